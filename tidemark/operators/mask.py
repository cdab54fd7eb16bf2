"""PII masking for published tables (PO1).

The reference says PII columns are tagged and masked but defines no policy;
this is the publishing-side equivalent: per column, a one-way hash (joins on
the hashed value still work), a character-class mask, or NULL.

`tagged` puts the tags of the configuration into the columns' metadata. SILVER
models do so; plain references, Parquet files and merged tables keep it, so
`mask_tagged` finds what to mask in the schema of whatever is published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config as C

#: Name of the tag in a column's metadata.
TAG = "pii"
HOW = ("hash", "mask", "null")


def masked(c: str, how: str) -> F.Column:
    if how == "hash":
        return F.sha2(F.col(c).cast("string"), 256)
    if how == "mask":  # upper -> X, lower -> x, digit -> n, others kept
        return F.mask(F.col(c).cast("string"), F.lit("X"), F.lit("x"), F.lit("n"), F.lit(None))
    if how == "null":
        return F.lit(None).cast("string")
    raise ValueError(f"unknown masking {how!r}; use one of {HOW}")


def mask_pii(df: DataFrame, policy: dict[str, str]) -> DataFrame:
    """Replace each column named in `policy` by its masked form (same name)."""
    return df.select(*[masked(c, policy[c]).alias(c) if c in policy else F.col(c) for c in df.columns])


def tagged(c: str) -> F.Column:
    """The column, with its tag as metadata if the configuration has one for its name."""
    return F.col(c).alias(c, metadata={TAG: C.PII_TAGS[c]}) if c in C.PII_TAGS else F.col(c)


def mask_tagged(df: DataFrame, policy: dict[str, str] | None = None) -> DataFrame:
    """Mask every tagged column as `policy` (tag -> how) says; a tag without a rule is an error, never published as it is."""
    policy = C.MASK_BY_TAG if policy is None else policy
    tags = {f.name: f.metadata[TAG] for f in df.schema.fields if f.metadata and TAG in f.metadata}
    unknown = sorted(set(tags.values()) - set(policy))
    if unknown:
        raise ValueError(f"no masking for the tags {unknown}")
    return mask_pii(df, {c: policy[t] for c, t in tags.items()})


DEFAULT_CUSTOMER_POLICY = {"email": "hash", "first_name": "mask", "last_name": "mask", "full_name": "mask"}
