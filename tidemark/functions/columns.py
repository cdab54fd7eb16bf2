"""Column -> Column building blocks (cleaning, typing, flags, keys).

All are built-in Spark expressions, so they stay inside whole-stage codegen;
none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config as C


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c: Column | str) -> Column:
    """NULLIF(TRIM(c), ''): blanks only are trimmed."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def null_if_sentinel(c: Column | str, sentinel: str) -> Column:
    """NULLIF(TRIM(c), sentinel)."""
    return F.nullif(F.trim(_c(c)), F.lit(sentinel))


def null_tokens(c: Column | str, tokens=C.NULL_TOKENS) -> Column:
    """Loader null tokens: the listed tokens become NULL, other text is kept."""
    c = _c(c)
    return F.when(~c.isin(*tokens), c)


def word(c: Column | str, n: int) -> Column:
    """n-th space-separated word; a missing word is NULL (not '')."""
    return F.nullif(F.trim(F.split_part(_c(c), F.lit(" "), F.lit(n))), F.lit(""))


def full_name(first: Column, last: Column, strict: bool = False) -> Column:
    """Full name from parts. Default skips NULL parts; strict gives NULL."""
    if strict:
        return F.when(first.isNotNull() & last.isNotNull(), F.concat_ws(" ", first, last))
    return F.nullif(F.trim(F.concat_ws(" ", first, last)), F.lit(""))


def is_valid_email(c: Column | str) -> Column:
    return F.coalesce(_c(c).rlike(C.EMAIL_PATTERN), F.lit(False))


def is_clean_id(c: Column | str, field_name: str) -> Column:
    """Garbage-id predicate. NULL id gives NULL, so a filter drops the row."""
    c = _c(c)
    return (~c.ilike(C.BANNER_LIKE)) & (F.lower(c) != F.lit(field_name.lower()))


def is_positive(c: Column | str) -> Column:
    """Validity of prices, quantities and amounts: not NULL and > 0."""
    c = _c(c)
    return c.isNotNull() & (c > 0)


def to_decimal(c: Column | str, precision: int = 12, scale: int = 2) -> Column:
    """TRY_CAST(trim(text) AS DECIMAL(p, s)); overflow and junk give NULL."""
    return F.trim(_c(c)).try_cast(f"decimal({precision},{scale})")


def to_int(c: Column | str) -> Column:
    """TRY_CAST to INTEGER with rounding ('2.7' -> 3) via an exact decimal."""
    return F.trim(_c(c)).try_cast("decimal(38,0)").try_cast("int")


def to_date(c: Column | str) -> Column:
    """ISO date text -> DATE; anything else (incl. '2025' or '2024-02-30') NULL."""
    t = F.trim(_c(c))
    return F.when(t.rlike(C.ISO_DATE_PATTERN), t.try_cast("date"))


def to_bool(c: Column | str) -> Column:
    t = F.lower(F.trim(_c(c)))
    return (F.when(t.isin(*C.TRUE_TOKENS), F.lit(True))
            .when(t.isin(*C.FALSE_TOKENS), F.lit(False)))


def canonical_tier(source_tier: Column, tier_map: dict | None = None) -> Column:
    """upper(source tier) looked up in a small fixed map, else NULL."""
    tier_map = tier_map or {t: t for t in C.CANONICAL_TIERS}
    u = F.upper(source_tier)
    expr = None
    for src, dst in tier_map.items():
        expr = (F.when(u == F.lit(src), F.lit(dst)) if expr is None
                else expr.when(u == F.lit(src), F.lit(dst)))
    return expr


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the text-cast columns joined by '-', NULL as a fixed token."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(C.SURROGATE_KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(C.SURROGATE_KEY_SEPARATOR, *parts))


def is_refund(amount: Column, status: Column) -> Column:
    return (F.coalesce(amount < 0, F.lit(False))
            | F.coalesce(F.upper(status) == F.lit(C.REFUND_STATUS), F.lit(False)))


def line_total(quantity: Column, unit_price: Column) -> Column:
    return F.when(is_positive(quantity) & is_positive(unit_price),
                  (quantity * unit_price).cast("decimal(12,2)"))


def strip_inline_note(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), C.INLINE_NOTE_PATTERN, "")


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)
