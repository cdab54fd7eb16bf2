"""JSON payloads as VARIANT: what the files really hold, beside the typed struct.

The typed parse keeps the fields of its schema. A client that renames a field or
adds one changes the payload without an error, so `path_counts` reports every
path that occurs, how often, and whether the schema knows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C
from tidemark.sources import payload as P


def variant_documents(raw: DataFrame) -> DataFrame:
    """RAW JSON payloads with `payload`, the whole document as VARIANT (NULL if it does not parse)."""
    clients = [s.client_id for s in C.PAYLOAD_SOURCES if s.fmt != "xml"]
    doc = F.from_json(P.clean_json_document(F.col("raw_payload")), "variant", P.JSON_OPTIONS)
    return raw.filter(F.col("client_id").isin(*clients)).withColumn("payload", doc)


def declared_paths(kind: T.DataType = P.JSON_DOCUMENT_SCHEMA, at: str = "") -> list[str]:
    """Paths of a schema: names joined by dots, `[]` for the elements of a list."""
    if isinstance(kind, T.ArrayType):
        return [f"{at}[]", *declared_paths(kind.elementType, f"{at}[]")]
    if not isinstance(kind, T.StructType):
        return []
    out = []
    for f in kind.fields:
        path = f"{at}.{f.name}" if at else f.name
        out += [path, *declared_paths(f.dataType, path)]
    return out


def depth(documents: DataFrame) -> int:
    """Levels of the deepest document (one aggregate, one number to the driver).

    Counted on the brackets of the canonical text without its strings: the merged
    schema would hide what lies below a place where types differ.
    """
    text = F.regexp_replace(F.to_json("payload"), r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "")
    brackets = F.split(F.regexp_replace(text, r"[^\[\]{}]", ""), "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(level, bracket):
        now = level["now"] + F.when(bracket.isin("[", "{"), 1).when(bracket.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(level["most"], now).alias("most"))
    return documents.agg(F.max(F.aggregate(brackets, start, step, lambda level: level["most"])).alias("d")).first()["d"] or 0


def path_counts(raw: DataFrame) -> DataFrame:
    """client_id, path, n (values at the path), known (the typed schema has it).

    One row per value at first: each level keeps the values found so far and
    opens the newest ones, so a document is parsed once; counts are partial
    aggregates.
    """
    documents = variant_documents(raw).select("client_id", "payload")
    spark = raw.sparkSession
    nodes = documents.select("client_id", F.lit("").alias("path"), F.col("payload").alias("v"), F.lit(False).alias("done"))
    for _ in range(depth(documents)):
        turns = F.when(F.col("done"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
        nodes = nodes.withColumn("open", F.explode(turns))
        nodes = nodes.withColumn("inner", F.expr("CASE WHEN open THEN v END"))
        nodes = nodes.lateralJoin(spark.tvf.variant_explode_outer(F.col("inner").outer()))
        name = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).when(
            F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key"))
        nodes = (nodes.filter(~F.col("open") | F.col("pos").isNotNull())
                 .select("client_id", F.when(F.col("open"), name).otherwise(F.col("path")).alias("path"),
                         F.when(F.col("open"), F.col("value")).alias("v"), (~F.col("open")).alias("done")))
    return (nodes.filter(F.col("path") != "").groupBy("client_id", "path").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("known", F.col("path").isin(declared_paths())))
