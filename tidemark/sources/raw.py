"""RAW sink (A13) and table lookup by logical name.

RAW tables are append-only Parquet, partitioned by load batch and client.
Each micro-batch writes its own `_batch=<source>_<id>` partition with
dynamic partition overwrite, so replaying a batch after a failure rewrites
the same files instead of appending twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("raw", "rejects", "quarantine", "silver", "gold")


@dataclass(frozen=True)
class Catalog:
    """Logical name -> path map: `<root>/<layer>/<entity>`."""

    root: str

    def path(self, layer: str, entity: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{entity}"

    def read(self, spark: SparkSession, layer: str, entity: str) -> DataFrame:
        return spark.read.parquet(self.path(layer, entity))


def write_batch(df: DataFrame, path: str, batch: str) -> None:
    """Idempotent append of one load batch (replay-safe)."""
    (df.withColumn("_batch", F.lit(batch))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("_batch", "client_id").parquet(path))
