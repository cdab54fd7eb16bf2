"""Duplicate flagging (E1-E3): the earliest row per key wins, later ones are flagged.

The reference numbers rows per key with a window and flags `row_number > 1`.
A window sorts every row of a key inside one task, so a key holding a third
of the data would become one giant task. Here a partial aggregate finds the
first row of every key (a hot key costs one row per map task in the shuffle);
only keys with more than one row go on, and the rows look their key up in that
small set. AQE broadcasts it when its measured size allows and splits the
skewed partitions of the join when not; keys of one row find no partner and
are not flagged. The flag equals
`row_number() > 1` under a total order. Nothing runs before an action.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as C


def flag_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str] = C.ORDER_COLUMNS,
                    flag: str = "_is_duplicate", strategy: str = "aggregate") -> DataFrame:
    """Add boolean `flag`: True for every row but the first per `keys` by `order`.

    `order` must identify a row within its key (lineage columns do). Rows with
    a NULL key must be removed beforehand (the garbage-id filter does).

    strategy="aggregate" (default) is skew-tolerant (see module doc);
    strategy="window" is the reference's `row_number() > 1`: one shuffle
    fewer, but every row of a key is sorted in one task.
    """
    if strategy == "window":
        return number_rows(df, keys, order, "_rn").withColumn(flag, F.col("_rn") > 1).drop("_rn")
    if strategy != "aggregate":
        raise ValueError(f"unknown strategy {strategy!r}")
    keys = list(keys)
    rank = F.struct(*[F.col(c) for c in order])
    first = (df.groupBy(*keys).agg(F.min(rank).alias("_first_row"), F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > 1).select(*keys, "_first_row"))
    return (df.join(first, keys, "left")
            .withColumn(flag, F.coalesce(rank > F.col("_first_row"), F.lit(False)))
            .drop("_first_row"))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] = C.ORDER_COLUMNS,
                name: str = "_row_num") -> DataFrame:
    """Plain `row_number()` per key (the reference's form). Use for small or
    unskewed inputs; `flag_duplicates` is the skew-tolerant default."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = C.ORDER_COLUMNS) -> DataFrame:
    """Keep only the first row per key (top-1 per group).

    `max_by`-style aggregation: the winning row is chosen by a partial
    aggregate, so nothing per key is gathered in one place.
    """
    rank = F.struct(*[F.col(c) for c in order])
    others = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*others), rank)
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")
