"""Joins of many rows with a lookup by keys of which some may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsearch.checkpoints import checkpointed


def hot_keys(rows: DataFrame, keys: list[str], hub_rows: int, hubs: int) -> DataFrame | None:
    """`_hub, _pieces` of the keys with more than `hub_rows` rows, the `hubs` largest at most, written once; None if no key
    has so many.

    A key is known by its hash, so the table has a bound in bytes. A hash that two keys share only makes both split.
    """
    counts = rows.groupBy(F.xxhash64(*keys).alias("_hub")).agg(F.count("*").alias("_n")).where(F.col("_n") > hub_rows)
    largest = counts.orderBy(F.col("_n").desc(), "_hub").limit(hubs)
    hot = checkpointed(largest.select("_hub", F.ceil(F.col("_n") / hub_rows).cast("int").alias("_pieces")))
    return None if hot.isEmpty() else hot


def hub_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread: str, hot: DataFrame | None, how: str = "inner"
) -> DataFrame:
    """Inner or left join of rows with a lookup of few rows per key.

    The rows of the `hot_keys` are dealt, by the hash of column `spread`, to their pieces, and their lookup rows are repeated
    for each piece, so no join key has more rows than `hub_rows`, or than all rows divided by `hubs`. The hot keys go to all
    tasks: a hash and a number for each of at most `hubs` keys.
    """
    if hot is None:
        return rows.join(lookup, keys, how)
    few = F.broadcast(hot)

    def marked(frame: DataFrame) -> DataFrame:
        found = frame.withColumn("_hub", F.xxhash64(*keys)).join(few, "_hub", "left")
        return found.withColumn("_pieces", F.coalesce("_pieces", F.lit(1)))

    dealt = marked(rows).withColumn("_piece", F.pmod(F.xxhash64(spread), F.col("_pieces")).cast("int"))
    repeated = marked(lookup).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    side = repeated.drop("_hub", "_pieces")
    return dealt.drop("_hub", "_pieces").join(side, [*keys, "_piece"], how).drop("_piece")
