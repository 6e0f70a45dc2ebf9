"""Cutting a project's resources, or a column's values, in parts of bounded size without one task for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogsearch.checkpoints import checkpointed

#: Parts that one window cuts, on average.
WINDOW_PARTS = 4


def _running(weight: Column, window) -> Column:
    """What stands before a row in its window."""
    return F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - weight


def number_parts(items: DataFrame, name: str, n_bytes: str, bound: int, most: int) -> DataFrame:
    """Adds `part_no` and `_bucket`: items `(project_id, kind, name, n_bytes, ...)` in parts of at most `bound` bytes and `most` items.

    A project within both bounds is part 0. Of others, an item over half the bound is a part by itself, and the small ones
    are dealt to buckets by the hash of their name and cut there, in order, wherever half the bound is reached. Parts are
    numbered by bucket: their counts come from the narrow columns of `items`, which are read three times (pass a written
    table), and nothing but those counts passes through one window per project. Projects and counts are written, so that Spark
    knows how few they are and ships them to the items, which then pass through one shuffle, to their buckets.
    """
    by_project, by_bucket = ["project_id"], ["project_id", "_bucket"]
    weight = F.col(n_bytes) + bound // most
    total = items.groupBy(*by_project).agg(F.sum(weight).alias("_total"))
    buckets = checkpointed(
        total.select(
            *by_project,
            F.when(F.col("_total") <= bound, F.col("_total") + 1).otherwise(F.lit(bound // 2)).alias("_cut"),
            F.when(F.col("_total") <= bound, 1).otherwise(F.ceil(F.col("_total") / (bound * WINDOW_PARTS))).alias("_buckets"),
        )
    )
    placed = items.join(buckets, by_project).withColumn("_bucket", F.pmod(F.xxhash64(name), F.col("_buckets")))
    large = weight > F.col("_cut")
    small_weight = F.when(large, 0).otherwise(weight)
    counts = placed.groupBy(*by_bucket, "_cut").agg(
        F.ceil(F.sum(small_weight) / F.col("_cut")).alias("_small"), F.count_if(large).alias("_large")
    )
    before = Window.partitionBy(*by_project).orderBy("_bucket")
    offsets = checkpointed(counts.select(*by_bucket, "_small", _running(F.col("_small") + F.col("_large"), before).alias("_offset")))

    order = Window.partitionBy(*by_bucket).orderBy("kind", name, n_bytes)
    of_small = F.floor(_running(small_weight, order) / F.col("_cut"))
    of_large = _running(large.cast("bigint"), order)
    numbered = placed.withColumn("_part", F.when(large, of_large).otherwise(of_small)).join(offsets, by_bucket)
    part = F.col("_offset") + F.when(large, F.col("_small")).otherwise(0) + F.col("_part")
    return numbered.withColumn("part_no", part.cast("int")).drop("_total", "_cut", "_buckets", "_part", "_small", "_offset")


def cut_values(values: DataFrame, keys: list[str], value: str, bound: int, ranges: str) -> DataFrame:
    """Adds `part`: the sorted values of each key in parts of about `bound` bytes.

    Column `ranges` numbers the ranges of keys and values that the rows are dealt to, so a key of any size is many tasks. Its
    bytes before a range come from one sum per key and range, those before a value from a window over its range. A part
    ends with the value that reaches the bound.
    """
    size = F.octet_length(value).cast("bigint") + 3  # with quotes and comma
    sums = values.groupBy(*keys, ranges).agg(F.sum(size).alias("_bytes"))
    offsets = sums.select(*keys, ranges, _running(F.col("_bytes"), Window.partitionBy(*keys).orderBy(ranges)).alias("_before"))
    local = _running(size, Window.partitionBy(*keys, ranges).orderBy(value))
    cut = values.withColumn("_local", local).join(offsets, [*keys, ranges])
    return cut.withColumn("part", F.floor((F.col("_before") + F.col("_local")) / bound).cast("int")).drop(ranges, "_local", "_before")
