"""Distinct values of text columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsearch.checkpoints import checkpointed
from catalogsearch.schemas import COLUMN_VALUES
from catalogsearch.sources.catalog import Catalog, columns_of, text_columns
from catalogsearch.sources.parts import cut_values
from catalogsearch.options import Options

# Type names of profiled columns in a PostgreSQL catalog.
TEXT_TYPES = ("character varying", "varchar", "text")

VALUE_KEYS = ["project_id", "table_name", "column_name"]
#: Sums of bytes by hash of the column, among which the large columns are looked for.
COLUMN_SUMS = 65_536


def profiled_columns(columns: DataFrame) -> DataFrame:
    """Catalog columns whose values are profiled."""
    return columns.where(F.lower("data_type").isin(*TEXT_TYPES))


def catalog_columns(catalog: Catalog, tables: Mapping[str, DataFrame], project_id: str, options: Options) -> dict[str, list[str]]:
    """The columns of given tables that the catalog has as text, for `fetch_unique_values`.

    Only columns that the tables have are listed, so the list is no longer than their schemas.
    """
    known = [(name, column) for name, frame in tables.items() for column in frame.columns]
    listed = catalog.columns.sparkSession.createDataFrame(known, "table_name string, column_name string")
    own = profiled_columns(columns_of(catalog, options)).where(F.col("project_id") == project_id)
    out: dict[str, list[str]] = {}
    for row in own.join(F.broadcast(listed), ["table_name", "column_name"]).orderBy("table_name", "ordinal_position").select("table_name", "column_name").collect():
        out.setdefault(row["table_name"], []).append(row["column_name"])
    return out


def fetch_unique_values(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    project_id: str,
    columns: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """All distinct values of all text columns, one row per value.

    Each table is scanned once whatever the number of its text columns, and one shuffle by
    value serves all tables; a value that fills most of a column is merged before it.
    `columns` names the profiled columns per table, as `catalog_columns` does, where the types do not tell.
    """

    def cells(name: str, frame: DataFrame) -> DataFrame | None:
        chosen = columns.get(name, []) if columns is not None else text_columns(frame)
        if not chosen:
            return None
        quoted = [F.col("`" + c.replace("`", "``") + "`") for c in chosen]
        return (
            frame.select(*[column.cast("string").alias(c) for column, c in zip(quoted, chosen)])
            .unpivot([], quoted, "column_name", "value")
            .where(F.col("value").isNotNull())
            .select(F.lit(project_id).alias("project_id"), F.lit(name).alias("table_name"), "column_name", "value")
        )

    parts = [part for part in (cells(name, frame) for name, frame in tables.items()) if part is not None]
    if not parts:
        return spark.createDataFrame([], COLUMN_VALUES)
    return reduce(DataFrame.unionByName, parts).distinct()


def column_value_sizes(values: DataFrame) -> DataFrame:
    """Number and total bytes of the distinct values of each column."""
    return values.groupBy(*VALUE_KEYS).agg(
        F.count("value").alias("n_values"), F.sum(F.octet_length("value").cast("bigint")).alias("n_bytes")
    )


def large_columns(values: DataFrame, part_bytes: int) -> DataFrame:
    """Keys of the columns with more than `part_bytes` of values, written.

    Bytes are summed by a hash of the column first, into a bounded number of sums. Only the columns of a sum over the bound, which
    each large column makes by itself, are summed one by one.
    """
    hashed = values.withColumn("_sum", F.pmod(F.xxhash64(*VALUE_KEYS), F.lit(COLUMN_SUMS)))
    sums = hashed.groupBy("_sum").agg(F.sum(F.octet_length("value").cast("bigint")).alias("_bytes"))
    heavy = checkpointed(sums.where(F.col("_bytes") > part_bytes).select("_sum"))
    some = hashed.join(F.broadcast(heavy), "_sum", "left_semi").drop("_sum")
    return checkpointed(column_value_sizes(some).where(F.col("n_bytes") > part_bytes).select(*VALUE_KEYS))


def nest_values(values: DataFrame, part_bytes: int) -> DataFrame:
    """The sorted values of each column as JSON lists: `(project_id, table_name, column_name, part, unique_values)`.

    A column within `part_bytes` is one list, part 0. A larger one is several, each of about that size, whose parts continue
    each other. `values` is read three times: pass a written table.
    """
    large = large_columns(values, part_bytes)
    listed = F.to_json(F.array_sort(F.collect_list("value"))).alias("unique_values")
    whole = values.join(large, VALUE_KEYS, "left_anti").groupBy(*VALUE_KEYS).agg(listed).withColumn("part", F.lit(0))
    if large.isEmpty():
        return whole.select(*VALUE_KEYS, "part", "unique_values")
    # Written, so that the ranges are the same for all that reads them.
    ranges = checkpointed(values.join(large, VALUE_KEYS, "left_semi").repartitionByRange(*VALUE_KEYS, "value").withColumn("_task", F.spark_partition_id()))
    cut = cut_values(ranges, VALUE_KEYS, "value", part_bytes, "_task")
    parts = cut.groupBy(*VALUE_KEYS, "part").agg(listed)
    return whole.select(*VALUE_KEYS, "part", "unique_values").unionByName(parts)
