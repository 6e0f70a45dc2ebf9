"""From a catalog to written MDL documents, where they are missing or out of date."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsearch.checkpoints import checkpointed
from catalogsearch.options import Options
from catalogsearch.sources.catalog import Catalog
from catalogsearch.sources.mdl import build_mdl, read_mdl, write_mdl
from catalogsearch.sources.store import of_projects

DIGEST = "digest string, project_id string"


@dataclass(frozen=True)
class Built:
    """All written documents, `(project_id, mdl)`, and the projects that this call built, `(project_id, digest)`."""

    documents: DataFrame
    projects: DataFrame


def _row_hash(frame: DataFrame, label: str, seed: int) -> Column:
    """Hash of a row and of where it has nulls."""
    columns = [F.col(f"`{c}`") for c in sorted(frame.columns)]
    return F.xxhash64(F.lit(label), F.lit(seed), *[x for c in columns for x in (c.isNull(), c)]).cast("decimal(38,0)")


def project_digests(catalog: Catalog, values: DataFrame | None, options: Options) -> DataFrame:
    """`project_id, digest`: changes with any row of a project's catalog or values, and with the options that shape the MDL.

    Two sums of row hashes for each table, so the order of rows is no matter and tasks sum what they read.
    """
    tables = {f.name: getattr(catalog, f.name) for f in fields(Catalog)} | ({} if values is None else {"values": values})
    hashed = [
        t.select("project_id", F.lit(name).alias("part"), _row_hash(t, name, 1).alias("a"), _row_hash(t, name, 2).alias("b"))
        for name, t in tables.items()
    ]
    sums = reduce(DataFrame.unionByName, hashed).groupBy("project_id", "part").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    shape = F.lit(f"{options.schema}|{options.table_prefix}|{options.value_part_bytes}|{values is not None}")
    lines = F.array_sort(F.collect_list(F.concat_ws(":", "part", "n", "a", "b")))
    return sums.groupBy("project_id").agg(F.sha2(F.concat_ws("\n", shape, lines), 256).alias("digest"))


def known_digests(spark: SparkSession, path: str) -> DataFrame:
    """Digests of the projects written under a path; none if there is nothing yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}_digests")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], DIGEST)
    return spark.read.schema(DIGEST).parquet(f"{path}_digests")


def build_if_absent(
    catalog: Catalog, values: DataFrame | None, path: str, options: Options, schema_url: str | None = None, refresh: bool = True
) -> Built:
    """Build and write the MDL of projects that are not written yet, or whose digest has changed since.

    With `refresh=False` a project that is written is taken as it is. Digests are kept in a folder beside the documents and
    written after them, so a run that fails in between builds its projects again. Projects without a name are left out.
    """
    spark = catalog.tables.sparkSession
    current = project_digests(catalog, values, options).where(F.col("project_id").isNotNull())
    due = checkpointed(current.join(known_digests(spark, path), ["project_id", "digest"] if refresh else "project_id", "left_anti").select("project_id", "digest"))
    if not due.isEmpty():
        own = replace(catalog, **{f.name: of_projects(getattr(catalog, f.name), due, "left_semi") for f in fields(Catalog)})
        some = None if values is None else checkpointed(of_projects(values, due, "left_semi"))
        write_mdl(build_mdl(own, some, options), path, options, schema_url, keep_others=True)
        listed = due.select("digest", "project_id").coalesce(1)  # two short texts for each project
        listed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("project_id").parquet(f"{path}_digests")
    return Built(read_mdl(spark, path), due)
