"""Catalog tables: reading them, and the facts taken from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsearch.options import Options
from catalogsearch.schemas import CATALOG

RELATION_KEYS = ["project_id", "table_schema", "constraint_name"]


@dataclass(frozen=True)
class Catalog:
    """The six catalog tables, each keyed by project. Key tables and views may be left empty."""

    tables: DataFrame
    columns: DataFrame
    constraints: DataFrame
    key_usage: DataFrame
    constraint_columns: DataFrame
    views: DataFrame


def empty(spark: SparkSession, table: str) -> DataFrame:
    """An empty catalog table."""
    return spark.createDataFrame([], CATALOG[table])


def catalog_of(
    spark: SparkSession, tables: Mapping[str, DataFrame], project_id: str, schema: str = "public", **given: DataFrame
) -> Catalog:
    """Catalog of named DataFrames, from their schemas alone.

    Comments come from the field metadata (`comment`). Keys and views, which files do not
    have, can be passed by catalog table name.
    """
    listed, columns = [], []
    for name, frame in tables.items():
        listed.append((project_id, schema, name, "BASE TABLE", None))
        for position, field in enumerate(frame.schema.fields, start=1):
            columns.append(
                (
                    project_id,
                    schema,
                    name,
                    field.name,
                    position,
                    field.dataType.simpleString(),
                    "YES" if field.nullable else "NO",
                    (field.metadata or {}).get("comment"),
                )
            )
    own = {
        "cat_tables": spark.createDataFrame(listed, CATALOG["cat_tables"]),
        "cat_columns": spark.createDataFrame(columns, CATALOG["cat_columns"]),
    }
    return Catalog(*[given.get(name, own.get(name)) or empty(spark, name) for name in CATALOG])


# System views of a PostgreSQL database, one query per catalog table.
_JDBC = {
    "cat_tables": """
        SELECT t.table_schema, t.table_name, t.table_type, obj_description(c.oid, 'pg_class') AS comment
        FROM information_schema.tables t
        JOIN pg_namespace n ON n.nspname = t.table_schema
        JOIN pg_class c ON c.relnamespace = n.oid AND c.relname = t.table_name""",
    "cat_columns": """
        SELECT s.table_schema, s.table_name, s.column_name, s.ordinal_position::int AS ordinal_position,
               s.data_type, s.is_nullable, col_description(c.oid, s.ordinal_position::int) AS comment
        FROM information_schema.columns s
        JOIN pg_namespace n ON n.nspname = s.table_schema
        JOIN pg_class c ON c.relnamespace = n.oid AND c.relname = s.table_name""",
    "cat_constraints": """
        SELECT table_schema, table_name, constraint_name, constraint_type
        FROM information_schema.table_constraints""",
    "cat_key_usage": """
        SELECT table_schema, table_name, constraint_name, column_name, ordinal_position::int AS ordinal_position
        FROM information_schema.key_column_usage""",
    "cat_constraint_columns": """
        SELECT n.nspname AS table_schema, r.relname AS table_name, k.conname AS constraint_name,
               a.attname AS column_name, u.place::int AS ordinal_position, t.relname AS source_table
        FROM pg_constraint k
        JOIN pg_class t ON t.oid = k.conrelid
        JOIN pg_class r ON r.oid = k.confrelid
        JOIN pg_namespace n ON n.oid = r.relnamespace
        CROSS JOIN LATERAL unnest(k.confkey) WITH ORDINALITY AS u(attnum, place)
        JOIN pg_attribute a ON a.attrelid = k.confrelid AND a.attnum = u.attnum
        WHERE k.contype = 'f'""",
    "cat_views": """
        SELECT table_schema, table_name, view_definition
        FROM information_schema.views""",
}


def read_jdbc_catalog(spark: SparkSession, url: str, project_id: str, properties: Mapping[str, str]) -> Catalog:
    """Catalog of a PostgreSQL database; filters on schema and table name reach the database."""

    def read(name: str) -> DataFrame:
        frame = spark.read.jdbc(url, f"({_JDBC[name]}) AS {name}", properties=dict(properties))
        return frame.select(F.lit(project_id).alias("project_id"), "*")

    return Catalog(*[read(name) for name in CATALOG])


def named(options: Options, like: bool = False, column: str = "table_name") -> Column:
    """Schema and name prefix test. With `like`, an underscore in the prefix matches any character."""
    name, prefix = F.col(column), options.table_prefix
    return (F.col("table_schema") == options.schema) & (
        name.like(f"{prefix}%") if like else name.startswith(prefix)
    )


def base_tables(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """Base tables of the schema with the prefix."""
    return catalog.tables.where((F.col("table_type") == "BASE TABLE") & named(options, like))


def fetch_tables(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """Names of the base tables, sorted."""
    return base_tables(catalog, options, like).select("project_id", "table_name").orderBy("project_id", "table_name")


def columns_of(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """Columns with their type, nullability and comment."""
    return catalog.columns.where(named(options, like)).select(
        "project_id",
        "table_name",
        "column_name",
        "ordinal_position",
        "data_type",
        (F.col("is_nullable") == "NO").alias("not_null"),
        "comment",
    )


def fetch_columns(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """Columns in ordinal order."""
    return columns_of(catalog, options, like).drop("comment").orderBy("project_id", "table_name", "ordinal_position")


def fetch_primary_keys(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """First primary key column of each table.

    The table is part of the join key, as constraint names may repeat within a schema. The first column of each constraint
    is chosen before the join, where tasks have most columns of a constraint together.
    """
    keys = catalog.constraints.where((F.col("constraint_type") == "PRIMARY KEY") & named(options, like))
    place = F.struct("ordinal_position", "column_name")
    first = catalog.key_usage.groupBy(*RELATION_KEYS, "table_name").agg(F.min(place).alias("first"))
    return (
        keys.join(first, [*RELATION_KEYS, "table_name"])
        .groupBy("project_id", "table_name")
        .agg(F.min("first")["column_name"].alias("column_name"))
    )


def fetch_table_descriptions(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """Table comments, empty where there is none."""
    return base_tables(catalog, options, like).select(
        "project_id", "table_name", F.coalesce("comment", F.lit("")).alias("table_description")
    )


def fetch_column_descriptions(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """Column comments of base tables, empty where there is none."""
    tables = base_tables(catalog, options, like).select("project_id", "table_schema", "table_name")
    return (
        catalog.columns.where(named(options, like))
        .join(tables, ["project_id", "table_schema", "table_name"], "left_semi")
        .select(
            "project_id", "table_name", "column_name", F.coalesce("comment", F.lit("")).alias("column_description")
        )
    )


def fetch_relationships(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """Foreign keys with both ends in the catalog slice, always many to one.

    `constraint_columns` may carry `ordinal_position`, which pairs the columns of a composite
    key, and `source_table`, which keeps equal constraint names of several tables apart.
    """
    keys = catalog.constraints.where((F.col("constraint_type") == "FOREIGN KEY") & named(options, like)).select(
        *RELATION_KEYS, "table_name"
    )
    used = catalog.key_usage.select(
        *RELATION_KEYS, "table_name", F.col("column_name").alias("from_column"), "ordinal_position"
    )
    given = catalog.constraint_columns.columns
    referenced = catalog.constraint_columns.where(named(options, like)).select(
        *RELATION_KEYS,
        F.col("table_name").alias("to_table"),
        F.col("column_name").alias("to_column"),
        *(["ordinal_position"] if "ordinal_position" in given else []),
        *([F.col("source_table").alias("table_name")] if "source_table" in given else []),
    )
    pairing = [c for c in ("ordinal_position", "table_name") if c in referenced.columns]
    return (
        keys.join(used, [*RELATION_KEYS, "table_name"])
        .join(referenced, RELATION_KEYS + pairing)
        .select(
            "project_id",
            F.col("constraint_name").alias("name"),
            F.array("table_name", "to_table").alias("models"),
            F.lit("MANY_TO_ONE").alias("joinType"),
            F.format_string('"%s".%s = "%s".%s', "table_name", "from_column", "to_table", "to_column").alias(
                "condition"
            ),
        )
    )


def views_of(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """Views with their definition and a standard description."""
    description = F.concat(F.lit("View for "), F.col("table_name")).alias("description")
    return catalog.views.where(named(options, like)).select(
        "project_id",
        F.col("table_name").alias("name"),
        F.col("view_definition").alias("statement"),
        F.to_json(F.struct(description)).alias("properties"),
    )


def fetch_views(catalog: Catalog, options: Options, like: bool = False) -> DataFrame:
    """The same, sorted."""
    return views_of(catalog, options, like).orderBy("project_id", "name")


def text_columns(frame: DataFrame) -> list[str]:
    """Names of the text columns of a DataFrame."""
    return [
        f.name for f in frame.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))
    ]
