"""MDL documents: building, writing, reading and checking them.

An MDL document lists the models, relationships, views and metrics of a project. Here a project
is one or more rows `(project_id, part_no, models, relationships, views, metrics, columnValues)`: one row up to a number
of resources and bytes, and several parts beyond, so that no project has to fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogsearch.checkpoints import checkpointed
from catalogsearch.functions.text import READ_ALL, json_string
from catalogsearch.options import Options
from catalogsearch.schemas import (
    MDL,
    MDL_COLUMN,
    MDL_METRIC,
    MDL_MODEL,
    MDL_RELATIONSHIP,
    MDL_VALUES,
    MDL_VIEW,
    empty_list,
)
from catalogsearch.sources.catalog import (
    Catalog,
    base_tables,
    columns_of,
    fetch_primary_keys,
    fetch_relationships,
    views_of,
)
from catalogsearch.sources.parts import number_parts
from catalogsearch.sources.profile import nest_values

LISTS = {
    "models": MDL_MODEL,
    "relationships": MDL_RELATIONSHIP,
    "views": MDL_VIEW,
    "metrics": MDL_METRIC,
    "columnValues": MDL_VALUES,
}


def _object(*members: tuple[str, Column]) -> Column:
    """JSON object of raw JSON members; null members are left out."""
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{key}":'), raw) for key, raw in members])
    return F.concat(F.lit("{"), body, F.lit("}"))


def _given(json: Column) -> Column:
    return F.nullif(json, F.lit("{}"))


def _described(text: Column) -> Column:
    return F.when(text != "", json_string(text))


def _bytes(*texts: Column) -> Column:
    """Size of some texts in a document, and of what stands around them."""
    return sum((F.coalesce(F.octet_length(t), F.lit(0)).cast("bigint") for t in texts), F.lit(64).cast("bigint"))


def with_lists(columns: DataFrame, lists: DataFrame) -> DataFrame:
    """Adds the `unique_values` of each column, null if it has none.

    Columns and lists go to the task of their table together, where the columns of a table are listed without another shuffle.
    """
    key = ["project_id", "table_name", "column_name"]
    own = columns.select("*", F.lit(None).cast("string").alias("unique_values"), F.lit(True).alias("_own"))
    listed = lists.select(*key, "unique_values", F.lit(False).alias("_own"))
    together = own.unionByName(listed, allowMissingColumns=True).repartition("project_id", "table_name")
    named = F.col("project_id").isNotNull() & F.col("table_name").isNotNull() & F.col("column_name").isNotNull()
    found = F.when(named, F.max("unique_values").over(Window.partitionBy(*key)))
    return together.withColumn("unique_values", found).where("_own").drop("_own")


def catalog_models(tables: DataFrame, catalog: Catalog, lists: DataFrame | None, options: Options) -> DataFrame:
    """One MDL model per given base table, columns in ordinal order: `(project_id, name, n_bytes, item)`.

    `lists` has the first list of values of each column.
    """
    columns = columns_of(catalog, options)
    if lists is None:
        columns = columns.withColumn("unique_values", F.lit(None).cast("string"))
    else:
        columns = with_lists(columns, lists)
    column = F.struct(
        F.col("column_name").alias("name"),
        F.col("data_type").alias("type"),
        F.lit(False).alias("isCalculated"),
        F.col("not_null").alias("notNull"),
        F.lit(None).cast("boolean").alias("isHidden"),
        F.lit(None).cast("string").alias("expression"),
        F.lit(None).cast("string").alias("relationship"),
        _given(
            _object(
                ("description", _described(F.col("comment"))), ("uniqueValues", F.col("unique_values"))
            )
        ).alias("properties"),
    ).cast(MDL_COLUMN)
    # The width of a table bounds each of these lists.
    listed = columns.select("project_id", "table_name", "ordinal_position", column.alias("column")).groupBy("project_id", "table_name").agg(
        F.array_sort(F.collect_list(F.struct("ordinal_position", "column"))).alias("columns"),
        F.sum(_bytes(F.col("column.name"), F.col("column.type"), F.col("column.properties"))).alias("columns_bytes"),
    )
    keys = fetch_primary_keys(catalog, options).withColumnRenamed("column_name", "primary_key")
    return (
        tables.join(listed, ["project_id", "table_name"], "left")
        .join(keys, ["project_id", "table_name"], "left")
        .select(
            "project_id",
            F.col("table_name").alias("name"),
            (F.coalesce("columns_bytes", F.lit(0)) + _bytes(F.col("table_name"), F.col("comment"))).alias("n_bytes"),
            F.struct(
                F.col("table_name").alias("name"),
                F.struct(F.lit(options.schema).alias("schema"), F.col("table_name").alias("table")).alias(
                    "tableReference"
                ),
                F.coalesce(F.transform("columns", lambda c: c["column"]), empty_list(MDL_COLUMN)).alias("columns"),
                F.col("primary_key").alias("primaryKey"),
                _given(_object(("description", _described(F.col("comment"))))).alias("properties"),
            )
            .cast(MDL_MODEL)
            .alias("item"),
        )
    )


def further_values(lists: DataFrame, tables: DataFrame) -> DataFrame:
    """The lists of values after the first of each column, numbered within their table."""
    rest = lists.where("part > 0")
    key = ["project_id", "table_name", "column_name", "part"]
    number = F.row_number().over(Window.partitionBy("project_id", "table_name").orderBy("column_name", "part")) - 1
    places = rest.select(*key).withColumn("place", number)
    own = rest.join(places, key).join(tables.select("project_id", "table_name"), ["project_id", "table_name"], "left_semi")
    item = F.struct(F.col("table_name").alias("model"), F.col("column_name").alias("column"), "part", "place", F.col("unique_values").alias("values"))
    return own.select("project_id", F.col("table_name").alias("name"), _bytes(F.col("unique_values")).alias("n_bytes"), item.cast(MDL_VALUES).alias("item"))


def build_mdl(catalog: Catalog, values: DataFrame | None, options: Options) -> DataFrame:
    """MDL rows of every project in the catalog.

    Models are sorted by name, relationships by name and condition, views by name. A project is one row up to
    `mdl_part_size` resources and `mdl_part_bytes`, and parts within both beyond; only a resource that is larger by itself
    makes a larger part. A list of values over `value_part_bytes` goes on in `columnValues`, so that none is too large for a
    row. The values are read twice: pass a written or checkpointed table.
    """
    tables = base_tables(catalog, options).select("project_id", "table_name", "comment")
    lists = None if values is None else checkpointed(nest_values(values, options.value_part_bytes))
    first = None if lists is None else lists.where("part = 0").drop("part")
    relation, view = F.struct("name", "models", "joinType", "condition"), F.struct("name", "statement", "properties")
    size_of_relation = _bytes(F.col("name"), F.col("condition"), F.array_join("models", ","))
    kinds = {
        "models": catalog_models(tables, catalog, first, options),
        "relationships": fetch_relationships(catalog, options).select(
            "project_id", "name", size_of_relation.alias("n_bytes"), relation.cast(MDL_RELATIONSHIP).alias("item")
        ),
        "views": views_of(catalog, options).select(
            "project_id", "name", _bytes(F.col("name"), F.col("statement"), F.col("properties")).alias("n_bytes"), view.cast(MDL_VIEW).alias("item")
        ),
    }
    if lists is not None:
        kinds["columnValues"] = further_values(lists, tables)
    rows = None
    for number, (kind, items) in enumerate(kinds.items()):
        part = items.select(
            "project_id",
            F.lit(number).alias("kind"),
            "name",
            "n_bytes",
            *[(F.col("item") if k == kind else F.lit(None).cast(LISTS[k])).alias(k) for k in kinds],
        )
        rows = part if rows is None else rows.unionByName(part)
    parts = number_parts(checkpointed(rows), "name", "n_bytes", options.mdl_part_bytes, options.mdl_part_size)
    built = parts.groupBy("project_id", "_bucket", "part_no").agg(*[F.sort_array(F.collect_list(kind)).alias(kind) for kind in kinds])
    for name, element in LISTS.items():
        if name not in kinds:
            built = built.withColumn(name, empty_list(element))
    return built.select("project_id", "part_no", *LISTS)


def _list_json(items: Column, shown) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, shown), ","), F.lit("]"))


def _scalars(item: Column, *fields: str) -> list[tuple[str, Column]]:
    return [(field, json_string(item[field])) for field in fields]


def _flag(value: Column) -> Column:
    return value.cast("string")


def _column_json(column: Column) -> Column:
    return _object(
        *_scalars(column, "name", "type"),
        ("isCalculated", _flag(column["isCalculated"])),
        ("notNull", _flag(column["notNull"])),
        ("isHidden", _flag(column["isHidden"])),
        *_scalars(column, "expression", "relationship"),
        ("properties", column["properties"]),
    )


def model_json(model: Column) -> Column:
    """JSON text of a model."""
    return _object(
        *_scalars(model, "name"),
        ("tableReference", F.to_json(model["tableReference"])),
        ("columns", _list_json(model["columns"], _column_json)),
        *_scalars(model, "primaryKey"),
        ("properties", model["properties"]),
    )


def mdl_json(mdl: DataFrame, options: Options, schema_url: str | None = None) -> DataFrame:
    """MDL rows as JSON documents: `(project_id, part_no, mdl)`."""
    url = F.lit(schema_url).cast("string")
    document = _object(
        ("$schema", json_string(url) if schema_url else url),
        ("catalog", F.lit('"default"')),
        ("schema", json_string(F.lit(options.schema))),
        ("dataSource", F.lit('"POSTGRES"')),
        ("models", _list_json(F.col("models"), model_json)),
        ("relationships", F.to_json("relationships")),
        (
            "views",
            _list_json(
                F.col("views"),
                lambda v: _object(*_scalars(v, "name", "statement"), ("properties", v["properties"])),
            ),
        ),
        (
            "metrics",
            _list_json(
                F.col("metrics"),
                lambda m: _object(
                    *_scalars(m, "name", "baseObject"),
                    ("dimension", F.to_json(m["dimension"])),
                    ("measure", F.to_json(m["measure"])),
                    ("properties", m["properties"]),
                ),
            ),
        ),
        (
            "columnValues",
            F.when(
                F.size("columnValues") > 0,
                _list_json(
                    F.col("columnValues"),
                    lambda v: _object(*_scalars(v, "model", "column"), *[(n, v[n].cast("string")) for n in ("part", "place")], ("values", v["values"])),
                ),
            ),
        ),
        ("enumDefinitions", F.lit("[]")),
        ("part", F.when(F.col("part_no") > 0, F.col("part_no").cast("string"))),
    )
    return mdl.select("project_id", "part_no", document.alias("mdl"))


def write_mdl(mdl: DataFrame, path: str, options: Options, schema_url: str | None = None, keep_others: bool = False) -> None:
    """Write the documents as text lines, one per part, in gzip files in a folder per project.

    With `keep_others`, folders of other projects stay.
    """
    (
        mdl_json(mdl, options, schema_url)
        .select("project_id", F.col("mdl").alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if keep_others else "static")
        .partitionBy("project_id")
        .option("compression", "gzip")
        .text(path)
    )


def read_mdl(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Written documents: `(project_id, mdl)`. `whole_files` reads one indented document per file."""
    reader = spark.read.schema("value string, project_id string").option("wholetext", whole_files)
    return reader.text(path).select("project_id", F.col("value").alias("mdl"))


#: Each list as raw JSON text, so that its JSON type shows, and the text itself if it is broken.
_SHAPE = ",".join(f"{name} string" for name in LISTS) + ",part string,broken string"
#: The whole document, and the text itself if it does not fit these types.
_FITTING = MDL.removesuffix(">") + ",part:string,broken:string>"
_OBJECT = r"^\s*\{"
NO_OBJECT = "no JSON object"
FLAGS = ("isCalculated", "notNull", "isHidden")
#: The document with flags of any type, and a text in which there may be flags that are no booleans.
_ANY_FLAGS = MDL.replace(",".join(f"{flag}:boolean" for flag in FLAGS), ",".join(f"{flag}:variant" for flag in FLAGS))
_ODD_FLAG = rf'"(?:{"|".join(FLAGS)})"\s*:\s*[-0-9"\[{{]'


def _truthy(value: Column) -> Column:
    """Whether a value is neither false, zero nor empty; null stays null."""
    kind, text = F.schema_of_variant(value), value.cast("string")
    full = F.when(kind == "BOOLEAN", text == "true").when(kind == "STRING", text != "").when(kind.rlike("^(ARRAY|OBJECT)"), ~text.isin("[]", "{}"))
    return F.when(kind != "VOID", F.coalesce(full, text.try_cast("double") != 0, F.lit(True)))


def _with_plain_flags(models: Column) -> Column:
    names = [field.split(":")[0] for field in MDL_COLUMN.removeprefix("struct<").removesuffix(">").split(",")]

    def column(c: Column) -> Column:
        return F.struct(*[(_truthy(c[n]) if n in FLAGS else c[n]).alias(n) for n in names])

    def model(m: Column) -> Column:
        columns = F.transform(m["columns"], lambda c: F.when(c.isNotNull(), column(c)))
        return F.struct(m["name"], m["tableReference"], columns.alias("columns"), m["primaryKey"], m["properties"])

    return F.transform(models, lambda m: F.when(m.isNotNull(), model(m)))


def _once(value: Column) -> Column:
    return F.explode(F.array(value))


def reject_reason(text: Column, shape: Column) -> Column:
    """Why a text, with its parsed shape, is no MDL document; null if it is one."""
    reason = F.when(
        text.isNull() | ~F.coalesce(text.rlike(_OBJECT), F.lit(False)) | shape.isNull() | shape["broken"].isNotNull(),
        NO_OBJECT,
    )
    for name in LISTS:
        reason = reason.when(shape[name].isNotNull() & ~shape[name].startswith("["), f"{name} is no list")
    return reason


def judge_mdl(documents: DataFrame) -> DataFrame:
    """Documents `(project_id, mdl)` parsed: `(project_id, part_no, reason, mdl, models, relationships, ...)`.

    `reason` says why a document is none, and `mdl` is kept for those alone. A document is parsed once; only one that does not
    fit the types, such as one with a number as a flag, is looked at again for its shape and odd flags.
    """
    options = READ_ALL | {"columnNameOfCorruptRecord": "broken"}
    # A list of one keeps each parse from being repeated for all that reads it.
    fitting = documents.select("project_id", "mdl", _once(F.from_json("mdl", _FITTING, options)).alias("m"))
    fits = F.col("m").isNotNull() & F.col("m.broken").isNull()
    shaped = fitting.select("*", _once(F.when(~fits, F.from_json("mdl", _SHAPE, options))).alias("shape"))
    text = F.col("mdl")
    judged = shaped.select(
        "project_id",
        "mdl",
        "m",
        fits.alias("fits"),
        F.coalesce(F.when(fits, F.col("m.part")).otherwise(F.col("shape.part")).try_cast("int"), F.lit(0)).alias("part_no"),
        F.when(fits, F.when(~text.rlike(_OBJECT), NO_OBJECT)).otherwise(reject_reason(text, F.col("shape"))).alias("reason"),
    )
    valid, odd = F.col("reason").isNull(), text.rlike(_ODD_FLAG)
    again = judged.select(
        "*",
        _once(F.when(valid & ~F.col("fits") & ~odd, F.from_json("mdl", MDL, READ_ALL))).alias("p"),
        _once(F.when(valid & ~F.col("fits") & odd, F.from_json("mdl", _ANY_FLAGS, READ_ALL))).alias("v"),
    )
    lists = {name: F.when(F.col("fits"), F.col(f"m.{name}")).otherwise(F.coalesce(F.col(f"p.{name}"), F.col(f"v.{name}"))) for name in LISTS}
    plain = _with_plain_flags(F.col("v.models")).cast(f"array<{MDL_MODEL}>")
    lists["models"] = F.when(F.col("fits"), F.col("m.models")).otherwise(F.coalesce(F.col("p.models"), plain))
    return again.select(
        "project_id",
        "part_no",
        "reason",
        F.when(~valid, text).alias("mdl"),
        *[F.when(valid, F.coalesce(lists[name], empty_list(element))).alias(name) for name, element in LISTS.items()],
    )


def accepted(judged: DataFrame) -> DataFrame:
    """The MDL rows of judged documents."""
    return judged.where(F.col("reason").isNull()).select("project_id", "part_no", *LISTS)


def rejected(judged: DataFrame) -> DataFrame:
    """The rejects of judged documents, with their `reason`."""
    return judged.where(F.col("reason").isNotNull()).select("project_id", "part_no", "mdl", "reason")


def validate_mdl(documents: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parse documents `(project_id, mdl)` to MDL rows and rejects, which carry a `reason`.

    Missing and null lists become empty. Text that is no JSON object, or has another value in place
    of a list, goes to the rejects, or fails the job with `strict`. Documents may be of any size that
    a row can hold. A project with several documents numbers them by `part`.
    """
    judged = judge_mdl(documents)
    rows = accepted(judged)
    if strict:
        message = F.concat(F.lit("invalid MDL JSON in project "), F.coalesce("project_id", F.lit("")))
        valid = F.when(F.col("reason").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
        rows = judged.where(valid).select("project_id", "part_no", *LISTS)
    return rows, rejected(judged)
