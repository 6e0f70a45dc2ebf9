"""MDL rows to schema chunks and table descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogsearch.functions import comments
from catalogsearch.functions.binding import bind
from catalogsearch.functions.comments import CommentBuilder
from catalogsearch.functions.text import READ_ALL
from catalogsearch.operators.hubs import hot_keys, hub_join
from catalogsearch.operators.numbering import number_rows
from catalogsearch.options import Options
from catalogsearch.schemas import COMMAND, MDL_COLUMN, ORD, empty_list

TABLE_SCHEMA = "TABLE_SCHEMA"
TABLE_DESCRIPTION = "TABLE_DESCRIPTION"
MODELS, VIEWS, METRICS = 0, 1, 2
CHUNK, HEADER, VALUES = 0, 1, 2
#: Bytes of value lists that are joined in one piece, in parts of MDL documents.
PIECE_PARTS = 4

JOIN_TYPES = ("MANY_TO_ONE", "ONE_TO_MANY", "ONE_TO_ONE")


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def _resources(mdl: DataFrame, name: str) -> DataFrame:
    """One row per list element with its position over all parts of the project."""
    return mdl.select("project_id", "part_no", F.posexplode(name).alias("_pos", "item")).select(
        "project_id", (F.col("part_no").cast("bigint") * F.lit(2**32) + F.col("_pos")).alias("pos"), "item"
    )


def preprocess_models(mdl: DataFrame) -> DataFrame:
    """Models with their visible columns."""
    item = F.col("item")
    return _resources(mdl, "models").select(
        "project_id",
        "pos",
        _text(item["name"]).alias("name"),
        _text(item["primaryKey"]).alias("primary_key"),
        item["properties"].alias("properties"),
        F.coalesce(
            F.filter(item["columns"], lambda c: ~F.coalesce(c["isHidden"], F.lit(False))), empty_list(MDL_COLUMN)
        ).alias("columns"),
    )


def column_commands(models: DataFrame, extra: tuple[CommentBuilder, ...] = ()) -> DataFrame:
    """Adds the column commands of each model; columns that stand for a relation have none."""

    def command(column: Column) -> Column:
        return F.struct(
            F.lit("COLUMN").alias("type"),
            comments.column_comment(column, extra).alias("comment"),
            _text(column["name"]).alias("name"),
            _text(column["type"]).alias("data_type"),
            (_text(column["name"]) == F.col("primary_key")).alias("is_primary_key"),
            F.lit(None).cast("string").alias("constraint"),
            F.lit(None).cast("array<string>").alias("tables"),
        ).cast(COMMAND)

    own = F.filter("columns", lambda c: _text(c["relationship"]) == "")
    return models.withColumn("n_columns", F.size(own)).withColumn("commands", F.transform(own, command))


def _key_column(condition: Column, side: Column) -> Column:
    """Column named by one side of `"a".x = "b".y`."""

    def column(part: Column) -> Column:
        quoted = F.regexp_extract(part, r'^"[^"]*"\.(.+)$', 1)
        return _text(F.when(part.startswith('"'), quoted).otherwise(F.get(F.split(part, r"\."), F.lit(1))))

    return bind(F.get(F.split(condition, " = "), side), column)


def relation_ends(mdl: DataFrame, options: Options) -> DataFrame:
    """Foreign key lines by the names they are for and refer to: `(project_id, rel_pos, item, side, name, related)`.

    `item` has the condition and join type of the relation; its models are the two names, in the order that `side` says.
    In `source_only` mode a relation belongs to its first model. In `reference` mode it is
    repeated on the second, and a model that relates to itself has it once.
    """
    item, side = F.col("item"), F.col("side")
    pair = _resources(mdl, "relationships").where(
        (F.size(item["models"]) == 2) & item["joinType"].isin(*JOIN_TYPES)
    )
    first, second = F.get(item["models"], F.lit(0)), F.get(item["models"], F.lit(1))
    if options.fk_mode == "reference":
        sides = F.when(first == second, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    else:
        sides = F.array(F.lit(0))
    ends = pair.select("project_id", F.col("pos").alias("rel_pos"), "item", F.explode(sides).alias("side"))
    return ends.select(
        "project_id",
        "rel_pos",
        F.struct(item["condition"].alias("condition"), item["joinType"].alias("joinType")).alias("item"),
        "side",
        F.get(item["models"], side).alias("name"),
        F.get(item["models"], 1 - side).alias("related"),
    )


def hub_models(ends: DataFrame, options: Options) -> DataFrame | None:
    """Models that very many relations belong or refer to."""
    names = ends.select("project_id", F.explode(F.array("name", "related")).alias("name"))
    return hot_keys(names, ["project_id", "name"], options.hub_rows, options.hubs)


def with_owners(ends: DataFrame, models: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """Ends with place and width of the models of their name; names that are no model are dropped."""
    return hub_join(ends, models.select("project_id", "name", "pos", "n_columns"), ["project_id", "name"], "rel_pos", hubs)


def with_key_command(ends: DataFrame, models: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """Adds the foreign key command of each end."""
    item = F.col("item")
    condition = _text(item["condition"])
    keys = models.groupBy("project_id", F.col("name").alias("related")).agg(
        F.max_by("primary_key", "pos").alias("related_key")
    )
    constraint = F.concat(
        F.lit("FOREIGN KEY ("),
        _key_column(condition, F.col("side")),
        F.lit(") REFERENCES "),
        F.col("related"),
        F.lit("("),
        _text(F.col("related_key")),
        F.lit(")"),
    )
    command = F.struct(
        F.lit("FOREIGN_KEY").alias("type"),
        comments.relation_comment(condition, item["joinType"]).alias("comment"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("data_type"),
        F.lit(None).cast("boolean").alias("is_primary_key"),
        constraint.alias("constraint"),
        F.when(F.col("side") == 0, F.array("name", "related")).otherwise(F.array("related", "name")).alias("tables"),
    ).cast(COMMAND)
    return (
        hub_join(ends, keys, ["project_id", "related"], "rel_pos", hubs, "left")
        .withColumn("command", command)
        .drop("item", "side", "related", "related_key")
    )


def relationship_commands(mdl: DataFrame, models: DataFrame, options: Options) -> DataFrame:
    """Foreign key commands of the models they belong to: `(project_id, pos, name, n_columns, rel_pos, command)`."""
    ends = relation_ends(mdl, options)
    hubs = hub_models(ends, options)
    return with_owners(with_key_command(ends, models, hubs), models, hubs)


def numbered_keys(mdl: DataFrame, models: DataFrame, options: Options) -> DataFrame:
    """`relationship_commands` with `rn`, the number of each among those of its model.

    Relations are numbered by the model's name, before anything of the model comes in: in one window while no model has
    more than `hub_rows` of them, else range by range.
    """
    ends = relation_ends(mdl, options)
    return _numbered(ends, models, hub_models(ends, options), options)


def _numbered(ends: DataFrame, models: DataFrame, hubs: DataFrame | None, options: Options) -> DataFrame:
    commands, owner = with_key_command(ends, models, hubs), ["project_id", "name"]
    if hubs is None:
        number = F.row_number().over(Window.partitionBy(*owner).orderBy("rel_pos"))
        numbered = commands.withColumn("rn", number.cast("bigint") - 1)
    else:
        numbered = number_rows(commands, owner, "rel_pos", options.number_bucket)
    return with_owners(numbered, models, hubs)


def listed_commands(ends: DataFrame, models: DataFrame) -> DataFrame:
    """Models with all their commands, columns before foreign keys, as `listed`; none of them is a hub.

    Models and keys are shuffled once, by project and name, and stay placed by it.
    """
    owner = ["project_id", "name"]
    in_order = F.sort_array(F.collect_list(F.struct("rel_pos", "command")))
    keys = with_key_command(ends, models, None).repartition(*owner).groupBy(*owner).agg(in_order.alias("keys"))
    joined = models.drop("columns", "primary_key", "n_columns").join(keys, owner, "left")
    listed = F.concat("commands", F.coalesce(F.col("keys")["command"], empty_list(COMMAND)))
    return joined.withColumn("listed", listed).drop("commands", "keys")


def _batches(size: int, batch) -> Column:
    """`batch(number, commands)` of each batch of `listed`."""
    count = F.ceil(F.size("listed") / size).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda n: batch(n, F.slice("listed", n * size + 1, F.lit(size))))


def column_chunks(mdl: DataFrame, options: Options, extra: tuple[CommentBuilder, ...] = ()) -> DataFrame:
    """Commands of each model, columns before foreign keys, in batches of `column_batch_size`."""
    models, ends = column_commands(preprocess_models(mdl), extra), relation_ends(mdl, options)
    hubs = hub_models(ends, options)
    if hubs is not None:
        return _hub_chunks(ends, models, hubs, options)
    batches = _batches(options.column_batch_size, lambda n, commands: F.struct(n.alias("chunk_no"), commands.alias("commands")))
    return listed_commands(ends, models).select("project_id", "pos", "name", F.inline(batches))


def _hub_chunks(ends: DataFrame, models: DataFrame, hubs: DataFrame, options: Options) -> DataFrame:
    """`column_chunks` where the foreign keys of a model may be too many for one row."""
    size = options.column_batch_size
    place = ["project_id", "pos", "name"]
    in_order = F.sort_array(F.collect_list(F.struct("rn", "command")))
    keys = (
        _numbered(ends, models, hubs, options)
        .withColumn("chunk_no", F.floor((F.col("n_columns") + F.col("rn")) / size).cast("int"))
        .groupBy(*place, "chunk_no", "n_columns")
        .agg(in_order.alias("numbered"))
        .select(*place, "chunk_no", "n_columns", F.transform("numbered", lambda x: x["command"]).alias("commands"))
    )
    # The first foreign keys of a model fill the batch of its last columns; later ones have batches of their own.
    fills = (F.col("chunk_no") == F.floor(F.col("n_columns") / size)) & (F.col("n_columns") % size > 0)
    first = keys.where(fills).select(*place, F.col("commands").alias("first_keys"))
    listed = F.concat("commands", F.coalesce("first_keys", empty_list(COMMAND)))
    whole = models.where("n_columns > 0").select(*place, "commands").join(first, place, "left").select(*place, listed.alias("listed"))
    batches = _batches(size, lambda n, commands: F.struct(n.alias("chunk_no"), commands.alias("commands")))
    own = whole.select(*place, F.inline(batches))
    return own.unionByName(keys.where(~fills).select(*place, "chunk_no", "commands"))


def _ord(section: int, kind: int, chunk_no: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"), F.col("pos"), F.lit(kind).alias("kind"), chunk_no.alias("chunk_no")
    ).cast(ORD)


def _documents(rows: DataFrame, doc_type: str) -> DataFrame:
    """Stored form of `(project_id, name, kind, ord, content)` rows.

    The id is a hash of the place of the document in its project, so a rebuild of the same MDL
    gives the same ids and two resources of one name stay two documents.
    """
    key = F.concat_ws(
        "|",
        _text(F.col("project_id")),
        F.lit(doc_type),
        F.col("kind"),
        F.col("ord.pos"),
        F.col("ord.chunk_no"),
        F.col("name"),
    )
    return rows.select(
        F.sha2(key, 256).alias("id"),
        "project_id",
        F.lit(doc_type).alias("type"),
        "name",
        "ord",
        "content",
        F.from_json(F.lit("{}"), "map<string,string>").alias("meta"),
    )


def _chunk(number: Column, commands: Column) -> Column:
    content = F.to_json(F.struct(F.lit("TABLE_COLUMNS").alias("type"), commands.alias("columns")))
    return F.struct(
        F.lit("TABLE_COLUMNS").alias("kind"), _ord(MODELS, CHUNK, number).alias("ord"), content.alias("content")
    )


def _header() -> Column:
    comment = comments.model_comment(F.col("properties"))
    content = F.to_json(F.struct(F.lit("TABLE").alias("type"), comment.alias("comment"), F.col("name")))
    return F.struct(F.lit("TABLE").alias("kind"), _ord(MODELS, HEADER, F.lit(0)).alias("ord"), content.alias("content"))


def chunk_documents(mdl: DataFrame, options: Options, extra: tuple[CommentBuilder, ...] = ()) -> DataFrame:
    """TABLE_COLUMNS payloads."""
    chunks = column_chunks(mdl, options, extra)
    return chunks.withColumn("_doc", _chunk(F.col("chunk_no"), F.col("commands"))).select("project_id", "name", "_doc.*")


def header_documents(mdl: DataFrame) -> DataFrame:
    """TABLE payloads, which follow the chunks of their model."""
    return preprocess_models(mdl).withColumn("_doc", _header()).select("project_id", "name", "_doc.*")


def table_documents(mdl: DataFrame, options: Options, extra: tuple[CommentBuilder, ...] = ()) -> DataFrame:
    """`chunk_documents` and `header_documents`; both come of the same row of a model while there are no hubs."""
    models, ends = column_commands(preprocess_models(mdl), extra), relation_ends(mdl, options)
    hubs = hub_models(ends, options)
    if hubs is not None:
        chunks = _hub_chunks(ends, models, hubs, options).withColumn("_doc", _chunk(F.col("chunk_no"), F.col("commands")))
        return chunks.select("project_id", "name", "_doc.*").unionByName(header_documents(mdl))
    own = F.concat(_batches(options.column_batch_size, _chunk), F.array(_header()))
    return listed_commands(ends, models).select("project_id", "name", F.inline(own))


def value_documents(mdl: DataFrame, options: Options) -> DataFrame:
    """COLUMN_VALUES payloads: values beyond the first list of a column, which follow the header of their model.

    The lists of a model are as many as its values ask for, so those of a model with more than fill a few parts are dealt to
    pieces, and the place of the model is repeated for each.
    """
    item = F.col("item")
    more = F.struct(
        F.lit("COLUMN").alias("type"),
        F.concat(F.lit('-- {"uniqueValues":'), item["values"], F.lit("}\n  ")).alias("comment"),
        _text(item["column"]).alias("name"),
    )
    content = F.to_json(F.struct(F.lit("COLUMN_VALUES").alias("type"), "name", F.array(more).alias("columns")))
    owner = ["project_id", "name"]
    lists = _resources(mdl, "columnValues").select("project_id", F.col("pos").alias("list_pos"), _text(item["model"]).alias("name"), "item")
    places = preprocess_models(mdl).groupBy(*owner).agg(F.min("pos").alias("pos"))
    many = max(1, PIECE_PARTS * options.mdl_part_bytes // options.value_part_bytes)
    hot = hot_keys(lists.select(*owner), owner, many, options.hubs)
    return hub_join(lists, places, owner, "list_pos", hot).select(
        "project_id",
        "name",
        F.lit("COLUMN_VALUES").alias("kind"),
        _ord(MODELS, VALUES, item["place"]).alias("ord"),
        content.alias("content"),
    )


def view_documents(mdl: DataFrame) -> DataFrame:
    """VIEW payloads."""
    item = F.col("item")
    content = F.to_json(
        F.struct(
            F.lit("VIEW").alias("type"),
            comments.view_comment(item["properties"]).alias("comment"),
            _text(item["name"]).alias("name"),
            _text(item["statement"]).alias("statement"),
        )
    )
    return _resources(mdl, "views").select(
        "project_id",
        _text(item["name"]).alias("name"),
        F.lit("VIEW").alias("kind"),
        _ord(VIEWS, CHUNK, F.lit(0)).alias("ord"),
        content.alias("content"),
    )


def metric_documents(mdl: DataFrame) -> DataFrame:
    """METRIC payloads: dimensions, then measures."""
    item = F.col("item")

    def command(field: Column, comment: Column) -> Column:
        return F.struct(
            F.lit("COLUMN").alias("type"),
            comment.alias("comment"),
            _text(field["name"]).alias("name"),
            _text(field["type"]).alias("data_type"),
        )

    none = empty_list("struct<type:string,comment:string,name:string,data_type:string>")
    dimensions = F.transform(item["dimension"], lambda d: command(d, F.lit(comments.DIMENSION_COMMENT)))
    measures = F.transform(item["measure"], lambda m: command(m, comments.measure_comment(m["expression"])))
    content = F.to_json(
        F.struct(
            F.lit("METRIC").alias("type"),
            comments.metric_comment(item["baseObject"]).alias("comment"),
            _text(item["name"]).alias("name"),
            F.concat(F.coalesce(dimensions, none), F.coalesce(measures, none)).alias("columns"),
        )
    )
    return _resources(mdl, "metrics").select(
        "project_id",
        _text(item["name"]).alias("name"),
        F.lit("METRIC").alias("kind"),
        _ord(METRICS, CHUNK, F.lit(0)).alias("ord"),
        content.alias("content"),
    )


def schema_documents(
    mdl: DataFrame, options: Options, extra: tuple[CommentBuilder, ...] = (), by_name: bool = False
) -> DataFrame:
    """All TABLE_SCHEMA documents of the projects.

    Those of models come placed by project and name; with `by_name` the others do too, so that a lookup by name which follows
    at once needs no shuffle.
    """
    others = [view_documents(mdl), metric_documents(mdl)]
    if "columnValues" in mdl.columns and not mdl.where(F.size("columnValues") > 0).isEmpty():
        others.append(value_documents(mdl, options))
    rows = table_documents(mdl, options, extra)
    for other in others:
        rows = rows.unionByName(other.repartition("project_id", "name") if by_name else other)
    return _documents(rows, TABLE_SCHEMA)


def description_documents(mdl: DataFrame) -> DataFrame:
    """One TABLE_DESCRIPTION document per named model, metric and view, in this order."""
    item = F.col("item")

    def described(name: str, section: int, columns: Column) -> DataFrame:
        content = F.to_json(
            F.struct(
                item["name"].alias("name"),
                _text(F.from_json(item["properties"], "description string", READ_ALL)["description"]).alias("description"),
                _text(columns).alias("columns"),
            )
        )
        return (
            _resources(mdl, name)
            .where(item["name"].isNotNull())
            .select(
                "project_id",
                item["name"].alias("name"),
                F.lit(name).alias("kind"),
                _ord(section, CHUNK, F.lit(0)).alias("ord"),
                content.alias("content"),
            )
        )

    names = F.array_join(F.transform(item["columns"], lambda c: c["name"]), ", ")
    rows = (
        described("models", 0, names)
        .unionByName(described("metrics", 1, F.lit("")))
        .unionByName(described("views", 2, F.lit("")))
    )
    return _documents(rows, TABLE_DESCRIPTION)
