"""Catalog tables, MDL documents, stores and questions derived from the whole driver tables.

Each order is a table whose columns are its line items, each customer of a priority is a table
that the orders refer to, suppliers are views and parts are metrics. The row templates are plain
SQL that Spark and the checking engine both run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsearch.checkpoints import checkpointed
from catalogsearch.options import Options
from catalogsearch.sources.catalog import Catalog
from catalogsearch.sources.mdl import validate_mdl

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

OPTIONS = Options(table_prefix="t_", column_batch_size=5, fk_mode="reference")

TYPE = """CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'varchar'
               WHEN l_returnflag = 'A' THEN 'uuid'
               WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'unknown'
               WHEN l_returnflag = 'N' THEN 'json'
               WHEN l_linestatus = 'F' THEN 'int64'
               ELSE 'text' END"""

# One row per line item: a column of the order's table.
LINES = f"""
    SELECT project_id, okey, model, ordinal, name, type, nullable, note, hidden, calculated, expression, relation,
           display, description,
           CASE WHEN type IN ('varchar', 'text') THEN 'P' || l_partkey END AS value_1,
           CASE WHEN type IN ('varchar', 'text') THEN 'S' || l_suppkey END AS value_2,
           CASE WHEN type = 'json' THEN 'n' || l_partkey END AS nested_part,
           CASE WHEN type = 'json' THEN CASE WHEN nullable THEN 'JSON' ELSE 'OTHER' END END AS json_type,
           CASE WHEN type = 'json' THEN 'note ' || l_suppkey END AS a_json_note
    FROM (
        SELECT o_orderpriority AS project_id, o_orderkey AS okey, 't_o' || o_orderkey AS model,
               l_linenumber AS ordinal,
               'c' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || CAST(l_quantity AS INT) || l_returnflag || l_linestatus AS name,
               {TYPE} AS type,
               l_quantity > 25 AS nullable,
               CASE WHEN l_discount > 0.05 THEN 'Part ' || l_partkey END AS note,
               l_discount > 0.08 AS hidden,
               l_tax > 0.06 AS calculated,
               'qty * ' || l_partkey AS expression,
               CASE WHEN l_quantity > 45 THEN 'to_supplier' END AS relation,
               CASE WHEN l_discount < 0.02 THEN l_linenumber || '. Part-(' || l_partkey || ')' END AS display,
               CASE WHEN l_tax < 0.03 THEN 'Part "' || l_partkey || '" of supplier''s ' || l_suppkey END AS description,
               l_partkey, l_suppkey
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
    ) numbered
"""

# One row per order: a table.
ORDERS = """
    SELECT o_orderpriority AS project_id, o_orderkey AS okey, o_custkey AS ckey, 't_o' || o_orderkey AS model,
           't_c' || o_custkey AS customer,
           CAST(floor(o_orderkey / 64) AS INT) AS part_no,
           o_orderstatus AS status,
           CASE WHEN o_orderstatus = 'P' THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
           CASE WHEN o_totalprice >= 50000 THEN 'Orders of customer ' || o_custkey END AS note,
           CASE WHEN o_orderstatus <> 'O' THEN 'custkey' END AS primary_key,
           'Order-' || o_orderkey || '.' AS display,
           CASE WHEN o_orderstatus = 'F' THEN 'customer''s order ' || o_orderkey
                ELSE 'order by ' || o_orderpriority END AS description,
           CASE WHEN o_orderstatus = 'F' THEN 'MANY_TO_ONE' WHEN o_orderstatus = 'O' THEN 'ONE_TO_ONE'
                ELSE 'MANY_TO_MANY' END AS join_type,
           '"t_o' || o_orderkey || '".custkey = "t_c' || o_custkey || '".c_custkey' AS relation
    FROM {orders}
"""

# One row per customer and priority: the table its orders refer to.
CUSTOMERS = """
    SELECT project_id, ckey, 't_c' || ckey AS model, CAST(floor(ckey / 64) AS INT) AS part_no, c_name, c_mktsegment
    FROM (SELECT DISTINCT o_orderpriority AS project_id, o_custkey AS ckey FROM {orders}) used
    JOIN {customer} ON ckey = c_custkey
"""

# One row per supplier: a view.
VIEWS = """
    SELECT r_name AS project_id, s_suppkey AS vkey, 't_s' || s_suppkey AS name,
           CAST(floor(s_suppkey / 64) AS INT) AS part_no,
           'SELECT * FROM supplier WHERE s_name = ''' || s_name || '''' || ' AND n = "' || n_name || '"' AS statement,
           'Supplier ''' || s_name || ''' in ' || n_name AS description
    FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

# One row per part: a metric.
METRICS = """
    SELECT p_type AS project_id, p_partkey AS pkey, 't_m' || p_partkey AS name,
           CAST(floor(p_partkey / 64) AS INT) AS part_no,
           p_name AS base_object, p_brand AS dimension,
           CASE WHEN p_size > 40 THEN 'unknown' ELSE 'bignumeric' END AS measure_type,
           'sum(p_retailprice * ' || p_size || ')' AS expression
    FROM {part}
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rows(spark: SparkSession, sf: str, template: str) -> DataFrame:
    used = {name: table(spark, sf, name) for name in TABLES if f"{{{name}}}" in template}
    return spark.sql(template, **used)


#: What the templates use of orders and line items.
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_discount l_tax l_returnflag l_linestatus".split()
JOIN = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"


def by_range(spark: SparkSession, template: str, key: str, frame: DataFrame) -> DataFrame:
    """Rows of a template over one frame, in the task of the key range that is their part, as `part_no`.

    The range is a column of its own from the shuffle on, so that Spark knows by what the rows are placed.
    """
    placed = frame.withColumn("part", F.expr(f"CAST(floor({key} / 64) AS INT)")).repartition("part")
    found = spark.sql(template.replace("SELECT ", "SELECT part, "), frame=placed)
    return found.drop("part_no").withColumnRenamed("part", "part_no")


def placed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """ORDERS by key range."""
    return by_range(spark, ORDERS.replace("{orders}", "{frame}"), "o_orderkey", table(spark, sf, "orders").select(*ORDER_COLUMNS))


def placed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """LINES by key range before they meet their orders: also those that have none, and without a project."""
    given = table(spark, sf, "lineitem").select(*LINE_COLUMNS)
    alone = given.withColumns({"o_orderkey": F.col("l_orderkey"), "o_orderpriority": F.lit(None).cast("string")})
    return by_range(spark, LINES.replace(JOIN, "{frame}"), "l_orderkey", alone)


def written_lines(spark: SparkSession, sf: str) -> DataFrame:
    """What catalog and values have of the line items, joined with their orders once."""
    used = ["project_id", "model", "ordinal", "name", "type", "nullable", "note", "value_1", "value_2"]
    return checkpointed(rows(spark, sf, LINES).select(*used))


def catalog(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> Catalog:
    """Catalog tables of the orders, their customers and the suppliers' views.

    With the `written_lines`, for jobs that read the catalog several times, the customers are written too.
    """
    orders, customers, views = rows(spark, sf, ORDERS), rows(spark, sf, CUSTOMERS), rows(spark, sf, VIEWS)
    if lines is None:
        lines = rows(spark, sf, LINES)
    else:
        customers = checkpointed(customers)
    public = F.lit("public").alias("table_schema")
    no_text = F.lit(None).cast("string")

    tables = orders.select("project_id", public, F.col("model").alias("table_name"), "table_type", F.col("note").alias("comment"))
    tables = tables.unionByName(
        customers.select(
            "project_id",
            public,
            F.col("model").alias("table_name"),
            F.lit("BASE TABLE").alias("table_type"),
            F.col("c_name").alias("comment"),
        )
    )
    columns = lines.select(
        "project_id",
        public,
        F.col("model").alias("table_name"),
        F.col("name").alias("column_name"),
        F.col("ordinal").alias("ordinal_position"),
        F.col("type").alias("data_type"),
        F.when(F.col("nullable"), "YES").otherwise("NO").alias("is_nullable"),
        F.col("note").alias("comment"),
    )
    own = F.explode(
        F.array(
            F.struct(F.lit("c_custkey").alias("column_name"), F.lit(1).alias("ordinal_position"), F.lit("int64").alias("data_type"), F.lit("NO").alias("is_nullable")),
            F.struct(F.lit("c_name").alias("column_name"), F.lit(2).alias("ordinal_position"), F.lit("varchar").alias("data_type"), F.lit("YES").alias("is_nullable")),
            F.struct(F.lit("c_mktsegment").alias("column_name"), F.lit(3).alias("ordinal_position"), F.lit("text").alias("data_type"), F.lit("YES").alias("is_nullable")),
        )
    )
    columns = columns.unionByName(
        customers.select("project_id", public, F.col("model").alias("table_name"), own.alias("c")).select(
            "project_id", "table_schema", "table_name", "c.*", no_text.alias("comment")
        )
    )

    def constraint(frame: DataFrame, name, kind: str) -> DataFrame:
        return frame.select(
            "project_id", public, F.col("model").alias("table_name"), name.alias("constraint_name"), F.lit(kind).alias("constraint_type")
        )

    def key(frame: DataFrame, name, column, position) -> DataFrame:
        return frame.select(
            "project_id",
            public,
            F.col("model").alias("table_name"),
            name.alias("constraint_name"),
            column.alias("column_name"),
            position.alias("ordinal_position"),
        )

    pk, one = F.lit("pk"), F.lit(1)
    fk = F.concat(F.lit("fk_"), F.col("okey"))
    constraints = (
        constraint(orders, pk, "PRIMARY KEY")
        .unionByName(constraint(customers, pk, "PRIMARY KEY"))
        .unionByName(constraint(orders, fk, "FOREIGN KEY"))
    )
    usage = (
        key(lines, pk, F.col("name"), F.col("ordinal"))
        .unionByName(key(customers, pk, F.lit("c_custkey"), one))
        .unionByName(key(orders, fk, F.lit("custkey"), one))
    )
    referenced = orders.select(
        "project_id",
        public,
        F.col("customer").alias("table_name"),
        fk.alias("constraint_name"),
        F.lit("c_custkey").alias("column_name"),
    )
    listed = views.select(
        "project_id", public, F.col("name").alias("table_name"), F.col("statement").alias("view_definition")
    )
    return Catalog(tables, columns, constraints, usage, referenced, listed)


def column_values(lines: DataFrame) -> DataFrame:
    """Distinct values of the text columns of the order tables."""
    key = ["project_id", "table_name", "column_name"]
    given = lines.select("project_id", F.col("model").alias("table_name"), F.col("name").alias("column_name"), F.array_compact(F.array("value_1", "value_2")).alias("given"))
    # Values go to the task of their column before they are rows of their own, each with the names.
    return given.where(F.size("given") > 0).repartition(*key).select(*key, F.explode("given").alias("value")).distinct()


def mdl_texts(spark: SparkSession, sf: str) -> DataFrame:
    """MDL documents `(project_id, mdl)`: orders and customers by priority, views by region, metrics by part type.

    A document holds the 64 orders, customers, suppliers or parts of one key range.
    """
    # All rows go to the task of their key range while they are short; every later step is within the range.
    orders, lines = placed_orders(spark, sf), placed_lines(spark, sf)
    customers, views, metrics = (rows(spark, sf, x).repartition("part_no") for x in (CUSTOMERS, VIEWS, METRICS))
    line = F.struct(
        "ordinal",
        "name",
        F.struct(
            "name",
            "type",
            F.col("calculated").alias("isCalculated"),
            (~F.col("nullable")).alias("notNull"),
            F.col("hidden").alias("isHidden"),
            "expression",
            F.col("relation").alias("relationship"),
            F.struct(
                F.col("display").alias("displayName"),
                "description",
                F.when(F.col("value_1").isNotNull(), F.array("value_1", "value_2")).alias("uniqueValues"),
                "nested_part",
                "json_type",
                "a_json_note",
            ).alias("properties"),
        ).alias("column"),
    )
    order_key, order = ["part_no", "okey"], [c for c in orders.columns if c not in ("part_no", "okey")]
    both = orders.select(*order_key, F.struct(*order).alias("order")).unionByName(
        lines.where("okey IS NOT NULL").select(*order_key, line.alias("line")), allowMissingColumns=True
    )
    listed = both.groupBy(*order_key).agg(
        F.collect_list("order").alias("orders"), F.sort_array(F.collect_list("line")).alias("lines")
    )
    # A line counts once for each order of its key.
    repeated = F.flatten(F.transform("lines", lambda x: F.array_repeat(x["column"], F.size("orders"))))
    texts = F.transform(F.when(F.size("orders") > 1, repeated).otherwise(F.col("lines")["column"]), lambda x: F.to_json(x))
    written_orders = listed.withColumn("texts", texts).select(*order_key, "texts", F.inline("orders"))
    first = F.struct(F.lit("custkey").alias("name"), F.lit("int64").alias("type"))
    order_head = F.to_json(
        F.struct(
            F.col("model").alias("name"),
            F.col("primary_key").alias("primaryKey"),
            F.struct(F.col("display").alias("displayName"), "description").alias("properties"),
        )
    )
    order_columns = F.concat_ws(",", F.to_json(first), "texts")
    customer_columns = F.array(
        F.struct(F.lit("c_custkey").alias("name"), F.lit("int64").alias("type"), F.lit(None).cast("struct<description:string,uniqueValues:array<string>>").alias("properties")),
        F.struct(
            F.lit("c_name").alias("name"),
            F.lit("text").alias("type"),
            F.struct(F.col("c_mktsegment").alias("description"), F.array("c_name").alias("uniqueValues")).alias("properties"),
        ),
        F.struct(F.lit("c_acctbal").alias("name"), F.lit("float64").alias("type"), F.lit(None).cast("struct<description:string,uniqueValues:array<string>>").alias("properties")),
    )
    customer_models = customers.select(
        "project_id",
        "part_no",
        F.lit(1).alias("kind"),
        F.col("ckey").alias("key"),
        F.to_json(F.struct(F.col("model").alias("name"), F.lit("c_custkey").alias("primaryKey"))).alias("head"),
        F.array_join(F.transform(customer_columns, lambda c: F.to_json(c)), ",").alias("columns"),
    )

    def model(head: Column, columns: Column) -> Column:
        # The text of the columns goes in before the closing brace of the head.
        return F.concat(head.substr(F.lit(1), F.length(head) - 1), F.lit(',"columns":['), columns, F.lit("]}"))

    customer_models = customer_models.select(
        "project_id", "part_no", F.lit("models").alias("list"), "kind", "key", model(F.col("head"), F.col("columns")).alias("item")
    )
    relation = F.to_json(
        F.struct(
            F.concat(F.lit("r"), F.col("okey")).alias("name"),
            F.array("model", "customer").alias("models"),
            F.col("join_type").alias("joinType"),
            F.col("relation").alias("condition"),
        )
    )
    own_items = F.array(
        F.struct(F.lit("models").alias("list"), model(order_head, order_columns).alias("item")),
        F.struct(F.lit("relationships").alias("list"), relation.alias("item")),
    )
    order_items = written_orders.select("project_id", "part_no", F.lit(0).alias("kind"), F.col("okey").alias("key"), F.inline(own_items))
    views = views.select(
        "project_id",
        "part_no",
        F.lit("views").alias("list"),
        F.lit(0).alias("kind"),
        F.col("vkey").alias("key"),
        F.to_json(F.struct("name", "statement", F.struct("description").alias("properties"))).alias("item"),
    )
    metrics = metrics.select(
        "project_id",
        "part_no",
        F.lit("metrics").alias("list"),
        F.lit(0).alias("kind"),
        F.col("pkey").alias("key"),
        F.to_json(
            F.struct(
                "name",
                F.col("base_object").alias("baseObject"),
                F.array(F.struct(F.col("dimension").alias("name"), F.lit("text").alias("type"))).alias("dimension"),
                F.array(
                    F.struct(F.lit("price").alias("name"), F.col("measure_type").alias("type"), "expression")
                ).alias("measure"),
            )
        ).alias("item"),
    )

    def own(name: str):
        return F.sort_array(F.collect_list(F.when(F.col("list") == name, F.struct("kind", "key", "item")))).alias(name)

    def member(name: str):
        return F.concat(F.lit(f'"{name}":['), F.array_join(F.col(name)["item"], ","), F.lit("]")).alias(name)

    names = ["models", "relationships", "views", "metrics"]
    parts = (
        order_items.unionByName(customer_models)
        .unionByName(views)
        .unionByName(metrics)
        .groupBy("project_id", "part_no")
        .agg(*[own(name) for name in names])
        .select("project_id", "part_no", *[member(name) for name in names])
    )
    text = F.concat(F.lit('{"part":'), F.col("part_no"), F.lit(","), F.concat_ws(",", *names), F.lit("}"))
    return parts.select("project_id", text.alias("mdl"))


def mdl(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, parsed once for all that reads them, as an index run does."""
    return checkpointed(validate_mdl(mdl_texts(spark, sf))[0])


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The texts as stored documents: one project per language."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("project_id"),
        F.lit("TEXT").alias("type"),
        F.concat(F.lit("doc_"), F.col("doc_id")).alias("name"),
        F.col("text").alias("content"),
        F.create_map(F.lit("source"), "source", F.lit("n_chars"), F.col("n_chars").cast("string")).alias("meta"),
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors as stored documents: one project per label."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("project_id"), "embedding"
    )


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    """One question per label: the mean of its vectors, and their number."""
    mean = (
        table(spark, sf, "embeddings")
        .select("label", F.posexplode("embedding").alias("at", "x"))
        .groupBy("label", "at")
        .agg(F.round(F.avg(F.col("x").cast("double")), 6).cast("float").alias("x"), F.count("*").alias("n"))
    )
    return mean.groupBy(F.col("label").cast("string").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda e: e["x"]).alias("embedding"),
        F.max("n").alias("n"),
    )


def questions_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """One question per order, for its own table and that of its customer."""
    return rows(spark, sf, ORDERS).select(
        F.col("okey").cast("string").alias("query_id"),
        "project_id",
        F.lit("").alias("query"),
        F.array("model", "customer").alias("tables"),
        (F.col("status") != "O").alias("enable_column_pruning"),
        "status",
    )


REPLY_F = (
    "'{\"results\":[{\"table_name\":\"' || model || '\",\"table_contents\":{\"columns\":[]}},"
    "{\"table_name\":\"' || customer || '\",\"table_contents\":{\"columns\":[\"c_name\"]}},"
    "{\"table_name\":\"' || model || '\",\"table_contents\":{\"columns\":[\"custkey\"]}}]}'"
)
REPLY_O = "'{\"results\":[{\"table_name\":\"' || customer || '\",\"table_contents\":{\"columns\":[]}}]}'"


def replies(spark: SparkSession, sf: str) -> DataFrame:
    """One reply per question; those for status P are cut short."""
    text = f"CASE WHEN status = 'F' THEN {REPLY_F} WHEN status = 'O' THEN {REPLY_O} ELSE '{{\"results\":[' END"
    return rows(spark, sf, ORDERS).select(
        F.col("okey").cast("string").alias("query_id"), F.expr(text).alias("reply")
    )


def conversations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Questions and histories: the last user turn of a conversation asks, the earlier ones precede it."""
    turns = table(spark, sf, "conversations").where("role = 'user'")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    asked = turns.join(last, "conv_id").withColumn("query_id", F.col("conv_id").cast("string"))
    queries = asked.where("turn = last").select("query_id", F.col("text").alias("query"))
    histories = asked.where("turn < last").select("query_id", F.col("turn").cast("int").alias("turn"), F.col("text").alias("question"))
    return queries, histories
