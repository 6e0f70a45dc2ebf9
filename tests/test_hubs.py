"""Joins and numbering of hot keys."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from catalogsearch.checkpoints import checkpointed
from catalogsearch.operators import documents
from catalogsearch.operators.hubs import hot_keys, hub_join
from catalogsearch.options import Options
from catalogsearch.schemas import MDL_COLUMN, MDL_METRIC, MDL_MODEL, MDL_RELATIONSHIP, MDL_VIEW, empty_list

RELATIONS, OTHERS, PART = 1_000_000, 2_000, 5_000


@pytest.fixture(scope="module")
def hub_mdl(spark):
    """A project in which a million relations lead from one model to `OTHERS` others, five thousand a row."""
    other = F.concat(F.lit("m"), F.col("id") % OTHERS)
    relation = F.struct(
        F.concat(F.lit("r"), "id").alias("name"),
        F.array(F.lit("hub"), other).alias("models"),
        F.lit("MANY_TO_ONE").alias("joinType"),
        F.concat(F.lit("hub.a"), "id", F.lit(" = "), other, F.lit(".id")).alias("condition"),
    ).cast(MDL_RELATIONSHIP)
    part = F.floor(F.col("id") / PART).cast("int")
    relations = spark.range(RELATIONS).groupBy(part.alias("part_no")).agg(F.array_sort(F.collect_list(relation)).alias("relationships"))
    column = F.array(F.struct(F.lit("id").alias("name"), F.lit("int64").alias("type"), *[F.lit(None).alias(c) for c in "abcdef"]).cast(MDL_COLUMN))

    def model(name):
        return F.struct(name.alias("name"), F.lit(None).alias("r"), column.alias("columns"), F.lit("id").alias("k"), F.lit(None).alias("p")).cast(MDL_MODEL)

    named = spark.range(OTHERS).select(F.concat(F.lit("m"), "id").alias("n")).unionByName(spark.createDataFrame([("hub",)], "n string"))
    models = named.agg(F.array_sort(F.collect_list(model(F.col("n")))).alias("models"))
    rows = relations.join(models.withColumn("part_no", F.lit(0)), "part_no", "left")
    return checkpointed(
        rows.select(
            F.lit("p").alias("project_id"), "part_no", F.coalesce("models", empty_list(MDL_MODEL)).alias("models"), "relationships",
            empty_list(MDL_VIEW).alias("views"), empty_list(MDL_METRIC).alias("metrics"),
        )
    )


@pytest.fixture
def own_partitions(spark):
    """Six partitions, and no lookup so small that it would be shipped whole."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_by_task(frame):
    """Rows of each task of the last stage."""
    return [r["count"] for r in frame.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def test_a_hub_is_dealt_to_all_tasks(spark, hub_mdl, own_partitions):
    models = documents.column_commands(documents.preprocess_models(hub_mdl))
    for mode in ("source_only", "reference"):
        options = Options(fk_mode=mode)
        ends = documents.relation_ends(hub_mdl, options)
        hubs = documents.hub_models(ends, options)
        assert {r["_pieces"] for r in hubs.collect()} == {100 if mode == "source_only" else 200}
        for joined in (documents.with_owners(ends, models, hubs), documents.with_key_command(ends, models, hubs)):
            n = rows_by_task(joined)
            assert sum(n) == RELATIONS * (2 if mode == "reference" else 1)
            assert max(n) <= 2 * median(n) and len(n) == 6


def test_relations_of_a_hub_are_numbered_once(spark, hub_mdl):
    models = documents.column_commands(documents.preprocess_models(hub_mdl))
    split = documents.numbered_keys(hub_mdl, models, Options(fk_mode="reference"))
    whole = documents.numbered_keys(hub_mdl, models, Options(fk_mode="reference", hub_rows=10**9))
    figures = [F.count("*"), F.countDistinct("rn"), F.min("rn"), F.max("rn"), F.sum(F.xxhash64("rel_pos", "rn", "command").cast("decimal(38,0)"))]
    by_model = {r["name"]: tuple(r)[1:] for r in split.groupBy("name").agg(*figures).collect()}
    assert by_model == {r["name"]: tuple(r)[1:] for r in whole.groupBy("name").agg(*figures).collect()}
    assert by_model["hub"][:4] == (RELATIONS, RELATIONS, 0, RELATIONS - 1) and len(by_model) == OTHERS + 1


def test_hub_join_equals_join(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 < 6, "hot").when(F.col("id") % 10 < 9, F.concat(F.lit("k"), F.col("id") % 50)).alias("key"), F.col("id").alias("n"))
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k6", 3), (None, 4)], "key string, value int")
    hot = hot_keys(rows, ["key"], 1_000, 5)
    assert sorted(r["_pieces"] for r in hot.collect()) == [2, 12]  # null is a key as well, though it joins nothing
    for how in ("inner", "left"):
        want, got = rows.join(lookup, "key", how), hub_join(rows, lookup, ["key"], "n", hot, how)
        assert want.columns == got.columns and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
    assert len(hot_keys(rows, ["key"], 10, 1).collect()) == 1 and hot_keys(rows, ["key"], 20_000, 5) is None
