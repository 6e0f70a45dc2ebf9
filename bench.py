"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the local threads. Each query runs twice, reads its
tables in full and hands every row to a sink that drops them; the second run is reported, the
first is listed under `cold`.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from catalogsearch.operators.search import nearest_documents  # noqa: E402
from catalogsearch.options import Options  # noqa: E402
from catalogsearch.sources.profile import fetch_unique_values  # noqa: E402
from workload import bindings as b  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def nearest_100(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.vectors(spark, sf)
    queries = docs.where("id < 100").select(
        F.col("id").alias("query_id"), F.lit(None).cast("string").alias("project_id"), "embedding"
    )
    return nearest_documents(queries, docs, 10, Options())


def unique_values_of(name: str):
    return lambda spark, sf: fetch_unique_values(spark, {name: b.table(spark, sf, name)}, "tables")


CASES = {
    "nearest_100": nearest_100,
    "unique_values_documents": unique_values_of("documents"),
    "unique_values_part": unique_values_of("part"),
    "unique_values_lineitem": unique_values_of("lineitem"),
    **{
        name: QUERIES[name]
        for name in (
            "c6_relationships",
            "c8_unique_values",
            "c9_build_mdl",
            "m3_clean_display_names",
            "m13_schema_documents",
            "m14_table_descriptions",
            "e2_embed_documents",
            "d2_filter_documents",
            "d3_upsert",
            "d8_vector_topk",
            "d8_vector_topk_in_blocks",
            "r11_token_estimates",
            "r15_results",
        )
    },
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or list(CASES)
    warm, cold = {}, {}
    for name in chosen:
        for times in (cold, warm):
            start = time.perf_counter()
            CASES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {cold[name]} {warm[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total warm time of headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
