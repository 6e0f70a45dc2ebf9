"""Operator 8: quality rules with cross-document line frequency, in DataFrame functions alone.

Base rules judge a text by itself: at least `MIN_WORDS` words, and at most half of them in repeated three-word windows.
The method then hashes every line, normalised to lower case and single spaces, and counts the distinct texts of a host
(`source`) that hold it: copies count once. A line is boilerplate if these are more than `MIN_DOCUMENTS` and more than
`HOST_SHARE` of the host's distinct texts, and if they are different documents: near copies of one text share most of their
lines too. So one line stands for each document, drawn by a hash with chances as the lines are long, which near copies mostly
have in common; in one of `DRAWS` draws, there must be at least `DIFFERENT` times as many such lines as texts. Where the line stands in a document and what stands around it does not matter. Boilerplate is
removed, and a document that loses more than `DEPLETED` of its characters is rejected: `kept_documents` gives the texts that
remain, and `quality_rules` the figures and verdicts.

Only lines over `MIN_DOCUMENTS` are looked at beyond the first count, which is a partial aggregation. Hot lines are single
rows on one side of the joins, so adaptive execution can split the other.

Defined results: a null text has no words and fails; null and empty hosts are one host; rows that agree in doc_id, text
and host are one document and each gets its verdict; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

MIN_WORDS = 50
REPEATED_PERCENT = 50
MIN_DOCUMENTS = 20
HOST_SHARE = 0.005
DIFFERENT = 0.5
DRAWS = 3
DEPLETED = 0.75

#: White space between words, and symbols.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows found twice or more: windows sorted by hash, then those that equal a neighbour."""
    windows = F.transform(words, lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.sort_array(F.slice(windows, 1, F.greatest(F.size(words) - 2, F.lit(0))))


def text_rules(documents: DataFrame) -> DataFrame:
    """`documents` with the base columns, `n_words` to `base_failed`; texts must not be null."""
    trimmed = documents.withColumn("trimmed", F.btrim("text", F.lit(SPACE)))
    split = trimmed.withColumn("words", F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", SPACES)))
    sorted_windows = split.withColumn("windows", _repeat_words(F.col("words")))

    def same(x: Column, other: Column) -> Column:
        return F.coalesce(x["h"] == other["h"], F.lit(False))

    windows = F.col("windows")
    found = F.filter(windows, lambda x, i: same(x, F.get(windows, i - 1)) | same(x, F.get(windows, i + 1)))
    places = sorted_windows.withColumn("places", F.sort_array(F.transform(found, lambda x: x["i"]))).drop("windows")
    steps = F.zip_with(F.col("places"), F.slice("places", 2, F.greatest(F.size("places") - 1, F.lit(0))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    counted = places.select(
        *documents.columns,
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x).alias("n_repeat_words"),
    )
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    return counted.select(
        *documents.columns, n, "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), repeated,
        ((n < MIN_WORDS) | (100 * repeated > REPEATED_PERCENT * n)).alias("base_failed"),
    )


def _lines(documents: DataFrame) -> DataFrame:
    """A row for each line with a word: its hash, its place, its length, whether it is the document's first such line, the
    lines drawn for the document, and the length of all lines."""
    normal = F.transform(F.split("text", "\n"), lambda line: F.regexp_replace(F.btrim(F.lower(line), F.lit(SPACE)), SPACES, " "))
    kept = documents.withColumn("lines", F.filter(normal, lambda line: line != ""))
    def drawn(draw: int) -> Column:
        """The line with the smallest lot; a line's lot is the smaller the longer it is."""

        def lot(line: Column) -> Column:
            number = F.conv(F.substring(line["md5"], 8 * draw + 1, 8), 16, 10).cast("bigint")
            return F.struct((number / line["size"]).alias("lot"), line["hash"].alias("line"))

        return F.array_min(F.transform("hashed", lot))["line"]

    hashed = F.transform("lines", lambda line: F.struct(F.md5(line).alias("md5"), F.xxhash64(line).alias("hash"), F.length(line).alias("size")))
    kept = kept.withColumn("hashed", hashed)
    placed = F.transform("hashed", lambda x, i: F.struct(x["hash"].alias("line"), i.alias("place"), x["size"].alias("size")))
    sample = F.array(*[drawn(draw) for draw in range(DRAWS)])
    ordered = kept.select("doc_id", "text_hash", "host", sample.alias("sample"), F.sort_array(placed).alias("found"))
    found = F.col("found")
    total = F.aggregate(found, F.lit(0).cast("bigint"), lambda t, x: t + x["size"])
    numbered = ordered.select(
        "doc_id", "text_hash", "host", "sample", total.alias("total"),
        F.transform(found, lambda x, i: F.struct(x.alias("x"), (~F.coalesce(x["line"] == F.get(found, i - 1)["line"], F.lit(False))).alias("first"))).alias("found"),
    )
    # An inner explode adds a filter on the array's size, which is pushed down and computes the array anew for each line.
    rows = numbered.select("doc_id", "text_hash", "host", "sample", "total", F.explode_outer("found").alias("f")).filter("f IS NOT NULL")
    return rows.select("doc_id", "text_hash", "host", "sample", "total", "f.x.*", "f.first")


def frequent_lines(documents: DataFrame) -> DataFrame:
    """`host, line` of boilerplate, for documents with `doc_id, text_hash, host, text`."""
    lines = _lines(documents).filter("first")
    key = ["host", "line"]
    often = lines.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > MIN_DOCUMENTS).select(*key)
    texts = lines.join(often, key).groupBy(*key, "text_hash").agg(F.first("sample").alias("sample"))
    drawn = [F.countDistinct(F.col("sample")[draw]) for draw in range(DRAWS)]
    spread = texts.groupBy(*key).agg(F.count("*").alias("n"), F.greatest(*drawn).alias("different"))
    spread = spread.filter((F.col("n") > MIN_DOCUMENTS) & (F.col("different") >= DIFFERENT * F.col("n")))
    hosts = documents.groupBy("host").agg(F.countDistinct("text_hash").alias("texts"))
    return spread.join(hosts, "host").filter(F.col("n") > HOST_SHARE * F.col("texts")).select(*key)


def _cleaned(rows: DataFrame, text: str) -> DataFrame:
    """The rows, with column `text` without the lines of `places`, which are numbered as in `_lines`."""
    split = rows.withColumn("lines", F.when(F.col("places").isNotNull(), F.split(text, "\n")))
    worded = F.filter(F.transform("lines", lambda line, i: F.when(F.btrim(line, F.lit(SPACE)) != "", i)), lambda i: i.isNotNull())
    # `lines` and `worded` are named twice where they are used, or else the optimizer would compute them anew for each element.
    gone = F.transform("places", lambda p: F.when(p < F.size("worded"), F.get("worded", p)))
    stay = split.withColumn("worded", worded).withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone))
    joined = F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
    return stay.withColumn(text, F.when(F.col("lines").isNull(), F.col(text)).otherwise(joined))


def _judged(documents: DataFrame) -> DataFrame:
    """`quality_rules`, and in `places` the removed lines, numbered among the lines with a word."""
    keyed = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host")
    ).withColumn("text_hash", F.xxhash64("text"))
    lines = _lines(keyed)
    removed = lines.join(frequent_lines(keyed), ["host", "line"])
    each = removed.groupBy("doc_id", "text_hash", "host", "place").agg(F.max("size").alias("size"), F.max("total").alias("total"))
    lost = each.groupBy("doc_id", "text_hash", "host").agg(F.sum("size").alias("removed_chars"), F.max("total").alias("total"), F.collect_list("place").alias("places"))
    lost = lost.select(F.col("doc_id").alias("lost_id"), F.col("text_hash").alias("lost_hash"), F.col("host").alias("lost_host"), "removed_chars", "total", "places")
    # Written, as a filter on a rule would else be pushed into the array functions and compute them for each element.
    rules = written(text_rules(keyed).drop("text"), "rules")
    same = rules["doc_id"].eqNullSafe(lost["lost_id"]) & (rules["text_hash"] == lost["lost_hash"]) & (rules["host"] == lost["lost_host"])
    depleted = F.coalesce(F.col("removed_chars") > DEPLETED * F.col("total"), F.lit(False))
    return rules.join(lost, same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"), F.coalesce("removed_chars", F.lit(0)).cast("bigint").alias("removed_chars"), "text_hash", "host", "places",
    )


def quality_rules(documents: DataFrame) -> DataFrame:
    """One row for each of `documents(doc_id, text, source)`: the base columns, `removed_chars` and `kept`."""
    return _judged(documents).drop("places")


def kept_documents(documents: DataFrame) -> DataFrame:
    """The rows of `documents(doc_id, text, source, ...)` that the rules keep, their text without the boilerplate lines."""
    names = [f"c{i}" for i in range(len(documents.columns))]  # whatever the columns are called
    number = {c: names[i] for i, c in enumerate(documents.columns)}
    text = number["text"]
    own = [F.col(number["doc_id"]).cast("bigint"), F.xxhash64(F.coalesce(text, F.lit(""))), F.coalesce(F.col(number["source"]).cast("string"), F.lit(""))]
    rows = documents.toDF(*names).select(*names, *[c.alias(n) for c, n in zip(own, ("own_id", "own_hash", "own_host"), strict=True)])
    judged = _judged(documents).filter("kept").select("doc_id", "text_hash", "host", "places").dropDuplicates(["doc_id", "text_hash", "host"])
    same = rows["own_id"].eqNullSafe(judged["doc_id"]) & (rows["own_hash"] == judged["text_hash"]) & (rows["own_host"] == judged["host"])
    return _cleaned(rows.join(judged, same), text).select(*names).toDF(*documents.columns)
