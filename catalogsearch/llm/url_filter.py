"""Operator 9: URL filter by rules, a blocked Bloom filter and an exact hash join, in DataFrame functions alone.

The canonical form of a URL is its host without a leading `www.` and its path without a last `/` or `.html`; scheme, query
and fragment are left out. The blocked Bloom filter of the listed canonical URLs (`bloom.py`) has a bounded size and is
broadcast; pages that it may hold are possible hits and go to an exact join with the list, which removes false positives.
A longer list makes more possible hits, never a wrong verdict. Pages without a hit are never shuffled.

Rules decide first: the longest that fits, else whether the canonical URL is listed.

Defined results: a null URL, or one without `://`, has an empty host and path, fits no rule and is not listed; rows are
independent, so repeats and ties need no rule; an empty list lists nothing; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import BLOCKS, bloom_blocks, with_possible

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits a host, its subdomains, and paths that start with the rule's."""

    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    rest = F.coalesce(F.substr(url, F.length(after) + 4), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Null for an empty host."""
    short = F.regexp_replace(path, r"(/|\.html)$", "")
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""), short))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], blocks: int = BLOCKS) -> DataFrame:
    """`page_id, host, path, rule, verdict, listed` of every page, for `pages(page_id, url)` and `listed(canonical)`."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("canonical", canonical(F.col("host"), F.col("path")))
    probed = with_possible(parsed, "canonical", bloom_blocks(listed, "canonical", blocks), blocks)
    columns = ["page_id", "host", "path", "canonical"]
    distinct = listed.filter("canonical IS NOT NULL").select("canonical").distinct().withColumn("found", F.lit(True))
    hits = probed.filter("possible").select(*columns).join(distinct, "canonical", "left").select(*columns, F.coalesce("found", F.lit(False)).alias("listed"))
    misses = probed.filter("NOT possible").select(*columns, F.lit(False).alias("listed"))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("listed"), "block").otherwise("allow")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):  # the longest comes last and is asked first
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return hits.unionByName(misses).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed")
