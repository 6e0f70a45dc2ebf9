"""A blocked Bloom filter of fixed size, in DataFrame functions alone.

A key sets eight bits in one block of 256 bits, both chosen by its hash. The filter is a table of the blocks that are not
empty; it never has more than `BLOCKS` rows of 40 bytes, however many keys it holds, so it can be broadcast. More keys
make more false positives, which an exact join after it removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1 << 16


def _bits(key: str) -> list[Column]:
    """Four words of 64 bits, two bits each, from a hash of their own."""
    places = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}, 'bits'), {6 * j}) & 63 as int))") for j in range(8)]
    return [places[2 * j].bitwiseOR(places[2 * j + 1]).alias(f"bits{j}") for j in range(4)]


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")


def bloom_blocks(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter of a column's values that are not null."""
    marked = keys.filter(F.col(key).isNotNull()).select(_block(key, blocks), *_bits(key))
    return marked.groupBy("block").agg(*[F.bit_or(f"bits{j}").alias(f"set{j}") for j in range(4)])


def with_possible(rows: DataFrame, key: str, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The rows with `possible`: whether the filter may hold their key (false for null). No row is shuffled."""
    probed = rows.select("*", _block(key, blocks), *_bits(key)).join(F.broadcast(bloom), "block", "left")
    hit = F.col(key).isNotNull()
    for j in range(4):
        hit = hit & (F.col(f"bits{j}").bitwiseAND(F.col(f"set{j}")) == F.col(f"bits{j}"))
    return probed.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("possible"))
