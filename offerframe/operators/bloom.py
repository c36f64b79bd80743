"""A Bloom filter over keys, as a table.

Keys are hashed to blocks of eight 64-bit words, and each sets one bit in every
word.  Building it is one aggregate, `bit_or` per block, partial in every task;
probing it is a join on the block number and eight bit tests, all in Spark's own
expressions.  The table has `bits_per_key` bits a key, up to `max_blocks` blocks
(about 100 MB), so it can be sent to every task; more keys than fit there only
let more other rows pass.  Rows that pass are a superset of those with a key, so an
exact join follows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8


@dataclass(frozen=True)
class Params:
    bits_per_key: int = 12
    max_blocks: int = 1 << 20


def blocks_for(keys: int, p: Params = Params()) -> int:
    return max(1, min(p.max_blocks, -(-keys * p.bits_per_key // (64 * WORDS))))


def _block(cols: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(blocks)).cast("int")


def _bit(cols: list[str], word: int) -> Column:
    """Bit number of a key in a word: six bits of a second hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols, F.lit(word // 4)), 6 * (word % 4) + 8).bitwiseAND(F.lit(63)).cast("int")


def build(keys: DataFrame, cols: list[str], blocks: int) -> DataFrame:
    """(block, w0 ... w7) over the keys."""
    bits = [F.expr(f"shiftleft(1L, b{w})").alias(f"w{w}") for w in range(WORDS)]
    one = keys.select(_block(cols, blocks).alias("block"), *[_bit(cols, w).alias(f"b{w}") for w in range(WORDS)]).select("block", *bits)
    return one.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)])


def _marked(rows: DataFrame, cols: list[str], table: DataFrame, blocks: int, how: str) -> tuple[DataFrame, Column]:
    """`rows` with the words of their block, and whether all bits of their key are set in them."""
    sent = F.broadcast(table.select(F.col("block").alias("_block"), *[F.col(f"w{w}").alias(f"_w{w}") for w in range(WORDS)]))
    hit = F.lit(True)
    for w in range(WORDS):
        hit = hit & (F.getbit(F.col(f"_w{w}"), _bit(cols, w)) == 1)
    return rows.withColumn("_block", _block(cols, blocks)).join(sent, "_block", how), hit


def probe(rows: DataFrame, cols: list[str], table: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be in the filter; all that are in it are among them."""
    marked, hit = _marked(rows, cols, table, blocks, "inner")
    return marked.where(hit).select(*rows.columns)


def split(rows: DataFrame, cols: list[str], table: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """The rows of `probe`, and all others, whose key is certainly not in the filter."""
    marked, hit = _marked(rows, cols, table, blocks, "left")
    return probe(rows, cols, table, blocks), marked.where(~F.coalesce(hit, F.lit(False))).select(*rows.columns)


def flagged(rows: DataFrame, cols: list[str], table: DataFrame, blocks: int, name: str) -> DataFrame:
    """All rows, with a column `name`: whether their key may be in the filter (a NULL key is not)."""
    marked, hit = _marked(rows, cols, table, blocks, "left")
    return marked.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias(name))


def without(rows: DataFrame, gone: DataFrame, cols: list[str]) -> DataFrame:
    """The rows whose key `cols` is not in `gone`, a table of distinct keys that is cheap to read twice (NULL equals
    NULL in both).  Only rows that the filter lets pass are shuffled."""
    blocks = blocks_for(gone.count())
    asked, rest = split(rows, cols, build(gone, cols, blocks), blocks)
    same = F.lit(True)
    for c in cols:
        same = same & asked[c].eqNullSafe(gone[c])
    return rest.unionByName(asked.join(gone, same, "left_anti"))
