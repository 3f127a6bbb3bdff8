"""Bloom filter as a table: built by an aggregate, probed by Columns.

The bits are dealt over blocks (a *blocked* filter): a key's 64-bit hash names its
block and ``PROBES`` bits in it, so the filter is a table (block, words) with one
small array per block. It is built by one aggregate with map-side combine, needs
``BITS_PER_KEY`` bits per key whatever the keys' length, and is probed through an
equi-join on the block, which may be broadcast where the keys themselves are
too many or too long to be. No key is missed; a few others pass (about 1 in 50).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordform.operators.joins import bounded_broadcast
from wordform.session import cut_lineage

#: Bits of a block, 64 to a word; bits per key; bits set per key.
BLOCK_BITS, BITS_PER_KEY, PROBES = 512, 12, 4
_WORDS = BLOCK_BITS // 64
_BIT = 9  # bits that name one of BLOCK_BITS


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def _bits(key: Column) -> list[Column]:
    """Positions of a key's bits in its block, from a second hash."""
    h = F.xxhash64(F.lit(1), key)
    return [F.shiftrightunsigned(h, _BIT * i).bitwiseAND(F.lit(BLOCK_BITS - 1).cast("long")) for i in range(PROBES)]


def _mask(key: Column, word: int) -> Column:
    """The bits of one word of the block that a key sets."""
    out = F.lit(0).cast("long")
    for at in _bits(key):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        out = out.bitwiseOR(F.when(F.shiftright(at, 6) == word, bit).otherwise(F.lit(0).cast("long")))
    return out


class BloomFilter:
    """``table``: block and its words w0, w1, ...; ``blocks``: how many there may be."""

    def __init__(self, table: DataFrame, blocks: int):
        self.table, self.blocks = table, blocks

    @classmethod
    def of(cls, keys: DataFrame, n_keys: int) -> BloomFilter:
        """Filter of the first column of ``keys`` (nulls aside), of about ``n_keys`` keys."""
        blocks = max(1, -(-n_keys * BITS_PER_KEY // BLOCK_BITS))
        key = F.col(keys.columns[0])
        words = [_mask(key, i).alias(f"w{i}") for i in range(_WORDS)]
        rows = keys.where(key.isNotNull()).select(_block(key, blocks).alias("block"), *words)
        table = rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)])
        return cls(cut_lineage(table, "bloom"), blocks)

    def probed(self, df: DataFrame, key: Column, out: str = "may_be_in") -> DataFrame:
        """``df`` with ``out``: false where ``key`` is certainly none of the keys
        (a null key never is one). Rows stay where they are while the filter's
        table is within the broadcast bounds."""
        table, _ = bounded_broadcast(self.table)
        table = table.select(F.col("block").alias("_block"), F.struct(*[f"w{i}" for i in range(_WORDS)]).alias("_words"))
        hit = F.col("_words").isNotNull()
        for i in range(_WORDS):
            wanted = _mask(key, i)
            hit = hit & (F.col(f"_words.w{i}").bitwiseAND(wanted) == wanted)
        joined = df.join(table, _block(key, self.blocks) == F.col("_block"), "left")
        return joined.withColumn(out, F.coalesce(hit & key.isNotNull(), F.lit(False))).drop("_block", "_words")
