"""Join helpers: a membership filter that grows with its keys up to a fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a block, a fixed value of the bitmap functions.
BLOCK_BITS = 1 << 15
#: Bits that a key sets, all in one block, and bits of the filter for each key.
HASHES, BITS_PER_KEY = 4, 11
#: Blocks at most; what is broadcast is at most MAX_BLOCKS * 4 KB = 128 MB, whatever the number of keys.
MAX_BLOCKS = 1 << 15


def passes(keys: int) -> float:
    """Share of other rows that pass the filter of so many distinct keys."""
    blocks = min(MAX_BLOCKS, max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS)))
    return (1 - (1 - 1 / BLOCK_BITS) ** (HASHES * keys / blocks)) ** HASHES


def _bit(keys: list[str], i: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(BLOCK_BITS))


def prefilter(rows: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` less rows whose ``keys`` are certainly not among those of ``keys_of``.

    A blocked Bloom filter: a key picks one block of bits and sets HASHES bits
    in it, so a row is looked up by one broadcast join on the block. The
    number of blocks follows the number of keys (a scalar subquery, no trip to
    the driver) up to MAX_BLOCKS; ``passes`` gives the share of other rows that
    pass, 1 % up to 10^8 keys, more beyond. An exact join must follow. It is
    always applied; too many keys make it useless, never wrong.
    """
    known = keys_of.select(*keys).distinct()
    blocks = known.select(F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.count("*") * BITS_PER_KEY / BLOCK_BITS))).cast("bigint")).scalar()
    block = F.pmod(F.xxhash64(*keys), blocks)
    bits = known.select(block.alias("_block"), F.explode(F.array(*[_bit(keys, i) for i in range(HASHES)])).alias("_bit"))
    maps = bits.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    marked = rows.withColumn("_block", block)
    found = marked.join(F.broadcast(maps), "_block")
    for i in range(HASHES):
        byte = F.conv(F.hex(F.substr("_map", F.floor(_bit(keys, i) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        found = found.where(byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << j) for j in range(8)]), (_bit(keys, i) % 8).cast("int") + 1)) != 0)
    return found.select(*rows.columns)
