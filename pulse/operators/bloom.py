"""Blocked Bloom filters over keys, built and probed with built-in functions.

A key belongs to one block of ``BLOCK`` bits (by one hash) and sets ``HASHES``
bits of it (from a second hash).  A block is one row of ``BLOCK / 32`` words,
so a filter is a small frame that is broadcast and met by an equi-join on the
block with the bit tests as its condition; a ``left_semi`` join keeps the rows
that may be known, a ``left_anti`` join those that are not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a block, as the bitmap aggregate makes them.
BLOCK = 32_768
WORD = 32
HASHES, BITS_PER_KEY = 6, 10


#: In-memory bytes of a block: eight a word of 32 bits.
BLOCK_BYTES = BLOCK // WORD * 8


def blocks_for(n: int) -> int:
    return max(1, -(-n * BITS_PER_KEY // BLOCK))


def filter_bytes(n: int) -> int:
    """In-memory bytes of a filter of n keys."""
    return blocks_for(n) * BLOCK_BYTES


@dataclass
class KeyFilter:
    rows: DataFrame     # (_block, _words)
    blocks: int


def _block(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks))


def _positions(keys: list[str]) -> list[Column]:
    second = F.xxhash64(F.lit(1), *keys)
    start, stride = second.bitwiseAND(F.lit(BLOCK - 1)), F.shiftrightunsigned(second, 32).bitwiseOR(F.lit(1))
    return [(start + i * stride).bitwiseAND(F.lit(BLOCK - 1)) for i in range(HASHES)]


def key_filter(rows: DataFrame, keys: list[str], n: int, most_bytes: int | None = None) -> KeyFilter:
    """Filter of the keys in ``rows`` (about n of them).  Its size follows n, up to
    ``most_bytes``; a filter held to that lets more foreign keys through, but none of its own is lost."""
    blocks = blocks_for(n) if most_bytes is None else max(1, min(blocks_for(n), most_bytes // BLOCK_BYTES))
    bits = (rows.select(_block(keys, blocks).alias("_block"), F.explode(F.array(*_positions(keys))).alias("_bit"))
            .groupBy("_block").agg(F.hex(F.bitmap_construct_agg("_bit")).alias("_hex")))
    # four bytes to a word; the word's first byte is its highest
    words = F.transform(F.sequence(F.lit(0), F.lit(BLOCK // WORD - 1)),
                        lambda i: F.conv(F.substring("_hex", i * 8 + 1, F.lit(8)), 16, 10).cast("long"))
    return KeyFilter(bits.select("_block", words.alias("_words")), blocks)


def may_hold(known: KeyFilter, keys: list[str]) -> Column:
    """Join condition of rows (with the key columns) and a filter's rows: true for every key that is in it."""
    hit = _block(keys, known.blocks) == F.col("_block")
    for p in _positions(keys):
        word = F.get("_words", F.shiftright(p, 5).cast("int"))
        place = (24 - F.shiftright(p.bitwiseAND(F.lit(31)), 3) * 8 + p.bitwiseAND(F.lit(7))).cast("int")
        hit = hit & (F.expr("1L").bitwiseAND(F.call_function("shiftright", word, place)) == 1)
    return hit
