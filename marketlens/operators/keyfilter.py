"""Run-time key filters: drop a large table's rows whose key no row of a selective one can have.

``key_filter`` builds a blocked Bloom filter from the selective side's keys
with Spark's bitmap aggregates (partially aggregated, no Python): a key sets
``HASHES`` bits in one of the filter's 4 KB blocks. ``keep`` broadcasts the
blocks, at most ``MOST_BITS`` in all (16 MB), and tests the large side's rows
in the scan's stage, before any shuffle. A filter lets some 2 % of other keys
pass and never drops one of its own, so it is only ever put in front of a join
that decides exactly.

A filter costs a pass over the selective side's key column. Whether to build it
is decided from the number of files of the large table, known before any job,
and from the counted keys: beyond ``MOST_BITS / BITS_PER_KEY`` keys the filter
would be too large, and the join goes without. ``spark.marketlens.keyFilter``
may say "on" or "off" instead. The result is the same either way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one block, as ``bitmap_construct_agg`` makes them.
BLOCK = 32768
HASHES = 3
BITS_PER_KEY = 12
MOST_BITS = 1 << 27
#: A table of fewer files is joined whole.
FEW_FILES = 32


def _texts(cols: Sequence[str | Column]) -> list[Column]:
    return [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\0")) for c in cols]


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter as a relation of blocks: (block number, its bits as 32-bit words)."""

    blocks: DataFrame
    n_blocks: int

    def keep(self, df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
        """The rows of ``df`` whose key may be among the filter's; key columns in the order they were given in."""
        keys = _texts(cols)
        cond = F.pmod(F.xxhash64(*keys), F.lit(self.n_blocks)) == F.col("__block")
        for i in range(HASHES):
            at = _position(i, keys)
            word = F.element_at("__words", (F.floor(at / 32) + 1).cast("int"))
            # words are read from bytes in order, bits of a byte from the lowest
            place = 8 * (3 - F.floor(at / 8) % 4) + at % 8
            cond = cond & (F.call_function("getbit", word, place.cast("int")) == 1)
        return df.join(F.broadcast(self.blocks), cond, "left_semi")


def _position(i: int, keys: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(BLOCK))


def build(keys_df: DataFrame, cols: Sequence[str], n_keys: int) -> KeyFilter | None:
    """A filter for about ``n_keys`` distinct keys, or None if they are too many for a bounded one."""
    if n_keys * BITS_PER_KEY > MOST_BITS:
        return None
    n_blocks = max(1, -(-n_keys * BITS_PER_KEY // BLOCK))
    keys = _texts(cols)
    bits = keys_df.select(F.pmod(F.xxhash64(*keys), F.lit(n_blocks)).alias("__block"),
                          F.explode(F.array(*[_position(i, keys) for i in range(HASHES)])).alias("bit"))
    blocks = bits.groupBy("__block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    words = F.transform(F.sequence(F.lit(0), F.lit(BLOCK // 32 - 1)), lambda i: F.conv(
        F.hex(F.substring(F.col("bits"), 4 * i + 1, F.lit(4))), 16, 10).cast("bigint"))
    return KeyFilter(blocks.select("__block", words.alias("__words")), n_blocks)


def wanted(large: DataFrame) -> bool:
    """Whether ``large`` is worth a filter, from its number of files or the session's setting."""
    setting = large.sparkSession.conf.get("spark.marketlens.keyFilter", "auto")
    if setting not in ("auto", "on", "off"):
        raise ValueError(f"spark.marketlens.keyFilter is {setting!r}")
    return setting == "on" or (setting == "auto" and len(large.inputFiles()) >= FEW_FILES)


def key_filter(keys_df: DataFrame, cols: Sequence[str], large: DataFrame) -> KeyFilter | None:
    """The filter of ``keys_df``'s keys for scans of ``large``, or None where the join is better off without."""
    if not wanted(large):
        return None
    n = keys_df.agg(F.approx_count_distinct(F.xxhash64(*_texts(cols)))).first()[0]
    return build(keys_df, cols, int(n * 1.1) + 1)
