"""Keys that hold too many rows for one task, and how their rows are spread.

``hot_keys`` finds them in one pass with a mergeable heavy-hitter sketch
(``approx_top_k``, partially aggregated in every task, over a hash of the key
columns). A key is hot above ``target_rows``: a million rows, or a thousandth
of all rows if that is more. So there are at most some 1,000 hot keys and
2,000 blocks of their rows whatever the input, which bounds every list, carry
and broadcast below. Placement never changes a result.

``blocks`` cuts the rows of hot keys into ranges of their order columns at
quantiles of a sample; all other keys keep one block. A window partitioned by
(key, block) then never holds a whole hot key; what a block needs to know of
the blocks before it comes as carry rows, which the caller puts in front.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.publish import materialize

#: Rows of one key that one task takes.
HOT_ROWS = 1_000_000
#: Rows of all keys that one task sorts or groups.
TASK_ROWS = 300_000
#: More tasks (and buckets of a staged table) than these aren't made; their rows spill.
MOST_TASKS = 50_000
#: Counters of the sketch; its error is a small part of a thousandth of the rows.
SKETCH_ITEMS = 20_000
MOST_HOT = 1_000
#: Sampled order values for each block.
SAMPLES = 32


@dataclass(frozen=True)
class Hot:
    """The hot keys of a relation: hash of the key columns -> estimated rows."""

    rows: dict[int, int]
    target: int

    def pieces(self) -> dict[int, int]:
        """How many tasks each key's rows are for."""
        return {h: ceil(n / self.target) for h, n in self.rows.items()}


def key_hash(keys: Sequence[str]) -> Column:
    """One number for the key columns, nulls told apart by place (equal hashes share their placement only)."""
    return F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])


def target_rows(spark: SparkSession, total: int) -> int:
    return max(int(spark.conf.get("spark.marketlens.hotRows", str(HOT_ROWS))), total // MOST_HOT)


def tasks_for(spark: SparkSession, total: int) -> int:
    """How many tasks ``total`` rows are dealt to: the session's shuffle partitions, or more where these would be too large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(ceil(total / TASK_ROWS), MOST_TASKS))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> Hot:
    """The keys of ``df`` that are too many rows for one task, from one pass over its key columns."""
    hashed = df.select(key_hash(keys).alias("h"))
    total, top = hashed.agg(F.count(F.lit(1)), F.expr(f"approx_top_k(h, {MOST_HOT}, {SKETCH_ITEMS})")).first()
    target = target_rows(df.sparkSession, total)
    return Hot({r["item"]: r["count"] for r in top or [] if r["count"] > target}, target)


def _lookup(spark: SparkSession, rows: dict[int, int], value: str) -> DataFrame:
    return spark.createDataFrame(list(rows.items()), f"__h bigint, {value} bigint")


def blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: Hot) -> DataFrame:
    """``df`` with ``__hot`` (is the key hot) and ``__block``, its place among the key's ranges of ``order`` (0 if not hot).

    Ranges follow one another in the order of the columns, nulls first; rows
    equal in ``order`` share a block.
    """
    at = F.struct(*order)
    pieces = hot.pieces()
    every = _lookup(df.sparkSession, {h: max(1, n // (SAMPLES * pieces[h])) for h, n in hot.rows.items()}, "__every")
    sampled = (df.select(key_hash(keys).alias("__h"), at.alias("__at")).join(F.broadcast(every), "__h")
               .where(F.pmod(F.xxhash64("__at", F.monotonically_increasing_id()), F.col("__every")) == 0))
    # one cut in SAMPLES sampled rows: as many as the key has pieces
    cuts = sampled.groupBy("__h").agg(F.sort_array(F.collect_list("__at")).alias("s")).select(
        "__h", F.array_distinct(F.expr(f"transform(sequence(1, greatest(1, int(size(s) / {SAMPLES}))), "
                                       f"i -> element_at(s, least(size(s), i * {SAMPLES})))")).alias("__cuts"))
    found = df.withColumn("__h", key_hash(keys)).join(F.broadcast(materialize(cuts)), "__h", "left")
    before = F.filter("__cuts", lambda c: c <= at)
    place = F.when(F.col("__cuts").isNull(), 0).otherwise(F.size(before))
    known = _lookup(df.sparkSession, hot.rows, "__rows")
    found = found.withColumn("__block", place.cast("int")).join(F.broadcast(known), "__h", "left")
    return found.withColumn("__hot", F.col("__rows").isNotNull()).drop("__h", "__cuts", "__rows")


def hot_join(big: DataFrame, small: DataFrame, keys: Sequence[str] | str, how: str = "inner",
             salt_from: Sequence[str] = (), hot: Hot | None = None, null_safe: bool = True,
             tasks: int | None = None, hint: str | None = None) -> DataFrame:
    """Equi-join that spreads the rows of ``big``'s hot keys over several tasks; ``null_safe``: null keys match null keys.

    Only hot keys are salted: a big row gets one of its key's salts from a
    hash of ``salt_from`` (default: all columns), and the small side's rows of
    that key are repeated for each; all other rows have salt 0. Without hot
    keys this is the plain join. ``how`` is inner or left; ``tasks`` deals the
    rows of ``big`` to that many tasks (keys that aren't null-safe); ``hint`` is the join's strategy.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    hot = hot or hot_keys(big, keys)
    names = {k: f"__s_{k}" for k in keys}
    right = small.select(*[F.col(c).alias(names[c]) if c in names else F.col(c) for c in small.columns])
    cond = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(names[k])) if null_safe else F.col(k) == F.col(names[k])
        cond = one if cond is None else cond & one
    if hot.rows:
        salts = F.broadcast(_lookup(big.sparkSession, hot.pieces(), "__pieces"))
        cols = [F.col(c) for c in (salt_from or big.columns)]
        left = big.withColumn("__h", key_hash(keys)).join(salts, "__h", "left").withColumn(
            "__salt", F.coalesce(F.pmod(F.xxhash64(*cols), F.col("__pieces")), F.lit(0)))
        right = right.withColumn("__h", key_hash(list(names.values()))).join(salts, "__h", "left").withColumn(
            "__rsalt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("__pieces", F.lit(1)) - 1)))
        # the salt is part of the join key, so a hot key's rows go to several partitions
        big, right = left.drop("__h", "__pieces"), right.drop("__h", "__pieces")
        cond = cond & (F.col("__salt") == F.col("__rsalt"))
    if tasks:
        big = big.repartition(tasks, *keys, *(["__salt"] if hot.rows else []))
    out = big.join(right.hint(hint) if hint else right, cond, how)
    return out.drop(*names.values(), "__salt", "__rsalt")
