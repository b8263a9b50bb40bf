"""Window operators (W1-W9), written to survive hot partition keys.

A plain ``Window.partitionBy(customer)`` sends every row of one customer to
one task. W3-W6 look for such keys first (``hotkeys.hot_keys``, one pass with
a heavy-hitter sketch). Without any, the plain window is the best plan: one
shuffle of the rows. With some, only the hot keys' rows are cut into blocks,
and the one window is partitioned by (key, block) too:

* W4: a block begins with a carry row, the last row of the key's block before;
* W3, W6: two-pass prefix scan. The first pass reduces hot keys to one row of
  sums per (key, order value) and block sums per (key, block); the second puts
  those rows and the sums of all earlier blocks in front of the block's rows,
  whose own values no longer count, so a block, and even one (key, order value)
  with very many rows, can be dealt to several tasks;
* W5: the first value is a partially aggregated MIN_BY, joined with salts for
  hot keys only.

Carry rows are united with the rows before the shuffle and dropped after the
window, so raw rows are never joined back to a window's result. Top-1 filters
use ``row_number() = 1``, which Spark plans as a partial ``WindowGroupLimit``
before the shuffle, so each map task forwards at most one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.hotkeys import Hot, blocks, hot_join, hot_keys
from marketlens.sources.publish import materialize


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (QUALIFY row_number() = 1).

    ``order`` must end in enough tiebreak columns to make the pick unique.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")




def with_transaction_rank(df: DataFrame, part: Sequence[str], date_col: str,
                          out: str = "transaction_rank", hot: Hot | None = None) -> DataFrame:
    """Dense rank of ``date_col`` within ``part`` (same-day rows share a rank; a null day ranks first).

    ``hot`` may give the hot keys of ``part`` if they are known already.
    """
    return running(df, part, date_col, {}, hot, rank=out)


def with_previous(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str],
                  cols: Mapping[str, str], hot: Hot | None = None) -> DataFrame:
    """LAG(col, 1) over (partition by keys order by bucket, *order), per ``cols`` (source -> output).

    ``bucket`` is the leading order key; ``bucket`` and ``order`` (ascending)
    must make a key's rows unique. A hot key is cut at quantiles of the whole
    order tuple, so a single hour or instant of one key is split too; each of
    its blocks starts with a copy of the last row before it.
    """
    hot = hot if hot is not None else hot_keys(df, keys)
    whole = [bucket, *(c for c in order if c != bucket)]
    lags = {src: dst for src, dst in cols.items()}
    if not hot.rows:
        w = Window.partitionBy(*keys).orderBy(*whole)
        return df.select("*", *[F.lag(F.col(src), 1).over(w).alias(dst) for src, dst in lags.items()])
    rows = blocks(df, keys, whole, hot)
    kept = list(dict.fromkeys([*keys, *lags]))
    last = rows.where("__hot").groupBy(*keys, "__block").agg(
        F.max_by(F.struct(*[F.col(c) for c in lags]), F.struct(*whole)).alias("__last"))
    after = last.withColumn("__next", F.lead("__block").over(Window.partitionBy(*keys).orderBy("__block")))
    values = {**{c: F.col(f"__last.{c}") for c in lags}, **{k: F.col(k) for k in keys}}
    carry = after.where("__next is not null").select(
        *[values[c].alias(c) for c in kept], F.col("__next").alias("__block"), F.lit(True).alias("__carry"))
    both = rows.withColumn("__carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "__block").orderBy(F.desc("__carry"), *whole)
    out = both.select("*", *[F.lag(F.col(src), 1).over(w).alias(dst) for src, dst in lags.items()])
    return out.where(~F.col("__carry")).drop("__hot", "__block", "__carry")


def last_change(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: str,
                out: str) -> DataFrame:
    """W4 + F13 + W2: latest ``bucket`` at which ``value`` differs from the previous observation."""
    prev = with_previous(df, keys, bucket, order, {value: "__prev"})
    ch = prev.filter(F.col("__prev").isNotNull() & (F.abs(F.col(value) - F.col("__prev")) > 0))
    return ch.groupBy(*keys).agg(F.max(bucket).alias(out))


def first_by(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], out: str,
             hot: Hot | None = None) -> DataFrame:
    """FIRST_VALUE(value) over (partition by keys order by order), one row per input row.

    Keys may be NULL and then group together. With hot keys it is a
    partially-aggregated MIN_BY per key, joined with the hot keys salted.
    """
    hot = hot if hot is not None else hot_keys(df, keys)
    if not hot.rows:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.first(value).over(w))
    firsts = df.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(*order)).alias(out))
    return hot_join(df, firsts, keys, "left", hot=hot)


def running_totals(df: DataFrame, part: Sequence[str], order: str,
                   exprs: Mapping[str, tuple[str, Column]], hot: Hot | None = None) -> DataFrame:
    """Running SUM/COUNT/MAX with the default RANGE frame (peers included).

    ``exprs`` maps output name -> (kind, column) with kind in sum|count|max.
    Sums of doubles are exact: added as decimals of 6 places, so they don't
    depend on the rows' placement. ``hot``: see ``with_transaction_rank``.
    """
    return running(df, part, order, exprs, hot)


def running(df: DataFrame, part: Sequence[str], order: str, exprs: Mapping[str, tuple[str, Column]],
            hot: Hot | None = None, rank: str | None = None) -> DataFrame:
    """W3 + W6 in one window: ``running_totals`` and, if ``rank`` names it, the dense rank of ``order``."""
    doubles = {n for n, (kind, c) in exprs.items() if kind == "sum" and dict(df.select(c.alias("c")).dtypes)["c"] in ("double", "float")}

    def value(name: str) -> Column:
        kind, c = exprs[name]
        if kind == "count":
            return F.when(c.isNotNull(), 1).otherwise(0).cast("bigint")
        if kind in ("sum", "max"):
            return c.cast("decimal(38,6)") if name in doubles else c
        raise ValueError(kind)

    def total(name: str, of: str) -> Column:
        return F.max(of) if exprs[name][0] == "max" else F.sum(of)

    def finish(rows: DataFrame, w, ranks: Column) -> DataFrame:
        cols = []
        for n in exprs:
            c = total(n, f"__v_{n}").over(w)
            cols.append((c.cast("double") if n in doubles else c).alias(n))
        return rows.select("*", *cols, *([ranks.cast("bigint").alias(rank)] if rank else [])).drop(*[f"__v_{n}" for n in exprs])

    hot = hot if hot is not None else hot_keys(df, part)
    rows = df.withColumns({f"__v_{n}": value(n) for n in exprs})
    if not hot.rows:
        w = Window.partitionBy(*part).orderBy(order)
        return finish(rows, w.rangeBetween(Window.unboundedPreceding, Window.currentRow), F.dense_rank().over(w))

    # first pass: one row per order value of a hot key, and sums and tasks per block
    rows = blocks(rows, part, [order], hot)
    names = [f"__v_{n}" for n in exprs]
    sums = [total(n, f"__v_{n}").alias(f"__v_{n}") for n in exprs]
    each = materialize(rows.where("__hot").groupBy(*part, "__block", order).agg(
        *sums, F.lit(1).cast("bigint").alias("__days"), F.count(F.lit(1)).alias("__n")))
    block = each.groupBy(*part, "__block").agg(*sums, F.sum("__days").alias("__days"), F.sum("__n").alias("__n"))
    salts = F.ceil(F.col("__n") / hot.target)
    block = materialize(block.withColumn("__salts", salts))
    w = Window.partitionBy(*part).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = block.select(*part, "__block", "__salts", F.lit(None).cast(dict(df.dtypes)[order]).alias(order),
                           F.lag("__block").over(Window.partitionBy(*part).orderBy("__block")).alias("__prev"),
                           *[total(n, f"__v_{n}").over(w).alias(f"__v_{n}") for n in exprs],
                           F.sum("__days").over(w).alias("__days")).where("__prev is not null").drop("__prev")

    # second pass: the rows behind their block's carries, on as many tasks as the block's rows need
    def same(left: DataFrame) -> Column:
        cond = left["__block"] == F.col("__b")
        for k in part:
            cond = cond & left[k].eqNullSafe(F.col(f"__k_{k}"))
        return cond

    few = block.select(*[F.col(k).alias(f"__k_{k}") for k in part], F.col("__block").alias("__b"), "__salts")
    gone = [*(f"__k_{k}" for k in part), "__b"]
    days = each.join(F.broadcast(few), same(each)).drop(*gone, "__n")
    carries = days.unionByName(offsets).select(
        *part, "__block", order, *names, "__days",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__salts") - 1)).alias("__salt"),
        F.lit(True).alias("__carry"), F.lit(True).alias("__hot"))
    spread = rows.join(F.broadcast(few), same(rows), "left")  # one row a block of a hot key: 2,000 or so
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*df.columns), F.col("__salts"))).otherwise(F.lit(0))
    spread = spread.withColumns({"__salt": salt.cast("bigint"), "__carry": F.lit(False), "__days": F.lit(None).cast("bigint"),
                                 **{n: F.when(~F.col("__hot"), F.col(n)) for n in names}}).drop(*gone, "__salts")
    both = spread.unionByName(carries, allowMissingColumns=True)
    w = Window.partitionBy(*part, "__block", "__salt").orderBy(order)
    frame = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = F.when(F.col("__hot"), F.sum("__days").over(frame)).otherwise(F.dense_rank().over(w))
    out = finish(both, frame, ranks)
    return out.where(~F.col("__carry")).drop("__carry", "__hot", "__block", "__salt", "__days")


def mix_flags(is_house: Column) -> dict[str, tuple[str, Column]]:
    """W7's columns for ``running``: has the part had a 1P row so far, and a 3P one."""
    return {"mix_has_1p": ("max", F.when(is_house, 1).otherwise(0)), "mix_has_3p": ("max", F.when(is_house, 0).otherwise(1))}


def party_mix(df: DataFrame, part: Sequence[str], order: str, is_house: Column) -> DataFrame:
    """Running party mix of ``part`` ordered by ``order`` (RANGE frame), as
    containment flags mix_has_1p / mix_has_3p (the original's '1P,3P' list is only
    ever tested with LIKE). NULL ``is_house`` counts as 3P."""
    return running_totals(df, part, order, mix_flags(is_house))


def top_per_group(df: DataFrame, group: str, measure: str, tiebreak: Sequence[str], k: int) -> DataFrame:
    """Best row of each group by ``measure`` desc, then the ``k`` best groups."""
    w = Window.partitionBy(group).orderBy(F.desc(measure), *tiebreak)
    best = df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    return best.orderBy(F.desc(measure), *tiebreak).limit(k)
