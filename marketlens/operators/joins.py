"""Equi-joins.

Broadcast policy: no broadcast hint is placed on a side whose size grows with
the data. Such joins are planned as shuffle joins and adaptive execution
turns them into broadcast joins at run time only when the measured shuffle
output is under ``spark.sql.autoBroadcastJoinThreshold`` (a checked size,
with the sort-merge plan as the fallback). Explicit ``F.broadcast`` is used
only for inputs of fixed size (literal tables, one-row aggregates).
Adaptive execution splits hot keys only where both sides of the join are plain
shuffles, so per-key aggregates that meet hot keys are materialized first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.keyfilter import key_filter


def with_receipt(lines: DataFrame, bridge: DataFrame, receipts: DataFrame,
                 cols: Sequence[str] = ("channel",)) -> DataFrame:
    """Line LEFT JOIN bridge LEFT JOIN distinct receipt header columns.

    The header is reduced to DISTINCT (receipt_id, *cols): a receipt that
    carries two channels fans its lines out (kept on purpose). Lines without
    a receipt, which may be most lines, match nothing: a second key spreads
    them by line, so they don't meet in one task. Both sides are shuffled for
    the two keys by the join itself, so adaptive execution can split a
    receipt with very many lines too.

    The bridge and the header are large, the lines often those of a short
    window: a run-time filter of the lines' ids goes into the bridge's scan, and
    one of the receipts found there into the header's, so neither is shuffled
    for lines of other months.
    """
    ids = key_filter(lines.select("line_id"), ["line_id"], bridge)
    if ids:
        bridge = ids.keep(bridge, ["line_id"])
        found = key_filter(bridge.select("receipt_id"), ["receipt_id"], receipts)
        receipts = found.keep(receipts, ["receipt_id"]) if found else receipts
    hdr = receipts.select("receipt_id", *cols).distinct().withColumn("__spread", F.xxhash64("receipt_id"))
    j = lines.join(bridge, "line_id", "left")
    # not a constant where there is a receipt, which the optimizer would fold out of the key
    spread = F.when(F.col("receipt_id").isNull(), F.xxhash64("line_id")).otherwise(F.xxhash64("receipt_id"))
    return j.withColumn("__spread", spread).join(hdr, ["receipt_id", "__spread"], "left").drop("__spread")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   nullable_keys: Sequence[str] = (), how: str = "left",
                   right_keys: dict[str, str] | None = None) -> DataFrame:
    """Equi-join where ``nullable_keys`` match NULL to NULL.

    ``right_keys`` maps a left key name to a different right column name.
    The right-side key columns are dropped from the output.
    """
    right_keys = right_keys or {}
    all_keys = [*keys, *nullable_keys]
    renamed = {right_keys.get(k, k): f"__r_{k}" for k in all_keys}
    r = right.select(*[F.col(c).alias(renamed[c]) if c in renamed else F.col(c) for c in right.columns])
    conds = [left[k] == r[f"__r_{k}"] for k in keys]
    conds += [left[k].eqNullSafe(r[f"__r_{k}"]) for k in nullable_keys]
    out = left.join(r, reduce(lambda a, b: a & b, conds), how)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return out
    return out.select(*[F.col(c) for c in out.columns if c not in renamed.values()])


def cast_join(left: DataFrame, right: DataFrame, on: dict[str, str], as_type: str = "string",
              how: str = "left") -> DataFrame:
    """Join across a key type mismatch by casting both keys to ``as_type``."""
    cond = reduce(lambda a, b: a & b,
                  [left[lk].cast(as_type) == right[rk].cast(as_type) for lk, rk in on.items()])
    return left.join(right, cond, how)


def semi(df: DataFrame, keys_df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows whose key is in another relation (IN subquery)."""
    return df.join(keys_df.select(*([keys] if isinstance(keys, str) else keys)), keys, "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows whose key is not in another relation (LEFT JOIN ... IS NULL).

    Written as a left-anti join, which Catalyst does not derive from the
    left-join form by itself.
    """
    return df.join(keys_df.select(*([keys] if isinstance(keys, str) else keys)), keys, "left_anti")


def semi_any(df: DataFrame, key_lists: Sequence[DataFrame], key: str, nullable_key: str) -> DataFrame:
    """(key, nullable_key) in list A OR in list B.

    The lists are unioned and de-duplicated, then one semi-join on
    (key, null-safe nullable_key) replaces two existence joins. Rows whose
    ``key`` is NULL never match (as with IN).
    """
    keys = reduce(lambda a, b: a.unionByName(b),
                  [k.select(F.col(k.columns[0]).alias("__k"), F.col(k.columns[1]).alias("__v"))
                   for k in key_lists])
    keys = keys.filter(F.col("__k").isNotNull()).distinct()
    cond = (df[key] == keys["__k"]) & df[nullable_key].eqNullSafe(keys["__v"])
    return df.join(keys, cond, "left_semi")


def add_parent_metrics(df: DataFrame, key: str, nullable_key: str, parent_key: str,
                       parent_nullable_key: str, metrics: Sequence[str],
                       keep: Sequence[str]) -> DataFrame:
    """child's metrics plus its parent's metrics (NULL as 0), self left join.

    A child row gets its parent's sales only if the child itself has a row.
    """
    p = df.select(F.col(key).alias("__pk"), F.col(nullable_key).alias("__pv"),
                  *[F.col(m).alias(f"__p_{m}") for m in metrics])
    cond = (df[parent_key] == p["__pk"]) & df[parent_nullable_key].eqNullSafe(p["__pv"])
    j = df.join(p, cond, "left")
    return j.select(*keep, *[F.try_add(F.coalesce(F.col(m), F.lit(0)),
                                       F.coalesce(F.col(f"__p_{m}"), F.lit(0))).alias(m)
                             for m in metrics])


def lookback(base: DataFrame, snap: DataFrame, date_col: str, days: Sequence[int],
             key: str, nullable_key: str, snap_date: str, snap_key: str, snap_nullable_key: str,
             value: str, out: str = "value_lb{d}", lookback_col: str = "lookback_{d}days",
             key_cast: str | None = None) -> DataFrame:
    """Value of a daily snapshot as of ``date_col - d`` days, for each d.

    The offsets become rows: one equality join on (date - d, key, null-safe
    nullable key) for all of them, then one aggregation that puts a base row's
    values side by side (equal base rows stay as many as they are). The
    snapshot's scan is filtered by the base's keys first (``keyfilter``), where
    that pays; it is never broadcast, as a snapshot made by exploding rows is far
    larger than what is estimated from its files. ``snap`` must be unique on its keys, and every base column must
    be groupable; ``key_cast`` casts the base key to the snapshot key's type (J4).
    """
    cols = base.columns
    probe = base.select("*", F.explode(F.array(*[F.lit(d) for d in days])).alias("__back"))
    k = F.col(key).cast(key_cast) if key_cast else F.col(key)
    probe = probe.withColumns({"__at": F.date_sub(F.col(date_col), F.col("__back")), "__key": k})
    s = snap.select(F.col(snap_date).alias("__d"), F.col(snap_key).alias("__k"), F.col(snap_nullable_key).alias("__v"),
                    F.col(value).alias("__value"))
    asked = key_filter(probe.select("__at", "__key", nullable_key), ["__at", "__key", nullable_key], snap)
    if asked:
        s = asked.keep(s, ["__d", "__k", "__v"])
    cond = (F.col("__at") == s["__d"]) & (F.col("__key") == s["__k"]) & F.col(nullable_key).eqNullSafe(s["__v"])
    found = probe.join(s.hint("merge"), cond, "left")
    wide = found.groupBy(*cols).agg(
        F.count(F.when(F.col("__back") == days[0], 1)).alias("__copies"),
        *[F.max(F.when(F.col("__back") == d, F.col("__value"))).alias(out.format(d=d)) for d in days])
    wide = wide.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))))
    return wide.select(*cols, *[F.date_sub(F.col(date_col), d).alias(lookback_col.format(d=d)) for d in days],
                       *[out.format(d=d) for d in days])


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int, how: str = "inner",
                salt_from: Sequence[str] = ()) -> DataFrame:
    """Equi-join on ``key`` with the big side's hot keys split ``salts`` ways.

    Each big row gets a salt from a hash of ``salt_from`` columns (or of all
    its columns); the small side (one row per key, e.g. a per-customer
    aggregate) is repeated once per salt. The join runs on (key, salt), so a
    key holding a third of the rows is spread over ``salts`` tasks even
    without adaptive skew handling. Same result as the plain join.
    """
    cols = list(salt_from) or big.columns
    b = big.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return b.join(s, [key, "__salt"], how).drop("__salt")


def broadcast_lookup(df: DataFrame, small: DataFrame, on: Sequence[str] | str | Column,
                     how: str = "left") -> DataFrame:
    """Join with a fixed-size table (broadcast; never used for growing data)."""
    return df.join(F.broadcast(small), on, how)


def assemble(base: DataFrame, parts: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Chain of left joins onto one base: (part, keys, nullable_keys)."""
    out = base
    for part, keys, nkeys in parts:
        out = null_safe_join(out, part, keys, nkeys, "left")
    return out
