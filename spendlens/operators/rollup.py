"""Aggregates that are kept and merged instead of worked out again.

* Active days: the days on which a key has rows, one bit a day, one number a month.  Exact
  under repetition (a day seen twice is one bit), mergeable by bitwise or, and countable
  over any period without the rows.
* Sums: per key and day, rows and exact decimal sums.  A batch is applied as what it adds
  less what it replaces, so reports never need the fact.

Both are hash aggregates over fixed-width buffers with partial sums before the shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_bits(df: DataFrame, keys: Sequence[str], date_col: str = "date") -> DataFrame:
    """``(*keys, month, days)``: bit i of ``days`` is set if day i + 1 of the month has rows."""
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth(date_col) - 1)
    return (df.where(F.col(date_col).isNotNull())
            .groupBy(*keys, F.trunc(date_col, "month").alias("month")).agg(F.bit_or(bit).alias("days")))


def merge_day_bits(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One state of several: of batches, of tables, of a state and a batch."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy(*keys, "month").agg(F.bit_or("days").alias("days"))


def active_days(state: DataFrame, keys: Sequence[str], start: _dt.date, end: _dt.date) -> DataFrame:
    """``(*keys, days_active)``: distinct days with rows from ``start`` to ``end`` inclusive;
    keys without any are left out."""
    first, last = F.lit(start), F.lit(end)
    one = F.lit(1).cast("bigint")
    # days of the month that lie in the period, as bits lo .. hi
    lo = F.greatest(F.datediff(first, "month"), F.lit(0))
    hi = F.least(F.datediff(last, "month"), F.lit(30))
    inside = (F.call_function("shiftleft", one, hi + 1) - 1).bitwiseAND(
        F.bitwise_not(F.call_function("shiftleft", one, lo) - 1))
    n = F.bit_count(F.col("days").cast("bigint").bitwiseAND(inside))
    return (state.where((F.col("month") <= last) & (F.last_day("month") >= first))
            .groupBy(*keys).agg(F.sum(n).alias("days_active")).where("days_active > 0"))


def rollup(fact: DataFrame, keys: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """``(*keys, n_rows, *measures)``: rows and sums; ``measures``: column -> decimal type."""
    return fact.groupBy(*keys).agg(F.count("*").alias("n_rows"), *[
        F.sum(F.coalesce(F.col(m).cast(kind), F.lit(0).cast(kind))).alias(m) for m, kind in measures.items()])


def replaced_rows(fact: DataFrame, batch: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """Rows of ``fact`` that an upsert of ``batch`` by ``row_key`` replaces (NULL keys match)."""
    other = batch.select(*[F.col(k).alias(f"_new_{k}") for k in row_key]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in row_key])
    return fact.join(other, same, "left_semi")


def apply_batch(state: DataFrame, added: DataFrame, removed: DataFrame, keys: Sequence[str],
                measures: dict[str, str]) -> DataFrame:
    """The state after a batch: ``state`` + the rollup of ``added`` - that of ``removed``; keys
    without rows are gone.  Exact, as the sums are decimals."""
    minus = rollup(removed, keys, measures).select(
        *keys, (-F.col("n_rows")).alias("n_rows"), *[(-F.col(m)).alias(m) for m in measures])
    kinds = {f.name: f.dataType for f in state.schema.fields}
    parts = [p.select(*keys, "n_rows", *[F.col(m).cast(kinds[m]).alias(m) for m in measures])
             for p in (state, rollup(added, keys, measures), minus)]
    out = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), *[F.sum(m).cast(kinds[m]).alias(m) for m in measures])
    return out.where("n_rows > 0")
