"""Key-based de-duplication, written as aggregations.

A window ``row_number() OVER (PARTITION BY key ...)`` sends every row of a key
to one task and sorts it there; with one key holding a third of the data that
task would hold a third of the data.  The functions here instead pick the
winning row as ``max(struct(ordering..., row))`` per key.  ``max`` is a
declarative aggregate, so Spark combines map-side (partial aggregation) before
the shuffle and a hot key costs one partial row per input partition.  (A
struct buffer makes Spark use sort-based aggregation; the struct holds the
non-key columns once, and keys are returned from the grouping columns so
filters on keys are pushed below the aggregate.)

Ordering conventions
--------------------
``ordinal``: input position (one column or several, compared in order;
numbers, or strings such as file names), lower = earlier.  When a rule says
"earlier wins" on ties we maximise the negated number or the inverted string.  The whole row is the final
tie-break, so the result is deterministic even without an ordinal.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _payload(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> Column:
    """Non-key columns as one struct (keys come back from the grouping
    columns, which lets Catalyst push filters on keys below the aggregate).  ``order``:
    columns that stand before it already; they come back from there."""
    gone = {*keys, *order}
    return F.struct(*[F.col(c) for c in df.columns if c not in gone] or [F.lit(0).alias("_none")])


def _out(df: DataFrame, keys: Sequence[str], struct_col: str, cols: Sequence[str],
         order: dict[str, Column] | None = None):
    """``cols`` from the grouping columns, from ``order`` and from the row in ``struct_col``."""
    keyset = set(keys)
    return [F.col(c) if c in keyset else order[c].alias(c) if c in (order or {})
            else F.col(struct_col)["_row"][c].alias(c) for c in cols]


_PRINTABLE = "".join(map(chr, range(0x20, 0x7f)))


def _inverted(c: Column) -> Column:
    """A string that sorts the other way round (file URIs are printable ASCII; a
    terminator above all of it puts a prefix after its extensions)."""
    return F.concat(F.translate(c, _PRINTABLE, _PRINTABLE[::-1]), F.lit("\x7f"))


def _as_it_was(c: Column) -> Column:
    """The string that ``_inverted`` made ``c`` of."""
    return F.translate(F.substr(c, F.lit(1), F.char_length(c) - 1), _PRINTABLE, _PRINTABLE[::-1])


def _names(c: str | Sequence[str] | None) -> list[str]:
    return [c] if isinstance(c, str) else list(c or ())


def _texts(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}


def _neg(df: DataFrame, c: str | Sequence[str] | None) -> list[Column]:
    """Order-inverted ordinal column(s): maximising them picks the earliest."""
    text = _texts(df)
    return [(_inverted(F.col(x)) if x in text else -F.col(x)).alias(f"_neg_{i}")
            for i, x in enumerate(_names(c))]


def _ordinals(df: DataFrame, c: str | Sequence[str] | None, struct_col: str) -> dict[str, Column]:
    """The ordinal column(s) from their inverted form in ``struct_col``: they travel once."""
    text = _texts(df)
    at = F.col(struct_col)
    return {x: _as_it_was(at[f"_neg_{i}"]) if x in text else -at[f"_neg_{i}"]
            for i, x in enumerate(_names(c))}


def _drop(df: DataFrame, ordinal, drop: bool) -> list[str]:
    if not (drop and ordinal):
        return list(df.columns)
    gone = {ordinal} if isinstance(ordinal, str) else set(ordinal)
    return [c for c in df.columns if c not in gone]


def _lowest(df: DataFrame, ts: str) -> Column:
    """Missing timestamps sort below every real one."""
    if isinstance(df.schema[ts].dataType, StringType):
        return F.coalesce(F.col(ts), F.lit(""))
    return F.coalesce(F.col(ts), F.lit("0001-01-01 00:00:00").cast(df.schema[ts].dataType))


def best_record(df: DataFrame, keys: Sequence[str], ts: str, size: str,
                ordinal: str | Sequence[str] | None = None,
                drop_ordinal: bool = True) -> DataFrame:
    """One row per key (AGG-11).

    * more than one distinct timestamp in the group -> newest timestamp wins;
    * otherwise the largest ``size`` wins;
    * remaining ties -> earliest ``ordinal``, then the largest row.

    Adds ``duplicate_combined`` (1 when the group had > 1 row) and
    ``duplicate_count``.
    """
    row = _payload(df, keys, _names(ordinal))
    ts_key = _lowest(df, ts)
    # max over one struct (ordering fields first, then the row as the final
    # tie-break): the winning row travels once, not as value + ordering
    by_ts = F.max(F.struct(ts_key.alias("_o1"), *_neg(df, ordinal), row.alias("_row")))
    by_size = F.max(F.struct(F.col(size).alias("_o1"), *_neg(df, ordinal), row.alias("_row")))
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(ts_key).alias("_ts_lo"), F.max(ts_key).alias("_ts_hi"),
        by_ts.alias("_by_ts"), by_size.alias("_by_size"))
    parts = [f"_neg_{i}" for i in range(len(_names(ordinal)))] + ["_row"]
    best = F.when(F.col("_ts_lo") != F.col("_ts_hi"), F.struct(*[F.col("_by_ts")[p].alias(p) for p in parts])) \
        .otherwise(F.struct(*[F.col("_by_size")[p].alias(p) for p in parts]))
    out_cols = _drop(df, ordinal, drop_ordinal)
    return g.select(*keys, best.alias("_best"), "_n").select(
        *_out(df, keys, "_best", out_cols, _ordinals(df, ordinal, "_best")),
        (F.col("_n") > 1).cast("int").alias("duplicate_combined"),
        F.col("_n").cast("int").alias("duplicate_count"))


def first_per_key(df: DataFrame, keys: Sequence[str],
                  ordinal: str | Sequence[str] | None = None,
                  drop_ordinal: bool = False) -> DataFrame:
    """Earliest row per key (insert-or-ignore inside one batch)."""
    row = _payload(df, keys, _names(ordinal)).alias("_row")
    # with an ordinal the earliest row wins; without one the smallest row
    pick = F.max(F.struct(*_neg(df, ordinal), row)) if ordinal else F.min(F.struct(row))
    g = df.groupBy(*keys).agg(pick.alias("_r"))
    out_cols = _drop(df, ordinal, drop_ordinal)
    return g.select(*_out(df, keys, "_r", out_cols, _ordinals(df, ordinal, "_r")))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key by the ``order`` columns (last write wins); the
    whole row breaks remaining ties."""
    row = _payload(df, keys, order)
    last = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                          row.alias("_row")))
    g = df.groupBy(*keys).agg(last.alias("_r"))
    return g.select(*_out(df, keys, "_r", df.columns,
                          {c: F.col("_r")[f"_o{i}"] for i, c in enumerate(order)}))
