"""Gap filling (zero-fill) for a daily series per key.

Grid = every day between the global min and max date x every key seen.  The
grid is generated per key with ``explode(sequence(...))`` (no nested-loop
join) and left-joined to the actual rows on (date, key).  Grid size is
days x keys, which depends on the calendar span and the number of keys, not on
the number of fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def zero_fill(visits: DataFrame, *, date_col: str = "date", key: str = "dma_code",
              name: str = "dma_name", measures: tuple[str, ...] = ("attributed_visits",
                                                                     "attribution_window_days"),
              carry: tuple[str, ...] = (), run_ts=None) -> DataFrame:
    """Fill missing (date, key) combinations with zero measures.

    ``carry`` columns (e.g. ``_load_timestamp``) are copied from the actual row;
    on filled rows they take ``run_ts`` when given (so that fills created by a
    later run pass later watermarks) or NULL.
    """
    # One aggregation gives the key list with per-key first/last dates; the
    # global range is then taken over that key list (one row per key, so the
    # unpartitioned window holds #keys rows), and the grid is generated per
    # key with explode(sequence) -- no join, and the input is read once here
    # and once for the join below.
    # (grouping by the name too keeps the buffers fixed-width, so this is a
    # hash aggregate; picking one name per key then runs on the tiny result)
    per_name = visits.groupBy(key, name).agg(F.min(date_col).alias("_lo"),
                                             F.max(date_col).alias("_hi"))
    keys = per_name.groupBy(key).agg(F.max(name).alias(name), F.min("_lo").alias("_lo"),
                                     F.max("_hi").alias("_hi"))
    everything = Window.partitionBy()
    ranged = keys.select(key, name, F.min("_lo").over(everything).cast("date").alias("_lo"),
                         F.max("_hi").over(everything).cast("date").alias("_hi"))
    grid = ranged.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY")))
                         .alias(date_col), key, name)
    actual = visits.select(date_col, key, *measures, *carry,
                           F.lit(1).alias("_present"))
    j = grid.join(actual, [date_col, key], "left")
    filled = [F.coalesce(F.col(m), F.lit(0)).cast(visits.schema[m].dataType).alias(m)
              for m in measures]
    carried = []
    for c in carry:
        if run_ts is None:
            fill_value = F.lit(None)
        elif hasattr(run_ts, "isoformat"):      # wall-clock literal, zone-independent
            fill_value = F.lit(run_ts.isoformat(sep=" "))
        else:
            fill_value = F.lit(run_ts)
        carried.append(F.coalesce(F.col(c), fill_value.cast(visits.schema[c].dataType)).alias(c))
    return j.select(date_col, key, name, *filled,
                    F.col("_present").isNull().cast("int").alias("is_zero_filled"), *carried)


def grid_state(visits: DataFrame, *, date_col: str = "date", key: str = "dma_code",
               name: str = "dma_name") -> DataFrame:
    """What a filled grid is made of, one row per key: ``(key, name, lo, hi)``, the key's name
    (the largest) and the first and last day of all keys."""
    per_name = visits.groupBy(key, name).agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return _whole_range(per_name, key, name)


def _whole_range(per_name: DataFrame, key: str, name: str) -> DataFrame:
    keys = per_name.groupBy(key).agg(F.max(name).alias(name), F.min("lo").alias("lo"),
                                     F.max("hi").alias("hi"))
    everything = Window.partitionBy()  # one row per key
    return keys.select(key, name, F.min("lo").over(everything).cast("date").alias("lo"),
                       F.max("hi").over(everything).cast("date").alias("hi"))


def zero_fill_delta(state: DataFrame, batch: DataFrame, stored: DataFrame, *, date_col: str = "date",
                    key: str = "dma_code", name: str = "dma_name",
                    measures: tuple[str, ...] = ("attributed_visits", "attribution_window_days"),
                    carry: tuple[str, ...] = (), run_ts=None) -> tuple[DataFrame, DataFrame]:
    """The rows that a batch of visits changes in a filled grid, and the grid's new state.

    ``state``: ``grid_state`` of the grid that is there; ``stored``: the visits it was made
    from and the batch.  Changed are the days outside the old range for all keys, all days
    for keys that are new or have got another name, and the days of the batch itself (a gap
    that is no gap any more).  Nothing else is read but the stored rows of renamed keys,
    and nothing else needs to be written: upserted by (date, key), the rows give the grid
    that ``zero_fill`` makes of all visits."""
    per_name = batch.groupBy(key, name).agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    new_state = _whole_range(state.select(key, name, "lo", "hi").unionByName(per_name), key, name)
    was = state.select(F.col(key).alias("_key"), F.col(name).alias("_name"), F.col("lo").alias("_lo"),
                       F.col("hi").alias("_hi"))
    # null-safe, as the grouping above is; one row per key on either side
    both = new_state.join(was, F.col(key).eqNullSafe(F.col("_key")), "left")
    whole = F.col("_lo").isNull() | ~F.col(name).eqNullSafe(F.col("_name"))

    def days(start, end):
        return F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).otherwise(
            F.array().cast("array<date>"))

    touched = F.when(whole, days(F.col("lo"), F.col("hi"))).otherwise(F.concat(
        days(F.col("lo"), F.date_sub("_lo", 1)), days(F.date_add("_hi", 1), F.col("hi"))))
    new_cells = both.select(F.explode(touched).alias(date_col), key)
    own_days = batch.select(F.col(date_col).cast("date").alias(date_col), key)
    cells = new_cells.unionByName(own_days).distinct()
    renamed = both.where(F.col("_lo").isNotNull() & ~F.col(name).eqNullSafe(F.col("_name"))).select(key)
    cols = [date_col, key, *measures, *carry]
    actual = batch.select(*cols).unionByName(
        stored.join(renamed, key, "left_semi").select(*cols)).distinct()
    rows = zero_fill_cells(cells, new_state, actual, date_col, key, name, measures, carry, run_ts,
                           batch.schema)
    return rows, new_state


def zero_fill_cells(cells: DataFrame, state: DataFrame, actual: DataFrame, date_col: str, key: str,
                    name: str, measures, carry, run_ts, schema) -> DataFrame:
    """Cells (date, key) of a grid with their key's name and their actual row, or zeros."""
    named = cells.join(state.select(key, name), key)
    j = named.join(actual.withColumn("_present", F.lit(1)), [date_col, key], "left")
    fill = F.lit(None if run_ts is None else run_ts.isoformat(sep=" "))
    return j.select(
        date_col, key, name,
        *[F.coalesce(F.col(m), F.lit(0)).cast(schema[m].dataType).alias(m) for m in measures],
        F.col("_present").isNull().cast("int").alias("is_zero_filled"),
        *[F.when(F.col("_present").isNotNull(), F.col(c)).otherwise(fill.cast(schema[c].dataType)).alias(c)
          for c in carry])
