"""High-water marks (SNK-5, FIL-1, FIL-2).

A watermark is one scalar per target table: the largest load timestamp that
has been processed.  Reading it is one small lookup; the filter built from it
is a literal comparison, which Parquet scans push down (row-group statistics).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = _dt.datetime(1900, 1, 1)


def since(df: DataFrame, watermark, col: str = "_load_timestamp",
          inclusive: bool = False) -> DataFrame:
    """Rows past the watermark: strict ``>`` (FIL-1) or inclusive ``>=``
    (FIL-2, re-processes the last batch; harmless behind an upsert).
    ``watermark`` may be a Python value or a scalar Column (subquery)."""
    dtype = df.schema[col].dataType
    if isinstance(watermark, Column):
        wm = watermark
    elif isinstance(watermark, _dt.datetime):
        # wall-clock text -> the column's type: no session/process zone involved
        wm = F.lit(watermark.isoformat(sep=" ")).cast(dtype)
    else:
        wm = F.lit(watermark)
    wm = F.coalesce(wm, F.lit(SEED.isoformat(sep=" ")).cast(dtype))
    c = F.col(col)
    return df.filter(c >= wm if inclusive else c > wm)
