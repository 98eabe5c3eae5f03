"""Registry of the queries run against the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs one engine operator or
report over tables derived (by Spark) from the benchmark tables, see
``bindings``.  ``ORACLES[name]`` is the same computation written as plain SQL
for DuckDB, following the reference's SQL where one exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = expand_dround(oracle.strip())
        return fn
    return deco


def expand_dround(sql: str) -> str:
    """``DROUND(x, n)`` -> round a double the way Spark (and SQLite) do:
    half away from zero on the double's shortest decimal form.  DuckDB's
    ``round(double)`` works on the binary value, so 0.285 gives 0.28 there
    and 0.29 in Spark; going through the text form gives the Spark answer."""
    out, i = [], 0
    while (j := sql.find("DROUND(", i)) >= 0:
        out.append(sql[i:j])
        k, depth, comma = j + len("DROUND("), 1, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        arg = expand_dround(sql[j + len("DROUND("):comma])
        digits = sql[comma + 1:k - 1].strip()
        out.append(f"CAST(ROUND(CAST(CAST(CAST(({arg}) AS DOUBLE) AS VARCHAR) "
                   f"AS DECIMAL(38,12)), {digits}) AS DOUBLE)")
        i = k
    out.append(sql[i:])
    return "".join(out)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _load_all() -> None:
    # importing the modules registers their queries
    from spendlens.plans import queries_landing, queries_media, queries_ops  # noqa: F401
    from spendlens.plans import queries_quality, queries_reports, queries_rollup  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
