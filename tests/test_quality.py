"""Quality-rule branches not reached by the registered queries."""

import datetime as dt

from spendlens.plans import quality as Q


def test_forecast_supplied_by_caller(spark):
    d = dt.date
    fact = spark.createDataFrame(
        [(d(2026, 1, 1), "meta", 150000.0), (d(2026, 1, 2), "meta", 50000.0),
         (d(2026, 1, 2), "google", 1000.0)], "date date, platform string, spend_usd double")
    fc = spark.createDataFrame(
        [(d(2026, 1, 1), "meta", 20000.0), (d(2026, 1, 2), "meta", 60000.0)],
        "date date, platform string, forecast_spend double")
    out = {(r["platform"], r["date"]): r for r in Q.spend_vs_forecast(fact, fc).collect()}
    assert out[("meta", d(2026, 1, 1))]["deviation"] == 130000.0
    assert out[("meta", d(2026, 1, 1))]["alert"] == 1
    assert out[("meta", d(2026, 1, 2))]["alert"] == 0
    assert out[("google", d(2026, 1, 2))]["forecast_spend"] is None
    assert out[("google", d(2026, 1, 2))]["alert"] == 0


def test_rowcount_severity(spark):
    base = dt.date(2026, 1, 1)
    counts = [100] * 7 + [130, 40, 100]
    daily = spark.createDataFrame([("meta", base + dt.timedelta(days=i), c)
                                   for i, c in enumerate(counts)],
                                  "source string, date date, row_count bigint")
    sev = [r["severity"] for r in Q.rowcount_vs_average(daily).orderBy("date").collect()]
    assert sev[0] == "no_history"
    assert sev[1:7] == ["ok"] * 6
    assert sev[7] == "warning"          # +30 %
    assert sev[8] == "critical"         # about -61 %


def test_key_collisions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c")], "k int, name string")
    out = Q.key_collisions(df, ["k"], "name").collect()
    assert [(r["k"], r["rows"], r["names"]) for r in out] == [(1, 3, 2)]
