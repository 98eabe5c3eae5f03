"""Operators against brute-force Python versions of the same semantics."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from spendlens.operators.dedup import best_record, first_per_key, last_per_key
from spendlens.operators.fill import zero_fill
from spendlens.operators.merge import insert_ignore, key_filter, might_hold, upsert
from spendlens.operators.names import multi_name_campaigns, name_change_log
from spendlens.operators.regional import match_regions
from spendlens.operators import watermark as WM


def _ref_best(group):
    """The source rule: >1 distinct ts -> newest; else max size; first wins."""
    ts = {r[1] or "" for r in group}
    if len(ts) > 1:
        return max(group, key=lambda r: r[1] or "")
    return max(group, key=lambda r: r[2])


def test_best_record_random(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        k = rnd.randint(0, 60)
        ts = rnd.choice([None, "2026-01-01T01", "2026-01-01T02", "2026-01-01T03"])
        rows.append((k, ts, rnd.randint(0, 5), i))
    df = spark.createDataFrame(rows, "k int, ts string, size int, ord long")
    got = {r["k"]: (r["ts"], r["size"], r["ord"], r["duplicate_count"])
           for r in best_record(df, ["k"], "ts", "size", ordinal="ord", drop_ordinal=False)
           .collect()}
    for k, grp in itertools.groupby(sorted(rows, key=lambda r: (r[0], r[3])), key=lambda r: r[0]):
        grp = sorted(grp, key=lambda r: r[3])      # input order
        b = _ref_best(grp)
        assert got[k] == (b[1], b[2], b[3], len(grp)), k


def test_first_last_insert_upsert(spark):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, o int")
    batch = spark.createDataFrame([(2, "B", 5), (3, "c", 2), (3, "C", 1), (3, "x", 9)],
                                  "k int, v string, o int")
    first = {r["k"]: r["v"] for r in first_per_key(batch, ["k"], ordinal="o").collect()}
    assert first == {2: "B", 3: "C"}
    last = {r["k"]: r["v"] for r in last_per_key(batch, ["k"], ["o"]).collect()}
    assert last == {2: "B", 3: "x"}
    ins = {r["k"]: r["v"] for r in insert_ignore(cur, batch, ["k"], ordinal="o").collect()}
    assert ins == {3: "C"}
    up = {r["k"]: r["v"] for r in upsert(cur, batch, ["k"], ["o"]).collect()}
    assert up == {1: "a", 2: "B", 3: "x"}


def test_order_columns_travel_once(spark):
    rows = [(1, "b", 2, 7, "x", "5"), (1, "a~", 9, 8, "y", "6"), (1, "a", 9, 9, None, "6"),
            (2, None, None, 1, "z", "1"), (2, "é/ü", -3, 2, "w", "1"), (None, "q", 0, 3, "v", None)]
    df = spark.createDataFrame(rows, "k int, file string, place long, size int, v string, ts string")
    order = ["file", "place"]
    outs = [best_record(df, ["k"], "ts", "size", order, drop_ordinal=False), first_per_key(df, ["k"], order),
            last_per_key(df, ["k"], order)]
    for out in outs:
        assert {tuple(r)[:6] for r in out.select(*df.columns).collect()} <= set(rows) and out.count() == 3
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "place, place#" not in plan and "file, file#" not in plan
    assert {(r["k"], r["file"]) for r in outs[1].collect()} == {(1, "a"), (2, "é/ü"), (None, "q")}
    assert {(r["k"], r["file"]) for r in outs[2].collect()} == {(1, "b"), (2, "é/ü"), (None, "q")}
    only = df.select("k", "place")
    assert {tuple(r) for r in first_per_key(only, ["k"], "place").collect()} == {(1, 2), (2, -3), (None, 0)}


def _key_rows(n, seed):
    rnd = random.Random(seed)
    return [(rnd.choice([None, *range(300)]), rnd.choice([None, "", "a", "b", "é"]), i) for i in range(n)]


def test_bloom_filter_of_a_batch(spark):
    schema, keys = "k int, s string, o int", ["k", "s"]
    stored, batch = _key_rows(1200, 1), _key_rows(40, 2)
    cur, new = (spark.createDataFrame(r, schema) for r in (stored, batch))
    wanted = {r[:2] for r in batch}
    kept = [tuple(r)[:2] for r in might_hold(cur, keys, key_filter(new, keys)).collect()]
    true = [r[:2] for r in stored if r[:2] in wanted]
    assert sorted(map(str, (r for r in kept if r in wanted))) == sorted(map(str, true))
    assert len(kept) - len(true) < 0.02 * len(stored)
    with_, without = (sorted(map(str, insert_ignore(cur, new, keys, ordinal="o", prefilter=p).collect()))
                      for p in (True, False))
    assert with_ == without and with_
    # one block, all bits crowded: it only lets more through
    small = might_hold(cur, keys, key_filter(new, keys, blocks=1), blocks=1).collect()
    assert len(small) >= len(true)


def test_bloom_filter_of_empty_and_of_other_types(spark):
    schema = "k int, s string, o int"
    cur = spark.createDataFrame(_key_rows(50, 3), schema)
    none = spark.createDataFrame([], schema)
    assert insert_ignore(cur, none, ["k", "s"], "o", prefilter=True).collect() == []
    assert insert_ignore(none, cur, ["k"], "o", prefilter=True).count() == cur.select("k").distinct().count()
    wide = cur.withColumn("k", F.col("k").cast("bigint"))
    assert insert_ignore(wide, cur, ["k", "s"], "o", prefilter=True).collect() == []


def test_bloom_filter_stands_below_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = insert_ignore(df, df.filter("k < 3"), ["k"], ordinal="id", prefilter=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    # the stored side's exchange, and under it the filter's join
    at = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x and "_known_k" in x)
    depth = lines[at].index("Exchange")
    below = itertools.takewhile(lambda x: len(x) - len(x.lstrip(" :+-")) > depth, lines[at + 1:])
    assert any("BroadcastHashJoin" in x and "_block" in x for x in below), plan


def test_zero_fill(spark):
    d = dt.date
    v = spark.createDataFrame([(d(2026, 1, 1), "501", "NY", 5, 7), (d(2026, 1, 3), "803", "LA", 3, 7)],
                              "date date, dma_code string, dma_name string, "
                              "attributed_visits bigint, attribution_window_days bigint")
    out = zero_fill(v).collect()
    assert len(out) == 6
    assert sum(r["is_zero_filled"] for r in out) == 4
    assert sum(r["attributed_visits"] for r in out) == 8


def test_match_regions_equals_or_join(spark):
    rnd = random.Random(3)
    regions = [("National",), ("East",), ("West",), ("East",)]
    totals = [(f"2026-W{w:02d}", rnd.choice(["East", "West", None]), rnd.randint(0, 100))
              for w in range(8) for _ in range(3)]
    cr = spark.createDataFrame(regions, "region string")
    t = spark.createDataFrame(totals, "week string, mapped_region string, v long")
    got = {(r["week"], r["campaign_region"]): r["v"]
           for r in match_regions(cr, t, keys=["week"], value="v").collect()}
    ref = {}
    for (reg,) in set(regions):
        for w, m, v in totals:
            if reg == "National" or reg == m:
                ref[(w, reg)] = ref.get((w, reg), 0) + v
    assert got == ref
    plan = match_regions(cr, t, keys=["week"], value="v")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_name_log_and_watermark(spark):
    d = dt.date
    perf = spark.createDataFrame(
        [(d(2026, 1, 1), "1", "old", "meta"), (d(2026, 1, 2), "1", "old", "meta"),
         (d(2026, 1, 5), "1", "new", "google"), (d(2026, 1, 3), "2", "", "meta")],
        "date date, campaign_id string, campaign_name string, platform string")
    log = {(r["campaign_id"], r["campaign_name"]): r for r in name_change_log(perf).collect()}
    assert set(log) == {("1", "old"), ("1", "new")}
    assert log[("1", "new")]["is_current"] == 1 and log[("1", "old")]["is_current"] == 0
    assert log[("1", "old")]["days_active"] == 2
    m = multi_name_campaigns(name_change_log(perf)).collect()
    assert [(r["campaign_id"], r["name_count"], r["current_names"]) for r in m] == [("1", 2, 1)]

    ts = dt.datetime
    t = spark.createDataFrame([(ts(2026, 1, 1),), (ts(2026, 1, 2),), (ts(2026, 1, 3),)],
                              "_load_timestamp timestamp_ntz")
    assert WM.since(t, ts(2026, 1, 2)).count() == 1
    assert WM.since(t, ts(2026, 1, 2), inclusive=True).count() == 2
    assert WM.since(t, None).count() == 3


def test_name_log_from_monthly_summaries_equals_full(spark):
    from spendlens.operators.names import name_log_from_months, name_month_summary
    rnd = random.Random(9)
    base = dt.date(2026, 1, 1)
    rows = [(base + dt.timedelta(days=rnd.randint(0, 150)), str(rnd.randint(1, 20)),
             rnd.choice(["a", "b", "c", ""]), rnd.choice(["meta", "google"])) for _ in range(3000)]
    perf = spark.createDataFrame(rows, "date date, campaign_id string, campaign_name string, "
                                       "platform string") \
        .withColumn("_month", F.date_trunc("month", "date").cast("date"))
    cols = ["campaign_id", "campaign_name", "platform", "first_seen_date", "last_seen_date",
            "days_active", "is_current"]
    a = name_log_from_months(name_month_summary(perf)).select(*cols).collect()
    b = name_change_log(perf).select(*cols).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_zero_fill_delta_equals_the_full_grid(spark):
    import datetime as dt
    import random

    from spendlens.operators.fill import grid_state, zero_fill, zero_fill_delta
    from spendlens.operators.merge import upsert

    r = random.Random(4)
    schema = "date date, dma_code string, dma_name string, attributed_visits long, attribution_window_days long"
    for span in (3, 20, 0):
        cells = {(dt.date(2026, 1, 1) + dt.timedelta(r.randrange(40)), r.choice("abcdef")) for _ in range(60)}
        rows = [(d, k, k + r.choice("xy"), r.randrange(9), 7) for d, k in sorted(cells)]
        old = [x for x in rows if dt.date(2026, 1, 10) <= x[0] < dt.date(2026, 1, 11 + span) and x[1] != "f"]
        old = old or rows[:1]
        first = spark.createDataFrame(old, schema)
        batch = spark.createDataFrame([x for x in rows if x not in old], schema)
        both = spark.createDataFrame(rows, schema)
        delta, state = zero_fill_delta(grid_state(first), batch, both)
        whole = zero_fill(both)
        got = upsert(zero_fill(first), delta.select(*whole.columns), ["date", "dma_code"])
        assert sorted(map(tuple, got.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))
        assert sorted(map(tuple, state.collect())) == sorted(map(tuple, grid_state(both).collect()))
    # a batch inside the range that renames nothing changes its own days only
    batch = both.where("dma_code = 'a'").limit(1)
    assert zero_fill_delta(grid_state(both), batch, both)[0].count() == 1
