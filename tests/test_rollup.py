"""Kept aggregates against plain Python."""

import datetime as dt
import random
from decimal import Decimal

from spendlens.operators.rollup import (active_days, apply_batch, day_bits, merge_day_bits,
                                        replaced_rows, rollup)


def test_active_days_of_any_period(spark):
    r = random.Random(1)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(r.randrange(400))
    rows = [(r.choice("ab"), day()) for _ in range(500)] + [("c", None), (None, dt.date(2024, 2, 29))]
    df = spark.createDataFrame(rows, "k string, date date").repartition(3)
    parts = [day_bits(df.where(c), ["k"]) for c in ("day(date) % 2 = 0", "day(date) % 3 <= 1 or date is null")]
    kept = [(k, d) for k, d in rows if d and (d.day % 2 == 0 or d.day % 3 <= 1)]
    state = merge_day_bits([*parts, parts[0]], ["k"])
    for a, b in [(dt.date(2024, 1, 1), dt.date(2025, 12, 31)), (dt.date(2024, 2, 29), dt.date(2024, 2, 29)),
                 (dt.date(2024, 1, 31), dt.date(2024, 3, 1)), (dt.date(2030, 1, 1), dt.date(2030, 2, 1))]:
        want = {}
        for k, d in kept:
            if a <= d <= b:
                want.setdefault(k, set()).add(d)
        got = {x.k: x.days_active for x in active_days(state, ["k"], a, b).collect()}
        assert got == {k: len(v) for k, v in want.items()}


def test_state_after_batches_equals_the_upserted_fact(spark):
    r = random.Random(2)
    fact = {i: (r.choice(["x", "y", None]), Decimal(r.randrange(10_000)) / 100) for i in range(60)}
    measures = {"spend": "decimal(14,2)"}
    schema = "id int, k string, spend decimal(14,2)"
    frame = lambda f: spark.createDataFrame([(i, *v) for i, v in f.items()], schema)
    state = rollup(frame(fact), ["k"], measures)
    for _ in range(2):
        batch = {r.randrange(90): (r.choice(["x", "z", None]), Decimal(r.randrange(10_000)) / 100)
                 for _ in range(25)}
        old, new = frame(fact), frame(batch)
        state = apply_batch(state, new, replaced_rows(old, new, ["id"]), ["k"], measures)
        fact |= batch
    want = {}
    for k, s in fact.values():
        n, t = want.get(k, (0, Decimal(0)))
        want[k] = (n + 1, t + s)
    assert {x.k: (x.n_rows, x.spend) for x in state.collect()} == want
    empty = apply_batch(state, frame(fact).limit(0), frame(fact), ["k"], measures)
    assert empty.count() == 0
