"""Snapshots kept up by loads against ones made anew, late bars and corrections included."""

import random
from datetime import date, timedelta

import pytest
from helpers import rows_of

from tickerforge.operators import screen, snapshot, state
from tickerforge.sources import warehouse as store
from tickerforge.streaming import loader


def loads(seed=11, n=10):
    """Ten loads of bars of five securities: late ones, corrections of any day, some without a close or a volume."""
    rng, first = random.Random(seed), date(2020, 11, 1)
    for _ in range(n):
        yield [(s, first + timedelta(d), rng.choice([None, *range(1, 60)]), rng.choice([None, *range(9)])) for s in rng.sample(range(1, 6), 2) for d in rng.sample(range(120), 12)]


def test_kept_rows_are_those_made_anew(spark):
    bar = "security_id long, trade_date date, close double, volume long"
    kept, months, have = spark.createDataFrame([], snapshot.LATEST), spark.createDataFrame([], snapshot.MONTHS), {}
    for load in loads():
        load = [(s, d, None if c is None else float(c), v) for s, d, c, v in load]
        news, stored = spark.createDataFrame(load, bar), spark.createDataFrame([(*k, *v) for k, v in have.items()], bar)
        changed = snapshot.changes(stored, news)
        kept = spark.createDataFrame(snapshot.merged_latest(kept, snapshot.latest_of(changed)).collect(), snapshot.LATEST)
        months = spark.createDataFrame(snapshot.merged_months(months, snapshot.months_of(changed)).collect(), snapshot.MONTHS)
        have |= {(s, d): (c, v) for s, d, c, v in load}
        last = {s: max(d for t, d in have if t == s) for s in {s for s, _ in have}}
        assert sorted(map(tuple, kept.collect())) == [(s, sum(t == s for t, _ in have), d, *have[s, d]) for s, d in sorted(last.items())]
        totals = {}
        for (_, d), (_, v) in have.items():
            n, total = totals.get(d.replace(day=1), (0, 0))
            totals[d.replace(day=1)] = n + 1, total + (v or 0)
        assert {r["month"]: (r["n"], r["volume"]) for r in months.collect()} == totals

    bars = spark.createDataFrame([(*k, *v) for k, v in have.items()], bar)
    assert rows_of(kept) == rows_of(snapshot.whole(bars)[0])
    fewer = bars.where("NOT (security_id = 1 AND trade_date > '2020-12-01') AND security_id <> 2")  # the last bars of one go, all of another
    assert rows_of(snapshot.rebuilt(kept, fewer, spark.createDataFrame([(1,), (2,)], "security_id long"))) == rows_of(snapshot.whole(fewer)[0])
    master = spark.createDataFrame([(1, "A"), (9, "B")], "security_id long, symbol string")
    found = snapshot.security_latest(master, kept)
    assert rows_of(found.drop("n_bars")) == rows_of(screen.security_latest(master, bars)) and [r["n_bars"] for r in found.orderBy("security_id").collect()][1] == 0


@pytest.mark.parametrize("old", [False, True])
def test_the_loader_keeps_them(spark, tmp_path, old):
    """The totals of a commit are those of its bars; a warehouse that had none of them counts its bars once."""
    w = store.Warehouse(spark, str(tmp_path / "store"))
    for k, load in enumerate(loads(5, 4)):
        if old and k == 2:
            change = w.change()
            del change.tables["latest"], change.tables["months"]
            change.commit()
        rows = [(s, str(d), 1.0 * (c or 1), 1.0 * (c or 1), 1.0 * (c or 1), 1.0 * (c or 1), 1.0 * (v or 0), None, 1) for s, d, c, v in load]
        loader.load_batch(w)(spark.createDataFrame(rows, loader.BAR), k)
        now = w.snapshot()
        bars = now.read("bars", loader.CLEAN)
        assert rows_of(now.read("latest", snapshot.LATEST)) == rows_of(snapshot.whole(bars)[0])
        assert rows_of(now.read("months", snapshot.MONTHS)) == rows_of(state.bars_per_month(bars))
    assert bars.count() > 40
