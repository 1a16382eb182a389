from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.frames import Order, add_features, clean_numbers
from tideline.functions.families import Families
from tideline.plans.scaleout import add_bounded_features, add_features_in_chunks, chunk_order, numbered, running


def column(df, name):
    return [r[0] for r in df.orderBy("_row").select(name).collect()]


def run(df, order, make):
    feature = make(Families(order))
    return column(add_features(df, [feature], Order()), feature.name)


def test_leak_safe_mean(series, order):
    out = run(series(range(20)), order, lambda f: f.rolling_mean("x", 5))
    assert out[0] is None and out[1] is None and out[10] == 7


def test_tsla(series, order):
    out = run(series([0, 0, 1, 0, 0, 0, 1, 0, 0, 0]), order, lambda f: f.tsla("x"))
    assert out == [None, None, 0, 1, 2, 3, 0, 1, 2, 3]


def test_edges(series, order):
    out = run(series([1 if 5 <= i <= 7 or 30 <= i <= 31 else 0 for i in range(80)]), order, lambda f: f.edges("x", 60))
    assert out[60] == 2


def test_starts_and_restart(series, order):
    df = series([0, 0, 1, 1, 0, 1, 0, 1])
    assert run(df, order, lambda f: f.cumulative_starts(["x"]))[-1] == 3
    assert run(df, order, lambda f: f.time_since_machine_off(["x"])) == [None, None, 0, 1, 2, 0, 1, 0]
    on = series([1, 1, 0])
    assert run(on, order, lambda f: f.time_since_machine_off(["x"])) == [0, 1, 2]  # a record that begins on starts there
    assert run(on, order, lambda f: f.cumulative_starts(["x"])) == [0, 0, 0]  # and that is no start


def test_daily_energy(series, order):
    out = run(series([60] * 4, dt.datetime(2025, 1, 1, 23, 59)), order, lambda f: f.cumulative_energy_daily("x", 1 / 60))
    assert out == [1, 1, 2, 3]


def test_energy_per_kg(series, order):
    out = run(series([60] * 80, rate=[10] * 80), order, lambda f: f.energy_per_kg("x", "rate", 60, 1 / 60))
    assert out[-1] == pytest.approx(0.1)


def test_robust_z_spike(series, order):
    draw = random.Random(1)
    out = run(series([500 if i == 120 else draw.gauss(50, 1) for i in range(130)]), order, lambda f: f.robust_z("x", 60))
    assert math.isfinite(out[120]) and abs(out[120]) > 50


def test_null_poisons_mad_but_not_median(series, order):
    x = [float(i % 7) for i in range(30)]
    x[20] = None
    df = series(x)
    mad = run(df, order, lambda f: f.mad("x", 8))
    assert mad[20] is not None and all(v is None for v in mad[21:29]) and mad[29] is not None
    assert run(df, order, lambda f: f.rolling_mean("x", 8))[25] is not None


def test_zero_base_and_nan(series, order):
    assert run(series([0, 5, 0, 0]), order, lambda f: f.pct_change("x", 1)) == [None, None, -1, None]
    df = clean_numbers(series([1.0, float("nan"), float("inf"), 2.0]))
    assert column(df, "x") == [1.0, None, None, 2.0]


PANDAS = {
    "rolling_mean": lambda s, w: s.rolling(w, min_periods=max(2, w // 4), closed="left").mean(),
    "rolling_std": lambda s, w: s.rolling(w, min_periods=max(2, w // 4), closed="left").std(),
    "rolling_trend": lambda s, w: s.diff().rolling(w, min_periods=max(2, w // 4), closed="left").mean(),
    "rolling_range": lambda s, w: s.rolling(w, min_periods=max(2, w // 4), closed="left").max() - s.rolling(w, min_periods=max(2, w // 4), closed="left").min(),
    "mad": lambda s, w: s.rolling(w, min_periods=max(2, w // 4), closed="left").apply(lambda a: np.median(np.abs(a - np.median(a))), raw=True),
    "acceleration": lambda s, w: s.diff(w).diff(w),
    "velocity": lambda s, w: s.diff(w),
    "lag": lambda s, w: s.shift(w),
}


@pytest.mark.parametrize("name", PANDAS)
def test_same_as_pandas(series, order, name):
    draw = random.Random(3)
    x = [None if draw.random() < 0.1 or 40 <= i < 60 or i >= 195 else draw.gauss(0, 5) for i in range(200)]
    s = pd.Series([np.nan if v is None else v for v in x])
    out = run(series(x), order, lambda f: getattr(f, name)("x", 15))
    want = PANDAS[name](s, 15).tolist()
    assert [v is None for v in out] == [math.isnan(v) for v in want]
    assert np.allclose([v for v in out if v is not None], [v for v in want if not math.isnan(v)], atol=1e-9)


def test_one_exchange_one_sort(series, order):
    f = Families(order)
    plan = add_features(series(range(50)), [g("x", w) for w in (5, 15, 60) for g in (f.rolling_mean, f.rolling_std, f.rolling_z, f.cv, f.rolling_range)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("+- Window [") + plan.count(" Window [") <= 2


def test_chunks_equal_one_window(spark, series, order):
    draw = random.Random(5)
    df = series([None if draw.random() < 0.1 else draw.random() for _ in range(500)])
    make = lambda f: [f.rolling_mean("x", 15), f.rolling_z("x", 60), f.acceleration("x", 5), f.sign_changes("x", 15)]
    want = add_features(df, make(Families(order)), order).orderBy("_row").collect()
    own = numbered(df.drop("_row"), "timestamp")
    found = add_bounded_features(own, make(Families(chunk_order())), 62, 100).orderBy("_row").collect()
    for a, b in zip(want, found, strict=True):
        for k in ("x_mean_15", "x_z_60", "x_accel_5", "x_signchanges_15"):
            assert (a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k], abs=1e-9)


@pytest.mark.parametrize("chunk_rows", [70, 100, 333, 10_000])
def test_running_values_cross_chunks(series, order, chunk_rows):
    """Flags that are on long before, days and starts that go over several chunks, and statistics of all rows."""
    draw = random.Random(9)
    n = 700
    df = series([None if draw.random() < 0.1 else draw.gauss(3, 2) for _ in range(n)], on=[float(i in (3, 4, 250) or 400 < i < 620) for i in range(n)], kg=[draw.random() for _ in range(n)]).withColumn("timestamp", F.timestamp_seconds(F.col("_row") * 400))

    def make(f):
        return [
            f.tsla("on"), f.edges("on", 15), f.cumulative_energy("x", 0.5), f.cumulative_energy_daily("x", 0.5), f.energy_per_kg("x", "kg", 15, 1 / 60), f.time_since_machine_off(["on"]), f.cumulative_starts(["on"]),
            f.time_since_any_alarm(["on"]), f.total_alarms(["on"], 30), f.global_z("x"), f.rolling_mean("x", 60), f.lag("x", 5), f.robust_z("x", 15),
        ]

    want = add_features(df, make(Families(order)), Order()).orderBy("_row").collect()
    own = Families(chunk_order())
    features = make(own)
    out = add_features_in_chunks(df, features, own.reach, "timestamp", chunk_rows)
    found = out.orderBy("_row").collect()
    assert own.reach == 72 and out.columns == want[0].__fields__ and len(found) == n
    for a, b in zip(want, found, strict=True):
        for f in features:
            assert (a[f.name] is None and b[f.name] is None) or a[f.name] == pytest.approx(b[f.name], abs=1e-9), (f.name, a["_row"])


def test_running_totals(series):
    df = series([float(i % 3) for i in range(250)])
    out = running(df, {"total": ("sum", F.col("x")), "last_two": ("max", F.when(F.col("x") == 2, F.col("_row")))}, 40).orderBy("_row").collect()
    assert [r["total"] for r in out] == list(np.cumsum([i % 3 for i in range(250)]))
    assert out[1]["last_two"] is None and out[249]["last_two"] == 248
