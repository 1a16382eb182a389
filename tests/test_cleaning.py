from __future__ import annotations

import datetime as dt
import json

import pytest

from tideline.catalog import Catalog
from tideline.operators import cleaning
from tideline.policy import policy

from .conftest import START

CATALOG, P = Catalog.default(), policy("cleaning")
at = lambda s: START + dt.timedelta(seconds=s)


def rows(found, **where):
    return [r for r in found.collect() if all(r[k] == v for k, v in where.items())]


def values(df, name):
    return [r[0] for r in df.orderBy("_row").select(name).collect()]


def lively(name):
    """A signal that changes in every row."""
    return {name: lambda i: 50.0 + i % 2}


def test_golden_table_has_no_findings(telemetry, order):
    df = telemetry(20, conditioner_inlet_temp=lambda i: 50.0 + i % 2)
    assert cleaning.detect_timestamps(df, P, order).count() == 0
    assert cleaning.detect_duplicates(df, P, CATALOG, order).count() == 0
    assert cleaning.detect_ranges(df, P, order).count() == 0
    assert cleaning.detect_frozen(df, P, CATALOG, order).count() == 0
    assert cleaning.detect_states(df, P, CATALOG, order).filter("finding_type <> 'sp_pv_drift'").count() == 0
    assert cleaning.detect_missing(df, P, CATALOG, order).count() == 0


def test_empty_table_has_no_findings(telemetry, order):
    out, found = cleaning.clean(telemetry(1).limit(0), CATALOG, P, order)
    assert found.count() == 0 and out.count() == 0


def test_unparseable_timestamp(telemetry, order):
    df = telemetry(10, times={3: None})
    (f,) = rows(cleaning.detect_timestamps(df, P, order), severity="critical")
    assert (f.finding_type, f.row_start, f.action_taken) == ("unparseable_timestamp", 3, "drop")
    assert values(cleaning.apply_timestamps(df, order), "_row") == list(range(9))


def test_order_gap_and_jump(telemetry, order):
    back = telemetry(5, times={3: at(30)})
    assert rows(cleaning.detect_timestamps(back, P, order), finding_type="non_monotonic")
    assert values(cleaning.apply_timestamps(back, order), "timestamp") == [at(0), at(30), at(60), at(120), at(240)]
    gap = telemetry(6, times={i: at(i * 60 + 200) for i in range(3, 6)})
    (f,) = cleaning.detect_timestamps(gap, P, order).collect()
    assert (f.finding_type, f.row_start, f.row_end) == ("gap", 2, 3)
    jump = telemetry(5, times={i: at(i * 60 + 7200) for i in range(2, 5)})
    assert [f.finding_type for f in cleaning.detect_timestamps(jump, P, order).collect()] == ["dst_jump"]
    exact = telemetry(3, times={2: at(180)})  # 120 s is no gap: it must be more
    assert cleaning.detect_timestamps(exact, P, order).count() == 0


def test_duplicate_timestamp(telemetry, order):
    df = telemetry(10, times={4: at(180)})
    (f,) = rows(cleaning.detect_duplicates(df, P, CATALOG, order), finding_type="duplicate_timestamp")
    assert f["count"] == 1 and cleaning.apply_duplicates(df, P, order).count() == 9


def test_three_equal_timestamps_all_go(telemetry, order):
    df = telemetry(8, times={3: at(120), 4: at(120)})
    out = cleaning.apply_duplicates(df, P, order)
    assert at(120) not in values(out, "timestamp") and out.count() == 5


def test_burst_keeps_the_median(telemetry, order):
    df = telemetry(8, times={i: at(60 + 0.5 * i) for i in range(2, 7)}, granulator_power=lambda i: float(i))
    (f,) = rows(cleaning.detect_duplicates(df, P, CATALOG, order), finding_type="plc_burst")
    assert f["count"] == 5
    assert values(cleaning.apply_duplicates(df, P, order), "granulator_power") == [0.0, 1.0, 4.0, 7.0]


def test_payload_runs(telemetry, order):
    df = telemetry(12, granulator_power=lambda i: [0, 1, 1, 1, 2, 3, 3, 3, 3, 3, 3, 4][i] * 1.0)
    found = rows(cleaning.detect_duplicates(df, P, CATALOG, order), finding_type="duplicate_payload")
    assert [(f.row_start, f.row_end) for f in found] == [(1, 3)]  # the run of six is longer than the window


@pytest.mark.parametrize("name, value", [("conditioner_inlet_temp", 999.0), ("steam_valve_pressure_me2", 5000.0), ("inlet_hopper_humidity", 250.0)])
def test_out_of_range(telemetry, order, name, value):
    df = telemetry(6, **{name: {2: value}})
    (f,) = cleaning.detect_ranges(df, P, order).collect()
    assert (f.finding_type, f.severity, f.column, f["count"]) == ("out_of_range", "critical", name, 1)
    assert values(cleaning.apply_ranges(df, P), name)[2] is None


def test_clip_and_fraction(telemetry, order):
    clip = policy("cleaning", {"physical_ranges": {"clip_soft_violations": True, "bounds": {k: dict(v) for k, v in P.physical_ranges.bounds.items()}}})
    df = telemetry(4, granulator_power={1: 500.0})
    assert values(cleaning.apply_ranges(df, clip), "granulator_power")[1] == 110.0
    assert values(cleaning.apply_ranges(df, P), "granulator_power")[1] is None
    half = telemetry(4, granulator_g2_running={1: 0.5})
    assert rows(cleaning.detect_ranges(half, P, order), finding_type="non_integer_in_integer_column")
    assert values(cleaning.apply_ranges(half, P), "granulator_g2_running")[1] is None


def test_frozen(telemetry, order):
    p = policy("cleaning", {"frozen_sensors": {"frozen_min_minutes": 5, "epsilon_rate_cols": ["granulator_production_rate"], "epsilon": 1e-6}})
    moving = {c: (lambda i: 50.0 + i % 2) for c in CATALOG.process(list(CATALOG.category))}
    df = telemetry(10, **{**moving, "conditioner_steam_loop_temp": lambda i: 80.0, "granulator_production_rate": lambda i: 5 + 1e-10 * i})
    found = {f.column: f for f in cleaning.detect_frozen(df, p, CATALOG, order).collect()}
    assert set(found) == {"conditioner_steam_loop_temp", "granulator_production_rate"}
    assert found["conditioner_steam_loop_temp"].severity == "critical" and found["granulator_production_rate"].severity == "important"
    assert values(cleaning.apply_frozen(df, p, CATALOG, order), "conditioner_steam_loop_temp") == [None] * 10
    off = {c: (lambda i: 0.0) for c in ("granulator_g2_running", "feeder_al2_running", "conditioner_me2_direct")}
    quiet = telemetry(10, **{**moving, **off, "feeder_hopper_temp": lambda i: 80.0})
    assert [f.severity for f in cleaning.detect_frozen(quiet, p, CATALOG, order).collect()] == ["aware"]


def test_frozen_runs_are_anchored(telemetry, order):
    p = policy("cleaning", {"frozen_sensors": {"frozen_min_minutes": 3, "epsilon_rate_cols": ["granulator_production_rate"], "epsilon": 1.0}})
    moving = {c: (lambda i: 50.0 + i % 2) for c in CATALOG.process(list(CATALOG.category))}
    drift = telemetry(6, **{**moving, "granulator_production_rate": lambda i: [0.0, 0.6, 0.9, 1.2, 1.8, 2.4][i]})
    found = cleaning.detect_frozen(drift, p, CATALOG, order).collect()
    assert [(f.row_start, f.row_end) for f in found] == [(0, 2)]  # 3 begins anew at 1.2; 5 is 1.2 away from it


def test_states(telemetry, order):
    off = telemetry(20, granulator_g2_running={5: 0.0, 6: 0.0})
    (f,) = rows(cleaning.detect_states(off, P, CATALOG, order), finding_type="off_with_production")
    assert (f.row_start, f.row_end, f["count"]) == (5, 6, 2) and json.loads(f.evidence)["rows"] == [5, 6]
    stop = telemetry(20, granulator_g2_alarm={i: 1.0 for i in range(2, 15)}, granulator_g2_running={i: 0.0 for i in range(2, 15)})
    (f,) = rows(cleaning.detect_states(stop, P, CATALOG, order), finding_type="alarm_with_extended_shutdown")
    assert f["count"] == 13
    drift = telemetry(40, granulator_power_sp=lambda i: 100.0)
    assert rows(cleaning.detect_states(drift, P, CATALOG, order), finding_type="sp_pv_drift", column="granulator_power")
    hot = telemetry(5, feeder_hopper_temp={1: 250.0})
    assert rows(cleaning.detect_states(hot, P, CATALOG, order), finding_type="alarm_off_but_hot")
    low = telemetry(5, granulator_power={1: 0.5})
    assert rows(cleaning.detect_states(low, P, CATALOG, order), finding_type="on_with_low_power")


def kinds(df, order):
    return [(f.column, f.finding_type, f.action_taken) for f in cleaning.detect_missing(df, P, CATALOG, order).collect()]


def test_missing_kinds(telemetry, order):
    name = "conditioner_inlet_temp"
    none = lambda a, b: {name: {i: None for i in range(a, b)}}
    off = {"granulator_g2_running": {i: 0.0 for i in (3, 4, 5)}, "feeder_al2_running": {i: 0.0 for i in (3, 4, 5)}}
    assert kinds(telemetry(10, **none(3, 6), **off), order) == [(name, "machine_off", "keep")]
    assert kinds(telemetry(40, **none(3, 37)), order) == [(name, "broken_sensor", "tag_only")]
    assert kinds(telemetry(10, **none(3, 6)), order) == [(name, "lost_communication", "interpolate_time")]
    assert kinds(telemetry(20, **none(3, 12)), order) == [(name, "unclassified_nan", "keep")]
    assert kinds(telemetry(30, **none(10, 13), granulator_g2_alarm={8: 1.0}), order) == [(name, "maintenance_window", "keep")]
    assert kinds(telemetry(5, batch_id={1: None}), order) == [("batch_id", "missing_by_design", "keep")]
    unknown = telemetry(6, granulator_g2_running={2: None})
    assert ("undeterminable_state", "drop") in [k[1:] for k in kinds(unknown, order)]
    assert cleaning.apply_missing(unknown, P, CATALOG, order).count() == 5


def test_interpolation_by_time(telemetry, order):
    df = telemetry(10, conditioner_inlet_temp=lambda i: None if 3 <= i < 6 else float(i))
    out = cleaning.apply_missing(df, P, CATALOG, order)
    assert values(out, "conditioner_inlet_temp") == [float(i) for i in range(10)]


def test_fill_modes(telemetry, order):
    """A short gap and a long one: the short one's fill reaches five rows into the long one, unless the mode is strict."""
    gone = [*range(3, 5), *range(20, 60)]
    df = telemetry(70, conditioner_inlet_temp=lambda i: None if i in gone else float(i))
    loose = values(cleaning.apply_missing(df, P, CATALOG, order), "conditioner_inlet_temp")
    assert loose[3:5] == [3.0, 4.0] and loose[20:25] == [20.0, 21.0, 22.0, 23.0, 24.0] and loose[25] is None
    strict = values(cleaning.apply_missing(df, P, CATALOG, order, "strict"), "conditioner_inlet_temp")
    assert strict[3:5] == [3.0, 4.0] and strict[20:60] == [None] * 40


def test_deltas_in_chunks(telemetry, order):
    df = telemetry(30, times={4: None, 9: None, 10: None, 20: at(5)})
    want = [tuple(r) for r in cleaning.deltas(df, order).orderBy("row").collect()]
    assert [tuple(r) for r in cleaning.deltas(df, order, 5).orderBy("row").collect()] == want
    assert want[0] == (0, None, None) and len(want) == 27 and (11, 8, 180.0) in want
