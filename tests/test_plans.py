from __future__ import annotations

import json

import pytest

from tideline.catalog import VARIABLES, Catalog, classification, dictionary, normal_unit
from tideline.findings import finding, frame, summary, write_json, write_markdown
from tideline.frames import Order
from tideline.plans import datasets, features
from tideline.policy import DATASETS, PolicyError, families_of, load_policy, policy
from tideline.stages import chain

CATALOG, COLUMNS = Catalog.default(), [v[0] for v in VARIABLES]


def test_column_counts():
    """The shipped policies make 323 and 566 columns besides the timestamp, and projections of 239, 294 and 46."""
    ts = features.plan_time_series(COLUMNS, CATALOG, policy("time_series"))
    wide = COLUMNS + [f.name for f in ts.features]
    eng = features.plan_engineering(wide, CATALOG, policy("engineering"))
    master = wide + [f.name for f in eng.features]
    assert (len(wide) - 1, len(master) - 1, len(set(master))) == (323, 566, 567)
    sizes = {k: len(datasets.select_columns(master, policy("datasets")[v], CATALOG, v)[0]) - 1 for k, v in datasets.PROJECTIONS.items()}
    assert sizes == {"anomaly": 239, "forecasting": 294, "energy": 46}
    chosen = {c for v in datasets.PROJECTIONS.values() for c in datasets.select_columns(master, policy("datasets")[v], CATALOG, v)[0]}
    assert len(chosen) == 550  # 549 and the timestamp
    assert {"total_alarms_60", "total_alarms_240", "temp_rise_conditioner", "temp_rise_feeder", "roller_gap_per_production"}.isdisjoint(chosen)


def test_policies(tmp_path):
    with pytest.raises(PolicyError):
        policy("engineering", {"stabilty": {}})
    with pytest.raises(PolicyError):
        policy("datasets", {"master_validation": {"max_nan_fraction_per_column": 2.0}})
    assert "nonsense" not in policy("cleaning", {"nonsense": 1})
    assert policy("cleaning", {}).timestamps.gap_factor == 2.0
    with pytest.raises(FileNotFoundError):
        load_policy("cleaning", str(tmp_path / "none.yaml"))
    file = tmp_path / "c.yaml"
    file.write_text("timestamps: {expected_period_s: 5}\n")
    assert load_policy("cleaning", str(file)).timestamps.expected_period_s == 5.0
    ts = policy("time_series")
    assert families_of(ts, "process_sensor", "granulator_production_rate").rolling_trend.windows == [5, 15, 60, 240]
    assert not families_of(ts, "process_sensor", "inlet_hopper_points").velocity.enabled
    assert families_of(policy("time_series", {}), "process_sensor", "x").pct_change.lags == [1, 5, 15]  # no entry: all families in full


def test_selectors():
    spec = policy("datasets", {"energy": {"include_patterns": ["_a$"], "include_columns": ["x", "gone"], "exclude_patterns": ["^x"], "exclude_columns": ["work_order"]}}).energy
    columns, found = datasets.select_columns(["timestamp", "work_order", "p_a", "x", "y"], spec, CATALOG, "energy")
    assert columns == ["timestamp", "p_a"]
    assert [f[2] for f in found] == ["include_patterns", "include_columns", "unmatched_include", "exclude", "projection_summary"]
    off = policy("datasets", {"energy": DATASETS["energy"] | {"enabled": False}}).energy
    assert datasets.select_columns(["x"], off, CATALOG, "energy")[0] == []


def test_catalogue(spark):
    assert CATALOG.of("granulator_g2_alarm") == "alarm" and CATALOG.of("conditioner_me2_direct") == "state_flag" and CATALOG.of("timestamp") is None
    assert normal_unit("ºC") == "C" and normal_unit("") == "-"
    assert dictionary(spark).count() == 37 and classification(spark, dictionary(spark)).count() == 37
    with pytest.raises(ValueError):
        classification(spark, dictionary(spark).limit(36))


def test_reports(spark, tmp_path):
    found = frame(spark, [finding("a", "normal", "k", "x", count=1, rows=(0, 3), many=list(range(50))), finding("a", "critical", "k2", "y", "col")])
    assert {(r["severity"], r["n"]) for r in summary(found).collect()} == {("normal", 1), ("critical", 1)}
    write_json(found, f"file://{tmp_path}/r.json")
    out = json.loads((tmp_path / "r.json").read_text())
    assert out["summary"] == {"a": {"normal": 1, "critical": 1}}
    (many,) = [f["evidence"]["many"] for f in out["findings_by_check"]["a"] if f["evidence"]]
    assert len(many) == 21 and many[10] == "..."
    write_markdown(found, f"file://{tmp_path}/r.md", "Title")
    text = (tmp_path / "r.md").read_text()
    assert text.startswith("# Title") and text.index("CRITICAL") < text.index("NORMAL")


def test_resample(series, order):
    df = series([0, 1, 2, 3, 4, 10, 20, 30, 40, 50], granulator_g2_alarm=[0, 0, 1, 0, 0, 0, 0, 0, 1, 0])
    out = features.resample(df, "5min", {"process_sensor": "mean", "alarm": "max"}, Catalog({"x": "Process", "granulator_g2_alarm": "State"}), order).orderBy("_row").collect()
    assert [(r.x, r.granulator_g2_alarm) for r in out] == [(2.0, 1.0), (30.0, 1.0)]
    from pyspark.sql import functions as F

    holes = features.resample(df.filter((F.col("_row") < 2) | (F.col("_row") > 7)), "1min", {"process_sensor": "mean"}, Catalog({"x": "Process"}), order)
    assert holes.count() == 10 and holes.filter("x is null").count() == 6
    with pytest.raises(ValueError):
        features.rule_seconds("soon")


def test_master_validation(spark, series, tmp_path):
    df = series([1, None, None], y=[1, 2, 3])
    master, found = datasets.validate_master(df, policy("datasets").master_validation)
    kinds = {r["finding_type"]: r for r in found.collect()}
    assert {"drop_skipped", "schema_lock_missing", "master_summary", "nan_budget_breach"} == set(kinds) and kinds["nan_budget_breach"]["column"] == "x"
    lock = f"file://{tmp_path}/lock.json"
    datasets.write_schema_lock(master, lock)
    assert [f[2] for f in datasets.schema_findings(master, lock)] == ["schema_lock_match"]
    assert [f[2] for f in datasets.schema_findings(master.drop("y").selectExpr("*", "1 as z"), lock)] == ["schema_added_columns", "schema_removed_columns"]


def test_whole_chain(telemetry):
    """All stages on 80 rows."""
    raw = telemetry(80, conditioner_inlet_temp=lambda i: 50.0 + i % 3)
    out = chain(raw, order=Order())
    assert {k: len([c for c in t.columns if c not in ("timestamp", "_row")]) for k, (t, _) in out.items()} == {"cleaning": 36, "time_series": 323, "engineering": 566, "master": 566, "anomaly": 239, "forecasting": 294, "energy": 46}
    assert out["master"][0].count() == 80
    severities = [r["severity"] for r in out["engineering"][1].collect()]
    assert severities.count("normal") > 0.8 * len(severities)
