"""Registered queries of the telemetry operators on the event table, and the SQL each is compared with.

Events serve as telemetry of many machines: the user is the entity, `value` a sensor
(null above 200, in a stretch of 0 to 40 rows, and for some rows at either end of a machine's record), event types are flags. Every query covers the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Catalog
from .frames import Feature, Order, add_features, micros, safe_div
from .functions.families import Families
from .operators import cleaning, profiling
from .plans import datasets, features
from .policy import policy

ORDER = Order(("user_id",), "timestamp", "_row")
CATALOG = Catalog(
    {"level": "Process", "aim": "Process", "loose": "Process", "x": "Process", "power": "Process", "sp": "Control", "granulator_g2_running": "State", "feeder_al2_running": "State", "granulator_g2_alarm": "State", "event_id": "Metadata"},
    {"x": "C", "level": "C"},
    {"aim": "temperature_forecasting"},
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry view of events."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    v = F.col("value")
    flag = lambda *kinds: F.when(F.col("event_type").isin(*kinds), 1.0).otherwise(0.0)
    own = e.select(
        "user_id", "event_id", F.col("ts").alias("timestamp"), v.alias("x"), (v / 5).alias("power"), F.floor(v / 125).cast("double").alias("level"), F.floor(v / 250).cast("double").alias("aim"), v.alias("loose"),
        F.lit(250.0).alias("sp"), flag("click", "view", "purchase").alias("granulator_g2_running"), flag("click", "purchase").alias("feeder_al2_running"), flag("error").alias("granulator_g2_alarm"),
    )
    row, user, n = F.col("_row"), F.col("user_id"), F.count("*").over(ORDER.whole)
    lost = (F.col("x") > 200) | ((row % 64 >= 12) & (row % 64 < 12 + user % 41)) | (row < user % 3) | (row >= n - user % 4)
    return ORDER.number(own, "event_id").withColumn("x", F.when(~lost, F.col("x")))


_M = """m AS (
    SELECT * EXCLUDE (n_) REPLACE (CASE WHEN NOT (x > 200 OR (r % 64 >= 12 AND r % 64 < 12 + user_id % 41) OR r < user_id % 3 OR r >= n_ - user_id % 4) THEN x END AS x) FROM (
    SELECT user_id, event_id, ts AS timestamp, value AS x, value / 5 AS power, floor(value / 125) AS level, floor(value / 250) AS aim, value AS loose, 250.0::DOUBLE AS sp,
        CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 1.0 ELSE 0.0 END::DOUBLE AS run, CASE WHEN event_type IN ('click', 'purchase') THEN 1.0 ELSE 0.0 END::DOUBLE AS run2, CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END::DOUBLE AS alarm,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r, count(*) OVER (PARTITION BY user_id) AS n_
    FROM events)
)"""
_O = "(PARTITION BY user_id ORDER BY timestamp, r)"
_CUM = "(PARTITION BY user_id ORDER BY timestamp, r ROWS UNBOUNDED PRECEDING)"


def _w(n: int, closed: str = "left") -> str:
    first, last = {"left": (n, 1), "right": (n - 1, 0), "both": (n, 0), "neither": (n - 1, 1)}[closed]
    return f"(PARTITION BY user_id ORDER BY timestamp, r ROWS BETWEEN {first} PRECEDING AND {f'{last} PRECEDING' if last else 'CURRENT ROW'})"


def _feature(name: str, make: Callable[[Families], list[Feature]], select: str, ctes: str = "", source: str = "m") -> None:
    """Register a query that adds features to the telemetry view and returns them rounded."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        own = make(Families(ORDER))
        return add_features(machines(spark, sf_dir), own, ORDER).select("event_id", *[F.round(F.col(f.name).cast("double"), 6).alias(f.name) for f in own])

    QUERIES[name] = run
    ORACLE[name] = f"WITH {_M}{ctes} SELECT event_id, {select} FROM {source}"


def _query(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLE[name] = f"WITH RECURSIVE {_M}{sql}" if sql[0] in " ," else sql  # sql that goes on from the telemetry view begins with a blank or comma
        return run

    return add


def _mp(value: str, counted: str, n: int, least: int, closed: str = "left") -> str:
    return f"CASE WHEN count({counted}) OVER {_w(n, closed)} >= {least} THEN {value} OVER {_w(n, closed)} END"


def _r(sql: str, name: str) -> str:
    return f"round({sql}, 6) AS {name}"


_feature("rolling_mean", lambda f: [f.rolling_mean("x", 5), f.rolling_mean("x", 15), f.rolling_mean("x", 60)], ", ".join(_r(_mp("avg(x)", "x", n, max(2, n // 4)), f"x_mean_{n}") for n in (5, 15, 60)))
_feature("rolling_std", lambda f: [f.rolling_std("x", 5), f.rolling_std("x", 15)], ", ".join(_r(_mp("stddev_samp(x)", "x", n, max(2, n // 4)), f"x_std_{n}") for n in (5, 15)))
for _closed in ("right", "both", "neither"):
    _feature(f"rolling_mean_{_closed}", lambda f, c=_closed: [f.rolling_mean("x", 5, c)], _r(_mp("avg(x)", "x", 5, 2, _closed), "x_mean_5"))
_D = f", d AS (SELECT *, x - lag(x) OVER {_O} AS dx, lag(x, 1) OVER {_O} AS x1, lag(x, 2) OVER {_O} AS x2, lag(x, 5) OVER {_O} AS x5, lag(x, 10) OVER {_O} AS x10 FROM m)"
_feature("rolling_trend", lambda f: [f.rolling_trend("x", 15)], _r(_mp("avg(dx)", "dx", 15, 3), "x_trend_15"), _D, "d")
_feature("lag_n", lambda f: [f.lag("x", 1), f.lag("x", 5)], f"{_r('x1', 'x_lag_1')}, {_r('x5', 'x_lag_5')}", _D, "d")
_feature("pct_change", lambda f: [f.pct_change("x", 1), f.pct_change("x", 5)], f"{_r('x / nullif(x1, 0) - 1', 'x_pctchg_1')}, {_r('x / nullif(x5, 0) - 1', 'x_pctchg_5')}", _D, "d")
_feature("velocity", lambda f: [f.velocity("x", 1)], _r("x - x1", "x_velocity_1"), _D, "d")
_feature("acceleration", lambda f: [f.acceleration("x", 1), f.acceleration("x", 5)], f"{_r('x - 2 * x1 + x2', 'x_accel_1')}, {_r('x - 2 * x5 + x10', 'x_accel_5')}", _D, "d")
_T = _D + ", t AS (SELECT *, CASE WHEN sign(x - x1) * sign(x1 - x2) < 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS turn FROM d)"
_feature("sign_changes", lambda f: [f.sign_changes("x", 15)], _r(_mp("sum(turn)", "*", 15, 3), "x_signchanges_15"), _T, "t")
_MS = f", s AS (SELECT *, {_mp('avg(x)', 'x', 15, 3)} AS m15, {_mp('stddev_samp(x)', 'x', 15, 3)} AS s15, {_mp('stddev_samp(x)', 'x', 5, 2)} AS s5, {_mp('median(x)', 'x', 15, 3)} AS med15, CASE WHEN count(x) OVER {_w(15)} = count(*) OVER {_w(15)} AND count(x) OVER {_w(15)} >= 3 THEN mad(x) OVER {_w(15)} END AS mad15 FROM m)"
_feature("cv", lambda f: [f.cv("x", 15)], _r("CASE WHEN abs(m15) >= 1e-6 THEN s15 / abs(m15) END", "x_cv_15"), _MS, "s")
_feature("std_ratio", lambda f: [f.std_ratio("x", 5, 15)], _r("CASE WHEN s15 >= 1e-6 THEN s5 / s15 END", "x_stdratio_5_15"), _MS, "s")
_feature("rolling_range", lambda f: [f.rolling_range("x", 15)], _r(f"CASE WHEN count(x) OVER {_w(15)} >= 3 THEN max(x) OVER {_w(15)} - min(x) OVER {_w(15)} END", "x_range_15"))
_feature("rolling_mad", lambda f: [f.mad("x", 15)], _r("mad15", "x_mad_15"), _MS, "s")
_feature("rolling_z", lambda f: [f.rolling_z("x", 15)], _r("CASE WHEN s15 >= 1e-6 THEN (x - m15) / s15 END", "x_z_15"), _MS, "s")
_feature("robust_z", lambda f: [f.robust_z("x", 15)], _r("CASE WHEN abs(1.4826 * mad15) >= 1e-6 THEN (x - med15) / (1.4826 * mad15) END", "x_robust_z_15"), _MS, "s")
_feature("global_z", lambda f: [f.global_z("x")], _r("CASE WHEN stddev_samp(x) OVER (PARTITION BY user_id) >= 1e-6 THEN (x - avg(x) OVER (PARTITION BY user_id)) / stddev_samp(x) OVER (PARTITION BY user_id) END", "x_z_global"))
_feature("runfrac", lambda f: [f.runfrac("granulator_g2_running", 15)], _r(_mp("avg(run)", "*", 15, 3), "granulator_g2_running_runfrac_15"))
_feature("tsla", lambda f: [f.tsla("granulator_g2_alarm")], _r(f"(r - max(CASE WHEN alarm <> 0 THEN r END) OVER {_CUM})::DOUBLE", "granulator_g2_alarm_tsla"))
_E = f", g AS (SELECT *, greatest(alarm - coalesce(lag(alarm) OVER {_O}, alarm), 0) AS up, run > 0 OR run2 > 0 AS busy FROM m), h AS (SELECT *, lag(busy) OVER {_O} AS was FROM g), k AS (SELECT *, CASE WHEN busy AND NOT coalesce(was, FALSE) THEN r END AS started, CASE WHEN busy AND was = FALSE THEN 1 ELSE 0 END AS edge FROM h)"
_feature("edges", lambda f: [f.edges("granulator_g2_alarm", 15)], _r(_mp("sum(up)", "*", 15, 3), "granulator_g2_alarm_edges_15"), _E, "k")
_RUN, _ALARM = ["granulator_g2_running", "feeder_al2_running"], ["granulator_g2_alarm"]
_feature("time_since_restart", lambda f: [f.time_since_machine_off(_RUN)], f"(r - max(started) OVER {_CUM})::DOUBLE AS time_since_machine_off", _E, "k")
_feature("n_running", lambda f: [f.n_running(_RUN)], "run + run2 AS n_subsystems_running", _E, "k")
_feature("cumulative_starts", lambda f: [f.cumulative_starts(_RUN)], f"(sum(edge) OVER {_CUM})::DOUBLE AS cumulative_starts", _E, "k")
_feature("total_alarms", lambda f: [f.total_alarms(_ALARM, 15)], _r(_mp("sum(up)", "*", 15, 3), "total_alarms_15"), _E, "k")
_feature("time_since_any_alarm", lambda f: [f.time_since_any_alarm(_ALARM)], f"(r - max(CASE WHEN alarm > 0 THEN r END) OVER {_CUM})::DOUBLE AS time_since_any_alarm")
_feature("alarm_while_running", lambda f: [f.any_alarm_while_running(["granulator_g2_alarm"], ["aim"])], "CASE WHEN alarm > 0 AND aim > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS any_alarm_while_running")
_feature("ratio_eps", lambda f: [Feature("ratio", safe_div(F.col("x"), F.col("level")))], _r("CASE WHEN abs(level) >= 1e-6 THEN x / level END", "ratio"))
_feature("column_difference", lambda f: [Feature("diff", F.col("power") - F.col("x"))], _r("power - x", "diff"))
_feature("column_scale", lambda f: [Feature("scaled", F.col("x") * 0.001)], _r("x * 0.001", "scaled"))
_feature("cum_energy", lambda f: [f.cumulative_energy("x", 1 / 60)], _r(f"sum(coalesce(x, 0) / 60) OVER {_CUM}", "x_cumkwh"))
_feature("cum_energy_daily", lambda f: [f.cumulative_energy_daily("x", 1 / 60)], _r("sum(coalesce(x, 0) / 60) OVER (PARTITION BY user_id, timestamp::DATE ORDER BY timestamp, r ROWS UNBOUNDED PRECEDING)", "x_cumkwh_day"))
_feature("energy_per_kg", lambda f: [f.energy_per_kg("x", "level", 15, 1 / 60)], _r(f"CASE WHEN count(*) OVER {_w(15)} >= 3 AND sum(level) OVER {_w(15)} >= 1e-6 THEN sum(coalesce(x, 0)) OVER {_w(15)} / 60 / (sum(level) OVER {_w(15)}) END", "x_energy_per_kg_15"))


# cleaning

_P = policy("cleaning", {"timestamps": {"expected_period_s": 3600.0, "gap_factor": 24.0, "max_legal_jump_s": 172800.0}, "duplicates": {"burst_max_delta_s": 14400.0}, "frozen_sensors": {"frozen_min_minutes": 3, "epsilon_rate_cols": ["loose"], "epsilon": 120.0}, "missing_values": {"broken_sensor_min_run": 2, "interpolation_max_run": 1, "alarm_alignment_window_min": 1}, "physical_ranges": {"bounds": {"x": {"min": 20.0, "max": 300.0, "severity": "critical"}, "power": {"min": 10.0, "max": 80.0, "severity": "important"}, "level": {"min": 1.0, "max": 3.0, "severity": "aware"}}}, "state_consistency": {"alarm_shutdown_window_min": 1, "sp_pv_max_drift_pct": 40.0, "sp_pv_drift_min_minutes": 3}})
_FOUND = ["finding_type", "severity", "column", "row_start", "row_end", "count"]


def _found(df: DataFrame) -> DataFrame:
    return df.select(*_FOUND)


@_query("gaps_jumps", f""", d AS (SELECT r, lag(r) OVER {_O} AS r0, epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER {_O} AS us FROM m)
    SELECT CASE WHEN us > 172800000000 THEN 'dst_jump' ELSE 'gap' END AS finding_type, 'important' AS severity, 'timestamp' AS "column", r0 AS row_start, r AS row_end, 1 AS count FROM d WHERE us > 86400000000""")
def _gaps(spark, sf_dir):
    return _found(cleaning.detect_timestamps(machines(spark, sf_dir), _P, ORDER))


_ARRIVED = "a AS (SELECT user_id, event_id, CASE WHEN value <= 120 THEN CASE WHEN event_id % 17 = 0 THEN ts - INTERVAL 3 DAY ELSE ts END END AS ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS r FROM events)"


def _arrived(spark, sf_dir):
    """Events as they arrive: some timestamps can't be read, some lie days before those of their neighbours."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts = F.when(F.col("event_id") % 17 == 0, F.col("ts") - F.expr("INTERVAL 3 DAY")).otherwise(F.col("ts"))
    own = e.select("user_id", "event_id", F.when(F.col("value") <= 120, ts).alias("timestamp"))
    return own.withColumn("_row", (F.row_number().over(Order(("user_id",), "event_id", "event_id").by_row) - 1).cast("long"))


@_query("timestamp_order", f"""WITH {_ARRIVED} SELECT 'unparseable_timestamp' AS finding_type, min(r) AS row_start, max(r) AS row_end, count(*) AS count FROM a WHERE ts IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'non_monotonic', min(r), max(r), count(*) FROM (SELECT r, ts < lag(ts) OVER (PARTITION BY user_id ORDER BY r) AS back FROM a WHERE ts IS NOT NULL) WHERE back HAVING count(*) > 0""")
def _arrival(spark, sf_dir):
    found = cleaning.detect_timestamps(_arrived(spark, sf_dir), _P, ORDER)
    return found.filter(F.col("severity") == "critical").select("finding_type", "row_start", "row_end", "count")


@_query("timestamp_apply", f"""WITH {_ARRIVED} SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, r) - 1 AS _row FROM a WHERE ts IS NOT NULL""")
def _timestamps(spark, sf_dir):
    return cleaning.apply_timestamps(_arrived(spark, sf_dir), ORDER).select("event_id", "_row")


def _hourly(spark, sf_dir):
    """Timestamps cut to days, so that some repeat."""
    return machines(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp"))


_H = ", q AS (SELECT * REPLACE (date_trunc('day', timestamp) AS timestamp) FROM m)"


@_query("dup_timestamp", _H + ", n AS (SELECT event_id, row_number() OVER (PARTITION BY user_id, timestamp ORDER BY r) AS k FROM q) SELECT event_id, k > 1 AS duplicate_timestamp FROM n")
def _dup_timestamp(spark, sf_dir):
    return cleaning.mark_duplicates(_hourly(spark, sf_dir), _P, ORDER, []).select("event_id", "duplicate_timestamp")


_B = f""", d AS (SELECT *, coalesce(epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER {_O} < 14400000000, FALSE) AS close FROM m), i AS (SELECT *, sum(CASE WHEN close THEN 0 ELSE 1 END) OVER {_CUM} AS island FROM d), b AS (SELECT *, count(*) OVER (PARTITION BY user_id, island) AS n, r - min(r) OVER (PARTITION BY user_id, island) AS p FROM i)"""


@_query("plc_burst", _B + " SELECT event_id, n >= 3 AND p <> n // 2 AS burst_drop, n AS burst_size FROM b")
def _burst(spark, sf_dir):
    return cleaning.mark_duplicates(machines(spark, sf_dir), _P, ORDER, []).select("event_id", "burst_drop", F.col("burst_size").cast("long").alias("burst_size"))


@_query("duplicates_apply", _B + f", z AS (SELECT * FROM b WHERE NOT (n >= 3 AND p <> n // 2)) SELECT event_id, row_number() OVER {_O} - 1 AS _row FROM z")
def _dup_apply(spark, sf_dir):
    return cleaning.apply_duplicates(machines(spark, sf_dir), _P, ORDER).select("event_id", "_row")


@_query("dup_payload", f""", d AS (SELECT *, coalesce(level = lag(level) OVER {_O} AND run = lag(run) OVER {_O}, FALSE) AS same FROM m), i AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER {_CUM} AS island FROM d)
    SELECT min(r) AS payload_first, max(r) AS payload_last FROM i GROUP BY user_id, island HAVING count(*) BETWEEN 2 AND 5""")
def _payload(spark, sf_dir):
    own = cleaning.mark_duplicates(machines(spark, sf_dir), _P, ORDER, ["level", "granulator_g2_running"])
    n = F.col("payload_last") - F.col("payload_first") + 1
    return own.filter((F.col("_row") == F.col("payload_first")) & n.between(2, 5)).select("payload_first", "payload_last")


@_query("range_findings", """, f AS (
    SELECT 'x' AS "column", 'critical' AS severity, 'mask_nan' AS action_taken, r, x AS v FROM m WHERE x < 20 OR x > 300
    UNION ALL SELECT 'power', 'important', 'mask_nan', r, power FROM m WHERE power < 10 OR power > 80
    UNION ALL SELECT 'level', 'aware', 'tag_only', r, level FROM m WHERE level < 1 OR level > 3)
    SELECT 'out_of_range' AS finding_type, severity, "column", action_taken, min(r) AS row_start, max(r) AS row_end, count(*) AS count FROM f GROUP BY 1, 2, 3, 4""")
def _ranges(spark, sf_dir):
    return cleaning.detect_ranges(machines(spark, sf_dir), _P, ORDER).select(*_FOUND, "action_taken")


@_query("range_mask", """ SELECT event_id, CASE WHEN x BETWEEN 20 AND 300 THEN x END AS x, CASE WHEN power BETWEEN 10 AND 80 THEN power END AS power, level FROM m""")
def _mask(spark, sf_dir):
    return cleaning.apply_ranges(machines(spark, sf_dir), _P).select("event_id", "x", "power", "level")


@_query("range_clip", """ SELECT event_id, CASE WHEN x BETWEEN 20 AND 300 THEN x END AS x, least(greatest(power, 10), 80) AS power FROM m""")
def _clip(spark, sf_dir):
    p = policy("cleaning", {"physical_ranges": {"clip_soft_violations": True, "bounds": {k: dict(v) for k, v in _P.physical_ranges.bounds.items()}}})
    return cleaning.apply_ranges(machines(spark, sf_dir), p).select("event_id", "x", "power")


@_query("non_integer", """ SELECT 'non_integer_in_integer_column' AS finding_type, 'critical' AS severity, 'half' AS "column", min(r) AS row_start, max(r) AS row_end, count(*) AS count FROM m WHERE level / 2 <= 1 AND level / 2 <> round(level / 2)""")
def _non_integer(spark, sf_dir):
    p = policy("cleaning", {"physical_ranges": {"bounds": {"half": {"min": 0.0, "max": 1.0, "severity": "critical", "integer": True}}}})
    m = machines(spark, sf_dir).withColumn("half", F.col("level") / 2)
    return _found(cleaning.detect_ranges(m, p, ORDER)).filter("finding_type <> 'out_of_range'")


def _frozen_sql(col: str) -> str:
    return f"SELECT user_id, r, run, run2, '{col}' AS c, {col} AS v, sum(CASE WHEN {col} = prev_{col} THEN 0 ELSE 1 END) OVER {_CUM} AS island FROM d"


_FZ = f""", d AS (SELECT *, lag(level) OVER {_O} AS prev_level, lag(aim) OVER {_O} AS prev_aim, lag(x) OVER {_O} AS prev_x, lag(power) OVER {_O} AS prev_power FROM m), i AS (SELECT *, r AS timestamp FROM ({' UNION ALL '.join(_frozen_sql(c) for c in ('level', 'aim', 'x', 'power'))}))"""


@_query("frozen_exact", _FZ + """ SELECT 'frozen_run' AS finding_type, CASE WHEN c = 'aim' THEN 'critical' WHEN max(run + run2) > 0 THEN 'important' ELSE 'aware' END AS severity, c AS "column", min(r) AS row_start, max(r) AS row_end, count(*) AS count
    FROM i WHERE v IS NOT NULL GROUP BY user_id, c, island HAVING count(*) >= 3""")
def _frozen(spark, sf_dir):
    return _found(cleaning.detect_frozen(machines(spark, sf_dir).drop("loose"), _P, CATALOG, ORDER))


@_query("frozen_mask", _FZ + """, z AS (SELECT user_id, r, count(*) OVER (PARTITION BY user_id, island) AS n FROM i WHERE c = 'aim') SELECT event_id, CASE WHEN n < 3 THEN aim END AS aim FROM m JOIN z USING (user_id, r)""")
def _frozen_mask(spark, sf_dir):
    return cleaning.apply_frozen(machines(spark, sf_dir).drop("loose"), _P, CATALOG, ORDER).select("event_id", "aim")


@_query("frozen_epsilon", """, walk AS (
        SELECT user_id, r, loose AS anchor, r AS first FROM m WHERE r = 0
        UNION ALL SELECT m.user_id, m.r, CASE WHEN abs(m.loose - w.anchor) < 120 THEN w.anchor ELSE m.loose END, CASE WHEN abs(m.loose - w.anchor) < 120 THEN w.first ELSE m.r END FROM walk w JOIN m ON m.user_id = w.user_id AND m.r = w.r + 1
    ) SELECT 'loose' AS "column", first AS row_start, max(r) AS row_end, count(*) AS count FROM walk GROUP BY user_id, first HAVING count(*) >= 3""")
def _frozen_loose(spark, sf_dir):
    own = machines(spark, sf_dir).drop("level", "aim", "x", "power")
    return cleaning.detect_frozen(own, _P, CATALOG, ORDER).select("column", "row_start", "row_end", "count")


def _states(spark, sf_dir, kind: str):
    m = machines(spark, sf_dir).withColumnsRenamed({"power": "granulator_power", "x": "granulator_production_rate"})
    own = Catalog(CATALOG.category, {"level": "C"}, {})
    p = policy("cleaning", {"state_consistency": {**_P.state_consistency, "min_power_pct": 30.0, "hot_temperature_threshold_c": 2.0}})
    found = cleaning.detect_states(m, p, own, ORDER, [("granulator_g2_alarm", "feeder_al2_running")], [("sp", "granulator_production_rate")])
    return found.filter(F.col("finding_type") == kind).select("row_start", "row_end", "count")


_ROWS = " SELECT min(r) AS row_start, max(r) AS row_end, count(*) AS count FROM m WHERE {} GROUP BY user_id"
for _name, _where in {"off_with_production": "run = 0 AND coalesce(x, 0) > 0.1", "on_with_low_power": "run = 1 AND power < 30", "alarm_off_but_hot": "alarm = 0 AND level > 2"}.items():
    _query(_name, _ROWS.format(_where))(lambda spark, sf_dir, kind=_name: _states(spark, sf_dir, kind))
_query("alarm_extended_shutdown", f""", d AS (SELECT *, coalesce(alarm = lag(alarm) OVER {_O}, FALSE) AS same FROM m), i AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER {_CUM} AS island FROM d)
    SELECT min(r) AS row_start, max(r) AS row_end, count(*) FILTER (run2 = 0) AS count FROM i WHERE alarm = 1 GROUP BY user_id, island HAVING count(*) FILTER (run2 = 0) > 1""")(lambda spark, sf_dir: _states(spark, sf_dir, "alarm_with_extended_shutdown"))
_query("sp_pv_drift", f""", d AS (SELECT *, coalesce(abs(sp - x) > 0.4 * sp, FALSE) AS off FROM m), e AS (SELECT *, coalesce(off = lag(off) OVER {_O}, FALSE) AS same FROM d), i AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER {_CUM} AS island FROM e)
    SELECT min(r) AS row_start, max(r) AS row_end, count(*) AS count FROM i WHERE off GROUP BY user_id, island HAVING count(*) > 3""")(lambda spark, sf_dir: _states(spark, sf_dir, "sp_pv_drift"))

_NR = f""", c AS (SELECT *, lag(alarm) OVER {_O} AS was FROM m), s AS (SELECT *, sum(CASE WHEN alarm > was THEN 1 ELSE 0 END) OVER {_CUM} AS up, sum(CASE WHEN alarm < was THEN 1 ELSE 0 END) OVER {_CUM} AS down, max(r) OVER (PARTITION BY user_id) AS last, r - row_number() OVER (PARTITION BY user_id, x IS NULL ORDER BY r) AS island FROM c),
    n AS (SELECT user_id, min(r) AS a, max(r) AS b, count(*) AS n, min(CASE WHEN run = 0 AND run2 = 0 THEN 1 ELSE 0 END) AS off, max(greatest(run, run2)) AS running, any_value(last) AS last FROM s WHERE x IS NULL GROUP BY user_id, island),
    k AS (SELECT n.*, hi.up > lo.up AND hi.down > lo.down AS aligned FROM n JOIN s lo ON lo.user_id = n.user_id AND lo.r = greatest(n.a - 1, 0) JOIN s hi ON hi.user_id = n.user_id AND hi.r = least(n.b + 1, n.last)),
    z AS (SELECT *, CASE WHEN off = 1 THEN 'machine_off' WHEN aligned THEN 'maintenance_window' WHEN n > 2 AND running = 1 THEN 'broken_sensor' WHEN n <= 1 AND running = 1 THEN 'lost_communication' WHEN n = 1 THEN 'continuous_sensor' ELSE 'unclassified_nan' END AS finding_type FROM k)"""


@_query("nan_classify", _NR + """ SELECT finding_type, 'x' AS "column", a, b, n FROM z""")
def _nan_classify(spark, sf_dir):
    return cleaning.null_runs(machines(spark, sf_dir), _P, CATALOG, ORDER).select("finding_type", "column", "a", "b", "n")


_IP = ", a AS (SELECT *, max(CASE WHEN x IS NOT NULL THEN r END) OVER (PARTITION BY user_id ORDER BY r ROWS UNBOUNDED PRECEDING) AS r0, min(CASE WHEN x IS NOT NULL THEN r END) OVER (PARTITION BY user_id ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r1 FROM m), j AS (SELECT a.*, p.x AS x0, p.timestamp AS t0, q.x AS x1, q.timestamp AS t1 FROM a LEFT JOIN m p ON p.user_id = a.user_id AND p.r = r0 LEFT JOIN m q ON q.user_id = a.user_id AND q.r = r1)"


@_query("interpolate_time", _IP + " SELECT event_id, round(CASE WHEN x IS NOT NULL THEN x WHEN r - r0 <= 2 THEN coalesce(x0 + (x1 - x0) * ((epoch_us(timestamp) - epoch_us(t0))::DOUBLE / (epoch_us(t1) - epoch_us(t0))::DOUBLE), x0) END, 6) AS x FROM j")
def _interpolate(spark, sf_dir):
    return cleaning.interpolated(machines(spark, sf_dir), {"x": 2}, ORDER).select("event_id", F.round("x", 6).alias("x"))


@_query("missing_apply", _IP + _NR.replace(", c AS", ", c AS", 1) + ", kk AS (SELECT count(*) AS k FROM z WHERE finding_type = 'lost_communication' AND b < (SELECT count(*) FROM m)), ff AS (SELECT count(*) AS f FROM z WHERE finding_type = 'continuous_sensor' AND b < (SELECT count(*) FROM m)), y AS (SELECT j.event_id, j.user_id, j.timestamp, j.r, CASE WHEN x IS NOT NULL THEN x WHEN r - r0 <= 1 * k THEN coalesce(x0 + (x1 - x0) * ((epoch_us(timestamp) - epoch_us(t0))::DOUBLE / (epoch_us(t1) - epoch_us(t0))::DOUBLE), x0) END AS x, f FROM j, kk, ff) SELECT event_id, round(CASE WHEN f > 0 THEN coalesce(x, lag(x) OVER " + _O + ") ELSE x END, 6) AS x FROM y")
def _missing_apply(spark, sf_dir):
    return cleaning.apply_missing(machines(spark, sf_dir), _P, CATALOG, ORDER).select("event_id", F.round("x", 6).alias("x"))


@_query("ffill_1", f" SELECT event_id, coalesce(x, lag(x) OVER {_O}) AS x FROM m")
def _ffill(spark, sf_dir):
    m = machines(spark, sf_dir)
    return m.select("event_id", F.coalesce("x", F.lag("x").over(ORDER.by_row)).alias("x"))


# time index and resampling


@_query("first_of_timestamp", _H + f", n AS (SELECT *, row_number() OVER (PARTITION BY user_id, timestamp ORDER BY r) AS k FROM q), o AS (SELECT * FROM n WHERE k = 1) SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY timestamp, r) - 1 AS _row FROM o")
def _first(spark, sf_dir):
    return features.first_of_each_timestamp(_hourly(spark, sf_dir), ORDER).select("event_id", "_row")


@_query("resample_dense", """, b AS (SELECT *, time_bucket(INTERVAL 1 DAY, timestamp) AS t FROM m), g AS (SELECT user_id, t, avg(x) AS x, max(alarm) AS alarm, arg_max(sp, r) FILTER (sp IS NOT NULL) AS sp FROM b GROUP BY 1, 2),
    e AS (SELECT user_id, min(t) AS a, max(t) AS z FROM g GROUP BY 1), s AS (SELECT user_id, unnest(generate_series(a, z, INTERVAL 1 DAY)) AS t FROM e)
    SELECT s.user_id, epoch(s.t)::BIGINT AS bin, round(x, 6) AS x, alarm AS granulator_g2_alarm, sp FROM s LEFT JOIN g ON g.user_id = s.user_id AND g.t = s.t""")
def _resample(spark, sf_dir):
    own = machines(spark, sf_dir).select("user_id", "timestamp", "x", "granulator_g2_alarm", "sp", "_row")
    out = features.resample(own, "1D", policy("time_series").resampling.aggregations, CATALOG, ORDER)
    return out.select("user_id", F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("bin"), F.round("x", 6).alias("x"), "granulator_g2_alarm", "sp")


# datasets


@_query("nan_budget", """ SELECT 'nan_budget_breach' AS finding_type, 'x' AS "column", 'important' AS severity, 1 AS count FROM m HAVING avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) > 0.01""")
def _budget(spark, sf_dir):
    return datasets.null_budget_findings(machines(spark, sf_dir), 0.01).select("finding_type", "column", "severity", "count")


@_query("timestamp_checks", f"""WITH {_ARRIVED}, o AS (SELECT ts, ts < lag(ts) OVER (ORDER BY event_id) AS back FROM a WHERE ts IS NOT NULL)
    SELECT 'timestamp_nat' AS finding_type, count(*) AS count FROM a WHERE ts IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'non_monotonic_timestamps', 1 WHERE EXISTS (SELECT 1 FROM a WHERE ts IS NULL) OR EXISTS (SELECT 1 FROM o WHERE back)
    UNION ALL SELECT 'duplicate_timestamps', sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM a GROUP BY ts) HAVING sum(n - 1) > 0""")
def _ts_checks(spark, sf_dir):
    return datasets.timestamp_findings(_arrived(spark, sf_dir).withColumn("_row", F.col("event_id"))).select("finding_type", "count")


@_query("timestamp_unordered", """WITH a AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN ts - INTERVAL 3 DAY ELSE ts END AS ts FROM events) SELECT 'non_monotonic_timestamps' AS finding_type, 1 AS count WHERE EXISTS (SELECT 1 FROM (SELECT ts < lag(ts) OVER (ORDER BY event_id) AS back FROM a) WHERE back)""")
def _ts_unordered(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts = F.when(F.col("event_id") % 17 == 0, F.col("ts") - F.expr("INTERVAL 3 DAY")).otherwise(F.col("ts"))
    return datasets.timestamp_findings(e.select(ts.alias("timestamp"), F.col("event_id").alias("_row")), unique=False).select("finding_type", "count")


@_query("projection", " SELECT event_id, x, power, level FROM m")
def _projection(spark, sf_dir):
    spec = policy("datasets", {"energy": {"include_patterns": ["^pow"], "include_categories": ["process_sensor"], "exclude_columns": ["aim", "loose"]}}).energy
    return datasets.project(machines(spark, sf_dir), spec, CATALOG, "energy")[0].select("event_id", "x", "power", "level")


# profiling

_ALL = Order((), "timestamp", "event_id")
_S = ", d AS (SELECT event_id, (epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (ORDER BY event_id)) / 1e6 AS delta FROM m)"


@_query("cadence_counts", _S + " SELECT count(*) AS rows, 0 AS bad_ts, count(*) FILTER (delta < 0) AS out_of_order, count(*) FILTER (delta = 0) AS duplicate_ts, count(*) FILTER (delta > 120) AS gaps, count(delta) AS n_deltas FROM d")
def _counts(spark, sf_dir):
    return profiling.cadence_counts(machines(spark, sf_dir), _ALL)


@_query("cadence_stats", _S + " SELECT round(median(delta), 6) AS median_s, round(avg(delta), 3) AS mean_s, round(stddev_samp(delta), 3) AS stdev_s, min(delta) AS min_s, max(delta) AS max_s FROM d")
def _stats(spark, sf_dir):
    s = profiling.cadence_stats(machines(spark, sf_dir), _ALL)
    return s.select(F.round("median_s", 6).alias("median_s"), F.round("mean_s", 3).alias("mean_s"), F.round("stdev_s", 3).alias("stdev_s"), "min_s", "max_s")


@_query("nearest_rank_percentiles", """, o AS (SELECT loose, row_number() OVER (ORDER BY loose) - 1 AS i, count(*) OVER () AS n FROM m), p(share) AS (VALUES (0.01), (0.25), (0.75), (0.99)) SELECT share::DOUBLE AS share, loose AS value FROM o, p WHERE i = round_even(share * (n - 1), 0)""")
def _ranks(spark, sf_dir):
    return profiling.nearest_ranks(machines(spark, sf_dir), "loose", [0.01, 0.25, 0.75, 0.99])


@_query("cadence_drift", _S + ", n AS (SELECT delta, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM d WHERE delta IS NOT NULL) SELECT least(i // (n // 10), 9)::INT AS segment, count(*) AS n, round(median(delta), 6) AS median_s, round(avg(delta), 3) AS mean_s FROM n GROUP BY 1")
def _drift(spark, sf_dir):
    return profiling.cadence_drift(machines(spark, sf_dir), _ALL).select("segment", "n", F.round("median_s", 6).alias("median_s"), F.round("mean_s", 3).alias("mean_s"))


@_query("coverage", " SELECT count(*) AS rows, floor((max(epoch_us(timestamp)) - min(epoch_us(timestamp))) / 1e6 / 60)::BIGINT + 1 AS expected, round(100.0 * count(*) / (floor((max(epoch_us(timestamp)) - min(epoch_us(timestamp))) / 1e6 / 60) + 1), 3)::DOUBLE AS coverage_pct FROM m")
def _coverage(spark, sf_dir):
    return profiling.coverage(machines(spark, sf_dir), _ALL)


_PROFILED = ["event_id", "x", "power", "level", "aim", "loose", "sp", "granulator_g2_running", "feeder_al2_running", "granulator_g2_alarm"]


@_query("longest_null_run", _NR + f""", u AS (SELECT unnest({_PROFILED}) AS "column"), w AS (SELECT sum(n)::BIGINT AS nulls, max(n) AS longest FROM n)
    SELECT "column", CASE WHEN "column" = 'x' THEN coalesce(nulls, 0) ELSE 0 END AS nulls, CASE WHEN "column" = 'x' THEN round(100.0 * coalesce(nulls, 0) / (SELECT count(*) FROM m), 3) ELSE 0 END::DOUBLE AS pct, CASE WHEN "column" = 'x' THEN coalesce(longest, 0) ELSE 0 END AS longest FROM u, w""")
def _null_profile(spark, sf_dir):
    return profiling.null_profile(machines(spark, sf_dir), ORDER)


@_query("quartile_range", ", k AS (SELECT loose, row_number() OVER (ORDER BY loose) - 1 AS i, count(*) OVER () AS n FROM m WHERE loose IS NOT NULL), q AS (SELECT max(loose) FILTER (i = round_even(0.25 * (n - 1), 0)) AS p25, max(loose) FILTER (i = round_even(0.75 * (n - 1), 0)) AS p75 FROM k) SELECT p25, p75, p75 - p25 AS iqr FROM q")
def _iqr(spark, sf_dir):
    return profiling.quartile_range(machines(spark, sf_dir), "loose")


@_query("co_missing", " SELECT count(*) FILTER (x IS NULL OR power IS NULL) AS any_null, count(*) FILTER (x IS NULL AND power IS NULL) AS all_null FROM m")
def _co_missing(spark, sf_dir):
    return profiling.co_missing(machines(spark, sf_dir), ["x", "power"])


@_query("largest_gaps", _S + " SELECT event_id AS row, delta FROM d WHERE delta > 120 ORDER BY delta DESC, event_id LIMIT 10")
def _largest(spark, sf_dir):
    return profiling.largest_gaps(machines(spark, sf_dir), _ALL)


@_query("gap_excess", _S + " SELECT round(coalesce(sum(delta - 60), 0), 3) AS excess_s FROM d WHERE delta > 120")
def _excess(spark, sf_dir):
    return profiling.gap_excess(machines(spark, sf_dir), _ALL).select(F.round("excess_s", 3).alias("excess_s"))


@_query("quality_checklist")
def _checklist(spark, sf_dir):
    return profiling.quality_checklist(machines(spark, sf_dir), ["x", "power"], _ALL)


@_query("state_fractions", " SELECT 'granulator_g2_running' AS flag, round(avg(run) * 100, 6) AS pct FROM m UNION ALL SELECT 'granulator_g2_alarm', round(avg(alarm) * 100, 6) FROM m")
def _fractions(spark, sf_dir):
    return profiling.state_fractions(machines(spark, sf_dir), ["granulator_g2_running", "granulator_g2_alarm"]).select("flag", F.round("pct", 6).alias("pct"))


@_query("active_daily", " SELECT epoch(date_trunc('day', timestamp))::BIGINT AS day, round(avg(CASE WHEN run > 0 OR run2 > 0 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS active_fraction, sum(alarm) AS granulator_g2_alarm_minutes FROM m GROUP BY 1")
def _daily(spark, sf_dir):
    m = machines(spark, sf_dir)
    return profiling.daily_activity(m, profiling.is_active(m), ["granulator_g2_alarm"]).select(F.unix_seconds(F.col("day").cast("timestamp")).alias("day"), F.round("active_fraction", 6).alias("active_fraction"), "granulator_g2_alarm_minutes")


@_query("describe_active", """, u AS (SELECT 'x' AS "column", x AS v FROM m WHERE run > 0 OR run2 > 0 UNION ALL SELECT 'power', power FROM m WHERE run > 0 OR run2 > 0) SELECT "column", count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max, round(stddev_samp(v) / avg(v), 6) AS cv FROM u GROUP BY 1""")
def _describe(spark, sf_dir):
    m = machines(spark, sf_dir)
    d = profiling.describe(m, ["x", "power"], profiling.is_active(m))
    return d.select("column", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max", F.round("cv", 6).alias("cv"))


@_query("downsample", " SELECT epoch(time_bucket(INTERVAL 15 MINUTE, timestamp))::BIGINT AS bin, round(avg(x), 6) AS x FROM m GROUP BY 1")
def _downsample(spark, sf_dir):
    return profiling.downsample(machines(spark, sf_dir), 900, ["x"]).select(F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("bin"), F.round("x", 6).alias("x"))


@_query("tracking_error", " SELECT count(x) AS n, round(avg(x - sp), 6) AS mean, round(stddev_samp(x - sp), 6) AS std FROM m")
def _tracking(spark, sf_dir):
    return profiling.tracking_error(machines(spark, sf_dir), "sp", "x").select("n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@_query("corr_top", """, c AS (SELECT 'x' AS a, 'level' AS b, corr(x, level) AS r FROM m UNION ALL SELECT 'x', 'granulator_g2_running', corr(x, run) FROM m UNION ALL SELECT 'level', 'granulator_g2_running', corr(level, run) FROM m) SELECT a, b, round(r, 6) AS r FROM c ORDER BY abs(r) DESC LIMIT 20""")
def _corr(spark, sf_dir):
    return profiling.correlations(machines(spark, sf_dir), ["x", "level", "granulator_g2_running"]).select("a", "b", F.round("r", 6).alias("r"))


@_query("histogram_active", " SELECT run > 0 OR run2 > 0 AS grp, least(floor(loose / 50) + 1, 11)::BIGINT AS bin, count(*) AS n FROM m GROUP BY 1, 2")
def _histogram(spark, sf_dir):
    m = machines(spark, sf_dir)
    return profiling.histogram(m, "loose", 0.0, 500.0, 10, profiling.is_active(m))


@_query("alarm_onsets", f", d AS (SELECT event_id, alarm - coalesce(lag(alarm) OVER {_O}, 0) AS up FROM m) SELECT event_id FROM d WHERE up > 0")
def _onsets(spark, sf_dir):
    return profiling.alarm_onsets(machines(spark, sf_dir), "granulator_g2_alarm", ORDER).select("event_id")


@_query("alarm_window", f", d AS (SELECT *, alarm - coalesce(lag(alarm) OVER {_O}, 0) AS up FROM m), f AS (SELECT min(timestamp) AS onset FROM d WHERE up > 0), n AS (SELECT m.* FROM m, f WHERE abs(epoch_us(timestamp) - epoch_us(onset)) <= 1800000000) SELECT epoch_us(timestamp) AS us, round((loose - min(loose) OVER ()) / nullif(max(loose) OVER () - min(loose) OVER (), 0), 6) AS loose FROM n")
def _alarm_window(spark, sf_dir):
    return profiling.alarm_window(machines(spark, sf_dir), "granulator_g2_alarm", ["loose"], ORDER).select(micros("timestamp").alias("us"), F.round("loose", 6).alias("loose"))


@_query("duplicate_rows_of_orders", "WITH t AS (SELECT o_orderdate, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS k FROM orders) SELECT count(*) AS duplicates FROM t WHERE k > 1")
def _orders(spark, sf_dir):
    own = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderdate").agg(F.count("*").alias("n"))
    return own.agg(F.sum(F.col("n") - 1).alias("duplicates"))
