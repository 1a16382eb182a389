"""The six cleaning checks. Each has detect (a DataFrame of findings) and apply (the cleaned table); each sees the result of the one before.

df has an ordinal column in order of arrival. Nothing is gathered between the checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import FORECAST_OBJECTIVES, Catalog
from ..findings import detected
from ..frames import Order, clean_numbers, micros, zero_if_null
from ..policy import Settings, policy
from .runs import anchored_starts, with_runs

#: Rows that the evidence of a row check names.
EVIDENCE_ROWS = 50


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def seconds(after: Column, before: Column) -> Column:
    return (micros(after) - micros(before)) / 1e6


def _row_findings(df: DataFrame, bad: Column, order: Order, check: str, severity: str, kind: str, column: str | None = None) -> DataFrame:
    """One finding for all rows that are bad, with the first of them as evidence; none if there are none."""
    rows = df.filter(bad).select(*order.entities, F.col(order.row).alias("row"))
    first = Window.partitionBy(*order.entities).orderBy("row")
    shown = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= EVIDENCE_ROWS).groupBy(*order.entities).agg(F.sort_array(F.collect_list("row")).alias("rows"))
    whole = rows.groupBy(*order.entities).agg(F.min("row").alias("a"), F.max("row").alias("b"), F.count("*").alias("n"))
    if order.entities:
        whole = whole.join(shown, list(order.entities))
    else:
        whole = whole.filter("n > 0").withColumn("k", F.lit(1)).join(shown.withColumn("k", F.lit(1)), "k")
    return detected(whole, check, severity, kind, "tag_only", F.col("a"), F.col("b"), F.col("n"), column, F.struct("rows"))


# timestamps


def deltas(df: DataFrame, order: Order, chunk_rows: int = 1_000_000) -> DataFrame:
    """Rows with a timestamp, in order of arrival, with the row before and the seconds since it. A series without entities is taken in chunks of its ordinals; the last row of each chunk goes to the next one."""
    ts, row = F.col(order.timestamp), F.col(order.row)
    known = df.filter(ts.isNotNull()).select(*order.entities, ts.alias("ts"), row.alias("row"))
    if order.entities:
        own = Window.partitionBy(*order.entities).orderBy("row")
        out = known.select("*", F.lag("ts").over(own).alias("ts_before"), F.lag("row").over(own).alias("row_before"))
    else:
        known = known.withColumn("chunk", F.floor(F.col("row") / chunk_rows))
        own, chunks = Window.partitionBy("chunk").orderBy("row"), Window.orderBy("chunk")
        ends = known.groupBy("chunk").agg(F.max_by("ts", "row").alias("t"), F.max("row").alias("r"))
        ends = ends.select("chunk", F.lag("t").over(chunks).alias("t"), F.lag("r").over(chunks).alias("r"))  # a row for each chunk
        inside = known.select("*", F.lag("ts").over(own).alias("a"), F.lag("row").over(own).alias("b"))
        out = inside.join(ends, "chunk").select("ts", "row", F.coalesce("a", "t").alias("ts_before"), F.coalesce("b", "r").alias("row_before"))
    return out.select(*order.entities, "row", "row_before", seconds(F.col("ts"), F.col("ts_before")).alias("delta"))


def detect_timestamps(df: DataFrame, p: Settings, order: Order) -> DataFrame:
    t, check = p.timestamps, "timestamps"
    none = df.filter(F.col(order.timestamp).isNull()).agg(F.min(order.row).alias("a"), F.max(order.row).alias("b"), F.count("*").alias("n")).filter("n > 0")
    steps = deltas(df, order)
    back = steps.filter("delta < 0").agg(F.min("row").alias("a"), F.max("row").alias("b"), F.count("*").alias("n")).filter("n > 0")
    wide = steps.filter(F.col("delta") > t.gap_factor * t.expected_period_s)
    kind = F.when(F.col("delta") > t.max_legal_jump_s, "dst_jump").otherwise("gap")
    return _union([
        detected(none, check, "critical", "unparseable_timestamp", "drop", F.col("a"), F.col("b"), F.col("n"), order.timestamp),
        detected(back, check, "critical", "non_monotonic", "sort", F.col("a"), F.col("b"), F.col("n"), order.timestamp),
        detected(wide, check, "important", kind, "tag_only", F.col("row_before"), F.col("row"), F.lit(1), order.timestamp, F.struct(F.col("delta").alias("delta_s"))),
    ])


def apply_timestamps(df: DataFrame, order: Order) -> DataFrame:
    """Rows with a timestamp, ordered by it; equal ones keep their order of arrival."""
    return order.number(df.filter(F.col(order.timestamp).isNotNull()), order.row)


# duplicates


def mark_duplicates(df: DataFrame, p: Settings, order: Order, signals: list[str]) -> DataFrame:
    """df with duplicate_timestamp, burst_drop, and the runs of bursts and of equal payloads."""
    d = p.duplicates
    before = F.lag(order.timestamp).over(order.by_row)
    ts = F.col(order.timestamp)
    same = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"`{c}`") == F.lag(f"`{c}`").over(order.by_row), F.lit(False)) for c in signals], F.lit(bool(signals)))
    marked = df.select("*", F.coalesce(ts == F.lag(order.timestamp).over(order.spec), F.lit(False)).alias("duplicate_timestamp"), F.coalesce(seconds(ts, before) < d.burst_max_delta_s, F.lit(False)).alias("__close"), same.alias("__same"))
    out = with_runs(marked, {"burst": ~F.col("__close"), "payload": ~F.col("__same")}, order).drop("__close", "__same")
    size, place = F.col("burst_last") - F.col("burst_first") + 1, F.col(order.row) - F.col("burst_first")
    return out.withColumn("burst_size", size).withColumn("burst_drop", (size >= d.burst_min_rows) & (place != F.floor(size / 2)))


def signal_columns(df: DataFrame, catalog: Catalog, order: Order) -> list[str]:
    skip = {order.timestamp, order.row, *order.entities, *catalog.metadata}
    return [c for c in df.columns if c not in skip]


def detect_duplicates(df: DataFrame, p: Settings, catalog: Catalog, order: Order) -> DataFrame:
    check, d = "duplicates", p.duplicates
    own = mark_duplicates(df, p, order, signal_columns(df, catalog, order))
    twice = own.filter("duplicate_timestamp").agg(F.min(order.row).alias("a"), F.max(order.row).alias("b"), F.count("*").alias("n")).filter("n > 0")
    length = F.col("payload_last") - F.col("payload_first") + 1
    same = own.filter((F.col(order.row) == F.col("payload_first")) & (length >= 2) & (length <= d.payload_window_rows))
    burst = own.filter((F.col(order.row) == F.col("burst_first")) & (F.col("burst_size") >= d.burst_min_rows))
    return _union([
        detected(twice, check, "important", "duplicate_timestamp", "drop_keep_first", F.col("a"), F.col("b"), F.col("n"), order.timestamp),
        detected(same, check, "aware", "duplicate_payload", "tag_only", F.col("payload_first"), F.col("payload_last"), length),
        detected(burst, check, "important", "plc_burst", "keep_median_drop_neighbours", F.col("burst_first"), F.col("burst_last"), F.col("burst_size")),
    ])


def apply_duplicates(df: DataFrame, p: Settings, order: Order) -> DataFrame:
    """Without repeated timestamps and without all but the median row of bursts. Both are marked on the same table, so three rows of one timestamp all go."""
    own = mark_duplicates(df, p, order, []).filter(~(F.col("duplicate_timestamp") | F.col("burst_drop")))
    return order.number(own.select(*df.columns), order.row)


# physical ranges


def detect_ranges(df: DataFrame, p: Settings, order: Order) -> DataFrame:
    """All bounds in one aggregation."""
    check, r = "physical_ranges", p.physical_ranges
    parts = []
    for c, b in r.bounds.items():
        if c not in df.columns:
            continue
        x, row = F.col(c), F.col(order.row)
        out = (x < b.min) | (x > b.max)
        action = "mask_nan" if b.severity == "critical" else ("clip" if r.clip_soft_violations else "mask_nan") if b.severity == "important" else "tag_only"
        kinds = [("out_of_range", out, action)] + ([("non_integer_in_integer_column", ~out & (x != F.rint(x)), "mask_nan")] if b.integer else [])
        for kind, bad, what in kinds:
            parts.append(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.lit(b.severity).alias("severity"), F.lit(what).alias("action"), F.min(F.when(bad, row)).alias("a"), F.max(F.when(bad, row)).alias("b"), F.count_if(bad).alias("n"), F.min(F.when(bad, x)).alias("low"), F.max(F.when(bad, x)).alias("high")))
    if not parts:
        return detected(df.limit(0), check, "normal", "none", "noop", F.lit(0), F.lit(0), F.lit(0))
    own = df.agg(F.array(*parts).alias("found")).select(F.inline("found")).filter("n > 0")
    return detected(own, check, F.col("severity"), F.col("kind"), F.col("action"), F.col("a"), F.col("b"), F.col("n"), F.col("column"), F.struct("low", "high"))


def apply_ranges(df: DataFrame, p: Settings) -> DataFrame:
    r = p.physical_ranges
    out = []
    for name in df.columns:
        x, b = F.col(f"`{name}`"), r.bounds.get(name)
        if b is not None:
            inside = (x >= b.min) & (x <= b.max)
            if b.severity == "critical":
                x = F.when(inside, x)
            elif b.severity == "important":
                x = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(b.min)), F.lit(b.max))) if r.clip_soft_violations else F.when(inside, x)
            if b.integer:
                x = F.when(x == F.rint(x), x)
        out.append(x.alias(name))
    return df.select(*out)


# frozen sensors


def _frozen_runs(df: DataFrame, p: Settings, catalog: Catalog, order: Order) -> tuple[DataFrame, list[str]]:
    f = p.frozen_sensors
    columns = [c for c in catalog.process(df.columns) if c not in f.skip_columns]
    loose = [c for c in columns if c in f.epsilon_rate_cols]
    if loose:
        df = anchored_starts(df, loose, f.epsilon, order)
    starts = {c: F.col(f"{c}_anchor_start") if c in loose else ~F.coalesce(F.col(c) == F.lag(c).over(order.by_row), F.lit(False)) for c in columns}
    return with_runs(df, starts, order), columns


def detect_frozen(df: DataFrame, p: Settings, catalog: Catalog, order: Order) -> DataFrame:
    own, columns = _frozen_runs(df, p, catalog, order)
    least = p.frozen_sensors.frozen_min_minutes
    flags = catalog.running(df.columns)
    on = reduce(lambda a, b: a | b, [zero_if_null(F.col(c)) != 0 for c in flags], F.lit(not flags))
    runs = F.array(*[F.when(F.col(c).isNotNull() & (F.col(f"{c}_last") - F.col(f"{c}_first") + 1 >= least), F.struct(F.lit(c).alias("column"), F.lit(catalog.objective.get(c) in FORECAST_OBJECTIVES).alias("forecast"), F.col(f"{c}_first").alias("a"), F.col(f"{c}_last").alias("b"), F.col(c).cast("double").alias("value"))) for c in columns])
    rows = own.select(*order.entities, on.alias("on"), F.explode(F.array_compact(runs)).alias("r"))
    found = rows.groupBy(*order.entities, "r.column", "r.forecast", "r.a", "r.b").agg(F.max("on").alias("on"), F.min("r.value").alias("value"))
    severity = F.when(F.col("forecast"), "critical").when(~F.col("on"), "aware").otherwise("important")
    action = F.when(F.col("forecast"), "mask_nan").otherwise("tag_only")
    return detected(found, "frozen_sensors", severity, "frozen_run", action, F.col("a"), F.col("b"), F.col("b") - F.col("a") + 1, F.col("column"), F.struct("value"))


def apply_frozen(df: DataFrame, p: Settings, catalog: Catalog, order: Order) -> DataFrame:
    """Runs of the columns that forecasts aim at become null."""
    own, columns = _frozen_runs(df, p, catalog, order)
    least = p.frozen_sensors.frozen_min_minutes
    aims = {c for c in columns if catalog.objective.get(c) in FORECAST_OBJECTIVES}
    return own.select(*[F.when(~(F.col(f"{c}_last") - F.col(f"{c}_first") + 1 >= least), F.col(c)).alias(c) if c in aims else F.col(f"`{c}`") for c in df.columns])


# state consistency

# Alarm and running flag of each machine; setpoint and measured value of each pair.
ALARM_PAIRS = [
    ("granulator_g2_alarm", "granulator_g2_running"),
    ("feeder_al2_alarm", "feeder_al2_running"),
    ("conditioner_me2_alarm", "conditioner_me2_direct"),
]
SETPOINT_PAIRS = [
    ("granulator_power_sp", "granulator_power"),
    ("conditioner_temp_sp", "conditioner_inlet_temp"),
    ("steam_line_pressure_sp", "steam_valve_pressure_me2"),
    ("expander_cone_pressure_sp", "extruder_specific_energy"),
]


def detect_states(df: DataFrame, p: Settings, catalog: Catalog, order: Order, alarm_pairs: list = ALARM_PAIRS, setpoint_pairs: list = SETPOINT_PAIRS) -> DataFrame:
    """What signals say against each other; all is tagged only."""
    check, s, have = "state_consistency", p.state_consistency, set(df.columns)
    parts = []
    run, rate, power = "granulator_g2_running", "granulator_production_rate", "granulator_power"
    value = lambda c, other: F.coalesce(F.col(c), F.lit(float(other)))
    if {run, rate} <= have:
        parts.append(_row_findings(df, (value(run, 1) == 0) & (value(rate, 0) > s.min_production_kgmin), order, check, "important", "off_with_production", rate))
    if {run, power} <= have:
        parts.append(_row_findings(df, (value(run, 0) == 1) & (value(power, 100) < s.min_power_pct), order, check, "important", "on_with_low_power", power))
    alarms, temps = catalog.alarms(df.columns), catalog.with_unit(df.columns, "C")
    if alarms and temps:
        quiet = reduce(lambda a, b: a + b, [zero_if_null(F.col(c)) for c in alarms]) == 0
        hot = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > s.hot_temperature_threshold_c, F.lit(False)) for c in temps])
        parts.append(_row_findings(df, quiet & hot, order, check, "important", "alarm_off_but_hot"))
    pairs = [(a, r) for a, r in alarm_pairs if {a, r} <= have]
    drifts = [(sp, pv) for sp, pv in setpoint_pairs if {sp, pv} <= have]
    on = {a: zero_if_null(F.col(a)) == 1 for a, _ in pairs}
    off = {f"{sp}|{pv}": F.coalesce((F.abs(F.col(sp)) > 1e-9) & (F.abs(F.col(sp) - F.col(pv)) > s.sp_pv_max_drift_pct / 100 * F.abs(F.col(sp))), F.lit(False)) for sp, pv in drifts}
    marked = df.select("*", *[c.alias(f"__on_{n}") for n, c in {**on, **off}.items()])
    names = [*on, *off]
    changed = {f"__run_{n}": ~F.coalesce(F.col(f"`__on_{n}`") == F.lag(f"`__on_{n}`").over(order.by_row), F.lit(False)) for n in names}
    if names:
        own = with_runs(marked, changed, order)
        rows = F.array(*[F.when(F.col(f"`__on_{n}`"), F.struct(F.lit(n).alias("name"), F.col(f"`__run_{n}_first`").alias("a"), F.col(f"`__run_{n}_last`").alias("b"), F.coalesce(F.col(r) == 0, F.lit(False)).cast("int").alias("off"))) for n, r in [*pairs, *[(n, n.split("|")[0]) for n in off]]])
        runs = own.select(*order.entities, F.explode(F.array_compact(rows)).alias("r")).groupBy(*order.entities, "r.name", "r.a", "r.b").agg(F.sum("r.off").alias("off"))
        down = runs.filter(F.col("name").isin(list(on)) & (F.col("off") > s.alarm_shutdown_window_min))
        parts.append(detected(down, check, "aware", "alarm_with_extended_shutdown", "tag_only", F.col("a"), F.col("b"), F.col("off"), F.col("name")))
        long = runs.filter(F.col("name").isin(list(off)) & (F.col("b") - F.col("a") + 1 > s.sp_pv_drift_min_minutes))
        parts.append(detected(long, check, "aware", "sp_pv_drift", "tag_only", F.col("a"), F.col("b"), F.col("b") - F.col("a") + 1, F.element_at(F.split("name", r"\|"), 2), F.struct(F.element_at(F.split("name", r"\|"), 1).alias("setpoint"))))
    return _union(parts) if parts else detected(df.limit(0), check, "normal", "none", "noop", F.lit(0), F.lit(0), F.lit(0))


# missing values

OFF_FLAGS = ("granulator_g2_running", "feeder_al2_running")


def null_runs(df: DataFrame, p: Settings, catalog: Catalog, order: Order) -> DataFrame:
    """(entities, column, a, b, n, finding_type, severity, action): every run of nulls of every column, classified. Only null cells are spread out."""
    m, row = p.missing_values, F.col(order.row)
    columns = [c for c in df.columns if c not in (order.timestamp, order.row, *order.entities)]
    flags = catalog.running(df.columns)
    both = all(c in df.columns for c in OFF_FLAGS)
    off = reduce(lambda a, b: a & b, [F.coalesce(F.col(c), F.lit(1.0)) == 0 for c in OFF_FLAGS]) if both else F.lit(False)
    running = reduce(lambda a, b: a | b, [zero_if_null(F.col(c)) == 1 for c in flags], F.lit(False))
    alarms = catalog.alarms(df.columns)
    change = [zero_if_null(F.col(c)) - F.lag(zero_if_null(F.col(c)), 1).over(order.by_row) for c in alarms]
    rises = reduce(lambda a, b: a + b, [F.coalesce((x > 0).cast("long"), F.lit(0)) for x in change], F.lit(0).cast("long"))
    falls = reduce(lambda a, b: a + b, [F.coalesce((x < 0).cast("long"), F.lit(0)) for x in change], F.lit(0).cast("long"))
    # rises and falls in the rows around each row, so that a run needs no join: those up to the row itself, and up to some rows before and after
    upto = order.by_row.rowsBetween(Window.unboundedPreceding, 0)
    near = m.alarm_alignment_window_min
    span = df.select("*", off.alias("__off"), running.alias("__running"), rises.alias("__r"), falls.alias("__f"))
    span = span.select("*", F.sum("__r").over(upto).alias("__rs"), F.sum("__f").over(upto).alias("__fs"))
    ahead = order.by_row.rowsBetween(0, near)
    behind = order.by_row.rowsBetween(-near, 0)
    span = span.select("*", *[F.max(f"__{x}s").over(ahead).alias(f"__{x}hi") for x in "rf"], *[F.min(f"__{x}s").over(behind).alias(f"__{x}lo") for x in "rf"])
    cells = span.select(*order.entities, row.alias("row"), "__off", "__running", "__rhi", "__fhi", "__rlo", "__flo", F.explode(F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in columns]))).alias("column"))
    own = Window.partitionBy(*order.entities, "column").orderBy("row")
    runs = cells.withColumn("run", F.col("row") - F.row_number().over(own)).groupBy(*order.entities, "column", "run").agg(
        F.min("row").alias("a"), F.max("row").alias("b"), F.count("*").alias("n"), F.min("__off").alias("off"), F.max("__running").alias("running"),
        F.max("__rhi").alias("rhi"), F.max("__fhi").alias("fhi"), F.min("__rlo").alias("rlo"), F.min("__flo").alias("flo"),
    ).drop("run")
    process = F.col("column").isin(catalog.process(columns))
    aligned = F.lit(bool(alarms)) & (F.col("rhi") > F.col("rlo")) & (F.col("fhi") > F.col("flo"))
    kinds = [
        (F.col("column").isin(list(m.missing_by_design_columns)), "missing_by_design", "normal", "keep"),
        (process & F.col("off"), "machine_off", "aware", "keep"),
        (process & aligned, "maintenance_window", "aware", "keep"),
        ((F.col("n") > m.broken_sensor_min_run) & F.col("running"), "broken_sensor", "critical", "tag_only"),
        ((F.col("n") <= m.interpolation_max_run) & F.col("running"), "lost_communication", "important", "interpolate_time"),
        ((F.col("n") == 1) & process, "continuous_sensor", "important", "forward_fill_1"),
        (F.lit(True), "unclassified_nan", "aware", "keep"),
    ]
    pick = F.coalesce(*[F.when(c, F.struct(F.lit(k).alias("finding_type"), F.lit(s).alias("severity"), F.lit(a).alias("action"))) for c, k, s, a in kinds])
    return runs.select(*order.entities, "column", "a", "b", "n", pick.alias("k")).select(*order.entities, "column", "a", "b", "n", "k.*")


def _unknown_state(df: DataFrame, catalog: Catalog) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in catalog.running(df.columns)], F.lit(False))


def detect_missing(df: DataFrame, p: Settings, catalog: Catalog, order: Order) -> DataFrame:
    check = "missing_values"
    lost = df.filter(_unknown_state(df, catalog)).agg(F.min(order.row).alias("a"), F.max(order.row).alias("b"), F.count("*").alias("n")).filter("n > 0")
    runs = null_runs(df, p, catalog, order)
    return _union([
        detected(lost, check, "critical", "undeterminable_state", "drop", F.col("a"), F.col("b"), F.col("n")),
        detected(runs, check, F.col("severity"), F.col("finding_type"), F.col("action"), F.col("a"), F.col("b"), F.col("n"), F.col("column")),
    ])


def interpolated(df: DataFrame, limits: dict[str, int], order: Order, only: str | None = None) -> DataFrame:
    """Numeric columns with nulls filled on the line between their neighbours in time, up to limits[column] rows after the last value; after the end the last value stays. only: a column of names that may be filled in a row."""
    limits = {c: n for c, n in limits.items() if dict(df.dtypes)[c] in ("double", "float", "int", "bigint")}
    if not limits:
        return df
    back = Window.partitionBy(*order.entities).orderBy(F.col(order.row).desc()).rowsBetween(Window.unboundedPreceding, 0)
    upto = order.by_row.rowsBetween(Window.unboundedPreceding, 0)
    point = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("x"), micros(order.timestamp).alias("t"), F.col(order.row).alias("r"))) for c in limits}
    own = df.select("*", *[F.last(v, ignorenulls=True).over(upto).alias(f"__a_{c}") for c, v in point.items()])
    own = own.select("*", *[F.last(v, ignorenulls=True).over(back).alias(f"__b_{c}") for c, v in point.items()])

    def one(c: str) -> Column:
        if c not in limits:
            return F.col(f"`{c}`")
        x, a, b = F.col(c), F.col(f"__a_{c}"), F.col(f"__b_{c}")
        share = F.try_divide((micros(order.timestamp) - a["t"]).cast("double"), (b["t"] - a["t"]).cast("double"))
        line = F.coalesce(a["x"] + (b["x"] - a["x"]) * share, a["x"])
        may = (F.col(order.row) - a["r"]) <= limits[c]
        if only:
            may = may & F.coalesce(F.array_contains(only, c), F.lit(False))
        return F.coalesce(x, F.when(may, line)).alias(c)

    return own.select(*[one(c) for c in df.columns])


def apply_missing(df: DataFrame, p: Settings, catalog: Catalog, order: Order, mode: str = "reference") -> DataFrame:
    """Drop rows of unknown state; fill short gaps.

    mode "reference": a column with k gaps to interpolate is filled k times over, as a whole, `limit` rows each time; a column with a gap to carry over is carried by one row. mode "strict": only the gaps themselves are filled. The counts of gaps, a number for each column, come to the driver.
    """
    runs = null_runs(df, p, catalog, order)
    kept = order.number(df.filter(~_unknown_state(df, catalog)), order.row)
    limit = p.missing_values.interpolation_max_run
    if mode == "strict":
        gaps = runs.filter("action = 'interpolate_time'").select(*order.entities, "column", F.explode(F.sequence("a", "b")).alias("__at")).groupBy(*order.entities, "__at").agg(F.collect_set("column").alias("__fill"))
        old = df.filter(~_unknown_state(df, catalog)).withColumn("__at", F.col(order.row)).join(gaps, [*order.entities, "__at"], "left").drop("__at")
        filled = interpolated(order.number(old, order.row), {c: limit for c in df.columns if c not in (order.row, order.timestamp, *order.entities)}, order, "__fill")
        return filled.select(*df.columns)
    last = kept.count()
    counts = {r["column"]: (r["k"], r["f"]) for r in runs.filter(F.col("b") < last).groupBy("column").agg(F.count_if(F.col("action") == "interpolate_time").alias("k"), F.count_if(F.col("action") == "forward_fill_1").alias("f")).filter("k + f > 0").collect()}
    out = interpolated(kept, {c: limit * k for c, (k, _) in counts.items() if k}, order)
    carried = {c for c, (_, f) in counts.items() if f}
    return out.select(*[F.coalesce(F.col(c), F.lag(c).over(order.by_row)).alias(c) if c in carried else F.col(f"`{c}`") for c in df.columns]) if carried else out


def clean(df: DataFrame, catalog: Catalog | None = None, settings: Settings | None = None, order: Order = Order(), mode: str = "reference") -> tuple[DataFrame, DataFrame]:
    """(clean table, findings) of all six checks in turn."""
    catalog, p = catalog or Catalog.default(), settings or policy("cleaning")
    df = clean_numbers(df)
    found = [detect_timestamps(df, p, order)]
    df = apply_timestamps(df, order)
    found.append(detect_duplicates(df, p, catalog, order))
    df = apply_duplicates(df, p, order)
    found.append(detect_ranges(df, p, order))
    df = apply_ranges(df, p)
    found.append(detect_frozen(df, p, catalog, order))
    df = apply_frozen(df, p, catalog, order)
    found.append(detect_states(df, p, catalog, order))
    found.append(detect_missing(df, p, catalog, order))
    return apply_missing(df, p, catalog, order, mode), _union(found)
