"""The time-series and feature-engineering stages.

A plan is a list of findings (what will be added and why) and features. It needs
column names only; the two findings that need data are added by `run_*`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..findings import finding, frame
from ..frames import Feature, Order, add_features, clean_numbers, flag_periods, micros, safe_div, signal_periods
from ..functions.families import Families
from ..policy import FAMILIES, Settings, families_of
from .scaleout import add_features_in_chunks, chunk_order

_SHORT = {"rolling_mean": "mean", "rolling_std": "std", "rolling_trend": "trend", "lag": "lag", "pct_change": "pctchg", "velocity": "velocity"}


@dataclass
class Plan:
    findings: list[tuple] = field(default_factory=list)
    features: list[Feature] = field(default_factory=list)
    #: What the features are made with.
    make: Families | None = None

    def add(self, check: str, kind: str, column: str | None, feature: Feature, severity: str = "normal", **evidence) -> None:
        self.findings.append(finding(check, severity, kind, f"add:{feature.name}", column, 1, **evidence))
        self.features.append(feature)

    def say(self, check: str, kind: str, action: str, column: str | None = None, severity: str = "normal", count: int = 1, **evidence) -> None:
        self.findings.append(finding(check, severity, kind, action, column, count, **evidence))


def plan_time_series(columns: list[str], catalog: Catalog, policy: Settings, order: Order = Order()) -> Plan:
    plan = Plan()
    make = plan.make = Families(order)
    signals = [(c, k) for c in columns if (k := catalog.of(c)) not in (None, "state_flag", "alarm")]
    for column, kind in signals:
        own = families_of(policy, kind, column)
        for name in FAMILIES:
            family = own[name]
            if not family.enabled:
                continue
            for n in family.windows if name.startswith("rolling") else family.lags:
                if name.startswith("rolling"):
                    plan.add("rolling_windows", name, column, getattr(make, name)(column, n, family.closed), window=n, closed=family.closed, min_periods=signal_periods(n))
                else:
                    plan.add("temporal_features", name, column, getattr(make, name)(column, n), lag=n)
    state = policy.state_features
    if not state.enabled:
        plan.say("state_features", "skipped", "noop", reason="disabled")
        return plan
    flags, alarms = catalog.in_category(columns, "state_flag"), catalog.in_category(columns, "alarm")
    for c in flags:
        for w in state.running_fraction_windows:
            plan.add("state_features", "runfrac", c, make.runfrac(c, w), window=w, min_periods=flag_periods(w))
    for c in [*flags, *alarms]:
        if state.time_since_active:
            plan.add("state_features", "tsla", c, make.tsla(c))
        for w in state.edge_count_windows:
            plan.add("state_features", "edges", c, make.edges(c, w), window=w, min_periods=flag_periods(w))
    return plan


def plan_engineering(columns: list[str], catalog: Catalog, policy: Settings, order: Order = Order()) -> Plan:
    plan, have = Plan(), set(columns)
    make = plan.make = Families(order)
    of = lambda kinds: catalog.in_category(columns, *kinds)

    p = policy.temporal_derivatives
    if p.enabled:
        if p.acceleration.enabled:
            for c in of(p.acceleration.categories):
                for n in p.acceleration.lags:
                    plan.add("temporal_derivatives", "acceleration", c, make.acceleration(c, n), lag=n)
        if p.sign_change_rate.enabled:
            for c in of(p.sign_change_rate.categories):
                for w in p.sign_change_rate.windows:
                    plan.add("temporal_derivatives", "sign_change_rate", c, make.sign_changes(c, w, p.sign_change_rate.closed), window=w)
        if p.sp_pv_deviation.enabled:
            for sp, pv in p.sp_pv_deviation.pairs.items():
                if missing := [c for c in (sp, pv) if c not in have]:
                    plan.say("temporal_derivatives", "sp_pv_deviation_missing", "skip", sp, "important", sp=sp, pv=pv, missing=missing)
                else:
                    plan.add("temporal_derivatives", "sp_pv_deviation", pv, Feature(f"{pv}_minus_{sp}", F.col(pv) - F.col(sp)), sp=sp, pv=pv)
    else:
        plan.say("temporal_derivatives", "skipped", "noop", reason="disabled")

    p = policy.stability
    if p.enabled:
        for c in of(p.cv.categories) if p.cv.enabled else []:
            for w in p.cv.windows:
                plan.add("stability", "cv", c, make.cv(c, w, p.cv.closed, p.cv.epsilon), window=w)
        for c in of(p.std_ratio.categories) if p.std_ratio.enabled else []:
            plan.add("stability", "std_ratio", c, make.std_ratio(c, p.std_ratio.short, p.std_ratio.long, p.std_ratio.epsilon, have))
        for c in of(p.rolling_range.categories) if p.rolling_range.enabled else []:
            for w in p.rolling_range.windows:
                plan.add("stability", "rolling_range", c, make.rolling_range(c, w, p.rolling_range.closed), window=w)
        for c in catalog.with_unit(of(p.mad.categories), *p.mad.units) if p.mad.enabled else []:
            for w in p.mad.windows:
                plan.add("stability", "mad", c, make.mad(c, w, p.mad.closed), window=w)
    else:
        plan.say("stability", "skipped", "noop", reason="disabled")

    p = policy.physical_ratios
    if p.enabled:
        for r in p.ratios:
            wanted = [r.a] if r.op == "scale" else [r.a, r.b]
            if missing := [c for c in wanted if c not in have]:
                plan.say("physical_ratios", "ratio_missing_input", "skip", r.name, "important", missing=missing)
                continue
            a = F.col(r.a)
            out = a * (r.factor or 1.0) if r.op == "scale" else a - F.col(r.b) if r.op == "diff" else safe_div(a, F.col(r.b), p.epsilon)
            plan.add("physical_ratios", "ratio", r.name, Feature(r.name, out), op=r.op, a=r.a, b=r.b, factor=r.factor)
    else:
        plan.say("physical_ratios", "skipped", "noop", reason="disabled")

    p = policy.energetic_features
    if p.enabled:
        hours = p.sample_period_s / 3600.0
        for c in p.power_columns if p.cumulative.enabled else []:
            if c not in have:
                plan.say("energetic_features", "cumulative_energy_missing_input", "skip", c, "important")
                continue
            plan.add("energetic_features", "cumulative_energy", c, make.cumulative_energy(c, hours), daily=False)
            if p.cumulative.daily_reset:
                plan.add("energetic_features", "cumulative_energy", c, make.cumulative_energy_daily(c, hours), daily=True)
        for c in p.power_columns if p.energy_per_kg.enabled else []:
            if c not in have or p.production_column not in have:
                plan.say("energetic_features", "energy_per_kg_missing_input", "skip", c, "important", production=p.production_column)
                continue
            for w in p.energy_per_kg.windows:
                plan.add("energetic_features", "energy_per_kg", c, make.energy_per_kg(c, p.production_column, w, hours, p.energy_per_kg.closed, p.energy_per_kg.epsilon), window=w)
        if p.per_cycle.enabled:
            plan.say("energetic_features", "per_cycle_enabled", "noop", p.per_cycle.cycle_id_column, "aware", reason="not implemented")
    else:
        plan.say("energetic_features", "skipped", "noop", reason="disabled")

    p = policy.operative_features
    if p.enabled:
        sets = {}
        for name in ("running_flags", "alarm_flags"):
            sets[name] = [c for c in p[name] if c in have]
            if missing := [c for c in p[name] if c not in have]:
                plan.say("operative_features", f"{name}_missing", "partial", None, "aware", len(missing), missing=missing)
        running, alarms = sets["running_flags"], sets["alarm_flags"]
        if p.time_since_machine_off and running:
            plan.add("operative_features", "time_since_machine_off", None, make.time_since_machine_off(running))
        if p.n_subsystems_running and running:
            plan.add("operative_features", "n_subsystems_running", None, make.n_running(running))
        if p.cumulative_starts and running:
            plan.add("operative_features", "cumulative_starts", None, make.cumulative_starts(running))
        for w in p.total_alarms.windows if p.total_alarms.enabled and alarms else []:
            plan.add("operative_features", "total_alarms", None, make.total_alarms(alarms, w, p.total_alarms.closed), window=w)
        if p.time_since_any_alarm and alarms:
            plan.add("operative_features", "time_since_any_alarm", None, make.time_since_any_alarm(alarms))
        if p.any_alarm_while_running and running and alarms:
            plan.add("operative_features", "any_alarm_while_running", None, make.any_alarm_while_running(alarms, running))
    else:
        plan.say("operative_features", "skipped", "noop", reason="disabled")

    p = policy.anomaly_features
    if p.enabled:
        for name in ("rolling_z", "robust_z"):
            for c in of(p[name].categories) if p[name].enabled else []:
                for w in p[name].windows:
                    plan.add("anomaly_features", name, c, getattr(make, name)(c, w, p[name].closed, p[name].epsilon), window=w)
        for c in of(p.global_z.categories) if p.global_z.enabled else []:
            plan.add("anomaly_features", "global_z", c, make.global_z(c, p.global_z.epsilon), "aware", leakage="uses mean and std of the whole record")
    else:
        plan.say("anomaly_features", "skipped", "noop", reason="disabled")
    return plan


def convert_timestamp(df: DataFrame, column: str = "timestamp") -> tuple[DataFrame, list[tuple]]:
    kinds = dict(df.dtypes)
    if column not in kinds:
        return df, [finding("temporal_conversion", "aware", "missing_timestamp", "noop", column)]
    if kinds[column].startswith("timestamp"):
        return df, [finding("temporal_conversion", "normal", "already_datetime", "noop", column)]
    return df.withColumn(column, F.col(column).try_cast("timestamp")), [finding("temporal_conversion", "normal", "coerce_datetime", "try_cast(timestamp)", column)]


def first_of_each_timestamp(df: DataFrame, order: Order) -> DataFrame:
    """The row that came first for each timestamp of an entity; ordinals are dealt anew."""
    own = Window.partitionBy(*order.entities, order.timestamp).orderBy(order.row)
    return order.number(df.withColumn("__n", F.row_number().over(own)).filter("__n = 1").drop("__n"), order.row)


def resample(df: DataFrame, rule: str, rules: dict[str, str], catalog: Catalog, order: Order = Order()) -> DataFrame:
    """A dense grid of `rule` steps ("1min", "5s", "1h") from each entity's first bin to its last. Columns aggregate by their category; empty bins have nulls only; `last` leaves out nulls; metadata takes the last."""
    step = rule_seconds(rule)
    ts = order.timestamp
    bin_ = F.timestamp_seconds(F.floor(micros(ts) / (step * 1_000_000)) * step)
    how = {c: rules.get(catalog.of(c), "last") for c in df.columns if c not in (ts, order.row, *order.entities)}
    at = F.struct(F.col(ts), F.col(order.row))

    def one(c: str, kind: str):
        if kind == "last":
            return F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
        if kind == "first":
            return F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
        return {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "median": F.median}[kind](c).alias(c)

    keys = list(order.entities)
    binned = df.filter(F.col(ts).isNotNull()).groupBy(*keys, bin_.alias(ts)).agg(*[one(c, k) for c, k in how.items()])
    ends = binned.groupBy(*keys).agg(F.min(ts).alias("__a"), F.max(ts).alias("__b"))
    spine = ends.select(*keys, F.explode(F.sequence("__a", "__b", F.expr(f"interval {step} seconds"))).alias(ts))
    return order.number(spine.join(binned, [*keys, ts], "left").select(*[c for c in df.columns if c != order.row]))


def rule_seconds(rule: str) -> int:
    """Seconds of a step such as 30s, 1min, 15T, 1H, 1D."""
    import re

    m = re.fullmatch(r"\s*(\d*)\s*([a-zA-Z]+)\s*", rule)
    units = {"s": 1, "sec": 1, "min": 60, "t": 60, "h": 3600, "hour": 3600, "d": 86400, "day": 86400}
    if not m or m[2].lower() not in units:
        raise ValueError(f"no time step: {rule!r}")
    return int(m[1] or 1) * units[m[2].lower()]


def dealt(order: Order) -> Order:
    """The order that features are made for: one series goes in chunks."""
    return order if order.entities else chunk_order(order.timestamp)


def made(df: DataFrame, plan: Plan, order: Order) -> DataFrame:
    """df with the plan's features. One series takes each chunk of its rows with the rows before it that windows reach."""
    if order.entities:
        return add_features(clean_numbers(df), plan.features, order)
    return add_features_in_chunks(clean_numbers(df), plan.features, plan.make.reach, order.timestamp)


def run_time_series(df: DataFrame, catalog: Catalog, policy: Settings, order: Order = Order()) -> tuple[DataFrame, DataFrame]:
    """(features, findings). df has the ordinal column."""
    said: list[tuple] = []
    if policy.temporal_conversion.enabled:
        df, found = convert_timestamp(df, policy.temporal_conversion.timestamp_col)
        said += found
    else:
        said.append(finding("temporal_conversion", "normal", "skipped", "noop"))
    spark = df.sparkSession
    counted = None
    if policy.temporal_index.enabled:
        said.append(finding("temporal_index", "normal", "set_index", "set_index", order.timestamp))
        if policy.temporal_index.drop_duplicates_on_index:
            per = df.groupBy(*order.entities, order.timestamp).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).filter("n > 0")
            counted = per.select(F.lit("temporal_index").alias("check"), F.lit("aware").alias("severity"), F.lit("duplicate_index").alias("finding_type"), F.lit(order.timestamp).alias("column"), F.lit(None).cast("long").alias("row_start"), F.lit(None).cast("long").alias("row_end"), F.col("n").cast("long").alias("count"), F.lit("drop_first").alias("action_taken"), F.lit(None).cast("string").alias("evidence"))
            df = first_of_each_timestamp(df, order)
    else:
        said.append(finding("temporal_index", "normal", "skipped", "noop"))
    if policy.resampling.enabled:
        df = resample(df, policy.resampling.rule, policy.resampling.aggregations, catalog, order)
        said.append(finding("resampling", "aware", "resample", f"resample({policy.resampling.rule})"))
    else:
        said.append(finding("resampling", "normal", "skipped", "noop", reason="disabled"))
    plan = plan_time_series(df.columns, catalog, policy, dealt(order))
    found = frame(spark, said + plan.findings)
    return made(df, plan, order), found if counted is None else found.unionByName(counted)


def run_engineering(df: DataFrame, catalog: Catalog, policy: Settings, order: Order = Order()) -> tuple[DataFrame, DataFrame]:
    """(engineered, findings). Ratios that are null too often are told of, from one pass over them."""
    plan = plan_engineering(df.columns, catalog, policy, dealt(order))
    out = made(df, plan, order)
    found = frame(df.sparkSession, plan.findings)
    names = [f.name for f in plan.features if f.name in {r.name for r in policy.physical_ratios.ratios}] if policy.physical_ratios.enabled else []
    if names:
        own = add_features(clean_numbers(df), [f for f in plan.features if f.name in names])  # these need no window
        rates = own.agg(*[F.avg(F.col(n).isNull().cast("double")).alias(n) for n in names]).unpivot([], names, "column", "rate").filter(F.col("rate") > policy.physical_ratios.nan_rate_warn)
        long = F.lit(None).cast("long")
        found = found.unionByName(rates.select(F.lit("physical_ratios").alias("check"), F.lit("aware").alias("severity"), F.lit("ratio_high_nan_rate").alias("finding_type"), "column", long.alias("row_start"), long.alias("row_end"), F.lit(1).cast("long").alias("count"), F.lit("emit").alias("action_taken"), F.to_json(F.struct(F.round("rate", 6).alias("nan_rate"))).alias("evidence")))
    return out, found
