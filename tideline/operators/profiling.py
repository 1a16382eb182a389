"""Temporal quality of a raw table, and the exploration queries on a clean one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..frames import Order, flag01, micros
from ..plans.scaleout import positions, running_by
from .cleaning import deltas

#: Seconds between rows that a regular record has, and that count as a gap.
PERIOD, GAP = 60.0, 120.0


def cadence_counts(df: DataFrame, order: Order = Order()) -> DataFrame:
    """One row: rows, bad_ts, out_of_order, duplicate_ts, gaps; a step is the first of the last three that it fits."""
    steps = deltas(df, order)
    own = steps.agg(F.count_if(F.col("delta") < 0).alias("out_of_order"), F.count_if(F.col("delta") == 0).alias("duplicate_ts"), F.count_if(F.col("delta") > GAP).alias("gaps"), F.count("delta").alias("n_deltas"))
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col(order.timestamp).isNull()).alias("bad_ts")).join(own)


def nearest_ranks(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """(share, value): the entry at place round(share*(n-1)) of the sorted column, halves to even. Ranks come from counts of equal values, so equal values take no room."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    upto = running_by(counted.withColumnRenamed(value, "value"), "value", "n")
    asked = F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share")) for s in shares])).alias("s")
    at = F.bround(F.col("s.share") * (F.col("_total") - 1), 0)
    return upto.select("*", asked).filter((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("n"))).select("s.share", "value")


def quartile_range(df: DataFrame, value: str) -> DataFrame:
    """One row: the quartiles by nearest rank, and the distance between them."""
    ranks = nearest_ranks(df, value, [0.25, 0.75])
    ends = [F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in ((0.25, "p25"), (0.75, "p75"))]
    return ranks.agg(*ends).select("p25", "p75", (F.col("p75") - F.col("p25")).alias("iqr"))


def cadence_stats(df: DataFrame, order: Order = Order()) -> DataFrame:
    """One row: median, mean, sample deviation, least and largest step in seconds."""
    return deltas(df, order).agg(F.median("delta").alias("median_s"), F.avg("delta").alias("mean_s"), F.stddev_samp("delta").alias("stdev_s"), F.min("delta").alias("min_s"), F.max("delta").alias("max_s"))


def cadence_drift(df: DataFrame, order: Order = Order(), segments: int = 10, least: int = 100) -> DataFrame:
    """(segment, n, median_s, mean_s) of equal stretches of the record, the last with the remainder; nothing under `least` steps."""
    steps = deltas(df, order).filter(F.col("delta").isNotNull())
    part = F.least(F.floor(F.col("_at") / F.floor(F.col("_n") / segments)), F.lit(segments - 1)).cast("int")
    return positions(steps, "row").filter(F.col("_n") >= least).groupBy(part.alias("segment")).agg(F.count("*").alias("n"), F.median("delta").alias("median_s"), F.avg("delta").alias("mean_s"))


def coverage(df: DataFrame, order: Order = Order()) -> DataFrame:
    """One row: rows, expected rows at one a minute, percent of them."""
    ends = df.agg(F.count(order.timestamp).alias("rows"), F.min(order.timestamp).alias("a"), F.max(order.timestamp).alias("b"))
    expected = F.floor((micros("b") - micros("a")) / 1e6 / PERIOD) + 1
    return ends.select("rows", expected.cast("long").alias("expected"), F.round(100.0 * F.col("rows") / expected, 3).alias("coverage_pct"))


def null_profile(df: DataFrame, order: Order = Order(), top: int = 10) -> DataFrame:
    """(column, nulls, pct, longest): the columns with most nulls, and their longest run of them; columns without any have 0. Only null cells are spread out."""
    columns = [c for c in df.columns if c not in (order.row, order.timestamp, *order.entities)]
    total = df.agg(F.count("*").alias("total"))
    cells = df.select(*order.entities, F.col(order.row).alias("row"), F.explode(F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in columns]))).alias("column"))
    own = Window.partitionBy(*order.entities, "column").orderBy("row")
    runs = cells.withColumn("run", F.col("row") - F.row_number().over(own)).groupBy(*order.entities, "column", "run").agg(F.count("*").alias("n"))
    some = runs.groupBy("column").agg(F.sum("n").alias("nulls"), F.max("n").alias("longest"))
    every = total.select("total", F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = every.join(some, "column", "left").select("column", "total", zero("nulls"), zero("longest"))
    return out.select("column", "nulls", F.round(100.0 * F.try_divide("nulls", "total"), 3).alias("pct"), "longest").orderBy(F.desc("nulls"), "column").limit(top)


def co_missing(df: DataFrame, signals: list[str]) -> DataFrame:
    """One row: rows with any, and with all, of the signals null."""
    lost = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("int") for c in signals])
    return df.agg(F.count_if(lost > 0).alias("any_null"), F.count_if(lost == len(signals)).alias("all_null"))


def largest_gaps(df: DataFrame, order: Order = Order(), top: int = 10) -> DataFrame:
    return deltas(df, order).filter(F.col("delta") > GAP).orderBy(F.desc("delta"), "row").limit(top).select("row", "delta")


def gap_excess(df: DataFrame, order: Order = Order()) -> DataFrame:
    """One row: seconds that gaps last beyond a regular step, in all."""
    return deltas(df, order).filter(F.col("delta") > GAP).agg(F.coalesce(F.sum(F.col("delta") - PERIOD), F.lit(0.0)).alias("excess_s"))


# The questions of the quality report, by rank.
QUESTIONS = [
    ("Are all timestamps parseable?", "critical", "bad_ts"),
    ("Are timestamps in order?", "critical", "out_of_order"),
    ("Are timestamps unique?", "critical", "duplicate_ts"),
    ("Are there gaps in the record?", "high", "gaps"),
    ("What is the sampling period?", "high", "median_s"),
    ("How regular is the sampling?", "high", "stdev_s"),
    ("Does the period drift?", "medium", "drift_s"),
    ("How complete is the record?", "high", "coverage_pct"),
    ("Which step is the largest?", "medium", "max_s"),
    ("Which step is the smallest?", "low", "min_s"),
    ("How much time do gaps take?", "medium", "excess_s"),
    ("How many rows lack a signal?", "medium", "any_null"),
    ("How many rows lack all signals?", "medium", "all_null"),
    ("How long is the longest run of nulls?", "medium", "longest"),
]


def quality_checklist(df: DataFrame, signals: list[str], order: Order = Order()) -> DataFrame:
    """(rank, question, importance, metric, value): the report's questions with their figures."""
    drift = cadence_drift(df, order).agg((F.max("median_s") - F.min("median_s")).alias("drift_s"))
    longest = null_profile(df, order).agg(F.max("longest").alias("longest"))
    one = reduce(lambda a, b: a.join(b), [cadence_counts(df, order), cadence_stats(df, order), drift, coverage(df, order).drop("rows"), gap_excess(df, order), co_missing(df, signals), longest])
    rows = [F.struct(F.lit(i + 1).alias("rank"), F.lit(q).alias("question"), F.lit(k).alias("importance"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for i, (q, k, m) in enumerate(QUESTIONS)]
    return one.select(F.inline(F.array(*rows)))


# exploration


def is_active(df: DataFrame) -> Column:
    """Some machine runs. Direct-drive flags don't count."""
    flags = [c for c in df.columns if c.endswith("_running")]
    return F.greatest(F.lit(0.0), *[flag01(F.col(c)) for c in flags]) > 0


def state_fractions(df: DataFrame, flags: list[str]) -> DataFrame:
    """(flag, pct)"""
    return df.agg(*[(F.avg(c) * 100).alias(c) for c in flags]).unpivot([], flags, "flag", "pct")


def daily_activity(df: DataFrame, active: Column, alarms: list[str], timestamp: str = "timestamp") -> DataFrame:
    """(day, active_fraction, and minutes of each alarm)"""
    return df.groupBy(F.date_trunc("day", timestamp).alias("day")).agg(F.avg(active.cast("double")).alias("active_fraction"), *[F.sum(c).alias(f"{c}_minutes") for c in alarms])


def describe(df: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """(column, n, mean, std, min, p25, p50, p75, max, cv), most variable first."""
    own = df.filter(where) if where is not None else df
    one = lambda c: F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), *[F.percentile(F.col(c), F.lit(q)).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)], F.max(c).cast("double").alias("max"))
    out = own.agg(F.array(*[one(c) for c in columns]).alias("a")).select(F.inline("a"))
    return out.withColumn("cv", F.when(F.abs("mean") >= 1e-12, F.try_divide(F.col("std"), F.abs("mean")))).orderBy(F.desc_nulls_last("cv"), "column")


def downsample(df: DataFrame, seconds: int, columns: list[str], timestamp: str = "timestamp") -> DataFrame:
    bin_ = F.timestamp_seconds(F.floor(micros(timestamp) / (seconds * 1_000_000)) * seconds)
    return df.groupBy(bin_.alias(timestamp)).agg(*[F.avg(c).alias(c) for c in columns])


def tracking_error(df: DataFrame, setpoint: str, measured: str, where: Column | None = None) -> DataFrame:
    return describe(df.select("*", (F.col(measured) - F.col(setpoint)).alias("error")), ["error"], where)


def correlations(df: DataFrame, columns: list[str], top: int = 20) -> DataFrame:
    """(a, b, r): the pairs with the largest absolute correlation, each once; one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    own = df.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r")) for a, b in pairs]).alias("p")).select(F.inline("p"))
    return own.filter(F.col("r").isNotNull()).orderBy(F.desc(F.abs("r")), "a", "b").limit(top)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int, group: Column) -> DataFrame:
    """(grp, bin, n); values outside are in bins 0 and bins + 1."""
    return df.filter(F.col(column).isNotNull()).groupBy(group.alias("grp"), F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))


def alarm_onsets(df: DataFrame, alarm: str, order: Order = Order()) -> DataFrame:
    """Rows in which the alarm rises."""
    flag = flag01(F.col(alarm))
    own = df.select("*", (flag - F.coalesce(F.lag(flag, 1).over(order.spec), F.lit(0.0))).alias("__rise"))
    return own.filter("__rise > 0").drop("__rise")


def alarm_window(df: DataFrame, alarm: str, columns: list[str], order: Order = Order(), minutes: int = 30) -> DataFrame:
    """Rows around the first onset, each column scaled to 0..1 within them; the onset is one row, so its join is one of a single row."""
    first = alarm_onsets(df, alarm, order).agg(F.min(order.timestamp).alias("__at")).filter(F.col("__at").isNotNull())
    near = F.abs(micros(order.timestamp) - micros("__at")) <= minutes * 60_000_000
    own = df.join(F.broadcast(first), near)
    whole = Window.partitionBy("__at")
    scaled = [F.when(F.max(c).over(whole) > F.min(c).over(whole), (F.col(c) - F.min(c).over(whole)) / (F.max(c).over(whole) - F.min(c).over(whole))).alias(c) for c in columns]
    return own.select(order.timestamp, *scaled)


def kpis(df: DataFrame, catalog: Catalog | None = None) -> DataFrame:
    """Specific energy and production rate."""
    return describe(df, [c for c in ("extruder_specific_energy", "granulator_production_rate") if c in df.columns])


