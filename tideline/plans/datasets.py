"""The dataset stage: master validation, and projections for model families."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..findings import detected, finding, frame
from ..frames import ROW, Order
from ..operators.cleaning import deltas
from ..policy import Settings, policy

CHECK = "master_validation"
PROJECTIONS = {"anomaly": "anomaly_detection", "forecasting": "forecasting", "energy": "energy"}


def select_columns(columns: list[str], spec: Settings, catalog: Catalog, check: str) -> tuple[list[str], list[tuple]]:
    """The columns that a selector picks, in the table's order, and what it has to say. Exclusion comes last, so it beats every inclusion, metadata too."""
    if not spec.enabled:
        return [], [finding(check, "normal", "skipped", "noop", reason="disabled")]
    have = set(columns)
    match = lambda patterns: {c for c in columns if any(re.search(p, c) for p in patterns)}
    by_pattern, by_kind = match(spec.include_patterns), set(catalog.in_category(columns, *spec.include_categories))
    named = [c for c in spec.include_columns if c in have]
    chosen = by_pattern | by_kind | set(named)
    if spec.include_metadata:
        chosen |= (set(catalog.metadata) | {"timestamp"}) & have
    out_pattern, out_named = match(spec.exclude_patterns), [c for c in spec.exclude_columns if c in have]
    chosen -= out_pattern | set(out_named)
    found: list[tuple] = []
    for kind, asked, hits in (("include_patterns", spec.include_patterns, sorted(by_pattern)), ("include_categories", spec.include_categories, sorted(by_kind)), ("include_columns", spec.include_columns, named)):
        if asked:
            found.append(finding(check, "normal", kind, f"match:{len(hits)}", count=len(hits), asked=asked, matched=hits))
    found += [finding(check, "aware", "unmatched_include", "skip", c, reason="not in the table") for c in spec.include_columns if c not in have]
    if spec.exclude_patterns or spec.exclude_columns:
        n = len(out_pattern) + len(out_named)
        found.append(finding(check, "normal", "exclude", f"drop:{n}", count=n, matched=sorted(out_pattern) + out_named))
        found += [finding(check, "aware", "unmatched_exclude", "skip", c, reason="not in the table") for c in spec.exclude_columns if c not in have]
    ordered = [c for c in columns if c in chosen]
    found.append(finding(check, "normal" if ordered else "important", "projection_summary", f"project:{len(ordered)}", count=len(ordered), source_columns=len(columns), selected_columns=len(ordered)))
    return ordered, found


def project(df: DataFrame, spec: Settings, catalog: Catalog, check: str) -> tuple[DataFrame, list[tuple]]:
    """The selected columns; a selector that picks none keeps the rows."""
    columns, found = select_columns([c for c in df.columns if c != ROW], spec, catalog, check)
    return df.select(*[F.col(f"`{c}`") for c in columns]), found


def timestamp_findings(df: DataFrame, timestamp: str = "timestamp", arrival: str = ROW, monotonic: bool = True, unique: bool = True) -> DataFrame:
    """Null, unordered and repeated timestamps. A null breaks the order; nulls repeat each other."""
    spark = df.sparkSession
    if timestamp not in df.columns:
        return frame(spark, [finding(CHECK, "important", "missing_timestamp", "none", reason="no timestamp column")])
    none = F.lit(None)
    nulls = df.agg(F.count_if(F.col(timestamp).isNull()).alias("n"))
    parts = [detected(nulls.filter("n > 0"), CHECK, "important", "timestamp_nat", "flag", none, none, F.col("n"))]
    if monotonic:
        bad = nulls
        if arrival in df.columns:  # steps are taken in chunks, so no task has the whole table
            back = deltas(df.select(timestamp, arrival), Order((), timestamp, arrival)).filter("delta < 0").agg(F.count("*").alias("n"))
            bad = nulls.unionAll(back).agg(F.sum("n").alias("n"))
        parts.append(detected(bad.filter("n > 0"), CHECK, "important", "non_monotonic_timestamps", "flag", none, none, F.lit(1)))
    if unique:
        repeats = df.groupBy(timestamp).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).filter("n > 0")
        parts.append(detected(repeats, CHECK, "important", "duplicate_timestamps", "flag", none, none, F.col("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_budget_findings(df: DataFrame, most: float) -> DataFrame:
    """Columns with a larger share of nulls than the budget, from one aggregation."""
    columns = [c for c in df.columns if c != ROW]
    shares = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in columns]).unpivot([], [F.col(f"`{c}`") for c in columns], "column", "share")
    own = shares.filter(F.col("share") > most)
    return detected(own, CHECK, "important", "nan_budget_breach", "flag", F.lit(None), F.lit(None), F.lit(1), F.col("column"), F.struct(F.round("share", 6).alias("nan_fraction"), F.lit(most).alias("threshold")))


def schema_of(df: DataFrame) -> dict[str, str]:
    return {n: t for n, t in df.dtypes if n != ROW}


def write_schema_lock(df: DataFrame, path: str) -> None:
    from ..findings import _write

    _write(df.sparkSession, path, json.dumps(schema_of(df), indent=2))


def schema_findings(df: DataFrame, path: str | None) -> list[tuple]:
    """Differences from the locked schema. Without a lock the finding asks for one; nothing is written here."""
    locked = None
    if path:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            locked = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
    if locked is None:
        return [finding(CHECK, "normal", "schema_lock_missing", "bootstrap")]
    now = schema_of(df)
    added, removed = [c for c in now if c not in locked], [c for c in locked if c not in now]
    changed = {c: [locked[c], now[c]] for c in now if c in locked and locked[c] != now[c]}
    out = []
    for kind, names in (("schema_added_columns", added), ("schema_removed_columns", removed), ("schema_dtype_drift", list(changed))):
        if names:
            out.append(finding(CHECK, "aware", kind, "flag", count=len(names), columns=names))
    return out or [finding(CHECK, "normal", "schema_lock_match", "none", count=len(now))]


def validate_master(df: DataFrame, settings: Settings | None = None, lock_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(master, findings)"""
    p = settings or policy("datasets").master_validation
    spark = df.sparkSession
    if not p.enabled:
        return df, frame(spark, [finding(CHECK, "normal", "skipped", "noop", reason="disabled")])
    gone, absent = [c for c in p.drop_columns if c in df.columns], [c for c in p.drop_columns if c not in df.columns]
    said = [finding(CHECK, "normal", "dropped_columns", f"drop:{len(gone)}", count=len(gone), columns=gone)] if gone else []
    said += [finding(CHECK, "normal", "drop_skipped", "skip", count=len(absent), columns=absent)] if absent else []
    master = df.drop(*gone)
    if p.schema_lock:
        said += schema_findings(master, lock_path)
    columns = len([c for c in master.columns if c != ROW])
    rows = detected(master.agg(F.count("*").alias("n")), CHECK, "normal", "master_summary", f"promote:{columns}", F.lit(None), F.lit(None), F.lit(columns), None, F.struct(F.col("n").alias("rows"), F.lit(columns).alias("columns")))
    found = frame(spark, said).unionByName(rows).unionByName(timestamp_findings(master, monotonic=p.require_monotonic_timestamps, unique=p.require_unique_timestamps))
    return master, found.unionByName(null_budget_findings(master, p.max_nan_fraction_per_column))


def run_datasets(df: DataFrame, catalog: Catalog, settings: Settings | None = None, lock_path: str | None = None) -> dict[str, tuple[DataFrame, DataFrame]]:
    """master, anomaly, forecasting and energy, each with its findings. The projections are views of the master, so a reader of one scans its columns only."""
    p = settings or policy("datasets")
    master, found = validate_master(df, p.master_validation, lock_path)
    out = {"master": (master, found)}
    for name, key in PROJECTIONS.items():
        own, said = project(master, p[key], catalog, key)
        out[name] = (own, frame(df.sparkSession, said))
    return out
