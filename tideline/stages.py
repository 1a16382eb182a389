"""Stages over files, and the chain of all of them."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .catalog import Catalog
from .findings import write_json, write_markdown
from .frames import ROW, Order
from .operators.cleaning import clean
from .plans.datasets import run_datasets
from .plans.features import run_engineering, run_time_series
from .policy import Settings, load_policy, policy
from .scratch import materialise
from .sources import read_raw, read_table, write_table

STAGES = ("cleaning", "time_series", "engineering", "datasets")


def chain(raw: DataFrame, catalog: Catalog | None = None, policies: dict[str, Settings] | None = None, order: Order = Order(), lock_path: str | None = None) -> dict[str, tuple[DataFrame, DataFrame]]:
    """All stages on a raw table with ordinals: name to (table, findings). Between stages tables are written, which keeps plans of hundreds of columns apart."""
    catalog = catalog or Catalog.default()
    p = {s: (policies or {}).get(s) or policy(s) for s in STAGES}
    cleaned, found = clean(raw, catalog, p["cleaning"], order)
    out = {"cleaning": (materialise(cleaned, "clean"), found)}
    featured, found = run_time_series(out["cleaning"][0], catalog, p["time_series"], order)
    out["time_series"] = (materialise(featured, "features"), found)
    engineered, found = run_engineering(out["time_series"][0], catalog, p["engineering"], order)
    out["engineering"] = (materialise(engineered, "engineered"), found)
    return out | run_datasets(out["engineering"][0], catalog, p["datasets"], lock_path)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tideline", description="Run stages of the telemetry pipeline.")
    parser.add_argument("--input", required=True, help="raw export, clean CSV or Parquet")
    parser.add_argument("--output", required=True, help="folder for tables and reports")
    parser.add_argument("--stage", choices=["cleaning", "features", "all"], default="all")
    parser.add_argument("--raw", action="store_true", help="the input has three header lines")
    parser.add_argument("--policy", action="append", default=[], metavar="STAGE=FILE", help=f"policy file of a stage ({', '.join(STAGES)})")
    parser.add_argument("--schema-lock")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    policies = {s: load_policy(s, f) for s, f in (x.split("=", 1) for x in args.policy)}
    order = Order()
    raw = read_raw(spark, args.input) if args.raw else read_table(spark, args.input)
    if ROW not in raw.columns:
        raw = order.number(raw)
    if args.stage == "cleaning":
        results = {"cleaning": clean(raw, settings=policies.get("cleaning"), order=order)}
    else:
        results = chain(raw, policies=policies, order=order, lock_path=args.schema_lock)
        if args.stage == "features":
            results = {k: results[k] for k in ("cleaning", "time_series", "engineering")}
    for name, (table, found) in results.items():
        write_table(table, f"{args.output}/{name}.parquet")
        write_json(found, f"{args.output}/reports/{name}.json")
        write_markdown(found, f"{args.output}/reports/{name}.md", f"{name} report")
    return 0
