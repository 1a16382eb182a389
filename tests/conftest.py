from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import SparkSession

from tideline.catalog import VARIABLES, telemetry_schema
from tideline.frames import Order

START = dt.datetime(2025, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def telemetry(spark):
    """A table of the 37 columns without any defect; edits: column to {row: value} or to a function of the row."""

    def make(n: int = 20, period: float = 60.0, times: dict | None = None, **edits):
        rows = []
        for i in range(n):
            row = {}
            for name, kind, _, _, unit in VARIABLES:
                row[name] = "x" if kind == "categorical" else (0.0 if name.endswith("_alarm") else 1.0) if kind == "bool" else 5.0 if unit == "bar" else 50.0 if unit in ("C", "%") else 1.0
            row["timestamp"] = START + dt.timedelta(seconds=i * period)
            if times and i in times:
                row["timestamp"] = times[i]
            for name, edit in edits.items():
                if callable(edit):
                    row[name] = edit(i)
                elif i in edit:
                    row[name] = edit[i]
            rows.append(tuple(row[v[0]] for v in VARIABLES) + (i,))
        schema = telemetry_schema().add("_row", "long")
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def series(spark):
    """A table of one column x (and more by name) at one a minute, with ordinals."""

    def make(x: list, start: dt.datetime = START, **more):
        names = ["x", *more]
        rows = [(start + dt.timedelta(minutes=i), i, *[None if v is None else float(v) for v in vals]) for i, vals in enumerate(zip(x, *more.values(), strict=True))]
        return spark.createDataFrame(rows, "timestamp timestamp, _row long, " + ", ".join(f"{n} double" for n in names))

    return make


@pytest.fixture(scope="session")
def order():
    return Order()
