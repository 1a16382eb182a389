from __future__ import annotations

import datetime as dt

import pytest

from tideline.catalog import VARIABLES
from tideline.frames import Order, add_features
from tideline.functions.families import Families
from tideline.sources import read_raw, read_table, synthetic_cycles, write_table
from tideline.streaming import stream_resample, stream_rolling


def test_raw_export(spark, tmp_path):
    n = len(VARIABLES)
    head = [",".join(["d"] * n), ",".join(f"P{i}" for i in range(n)), ",".join(["u"] * n)]
    row = lambda ts, x: ",".join([ts, *["id"] * 4, x, *['"1,5"'] * (n - 6)])
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([*head, row("2025-01-01 00:00:00.250", '"2,5"'), row("2025-01-01 00:01:00", "NaN"), row("bad", "None")]) + "\n")
    out = read_raw(spark, str(path)).orderBy("_row").collect()
    assert [r.timestamp for r in out] == [dt.datetime(2025, 1, 1, 0, 0, 0, 250000), dt.datetime(2025, 1, 1, 0, 1), None]
    assert [r.feeder_max_speed_sp for r in out] == [2.5, None, None] and out[0].work_order == "id" and out[0].inlet_hopper_temp == 1.5
    named = read_raw(spark, str(path), {"P0": "timestamp", "P5": "speed"})
    assert "speed" in named.columns and "P1" in named.columns
    with pytest.raises(ValueError):
        read_raw(spark, str(path), {"P0": "time"})


def test_files_and_generator(spark, tmp_path, series):
    df = series([1.5, None, 3])
    write_table(df, f"file://{tmp_path}/t.parquet", f"file://{tmp_path}/t.csv")
    assert read_table(spark, f"file://{tmp_path}/t.parquet").drop("_row").exceptAll(df.drop("_row")).count() == 0
    assert read_table(spark, f"file://{tmp_path}/t.csv", df.drop("_row").schema).exceptAll(df.drop("_row")).count() == 0
    cycles = synthetic_cycles(spark, 500, 1)
    assert cycles.count() == 500 and len(cycles.columns) == 16
    assert 0 < cycles.filter("tipo_anomalia <> 'ninguna'").count() < 60


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"m{i % 2}", dt.datetime(2025, 1, 1) + dt.timedelta(minutes=i), float((i * 7) % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "machine string, ts timestamp, x double")
    for k in range(3):
        df.filter(f"minute(ts) div 20 = {k}").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = stream_rolling(stream, "machine", "ts", "x", 5, "2 hours").writeStream.format("memory").queryName("rolled").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    got = {(r.machine, r.ts): r for r in spark.table("rolled").collect()}
    order = Order(("machine",), "ts")
    f = Families(order)
    want = add_features(order.number(df), [f.rolling_mean("x", 5), f.rolling_z("x", 5)]).collect()
    assert len(got) == 60
    for r in want:
        for c in ("x_mean_5", "x_z_5"):
            a, b = r[c], got[r.machine, r.ts][c]
            assert (a is None and (b is None or b != b)) or a == pytest.approx(b)


def test_stream_resample(spark, tmp_path):
    rows = [("m", dt.datetime(2025, 1, 1) + dt.timedelta(seconds=20 * i), float(i)) for i in range(12)]
    spark.createDataFrame(rows, "machine string, ts timestamp, x double").coalesce(1).write.parquet(str(tmp_path / "in/0"))
    stream = spark.readStream.schema("machine string, ts timestamp, x double").parquet(str(tmp_path / "in/0"))
    query = stream_resample(stream, "machine", "ts", {"x": "mean"}).writeStream.format("memory").queryName("binned").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.x for r in spark.table("binned").collect()) == [1.0, 4.0, 7.0, 10.0]
