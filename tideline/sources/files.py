"""Raw exports with three header lines, clean CSV, Parquet, and a generator of machine cycles."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import VARIABLES, telemetry_schema
from ..frames import ROW

#: Texts that mean a missing value.
NULLS = ["", "NaN", "nan", "NULL", "null", "None"]
FORMATS = ["yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss"]


def parse_timestamp(c: Column) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in FORMATS])


def parse_number(c: Column) -> Column:
    """A number with a decimal comma or point; null if it is none."""
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def read_raw(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """A raw export: descriptions, sensor codes, units, then data with decimal commas. names: sensor code to column; without it columns are those of the catalogue in file order. Rows keep their place in the file as an ordinal."""
    head = [next(csv.reader([line])) for (line,) in spark.read.text(path).limit(3).collect()]
    if len(head) < 3:
        raise ValueError("three header lines are wanted")
    codes = head[1]
    columns = [names.get(c, c) for c in codes] if names else [v[0] for v in VARIABLES][: len(codes)]
    if "timestamp" not in columns:
        raise ValueError("no column is named timestamp")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    # the place in the file, for the order of arrival: file, then offset within it
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias(ROW))
    body = lines.filter(F.col(ROW) >= 3).select(ROW, F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"quote": '"'}).alias("r"))
    ids = {v[0] for v in VARIABLES if v[1] == "categorical"}

    def one(c: str) -> Column:
        raw = F.trim(F.col(f"r.{c}"))
        held = F.when(~raw.isin(NULLS), raw)
        return (held if c in ids else parse_timestamp(held) if c == "timestamp" else parse_number(held)).alias(c)

    return body.select(*[one(c) for c in columns], ROW)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, or CSV with a header, by the path's ending. CSV has the given schema, else the telemetry schema; nothing is inferred."""
    if path.rstrip("/").endswith(".csv"):
        own = schema or telemetry_schema()
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in own.fields])
        raw = spark.read.csv(path, header=True, schema=text)
        out = []
        for f in own.fields:
            c = F.when(~F.trim(F.col(f.name)).isin(NULLS), F.col(f.name))
            out.append((F.coalesce(parse_timestamp(c), c.try_cast("timestamp")) if isinstance(f.dataType, T.TimestampType) else c.try_cast(f.dataType)).alias(f.name))
        return raw.select(*out)
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, csv_mirror: str | None = None) -> None:
    """Parquet or CSV by the path's ending, and a CSV copy if asked for. The ordinal isn't written."""
    df = df.drop(ROW)
    for target in [path, *([csv_mirror] if csv_mirror else [])]:
        if target.rstrip("/").endswith(".csv") or target == csv_mirror:
            df.write.mode("overwrite").option("timestampFormat", FORMATS[0]).csv(target, header=True)
        else:
            df.write.mode("overwrite").parquet(target)


def synthetic_cycles(spark: SparkSession, n: int = 2000, seed: int = 0, start: str = "2025-01-01 00:00:00") -> DataFrame:
    """Machine cycles every 40 s with slow drift and four kinds of anomaly (3 % of cycles begin one)."""
    normal = lambda mean, spread, k: F.lit(mean) + F.randn(seed + k) * spread
    drift = F.least(F.col("id") * 0.002, F.lit(5.0))
    base = spark.range(n).withColumn("u", F.rand(seed + 50)).withColumn("v", F.rand(seed + 51))
    kind = F.when(F.col("u") < 0.03, F.when(F.col("v") < 0.4, "temperatura_alta").when(F.col("v") < 0.7, "presion_baja").when(F.col("v") < 0.9, "ciclo_lento").otherwise("sensor"))
    base = base.withColumn("tipo_anomalia", F.coalesce(kind, F.lit("ninguna")))
    hit = lambda name: F.when(F.col("tipo_anomalia") == name, 1.0).otherwise(0.0)
    signals = {
        "temperatura_material": normal(220.0, 2.0, 1) + drift + 25 * hit("temperatura_alta"),
        "temperatura_molde": normal(60.0, 1.0, 2) + drift * 0.3,
        "presion_inyeccion": normal(900.0, 15.0, 3) - 200 * hit("presion_baja"),
        "presion_mantenimiento": normal(500.0, 10.0, 4),
        "presion_cavidad": normal(350.0, 8.0, 5) - 80 * hit("presion_baja"),
        "velocidad_inyeccion": normal(80.0, 2.0, 6),
        "posicion_tornillo": normal(120.0, 1.5, 7),
        "tiempo_inyeccion": normal(2.5, 0.1, 8),
        "tiempo_enfriamiento": normal(15.0, 0.5, 9),
        "tiempo_ciclo": normal(40.0, 0.8, 10) + 12 * hit("ciclo_lento"),
        "volumen_especifico": normal(1.1, 0.01, 11),
        "energia_consumida": normal(3.2, 0.1, 12) + drift * 0.02,
    }
    state = F.when(F.col("tipo_anomalia") != "ninguna", "anomalia").when(drift > 4, "warning").otherwise("normal")
    at = F.timestamp_micros(F.unix_micros(F.lit(start).cast("timestamp")) + F.col("id") * 40_000_000)
    return base.select(at.alias("tiempo"), F.col("id").alias("ciclo_id"), *[c.alias(k) for k, c in signals.items()], state.alias("estado"), "tipo_anomalia")
