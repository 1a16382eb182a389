"""One long series on many executors: ordinals, windows and running totals without a task that holds all rows.

Rows are dealt by time range and numbered within each range; a small table of range
sizes gives global ordinals. Windows of bounded reach run in chunks of
consecutive rows, each with the last rows of the chunk before it (the halo). Running
totals take each chunk's total, add up the totals of earlier chunks, and add that.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..frames import ROW, Feature, Order, add_features, outcome, running_of, since, with_level
from ..scratch import materialise

#: Rows of a chunk. A chunk is sorted and windowed by one task.
CHUNK_ROWS = 1_000_000
CHUNK, HALO = "_chunk", "_halo"
#: Rows of a chunk where hundreds of features are made of each.
FEATURE_ROWS = 20_000
#: Partitions that chunks are dealt to, at most.
MOST_PARTITIONS = 100_000
#: Chunks that a side may have at most to be broadcast.
BROADCAST_CHUNKS = 100_000


def numbered(df: DataFrame, *keys: str, row: str = ROW) -> DataFrame:
    """df with ordinals from 0 by the keys, which must order all rows. The dealt table is written, so ranges don't change between the two passes."""
    dealt = materialise(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_from"))  # a row for each partition
    own = Window.partitionBy("_part").orderBy(*keys)
    return dealt.withColumn("_i", F.row_number().over(own)).join(F.broadcast(starts), "_part").withColumn(row, (F.col("_from") + F.col("_i") - 1).cast("long")).drop("_part", "_from", "_i")


def positions(df: DataFrame, row: str = ROW, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """df with _at, the place of each row from 0 by its ordinal (which may have holes), and _n, the number of rows."""
    own = df.withColumn(CHUNK, F.floor(F.col(row) / chunk_rows))
    sizes = own.groupBy(CHUNK).agg(F.count("*").alias("_k"))
    starts = sizes.select(CHUNK, (F.sum("_k").over(Window.orderBy(CHUNK)) - F.col("_k")).alias("_from"), F.sum("_k").over(Window.partitionBy()).alias("_n"))  # a row for each chunk
    inside = F.row_number().over(Window.partitionBy(CHUNK).orderBy(row))
    return own.withColumn("_i", inside).join(starts, CHUNK).withColumn("_at", F.col("_from") + F.col("_i") - 1).drop(CHUNK, "_i", "_from")


def running_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """df with _upto, the sum of value over all rows up to each in order of key (which is unique), and _total."""
    dealt = materialise(df.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy("_part").agg(F.sum(value).alias("_s"))
    starts = sums.select("_part", (F.sum("_s").over(Window.orderBy("_part")) - F.col("_s")).alias("_from"), F.sum("_s").over(Window.partitionBy()).alias("_total"))  # a row for each partition
    inside = F.sum(value).over(Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("_in", inside).join(F.broadcast(starts), "_part").withColumn("_upto", F.col("_from") + F.col("_in")).drop("_part", "_from", "_in")


def in_chunks(df: DataFrame, halo: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """df with each row in its chunk, and the last `halo` rows of each chunk again, marked, before the next one."""
    own = F.floor(F.col(ROW) / chunk_rows)
    last = F.col(ROW) % chunk_rows >= chunk_rows - halo
    places = F.array_compact(F.array(F.struct(own.alias("c"), F.lit(False).alias("h")), F.when(last, F.struct((own + 1).alias("c"), F.lit(True).alias("h")))))
    return df.withColumn("_p", F.explode(places)).withColumn(CHUNK, F.col("_p.c")).withColumn(HALO, F.col("_p.h")).drop("_p")


def chunk_order(timestamp: str = "timestamp") -> Order:
    return Order((CHUNK,), timestamp, ROW)


def add_bounded_features(df: DataFrame, features: list[Feature], halo: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """df (numbered) with features that look back `halo` rows at most, made for chunk_order(). The reach is the largest window plus 2, and twice the largest lag."""
    if halo > chunk_rows:
        raise ValueError("the halo is larger than a chunk")
    return add_features(in_chunks(df, halo, chunk_rows), features).filter(~F.col(HALO)).drop(HALO, CHUNK)


def add_features_in_chunks(df: DataFrame, features: list[Feature], halo: int, timestamp: str = "timestamp", chunk_rows: int = FEATURE_ROWS) -> DataFrame:
    """df (numbered without holes) with features made for chunk_order(): windows look back `halo` rows at most, and running values go on from chunk to chunk. A first pass over the running values' columns gives each chunk's totals; the chunks before are added up in a table with a row for each chunk."""
    order, chunk_rows = chunk_order(timestamp), max(chunk_rows, halo)
    runs = running_of(features)
    # so many partitions are asked for: adaptive execution would put chunks together, as it sees their bytes and not the hundreds of windows
    last = df.agg(F.max(ROW)).first()[0]
    parts = min(MOST_PARTITIONS, 2 * ((last or 0) // chunk_rows + 1))
    own = with_level(in_chunks(df, halo, chunk_rows).repartition(parts, CHUNK), features, "helpers")
    if not runs:
        return with_level(own, features, "windows").filter(~F.col(HALO)).select(*outcome(df.columns, features))
    value, reset = (lambda r: F.when(~F.col(HALO), r.value)), (lambda r: F.when(~F.col(HALO), r.reset))
    kept = [replace(r, value=F.coalesce(F.col(f"__v_{r.name}"), F.lit(0.0)) if r.how == "since" else F.col(f"__v_{r.name}"), reset=F.col(f"__r_{r.name}") if r.reset is not None else None) for r in runs]
    columns = [*[value(r).alias(f"__v_{r.name}") for r in runs], *[reset(r).alias(f"__r_{r.name}") for r in runs if r.reset is not None]]
    inside = own.select(CHUNK, ROW, timestamp, HALO, *columns).filter(~F.col(HALO))
    totals, whole = [], []
    for r in kept:
        if r.how == "since":
            totals += [F.sum(r.value).alias(f"__t_{r.name}"), F.max_by(F.col(f"__upto_{r.name}") - F.col(f"__base_{r.name}"), ROW).alias(f"__u_{r.name}")]
        elif r.how in ("sum", "max"):
            totals.append((F.sum if r.how == "sum" else F.max)(r.value).alias(f"__t_{r.name}"))
        else:
            whole.append((F.avg if r.how == "mean" else F.stddev_samp)(r.value).alias(r.name))
    chunks = since(inside, kept, order).groupBy(CHUNK).agg(F.count("*").alias("__n"), *totals)
    so_far, to_here = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, 0)
    # what is left of a sum since the last reset, as if it had never been reset
    chunks = chunks.select("*", *[(F.col(f"__u_{r.name}") - F.sum(f"__t_{r.name}").over(to_here)).alias(f"__g_{r.name}") for r in kept if r.how == "since"])
    carried = []
    for r in kept:
        before = {"sum": F.sum, "max": F.max, "since": F.sum}.get(r.how)
        if before is not None:
            total = before(f"__t_{r.name}").over(so_far)
            left = F.coalesce(F.last(f"__g_{r.name}", ignorenulls=True).over(so_far), F.lit(0.0)) if r.how == "since" else None
            carried.append((total if left is None else F.coalesce(total, F.lit(0.0)) + left).alias(f"__o_{r.name}"))
    offsets = materialise(chunks.select(CHUNK, *carried), "offsets")
    offsets = F.broadcast(offsets) if offsets.count() <= BROADCAST_CHUNKS else offsets
    made = with_level(own.select("*", *columns), features, "windows")
    made = since(made, kept, order)
    made = made.select("*", *[(F.sum if r.how == "sum" else F.max)(r.value).over(order.to_here).alias(f"__l_{r.name}") for r in kept if r.how in ("sum", "max")])
    made = made.filter(~F.col(HALO)).join(offsets, CHUNK)
    if whole:
        made = made.join(F.broadcast(inside.agg(*whole)))  # one row

    def joined(r):
        here, before = F.col(f"__l_{r.name}"), F.col(f"__o_{r.name}")
        if r.how == "since":
            return F.when(F.col(f"__base_{r.name}").isNull(), F.col(f"__upto_{r.name}") + before).otherwise(F.col(f"__upto_{r.name}") - F.col(f"__base_{r.name}"))
        return F.coalesce(here + before, here, before) if r.how == "sum" else F.greatest(here, before)

    made = made.select("*", *[joined(r).alias(r.name) for r in kept if r.how in ("sum", "max", "since")])
    return made.select(*outcome(df.columns, features))


def running(df: DataFrame, values: dict[str, tuple[str, Column]], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """df (numbered) with running sums or maxima: name to ("sum" or "max", value)."""
    how = {"sum": F.sum, "max": F.max}
    own = df.withColumn(CHUNK, F.floor(F.col(ROW) / chunk_rows)).select("*", *[c.alias(f"_v_{n}") for n, (_, c) in values.items()])
    here = Window.partitionBy(CHUNK).orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    totals = own.groupBy(CHUNK).agg(*[how[k](f"_v_{n}").alias(f"_t_{n}") for n, (k, _) in values.items()])
    offsets = totals.select(CHUNK, *[how[k](f"_t_{n}").over(before).alias(f"_o_{n}") for n, (k, _) in values.items()])  # a row for each chunk
    inside = own.select("*", *[how[k](f"_v_{n}").over(here).alias(f"_h_{n}") for n, (k, _) in values.items()]).join(offsets, CHUNK)
    out = []
    for n, (k, _) in values.items():
        h, o = F.col(f"_h_{n}"), F.col(f"_o_{n}")
        out.append((F.coalesce(h + o, h, o) if k == "sum" else F.greatest(h, o)).alias(n))
    return inside.select(*[F.col(f"`{c}`") for c in df.columns], *out)
