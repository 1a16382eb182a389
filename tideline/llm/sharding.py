"""Global shuffle into shards by a two-pass external shuffle (operator 3).

Pass one scatters rows uniformly into buckets that fit in memory, by a seeded hash of
the whole row (so equal texts spread, and rows of one id), and counts the buckets. Pass
two shuffles each bucket by Fisher-Yates with a generator seeded by bucket, and writes it.
The concatenated buckets are one random order; shard s takes the places from
ceil(s*N/shards) on, so shard sizes differ by one at most (law `rows`), and a bucket's
rows go to one or two shards only (unless buckets are fewer than shards): few files, no
second shuffle. Each shard's files are in a folder of their own.

The number of buckets follows from the bytes alone, and before Fisher-Yates each bucket is
sorted by all its values; so a table and a seed give one order, whatever the settings or
the partitions of the input, also when a task runs again after a lost executor.

Defined results: null text is kept and has size 16; null ids are scattered by their other
values. Repeated rows each get a place; rows that are equal in every column share a
bucket. An empty table gives empty shards. Other columns are carried, whatever their names
(of columns of map type only the sorted entries take part in the hash).
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import fresh, materialise, partitions, sized, tidy

#: Bytes of text that a bucket should hold.
BUCKET_BYTES = 8 << 20
SHARDS = 40
SEED = 20240229


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def fisher_yates(n: int, seed: str) -> np.ndarray:
    """A uniform permutation of range(n), the same for the same seed on every machine."""
    draw, order = random.Random(seed), np.arange(n)
    for i in range(n - 1, 0, -1):
        j = int(draw.random() * (i + 1))
        order[i], order[j] = order[j], order[i]
    return order


def _shuffle(bucket_col: str, order_col: str, place_col: str, seed: int, out: pa.Schema):
    """Rows come sorted by bucket; each bucket is gathered, shuffled and given out before the next."""

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts)
        bucket = whole.column(bucket_col)[0].as_py()
        order = fisher_yates(whole.num_rows, f"{seed}/{bucket}")
        whole = whole.drop_columns([order_col]).take(pa.array(order)).append_column(place_col, pa.array(np.arange(whole.num_rows)))
        yield from whole.select(out.names).cast(out).to_batches(max_chunksize=2000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            key = batch.column(batch.schema.get_field_index(bucket_col)).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else []
            for a, b in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
                if held and held[0].column(held[0].schema.get_field_index(bucket_col))[0].as_py() != key[a]:
                    yield from flush(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from flush(held)

    return run


def external_shuffle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write the rows of docs in shuffled order to the shared folder; the files read back, with all columns and a struct `place` of shard and slot (renamed if docs has that name)."""
    spark = docs.sparkSession
    bucket_col, order_col, at_col, shard_col, slot_col, place, start_col, total_col = (fresh(docs, x) for x in ("bucket_", "order_", "at_", "shard_", "slot_", "place", "start_", "total_"))
    values = [F.array_sort(F.map_entries(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in docs.schema.fields]
    total = docs.agg(F.coalesce(F.sum(record_size(F.col(text_col))), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    hashed = F.xxhash64(F.lit(seed), *values)
    bucket = F.pmod(hashed, F.lit(buckets))
    counts = materialise(docs.groupBy(bucket.alias(bucket_col)).agg(F.count("*").alias("rows")), "buckets")
    starts = materialise(running_starts(counts, bucket_col, "rows", start_col, total_col), "starts")
    scattered = docs.withColumn(bucket_col, bucket).withColumn(order_col, hashed)
    inner = T.StructType([*docs.schema.fields, T.StructField(bucket_col, T.LongType()), T.StructField(at_col, T.LongType())])
    # in one bucket: by hash, and by a second one where it ties
    dealt = scattered.repartition(max(partitions(spark), min(buckets, 100_000)), F.col(bucket_col)).sortWithinPartitions(bucket_col, order_col, F.col(f"`{id_col}`"), F.xxhash64(*values))
    shuffled = dealt.mapInArrow(tidy(_shuffle(bucket_col, order_col, at_col, seed, to_arrow_schema(inner))), inner)
    at = f"(`{start_col}` + `{at_col}`)"
    shard = F.expr(f"{at} * {shards} div `{total_col}`")
    slot = F.expr(f"{at} - (({at} * {shards} div `{total_col}`) * `{total_col}` + {shards - 1}) div {shards}")
    own = [F.col(f"`{c}`") for c in docs.columns]
    placed = shuffled.join(sized(starts), bucket_col).select(*own, slot.alias(slot_col), shard.cast("int").alias(shard_col))
    return materialise(placed, "shards", shard_col).select(*own, F.struct(F.col(shard_col).alias("shard"), F.col(slot_col).alias("slot")).alias(place))


def running_starts(counts: DataFrame, bucket_col: str, rows_col: str, start_col: str, total_col: str, block: int = 4096) -> DataFrame:
    """(bucket, start, total): how many rows come before each bucket, and are there in all. Blocks of buckets are added up on their own, then the blocks, so no task has all buckets."""
    numbered = counts.withColumn("block_", F.floor(F.col(bucket_col) / block))
    within = F.sum(rows_col).over(Window.partitionBy("block_").orderBy(bucket_col)) - F.col(rows_col)
    blocks = numbered.groupBy("block_").agg(F.sum(rows_col).alias("all_"))
    before = blocks.select("block_", (F.sum("all_").over(Window.orderBy("block_")) - F.col("all_")).alias("before_"), F.sum("all_").over(Window.partitionBy()).alias(total_col))
    return numbered.withColumn("within_", within).join(before, "block_").select(bucket_col, (F.col("within_") + F.col("before_")).alias(start_col), total_col)


def shard_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """A row for each row of the written shards: id, size, text_crc32, law, shard, slot, grown_shard."""
    written = external_shuffle(docs.select(id_col, text_col), id_col, text_col, shards, seed)
    return written.select(
        id_col,
        record_size(F.col(text_col)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("place.shard").alias("shard"),
        F.col("place.slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

