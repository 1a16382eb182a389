"""Exact deduplication with counting quotient filters (operator 1).

A fingerprint of 64 bits splits into a quotient (the slot a filter addresses) and
a remainder (what it stores). Each partition packs the fingerprints of its rows
into one filter for each range of quotients; filters of one range merge without
loss by merging their sorted remainders and adding the counters. Only
fingerprints whose merged count is above one go to byte verification, which
groups the whole normalised texts.

Defined results: null text counts as empty; all texts that are empty after
normalisation are equal. A null id can't be kept while an equal text has an id.
Rows that repeat both id and text share one decision, and `deduplicated` keeps one
of them. An empty table gives an empty result. Other columns are carried, whatever
their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, partitions, sized, small_batches, tidy

#: What normalisation deletes: every character of [\x20\x09-\x0D].
DELETED = b" \t\n\x0b\x0c\r"


@dataclass
class QuotientFilter:
    """Sorted distinct fingerprints with counts, as quotient bitmap, run ends, remainders and counters.

    bits is the number of quotient bits below the `skip` highest ones, which all
    fingerprints of the filter share.
    """

    skip: int
    prefix: int
    bits: int
    occupied: np.ndarray  # a bit for each quotient: it has a run
    run_end: np.ndarray  # a bit for each slot: its run ends here
    remainders: np.ndarray  # uint64, ascending within a run
    counted: np.ndarray  # a bit for each slot: a counter follows
    counters: np.ndarray  # uint32, for the counted slots in order

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray, skip: int) -> QuotientFilter:
        """fingerprints: ascending and distinct, alike in their highest skip bits."""
        n = len(fingerprints)
        bits = max(1, int(np.ceil(np.log2(max(n, 1) / 0.95))))
        low = 64 - skip - bits
        body = fingerprints & np.uint64((1 << (64 - skip)) - 1)
        quotients = (body >> np.uint64(low)).astype(np.int64)
        occupied = np.zeros(1 << bits, bool)
        occupied[quotients] = True
        many = counts > 1
        return cls(
            skip,
            int(fingerprints[0] >> np.uint64(64 - skip)) if n and skip else 0,
            bits,
            np.packbits(occupied),
            np.packbits(np.append(quotients[1:] != quotients[:-1], True) if n else np.zeros(0, bool)),
            body & np.uint64((1 << low) - 1),
            np.packbits(many),
            counts[many].astype(np.uint32),
        )

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints in ascending order, and their counts."""
        n = len(self.remainders)
        ends = np.unpackbits(self.run_end, count=n).astype(np.int64)
        runs = np.flatnonzero(np.unpackbits(self.occupied, count=1 << self.bits))
        quotients = runs[np.cumsum(ends) - ends].astype(np.uint64)
        counts = np.ones(n, np.int64)
        counts[np.unpackbits(self.counted, count=n).astype(bool)] = self.counters
        body = (quotients << np.uint64(64 - self.skip - self.bits)) | self.remainders
        return body | (np.uint64(self.prefix) << np.uint64(64 - self.skip) if self.skip else np.uint64(0)), counts

    def pack(self) -> bytes:
        width = (64 - self.skip - self.bits + 7) // 8
        slots = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = struct.pack("<BBQQQ", self.skip, self.bits, self.prefix, len(self.remainders), len(self.counters))
        return b"".join([head, self.occupied.tobytes(), self.run_end.tobytes(), slots.tobytes(), self.counted.tobytes(), self.counters.astype("<u4").tobytes()])

    @classmethod
    def unpack(cls, packed: bytes) -> QuotientFilter:
        skip, bits, prefix, n, many = struct.unpack_from("<BBQQQ", packed)
        at, width = struct.calcsize("<BBQQQ"), (64 - skip - bits + 7) // 8

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(packed, kind, count, at)
            at += out.nbytes
            return out

        occupied, run_end = take(np.uint8, ((1 << bits) + 7) // 8), take(np.uint8, (n + 7) // 8)
        slots = np.zeros((n, 8), np.uint8)
        slots[:, :width] = take(np.uint8, n * width).reshape(n, width)
        return cls(skip, prefix, bits, occupied, run_end, slots.view("<u8").reshape(-1), take(np.uint8, (n + 7) // 8), take("<u4", many))


def merge(filters: list[QuotientFilter]) -> QuotientFilter:
    """One filter with the fingerprints of all and their counts added."""
    parts = [f.items() for f in filters]
    values, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(values, kind="stable")  # merges the ascending runs
    values, counts = values[order], counts[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return QuotientFilter.of(values[starts], np.add.reduceat(counts, starts) if len(starts) else counts, filters[0].skip)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pc.fill_null(batch.column(1), "")
        fps, shas = [], []
        for raw in text.cast(pa.binary()).to_pylist():
            raw = raw.translate(None, DELETED)
            fps.append(xxhash.xxh64_intdigest(raw))
            shas.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(shas, pa.binary()), pc.utf8_length(text).cast(pa.int64())], ["id", "fp", "sha", "n"])


def _build(skip: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches]
        values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_counts=True)
        ranges = (values >> np.uint64(64 - skip)).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])) if len(values) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(values))
        if len(cuts):
            yield pa.RecordBatch.from_arrays([pa.array(ranges[cuts].astype(np.int32)), pa.array([QuotientFilter.of(values[a:b], counts[a:b], skip).pack() for a, b in zip(cuts, ends, strict=True)], pa.binary())], ["range", "filter"])

    return build


def _repeated(group: pa.Table) -> pa.Table:
    values, counts = merge([QuotientFilter.unpack(x) for x in group.column("filter").to_pylist()]).items()
    return pa.table({"fp": values[counts > 1].view(np.int64)})


def repeated_fingerprints(keys: DataFrame) -> DataFrame:
    """Fingerprints (column fp) that the whole table has more than once, by merged counting quotient filters. The number of quotient ranges follows the cluster's shuffle partitions."""
    skip = max(6, (4 * partitions(keys.sparkSession) - 1).bit_length())
    filters = keys.select("fp").mapInArrow(tidy(_build(skip)), "range int, filter binary")
    return filters.groupBy("range").applyInArrow(_repeated, "fp bigint")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """keys: a row (id, fp, sha, n) for each row of docs. groups: (fp, sha, keep_id, keep_n, group_size) for each text that is there more than once, verified on bytes."""
    keys = materialise(small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(_fingerprints), f"id {docs.schema[id_col].dataType.simpleString()}, fp bigint, sha binary, n bigint"), "keys")
    repeated = materialise(repeated_fingerprints(keys), "repeated")
    suspects = materialise(keys.join(sized(repeated), "fp", "left_semi").select("id").distinct(), "suspects")
    bodies = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(sized(suspects.withColumnRenamed("id", "suspect")), F.col("id").eqNullSafe(F.col("suspect")), "left_semi")
    normal = F.regexp_replace("text", "[ \\t-\\r]+", "")
    verified = (
        bodies.select("id", F.length("text").cast("long").alias("n"), normal.alias("body"))
        .withColumn("fp", F.xxhash64("body"))
        .groupBy("fp", "body", "n")
        .agg(F.min("id").alias("id"), F.count("*").alias("rows"))
        .groupBy("fp", "body")
        .agg(F.max_by("id", F.when(F.col("id").isNotNull(), F.col("n"))).alias("keep_id"), F.max(F.when(F.col("id").isNotNull(), F.col("n"))).alias("keep_n"), F.sum("rows").alias("group_size"))
        .filter("group_size > 1")
        .select(F.unhex(F.sha2("body", 256)).alias("sha"), "keep_id", "keep_n", "group_size")
    )
    return keys, materialise(verified, "groups")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: its id, keep_id, group_size, kept, text_sha256."""
    keys, groups = classes(docs, id_col, text_col)
    out = keys.join(sized(groups), "sha", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("keep_id").eqNullSafe(F.col("id")) & F.coalesce(F.col("keep_n") == F.col("n"), F.lit(True))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each group of equal texts."""
    keys, groups = classes(docs, id_col, text_col)
    losers = materialise(
        keys.join(sized(groups), "sha").filter(~(F.col("keep_id").eqNullSafe(F.col("id")) & F.coalesce(F.col("keep_n") == F.col("n"), F.lit(True)))).select("id", F.lower(F.hex("sha")).alias("sha")).distinct(),
        "losers",
    )
    repeats = materialise(keys.join(sized(groups), "sha").filter(F.col("keep_id").eqNullSafe(F.col("id"))).groupBy("id", "sha").agg(F.count("*").alias("rows")).filter("rows > 1").select("id", F.lower(F.hex("sha")).alias("sha")), "repeats")
    own, by_id, by_sha = fresh(docs, "sha_"), fresh(docs, "lost_id"), fresh(docs, "lost_sha")
    gone = losers.select(F.col("id").alias(by_id), F.col("sha").alias(by_sha))
    body = F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "[ \\t-\\r]+", ""), 256)
    left = docs.withColumn(own, body).join(sized(gone, losers.count()), F.col(id_col).eqNullSafe(F.col(by_id)) & (F.col(own) == F.col(by_sha)), "left_anti")
    if not repeats.isEmpty():
        again = sized(repeats.select(F.col("id").alias(by_id), F.col("sha").alias(by_sha)))
        on = F.col(id_col).eqNullSafe(F.col(by_id)) & (F.col(own) == F.col(by_sha))
        left = left.join(again, on, "left_anti").unionByName(left.join(again, on, "left_semi").dropDuplicates([id_col, own]))
    return left.drop(own)
