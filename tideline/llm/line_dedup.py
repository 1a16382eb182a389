"""Removal of lines that spread over many sites (operator 7).

A line is known by two 64-bit hashes of its bytes without blanks at either end, 128 bits
together. One pass over the documents counts lines by site. Lines with fewer rows than
the threshold can't have enough sites and end there. Each other line gets a HyperLogLog
sketch of its sites; sketches merge in the aggregation. Where the estimate is near the
threshold, as far as the sketch may err, the line's distinct sites are counted exactly,
so the decision is the exact one unless a sketch errs by over MARGIN standard errors. Both
read the counts, not the documents. A second pass takes the lines out of every document.

That pass holds the spread lines' hashes in memory if they are few (counted,
common.BROADCAST_ROWS at most); otherwise lines meet them by a shuffle, and what is found
comes back to its document by another. Nothing that grows with the documents is broadcast.

Defined results: null text is empty, which is one empty line. Empty lines stay. A
null site counts as one site. Repeated rows count once for a site and get equal
results. Extra columns are carried by `without_spread_lines`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common
from .common import fresh, materialise, sized, tidy

#: Sites from which on a line is boilerplate.
SITES = 10
#: log2 of a sketch's registers; its standard error is 1.04 / sqrt of them.
REGISTERS = 12
#: Standard errors that count as near.
MARGIN = 4
BLANKS = " \t\r\x0b\x0c"
#: What Spark's hash starts from, and what the second hash takes in first.
START, SECOND = 42, "second"
KEY = ["line", "line2"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows whose column `text` isn't blank, with KEY in its place."""
    body = F.btrim("text", F.lit(BLANKS))
    return rows.withColumn("text", body).filter(F.length("text") > 0).withColumns({"line": F.xxhash64("text"), "line2": F.xxhash64(F.lit(SECOND), "text")}).drop("text")


def spread_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source", sites: int = SITES) -> DataFrame:
    """KEY of the lines that stand in documents of at least so many sites."""
    rows = docs.select(F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"), F.explode(_lines(F.col(text_col))).alias("text"))
    counts = materialise(_keyed(rows).groupBy(*KEY, "site").agg(F.count("*").alias("n")), "lines_of_sites")
    repeated = materialise(counts.groupBy(*KEY).agg(F.sum("n").alias("n")).filter(F.col("n") >= sites).select(*KEY), "repeated_lines")
    told = counts.join(sized(repeated), KEY, "left_semi")
    sketches = told.groupBy(*KEY).agg(F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("sketch"))
    estimates = materialise(sketches.select(*KEY, F.hll_sketch_estimate("sketch").alias("n")), "line_sites")
    near = F.abs(F.col("n") - sites) <= max(1.0, MARGIN * 1.04 / 2 ** (REGISTERS / 2) * sites)
    doubtful = materialise(estimates.filter(near).select(*KEY), "doubtful_lines")
    exact = told.join(sized(doubtful), KEY, "left_semi").groupBy(*KEY).agg(F.count("*").alias("n"))
    return materialise(estimates.filter(~near & (F.col("n") >= sites)).select(*KEY).unionAll(exact.filter(F.col("n") >= sites).select(*KEY)), "spread_lines")


def _take_out(gone, at: int, schema: pa.Schema):
    second = xxhash.xxh64_intdigest(SECOND.encode(), START)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, blanks = gone.value, BLANKS.encode()

        def spread(line: bytes) -> bool:
            body = line.strip(blanks)
            return len(body) > 0 and (found := keys.get(xxhash.xxh64_intdigest(body, START))) is not None and xxhash.xxh64_intdigest(body, second) in found

        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                batch = whole.slice(a, 500)
                clean, n_lines, n_removed = [], [], []
                for text in batch.column(at).cast(pa.binary()).to_pylist():
                    lines = (text or b"").split(b"\n")
                    left = [x for x in lines if not spread(x)]
                    clean.append(b"\n".join(left) if len(left) < len(lines) else text or b"")
                    n_lines.append(len(lines))
                    n_removed.append(len(lines) - len(left))
                new = [pa.array(clean, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(x.cast(schema.field(batch.num_columns + i).type) for i, x in enumerate(new))], schema=schema)

    return run


def _by_joins(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, clean: str, n_lines: str, n_removed: str) -> DataFrame:
    """The same where there are too many spread lines to hold: by shuffles."""
    own, by_id, by_h, at, every = (fresh(docs, x) for x in ("h_", "hit_id", "hit_h", "hit_lines", "every_"))
    keyed = docs.withColumn(own, F.xxhash64(text_col))
    lines = keyed.select(F.col(id_col).alias(by_id), F.col(own).alias(by_h), F.posexplode(_lines(F.col(text_col))).alias("at", "text"))
    hits = materialise(_keyed(lines).join(gone, KEY, "left_semi").groupBy(by_id, by_h).agg(F.collect_set("at").alias(at)), "line_hits")
    joined = keyed.join(hits, F.col(id_col).eqNullSafe(F.col(by_id)) & (F.col(own) == F.col(by_h)), "left").withColumn(every, _lines(F.col(text_col)))
    left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(at))
    text = F.when(F.col(at).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(F.transform(left, lambda i: F.get(every, i)), "\n"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], text.alias(clean), F.size(every).cast("long").alias(n_lines), F.coalesce(F.size(at), F.lit(0)).cast("long").alias(n_removed))


def without_spread_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", sites: int = SITES) -> tuple[DataFrame, str, str, str]:
    """docs with three more columns, whose names follow: the text that is left, the number of lines, and of lines removed."""
    gone = spread_lines(docs, text_col, site_col, sites)
    clean, n_lines, n_removed = (fresh(docs, x) for x in ("clean_text", "n_lines", "n_removed"))
    if gone.count() > common.BROADCAST_ROWS:
        return _by_joins(docs, gone, id_col, text_col, clean, n_lines, n_removed), clean, n_lines, n_removed
    keys: dict[int, set[int]] = {}
    for row in gone.toLocalIterator():
        keys.setdefault(row.line % (1 << 64), set()).add(row.line2 % (1 << 64))
    schema = T.StructType([*docs.schema.fields, T.StructField(clean, T.StringType()), T.StructField(n_lines, T.LongType()), T.StructField(n_removed, T.LongType())])
    held = docs.sparkSession.sparkContext.broadcast(keys)
    return docs.mapInArrow(tidy(_take_out(held, docs.columns.index(text_col), to_arrow_schema(schema))), schema), clean, n_lines, n_removed


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """A row for each row of docs: id, n_lines, n_removed, clean_chars, clean_sha256."""
    out, clean, n_lines, n_removed = without_spread_lines(docs.select(id_col, text_col, site_col), id_col, text_col, site_col)
    return out.select(id_col, n_lines, n_removed, F.length(clean).cast("long").alias("clean_chars"), F.sha2(clean, 256).alias("clean_sha256"))
