"""Runs: stretches of consecutive rows, by window bounds on the shared order, without a shuffle of their own."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..frames import Order


def with_runs(df: DataFrame, starts: dict[str, Column], order: Order) -> DataFrame:
    """For each name a run begins where its condition holds: columns <name>_first and <name>_last are the ordinals of the run that a row is in. Two windows serve all names; the second runs backwards, as frames that end at the last row cost quadratic time."""
    row = F.col(order.row)
    flagged = df.select("*", *[F.coalesce(c, F.lit(False)).alias(f"{n}_start") for n, c in starts.items()])
    back = Window.partitionBy(*order.entities).orderBy(F.col(order.row).desc())
    firsts = [F.max(F.when(F.col(f"{n}_start"), row)).over(order.by_row.rowsBetween(Window.unboundedPreceding, 0)).alias(f"{n}_first") for n in starts]
    after = [F.min(F.when(F.col(f"{n}_start"), row)).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias(f"{n}_next") for n in starts]
    end = F.max(row).over(back.rowsBetween(Window.unboundedPreceding, 0)).alias("__end")
    out = flagged.select("*", *firsts).select("*", *after, end)
    lasts = [F.coalesce(F.col(f"{n}_next") - 1, F.col("__end")).alias(f"{n}_last") for n in starts]
    gone = [f"{n}_{x}" for n in starts for x in ("start", "next")]
    return out.select("*", *lasts).drop("__end", *gone)


def anchored_starts(df: DataFrame, columns: list[str], epsilon: float, order: Order) -> DataFrame:
    """For each column <column>_anchor_start: a value that isn't within epsilon of the first value of its run starts a run; a null ends one. Each value depends on the run so far, so rows stream through in order, entity by entity, with one anchor per column as the only state."""
    names = [f"{c}_anchor_start" for c in columns]
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.BooleanType()) for n in names]])
    arrow, at = to_arrow_schema(schema), [df.columns.index(c) for c in columns]
    keys = [df.columns.index(c) for c in order.entities]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entity, anchors = None, [None] * len(columns)
        for batch in batches:
            values = [batch.column(i).to_pylist() for i in at]
            own = list(zip(*[batch.column(i).to_pylist() for i in keys], strict=True)) if keys else [()] * batch.num_rows
            starts: list[list[bool]] = [[] for _ in columns]
            for r in range(batch.num_rows):
                if own[r] != entity:
                    entity, anchors = own[r], [None] * len(columns)
                for k, v in enumerate(values):
                    x = v[r]
                    new = x is None or anchors[k] is None or abs(x - anchors[k]) >= epsilon
                    starts[k].append(new)
                    if new:
                        anchors[k] = x
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(s, pa.bool_()) for s in starts]], schema=arrow)

    dealt = df.repartition(*order.entities).sortWithinPartitions(*order.entities, order.row) if order.entities else df.coalesce(1).sortWithinPartitions(order.row)
    return dealt.mapInArrow(run, schema)
