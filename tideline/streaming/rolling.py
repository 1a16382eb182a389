"""Row-count windows on a stream: state for each entity holds the last values only.

Structured Streaming has no row frames, so the last `window` values are kept for
each entity and every new row is scored against the ones before it. Rows of a
micro-batch are taken in time order within their entity; rows later than the
watermark are dropped by Spark before they come here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..frames import signal_periods


def stream_rolling(stream: DataFrame, entity: str, timestamp: str, column: str, window: int, late: str = "10 minutes", eps: float = 1e-6) -> DataFrame:
    """(entity, timestamp, column, <column>_mean_W, <column>_std_W, <column>_z_W): leak-safe, as in batch."""
    least = signal_periods(window)
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    names = [f"{column}_{k}_{window}" for k in ("mean", "std", "z")]
    out = T.StructType([T.StructField(entity, kinds[entity]), T.StructField(timestamp, kinds[timestamp]), T.StructField(column, T.DoubleType()), *[T.StructField(n, T.DoubleType()) for n in names]])
    state_type = T.StructType([T.StructField("last", T.ArrayType(T.DoubleType()))])

    def score(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(timestamp, kind="stable")  # an entity's rows of one micro-batch
        last = [np.nan if v is None else v for v in state.get[0]] if state.exists else []
        found = []
        for x in rows[column].astype(float):
            seen = np.array([v for v in last if not np.isnan(v)])
            mean = seen.mean() if len(seen) >= least else np.nan
            std = seen.std(ddof=1) if len(seen) >= least else np.nan
            found.append((mean, std, (x - mean) / std if std >= eps else np.nan))
            last = [*last, x][-window:]
        state.update(([None if np.isnan(v) else float(v) for v in last],))
        made = pd.DataFrame(found, columns=names)
        made.insert(0, column, rows[column].to_numpy(float))
        made.insert(0, timestamp, rows[timestamp].to_numpy())
        made.insert(0, entity, key[0])
        yield made

    own = stream.select(entity, timestamp, F.col(column).cast("double").alias(column)).withWatermark(timestamp, late)
    return own.groupBy(entity).applyInPandasWithState(score, out, state_type, "append", "NoTimeout")


def stream_resample(stream: DataFrame, entity: str, timestamp: str, rules: dict[str, str], step: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """(entity, timestamp, columns): bins that the watermark has passed. rules: column to mean, max, min or sum."""
    how = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}
    own = stream.withWatermark(timestamp, late).groupBy(entity, F.window(timestamp, step).alias("w")).agg(*[how[k](c).alias(c) for c, k in rules.items()])
    return own.select(entity, F.col("w.start").alias(timestamp), *rules)
