"""Ordered frames: the one window specification that every time-ordered operator shares, and the expressions built on it.

All features of a table use one (entities, timestamp, row) order, so Spark plans one
exchange and one sort for all of them. Rows have an explicit ordinal, as Spark has no
order of its own. NaN and infinity become null once, at the start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "_row"
_CLOSED = {"left": (-1, True), "right": (0, False), "both": (0, True), "neither": (-1, False)}


def clean_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinite values become null, in one projection."""
    inf = float("inf")

    def one(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c) & (F.abs(c) < inf), c).alias(f.name)
        return c

    return df.select(*[one(f) for f in df.schema.fields])


@dataclass(frozen=True)
class Order:
    """Which rows belong together, and their order. No entities: the table is one series."""

    entities: tuple[str, ...] = ()
    timestamp: str = "timestamp"
    row: str = ROW

    @property
    def spec(self) -> WindowSpec:
        return Window.partitionBy(*self.entities).orderBy(self.timestamp, self.row)

    @property
    def by_row(self) -> WindowSpec:
        """In order of arrival."""
        return Window.partitionBy(*self.entities).orderBy(self.row)

    @property
    def to_here(self) -> WindowSpec:
        return self.spec.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def from_here(self) -> WindowSpec:
        return self.spec.rowsBetween(0, Window.unboundedFollowing)

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.entities)

    def rolling(self, size: int, closed: str = "left") -> WindowSpec:
        """`size` rows; left ends before the current row and never sees it."""
        end, first = _CLOSED[closed]
        return self.spec.rowsBetween(-size if first else 1 - size, end)

    def number(self, df: DataFrame, *ties: str) -> DataFrame:
        """df with the ordinal of each row, from 0, by timestamp and ties. One series is dealt by range, so no task holds it."""
        if not self.entities:
            from .plans.scaleout import numbered

            return numbered(df, self.timestamp, *ties, row=self.row)
        own = Window.partitionBy(*self.entities).orderBy(self.timestamp, *ties)
        return df.withColumn(self.row, (F.row_number().over(own) - 1).cast("long"))


def at_least(value: Column, counted: Column, over: WindowSpec, least: int) -> Column:
    """The value where the window has so many counted entries, else null."""
    return F.when(F.count(counted).over(over) >= least, value)


def signal_periods(window: int) -> int:
    return max(2, window // 4)


def flag_periods(window: int) -> int:
    return max(1, window // 4)


def safe_div(a: Column, b: Column, eps: float = 1e-6) -> Column:
    """a/b, null where b is closer to zero than eps."""
    return F.when(F.abs(b) >= eps, F.try_divide(a, b))


def micros(c: Column | str) -> Column:
    """Microseconds since the epoch, of timestamps with or without a time zone."""
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def flag01(c: Column) -> Column:
    """A flag as 0 to 1, null as 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), zero_if_null(c)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_median(values: Column) -> Column:
    """The median of a sorted array without nulls; null if empty."""
    return let(F.size(values), lambda n: (F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))) / 2)


def array_mad(values: Column) -> Column:
    """The median absolute deviation from the median of an array."""
    return let(F.sort_array(values), lambda v: let(array_median(v), lambda m: array_median(F.sort_array(F.transform(v, lambda x: F.abs(x - m))))))


@dataclass(frozen=True)
class Running:
    """A value over all rows up to each: the sum or max, or the sum since the last row where `reset` holds; or the mean or std of all rows, behind and ahead."""

    name: str
    how: str
    value: Column
    reset: Column | None = None


@dataclass(frozen=True)
class Feature:
    """A derived column in three levels, each over the ones before: values of the row and its neighbours, windows of bounded reach and running values over these, and arithmetic. Equal names of the first two levels are computed once."""

    name: str
    out: Column
    windows: tuple[tuple[str, Column], ...] = ()
    helpers: tuple[tuple[str, Column], ...] = ()
    running: tuple[Running, ...] = ()


def with_level(df: DataFrame, features: Iterable[Feature], level: str) -> DataFrame:
    new = {n: c for f in features for n, c in getattr(f, level)}
    return df.select("*", *[c.alias(n) for n, c in new.items()]) if new else df


def running_of(features: Iterable[Feature]) -> list[Running]:
    return list({r.name: r for f in features for r in f.running}.values())


def outcome(columns: list[str], features: Iterable[Feature]) -> list[Column]:
    return [*[F.col(f"`{c}`") for c in columns], *[f.out.alias(f.name) for f in features]]


def since(df: DataFrame, runs: list[Running], order: Order) -> DataFrame:
    """df with, for sums since a reset, the sum so far (__upto_) and what it was before the last reset (__base_)."""
    own = [r for r in runs if r.how == "since"]
    df = df.select("*", *[F.sum(r.value).over(order.to_here).alias(f"__upto_{r.name}") for r in own]) if own else df
    last = lambda r: F.last(F.when(r.reset, F.col(f"__upto_{r.name}") - r.value), ignorenulls=True).over(order.to_here)
    return df.select("*", *[last(r).alias(f"__base_{r.name}") for r in own]) if own else df


def add_features(df: DataFrame, features: Iterable[Feature], order: Order | None = None) -> DataFrame:
    """df with all features: a projection for each level, whatever their number. order: needed for running values."""
    features, own = list(features), df.columns
    runs = running_of(features)
    df = with_level(with_level(df, features, "helpers"), features, "windows")
    if runs:
        df = since(df, runs, order)
        plain = {"sum": lambda r: F.sum(r.value).over(order.to_here), "max": lambda r: F.max(r.value).over(order.to_here), "mean": lambda r: F.avg(r.value).over(order.whole), "std": lambda r: F.stddev_samp(r.value).over(order.whole), "since": lambda r: F.col(f"__upto_{r.name}") - F.col(f"__base_{r.name}")}
        df = df.select("*", *[plain[r.how](r).alias(r.name) for r in runs])
    return df.select(*outcome(own, features))


def islands(df: DataFrame, starts: Column, order: Order, name: str = "island", by: WindowSpec | None = None) -> DataFrame:
    """df with a number for each stretch of rows that begins where `starts` holds (null: it doesn't)."""
    own = (by if by is not None else order.by_row).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("__start", F.coalesce(starts, F.lit(False)).cast("int")).withColumn(name, F.sum("__start").over(own)).drop("__start")
