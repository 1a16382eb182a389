"""Feature families over one ordered frame. Names are <source>_<family>_<parameter>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..frames import Feature, Order, Running, array_mad, at_least, flag01, flag_periods, safe_div, signal_periods, zero_if_null


class Families:
    """The families for one order of rows."""

    def __init__(self, order: Order):
        self.order = order
        #: Rows that features made so far look back, at most: the largest window, and twice the largest lag.
        self.size, self.back = 0, 1

    @property
    def reach(self) -> int:
        return self.size + 2 * self.back + 2

    def _over(self, size: int, closed: str):
        self.size = max(self.size, size)
        return self.order.rolling(size, closed)

    # windows over a column; the name says everything that tells two apart

    def _roll(self, kind: str, col: str, size: int, closed: str, value: Column, counted: Column, least: int) -> tuple[str, Column]:
        return f"__{kind}_{col}_{size}_{closed}_{least}", at_least(value, counted, self._over(size, closed), least)

    def mean_of(self, col: str, size: int, closed: str = "left", kind: str = "mean", least: int | None = None) -> tuple[str, Column]:
        over = self._over(size, closed)
        return self._roll(kind, col, size, closed, F.avg(col).over(over), F.col(col), signal_periods(size) if least is None else least)

    def std_of(self, col: str, size: int, closed: str = "left") -> tuple[str, Column]:
        over = self._over(size, closed)
        return self._roll("std", col, size, closed, F.stddev_samp(col).over(over), F.col(col), signal_periods(size))

    def sum_of(self, col: str, size: int, closed: str, least: int) -> tuple[str, Column]:
        over = self._over(size, closed)
        return self._roll("sum", col, size, closed, F.sum(col).over(over), F.col(col), least)

    def lag_of(self, col: str, n: int) -> tuple[str, Column]:
        self.back = max(self.back, n)
        return f"__lag_{col}_{n}", F.lag(col, n).over(self.order.spec)

    def diff_of(self, col: str) -> tuple[str, Column]:
        return f"__diff_{col}", F.col(col) - F.lag(col, 1).over(self.order.spec)

    # signals

    def rolling_mean(self, col: str, size: int, closed: str = "left") -> Feature:
        w = self.mean_of(col, size, closed)
        return Feature(f"{col}_mean_{size}", F.col(w[0]), (w,))

    def rolling_std(self, col: str, size: int, closed: str = "left") -> Feature:
        w = self.std_of(col, size, closed)
        return Feature(f"{col}_std_{size}", F.col(w[0]), (w,))

    def rolling_trend(self, col: str, size: int, closed: str = "left") -> Feature:
        """The mean of first differences."""
        d = self.diff_of(col)
        w = self.mean_of(d[0], size, closed)
        return Feature(f"{col}_trend_{size}", F.col(w[0]), (w,), (d,))

    def lag(self, col: str, n: int) -> Feature:
        w = self.lag_of(col, n)
        return Feature(f"{col}_lag_{n}", F.col(w[0]), (w,))

    def pct_change(self, col: str, n: int, fill: str | None = None) -> Feature:
        """x over x n rows before, less 1; null for a base of zero. fill="pad" carries values over nulls first; by default nothing is filled."""
        if fill == "pad":
            held = f"__pad_{col}", F.last(col, ignorenulls=True).over(self.order.to_here)
            w = self.lag_of(held[0], n)
            return Feature(f"{col}_pctchg_{n}", F.try_divide(F.col(held[0]), F.col(w[0])) - 1, (w,), (held,))
        w = self.lag_of(col, n)
        return Feature(f"{col}_pctchg_{n}", F.try_divide(F.col(col), F.col(w[0])) - 1, (w,))

    def velocity(self, col: str, n: int) -> Feature:
        w = self.lag_of(col, n)
        return Feature(f"{col}_velocity_{n}", F.col(col) - F.col(w[0]), (w,))

    def acceleration(self, col: str, n: int) -> Feature:
        one, two = self.lag_of(col, n), self.lag_of(col, 2 * n)
        return Feature(f"{col}_accel_{n}", F.col(col) - 2 * F.col(one[0]) + F.col(two[0]), (one, two))

    def sign_changes(self, col: str, size: int, closed: str = "left") -> Feature:
        """How often the difference changed its sign; a null difference is no change."""
        s = self.order.spec
        x, y, z = F.col(col), F.lag(col, 1).over(s), F.lag(col, 2).over(s)
        h = f"__turn_{col}", F.coalesce((F.signum(x - y) * F.signum(y - z) < 0).cast("double"), F.lit(0.0))
        w = self.sum_of(h[0], size, closed, signal_periods(size))
        return Feature(f"{col}_signchanges_{size}", F.col(w[0]), (w,), (h,))

    def cv(self, col: str, size: int, closed: str = "left", eps: float = 1e-6) -> Feature:
        m, s = self.mean_of(col, size, closed), self.std_of(col, size, closed)
        return Feature(f"{col}_cv_{size}", safe_div(F.col(s[0]), F.abs(F.col(m[0])), eps), (m, s))

    def std_ratio(self, col: str, short: int, long: int, eps: float = 1e-6, have: set[str] = frozenset()) -> Feature:
        """std over the short window by std over the long one; columns that the table already has are used."""
        parts = []
        windows = []
        for size in (short, long):
            if f"{col}_std_{size}" in have:
                parts.append(F.col(f"{col}_std_{size}"))
            else:
                w = self.std_of(col, size)
                windows.append(w)
                parts.append(F.col(w[0]))
        return Feature(f"{col}_stdratio_{short}_{long}", safe_div(*parts, eps), tuple(windows))

    def rolling_range(self, col: str, size: int, closed: str = "left") -> Feature:
        over = self._over(size, closed)
        w = self._roll("range", col, size, closed, F.max(col).over(over) - F.min(col).over(over), F.col(col), signal_periods(size))
        return Feature(f"{col}_range_{size}", F.col(w[0]), (w,))

    def _mad(self, col: str, size: int, closed: str) -> tuple[tuple[str, Column], Column]:
        """The window's values, and their MAD: null if any of them is null or they are too few."""
        over = self._over(size, closed)
        held = F.when((F.count(col).over(over) == F.count(F.lit(1)).over(over)) & (F.count(col).over(over) >= signal_periods(size)), F.collect_list(col).over(over))
        w = f"__values_{col}_{size}_{closed}", held
        return w, array_mad(F.col(w[0]))

    def mad(self, col: str, size: int, closed: str = "left") -> Feature:
        w, out = self._mad(col, size, closed)
        return Feature(f"{col}_mad_{size}", out, (w,))

    def rolling_z(self, col: str, size: int, closed: str = "left", eps: float = 1e-6) -> Feature:
        m, s = self.mean_of(col, size, closed), self.std_of(col, size, closed)
        return Feature(f"{col}_z_{size}", safe_div(F.col(col) - F.col(m[0]), F.col(s[0]), eps), (m, s))

    def robust_z(self, col: str, size: int, closed: str = "left", eps: float = 1e-6) -> Feature:
        """(x - median) / (1.4826 MAD); the median leaves out nulls, the MAD doesn't bear any."""
        over = self._over(size, closed)
        m = self._roll("median", col, size, closed, F.percentile(F.col(col), F.lit(0.5)).over(over), F.col(col), signal_periods(size))
        w, mad = self._mad(col, size, closed)
        return Feature(f"{col}_robust_z_{size}", safe_div(F.col(col) - F.col(m[0]), 1.4826 * mad, eps), (m, w))

    def global_z(self, col: str, eps: float = 1e-6) -> Feature:
        """Against mean and std of all rows: it sees the future, so it is off by default."""
        m, s = Running(f"__all_mean_{col}", "mean", F.col(col)), Running(f"__all_std_{col}", "std", F.col(col))
        return Feature(f"{col}_z_global", F.when(F.col(s.name) >= eps, (F.col(col) - F.col(m.name)) / F.col(s.name)), running=(m, s))

    # flags

    def runfrac(self, col: str, size: int) -> Feature:
        h = f"__flag_{col}", zero_if_null(F.col(col))
        w = self.mean_of(h[0], size, "left", least=flag_periods(size))
        return Feature(f"{col}_runfrac_{size}", F.col(w[0]), (w,), (h,))

    def tsla(self, col: str, name: str | None = None) -> Feature:
        """Rows since the flag was last on: 0 while it is, null before."""
        row = F.col(self.order.row)
        w = Running(f"__active_{col}", "max", F.when(zero_if_null(F.col(col)) != 0, row))
        return Feature(name or f"{col}_tsla", (row - F.col(w.name)).cast("double"), running=(w,))

    def edge_of(self, col: str) -> tuple[str, Column]:
        flag = zero_if_null(F.col(col))
        return f"__edge_{col}", F.greatest(F.lit(0.0), F.coalesce(flag - F.lag(flag, 1).over(self.order.spec), F.lit(0.0)))

    def edges(self, col: str, size: int) -> Feature:
        """Rises of the flag in the window."""
        h = self.edge_of(col)
        w = self.sum_of(h[0], size, "left", flag_periods(size))
        return Feature(f"{col}_edges_{size}", F.col(w[0]), (w,), (h,))

    # energy

    def cumulative_energy(self, col: str, hours: float) -> Feature:
        w = Running(f"__cum_{col}", "sum", zero_if_null(F.col(col)) * hours)
        return Feature(f"{col}_cumkwh", F.col(w.name), running=(w,))

    def cumulative_energy_daily(self, col: str, hours: float) -> Feature:
        """The same from midnight on."""
        day = F.to_date(self.order.timestamp)
        h = f"__first_{self.order.timestamp}", ~F.coalesce(F.lag(day, 1).over(self.order.spec) == day, F.lit(False))
        w = Running(f"__cumday_{col}", "since", zero_if_null(F.col(col)) * hours, F.col(h[0]))
        return Feature(f"{col}_cumkwh_day", F.col(w.name), (), (h,), (w,))

    def energy_per_kg(self, power: str, production: str, size: int, hours: float, closed: str = "left", eps: float = 1e-6) -> Feature:
        h = (f"__flag_{power}", zero_if_null(F.col(power))), (f"__kg_{production}", zero_if_null(F.col(production)) * (hours * 60.0))
        p, k = (self.sum_of(x[0], size, closed, signal_periods(size)) for x in h)
        return Feature(f"{power}_energy_per_kg_{size}", safe_div(F.col(p[0]) * hours, F.col(k[0]), eps), (p, k), h)

    # the machine as a whole

    def any_flag(self, cols: list[str]) -> Column:
        """1 if any flag is on."""
        return F.when(F.greatest(F.lit(0.0), *[flag01(F.col(c)) for c in cols]) > 0, 1.0).otherwise(0.0) if cols else F.lit(0.0)

    def n_running(self, cols: list[str]) -> Feature:
        total = F.lit(0.0)
        for c in cols:
            total = total + flag01(F.col(c))
        return Feature("n_subsystems_running", total)

    def time_since_machine_off(self, cols: list[str]) -> Feature:
        """Rows since the last start; a record that begins with the machine on starts at its first row."""
        on, row = self.any_flag(cols), F.col(self.order.row)
        h = "__any_running_start", F.when((on > 0) & (F.lag(on, 1, 0.0).over(self.order.spec) <= 0), row)
        w = Running("__last_start", "max", F.col(h[0]))
        return Feature("time_since_machine_off", (row - F.col(w.name)).cast("double"), (), (h,), (w,))

    def cumulative_starts(self, cols: list[str]) -> Feature:
        """Rises so far; unlike above, being on in the first row is none."""
        on = self.any_flag(cols)
        h = "__any_running_edge", F.greatest(F.lit(0.0), F.coalesce(on - F.lag(on, 1).over(self.order.spec), F.lit(0.0)))
        w = Running("__starts", "sum", F.col(h[0]))
        return Feature("cumulative_starts", F.col(w.name), (), (h,), (w,))

    def total_alarms(self, cols: list[str], size: int, closed: str = "left") -> Feature:
        total = F.lit(0.0)
        for c in cols:
            flag = F.col(c).cast("double")
            total = total + F.greatest(F.lit(0.0), F.coalesce(flag - F.lag(flag, 1).over(self.order.spec), F.lit(0.0)))
        h = "__alarm_edges", total
        w = self.sum_of(h[0], size, closed, flag_periods(size))
        return Feature(f"total_alarms_{size}", F.col(w[0]), (w,), (h,))

    def time_since_any_alarm(self, cols: list[str]) -> Feature:
        row = F.col(self.order.row)
        w = Running("__last_alarm", "max", F.when(self.any_flag(cols) > 0, row))
        return Feature("time_since_any_alarm", (row - F.col(w.name)).cast("double"), running=(w,))

    def any_alarm_while_running(self, alarms: list[str], running: list[str]) -> Feature:
        both = (self.any_flag(alarms) > 0) & (self.any_flag(running) > 0)
        return Feature("any_alarm_while_running", both.cast("int"))
