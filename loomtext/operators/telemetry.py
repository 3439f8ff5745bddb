"""Rates, averages and streaks over time-ordered logs, and the worker tuner as a fold.

Windows are cut by run, so runs are handled apart; a run is one stream of events.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALPHA = 0.2


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970; times without a zone count in the session's."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def running_total(df: DataFrame, run: str, ts: str, value: str) -> DataFrame:
    return df.withColumn("running_total", F.sum(value).over(Window.partitionBy(run).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)))


def trailing_rate(df: DataFrame, run: str, ts: str, total: str, seconds: int = 1800) -> DataFrame:
    """``rate``: growth of a cumulative count since the oldest sample of the last ``seconds``, a second; null for a lone sample."""
    at = micros(ts)
    w = Window.partitionBy(run).orderBy(at).rangeBetween(-seconds * 1_000_000, 0)
    span = at - F.first(at).over(w)
    return df.withColumn("rate", F.when(span > 0, (F.col(total) - F.first(total).over(w)) * 1e6 / span))


def delta_rate(df: DataFrame, run: str, ts: str, total: str) -> DataFrame:
    """``rate`` since the sample before; null for the first."""
    w = Window.partitionBy(run).orderBy(ts)
    span = micros(ts) - F.lag(micros(ts)).over(w)
    return df.withColumn("rate", F.when(span > 0, (F.col(total) - F.lag(total).over(w)) * 1e6 / span))


def ema(values: Column, alpha: float = ALPHA) -> Column:
    """Exponential average of an ordered array: seeded by the first positive value, others skipped; null if none."""
    none = F.lit(None).cast("double")
    return F.aggregate(values, none, lambda acc, x: F.when(F.coalesce(x, F.lit(0.0)) <= 0, acc).when(acc.isNull(), x).otherwise(F.lit(alpha) * x + F.lit(1 - alpha) * acc))


def ema_by_run(df: DataFrame, run: list[str], ts: str, value: str) -> DataFrame:
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(ts, value))), lambda x: x[value])
    return df.groupBy(*run).agg(ordered.alias("v")).select(*run, ema(F.col("v")).alias("ema"))


def streaks(df: DataFrame, run: str, ts: str, ok: Column) -> DataFrame:
    """``success`` and ``streak``: the length so far of the current run of equal outcomes."""
    all_, same = Window.partitionBy(run).orderBy(ts), Window.partitionBy(run, "success").orderBy(ts)
    out = df.withColumn("success", ok).withColumn("_g", F.row_number().over(all_) - F.row_number().over(same))
    return out.withColumn("streak", F.row_number().over(Window.partitionBy(run, "success", "_g").orderBy(ts))).drop("_g")


def throughput(batches: DataFrame, run: str) -> DataFrame:
    """``(run, ts, n_rows, n_tokens, latency)``: totals, rates a second over the elapsed time, and mean latency."""
    span = micros(F.max("ts")) - micros(F.min("ts"))
    sums = batches.groupBy(run).agg(F.sum("n_rows").alias("rows"), F.sum("n_tokens").alias("tokens"), F.avg("latency").alias("mean_latency"), span.alias("micros"))
    per = lambda c: F.when(F.col("micros") > 0, F.col(c) * 1e6 / F.col("micros"))
    return sums.select(run, "rows", "tokens", "mean_latency", per("rows").alias("rows_per_s"), per("tokens").alias("tokens_per_s"))


def eta_hours(left: Column, rows_per_s: Column) -> Column:
    return F.when(rows_per_s > 0, left / rows_per_s / 3600)


@dataclass(frozen=True)
class Tuning:
    """One generation of the tuner. Sizes shrink after ``fails`` failures in a row and grow after ``wins``
    successes and ``quiet`` seconds; ceilings rise every ``raise_every`` seconds, if at all."""

    workers: int = 18
    batch: int = 40
    fails: int = 3
    wins: int = 20
    quiet: float = 120.0
    shrink: tuple[float, float] = (0.75, 0.8)
    grow: tuple[float, float] = (1.1, 1.05)
    least: tuple[int, int] = (1, 5)
    ceiling: tuple[int, int] = (32, 80)
    raise_every: float | None = None
    raise_by: float = 1.1
    top: tuple[int, int] = (64, 120)
    slow: float | None = None
    efficiency_drop: float | None = None
    smooth: bool = False
    target_tokens: float | None = None


PRESETS = {
    "v1": Tuning(8, 25, wins=10, shrink=(0.8, 0.8), grow=(1.2, 1.1), least=(8, 30), ceiling=(32, 100)),
    "v4": Tuning(24, 50, least=(8, 30)),
    "v5": Tuning(raise_every=1800.0, raise_by=1.2, top=(32, 80)),
    "v6": Tuning(raise_every=1800.0, efficiency_drop=0.1),
    "v8": Tuning(raise_every=1800.0, efficiency_drop=0.1, slow=180.0, smooth=True, target_tokens=3800.0),
}


class Tuner:
    """The control state after each event ``(t, success, rate, latency, tokens)``; times are seconds of the log, never of a clock."""

    def __init__(self, rule: Tuning) -> None:
        self.rule, self.workers, self.batch = rule, rule.workers, rule.batch
        self.ceiling = list(rule.ceiling)
        self.fails = self.wins = 0
        self.changed = self.raised = None
        self.rate = self.latency = self.tokens = self.efficiency = None

    def _smoothed(self, old: float | None, x: float | None) -> float | None:
        if x is None or not x > 0:
            return old
        return x if old is None or not self.rule.smooth else ALPHA * x + (1 - ALPHA) * old

    def event(self, t: float, success: bool, rate: float | None = None, latency: float | None = None, tokens: float | None = None) -> tuple[int, int]:
        r = self.rule
        if self.changed is None:
            self.changed = self.raised = t
        self.rate, self.latency, self.tokens = (self._smoothed(a, b) for a, b in ((self.rate, rate), (self.latency, latency), (self.tokens, tokens)))
        self.wins, self.fails = (self.wins + 1, 0) if success else (0, self.fails + 1)
        waited = t - self.changed > r.quiet
        if self.fails >= r.fails:
            self._resize(t, r.shrink, floor=True)
            self.fails = 0
        elif waited and self._less_efficient():
            self._resize(t, (0.9, 0.95), floor=True)
        elif self.wins >= r.wins and waited:
            self._resize(t, r.grow, floor=False)
            self.wins = 0
        if r.slow is not None and self.latency is not None and self.latency > r.slow:
            self.ceiling[0] = max(r.least[0], int(self.ceiling[0] * 0.9))
        if r.raise_every is not None and t - self.raised >= r.raise_every and not self.fails:
            self.ceiling = [min(top, int(c * r.raise_by) + r.smooth) for c, top in zip(self.ceiling, r.top)]
            self.raised = t
        if r.target_tokens and self.tokens:
            want = min(max(r.target_tokens / self.tokens, r.least[1]), self.ceiling[1])
            step = max(1, int(self.batch * 0.1))
            self.batch = int(min(max(want, self.batch - step), self.batch + step))
        return self.workers, self.batch

    def _less_efficient(self) -> bool:
        if self.rule.efficiency_drop is None or self.rate is None:
            return False
        now, old = self.rate / self.workers, self.efficiency
        self.efficiency = now
        return old is not None and now < old * (1 - self.rule.efficiency_drop)

    def _resize(self, t: float, by: tuple[float, float], floor: bool) -> None:
        new = [int(x * f) for x, f in zip((self.workers, self.batch), by)]
        if floor:
            new = [max(lo, x) for lo, x in zip(self.rule.least, new)]
        else:
            new = [max(old, min(top, x)) for old, top, x in zip((self.workers, self.batch), self.ceiling, new)]
        self.workers, self.batch = new
        self.changed = t


def tune(events: DataFrame, preset: str = "v8") -> DataFrame:
    """``(run, seq, t, success, rate, latency, tokens)`` to ``run, seq, workers, batch``: one tuner a run, fed in order."""
    rule = PRESETS[preset]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, tuner = None, None
        for b in batches:
            rows = []
            for e in b.itertuples(index=False):
                if tuner is None or e.run != run:
                    run, tuner = e.run, Tuner(rule)
                known = lambda x: None if pd.isna(x) else float(x)
                rows.append((e.run, e.seq, *tuner.event(float(e.t), bool(e.success), known(e.rate), known(e.latency), known(e.tokens))))
            yield pd.DataFrame(rows, columns=["run", "seq", "workers", "batch"])

    dealt = events.repartition("run").sortWithinPartitions("run", "seq")
    return dealt.select("run", "seq", "t", "success", "rate", "latency", "tokens").mapInPandas(fold, "run long, seq long, workers int, batch int")
