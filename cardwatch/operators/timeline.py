"""Per-key windows that stay bounded when one key owns a large share of the rows.

A window over ``PARTITION BY customer ORDER BY time`` puts all rows of a customer into one task. Here the rows of a
*busy* key, found by one combined count, are put in order by a distributed sort and cut into slices of exactly
``rows_per_slice`` rows; windows then run per (key, slice). A missing key is a key, and a slice may begin inside an
instant, so neither a burst nor an early stray row makes a slice larger. What a frame needs from elsewhere is handed
over explicitly:

* ``back_rows`` the last k rows before the slice, for LAG and ROWS frames,
* ``running``   totals of all earlier slices, for frames from the beginning,
* ``upto``, ``recent``  totals up to an instant, ties included, from one row per (key, instant).

Handed-over rows are flagged and dropped by ``close``, so each input row comes out exactly once and all results equal
those of the plain window. If no key is busy there is one slice, and the plan is that of the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cardwatch.functions.numbers import whole_div
from cardwatch.operators.busy import ROWS, beside, busy_keys, positions
from cardwatch.session import staged

SLICE, HALO, BUSY, LEAVING = "_slice", "_halo", "_is_busy", "_leaving"
#: Totals over instants run per stretch of so many units of time, which holds as many instants at most.
STRETCH = 1 << 20


@dataclass(frozen=True)
class Timeline:
    key: str = "customer_id"
    time: str = "timestamp_ms"
    ties: Sequence[str] = ("transaction_id",)
    rows_per_slice: int = 2_000_000

    def window(self) -> WindowSpec:
        """All rows of the slice in order; ties are resolved, so ROWS frames are repeatable."""
        return Window.partitionBy(self.key, SLICE).orderBy(self.time, *self.ties)

    def last_rows(self, k: int) -> WindowSpec:
        return self.window().rowsBetween(-k, 0)

    def cut(self, df: DataFrame, back_rows: int = 0) -> DataFrame:
        """Adds the slice of each row and the handed-over rows (``_halo``); ``_is_busy`` only if there are busy keys."""
        columns, first = df.columns, F.lit(0).cast("bigint").alias(SLICE)
        busy = busy_keys(df, [self.key], self.rows_per_slice)
        if busy is None:
            return df.select(*columns, first, F.lit(False).alias(HALO))
        marked = beside(df, busy, [self.key])
        at = F.col("_position")
        placed = positions(marked.where(F.col(ROWS).isNotNull()), self.key, (self.time, *self.ties), "_position")
        size = F.lit(self.rows_per_slice)
        out = marked.where(F.col(ROWS).isNull()).select(*columns, first, F.lit(False).alias(HALO), F.lit(False).alias(BUSY))
        out = out.unionByName(placed.select(*columns, whole_div(at, size).alias(SLICE), F.lit(False).alias(HALO),
                                            F.lit(True).alias(BUSY)))
        if back_rows:
            reach = F.least(whole_div(at + back_rows, size), whole_div(F.col(ROWS) - 1, size))
            ahead = placed.where(reach > whole_div(at, size)).withColumn(
                SLICE, F.explode(F.sequence(whole_div(at, size) + 1, reach)))
            out = out.unionByName(ahead.select(*columns, SLICE, F.lit(True).alias(HALO), F.lit(True).alias(BUSY)))
        return out

    def running(self, cut: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
        """Totals from the first row of the key up to and including each row.

        Call it right after ``cut``; measures are additive expressions over the input columns.
        """
        parts = {f"_m{i}": F.when(F.col(HALO), F.lit(None)).otherwise(m) for i, m in enumerate(measures.values())}
        so_far = self.window().rowsBetween(Window.unboundedPreceding, 0)
        local = cut.withColumns(parts).withColumns({n: F.sum(n).over(so_far) for n in parts})
        if BUSY not in cut.columns:
            return local.select(*cut.columns, *[F.coalesce(n, F.lit(0)).alias(name) for n, name in zip(parts, measures)])
        earlier = Window.partitionBy(self.key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carried = (cut.where(F.col(BUSY) & ~F.col(HALO)).groupBy(self.key, SLICE)
                   .agg(*[F.sum(m).alias(f"_c{i}") for i, m in enumerate(measures.values())])
                   .select(self.key, SLICE, *[F.sum(f"_c{i}").over(earlier).alias(f"_c{i}") for i in
                                              range(len(measures))]))
        return beside(local, carried, [self.key, SLICE]).select(
            *cut.columns,
            *[(F.coalesce(f"_m{i}", F.lit(0)) + F.coalesce(f"_c{i}", F.lit(0))).alias(name)
              for i, name in enumerate(measures)])

    def upto(self, cut: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
        """Totals from the first row of the key up to each row's instant, rows of the same instant included."""
        instant = Window.partitionBy(self.key, SLICE).orderBy(self.time).rangeBetween(
            Window.unboundedPreceding, Window.currentRow)
        plain = _plain(cut).select(
            "*", *[F.coalesce(F.sum(m).over(instant), F.lit(0)).alias(name) for name, m in measures.items()])
        return plain.unionByName(self._at_instants(cut, None, measures)) if BUSY in cut.columns else plain

    def recent(self, cut: DataFrame, ms: int, measures: Mapping[str, Column]) -> DataFrame:
        """Totals of the rows at most ``ms`` before each row, ties included.

        A RANGE frame that moves at both ends is added up anew for every row, which is quadratic for a key with many
        rows per frame. Instead each row enters the total at its time and leaves it ``ms + 1`` later, and one running
        total over both gives the answer. The copies are made after the shuffle: that of the windows before, or where keys
        are cut into slices, one by key and slice. Where there is one slice it is a constant, which windows leave out, so
        such a shuffle would be of no use to them.
        """
        parts = {f"_r{i}": m for i, m in enumerate(measures.values())}
        placed = _plain(cut).repartition(self.key, SLICE) if BUSY in cut.columns else cut
        twice = placed.withColumns(parts).withColumn(LEAVING, F.explode(F.array(F.lit(False), F.lit(True))))
        kept = {self.key, SLICE, HALO, BUSY, self.time}
        leaves = F.col(LEAVING)
        moved = twice.select(
            *[F.col(c) if c in kept else F.when(~leaves, F.col(c)).alias(c) for c in cut.columns if c != self.time],
            F.when(leaves, F.col(self.time) + (ms + 1)).otherwise(F.col(self.time)).alias(self.time), leaves,
            *[F.when(leaves, -F.col(p)).otherwise(F.col(p)).alias(p) for p in parts])
        upto = (Window.partitionBy(self.key, SLICE).orderBy(self.time)
                .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        totals = [F.coalesce(F.sum(p).over(upto), F.lit(0)).alias(name) for p, name in zip(parts, measures)]
        plain = moved.select(*cut.columns, LEAVING, *totals).where(~leaves).drop(LEAVING)
        return plain.unionByName(self._at_instants(cut, ms, measures)) if BUSY in cut.columns else plain

    def _at_instants(self, cut: DataFrame, ms: int | None, measures: Mapping[str, Column]) -> DataFrame:
        """The rows of busy keys with totals up to their instant, or of the last ``ms`` before it.

        Rows are combined per instant first. Instants are added up within stretches of time, each of which has a bounded
        number of them, and one total per stretch is carried on; rows then look their instant up.
        """
        rows = cut.where(F.col(BUSY))
        names = [f"_t{i}" for i in range(len(measures))]
        sums = rows.where(~F.col(HALO)).groupBy(self.key, F.col(self.time).alias("_time")).agg(
            *[F.sum(m).alias(n) for n, m in zip(names, measures.values())])
        if ms is not None:
            left = sums.select(self.key, (F.col("_time") + (ms + 1)).alias("_time"), *[(-F.col(n)).alias(n) for n in names])
            sums = sums.unionByName(left).groupBy(self.key, "_time").agg(*[F.sum(n).alias(n) for n in names])
        spark = cut.sparkSession
        sums = staged(spark, sums.withColumn("_stretch", F.floor(F.col("_time") / STRETCH)), "instants")
        before = Window.partitionBy(self.key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
        carried = sums.groupBy(self.key, "_stretch").agg(*[F.sum(n).alias(n) for n in names]).select(
            self.key, "_stretch", *[F.sum(n).over(before).alias(f"_c{n}") for n in names])
        inside = Window.partitionBy(self.key, "_stretch").orderBy("_time").rowsBetween(Window.unboundedPreceding, 0)
        totals = beside(sums.withColumns({n: F.sum(n).over(inside) for n in names}), carried, [self.key, "_stretch"]).select(
            self.key, F.col("_time").alias(self.time),
            *[(F.coalesce(n, F.lit(0)) + F.coalesce(f"_c{n}", F.lit(0))).alias(name) for n, name in zip(names, measures)])
        # both sides are written tables, so the rows of a burst are split
        return beside(rows, staged(spark, totals, "totals"), [self.key, self.time])

    def close(self, df: DataFrame) -> DataFrame:
        return df.where(~F.col(HALO)).drop(SLICE, HALO, BUSY)


def _plain(cut: DataFrame) -> DataFrame:
    return cut.where(~F.col(BUSY)) if BUSY in cut.columns else cut
