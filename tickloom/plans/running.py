"""Running values from the start of a series: sum, product, count, first or last value seen.

Long series are cut in time buckets. Each bucket is scanned on its own; the buckets' totals,
one row each, are scanned in the same way to give the value entering each bucket; a join on
(key, bucket) adds it. The large side of that join is already partitioned that way.

Recurrences y → a·y + b go the same way: their steps compose to one step per block of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.plans.series import DAILY, Series, bucket_start

# Blocks that are scanned together, at each of the levels above the rows.
FAN, LEVELS = 1024, 3


@dataclass(frozen=True, eq=False)
class Running:
    """One running column. ``before`` leaves the current row out (kind "last" only)."""

    name: str
    kind: str
    value: Column
    before: bool = False

    def over(self, window: WindowSpec) -> Column:
        upto = -1 if self.before else 0
        return self._agg(self.value).over(window.rowsBetween(Window.unboundedPreceding, upto))

    def total(self, value: Column, order: Column) -> Column:
        """Value of a whole group of rows."""
        present = F.when(value.isNotNull(), order)
        if self.kind == "last":
            return F.max_by(value, present)
        if self.kind == "first":
            return F.min_by(value, present)
        return self._agg(value)

    def earlier(self, total: Column, window: WindowSpec) -> Column:
        """Value of all earlier groups."""
        return self._agg(total).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def joined(self, entering: Column, local: Column) -> Column:
        if self.kind == "last":
            return F.coalesce(local, entering)
        if self.kind == "first":
            return F.coalesce(entering, local)
        both = entering * local if self.kind == "product" else entering + local
        return F.coalesce(both, local, entering)

    def _agg(self, value: Column) -> Column:
        if self.kind == "last":
            return F.last(value, ignorenulls=True)
        if self.kind == "first":
            return F.first(value, ignorenulls=True)
        return F.product(value) if self.kind == "product" else F.sum(value)


class Steps(Running):
    """Steps y → p·y + s composed in their order, as structs (p, s)."""

    def total(self, value: Column, order: Column) -> Column:
        each = F.collect_list(F.struct(order.alias("at"), value.alias("step")))
        return _composed(F.transform(F.array_sort(each), lambda e: e["step"]))

    def earlier(self, total: Column, window: WindowSpec) -> Column:
        return _composed(F.collect_list(total).over(window.rowsBetween(Window.unboundedPreceding, -1)))

    def joined(self, entering: Column, local: Column) -> Column:
        return _then(entering, local)


def _step(p: Column, s: Column) -> Column:
    return F.struct(p.alias("p"), s.alias("s"))


def _then(first: Column, second: Column) -> Column:
    return _step(first["p"] * second["p"], second["s"] + second["p"] * first["s"])


def _composed(steps: Column) -> Column:
    return F.aggregate(steps, _step(F.lit(1.0), F.lit(0.0)), _then)


def position(name: str = "_pos") -> Running:
    """Running row count; minus one it is the dense 0-based position."""
    return Running(name, "sum", F.lit(1).cast("bigint"))


def with_running(df: DataFrame, items: list[Running], series: Series = DAILY) -> DataFrame:
    """Append the running columns, cutting long series (see module text)."""
    if not items:
        return df
    if series.cut_rows(df) is None:
        return df.withColumns({i.name: i.over(series.window()) for i in items})

    width, *wider = series.widths(df)
    rows = df.withColumn("_bucket", bucket_start(series.clock(df), width))
    cell = [*series.keys, "_bucket"]
    order = F.struct(series.order, *series.ties) if series.ties else F.col(series.order)
    totals = rows.groupBy(*cell).agg(*[i.total(i.value, order).alias(i.name) for i in items])
    inside = Window.partitionBy(*cell).orderBy(series.order, *series.ties)
    local = rows.withColumns({i.name: i.over(inside) for i in items})
    return (
        local.join(_entering(totals, items, series.keys, wider), cell, "left")
        .withColumns({i.name: i.joined(F.col(f"_in_{i.name}"), F.col(i.name)) for i in items})
        .select(*df.columns, *[i.name for i in items])
    )


def numbered(keys: list[str], size: int) -> Series:
    """Series of rows numbered by ``_pos``, in nested buckets of ``size`` rows and more."""
    widths = tuple(size * FAN**level for level in range(LEVELS))
    return Series(tuple(keys), "_pos", chunk_rows=size, bucket=widths)


def with_steps(
    rows: DataFrame, steps: dict[str, tuple[Column, Column]], keys: list[str], size: int
) -> DataFrame:
    """Append y of each recurrence y → a·y + b over ``_pos``, started at zero.

    ``steps``: name → (a, b). The product of a must stay far from underflow within ``size`` rows.
    """
    series = numbered(keys, size)
    _, *wider = series.widths(rows)
    cells = rows.withColumn("_bucket", bucket_start(F.col("_pos"), size))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, 0
    )
    cells = cells.withColumns({f"_fall_{n}": F.product(a).over(inside) for n, (a, _) in steps.items()})
    cells = cells.withColumns({
        f"_here_{n}": F.sum(b / F.col(f"_fall_{n}")).over(inside) * F.col(f"_fall_{n}")
        for n, (_, b) in steps.items()
    })
    totals = cells.groupBy(*keys, "_bucket").agg(*[
        _step(F.max_by(f"_fall_{n}", "_pos"), F.max_by(f"_here_{n}", "_pos")).alias(n) for n in steps
    ])
    before = _entering(totals, [Steps(n, "steps", F.col(n)) for n in steps], keys, wider)
    return cells.join(before, [*keys, "_bucket"], "left").select(
        *rows.columns,
        *[(F.col(f"_here_{n}") + F.col(f"_fall_{n}") * F.col(f"_in_{n}")["s"]).alias(n) for n in steps],
    )


def _entering(
    totals: DataFrame, items: list[Running], keys: list[str], widths: list[int]
) -> DataFrame:
    """Per (key, bucket): the value of everything before the bucket, as ``_in_<name>``."""
    at = F.col("_bucket")
    if not widths:
        across = Window.partitionBy(*keys).orderBy("_bucket")
        entering = {f"_in_{i.name}": i.earlier(F.col(i.name), across) for i in items}
        return totals.withColumns(entering).select(*keys, "_bucket", *entering)

    width, *wider = widths
    grouped = totals.withColumn("_wide", bucket_start(at, width))
    inside = Window.partitionBy(*keys, "_wide").orderBy("_bucket")
    local = grouped.withColumns({f"_near_{i.name}": i.earlier(F.col(i.name), inside) for i in items})
    outer = _entering(
        grouped.groupBy(*keys, F.col("_wide")).agg(
            *[i.total(F.col(i.name), at).alias(i.name) for i in items]
        ).withColumnRenamed("_wide", "_bucket"),
        items, keys, wider,
    ).withColumnRenamed("_bucket", "_wide")
    return local.join(outer, [*keys, "_wide"], "left").select(
        *keys, "_bucket",
        *[
            i.joined(F.col(f"_in_{i.name}"), F.col(f"_near_{i.name}")).alias(f"_in_{i.name}")
            for i in items
        ],
    )
