"""Exponential averages y = (1 - a)·y₋₁ + a·x as window sums, linear in the number of rows.

Each row is an affine step y → A·y + B. With P the running product of A, the steps of a block
of rows add up to y = P·(y before the block) + P·sum(B / P): two running aggregates that restart
in every block, where P stays far from underflow. The value entering a block is folded from the
(P, y) pairs at the ends of the blocks before it, a handful per window group.

Missing values follow the pandas rule (``adjust=False``): a NULL keeps the last average, and the
next value is weighted by a against (1 - a)^(rows since the last value), renormalised.

Long series are cut. The steps of a block are composed to one step, blocks of blocks likewise, and
the average that enters a block is joined back to its rows; so are the number of values so far and
the place of the last one. Results are those of the uncut series for any run of missing values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tickloom.functions.window import Source, derived, so_far, source
from tickloom.plans import Carried, Feature, Running

# Largest fall of P within a block, as a power of e, and the most rows in one.
UNDERFLOW, BLOCK_ROWS = 550.0, 2560
# What is left of an average after a very long gap: it vanishes in a double, but is not zero.
LEAST_WEIGHT = 1e-30


def ema(x: Source, span: int, min_periods: int = 0) -> Feature:
    """Exponential average with a = 2 / (span + 1), started at the first value."""
    c, _ = source(x)
    label = f"ema{span}_{c}" + (f"_min{min_periods}" if min_periods else "")
    return _average(label, x, 2.0 / (span + 1), min_periods, seed_rows=1)


def wilder(x: Source, n: int, seeded: bool = False) -> Feature:
    """Exponential average with a = 1 / n, NULL before n values.

    ``seeded``: starts at the n-th value with the mean of the first n.
    """
    c, _ = source(x)
    return _average(
        f"wilder{n}{'s' if seeded else ''}_{c}", x, 1.0 / n, n, seed_rows=n if seeded else 1
    )


def _average(label: str, x: Source, a: float, min_periods: int, seed_rows: int) -> Feature:
    c, needs = source(x)
    keep = max(1.0 - a, 1e-12)
    row = Feature("_row", lambda w: F.row_number().over(w))
    seen = Feature(f"_seen_{c}", lambda w: F.count(c).over(so_far(w)), needs)
    last = Feature(
        f"_last_{c}",
        lambda w: F.last(F.when(F.col(c).isNotNull(), F.col("_row")), True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)
        ),
        (row, *needs),
    )
    start = Feature(f"_start_{c}", lambda w: F.avg(c).over(so_far(w)), needs)

    known, count = F.col(c).isNotNull(), F.col(seen.name)

    def steps(at: str, first_mean: Column) -> tuple[Column, Column]:
        """A and B of a row numbered by ``at``."""
        rows = F.col(at) - F.col(last.name)
        aged = F.when(rows == 1, F.lit(keep)).otherwise(F.pow(F.lit(keep), rows))
        weight = F.greatest(aged / (aged + a), F.lit(LEAST_WEIGHT))
        # Nothing precedes the seed row, so its own A never matters.
        return (
            F.when(~known | (count <= seed_rows), 1.0).otherwise(weight),
            F.when(~known | (count < seed_rows), 0.0)
            .when(count == seed_rows, first_mean if seed_rows > 1 else F.col(c))
            .otherwise((1.0 - weight) * F.col(c)),
        )

    means = (start,) if seed_rows > 1 else ()
    row_a, row_b = steps(row.name, F.col(start.name))
    step_a = derived(f"_a_{label}", row_a, seen, last)
    step_b = derived(f"_b_{label}", row_b, seen, last, *needs, *means)
    size = max(1, min(BLOCK_ROWS, math.floor(UNDERFLOW / -math.log(keep))))
    fall = Feature(
        f"_p_{label}", lambda w: F.product(step_a.name).over(so_far(w)), (step_a,),
        block=size, restarts=True,
    )
    grown = Feature(
        f"_s_{label}",
        lambda w: F.sum(F.col(step_b.name) / F.col(fall.name)).over(so_far(w)),
        (step_b, fall), block=size, restarts=True,
    )
    here = derived(f"_y_{label}", F.col(grown.name) * F.col(fall.name), grown, fall)
    edge = Feature("_edge", lambda w: F.lead("_block").over(w) != F.col("_block"), block=size)
    ends = Feature(
        f"_ends_{label}",
        lambda w: F.collect_list(
            F.when(F.col("_edge"), F.struct(F.col(fall.name).alias("p"), F.col(here.name).alias("y")))
        ).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        (edge, fall, here),
    )
    entering = F.aggregate(ends.name, F.lit(0.0), lambda y, e: e["y"] + e["p"] * y)
    ready = F.col(seen.name) >= max(min_periods, seed_rows, 1)
    total = f"_total_{c}"
    carried = Carried(
        needs,
        (
            Running(seen.name, "sum", known.cast("bigint")),
            Running(last.name, "last", F.when(known, F.col("_pos")), before=True),
            *((Running(total, "sum", F.col(c).cast("double")),) if seed_rows > 1 else ()),
        ),
        *steps("_pos", F.col(total) / count),
        ready,
        size,
    )
    return Feature(
        label,
        lambda w: F.when(ready, F.col(here.name) + F.col(fall.name) * entering),
        (here, fall, ends, seen),
        carried=carried,
    )
