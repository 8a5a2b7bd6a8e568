"""Columns computed from nearby rows of a series, in one exchange and one sort.

A ``Feature`` is a named column expression over the series window together with the features
it reads and the number of neighbouring rows it reaches. ``with_features`` adds any number of
them: all share one window order, so Spark exchanges and sorts once.

Long series are cut in chunks of numbered rows. Rows near a chunk's edge are copied into the
neighbour that reads them, evaluated there as context and dropped afterwards, so every kept
row sees exactly the rows it would see in the whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.plans.running import Running, numbered, position, with_running, with_steps
from tickloom.plans.scratch import stored
from tickloom.plans.series import DAILY, Series

BLOCK = "_block"


@dataclass(frozen=True, eq=False)
class Carried:
    """A recurrence y → a·y + b for cut series, whose rows are numbered by ``_pos``.

    ``needs`` are the features it reads, ``running`` the running values in ``a``, ``b`` and ``ready``;
    y is NULL where it is not ``ready``. ``size``: the most rows over which the product of a stays
    far from underflow.
    """

    needs: tuple[Feature, ...]
    running: tuple[Running, ...]
    a: Column
    b: Column
    ready: Column
    size: int


@dataclass(frozen=True, eq=False)
class Feature:
    """A named column over a series window.

    ``back`` / ``ahead``: rows its own expression reads before / after the current one.
    ``block``: the feature needs the series divided in blocks of at most that many rows (column
    ``_block``); ``restarts`` makes its window start anew in each block.
    Built names spell out their parameters, so equal names mean equal definitions and shared
    inputs are computed once. ``alias`` is the built name behind a short one. ``carried`` is the
    recurrence that takes the place of the expression on a cut series.
    """

    name: str
    expr: Callable[[WindowSpec], Column]
    needs: tuple[Feature | Running, ...] = ()
    back: int = 0
    ahead: int = 0
    block: int | None = None
    restarts: bool = False
    alias: str | None = None
    carried: Carried | None = None

    def named(self, name: str) -> Feature:
        if name == self.name:
            return self
        built = self.alias or self.name
        return Feature(name, lambda w: F.col(built), self.needs if self.alias else (self,), alias=built)

    @property
    def inputs(self) -> list[Feature]:
        return [n for n in self.needs if isinstance(n, Feature)]

    @property
    def sources(self) -> list[Feature]:
        """The features it reads on a cut series."""
        return list(self.carried.needs) if self.carried else self.inputs

    @cached_property
    def level(self) -> int:
        """Number of recurrences that follow one another up to this feature."""
        return bool(self.carried) + max((n.level for n in self.sources), default=0)

    @cached_property
    def depth(self) -> int:
        return 1 + max((n.depth for n in self.inputs), default=-1)


def with_features(df: DataFrame, *features: Feature, series: Series = DAILY) -> DataFrame:
    """Append one column per feature."""
    out = _whole(df, features, series) if series.cut_rows(df) is None else _cut(df, features, series)
    names = [f.name for f in features]
    return out.select(*[c for c in df.columns if c not in names], *names)


def _whole(df: DataFrame, features: tuple[Feature, ...], series: Series) -> DataFrame:
    """Every series in one window group."""
    needed = _closure(features, lambda f: f.inputs)
    blocks = [f.block for f in needed if f.block]
    out, window = df, Window.partitionBy(*series.keys).orderBy(series.order)
    restarted = window
    if blocks:
        # Ordered by (block, order) all windows need the same sort: keys, block, order.
        out = out.withColumn(BLOCK, _block_number(out, series.order, window, min(blocks)))
        window = Window.partitionBy(*series.keys).orderBy(BLOCK, series.order)
        restarted = Window.partitionBy(*series.keys, BLOCK).orderBy(series.order)
    return _evaluated(
        out.withColumns({r.name: r.over(window) for r in _running(needed)}), needed, window, restarted
    )


def _cut(df: DataFrame, features: tuple[Feature, ...], series: Series) -> DataFrame:
    """Long series: recurrences level by level, then what is left."""
    needed = _closure(features, lambda f: f.sources)
    plain = [f for f in needed if not f.carried]
    chunk, keys = series.cut_rows(df), series.keys
    rows, known = with_running(df, [*_running(plain), position()], series), set()
    for level in range(1, max((f.level for f in needed), default=0) + 1):
        averages = [f for f in needed if f.carried and f.level == level]
        # Written once: the scans below read these rows several times over.
        rows = stored(_near(rows, [n for f in averages for n in f.sources], known, keys, chunk))
        size = min(chunk, *[f.carried.size for f in averages])
        running = {r.name: r for f in averages for r in f.carried.running}
        steps = {f.name: (f.carried.a, f.carried.b) for f in averages}
        before = rows.columns
        rows = with_running(rows, list(running.values()), numbered(keys, size))
        rows = with_steps(rows, steps, keys, size).select(
            *before, *[F.when(f.carried.ready, F.col(f.name)).alias(f.name) for f in averages]
        )
        known.update(steps)
    return _near(rows, features, known, keys, chunk)


def _near(
    rows: DataFrame, features: Iterable[Feature], known: set[str], keys: list[str], chunk: int
) -> DataFrame:
    """Append features of numbered rows that read a bounded number of neighbours.

    ``known``: features that are columns already; those added here join them.
    """
    wanted = {f.name: f for f in features if f.name not in known}
    if not wanted:
        return rows
    needed = _closure(wanted.values(), lambda f: f.sources, known)
    back = max(_reach(f, known, "back") for f in wanted.values())
    ahead = max(_reach(f, known, "ahead") for f in wanted.values())
    spread, home = spread_rows(rows, back, ahead, chunk)
    window = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    known.update(wanted)
    return _evaluated(spread, needed, window, window).filter(home).select(
        *[c for c in rows.columns if c not in wanted], *wanted
    )


def _evaluated(
    df: DataFrame, needed: list[Feature], window: WindowSpec, restarted: WindowSpec
) -> DataFrame:
    """Append all features, inputs before what reads them."""
    for depth in range(max((f.depth for f in needed), default=-1) + 1):
        here = [f for f in needed if f.depth == depth]
        df = df.withColumns({f.name: f.expr(restarted if f.restarts else window) for f in here})
    return df


def _running(needed: list[Feature]) -> list[Running]:
    return list({n.name: n for f in needed for n in f.needs if isinstance(n, Running)}.values())


def _reach(f: Feature, known: set[str], side: str) -> int:
    """Rows before ("back") or after ("ahead") a row that the feature and its inputs read."""
    if f.name in known:
        return 0
    return getattr(f, side) + max((_reach(n, known, side) for n in f.sources), default=0)


def neighbourhood(
    df: DataFrame, running: list[Running], back: int, ahead: int, series: Series
) -> tuple[DataFrame, Column]:
    """A long series in chunks (``_chunk``) of numbered rows (``_pos``) with their neighbours.

    Rows near an edge appear in every chunk that reads them; the returned predicate keeps each
    row once.
    """
    return spread_rows(with_running(df, [*running, position()], series), back, ahead, series.cut_rows(df))


def spread_rows(rows: DataFrame, back: int, ahead: int, chunk: int) -> tuple[DataFrame, Column]:
    """Rows numbered by ``_pos`` from 1 in chunks (``_chunk``), with the neighbours that each chunk reads."""
    first = F.greatest(F.lit(0), F.floor((F.col("_pos") - 1 - ahead) / chunk))
    last = F.floor((F.col("_pos") - 1 + back) / chunk)
    spread = rows.withColumn("_chunk", F.explode(F.sequence(first, last)))
    return spread, F.col("_chunk") == F.floor((F.col("_pos") - 1) / chunk)


def _block_number(df: DataFrame, order: str, window: WindowSpec, size: int) -> Column:
    """Blocks of at most ``size`` rows: of days, else of counted rows."""
    if isinstance(df.schema[order].dataType, T.DateType):
        return F.floor(F.unix_date(order) / size)
    return F.floor(F.row_number().over(window) / size)


def _closure(
    features: Iterable[Feature],
    reads: Callable[[Feature], list[Feature]],
    known: Iterable[str] = (),
) -> list[Feature]:
    """The features and all they read, but for the known ones."""
    found: dict[str, Feature] = {}
    todo = list(features)
    while todo:
        f = todo.pop()
        if f.name in known:
            continue
        if f.name not in found:
            found[f.name] = f
            todo.extend(reads(f))
        elif found[f.name].alias != f.alias:
            raise ValueError(f"two different features are called {f.name!r}; use .named()")
    return list(found.values())
