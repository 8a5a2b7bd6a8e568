"""What a series is, and how its rows are spread over tasks.

A series is the set of rows sharing ``key``, ordered by ``order`` (unique within a key; keys
are not NULL).

* When ``order`` is a DATE the calendar bounds a series: one row per key and day is at most
  366 rows a year, whatever the size of the whole table. Such a series is one window group.
* Any other order (timestamps, positions) has no such bound, and one key may hold a third of
  all rows. Those series are cut: running values go by time bucket plus a value carried into
  each bucket, fixed windows go by numbered chunk plus copied edge rows. No task sees a whole
  series.

Buckets are bounded too. Narrow buckets lie inside wide ones, and the uniqueness of the order
bounds both: at most 10⁶ microseconds in a second or 65,536 positions in a narrow bucket, and
65,536 narrow buckets in a wide one. Numbers with fractions have no such bound; number such rows first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 65_536
# Narrow and wide bucket: seconds of a timestamp, units of a number.
SECONDS, UNITS = (1, 1 << 16), (1 << 16, 1 << 32)


@dataclass(frozen=True)
class Series:
    """Key and order of a series table, and the cutting of long series.

    ``chunk_rows``: "auto" cuts unless the order is a DATE; a number always cuts; None never does.
    ``bucket``: widths of the time buckets, narrow to wide, in days, seconds or units; by default
    chosen by the type of the order. ``ties`` order rows of equal ``order`` in running values.
    """

    key: tuple[str, ...] | str = ("symbol",)
    order: str = "date"
    chunk_rows: int | str | None = "auto"
    bucket: int | tuple[int, ...] | None = None
    ties: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key)

    def cut_rows(self, df: DataFrame) -> int | None:
        """Rows per chunk, or None when a series may be one window group."""
        if self.chunk_rows != "auto":
            return self.chunk_rows
        return None if isinstance(df.schema[self.order].dataType, T.DateType) else CHUNK_ROWS

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.order, *self.ties)

    def clock(self, df: DataFrame) -> Column:
        """The order as a whole number of days, seconds or units."""
        at, kind = F.col(self.order), df.schema[self.order].dataType
        if isinstance(kind, T.DateType):
            return F.unix_date(at).cast("bigint")
        if isinstance(kind, T.TimestampType):
            return F.unix_seconds(at)
        if isinstance(kind, T.TimestampNTZType):
            # From the calendar parts: no session time zone is involved.
            day = F.unix_date(at.cast("date")).cast("bigint")
            return day * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
        return F.floor(at).cast("bigint")

    def widths(self, df: DataFrame) -> list[int]:
        """Bucket widths, narrow to wide (see module text)."""
        if self.bucket:
            return list(self.bucket) if isinstance(self.bucket, tuple) else [self.bucket]
        kind = df.schema[self.order].dataType
        if isinstance(kind, T.DateType):
            return [CHUNK_ROWS]
        times = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
        return list(SECONDS if times else UNITS)


def bucket_start(clock: Column, width: int) -> Column:
    return clock - F.pmod(clock, F.lit(width).cast("bigint"))


DAILY = Series()
