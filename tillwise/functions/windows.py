"""Window expressions. NULL order is descending-first, ascending-last everywhere.

Windows without partition keys run in one task. They are meant for month-level rows only, whose
number is bounded by the calendar; aggregate before using them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tillwise.functions.measures import ratio
from tillwise.schemas import OPEN_END


def by(keys: Sequence[str] = (), *order: Column) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def version_number(keys: Sequence[str], order: str) -> Column:
    return F.row_number().over(by(keys, asc(order)))


def rank_desc(keys: Sequence[str], c: str) -> Column:
    return F.rank().over(by(keys, desc(c)))


def prev(c: str, order: str, keys: Sequence[str] = ()) -> Column:
    return F.lag(c).over(by(keys, asc(order)))


def next_or_open(start: str, keys: Sequence[str], *tiebreak: str, open_end: dt.date = OPEN_END) -> Column:
    w = by(keys, asc(start), *[asc(t) for t in tiebreak])
    return F.coalesce(F.lead(start).over(w), F.lit(open_end))


def running_sum(c: str, order: str, keys: Sequence[str] = ()) -> Column:
    return F.sum(c).over(by(keys, asc(order)).rowsBetween(Window.unboundedPreceding, 0))


def moving_avg(c: str, order: str, n: int, scale: int = 2, keys: Sequence[str] = ()) -> Column:
    frame = by(keys, asc(order)).rowsBetween(1 - n, 0)
    return ratio(F.sum(c).over(frame), F.count(c).over(frame), scale)


def share_of_total(c: str, scale: int = 2) -> Column:
    return ratio(F.col(c), F.sum(c).over(Window.partitionBy()), scale, pct=True)
