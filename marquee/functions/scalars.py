from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def english_list(items: ColumnOrName) -> Column:
    """``[a, b, c]`` as ``a, b and c``; one item as itself; none as NULL.

    NULL items before the last are left out of the enumeration; a NULL last
    item makes the whole sentence NULL.
    """
    items = _col(items)
    n = F.size(items)
    enumerated = F.concat_ws(", ", F.slice(items, F.lit(1), n - 1))
    sentence = F.concat(enumerated, F.lit(" and "), F.try_element_at(items, F.lit(-1)))
    return F.when(n > 1, sentence).otherwise(F.try_element_at(items, F.lit(1)))


def date_or_null(text: ColumnOrName) -> Column:
    """A date string as DATE; empty or malformed text as NULL."""
    return _col(text).try_cast("date")


def date_parts(date: ColumnOrName, prefix: str) -> dict[str, Column]:
    """Year, month and day columns, named ``<prefix>_year`` and so on."""
    d = date_or_null(date)
    return {
        f"{prefix}_year": F.year(d),
        f"{prefix}_month": F.month(d),
        f"{prefix}_day": F.dayofmonth(d),
    }


def age_years(date: ColumnOrName, as_of: dt.date | str | None = None, digits: int = 2) -> Column:
    """Years of 365 days from ``date`` to ``as_of`` (today when not given)."""
    end = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.round(F.datediff(end, date_or_null(date)) / F.lit(365), digits)


_COMPARE = {">=": operator.ge, ">": operator.gt, "<": operator.lt, "<=": operator.le}


def bucketize(
    value: ColumnOrName,
    bounds: Sequence[tuple[Any, str]],
    otherwise: str,
    compare: str = ">=",
) -> Column:
    """The label of the first bound that ``value`` meets.

    A NULL value meets none, so it gets the ``otherwise`` label.
    """
    holds = _COMPARE[compare]
    value = _col(value)
    chain = F
    for bound, label in bounds:
        chain = chain.when(holds(value, F.lit(bound)), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def text_length(text: ColumnOrName) -> Column:
    """Number of characters."""
    return F.length(_col(text))


def prefixed(prefix: str, path: ColumnOrName) -> Column:
    """``prefix`` + path, NULL for a NULL path."""
    return F.concat(F.lit(prefix), _col(path))


def differs_flag(left: ColumnOrName, right: ColumnOrName) -> Column:
    """1 where both sides are known and differ, else 0."""
    return F.when(_col(left) != _col(right), F.lit(1)).otherwise(F.lit(0))


def int_to_bool(flag: ColumnOrName) -> Column:
    return _col(flag).cast("boolean")


def bool_to_int(flag: ColumnOrName) -> Column:
    """0 for false, 1 otherwise; NULL counts as 1."""
    return F.when(_col(flag) == F.lit(False), F.lit(0)).otherwise(F.lit(1))


def not_in_flag(value: ColumnOrName, listed: Sequence[Any]) -> Column:
    """1 where a known value is outside ``listed``; 0 for listed and NULL values."""
    value = _col(value)
    outside = ~value.isin(list(listed)) if listed else value.isNotNull()
    return F.when(outside, F.lit(1)).otherwise(F.lit(0))


def hash_bucket(key: ColumnOrName, buckets: int, salt: str = "") -> Column:
    """A bucket in ``[0, buckets)`` that depends on the key's text alone.

    Neither partitioning nor row order changes it, and any SQL engine with
    md5 can repeat it.  A NULL key counts as empty text.
    """
    text = F.coalesce(_col(key).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(salt), text) if salt else text)
    return (F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % buckets).cast("int")
