"""Quantiles by mergeable sketches: approximate in one pass, exact in two or a few more.

A sketch (KLL) keeps a bounded number of a column's values and tells the value
at any rank to a known error.  Sketches are merged in two levels, so that the
last task merges at most ``FAN`` of them however many tasks scan the table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import stage

QUARTILES = (0.25, 0.5, 0.75)
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Partial results that the last task gets.
FAN = 256
#: The largest size a sketch may have; it then keeps at most some 200,000 values, 1.5 MB.
LARGEST = 65_535


def rank_error(size: int) -> float:
    """The share of rows by which a sketch's rank may be off, with 99 % confidence (published fit)."""
    return 2.296 / size**0.9021


def sketch_size(accuracy: int) -> int:
    """The size for a rank error of 1 / ``accuracy``, or the largest there is."""
    return min(max(math.ceil((2.296 * accuracy) ** (1 / 0.9021)), 8), LARGEST)


def merged(df: DataFrame, partial: Mapping[str, Column], final: Mapping[str, Column]) -> DataFrame:
    """One row: ``partial`` over the rows of up to ``FAN`` groups of scan tasks, ``final`` over those."""
    group = F.pmod(F.spark_partition_id(), F.lit(FAN)).alias("scan_group")
    parts = df.groupBy(group).agg(*(c.alias(n) for n, c in partial.items()))
    return parts.agg(*(c.alias(n) for n, c in final.items()))


def is_whole(df: DataFrame, column: str) -> bool:
    return isinstance(next(f.dataType for f in df.schema.fields if f.name == column), INTEGERS)


class Sketched:
    """The sketch of one value: its partial and final aggregates and how to read it."""

    def __init__(self, name: str, value: Column, whole: bool, size: int):
        kind = "bigint" if whole else "double"
        self.partial = {name: getattr(F, f"kll_sketch_agg_{kind}")(value, F.lit(size))}
        self.final = {name: getattr(F, f"kll_merge_agg_{kind}")(name, F.lit(size))}
        self._name, self._read = name, getattr(F, f"kll_sketch_get_quantile_{kind}")
        self._count = getattr(F, f"kll_sketch_get_n_{kind}")

    def at(self, ranks: Sequence[float]) -> Column:
        """The values at these shares of all; null if there is no value."""
        shares = F.array(*(F.lit(min(max(float(r), 0.0), 1.0)) for r in ranks))
        return F.when(self._count(self._name) > 0, self._read(self._name, shares))


def known(df: DataFrame, column: str) -> Column:
    """A column as long or double; NaN counts as unknown."""
    c = F.col(f"`{column}`")
    if is_whole(df, column):
        return c.cast("long")
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


class _Bracket(NamedTuple):
    """The value at ``rank`` of a column lies in ``[low, high]``."""

    column: int
    rank: int
    low: float | int
    high: float | int


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    size: int = LARGEST,
) -> dict[str, list[float | int | None]]:
    """Per numeric column, the values at the ranks ceil(p * n); NULL and NaN are left out."""
    quantiles, _ = select_exact(df, columns, {}, {}, probabilities, size)
    return quantiles


def select_exact(
    df: DataFrame,
    columns: Sequence[str],
    partial: Mapping[str, Column],
    final: Mapping[str, Column],
    probabilities: Sequence[float] = QUARTILES,
    size: int = LARGEST,
) -> tuple[dict[str, list[float | int | None]], DataFrame]:
    """Exact quantiles, and a row with other aggregates (see ``merged``) taken in the first pass.

    The first pass sketches every column and brackets each wanted rank between two values that the
    sketch puts safely before and after it.  A further pass counts the values below, at and between
    the ends, which proves the bracket (or moves it), and sketches those between: where they fit
    into the sketch, it holds them all and the wanted one is read from it, else the next bracket is
    some thousand times narrower.  With the largest sketch two passes do up to 10^8 rows and each
    further one for a thousand times more, on any distribution, infinities and 64-bit integers
    included.  A pass is one scan for all columns; rows are neither copied nor shuffled.
    """
    values = {f"v{i}": known(df, c) for i, c in enumerate(columns)}
    whole = [is_whole(df, c) for c in columns]
    typed = df.withColumns(values)
    sketches = [Sketched(f"s{i}", F.col(f"v{i}"), whole[i], size) for i in range(len(columns))]
    own, last = dict(partial), dict(final)
    for i, sketch in enumerate(sketches):
        own |= sketch.partial | {
            f"n{i}": F.count(f"v{i}"), f"low{i}": F.min(f"v{i}"), f"high{i}": F.max(f"v{i}")
        }
        last |= sketch.final | {
            f"n{i}": F.sum(f"n{i}"), f"low{i}": F.min(f"low{i}"), f"high{i}": F.max(f"high{i}")
        }
    margin = 2 * rank_error(size)
    shares = [s for p in probabilities for s in (p - margin, p, p + margin)]
    one = merged(typed, own, last)
    one = one.withColumns({f"s{i}": sketch.at(shares) for i, sketch in enumerate(sketches)})
    ends = one.first()

    found: dict[tuple[int, int], float | int] = {}
    wanted: list[list[int]] = []
    open_: list[_Bracket] = []
    for i in range(len(columns)):
        n = ends[f"n{i}"] or 0
        wanted.append([max(math.ceil(p * n), 1) for p in probabilities] if n else [])
        for j, rank in enumerate(wanted[i]):
            low, middle, high = ends[f"s{i}"][3 * j : 3 * j + 3]
            if n <= size // 2:
                found[i, rank] = middle  # the sketch holds all values
            else:
                at = probabilities[j]
                low = ends[f"low{i}"] if at <= margin else low
                high = ends[f"high{i}"] if at >= 1 - margin else high
                open_.append(_Bracket(i, rank, low, high))
    while open_:
        open_ = _narrow(typed, whole, open_, found, ends, size)
    return {
        c: [found[i, r] for r in wanted[i]] or [None] * len(probabilities) for i, c in enumerate(columns)
    }, df.sparkSession.createDataFrame([ends], one.schema)


def _narrow(
    typed: DataFrame,
    whole: Sequence[bool],
    brackets: list[_Bracket],
    found: dict[tuple[int, int], float | int],
    ends: Row,
    size: int,
) -> list[_Bracket]:
    """One pass over the values; adds answers to ``found`` and returns what is left, narrower."""
    slots = sorted({(b.column, b.low, b.high) for b in brackets})
    partial, final = {}, {}
    sketches: dict[int, Sketched] = {}
    for k, (i, low, high) in enumerate(slots):
        v = F.col(f"v{i}")
        between = (v > F.lit(low)) & (v < F.lit(high))
        for name, rows in {"below": v < F.lit(low), "at": v == F.lit(low), "in": between, "top": v == F.lit(high)}.items():
            partial[f"{name}{k}"] = F.count_if(rows)
            final[f"{name}{k}"] = F.sum(f"{name}{k}")
        if low != high:  # else the counts alone prove the one value
            sketches[k] = Sketched(f"s{k}", F.when(between, v), whole[i], size)
            partial |= sketches[k].partial
            final |= sketches[k].final
    one = merged(typed, partial, final)
    if sketches:
        # One row; the ranks to read from its sketches are known when its counts are.
        one = stage(one, "quantile-pass")
    counts = one.drop(*(f"s{k}" for k in sketches)).first()
    margin = 2 * rank_error(size)
    left, reads = [], []
    for b in brackets:
        k = slots.index((b.column, b.low, b.high))
        inside = counts[f"in{k}"]
        place = b.rank - counts[f"below{k}"] - counts[f"at{k}"]
        key = b.column, b.rank
        if b.rank <= counts[f"below{k}"]:  # the sketch was off by more than its margin
            left.append(_Bracket(*key, ends[f"low{b.column}"], b.low))
        elif place <= 0:
            found[key] = b.low
        elif place <= inside:
            share = (place - 0.5) / inside
            shares = [share] if inside <= size // 2 else [share - margin, share + margin]
            reads.append((b, sketches[k].at(shares)))
        elif place <= inside + (counts[f"top{k}"] if b.high != b.low else 0):
            found[key] = b.high
        else:
            left.append(_Bracket(*key, b.high, ends[f"high{b.column}"]))
    if reads:
        got = one.select(*(c.alias(f"r{j}") for j, (_, c) in enumerate(reads))).first()
        for (b, _), values in zip(reads, got):
            if len(values) == 1:
                found[b.column, b.rank] = values[0]
            elif (values[0], values[1]) == (b.low, b.high):
                raise ArithmeticError(f"the values between {b.low} and {b.high} do not part")
            else:
                left.append(_Bracket(b.column, b.rank, *values))
    return left
