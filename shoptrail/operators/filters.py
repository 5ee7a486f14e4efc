"""Row filters shared by the batch queries."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _given(bound: str | None) -> bool:
    return bound is not None and bound.strip("".join(map(chr, range(33)))) != ""


def between_dates(
    table: DataFrame, start: str | None = None, end: str | None = None, column: str = "date"
) -> DataFrame:
    """Keep ``start <= date <= end``, both inclusive and compared as text; a blank bound is no bound."""
    if _given(start):
        table = table.filter(F.col(column) >= F.lit(start))
    if _given(end):
        table = table.filter(F.col(column) <= F.lit(end))
    return table


def is_click(category: Column) -> Column:
    """``-1`` stands for "no click"."""
    return category != -1


def is_one_of(column: Column, texts: Sequence[str]) -> Column:
    """Whether a ``bigint`` is written like one of the texts, so ``'01'`` does not match 1.

    Texts that are no plain number match nothing; the others become numbers, so that the test is on the
    bare column and reaches the scan.
    """
    plain = [t for t in texts if re.fullmatch("0|-?[1-9][0-9]{0,18}", t)]
    numbers = [n for n in map(int, plain) if -(2**63) <= n < 2**63]
    return column.isin(numbers) if numbers else F.lit(False)


def is_pair_of(first: Column, second: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Whether ``(first, second)`` is one of the pairs, as text."""
    if not pairs:
        return F.lit(False)
    wanted = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs]
    return F.struct(first.cast("string").alias("a"), second.cast("string").alias("b")).isin(wanted)


def at_least(table: DataFrame, threshold: int, column: str = "n") -> DataFrame:
    """Groups whose count reaches the threshold."""
    return table.filter(F.col(column) >= threshold)
