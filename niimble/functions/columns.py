"""Small Column expressions; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for money sums and for products of factors; the sum is exact, so it does
# not depend on the order in which partial sums arrive.
EXACT_TYPE = "decimal(38,10)"
SHARE_TYPE = "decimal(38,18)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """``top / bottom`` as double, NULL where the bottom is zero or NULL."""
    return F.try_divide(col(top).cast("double"), col(bottom).cast("double"))


def mean(c: str | Column) -> Column:
    """Mean of the non-NULL values as double, summed as ``exact_sum`` does."""
    return ratio(exact_sum(c), F.count(col(c)))


def exact_sum(c: str | Column, as_type: str = EXACT_TYPE) -> Column:
    """Sum as double that is the same for every order and partitioning of the rows.

    Values are rounded to the scale of ``as_type`` (ten places) before they are added. A NaN makes the
    sum NaN; a value or a sum that does not fit the type makes it NULL. No value drops out unseen.
    """
    value = col(c)
    exact = value.try_cast(as_type)
    no_number = F.coalesce(F.bool_or(F.isnan(value.cast("double"))), F.lit(False))
    unfit = F.coalesce(F.bool_or(value.isNotNull() & exact.isNull()), F.lit(False))
    return F.when(no_number, F.lit(float("nan"))).when(~unfit, F.try_sum(exact).cast("double"))


def rounded(c: str | Column, as_type: str) -> Column:
    """A double at the scale of a DECIMAL type; a value that does not fit it stays as it is."""
    value = col(c).cast("double")
    return F.coalesce(col(c).try_cast(as_type).cast("double"), value)


def default(c: str | Column, value: object) -> Column:
    return F.coalesce(col(c), F.lit(value))


def choose(c: str | Column, values: Mapping[str, object], otherwise: object) -> Column:
    """Literal for each listed value of ``c``; NULL and unlisted values give ``otherwise``."""
    picked = F.lit(otherwise)
    for key, value in values.items():
        picked = F.when(col(c) == F.lit(key), F.lit(value)).otherwise(picked)
    return picked


def times(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a * b, columns)


def plus(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
