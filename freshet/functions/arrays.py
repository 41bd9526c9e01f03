"""Small helpers for higher-order array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` once for use in several places of `body`.

    Lambda bodies get no common-subexpression elimination, so a value named twice there would be computed per use.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def tail(array: Column) -> Column:
    return F.slice(array, F.lit(2), F.size(array))


def elements(array: Column) -> Column:
    """Generator of (position, element) that computes its array once.

    Exploding a plain column makes the optimizer infer a filter on its size and push that filter, with a copy of the
    expression behind the column, below everything else. An input that is not a plain column is left alone.
    """
    return F.posexplode(F.transform(array, lambda x: x))
