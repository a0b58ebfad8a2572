"""Composable steps over Columns (or DataFrames).

A step is any one-argument function: ``Column -> Column`` for per-row logic
(stays a native expression, so whole-stage codegen spans the composition) or
``DataFrame -> DataFrame`` for plan fragments (``df.transform`` style).
:class:`Step` adds ``>>`` for "then" so pipelines read left to right.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


class Step:
    """A wrapped one-argument function; ``a >> b`` runs ``a`` then ``b``."""

    __slots__ = ("fn",)

    def __init__(self, fn: Callable[[Any], Any]):
        self.fn = fn.fn if isinstance(fn, Step) else fn

    def __call__(self, value: Any) -> Any:
        return self.fn(value)

    def __rshift__(self, other: Callable[[Any], Any]) -> Step:
        return then(self, other)


def lift(fn: Callable[[Any], Any]) -> Step:
    """Wrap a function as a composable step."""
    return Step(fn)


def identity() -> Step:
    """The neutral step: returns its input unchanged."""
    return Step(lambda value: value)


def then(first: Callable[[Any], Any], second: Callable[[Any], Any]) -> Step:
    """Sequential composition: ``second(first(x))`` (associative)."""
    return Step(lambda value: second(first(value)))


def zip_steps(
    left: Callable[[Column], Column], right: Callable[[Column], Column], names: tuple[str, str] = ("_1", "_2")
) -> Step:
    """Both steps on the same input, paired in a struct ``(names[0], names[1])``."""
    return Step(lambda c: F.struct(left(c).alias(names[0]), right(c).alias(names[1])))


def filter_k(step: Callable[[Column], Column], predicate: Callable[[Column], Column]) -> Step:
    """The step's result where ``predicate`` holds on it, else NULL."""

    def run(c: Column) -> Column:
        produced = step(c)
        return F.when(predicate(produced), produced)

    return Step(run)


def chain(steps: Iterable[Callable[[Any], Any]]) -> Step:
    """Fold steps left to right with :func:`then`; an empty list is the identity."""
    return reduce(then, steps, identity())
