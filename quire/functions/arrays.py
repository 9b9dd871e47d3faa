"""Array functions that Spark lacks; they look at each element once, within a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Arrays grow by copying, so what is gathered is held in blocks of this size.
BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def scan(values: Column, kind: str, first: dict[str, Column], step: Callable[[Column, Column], dict[str, Column]], told: str) -> Column:
    """All states of a fold: an array of ``told`` (of type ``kind``), one of the names of the state, after each
    element. ``first`` is the state before, ``step`` gives the next one."""
    blocks, block = F.array().cast(f"array<array<{kind}>>"), F.array().cast(f"array<{kind}>")
    start = F.struct(blocks.alias("__blocks"), block.alias("__block"), *[v.alias(k) for k, v in first.items()])

    def put(state: Column, x: Column) -> Column:
        full = F.size(state["__block"]) >= BLOCK

        def held(now: Column) -> Column:
            one = F.array(now[told])
            return F.struct(
                F.when(full, F.concat(state["__blocks"], F.array(state["__block"]))).otherwise(state["__blocks"]).alias("__blocks"),
                F.when(full, one).otherwise(F.concat(state["__block"], one)).alias("__block"),
                *[now[k].alias(k) for k in first],
            )

        return let(F.struct(*[v.alias(k) for k, v in step(state, x).items()]), held)

    return F.aggregate(values, start, put, lambda s: F.flatten(F.concat(s["__blocks"], F.array(s["__block"]))))


def run_starts(values: Column) -> Column:
    """Places, from 1, where an element differs from the one before."""
    places = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values))).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: (i == 1) | ~F.get(values, i - 1).eqNullSafe(F.get(values, i - 2)))
