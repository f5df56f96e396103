"""Regressions of every order from one cross-product matrix, by successive elimination.

A matrix column holds the sums of products of some variables, the target last.  Eliminating
the variables one after the other leaves, after k steps, what the first k variables don't
explain: the last diagonal element is then the residual sum of squares of that order.
Everything is higher-order functions on the row's own matrix.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A variable of which less than this share is left depends on those before it, and is passed over.
DEPENDENT = 1e-10


def cross_products(variables: list[str]) -> Column:
    """Aggregate: the symmetric matrix of sums of products of some columns.

    One SQL text: a matrix of 30 variables is 900 cells, which are slow to build one by one.
    """
    cell = lambda a, b: f"coalesce(sum(`{min(a, b)}` * `{max(a, b)}`), 0D)"
    rows = (", ".join(cell(a, b) for b in variables) for a in variables)
    return F.expr("array(" + ", ".join(f"array({row})" for row in rows) + ")")


def _at(matrix: Column, i: Column, j: Column) -> Column:
    return F.get(F.get(matrix, i), j)


def eliminate(matrix: Column, steps: Column) -> Column:
    """(m, rest): the matrix after eliminating the variables of ``steps``, and the target's
    residual sum of squares after each of them."""
    last = F.size(matrix) - 1

    def step(state: Column, k: Column) -> Column:
        m = state["m"]
        pivot = _at(m, k, k)
        usable = pivot > DEPENDENT * F.greatest(F.get(state["first"], k), F.lit(1e-300))
        row = F.get(m, k)
        after = F.transform(m, lambda r: F.zip_with(r, row, lambda x, p: x - F.get(r, k) * p / pivot))
        return F.struct(
            F.when(usable, after).otherwise(m).alias("m"),
            # What was left before this step; the last is added at the end.
            F.concat(state["rest"], F.array(_at(m, last, last))).alias("rest"),
            state["first"].alias("first"),
        )

    start = F.struct(
        matrix.alias("m"), F.array().cast("array<double>").alias("rest"), F.transform(matrix, lambda r, i: F.get(r, i)).alias("first")
    )

    def finish(state: Column) -> Column:
        rest = F.concat(F.slice(state["rest"], 2, F.size(matrix)), F.array(_at(state["m"], last, last)))
        return F.struct(state["m"].alias("m"), rest.alias("rest"))

    return F.aggregate(steps, start, step, finish)


def slope_t(matrix: Column, others: Column, which: Column, n: Column) -> Column:
    """t statistic of one variable in the regression on it and ``others`` from ``n`` rows."""
    last = F.size(matrix) - 1
    left = eliminate(matrix, others)["m"]
    sxx, sxy, syy = _at(left, which, which), _at(left, which, last), _at(left, last, last)
    usable = sxx > DEPENDENT * F.greatest(_at(matrix, which, which), F.lit(1e-300))
    rest = syy - sxy * F.try_divide(sxy, sxx)
    variance = F.try_divide(rest, n - F.size(others) - 1)
    return F.when(usable & (variance > 0), F.try_divide(sxy, sxx) / F.sqrt(F.try_divide(variance, sxx)))
