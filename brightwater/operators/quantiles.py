"""Exact quantiles of many columns at once, without gathering a column.

``percentile`` keeps every distinct value of a column in one task, which no
executor survives on a large table. Here each wanted rank is first bracketed by
``approx_percentile`` and then settled by counting: one aggregate counts the
values below, at and inside each bracket and picks the order statistic from the
few values strictly inside. The counts prove the pick, so the result is exact;
a bracket that proves wrong or too full is narrowed or widened and tried again.
Only one row of numbers reaches the driver per pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame

ACCURACY = 10_000
INSIDE_LIMIT = 50_000
CUTS = 64


@dataclass
class _Search:
    """Wanted order statistics (0-based ranks) of one column within one bracket.

    ``expected`` bounds the number of rows strictly between the bracket's ends.
    """

    column: str
    ranks: list[int]
    low: float
    high: float
    expected: float


def numeric_value(column: str) -> str:
    """The column as double with NaN read as missing."""
    return f"nanvl(CAST(`{column}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def double_literal(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _aggregate(df: DataFrame, columns: dict[str, str]) -> dict:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()]).collect()[0].asDict()


def _approximate(value: str, probabilities: list[float]) -> str:
    clipped = ", ".join(f"{min(1.0, max(0.0, p)):.9f}D" for p in probabilities)
    return f"percentile_approx({value}, array({clipped}), {ACCURACY})"


def _probe(search: _Search, i: int) -> dict[str, str]:
    """Counts around the bracket, and either the values sought or cuts to narrow by."""
    value, low, high = f"`{search.column}`", double_literal(search.low), double_literal(search.high)
    strictly = f"CASE WHEN {value} > {low} AND {value} < {high} THEN {value} END"
    below, at_low = f"count_if({value} < {low})", f"count_if({value} = {low})"
    columns = {
        f"below{i}": below,
        f"at_low{i}": at_low,
        f"inside{i}": f"count({strictly})",
        f"at_high{i}": f"count_if({value} = {high} AND {high} > {low})",
    }
    if search.expected > INSIDE_LIMIT:
        columns[f"cuts{i}"] = _approximate(strictly, [j / CUTS for j in range(CUTS + 1)])
    else:
        picks = [f"get(sort_array(collect_list({strictly})), CAST({r} - {below} - {at_low} AS INT))" for r in search.ranks]
        columns[f"found{i}"] = f"array({', '.join(picks)})"
    return columns


def _advance(
    search: _Search, row: dict, i: int, extremes: tuple[float, float], rows: int, settled: dict[tuple[str, int], float]
) -> list[_Search]:
    """Settle the ranks the counts decide; return searches for the others."""
    below, at_low, inside, at_high = (row[f"{part}{i}"] for part in ("below", "at_low", "inside", "at_high"))
    left = []
    for j, rank in enumerate(search.ranks):
        offset = rank - below - at_low
        key = (search.column, rank)
        if rank < below:
            left.append(_Search(search.column, [rank], extremes[0], search.low, rows))
        elif offset < 0:
            settled[key] = search.low
        elif offset >= inside + at_high:
            left.append(_Search(search.column, [rank], search.high, extremes[1], rows))
        elif offset >= inside:
            settled[key] = search.high
        elif f"found{i}" in row:
            settled[key] = row[f"found{i}"][j]
        else:
            cuts, step = row[f"cuts{i}"], int(offset / inside * CUTS)
            low = cuts[step - 1] if step >= 1 else search.low
            high = cuts[step + 2] if step + 2 <= CUTS else search.high
            left.append(_Search(search.column, [rank], low, high, inside * (3 / CUTS + 2 / ACCURACY)))
    return left


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; None where a column has no value.

    Runs aggregates on ``df``: one pass for counts and brackets and usually one
    to settle every rank. Persist ``df`` if it is costly to compute.
    """
    if not columns:
        return {}
    margin = 2 / ACCURACY
    values = df.selectExpr(*[f"{numeric_value(c)} AS `{c}`" for c in columns])
    first: dict[str, str] = {}
    wanted = sorted({q for p in probabilities for q in (p - margin, p + margin)})
    for i, c in enumerate(columns):
        first |= {f"n{i}": f"count(`{c}`)", f"lo{i}": f"min(`{c}`)", f"hi{i}": f"max(`{c}`)"}
        first[f"q{i}"] = _approximate(f"`{c}`", wanted)
    row = _aggregate(values, first)
    sizes = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    extremes = {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)}
    searches = []
    for i, c in enumerate(columns):
        if not sizes[c]:
            continue
        near = dict(zip(wanted, row[f"q{i}"]))
        for p in dict.fromkeys(probabilities):
            position = p * (sizes[c] - 1)
            ranks = sorted({math.floor(position), math.ceil(position)})
            searches.append(_Search(c, ranks, near[p - margin], near[p + margin], 6 * sizes[c] / ACCURACY + 2))
    rows = max(sizes.values())
    settled: dict[tuple[str, int], float] = {}
    while searches:
        probes: dict[str, str] = {}
        for i, s in enumerate(searches):
            probes |= _probe(s, i)
        counts = _aggregate(values, probes)
        searches = [t for i, s in enumerate(searches) for t in _advance(s, counts, i, extremes[s.column], rows, settled)]
    result: dict[str, list[float | None]] = {}
    for c in columns:
        result[c] = []
        for p in probabilities:
            position = p * (sizes[c] - 1)
            low, high = settled.get((c, math.floor(position))), settled.get((c, math.ceil(position)))
            result[c].append(low if low is None or low == high else low + (high - low) * (position - math.floor(position)))
    return result
