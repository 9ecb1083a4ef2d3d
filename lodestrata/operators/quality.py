"""Quality rules: measure in Spark, judge in one small report, stop the run at the end."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityGateFailed(RuntimeError):
    """At least one quality rule found violations."""


class Measures:
    """The measured numbers by name, as columns of the report's one-row input."""

    def __init__(self, numbers: Column) -> None:
        self._numbers = numbers

    def __getitem__(self, name: str) -> Column:
        return self._numbers[name]


Wording = str | Callable[[Measures], Column]


@dataclass(frozen=True)
class Rule:
    """A rule passes when its violations add up to zero.

    ``passed`` and ``failed`` word the result: a text with ``{measure}`` marks, or a function.
    """

    name: str
    violations: Sequence[str]
    passed: Wording
    failed: Wording


def _words(wording: Wording, measures: Measures) -> Column:
    if callable(wording):
        return wording(measures)
    pieces = []
    for words, measure, _, _ in Formatter().parse(wording):
        if words:
            pieces.append(F.lit(words))
        if measure is not None:
            pieces.append(measures[measure].cast("string"))
    return F.concat(*pieces)


def count_where(conditions: Mapping[str, Column]) -> list[Column]:
    """One aggregate per condition: the rows for which it is true."""
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]


def quality_report(measured: Sequence[DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule (rule, passed, violations, detail), all rules, in the order given.

    ``measured`` are one-row frames of counts with names that differ. They become one row of
    numbers, so the whole report is a single plan and a single job.
    """
    tall = []
    for frame in measured:
        numbers = [
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("bigint").alias("n"))
            for c in frame.columns
        ]
        tall.append(frame.select(F.inline(F.array(*numbers))))
    row = reduce(DataFrame.unionByName, tall).agg(
        F.map_from_entries(F.collect_list(F.struct("measure", "n"))).alias("numbers")
    )
    measures = Measures(F.col("numbers"))
    results = []
    for rule in rules:
        violations = reduce(add, (measures[v] for v in rule.violations))
        good = violations == 0
        results.append(
            F.struct(
                F.lit(rule.name).alias("rule"),
                good.alias("passed"),
                violations.alias("violations"),
                F.when(good, _words(rule.passed, measures))
                .otherwise(_words(rule.failed, measures))
                .alias("detail"),
            )
        )
    return row.select(F.inline(F.array(*results)))


def raise_on_failures(report: DataFrame, headline: str) -> None:
    """One error that lists every failed rule; ``headline`` may hold ``{n}``. One row per rule is read."""
    failed = report.filter(~F.col("passed")).select("rule", "detail").collect()
    if failed:
        lines = [headline.format(n=len(failed)), *(f"- {r['rule']}: {r['detail']}" for r in failed)]
        raise QualityGateFailed("\n".join(lines))
