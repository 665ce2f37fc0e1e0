"""Chains of steps with priorities."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def compose(steps: Sequence[tuple[int, Step]]) -> Step:
    """One step out of many, run by ascending priority number.

    Steps that reject rows add a reason (see `filters.with_verdict`) and pass the rows
    on, so the chain ends with kept and rejected rows side by side.
    """
    ordered = [step for _, step in sorted(steps, key=lambda s: s[0])]

    def run(df: DataFrame) -> DataFrame:
        for step in ordered:
            df = df.transform(step)
        return df

    return run
