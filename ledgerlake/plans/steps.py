"""Ordered steps with gates: a step whose check finds problems stops the run."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlake.operators.quality import gate


@dataclass(frozen=True)
class Step:
    """An action and, optionally, the problems it may leave behind."""

    name: str
    run: Callable[[], object]
    check: Callable[[], DataFrame] | None = None


def run_steps(steps: Iterable[Step]) -> dict[str, object]:
    """Run the steps in one application; returns what each of them returned."""
    results: dict[str, object] = {}
    for step in steps:
        results[step.name] = step.run()
        if step.check is not None:
            gate(step.check())
    return results
