"""Jobs of several stages that go on where they were broken off.

A stage reads and writes stored tables. When it is done a mark is put below ``_done``; a job that is run again skips
marked stages. Scratch folders go as soon as every stage that reads them is marked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .. import files


@dataclass(frozen=True)
class Stage:
    """``needs`` names earlier stages; ``scratch`` are folders that only stages which need this one read."""

    name: str
    run: Callable[[], None]
    needs: tuple[str, ...] = ()
    scratch: tuple[str, ...] = ()


def _mark(out: str, stage: Stage) -> str:
    return f"{out}/_done/{stage.name}"


def run_stages(spark: SparkSession, out: str, stages: Sequence[Stage], resume: bool = True) -> list[str]:
    """Run the stages in their order; the names of those that ran. Without ``resume`` all do."""
    names = [s.name for s in stages]
    for i, stage in enumerate(stages):
        if names.count(stage.name) > 1 or not set(stage.needs) <= set(names[:i]):
            raise ValueError(f"stage {stage.name} comes twice or before what it needs")
    if not resume:
        for stage in stages:
            files.delete(spark, _mark(out, stage))
    ran = []
    for i, stage in enumerate(stages):
        if files.exists(spark, _mark(out, stage)):
            continue
        stage.run()
        files.create(spark, _mark(out, stage), "")
        ran.append(stage.name)
        done = set(names[:i + 1])
        for earlier in stages[:i + 1]:
            readers = {s.name for s in stages if earlier.name in s.needs}
            if readers and readers <= done:
                for folder in earlier.scratch:
                    files.delete(spark, folder)
    return ran
