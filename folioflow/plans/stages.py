"""Ordered item stages: each is DataFrame -> DataFrame, and what it drops is reported."""

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F


class Stage(NamedTuple):
    name: str
    apply: Callable[[DataFrame], DataFrame]
    #: SQL condition of the rows of the stage's output that go no further, and why.
    reject: str | None = None
    reason: str = ""


def run_stages(items: DataFrame, stages: list[Stage]) -> tuple[DataFrame, DataFrame | None]:
    """(rows that passed every stage, rejects as ``identifier, stage, reason``)."""
    rejects = []
    for stage in stages:
        items = items.transform(stage.apply)
        if stage.reject is not None:
            bad = F.coalesce(F.expr(stage.reject), F.lit(False))
            rejects.append(
                items.where(bad).select(
                    "identifier", F.lit(stage.name).alias("stage"), F.lit(stage.reason).alias("reason")
                )
            )
            items = items.where(~bad)
    return items, (reduce(DataFrame.unionByName, rejects) if rejects else None)
