"""Absorbing runs that name no client into a neighbour on the same ip.

Per household and ip: a run without clients joins the next later run that has
some; trailing ones join the last such run; if there is none they become one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanfold.functions.clients import empty_only
from spanfold.operators.hot import Step
from spanfold.operators.islands import HOUSEHOLD, merged_spans
from spanfold.sources.scratch import stored


def _named_from_here_on(runs: DataFrame, group: Sequence[str]) -> DataFrame:
    """Count, from the latest run back, the runs that name a client. Runs of one
    household and ip start at different times, so the start orders them."""
    latest_first = (
        Window.partitionBy(*group)
        .orderBy(F.desc("start"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    named = (~empty_only(F.col("clients"))).cast("long")
    return runs.withColumn("named", named).withColumn("later", F.sum("named").over(latest_first))


def _target() -> Column:
    return F.greatest(F.col("later"), F.lit(1)).alias("target")


def absorb(runs: DataFrame, keys: Sequence[str] = HOUSEHOLD) -> DataFrame:
    group = [*keys, "ip"]
    counted = _named_from_here_on(runs, group).withColumn("target", _target())
    return merged_spans(counted, [*group, "target"]).drop("target")


def absorb_sliced(
    runs: DataFrame, add_slice: Step, keys: Sequence[str] = HOUSEHOLD
) -> DataFrame:
    group = [*keys, "ip"]
    local = stored(_named_from_here_on(add_slice(runs), [*group, "slice"]), "sliced-absorb")
    later_slices = (
        Window.partitionBy(*group)
        .orderBy(F.desc("slice"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        local.groupBy(*group, "slice")
        .agg(F.sum("named").alias("n"))
        .withColumn("after", F.coalesce(F.sum("n").over(later_slices), F.lit(0)))
        .drop("n")
    )
    counted = local.join(carried, [*group, "slice"]).withColumn(
        "later", F.col("later") + F.col("after")
    )
    return merged_spans(counted.withColumn("target", _target()), [*group, "target"]).drop("target")
