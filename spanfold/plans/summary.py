"""The roll-up: rows -> islands -> runs -> absorbed runs -> household summary.

Every function takes assignment rows. Ordinary households go through window
functions over one exchange on the household; hot ones go through the sliced
operators, which spread one household over many tasks. ``hot`` says from which
size on a group is hot, or hands over what ``find_hot`` found in the rows before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfold.functions.clients import client_ids
from spanfold.functions.spans import time_span, utc_date
from spanfold.operators import absorb, islands, runs
from spanfold.operators.hot import Hot, Limits, Step, slicer
from spanfold.sources.rows import SUMMARY_VERSION, spans
from spanfold.sources.scratch import stored

HOUSEHOLD = islands.HOUSEHOLD
HOUSEHOLD_IP = ("householdId", "ip")
LIMITS = Limits()
GRAINS = ("Daily", "Monthly")


@dataclass(frozen=True)
class Stage:
    """One step of the roll-up: its two forms, and whether a household's ips are
    independent in it."""

    plain: Callable[..., DataFrame]
    sliced: Callable[..., DataFrame]
    per_ip: bool

    def on_hot(self, df: DataFrame, hot: Hot, keys: Sequence[str] = HOUSEHOLD) -> DataFrame:
        """On rows of hot households. Per ip, only the hot pairs need slicing."""
        if not self.per_ip:
            return self.sliced(df, slicer(hot.household_slices, HOUSEHOLD), keys)
        return hot.by_pair(
            df,
            lambda ips: self.plain(ips, keys),
            lambda ips: self.sliced(ips, slicer(hot.pair_slices, HOUSEHOLD_IP), keys),
        )


ISLANDS = Stage(islands.islands, islands.islands_sliced, per_ip=True)
TIMELINE = Stage(runs.timeline, runs.timeline_sliced, per_ip=False)
RUNS = Stage(runs.runs, runs.runs_sliced, per_ip=False)
ABSORB = Stage(absorb.absorb, absorb.absorb_sliced, per_ip=True)


def fold(
    rows: DataFrame,
    stages: Sequence[Stage],
    hot: Limits | Hot = LIMITS,
    period: Column | None = None,
) -> DataFrame:
    """Run the stages over the rows. With ``period``, each period of a row's start
    is folded on its own, as one job per period would."""
    extra = ()
    if period is not None:
        rows, extra = rows.withColumn("period", period), ("period",)
    return fold_spans(spans(rows, extra=extra), stages, hot, extra)


def fold_spans(
    found: DataFrame,
    stages: Sequence[Stage],
    hot: Limits | Hot = LIMITS,
    extra: Sequence[str] = (),
    expand: Step | None = None,
) -> DataFrame:
    """Run the stages over spans, or over islands, by household and the ``extra`` columns.
    ``expand`` may make several rows of one behind the exchange, and add columns to fold by."""
    hot = Hot.of(found, hot)
    keys = [*HOUSEHOLD, *extra]
    expanded = expand or (lambda df: df)
    # rows that are expanded later move once, by what they have now
    placed = [k for k in keys if k in found.columns]

    def plain(df: DataFrame) -> DataFrame:
        df = expanded(df.repartition(*placed))
        for stage in stages:
            df = stage.plain(df, keys)
        return df

    def sliced(df: DataFrame) -> DataFrame:
        df = expanded(df)
        for number, stage in enumerate(stages):
            if number and stage.per_ip and hot.pair_slices is not None:
                df = stored(df, "hot-steps")  # read twice: hot pairs and other ips
            df = stage.on_hot(df, hot, keys)
        return df

    return hot.by_household(found, plain, sliced)


def summarize(folded: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return folded.select(
        "householdId",
        *extra,
        "ip",
        time_span(F.col("start"), F.col("end")).alias("timeSpan"),
        client_ids(F.col("clients")).alias("clientIds"),
        F.lit(SUMMARY_VERSION).alias("version"),
    )


def household_islands(rows: DataFrame, hot: Limits | Hot = LIMITS) -> DataFrame:
    """Islands alone need no household in one place, only a household's ip."""
    found = spans(rows)
    return ISLANDS.on_hot(found, Hot.of(found, hot))


def household_timeline(rows: DataFrame, hot: Limits | Hot = LIMITS) -> DataFrame:
    return fold(rows, [ISLANDS, TIMELINE], hot)


def household_runs(rows: DataFrame, hot: Limits | Hot = LIMITS) -> DataFrame:
    return fold(rows, [ISLANDS, RUNS], hot)


def absorbed_runs(rows: DataFrame, hot: Limits | Hot = LIMITS) -> DataFrame:
    return fold(rows, [ISLANDS, RUNS, ABSORB], hot)


def household_summary(rows: DataFrame, hot: Limits | Hot = LIMITS) -> DataFrame:
    """``householdId, ip, timeSpan, clientIds, version``; one row per household, ip
    and start, so the rows are distinct without a further exchange."""
    return summarize(absorbed_runs(rows, hot))


def merge_increment(
    existing: DataFrame, increment: DataFrame, hot: Limits | Hot = LIMITS
) -> DataFrame:
    """Islands of an increment folded into existing islands, which do not overlap each
    other where the increment has nothing to say. Only the (household, ip) pairs that it
    touches are coalesced anew, fully, so no overlap is left whatever order increments
    arrive in; all others pass through unsorted."""
    on = list(HOUSEHOLD_IP)
    pairs = increment.select(*on).distinct()
    touched = existing.join(pairs, on, "left_semi").unionByName(increment)
    rest = existing.join(pairs, on, "left_anti")
    coalesced = ISLANDS.on_hot(touched, Hot.of(touched, hot))
    return coalesced.unionByName(rest.select(*coalesced.columns))


def _period(grain: str, start: Column) -> Column:
    day = utc_date(start)
    return {"Daily": day, "Monthly": F.trunc(day, "month")}[grain]


def period_of(grain: str) -> Column:
    """Period of a row's start for a coarse grain, as a date."""
    return _period(grain, F.col("timeSpan.startTimeMs"))


def summary_by_grain(rows: DataFrame, grain: str, hot: Limits | Hot = LIMITS) -> DataFrame:
    folded = fold(rows, [ISLANDS, RUNS, ABSORB], hot, period_of(grain))
    return summarize(folded, extra=("period",))


def summary_by_grains(
    rows: DataFrame, grains: Sequence[str] = GRAINS, hot: Limits | Hot = LIMITS
) -> DataFrame:
    """The summaries of several grains, told apart by ``grain``, from one scan and one
    exchange of the rows: a row becomes one per grain where its household already is."""
    extra = ("grain", "period")
    each = F.explode(
        F.array(*(F.struct(F.lit(g).alias("grain"), _period(g, F.col("start")).alias("period")) for g in grains))
    )

    def expand(df: DataFrame) -> DataFrame:
        return df.select("*", each.alias("at")).select(*df.columns, "at.grain", "at.period")

    return summarize(fold_spans(spans(rows), [ISLANDS, RUNS, ABSORB], hot, extra, expand), extra)
