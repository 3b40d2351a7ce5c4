"""Checks that a summary is consistent with the rows it was made from, and that
several customers' rows are consistent with each other.

``facts`` is ``client_facts`` of the input rows; both it and ``summary`` are read
by many checks, so a validation run works on stored copies of the two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfold.functions.spans import covers
from spanfold.operators.hot import Limits
from spanfold.plans.stats import (
    accepted,
    client_facts,
    client_ip_counts,
    client_sets,
    household_input_totals,
    household_ip_extents,
    household_ip_stats,
    household_output_totals,
    household_span_counts,
    input_counts,
    no_client_ids,
    output_counts,
    overall_counts,
    span_statistics,
    summary_clients,
)
from spanfold.sources.placed import Placed, place
from spanfold.sources.scratch import stored

HOUSEHOLD_IP = ["householdId", "ip"]


def _same_clients() -> Column:
    # both arrays are sorted and distinct; only the input one may hold the empty id
    return F.filter("inputClientIds", lambda c: F.size(c) != 0) == F.col("outputClientIds")


def household_consistency(rows: DataFrame, facts: DataFrame, summary: DataFrame) -> DataFrame:
    """Households whose ip count and bounds agree on both sides, with a flag for
    their client sets and a score; ordered by score. Households that do not agree
    are absent here: see ``household_mismatches``."""
    n_households = summary.agg(F.count_distinct("householdId")).scalar()
    scored = _consistent_households(rows, facts, summary, n_households)
    return scored.orderBy("householdIdEncoding", "minStartTime")


def placed_consistency(placed: Placed) -> DataFrame:
    """The same over ``rows``, ``facts`` and ``summary`` that are placed by household."""
    n_households = placed.whole("summary").agg(F.count_distinct("householdId")).scalar()
    scored = placed.over(
        lambda rows, facts, summary: _consistent_households(rows, facts, summary, n_households),
        "rows", "facts", "summary",
    )
    return scored.orderBy("householdIdEncoding", "minStartTime")


def placed_by_household(
    rows: DataFrame, summary: DataFrame, n_buckets: int = 200, limits: Limits | None = None
) -> Placed:
    """What the checks of one summary read: ``rows`` (usable ones, four columns), their client
    ``facts`` and the ``summary``, placed by household. One exchange of the rows in all."""
    usable = accepted(rows).select("householdId", "ip", "clientId", "timeSpan")
    placed = place(usable, "rows", n_buckets, limits).with_derived("facts", client_facts, "rows")
    return placed.with_placed("summary", summary)


def placed_mismatches(placed: Placed) -> DataFrame:
    """Of ordinary households whole client sets are compared, where they are; of hot ones id by
    id, as ``household_mismatches`` does."""
    return placed.over(_mismatches_of_sets, "facts", "summary", hot=household_mismatches)


def _mismatches_of_sets(facts: DataFrame, summary: DataFrame) -> DataFrame:
    named = facts.where(F.size("clientId") != 0)
    left = household_input_totals(facts).join(client_sets(named, "clients"), "householdId", "left")
    right = household_output_totals(summary).join(
        client_sets(summary_clients(summary), "clients"), "householdId", "left"
    )
    compared = left.alias("i").join(right.alias("o"), "householdId", "full_outer")

    def same(name: str) -> Column:
        return F.col(f"i.{name}").eqNullSafe(F.col(f"o.{name}"))

    on_both = F.col("i.ipCount").isNotNull() & F.col("o.ipCount").isNotNull()
    return compared.select(
        "householdId",
        same("ipCount").alias("sameIpCount"),
        (same("minStartTime") & same("maxEndTime")).alias("sameBounds"),
        (on_both & same("clients")).alias("sameClientIds"),
    ).where("NOT (sameIpCount AND sameBounds AND sameClientIds)")


def _consistent_households(
    rows: DataFrame, facts: DataFrame, summary: DataFrame, n_households: Column
) -> DataFrame:
    agree = ["ipCount", "minStartTime", "maxEndTime"]
    # one key, so sides placed by household stay there; the client sets come last
    both = _same_bounds(household_input_totals(facts), household_output_totals(summary), agree)
    both = both.join(household_span_counts(rows), "householdId")
    both = both.join(client_sets(facts, "inputClientIds"), "householdId")
    both = both.join(client_sets(summary_clients(summary), "outputClientIds"), "householdId", "left")
    both = both.withColumn("outputClientIds", F.coalesce("outputClientIds", no_client_ids()))
    return both.select(
        "householdId",
        (F.col("outputRecordCount") / n_households * F.col("ipCount")).alias(
            "householdIdEncoding"
        ),
        "ipCount",
        "minStartTime",
        "maxEndTime",
        "inputTimeSpanCount",
        "outputTimeSpanCount",
        "inputClientIds",
        "outputClientIds",
        _same_clients().alias("sameClientIds"),
        "inputRecordCount",
        "outputRecordCount",
    )


def _same_bounds(left: DataFrame, right: DataFrame, agree: list[str]) -> DataFrame:
    """Joined by household alone. As two inequalities, the further conditions do not
    become join keys, which both sides would have to be shuffled by anew."""
    other = right.withColumnsRenamed({c: f"{c}2" for c in agree})
    both = left.join(other, "householdId")
    for column in agree:
        both = both.where((F.col(column) <= F.col(f"{column}2")) & (F.col(column) >= F.col(f"{column}2")))
    return both.drop(*[f"{c}2" for c in agree])


def _client_differences(facts: DataFrame, summary: DataFrame) -> DataFrame:
    """Households with a client id that only one side has. Compares id by id, so
    that no client set has to be held in one place."""

    def side(pairs: DataFrame, n_input: int, n_output: int) -> DataFrame:
        flags = F.lit(n_input).alias("isInput"), F.lit(n_output).alias("isOutput")
        return pairs.select("householdId", "clientId", *flags)

    return (
        side(facts.where(F.size("clientId") != 0), 1, 0)
        .unionByName(side(summary_clients(summary), 0, 1))
        .groupBy("householdId", "clientId")
        .agg(F.max("isInput").alias("isInput"), F.max("isOutput").alias("isOutput"))
        .where("isInput <> isOutput")
        .select("householdId", F.lit(True).alias("otherClients"))
        .distinct()
    )


def household_mismatches(facts: DataFrame, summary: DataFrame) -> DataFrame:
    """Households missing on one side, or with another ip count, bounds or client
    set there."""
    left = household_input_totals(facts).alias("i")
    right = household_output_totals(summary).alias("o")

    def same(name: str) -> Column:
        return F.col(f"i.{name}").eqNullSafe(F.col(f"o.{name}"))

    on_both = F.col("i.ipCount").isNotNull() & F.col("o.ipCount").isNotNull()
    compared = left.join(right, "householdId", "full_outer").select(
        "householdId",
        same("ipCount").alias("sameIpCount"),
        (same("minStartTime") & same("maxEndTime")).alias("sameBounds"),
        on_both.alias("onBoth"),
    )
    return (
        compared.join(_client_differences(facts, summary), "householdId", "left")
        .select(
            "householdId",
            "sameIpCount",
            "sameBounds",
            (F.col("onBoth") & F.col("otherClients").isNull()).alias("sameClientIds"),
        )
        .where("NOT (sameIpCount AND sameBounds AND sameClientIds)")
    )


def interleaving_ips(facts: DataFrame, summary: DataFrame) -> DataFrame:
    """Summary rows that do not hold the whole extent of their household and ip:
    another ip came in between."""
    span = F.col("timeSpan.startTimeMs"), F.col("timeSpan.endTimeMs")
    held = covers(*span, F.col("minStartTime"), F.col("maxEndTime"))
    return (
        household_ip_extents(facts)
        .join(summary, HOUSEHOLD_IP)
        .where(~held)
        .select(*HOUSEHOLD_IP, "timeSpan")
        .orderBy("timeSpan.startTimeMs", "ip")
    )


def spans_outside_household(facts: DataFrame, summary: DataFrame) -> DataFrame:
    """Summary rows that reach beyond what the input shows of their household, or whose
    household it does not show at all."""
    bounds = facts.groupBy("householdId").agg(
        F.min("minStartTime").alias("householdMinStart"), F.max("maxEndTime").alias("householdMaxEnd")
    )
    inside = covers(
        F.col("householdMinStart"), F.col("householdMaxEnd"),
        F.col("timeSpan.startTimeMs"), F.col("timeSpan.endTimeMs"),
    )
    rows = summary.select(*HOUSEHOLD_IP, "timeSpan").join(bounds, "householdId", "left")
    return rows.where(~F.coalesce(inside, F.lit(False)))


def unknown_clients(facts: DataFrame, summary: DataFrame) -> DataFrame:
    """Client ids of the summary that the input never shows for their household
    and ip. An anti-join, so no client set has to be compared in one place."""
    return summary_clients(summary).join(facts, [*HOUSEHOLD_IP, "clientId"], "left_anti")


def output_with_empty_clients(ip_stats: DataFrame, summary: DataFrame) -> DataFrame:
    """Every summary row, next to the statistics of its household and ip where
    that had rows without a client (NULL otherwise)."""
    had_empty = ip_stats.where(F.col("emptyClientIdCount") != 0)
    return summary.select(*HOUSEHOLD_IP, "clientIds").join(had_empty, HOUSEHOLD_IP, "left")


def client_ip_mismatches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Clients of both inputs that have a different number of ips in each."""

    def side(facts: DataFrame, n: int) -> DataFrame:
        return client_ip_counts(facts).withColumnsRenamed(
            {"ipCount": f"ipCount{n}", "recordCount": f"recordCount{n}"}
        )

    return side(left, 1).join(side(right, 2), "clientId").where(
        "ipCount1 <> ipCount2 AND ipCount1 <> 0 AND ipCount2 <> 0"
    )


def client_ip_spread(facts: DataFrame) -> DataFrame:
    """The same for any number of customers at once: clients for which some two
    customers differ. Least and greatest tell that without forming the pairs."""
    return (
        client_ip_counts(facts, "customer")
        .where("ipCount <> 0")
        .groupBy("clientId")
        .agg(
            F.min("ipCount").alias("minIpCount"),
            F.max("ipCount").alias("maxIpCount"),
            F.count(F.lit(1)).alias("nCustomers"),
        )
        .where("minIpCount <> maxIpCount")
    )


def _unpivoted(counts: DataFrame, value: str) -> DataFrame:
    return counts.unpivot([], ["nHHs", "nIps", "nClients"], "count", value)


def totals_report(facts: DataFrame, summary: DataFrame) -> DataFrame:
    expected = _unpivoted(input_counts(facts), "expected")
    actual = _unpivoted(output_counts(summary), "actual")
    return expected.join(actual, "count").select(
        F.concat(F.lit("output "), "count").alias("check"), "expected", "actual"
    )


def customers_report(facts: DataFrame) -> DataFrame:
    """Every two customers agree on a total when its least and greatest do."""
    return (
        input_counts(facts, "customer")
        .unpivot(["customer"], ["nHHs", "nIps", "nClients"], "count", "n")
        .groupBy("count")
        .agg(F.min("n").alias("expected"), F.max("n").alias("actual"))
        .select(F.concat(F.lit("customers "), "count").alias("check"), "expected", "actual")
    )


def _none_expected(name: str, errors: DataFrame) -> DataFrame:
    return errors.agg(F.count(F.lit(1)).alias("actual")).select(
        F.lit(name).alias("check"), F.lit(0).cast("long").alias("expected"), "actual"
    )


def validation_report(facts: DataFrame, summary: DataFrame) -> DataFrame:
    """``check, expected, actual, ok``. ``facts`` are those per ``customer``."""
    report = totals_report(facts, summary).unionByName(customers_report(facts))
    for name, errors in {
        "client ip counts": client_ip_spread(facts),
        "household mismatches": household_mismatches(facts, summary),
        "unknown clients": unknown_clients(facts, summary),
        "spans outside household": spans_outside_household(facts, summary),
    }.items():
        report = report.unionByName(_none_expected(name, errors))
    return report.withColumn("ok", F.col("expected") == F.col("actual"))


@dataclass(frozen=True)
class ValidationRun:
    """The result tables of one validation run."""

    counts: DataFrame
    households: DataFrame
    interleaving: DataFrame
    with_empty_clients: DataFrame
    summary: DataFrame

    @classmethod
    def of(cls, rows: DataFrame, summary: DataFrame, facts: DataFrame | None = None) -> ValidationRun:
        facts = stored(client_facts(rows) if facts is None else facts, "facts")
        return cls(
            overall_counts(facts, summary),
            household_consistency(rows, facts, summary),
            interleaving_ips(facts, summary),
            output_with_empty_clients(household_ip_stats(facts), summary),
            summary,
        )

    def tables(self) -> dict[str, DataFrame]:
        return {
            "households": self.households,
            "interleaving": self.interleaving,
            "summary": self.summary,
            "with empty clients": self.with_empty_clients,
        }

    def statistics(self) -> dict[str, DataFrame]:
        """Tables that stay equal when households and clients are renamed."""
        return {
            "counts": self.counts,
            "households": self.households.drop("householdId", "inputClientIds", "outputClientIds"),
            "interleaving": span_statistics(self.interleaving),
            "with empty clients": self.with_empty_clients.agg(F.count(F.lit(1)).alias("n")),
        }


def validate(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """The report over stored facts of the rows, which carry a ``customer``."""
    return validation_report(stored(client_facts(rows, "customer"), "facts"), summary)


def rejects_report(found: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows the roll-up left out, and those written beside the summary."""

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name)).withColumn("check", F.lit("rejected rows"))

    both = count(found, "expected").join(count(kept, "actual"), "check")
    return both.select("check", "expected", "actual", (F.col("expected") == F.col("actual")).alias("ok"))


def raise_failed(report: DataFrame) -> None:
    # bounded: one line per check
    failed = report.where(~F.col("ok")).collect()
    if failed:
        raise AssertionError(
            "; ".join(f"{r.check}: expected {r.expected}, found {r.actual}" for r in failed)
        )


def assert_valid(rows: DataFrame, summary: DataFrame) -> None:
    """Run every check; fail with the ones that do not hold."""
    raise_failed(validate(rows, summary))
