"""Counts and statistics of input rows and of summaries, for comparing the two.

Most of them start from ``client_facts``, one row per household, ip and client id.
It is built by one aggregation that combines rows before its shuffle, is far
smaller than the rows, and can be stored once for a whole validation.

Client sets appear as sorted arrays. They are collected from distinct ids, so
they grow with the ids of a household and not with its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfold.sources.rows import is_usable, known_households


def accepted(rows: DataFrame) -> DataFrame:
    """The rows the roll-up uses, with a NULL client id as the empty one."""
    return known_households(rows).where(is_usable()).withColumn(
        "clientId", F.coalesce("clientId", _no_ids("array<int>"))
    )


def _no_ids(kind: str) -> Column:
    return F.array().cast(kind)


def _has_client() -> Column:
    return F.size("clientId") != 0


def _bounds(
    start: str = "timeSpan.startTimeMs", end: str = "timeSpan.endTimeMs"
) -> tuple[Column, Column]:
    return F.min(start).alias("minStartTime"), F.max(end).alias("maxEndTime")


def _outer_bounds() -> tuple[Column, Column]:
    return _bounds("minStartTime", "maxEndTime")


def client_facts(rows: DataFrame, *by: str) -> DataFrame:
    """``<by>, householdId, ip, clientId`` with row count ``n`` and extent."""
    return accepted(rows).groupBy(*by, "householdId", "ip", "clientId").agg(
        F.count(F.lit(1)).alias("n"), *_bounds()
    )


def combined_facts(facts: DataFrame) -> DataFrame:
    """Facts without regard to what they were grouped by further."""
    return facts.groupBy("householdId", "ip", "clientId").agg(F.sum("n").alias("n"), *_outer_bounds())


def input_counts(facts: DataFrame, *by: str) -> DataFrame:
    """Distinct households, ips and clients, and rows without a client; per group
    when ``by`` is given."""
    return facts.groupBy(*by).agg(
        F.count_distinct("householdId").alias("nHHs"),
        F.count_distinct("ip").alias("nIps"),
        F.count_distinct(F.when(_has_client(), F.col("clientId"))).alias("nClients"),
        F.coalesce(F.sum(F.when(~_has_client(), F.col("n"))), F.lit(0)).alias("nEmptyRows"),
    )


def output_counts(summary: DataFrame) -> DataFrame:
    exploded = summary.select("householdId", "ip", F.explode_outer("clientIds").alias("clientId"))
    return exploded.agg(
        F.count_distinct("householdId").alias("nHHs"),
        F.count_distinct("ip").alias("nIps"),
        F.count_distinct(F.when(_has_client(), F.col("clientId"))).alias("nClients"),
        F.count_if(F.coalesce(~_has_client(), F.lit(False))).alias("nEmptyRows"),
    )


def overall_counts(facts: DataFrame, summary: DataFrame) -> DataFrame:
    def side(name: str, counts: DataFrame) -> DataFrame:
        return counts.select(F.lit(name).alias("side"), "*")

    return side("Input", input_counts(facts)).unionByName(side("Output", output_counts(summary)))


def client_sets(pairs: DataFrame, name: str) -> DataFrame:
    """Distinct first: it combines before the shuffle and spreads a large household
    over its ids, which collecting all rows into a set would not."""
    distinct = pairs.select("householdId", "clientId").distinct()
    return distinct.groupBy("householdId").agg(F.array_sort(F.collect_list("clientId")).alias(name))


def household_input_totals(facts: DataFrame) -> DataFrame:
    return facts.groupBy("householdId").agg(
        F.count_distinct("ip").alias("ipCount"),
        F.sum("n").alias("inputRecordCount"),
        *_outer_bounds(),
    )


def household_output_totals(summary: DataFrame) -> DataFrame:
    """Two distinct counts, each by a grouping of its own: as one aggregation they would copy
    every row per count and move it by more than its household."""
    spans = summary.groupBy("householdId", "timeSpan").agg(F.count(F.lit(1)).alias("n"))
    per_span = spans.groupBy("householdId").agg(
        F.count("timeSpan").alias("outputTimeSpanCount"),
        F.sum("n").alias("outputRecordCount"),
        *_bounds(),
    )
    ips = summary.groupBy("householdId").agg(F.count_distinct("ip").alias("ipCount"))
    return ips.join(per_span, "householdId").select(
        "householdId", "ipCount", "outputTimeSpanCount", "outputRecordCount", "minStartTime", "maxEndTime"
    )


def household_span_counts(rows: DataFrame) -> DataFrame:
    return accepted(rows).groupBy("householdId").agg(
        F.count_distinct("timeSpan").alias("inputTimeSpanCount")
    )


def household_input_stats(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Per household of the input: ips, rows, extent, spans and client set."""
    n_spans = household_span_counts(rows)
    clients = client_sets(facts, "inputClientIds")
    return household_input_totals(facts).join(clients, "householdId").join(n_spans, "householdId")


def no_client_ids() -> Column:
    return _no_ids("array<array<int>>")


def summary_clients(summary: DataFrame) -> DataFrame:
    return summary.select("householdId", "ip", F.explode("clientIds").alias("clientId"))


def household_output_stats(summary: DataFrame) -> DataFrame:
    clients = client_sets(summary_clients(summary), "outputClientIds")
    named = household_output_totals(summary).join(clients, "householdId", "left")
    return named.withColumn(
        "outputClientIds", F.coalesce("outputClientIds", no_client_ids())
    )


def _with_household_bounds(ip_stats: DataFrame) -> DataFrame:
    bounds = ip_stats.groupBy("householdId").agg(
        F.min("minStartTime").alias("householdMinStart"),
        F.max("maxEndTime").alias("householdMaxEnd"),
    )
    return ip_stats.join(bounds, "householdId")


def household_ip_extents(facts: DataFrame) -> DataFrame:
    """Full extent of each (household, ip), next to that of its household."""
    return _with_household_bounds(facts.groupBy("householdId", "ip").agg(*_outer_bounds()))


def household_ip_stats(facts: DataFrame) -> DataFrame:
    """The extents with every client id seen and how often, as ``inputClients``:
    the list of all ids without spelling out its copies."""
    stats = facts.groupBy("householdId", "ip").agg(
        F.array_sort(F.collect_list(F.struct("clientId", "n"))).alias("inputClients"),
        *_outer_bounds(),
        F.sum(F.when(_has_client(), 0).otherwise(F.col("n"))).alias("emptyClientIdCount"),
    )
    return _with_household_bounds(stats)


def client_ip_counts(facts: DataFrame, *by: str) -> DataFrame:
    """How many ips, and rows, each client id has; per group when ``by`` is given."""
    return facts.groupBy(*by, "clientId").agg(
        F.count_distinct("ip").alias("ipCount"), F.sum("n").alias("recordCount")
    )


def span_statistics(df: DataFrame) -> DataFrame:
    """Count, mean, min and max of both ends of ``timeSpan``. The sum behind the
    mean is exact, so equal data gives an equal mean in any row order."""

    def of(field: str) -> Column:
        ms = F.col(f"timeSpan.{field}")
        exact_sum = F.sum(ms.cast("decimal(20,0)")).cast("double")
        return F.struct(
            F.lit(field).alias("field"),
            F.count(ms).alias("count"),
            (exact_sum / F.count(ms)).alias("mean"),
            F.min(ms).alias("min"),
            F.max(ms).alias("max"),
        )

    both = df.agg(F.array(of("startTimeMs"), of("endTimeMs")).alias("both"))
    return both.select(F.inline("both"))
