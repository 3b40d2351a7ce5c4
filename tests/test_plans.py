"""What the plans must look like to hold at scale."""

import re

import pytest
from notation import PLAIN, SLICED, fixed_slicer, folded_frame, parse

import __spark_entry__ as driver
from spanfold.operators import absorb, islands, runs
from spanfold.operators.hot import Limits
from spanfold.plans import stats, validation
from spanfold.plans.summary import (
    household_islands,
    household_summary,
    merge_increment,
    summary_by_grains,
)
from spanfold.sources.events_view import assignment_input
from spanfold.sources.scratch import stored

SMALL = "/root/testdata/sf0.001"
MINUTES = fixed_slicer(60_000)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange ([^\n]*)", plan_of(df))


def test_roll_up_shuffles_rows_once(spark):
    out = household_summary(assignment_input(spark, SMALL))
    (only,) = exchanges(out)
    assert only.startswith("hashpartitioning(householdId")


def test_islands_shuffle_by_household_and_ip(spark):
    (only,) = exchanges(household_islands(assignment_input(spark, SMALL)))
    assert re.match(r"hashpartitioning\(householdId#\d+, ip#\d+", only)


@pytest.mark.parametrize("limits", [PLAIN, SLICED])
def test_no_python_workers_and_no_cross_join(spark, limits):
    plan = plan_of(household_summary(assignment_input(spark, SMALL), limits))
    assert not re.search(r"Python|ArrowEval|CartesianProduct|NestedLoop", plan)


def window_partitions(df):
    """[(partition columns, lines below)] of every window in the optimized plan"""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.lstrip(" :+-") for line in plan.split("\n")]
    found = []
    for i, line in enumerate(lines):
        partition = re.match(r"Window \[.*?\], \[([^\]]*)\], \[[^\]]*\]$", line)
        if partition:
            below = next(x for x in lines[i + 1:] if not x.startswith(("Window", "Project")))
            found.append((partition[1], below))
    return found


@pytest.mark.parametrize(
    "sliced",
    [
        lambda df: islands.islands_sliced(df, MINUTES),
        lambda df: runs.timeline_sliced(df, MINUTES),
        lambda df: runs.runs_sliced(df, MINUTES),
        lambda df: absorb.absorb_sliced(df, MINUTES),
    ],
    ids=["islands", "timeline", "runs", "absorb"],
)
def test_sliced_forms_window_a_group_over_slice_summaries_only(spark, sliced):
    given = folded_frame(spark, parse("A:{1}[1,2] A:{2}[3,4] B:{}[9,9]"))
    windows = window_partitions(sliced(given))
    assert windows
    for partition, below in windows:
        assert "slice" not in partition
        assert re.match(r"Aggregate \[householdId#\d+, (ip#\d+, )?slice#", below)


def test_scan_reads_only_what_the_roll_up_needs(spark):
    plan = plan_of(household_summary(assignment_input(spark, SMALL)))
    assert "props" not in plan
    assert "IsNotNull(user_id)" in plan


def test_an_increment_leaves_other_groups_unsorted(spark, tmp_path):
    islands_of = folded_frame(spark, parse("A:{1}[1,2] A:{2}[5,6] B:{}[9,9]"))
    islands_of.write.parquet(f"{tmp_path}/islands")
    existing = spark.read.parquet(f"{tmp_path}/islands")
    merged = merge_increment(existing, folded_frame(spark, parse("A:{3}[2,4]")), PLAIN)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    passed = plan[plan.index("LeftAnti"):]
    assert "Window" in plan and not re.search("Window|Aggregate.*collect", passed)
    assert merged.count() == 3


def test_one_key_joins_the_sides_of_a_household(spark):
    rows = assignment_input(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = stored(stats.client_facts(rows), "facts")
        summary = stored(household_summary(rows, PLAIN), "summary")
        plan = plan_of(validation.household_consistency(rows, facts, summary))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"hashpartitioning\([^)]*ipCount", plan)
    assert len(re.findall("Exchange hash", plan)) <= 13


def shuffles_by_household(df):
    df.count()
    return [e for e in exchanges(df) if re.match(r"hashpartitioning.*householdId#", e)]


@pytest.fixture
def without_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_placed_datasets_are_compared_where_they_are(spark, without_broadcasts):
    """No check of placed datasets shuffles by household, nor does storing their facts."""
    rows = assignment_input(spark, SMALL)
    out = stored(household_summary(rows, PLAIN), "summary")
    placed = validation.placed_by_household(rows, out, 4)
    for found in (
        validation.placed_consistency(placed),
        validation.placed_mismatches(placed),
        placed.over(validation.spans_outside_household, "facts", "summary"),
        placed.over(stats.client_facts, "rows"),
    ):
        assert not shuffles_by_household(found), plan_of(found)
    assert shuffles_by_household(validation.household_mismatches(stats.client_facts(rows), out))
    # joined by household and more: Spark keeps the buckets only if it is told so
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    for check in (validation.unknown_clients, validation.interleaving_ips):
        found = placed.over(check, "facts", "summary")
        assert not shuffles_by_household(found), plan_of(found)
    placed.drop()


def test_placed_hot_households_are_checked_too(spark):
    rows = assignment_input(spark, SMALL)
    lost = rows.where("not (ip = 2 and householdId like '%5')").where("householdId <> '7'")
    out = stored(household_summary(lost, PLAIN), "summary")
    placed = validation.placed_by_household(rows, out, 4, Limits(hot_rows=70))
    n_hot = placed.hot_households.count()
    assert 0 < n_hot < rows.select("householdId").distinct().count() - 1
    facts = stats.client_facts(rows)
    for found, expected in (
        (validation.placed_mismatches(placed), validation.household_mismatches(facts, out)),
        (validation.placed_consistency(placed), validation.household_consistency(rows, facts, out)),
    ):
        found, expected = ([str(r) for r in df.collect()] for df in (found, expected))
        assert sorted(found) == sorted(expected) and found
    placed.drop()


def test_several_grains_come_from_one_scan_and_one_exchange(spark):
    plan = plan_of(summary_by_grains(assignment_input(spark, SMALL)))
    (only,) = re.findall(r"Exchange ([^\n]*)", plan)
    assert only.startswith("hashpartitioning(householdId") and "period" not in only.split(")")[0]
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_facts_combine_before_their_shuffle(spark):
    plan = plan_of(stats.client_facts(assignment_input(spark, SMALL)))
    before_shuffle = plan[plan.index("Exchange"):]
    assert "partial_count" in before_shuffle and plan.count("Exchange") == 1


def test_every_query_has_an_oracle():
    assert set(driver._own_queries()) == set(driver.oracles.oracle_sql())


def test_entry(spark):
    out = driver.entry(spark)
    assert out.columns == ["householdId", "ip", "startMs", "endMs", "clients", "nClients", "version"]
    assert out.count() == 72
