import pytest
from notation import parse, rows_frame
from pyspark.sql import functions as F

from spanfold.plans import stats, validation
from spanfold.plans.diff import compare_exact, compare_statistics
from spanfold.plans.summary import household_summary
from spanfold.plans.validation import ValidationRun

ROWS = (
    "HH1 A:4[11,12] B:5[21,22] A:6[31,32] B:-[31,32] HH2 A:1[31,32] B:2[21,22] B:3[11,12] "
    "HH3 A:2[11,12] A:3[11,15]"
)


@pytest.fixture(scope="module")
def rows(spark):
    return rows_frame(spark, parse(ROWS)).withColumn("customer", F.lit(123)).cache()


@pytest.fixture(scope="module")
def facts(rows):
    return stats.client_facts(rows)


@pytest.fixture(scope="module")
def summary(rows):
    return household_summary(rows).cache()


def test_every_check_passes(rows, summary):
    validation.assert_valid(rows, summary)
    assert validation.validate(rows, summary).where("ok").count() == 10


def test_a_damaged_summary_is_refused(rows, summary):
    with pytest.raises(AssertionError, match="output nHHs: expected 3, found 2"):
        validation.assert_valid(rows, summary.where("householdId <> 'HH2'"))
    stranger = summary.withColumn("clientIds", F.expr("array(array(99))"))
    with pytest.raises(AssertionError, match="unknown clients"):
        validation.assert_valid(rows, stranger)


def test_counts(facts, summary):
    found = {r.side: tuple(r)[1:] for r in stats.overall_counts(facts, summary).collect()}
    assert found == {"Input": (3, 2, 6, 1), "Output": (3, 2, 6, 0)}


def test_counts_of_nothing(rows, summary):
    nothing = stats.client_facts(rows.where("false"))
    found = stats.overall_counts(nothing, summary.where("false")).collect()
    assert [tuple(r)[1:] for r in found] == [(0, 0, 0, 0)] * 2


def test_households_score_and_order(rows, facts, summary):
    found = validation.household_consistency(rows, facts, summary).collect()
    assert [(r.householdId, r.householdIdEncoding) for r in found] == [
        ("HH3", 1 / 3 * 1), ("HH2", 2 / 3 * 2), ("HH1", 3 / 3 * 2),
    ]
    assert all(r.sameClientIds for r in found)
    first = found[-1]
    assert first.inputClientIds == [[], [4], [5], [6]] and first.outputClientIds == [[4], [5], [6]]
    assert (first.inputRecordCount, first.outputRecordCount, first.inputTimeSpanCount) == (4, 3, 3)


def test_a_client_on_two_rows_counts_once(spark):
    # one client on both sides of another ip: two output rows share it
    rows = rows_frame(spark, parse("A:1[1,2] B:2[3,4] A:1[5,6] A:3[5,6]"))
    out = household_summary(rows)
    assert validation.household_mismatches(stats.client_facts(rows), out).count() == 0


def test_mismatches_name_their_cause(facts, summary):
    changed = summary.where("NOT (householdId = 'HH1' AND ip = 20)").unionByName(
        summary.where("householdId = 'HH3'").withColumn("householdId", F.lit("HH9"))
    )
    found = {r.householdId: tuple(r)[1:] for r in validation.household_mismatches(facts, changed).collect()}
    assert found == {"HH1": (False, True, False), "HH9": (False, False, False)}


def test_interleaving(facts, summary):
    found = [
        (r.householdId, r.ip, r.timeSpan.startTimeMs // 60000)
        for r in validation.interleaving_ips(facts, summary).collect()
    ]
    assert found == [("HH1", 10, 11), ("HH1", 10, 31)]


def test_rows_that_had_empty_clients(facts, summary):
    joined = validation.output_with_empty_clients(stats.household_ip_stats(facts), summary)
    found = {(r.householdId, r.ip): r.emptyClientIdCount for r in joined.collect()}
    assert found[("HH1", 20)] == 1 and found[("HH2", 10)] is None
    assert joined.count() == summary.count()


def test_ip_stats_count_copies(spark):
    rows = rows_frame(spark, parse("A:1[1,2] A:1[1,2] A:1[5,6] A:-[7,8] B:2[0,99]"))
    (found,) = stats.household_ip_stats(stats.client_facts(rows)).where("ip = 10").collect()
    assert [tuple(c) for c in found.inputClients] == [([], 1), ([1], 3)]
    assert (found.minStartTime, found.maxEndTime, found.householdMaxEnd) == (60000, 480000, 99 * 60000)


def test_client_ips_across_customers(spark):
    one = rows_frame(spark, parse("A:1[1,2] B:1[3,4] A:2[1,2] A:3[1,1]"))
    two = rows_frame(spark, parse("A:1[1,2] A:2[3,4] A:2[5,6] B:4[1,1]"))
    pair = validation.client_ip_mismatches(stats.client_facts(one), stats.client_facts(two)).collect()
    assert [(r.clientId, r.ipCount1, r.ipCount2) for r in pair] == [([1], 2, 1)]
    both = one.withColumn("customer", F.lit(1)).unionByName(two.withColumn("customer", F.lit(2)))
    spread = validation.client_ip_spread(stats.client_facts(both, "customer")).collect()
    assert [(r.clientId, r.minIpCount, r.maxIpCount) for r in spread] == [([1], 1, 2)]


def test_span_statistics(summary):
    found = {r.field: r for r in stats.span_statistics(summary).collect()}
    starts = [r.timeSpan.startTimeMs for r in summary.collect()]
    assert found["startTimeMs"]["count"] == len(starts)
    assert found["startTimeMs"]["mean"] == sum(starts) / len(starts)
    assert found["endTimeMs"]["max"] == 32 * 60000


def test_runs_compare(rows, summary):
    same = ValidationRun.of(rows, summary), ValidationRun.of(rows, summary)
    assert compare_exact(*same).where("nMismatched <> 0 OR nExpected <> nActual").count() == 0

    renamed = rows.withColumn("householdId", F.concat(F.lit("x"), "householdId"))
    other = ValidationRun.of(renamed, household_summary(renamed))
    differing = {r.table for r in compare_exact(same[0], other).where("nMismatched <> 0").collect()}
    # rows carry the names; statistics do not
    assert differing == {"households", "interleaving", "summary", "with empty clients"}
    assert compare_statistics(same[0], other).where("nMismatched <> 0").count() == 0
