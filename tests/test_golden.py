"""End-to-end cases: rows in, household summary out."""

import pytest
from notation import MINUTE, PLAIN, SLICED, expected_rows, parse, row, rows_frame, summary_rows

from spanfold.plans.summary import household_summary
from spanfold.sources.rows import ROW_SCHEMA, rejects

CASES = {
    "grows": ("A:1[1,1] A:2[1,2] A:3[1,3]", "A:{1,2,3}[1,3]"),
    "shared end": ("A:1[1,5] A:2[2,5] A:3[3,5]", "A:{1,2,3}[1,5]"),
    "points": ("A:1[1,1] A:2[2,2] A:3[3,3]", "A:{1,2,3}[1,3]"),
    "one client, gap": ("A:1[1,2] A:1[4,6] A:1[3,5]", "A:{1}[1,6]"),
    "three clients, gap": ("A:1[1,1] A:2[4,6] A:3[3,5]", "A:{1,2,3}[1,6]"),
    "three ips": (
        "C:1[31,32] B:2[21,22] A:2[11,12]", "A:{2}[11,12] B:{2}[21,22] C:{1}[31,32]",
    ),
    "run at the end": ("A:1[11,12] B:2[21,22] B:3[30,50]", "A:{1}[11,12] B:{2,3}[21,50]"),
    "long span first": (
        "B:4[5,20] A:1[11,12] B:2[21,22] B:3[30,50]", "B:{4}[5,20] A:{1}[11,12] B:{2,3}[21,50]",
    ),
    "same start, shorter first": (
        "B:4[5,20] B:2[21,22] A:1[21,23] B:3[30,50]", "B:{2,4}[5,22] A:{1}[21,23] B:{3}[30,50]",
    ),
    "same start, longer second": (
        "B:4[5,20] A:1[21,22] B:2[21,23] B:3[30,50]", "B:{4}[5,20] A:{1}[21,22] B:{2,3}[21,50]",
    ),
    "covered by another ip": (
        "A:1[4,51] B:4[5,20] B:2[21,23] B:3[30,50]", "A:{1}[4,51] B:{2,3,4}[5,50]",
    ),
    "same start, longer other": (
        "B:4[5,20] A:1[5,51] B:2[21,23] B:3[30,50]", "B:{4}[5,20] A:{1}[5,51] B:{2,3}[21,50]",
    ),
    "two overlapping ips": ("A:1[2,3] A:2[4,5] B:2[1,5] B:3[3,6]", "A:{1,2}[2,5] B:{2,3}[1,6]"),
    "empty ids removed": (
        "B:-[10,22] A:-[11,12] A:-[31,32] A:1[31,32] A:2[21,22]", "B:{}[10,22] A:{1,2}[11,32]",
    ),
    "rows without a client are kept": (
        "HH1 B:-[10,22] A:-[11,12] A:-[31,32] HH2 A:-[31,32] A:-[21,22]",
        "HH1 B:{}[10,22] A:{}[11,32] HH2 A:{}[21,32]",
    ),
    "several households": (
        "HH1 A:1[11,12] B:2[21,22] A:3[31,32] HH2 A:1[31,32] B:2[21,22] B:3[11,12] "
        "HH3 A:2[11,12] A:3[11,15]",
        "HH1 A:{1}[11,12] B:{2}[21,22] A:{3}[31,32] HH2 A:{1}[31,32] B:{2,3}[11,22] "
        "HH3 A:{2,3}[11,15]",
    ),
    # minutes from (minute, hour, day) = (10, 0, 10), (5, 0, 10), (10, 0, 20) and so on
    "several days": (
        "HH2 A:1[14410,15860] C:2[14405,15855] C:3[14410,15860] C:4[28810,36020]",
        "HH2 C:{2,3}[14405,15860] A:{1}[14410,15860] C:{4}[28810,36020]",
    ),
    "tie with an empty id": (
        "HH1 A:4[11,12] B:5[21,22] A:6[31,32] B:-[31,32]",
        "HH1 A:{4}[11,12] B:{5}[21,32] A:{6}[31,32]",
    ),
    "empty run joins the later one": (
        "A:1[1,2] B:9[3,4] A:-[5,6] B:9[7,8] A:2[9,10]",
        "A:{1}[1,2] A:{2}[5,10] B:{9}[3,4] B:{9}[7,8]",
    ),
    "trailing empty run": ("A:1[1,2] B:9[3,4] A:-[5,6]", "A:{1}[1,6] B:{9}[3,4]"),
    "equal spans are ordered by ip": (
        "A:1[5,6] B:2[5,6] A:3[7,8]", "A:{1}[5,6] B:{2}[5,6] A:{3}[7,8]",
    ),
}


@pytest.mark.parametrize("limits", [PLAIN, SLICED], ids=["plain", "sliced"])
def test_all_cases(spark, limits):
    given, expected = [], []
    for name, (rows, summary) in CASES.items():
        prefix = name.replace(" ", "_") + "/"
        given += parse(rows, prefix)
        expected += parse(summary, prefix)
    result = household_summary(rows_frame(spark, given), limits)
    assert summary_rows(result) == expected_rows(expected)
    assert {r.version for r in result.select("version").distinct().collect()} == {"0.0.1"}


def test_no_rows(spark):
    empty = spark.createDataFrame([], ROW_SCHEMA)
    assert household_summary(empty).collect() == []
    assert household_summary(empty, SLICED).collect() == []


def test_unknown_household_null_client_and_rejects(spark):
    rows = spark.createDataFrame(
        [
            row("0", 10, "1", 1, 2),
            row(None, 10, "1", 1, 2),
            (10, None, (1, 2), "HH1", 0, "0.0.1"),
            row("HH1", 10, "7", 9, 3),
            row("HH1", None, "7", 1, 3),
            (10, [1], None, "HH1", 0, "0.0.1"),
        ],
        ROW_SCHEMA,
    )
    assert summary_rows(household_summary(rows)) == [("HH1", 10, [], 1, 2)]
    assert rejects(rows).count() == 3


def test_client_ids_keep_all_their_numbers(spark):
    rows = spark.createDataFrame(
        [(10, [7, -2, 0, 11], (1, 2), "HH1", 0, "v"), (10, [7, -2], (2, MINUTE), "HH1", 0, "v")],
        ROW_SCHEMA,
    )
    (found,) = household_summary(rows).collect()
    assert found.clientIds == [[7, -2], [7, -2, 0, 11]]
