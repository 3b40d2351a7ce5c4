from datetime import UTC, datetime, timedelta, timezone

import pytest
from notation import parse, rows_frame, summary_rows
from pyspark.sql import functions as F

from spanfold.plans.summary import household_summary, summary_by_grain
from spanfold.sources.job import JobParameters
from spanfold.sources.rows import (
    ROW_SCHEMA, conform, in_window, read_paths, read_window, union_customers,
)
from spanfold.sources.scratch import drop_scratch, stored
from spanfold.sources.sink import SUMMARY_SCHEMA, read_summary, write_summary
from spanfold.streaming.islands import stream_islands


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """Two customers over four days; the later days have a column more."""
    base = str(tmp_path_factory.mktemp("layout"))
    rows = rows_frame(spark, parse("HH1 A:1[1,2] B:-[3,4] 0 A:2[5,6]"))
    for customer in (1, 2):
        for day in range(1, 5):
            path = f"{base}/customer={customer}/dt=2024-01-0{day}"
            extra = rows.withColumn("origin", F.lit("x")) if day > 2 else rows
            extra.coalesce(1).write.parquet(path)
    return base


def test_window_reads_only_its_directories(spark, layout):
    found = read_window(spark, layout, [1], datetime(2024, 1, 2), datetime(2024, 1, 4))
    assert found.count() == 4  # two days, the unknown household left out
    assert {(r.customer, str(r.dt)) for r in found.collect()} == {(1, "2024-01-02"), (1, "2024-01-03")}
    scan = plan_of(found)
    assert "PartitionFilters: [" in scan and "customer#" in scan.split("PartitionFilters: [")[1]
    assert "Or" not in scan.split("PushedFilters")[1].split("\n")[0]


def test_unneeded_columns_are_not_read(spark, layout):
    found = read_window(spark, layout, [1, 2], datetime(2024, 1, 1), datetime(2024, 1, 5)).select("householdId")
    assert "ReadSchema: struct<householdId:string>" in plan_of(found)


def test_paths_keep_partition_columns_and_merge_schemas(spark, layout):
    paths = [f"{layout}/customer=2/dt=2024-01-0{d}" for d in (2, 3)]
    found = read_paths(spark, layout, paths)
    assert found.count() == 4
    assert {"customer", "dt", "origin"} <= set(found.columns)
    assert found.where("origin IS NULL").count() == 2


def test_window_is_half_open(spark):
    days = spark.sql("SELECT 1 AS customer, explode(sequence(date'2024-01-01', date'2024-01-05')) AS dt")
    assert days.where(in_window([1], datetime(2024, 1, 2), datetime(2024, 1, 4))).count() == 2
    assert days.where(in_window([2], datetime(2024, 1, 2), datetime(2024, 1, 4))).count() == 0


def test_window_of_hours(spark):
    hours = spark.sql(
        "SELECT 1 AS customer, date(h) AS dt, hour(h) AS hour FROM (SELECT explode("
        "sequence(timestamp_ntz'2024-01-01 00:00', timestamp_ntz'2024-01-03 23:00', interval 1 hour)) AS h)"
    )

    def found(start, end):
        rows = hours.where(in_window([1], start, end, "Hourly")).orderBy("dt", "hour").collect()
        return [(r.dt.day, r.hour) for r in rows]

    assert found(datetime(2024, 1, 1, 6), datetime(2024, 1, 1, 12)) == [(1, h) for h in range(6, 12)]
    crossing = found(datetime(2024, 1, 1, 22), datetime(2024, 1, 3, 2))
    assert crossing == [(1, 22), (1, 23), *[(2, h) for h in range(24)], (3, 0), (3, 1)]
    # an hour that is only touched is read, and no row before the window's first hour
    assert found(datetime(2024, 1, 2, 5, 30), datetime(2024, 1, 2, 6, 1)) == [(2, 5), (2, 6)]


def test_windows_are_in_utc(spark):
    days = spark.sql("SELECT 1 AS customer, explode(sequence(date'2024-01-01', date'2024-01-05')) AS dt")
    east = timezone(timedelta(hours=2))
    start, end = datetime(2024, 1, 3, 1, tzinfo=east), datetime(2024, 1, 3, 2, tzinfo=east)
    found = days.where(in_window([1], start, end)).collect()
    assert [str(r.dt) for r in found] == ["2024-01-02"]
    found = days.where(in_window([1], datetime(2024, 1, 2, 8), datetime(2024, 1, 3, 8))).collect()
    assert [str(r.dt) for r in found] == ["2024-01-02", "2024-01-03"]


def test_union_is_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4, 5)], "y int, x int, z int")
    assert sorted(map(tuple, union_customers([a, b]).collect()), key=str) == [(1, 2, None), (4, 3, 5)]


def test_conform_casts_and_drops(spark):
    loose = spark.createDataFrame(
        [("HH1", 5, [1], (1, 2), 0, "v", "junk")],
        "householdId string, ip long, clientId array<long>, "
        "timeSpan struct<startTimeMs:int,endTimeMs:int>, status int, version string, junk string",
    )
    assert conform(loose).schema == ROW_SCHEMA


def test_sink_round_trip(spark, tmp_path):
    path = str(tmp_path / "summary")
    out = household_summary(rows_frame(spark, parse("HH1 A:1[1,2] B:2[3,4] HH2 A:-[1,9]")))
    write_summary(out, path)
    write_summary(out, path)  # overwrites
    again = read_summary(spark, path)
    assert again.schema == SUMMARY_SCHEMA
    assert summary_rows(again) == summary_rows(out)
    assert [p.name for p in (tmp_path / "summary").iterdir() if p.is_dir()] == ["version=0.0.1"]


def test_rebalanced_write_is_not_partitioned_by_version(spark):
    out = household_summary(rows_frame(spark, parse("A:1[1,2]"))).hint("rebalance")
    assert "REBALANCE_PARTITIONS_BY_NONE" in plan_of(out)


def test_stored_frame_reads_back(spark):
    frame = spark.createDataFrame([(1, ["a"]), (2, [])], "i int, s array<string>")
    assert sorted(map(tuple, stored(frame, "t").collect())) == [(1, ["a"]), (2, [])]


def test_periods_are_folded_apart(spark):
    # the second and third span touch, but start in different days
    rows = rows_frame(spark, parse("A:1[1,2] A:2[1000,1440] A:3[1440,1450]"))
    daily = summary_by_grain(rows, "Daily").orderBy("period").collect()
    assert [(str(r.period), [c[0] for c in r.clientIds]) for r in daily] == [
        ("1970-01-01", [1, 2]), ("1970-01-02", [3]),
    ]
    monthly = summary_by_grain(rows, "Monthly").collect()
    assert [(str(r.period), [c[0] for c in r.clientIds]) for r in monthly] == [("1970-01-01", [1, 2, 3])]


def at(day, year=2020, month=10):
    return datetime(year, month, day, 8, tzinfo=UTC)


def job(**changes):
    given = {"customer_ids": (1960184661, 1234567), "date_from": at(1), "date_to": at(31)}
    return JobParameters(**{**given, **changes})


@pytest.mark.parametrize("grain_from", ["Daily", "Hourly"])
def test_accepted_parameters(grain_from):
    assert job(grain_from=grain_from).job_name == "cust=1960184661_1234567"


@pytest.mark.parametrize(
    ("changes", "message"),
    [
        ({"grain_from": "Daily", "grain_to": "Daily"}, "must differ"),
        ({"grain_from": "Monthly", "grain_to": "Monthly"}, "grain_from"),
        ({"grain_from": "Monthly", "grain_to": "Daily"}, "grain_from"),
        ({"grain_to": "Hourly"}, "grain_to"),
        ({"date_to": at(1, 2018)}, "not after"),
        ({"date_to": at(1)}, "not after"),
        ({"customer_ids": ()}, "no customer ids"),
    ],
)
def test_refused_parameters(changes, message):
    with pytest.raises(ValueError, match=message):
        job(**changes)


@pytest.mark.parametrize(("name", "shown"), [(None, "cust=123"), ("February", "February")])
def test_output_path(name, shown):
    path = job(
        customer_ids=(123,), date_from=at(1, 2019, 1), date_to=at(31, 2020, 1), base_dir="HOME/", name=name,
    ).output_path
    assert path == (
        f"HOME/assignmentSummary/HouseholdByIpClientSummary/{shown}"
        "/tailored/y=2019/dt=d2019_01_01_08_00_to_2020_01_31_08_00"
    )


def test_stream_emits_closed_islands(spark, tmp_path):
    source = str(tmp_path / "in")
    rows_frame(spark, parse("A:1[1,5] A:2[5,9] A:3[20,21] B:1[2,2]")).coalesce(1).write.parquet(source)
    rows_frame(spark, parse("A:4[900,901]")).coalesce(1).write.mode("append").parquet(source)
    rows_frame(spark, parse("A:5[2000,2001]")).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(ROW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        stream_islands(stream, "1 minute")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    minutes = sorted((r.ip, r.start // 60000, r.end // 60000, sorted(r.clients)) for r in found)
    assert minutes[:1] == [(10, 1, 9, ["1", "2"])]
    assert (10, 20, 21, ["3"]) in minutes and (20, 2, 2, ["1"]) in minutes
    assert all(start < 2000 for _, start, _, _ in minutes)


def test_the_owner_of_a_run_drops_its_tables(spark):
    kept = stored(spark.range(3), "numbers")
    assert kept.count() == 3
    path = kept.inputFiles()[0]
    drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()
    assert stored(spark.range(2), "numbers").count() == 2
