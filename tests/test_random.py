"""Window and sliced forms against a plain sequential reading of the rules."""

import random

import pytest
from notation import PARTLY, PLAIN, SLICED, row, summary_rows, fixed_slicer
from pyspark.sql import functions as F

from spanfold.operators import islands
from spanfold.operators.islands import session_islands
from spanfold.plans.summary import absorbed_runs, household_islands, household_runs, household_summary
from spanfold.sources.rows import ROW_SCHEMA, spans


def make_rows(seed, n=400, households=3, horizon=3_000_000):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = rng.randrange(0, horizon, 500)
        length = rng.choice([0, 0, 500, 1_000, 30_000, 200_000])
        client = "-" if rng.random() < 0.4 else str(rng.randrange(6))
        rows.append((f"h{rng.randrange(households)}", rng.randrange(1, 4), client, start, start + length))
    return rows


def fold_islands(rows):
    found = {}
    for hh, ip, client, start, end in sorted(rows, key=lambda r: (r[3], r[4])):
        of_ip = found.setdefault((hh, ip), [])
        if of_ip and start <= of_ip[-1][1]:
            last = of_ip[-1]
            last[1] = max(last[1], end)
            last[2].add(client)
        else:
            of_ip.append([start, end, {client}])
    return found


def join(left, right):
    return [min(left[0], right[0]), max(left[1], right[1]), left[2] | right[2]]


def fold_runs(rows):
    """{(household, ip): runs in time order}"""
    timelines = {}
    for (hh, ip), of_ip in fold_islands(rows).items():
        timelines.setdefault(hh, []).extend((s, e, ip, c) for s, e, c in of_ip)
    found = {}
    for hh, line in timelines.items():
        last_ip = None
        for s, e, ip, c in sorted(line, key=lambda i: i[:3]):
            of_ip = found.setdefault((hh, ip), [])
            if ip == last_ip:
                of_ip[-1] = join(of_ip[-1], [s, e, c])
            else:
                of_ip.append([s, e, set(c)])
            last_ip = ip
    return found


def fold_summary(rows):
    found = []
    for (hh, ip), of_ip in fold_runs(rows).items():
        merged, waiting = [], None
        for run in of_ip:
            named = run[2] != {"-"}
            if waiting is not None:
                run, waiting = join(waiting, run), None
            if named:
                merged.append(run)
            else:
                waiting = run
        if waiting is not None:
            if merged:
                merged[-1] = join(merged[-1], waiting)
            else:
                merged.append(waiting)
        found += [(hh, ip, sorted(c - {"-"}), s, e) for s, e, c in merged]
    return sorted(found)


@pytest.fixture(scope="module")
def data():
    """Several random sets, told apart by household."""
    found = []
    for seed in range(6):
        horizon = [300_000, 3_000_000, 30_000_000][seed % 3]
        found += [(f"{seed}/{r[0]}", *r[1:]) for r in make_rows(seed, horizon=horizon)]
    return found


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame([row(*r) for r in data], ROW_SCHEMA).repartition(7).cache()


def island_rows(df):
    return sorted(
        (r.householdId, r.ip, r.start, r.end, sorted(c or "-" for c in r.clients)) for r in df.collect()
    )


@pytest.fixture(scope="module")
def expected_islands(data):
    return sorted(
        (hh, ip, s, e, sorted(c)) for (hh, ip), of_ip in fold_islands(data).items() for s, e, c in of_ip
    )


@pytest.mark.parametrize("limits", [PLAIN, PARTLY, SLICED])
def test_islands(frame, expected_islands, limits):
    assert island_rows(household_islands(frame, limits)) == expected_islands


def test_session_islands(frame, expected_islands):
    assert island_rows(session_islands(spans(frame))) == expected_islands


def test_coalescing_twice_changes_nothing(frame, expected_islands):
    once = household_islands(frame)
    assert island_rows(islands.islands(once)) == expected_islands
    assert island_rows(islands.islands_sliced(once, fixed_slicer(60_000))) == expected_islands


@pytest.mark.parametrize("slice_ms", [500, 7_000, 10**9])
def test_any_slice_width(frame, expected_islands, slice_ms):
    result = islands.islands_sliced(spans(frame), fixed_slicer(slice_ms))
    assert island_rows(result) == expected_islands


@pytest.mark.parametrize("limits", [PLAIN, SLICED])
def test_runs(frame, data, limits):
    expected = sorted(
        (hh, ip, s, e, sorted(c)) for (hh, ip), of_ip in fold_runs(data).items() for s, e, c in of_ip
    )
    assert island_rows(household_runs(frame, limits)) == expected


@pytest.mark.parametrize("limits", [PLAIN, PARTLY, SLICED])
def test_summary(frame, data, limits):
    assert summary_rows(household_summary(frame, limits)) == fold_summary(data)


def test_summary_keeps_clients_and_stays_inside_the_household(frame):
    rows = frame.groupBy("householdId", "ip").agg(
        F.array_sort(F.collect_set(F.when(F.size("clientId") > 0, F.col("clientId")))).alias("ids"),
        F.min("timeSpan.startTimeMs").alias("lo"),
        F.max("timeSpan.endTimeMs").alias("hi"),
    )
    out = household_summary(frame).groupBy("householdId", "ip").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("clientIds")))).alias("ids"),
        F.min("timeSpan.startTimeMs").alias("lo"),
        F.max("timeSpan.endTimeMs").alias("hi"),
    )
    assert rows.exceptAll(out).count() == 0 and out.exceptAll(rows).count() == 0


def test_absorbed_rows_name_a_client_or_stand_alone(frame):
    out = absorbed_runs(frame)
    alone = out.groupBy("householdId", "ip").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.forall("clients", lambda c: c == "")).alias("empty"),
    )
    assert alone.where("empty > 0 AND n > 1").count() == 0
