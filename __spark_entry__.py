"""

Every query reads the whole ``events`` table through one of two views
(``spanfold.sources.events_view``). Client sets are shown as sorted text, spans
as two columns, so that results compare across engines.
"""

from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from spanfold.functions.clients import NO_CLIENT, client_ids, client_token  # noqa: E402
from spanfold.functions.spans import time_span  # noqa: E402
from spanfold.operators.hot import Limits, find_hot  # noqa: E402
from spanfold.operators.islands import session_islands  # noqa: E402
from spanfold.plans import diff, digest, stats, summary, validation  # noqa: E402
from spanfold.plans import job as batch  # noqa: E402
from spanfold.plans.increments import SummaryStore  # noqa: E402
from spanfold.plans.job import JobMetrics  # noqa: E402
from spanfold.sources import catalog, sink  # noqa: E402
from spanfold.sources import rows as source  # noqa: E402
from spanfold.sources.events_view import assignment_input, assignment_input_dense  # noqa: E402
from spanfold.sources.job import JobParameters  # noqa: E402
from spanfold.sources.placed import Placed  # noqa: E402
from spanfold.sources.runs import RunStore  # noqa: E402
from spanfold.sources.scratch import fresh_path, stored  # noqa: E402


def _optional(name: str) -> ModuleType | None:
    """The operators for training data and their pipeline may be left out."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name not in (name, "spanfold.llm"):
            raise
        return None


llm = _optional("spanfold.llm.queries")
corpus_pipeline = _optional("corpus_pipeline")

SMOKE_DIR = "/root/testdata/sf0.001"
WINDOW = ((0, 1), datetime(2024, 1, 5), datetime(2024, 1, 20))
# Below the size of most households and pairs here, so that the sliced operators run.
SLICE_ALL = Limits(hot_rows=20, slice_rows=10)

# One window inside a day, one over midnights.
HOURLY_WINDOWS = {
    "day": (datetime(2024, 1, 5, 6), datetime(2024, 1, 5, 12)),
    "midnight": (datetime(2024, 1, 6, 20), datetime(2024, 1, 8, 5)),
}

Query = Callable[[SparkSession, str], DataFrame]


def _text(ids: Column) -> Column:
    """Client ids as sorted text, the empty id left out."""
    return F.array_join(
        F.transform(F.filter(ids, lambda c: F.size(c) > 0), client_token), ","
    )


def _row_columns(*extra: str) -> list[Column | str]:
    return ["householdId", "ip", client_token(F.col("clientId")).alias("client"), *extra]


def _span() -> list[Column]:
    return [
        F.col("timeSpan.startTimeMs").alias("startMs"), F.col("timeSpan.endTimeMs").alias("endMs")
    ]


def _show_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        *_row_columns(), *_span(), "status", "version", "customer",
        F.col("dt").cast("string").alias("dt"),
    )


def _show_folded(folded: DataFrame, *extra: str) -> DataFrame:
    ids = client_ids(F.col("clients"))
    return folded.select(
        "householdId", "ip", F.col("start").alias("startMs"), F.col("end").alias("endMs"),
        _text(ids).alias("clients"), F.size(ids).alias("nClients"),
        F.array_contains("clients", NO_CLIENT).cast("int").alias("hasEmpty"), *extra,
    )


def _show_summary(df: DataFrame) -> DataFrame:
    return df.select(
        "householdId", "ip", *_span(), _text(F.col("clientIds")).alias("clients"),
        F.size("clientIds").alias("nClients"), "version",
    )


def _without_some_ips(rows: DataFrame) -> DataFrame:
    """A second copy of the rows that differs: some households lose an ip."""
    return rows.where(~((F.col("ip") == 2) & F.col("householdId").endswith("5")))


# -- scans, sources, sinks ---------------------------------------------------


def q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source.known_households(assignment_input(spark, sf_dir))
    return _show_rows(source.conform(rows, extra=("customer", "dt")))


def q01_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in directories of their own; the files of one have a column more."""
    base = fresh_path(spark, "customers")
    rows = assignment_input(spark, sf_dir).drop("eventId")
    for customer in (0, 1):
        part = rows.where(F.col("customer") == customer).drop("customer")
        if customer:
            part = part.withColumn("origin", F.lit("late"))
        part.write.parquet(f"{base}/customer={customer}")
    found = source.read_paths(spark, base, [f"{base}/customer={c}" for c in (0, 1)])
    return source.conform(found, extra=("customer", "dt", "origin")).select(
        *_row_columns(), *_span(), "status", "version", "customer",
        F.col("dt").cast("string").alias("dt"), "origin",
    )


def q02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source.known_households(assignment_input(spark, sf_dir))
    return _show_rows(rows.where(source.in_window(*WINDOW)))


def q02_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "assignments")
    rows = assignment_input(spark, sf_dir).drop("eventId")
    rows.hint("rebalance", "customer", "dt").write.partitionBy("customer", "dt").parquet(path)
    return _show_rows(source.read_window(spark, path, *WINDOW))


def q02_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions that a catalog table knows."""
    path, table = fresh_path(spark, "assignments"), f"assignments_{uuid.uuid4().hex}"
    _write_layout(assignment_input(spark, sf_dir), path, "customer", "dt")
    catalog.create(spark, table, path)
    catalog.register(spark, table, catalog.partitions_of(spark, path, (0, 1)))
    return _show_rows(catalog.read_window(spark, table, *WINDOW))


def q03(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source.known_households(assignment_input(spark, sf_dir))
    slices = [rows.where(F.col("customer") == c) for c in (0, 1)]
    slices[1] = slices[1].select(*sorted(slices[1].columns))
    return _show_rows(source.union_customers(slices))


def q04(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "summary")
    sink.write_summary(summary.household_summary(assignment_input(spark, sf_dir)), path)
    return _show_summary(sink.read_summary(spark, path))


def _job(grain: str, window: tuple[datetime, datetime], base: str) -> JobParameters:
    return JobParameters(
        (0, 1), *window, grain_from=grain, base_dir=f"{base}/out/", input_dir=f"{base}/in/"
    )


def _write_layout(rows: DataFrame, path: str, *by: str) -> None:
    rows.drop("eventId").hint("rebalance", *by).write.partitionBy(*by).parquet(path)


def q04_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job from its input layout to its output path."""
    base = fresh_path(spark, "job")
    _write_layout(assignment_input(spark, sf_dir), f"{base}/in/Daily", "customer", "dt")
    job = _job("Daily", (datetime(2023, 1, 1), datetime(2026, 1, 1)), base)
    batch.run(spark, job)
    place = job.output_path.removeprefix(job.base_dir)
    return _show_summary(sink.read_summary(spark, job.output_path)).withColumn("place", F.lit(place))


def q25_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fresh_path(spark, "job")
    rows = assignment_input(spark, sf_dir)
    ms = F.col("timeSpan.startTimeMs")
    hour = F.pmod(F.floor(ms / F.lit(3_600_000)), F.lit(24)).cast("int")
    _write_layout(rows.withColumn("hour", hour), f"{base}/in/Hourly", "customer", "dt", "hour")
    found = []
    for name, window in HOURLY_WINDOWS.items():
        job = _job("Hourly", window, base)
        batch.run(spark, job)
        written = _show_summary(sink.read_summary(spark, job.output_path))
        found.append(written.withColumn("window", F.lit(name)))
    return found[0].unionByName(found[1])


def _with_broken_rows(spark: SparkSession, sf_dir: str) -> tuple[JobParameters, JobMetrics | None]:
    """Rows without an ip, without a span, and with one that ends before it starts."""
    base = fresh_path(spark, "job")
    rows = assignment_input(spark, sf_dir)
    event, span = F.col("eventId"), F.col("timeSpan")
    start, end = span["startTimeMs"], span["endTimeMs"]
    broken = rows.withColumns({
        "ip": F.when(event % 11 != 0, F.col("ip")),
        "timeSpan": F.when(event % 13 == 0, time_span(end + 1, start)).when(event % 17 != 0, span),
    })
    _write_layout(broken, f"{base}/in/Daily", "customer", "dt")
    job = _job("Daily", (datetime(2023, 1, 1), datetime(2026, 1, 1)), base)
    return job, batch.run(spark, job)


def q25_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    job, _ = _with_broken_rows(spark, sf_dir)
    return batch.read_rejects(spark, job).select(
        "householdId", "ip", *_span(), "customer", F.col("dt").cast("string").alias("dt")
    )


def q25_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job counted as rows went by, next to what it published."""
    job, counted = _with_broken_rows(spark, sf_dir)
    summary_rows = sink.read_summary(spark, job.output_path).agg(F.count(F.lit(1)).alias("nSummary"))
    return summary_rows.select(
        *[F.lit(n).cast("long").alias(f"n{name.capitalize()}") for name, n in vars(counted).items()], "nSummary"
    )


# -- the roll-up ---------------------------------------------------------------


def _folded(
    steps: Callable[..., DataFrame], *extra: str, view=assignment_input, **options
) -> Query:
    return lambda spark, sf_dir: _show_folded(steps(view(spark, sf_dir), **options), *extra)


def _summary(view=assignment_input, **options) -> Query:
    return lambda spark, sf_dir: _show_summary(
        summary.household_summary(view(spark, sf_dir), **options)
    )


def q05_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_folded(session_islands(source.spans(assignment_input(spark, sf_dir))))


def _merge(limits: Limits) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = assignment_input(spark, sf_dir)
        hot = find_hot(source.spans(rows), limits)
        old, new = (
            summary.household_islands(rows.where(F.col("customer") == c), hot) for c in (0, 1)
        )
        return _show_folded(summary.merge_increment(old, new, hot))

    return run


def q10_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An increment of the rows of few households; the others pass through."""
    rows = assignment_input(spark, sf_dir)
    few = _few()
    old = stored(summary.household_islands(rows.where(~few)), "islands")
    return _show_folded(summary.merge_increment(old, summary.household_islands(rows.where(few))))


def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source.known_households(assignment_input(spark, sf_dir))
    return rows.select(*_row_columns(), F.col("dt").cast("string").alias("dt")).dropDuplicates()


def q12(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.col("timeSpan.endTimeMs") - F.col("timeSpan.startTimeMs")
    summaries = summary.summary_by_grains(assignment_input(spark, sf_dir))
    return summaries.groupBy("grain", F.col("period").cast("string").alias("period")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(length).alias("totalMs"),
        F.sum(F.size("clientIds")).alias("nClients"),
    )


def _summary_increments(limits: Limits, *parts: Callable[[], Column]) -> Query:
    """A stored summary of no rows, and increments one after the other."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = assignment_input(spark, sf_dir)
        store = SummaryStore(spark, fresh_path(spark, "summary-store"), n_buckets=8)
        for part in parts:
            store.add(rows.where(part()), limits)
        return _show_summary(store.summary())

    return run


def _few() -> Column:
    return (F.col("customer") == 1) & F.col("householdId").endswith("3")


# -- validation ------------------------------------------------------------------


def _facts(rows: DataFrame) -> DataFrame:
    """Written once, as the statistics read it more than once."""
    return stored(stats.client_facts(rows), "facts")


def _summary_of(rows: DataFrame) -> DataFrame:
    return summary.household_summary(rows)


def _stored_summary_of(rows: DataFrame) -> DataFrame:
    """For what reads the summary more than once, a written one as in a real job."""
    path = fresh_path(rows.sparkSession, "summary")
    sink.write_summary(summary.household_summary(rows), path)
    return sink.read_summary(rows.sparkSession, path)


def q13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assignment_input(spark, sf_dir)
    return stats.overall_counts(stats.client_facts(rows), _summary_of(rows))


def q14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assignment_input(spark, sf_dir)

    def side(name: str, df: DataFrame) -> DataFrame:
        p = name.lower()
        ids = F.col(f"{p}ClientIds")
        return df.select(
            F.lit(name).alias("side"), "householdId", "ipCount",
            F.col(f"{p}TimeSpanCount").alias("timeSpanCount"), _text(ids).alias("clients"),
            F.exists(ids, lambda c: F.size(c) == 0).cast("int").alias("hasEmpty"),
            F.col(f"{p}RecordCount").alias("recordCount"), "minStartTime", "maxEndTime",
        )

    return side("Input", stats.household_input_stats(rows, _facts(rows))).unionByName(
        side("Output", stats.household_output_stats(_stored_summary_of(rows)))
    )


EXTENT = ("minStartTime", "maxEndTime", "emptyClientIdCount", "householdMinStart", "householdMaxEnd")


def q15(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = F.transform(
        "inputClients", lambda c: F.concat_ws(":", client_token(c["clientId"]), c["n"])
    )
    return stats.household_ip_stats(_facts(assignment_input(spark, sf_dir))).select(
        "householdId", "ip", F.array_join(counted, ",").alias("inputClients"), *EXTENT
    )


def q16(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assignment_input(spark, sf_dir)
    ip_stats = stats.household_ip_stats(_facts(rows))
    joined = validation.output_with_empty_clients(ip_stats, _summary_of(rows))
    return joined.select(
        "householdId", "ip", _text(F.col("clientIds")).alias("clientIds"), *EXTENT
    )


def _show_consistency(checked: DataFrame) -> DataFrame:
    return checked.withColumns({
        "inputClientIds": _text(F.col("inputClientIds")),
        "outputClientIds": _text(F.col("outputClientIds")),
        "sameClientIds": F.col("sameClientIds").cast("int"),
    })


def _show_mismatches(found: DataFrame) -> DataFrame:
    return found.select(
        "householdId",
        *[F.col(c).cast("int").alias(c) for c in ("sameIpCount", "sameBounds", "sameClientIds")],
    )


def _consistency(view) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = view(spark, sf_dir)
        return _show_consistency(
            validation.household_consistency(rows, _facts(rows), _stored_summary_of(rows))
        )

    return run


def _placed_pair(view, limits: Limits, lose: bool = False) -> Callable[..., Placed]:
    """Rows, facts and a summary (of all rows or of some) placed by household."""

    def make(spark: SparkSession, sf_dir: str) -> Placed:
        rows = view(spark, sf_dir)
        out = _stored_summary_of(_without_some_ips(rows) if lose else rows)
        return validation.placed_by_household(rows, out, 8, limits)

    return make


def _placed_consistency(view, limits: Limits = summary.LIMITS) -> Query:
    make = _placed_pair(view, limits)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _show_consistency(validation.placed_consistency(make(spark, sf_dir)))

    return run


def _placed_mismatches(limits: Limits = summary.LIMITS) -> Query:
    make = _placed_pair(assignment_input_dense, limits, lose=True)
    return lambda spark, sf_dir: _show_mismatches(validation.placed_mismatches(make(spark, sf_dir)))


def q17_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assignment_input_dense(spark, sf_dir)
    out = _stored_summary_of(_without_some_ips(rows))
    return _show_mismatches(validation.household_mismatches(_facts(rows), out))


def _interleaving_rows(view) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = view(spark, sf_dir)
        return validation.interleaving_ips(_facts(rows), _summary_of(rows))

    return run


def _interleaving(view) -> Query:
    found = _interleaving_rows(view)
    return lambda spark, sf_dir: found(spark, sf_dir).select("householdId", "ip", *_span())


def q18_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assignment_input_dense(spark, sf_dir)
    known = stats.client_facts(_without_some_ips(rows))
    return validation.unknown_clients(known, _summary_of(rows)).select(*_row_columns())


def q18_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary some rows of which were moved out of their households' extent."""
    rows = assignment_input(spark, sf_dir)
    start, end = F.col("timeSpan.startTimeMs"), F.col("timeSpan.endTimeMs")
    moved = F.when(F.col("ip") == 1, time_span(start - 7_200_000, end)).otherwise(F.col("timeSpan"))
    damaged = _summary_of(rows).withColumn("timeSpan", moved)
    found = validation.spans_outside_household(stats.client_facts(rows), damaged)
    return found.select("householdId", "ip", *_span(), "householdMinStart", "householdMaxEnd")


def q19(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assignment_input_dense(spark, sf_dir)
    sides = stats.client_facts(rows), stats.client_facts(_without_some_ips(rows))
    return validation.client_ip_mismatches(*sides).select(
        client_token(F.col("clientId")).alias("client"),
        "ipCount1", "recordCount1", "ipCount2", "recordCount2",
    )


def q19_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assignment_input_dense(spark, sf_dir)
    copies = rows.withColumn("customer", F.lit(1)).unionByName(
        _without_some_ips(rows).withColumn("customer", F.lit(2))
    )
    return validation.client_ip_spread(stats.client_facts(copies, "customer")).select(
        client_token(F.col("clientId")).alias("client"), "minIpCount", "maxIpCount", "nCustomers"
    )


def q20(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assignment_input(spark, sf_dir)
    report = validation.validate(rows, _stored_summary_of(rows))
    return report.withColumn("ok", F.col("ok").cast("int"))


# -- comparing datasets ------------------------------------------------------------


def _two_customers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = source.known_households(assignment_input(spark, sf_dir))
    return [rows.where(F.col("customer") == c).select(*_row_columns("dt")) for c in (0, 1)]


def _customers_compared(compare: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: compare(*_two_customers(spark, sf_dir)).withColumn(
        "dt", F.col("dt").cast("string")
    )


def _by_digest(compared: Callable[[SparkSession, str], list[DataFrame]]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sides = compared(spark, sf_dir)
        paths = [fresh_path(spark, "digested") for _ in sides]
        for df, path in zip(sides, paths, strict=True):
            digest.write_digested(df, path, n_buckets=16)
        found = digest.diff_stored(spark, *paths, sides[0].schema)
        return found.withColumn("dt", F.col("dt").cast("string"))

    return run


def _all_and_some(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All rows, and those without some ips of two households: most buckets are equal."""
    rows = source.known_households(assignment_input_dense(spark, sf_dir))
    few = (F.col("ip") == 2) & F.col("householdId").isin("5", "15")
    return [r.select(*_row_columns("dt")) for r in (rows, rows.where(~few))]


def q24_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of two summaries, both written in one order."""
    rows = assignment_input_dense(spark, sf_dir)
    columns = ("householdId", "ip", "startMs", "endMs", "clients")
    scans = []
    for r in (rows, _without_some_ips(rows)):
        path = fresh_path(spark, "in-order")
        ordered = _show_summary(_summary_of(r)).select(*columns).orderBy("startMs", "ip", "householdId", "endMs", "clients")
        ordered.write.option("maxRecordsPerFile", 500).parquet(path)
        scans.append(spark.read.parquet(path))
    found = digest.ordered_diff_as_written(*scans, rows_per_chunk=100)
    return _positions_shown(found, columns)


def _two_runs(spark: SparkSession, sf_dir: str) -> list[validation.ValidationRun]:
    rows = assignment_input_dense(spark, sf_dir)
    return [
        validation.ValidationRun.of(r, _stored_summary_of(r))
        for r in (rows, _without_some_ips(rows))
    ]


def q23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.span_statistics(_interleaving_rows(assignment_input)(spark, sf_dir))


def q23_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.span_statistics(_summary_of(assignment_input(spark, sf_dir)))


def _positions_shown(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    def shown(side: str) -> Column:
        fields = F.concat_ws("|", *[F.col(f"{side}.{c}") for c in columns])
        return F.when(F.col(side).isNotNull(), fields).alias(side)

    return found.select("position", shown("expected"), shown("actual"))


def q22_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs from what a run store kept of them."""
    store = RunStore(spark, fresh_path(spark, "runs"))
    for name, run in zip(("all", "some"), _two_runs(spark, sf_dir), strict=True):
        store.save(name, run)
    return diff.compare_exact(store.load("all"), store.load("some"))


def _ordered(compare: Callable[..., DataFrame]) -> Query:
    columns = ("householdId", "ip", "startMs", "endMs", "clients")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = assignment_input_dense(spark, sf_dir)
        both = [
            _show_summary(_summary_of(r)).select(*columns)
            for r in (rows, _without_some_ips(rows))
        ]

        return _positions_shown(compare(*both, order_by=["startMs", "ip"]), columns)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """The household summary of the smallest data set."""
    return _summary()(spark, SMOKE_DIR)


def oracle_sql() -> dict[str, str]:
    found = dict(oracles.oracle_sql())
    if llm is not None:
        found |= llm.oracle_sql()
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    found = _own_queries()
    if llm is not None:
        found |= llm.queries()
    if corpus_pipeline is not None:
        found["pipeline"] = corpus_pipeline.run
    return found


def _own_queries() -> dict[str, Query]:
    dense = assignment_input_dense
    return {
        "q01_scan_known_households": q01,
        "q01_scan_merged_schema": q01_merged,
        "q02_scan_window": q02,
        "q02_scan_partitioned_layout": q02_partitioned,
        "q02_scan_catalog_partitions": q02_catalog,
        "q03_union_customers": q03,
        "q04_sink_roundtrip": q04,
        "q04_job_output_path": q04_job,
        "q05_islands": _folded(summary.household_islands),
        "q05_islands_session": q05_session,
        "q05_islands_dense": _folded(summary.household_islands, view=dense),
        "q05_islands_sliced": _folded(summary.household_islands, hot=SLICE_ALL),
        "q06_household_timeline": _folded(summary.household_timeline, "position"),
        "q06_household_timeline_sliced": _folded(
            summary.household_timeline, "position", hot=SLICE_ALL
        ),
        "q07_runs": _folded(summary.household_runs, "run"),
        "q07_runs_dense": _folded(summary.household_runs, "run", view=dense),
        "q07_runs_sliced": _folded(summary.household_runs, "run", hot=SLICE_ALL),
        "q08_absorb_empty_runs": _folded(summary.absorbed_runs),
        "q08_absorb_empty_runs_sliced": _folded(summary.absorbed_runs, hot=SLICE_ALL),
        "q09_household_summary": _summary(),
        "q09_household_summary_dense": _summary(view=dense),
        "q09_household_summary_sliced": _summary(hot=SLICE_ALL),
        "q09_household_summary_dense_sliced": _summary(view=dense, hot=SLICE_ALL),
        "q10_merge_increment": _merge(summary.LIMITS),
        "q10_merge_increment_sliced": _merge(SLICE_ALL),
        "q10_merge_increment_of_few": q10_few,
        "q10_merge_summary_increment": _summary_increments(
            summary.LIMITS, lambda: F.col("customer") == 0, lambda: F.col("customer") == 1
        ),
        "q10_merge_summary_increment_sliced": _summary_increments(
            SLICE_ALL, lambda: F.col("customer") == 0, lambda: F.col("customer") == 1
        ),
        "q10_merge_summary_increment_of_few": _summary_increments(
            summary.LIMITS, lambda: ~_few(), _few
        ),
        "q11_distinct_rows": q11,
        "q12_rollup_by_grain": q12,
        "q13_overall_counts": q13,
        "q14_household_stats": q14,
        "q15_household_ip_stats": q15,
        "q16_output_with_empty_clients": q16,
        "q17_household_consistency": _consistency(assignment_input),
        "q17_household_consistency_dense": _consistency(dense),
        "q17_household_mismatches": q17_mismatches,
        "q17_household_consistency_placed": _placed_consistency(assignment_input),
        "q17_household_consistency_placed_hot": _placed_consistency(
            assignment_input, Limits(hot_rows=60)
        ),
        "q17_household_mismatches_placed": _placed_mismatches(),
        "q17_household_mismatches_placed_hot": _placed_mismatches(Limits(hot_rows=215)),
        "q18_interleaving_ips": _interleaving(assignment_input),
        "q18_interleaving_ips_dense": _interleaving(dense),
        "q18_unknown_clients": q18_unknown,
        "q18_spans_outside_household": q18_outside,
        "q19_cross_customer_ip_cardinality": q19,
        "q19_client_ip_spread": q19_spread,
        "q20_validation_report": q20,
        "q21_dataset_diff": _customers_compared(diff.dataset_diff),
        "q21_first_difference": _customers_compared(diff.first_difference),
        "q21_multiset_difference": _customers_compared(diff.multiset_difference),
        "q21_diff_by_digest": _by_digest(_two_customers),
        "q21_diff_by_digest_of_few": _by_digest(_all_and_some),
        "q22_compare_stored_runs": q22_stored,
        "q22_compare_runs": lambda s, d: diff.compare_exact(*_two_runs(s, d)),
        "q22_compare_statistics": lambda s, d: diff.compare_statistics(*_two_runs(s, d)),
        "q23_describe_spans": q23,
        "q23_describe_summary": q23_summary,
        "q24_ordered_diff": _ordered(diff.ordered_diff),
        "q24_first_ordered_difference": _ordered(diff.first_ordered_difference),
        "q24_ordered_diff_as_written": q24_as_written,
        "q25_job_hourly_window": q25_hourly,
        "q25_job_rejects": q25_rejects,
        "q25_job_metrics": q25_metrics,
    }
