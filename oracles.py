"""DuckDB SQL for every registered query.

Islands and absorption are written from their definitions (an island opens at a
start that no earlier span reaches; an empty run looks up its target run), not
with the running windows the Spark side uses, so that the two check each other.
"""

from __future__ import annotations

VIEWS = {
    "default": {
        "hh": "user_id::varchar",
        "ip": "CASE WHEN event_id % 60 = 0 THEN 1 WHEN event_id % 60 = 1 THEN 2 ELSE 0 END",
        "client": "(event_id % 7)::int",
    },
    "dense": {
        "hh": "(user_id % 50)::varchar",
        "ip": "(event_id % 3)::int",
        "client": "user_id::int",
    },
}

# Rows of known households; a NULL client is the empty id.
ALL_ROWS = """
all_rows AS (
  SELECT {hh} AS hh, {ip} AS ip,
         CASE WHEN event_type = 'error' THEN NULL ELSE {client} END AS client,
         epoch_us(ts) // 1000 AS s,
         epoch_us(ts) // 1000 + floor(value * 600000)::bigint AS e,
         (event_id % 2)::int AS customer, ts::date AS dt, event_id
  FROM events
  WHERE {hh} <> '0'
)"""

LOST_IP = "NOT (ip = 2 AND hh LIKE '%5')"


def text(ids: str) -> str:
    return f"array_to_string(list_sort(coalesce({ids}, [])), ',')"


def stages(rows: str, p: str = "", period: str | None = None) -> str:
    """CTEs {p}islands, {p}timeline, {p}runs, {p}absorbed over a table ``rows``."""
    k = "hh" if period is None else "hh, period"
    both = "a.hh = b.hh" if period is None else "a.hh = b.hh AND a.period = b.period"
    union = "list_distinct(flatten(list(clients)))"
    return f"""
{p}opens AS (
  SELECT DISTINCT {k}, ip, s FROM {rows} b WHERE NOT EXISTS (
    SELECT 1 FROM {rows} a WHERE {both} AND a.ip = b.ip AND a.s < b.s AND a.e >= b.s)
),
{p}placed AS (
  SELECT b.*, (SELECT max(a.s) FROM {p}opens a WHERE {both} AND a.ip = b.ip AND a.s <= b.s) AS opened
  FROM {rows} b
),
{p}islands AS (
  SELECT {k}, ip, min(s) AS s, max(e) AS e,
         coalesce(list(DISTINCT client) FILTER (WHERE client IS NOT NULL), []) AS clients,
         bool_or(client IS NULL)::int AS has_empty
  FROM {p}placed GROUP BY {k}, ip, opened
),
{p}timeline AS (
  SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY s, e, ip) AS position FROM {p}islands
),
{p}turns AS (
  SELECT *, CASE WHEN lag(ip) OVER (PARTITION BY {k} ORDER BY position) = ip THEN 0 ELSE 1 END AS turn
  FROM {p}timeline
),
{p}numbered AS (
  SELECT *, sum(turn) OVER (PARTITION BY {k} ORDER BY position ROWS UNBOUNDED PRECEDING) AS run
  FROM {p}turns
),
{p}runs AS (
  SELECT {k}, ip, run, min(s) AS s, max(e) AS e, {union} AS clients, max(has_empty) AS has_empty
  FROM {p}numbered GROUP BY {k}, ip, run
),
{p}targets AS (
  SELECT b.*, CASE WHEN len(b.clients) > 0 THEN b.run ELSE coalesce(
      (SELECT min(a.run) FROM {p}runs a
        WHERE {both} AND a.ip = b.ip AND a.run > b.run AND len(a.clients) > 0),
      (SELECT max(a.run) FROM {p}runs a
        WHERE {both} AND a.ip = b.ip AND a.run < b.run AND len(a.clients) > 0),
      0) END AS target
  FROM {p}runs b
),
{p}absorbed AS (
  SELECT {k}, ip, min(s) AS s, max(e) AS e, {union} AS clients, max(has_empty) AS has_empty
  FROM {p}targets GROUP BY {k}, ip, target
)"""


def query(select: str, *ctes: str, view: str = "default") -> str:
    return "WITH " + ",".join([ALL_ROWS.format(**VIEWS[view]), *ctes]) + "\n" + select


ROWS = """SELECT hh AS "householdId", ip, coalesce(client::varchar, '') AS client,
  s AS "startMs", e AS "endMs", 0::tinyint AS status, '0.0.1' AS version, customer, dt::varchar AS dt
FROM all_rows"""

FOLDED = """SELECT hh AS "householdId", ip, s AS "startMs", e AS "endMs",
  {ids} AS clients, len(clients)::int AS "nClients", has_empty AS "hasEmpty"{extra} FROM {table}"""

SUMMARY = """SELECT hh AS "householdId", ip, s AS "startMs", e AS "endMs",
  {ids} AS clients, len(clients)::int AS "nClients", '0.0.1' AS version FROM absorbed"""


def folded(table: str, extra: str = "", view: str = "default") -> str:
    select = FOLDED.format(ids=text("clients"), table=table, extra=extra)
    return query(select, stages("all_rows"), view=view)


def summary(view: str = "default") -> str:
    return query(SUMMARY.format(ids=text("clients")), stages("all_rows"), view=view)


COUNTS = """
in_counts AS (
  SELECT count(DISTINCT hh) AS hhs, count(DISTINCT ip) AS ips, count(DISTINCT client) AS clients,
         count(*) FILTER (WHERE client IS NULL) AS empties FROM all_rows
),
out_counts AS (
  SELECT count(DISTINCT hh) AS hhs, count(DISTINCT ip) AS ips,
         (SELECT count(DISTINCT c) FROM (SELECT unnest(clients) AS c FROM absorbed)) AS clients,
         0 AS empties FROM absorbed
)"""


def household_stats(rows: str, summary: str, p: str = "") -> str:
    return f"""
{p}hh_in AS (
  SELECT hh, count(DISTINCT ip) AS ips, count(DISTINCT (s, e)) AS spans,
         coalesce(list(DISTINCT client) FILTER (WHERE client IS NOT NULL), []) AS clients,
         bool_or(client IS NULL)::int AS has_empty,
         count(*) AS n, min(s) AS lo, max(e) AS hi FROM {rows} GROUP BY hh
),
{p}hh_out AS (
  SELECT hh, count(DISTINCT ip) AS ips, count(DISTINCT (s, e)) AS spans,
         list_distinct(flatten(list(clients))) AS clients, 0 AS has_empty,
         count(*) AS n, min(s) AS lo, max(e) AS hi FROM {summary} GROUP BY hh
),
{p}hh_both AS (
  SELECT i.hh, o.n / (SELECT count(*) FROM {p}hh_out)::double * i.ips AS score, i.ips, i.lo, i.hi,
         i.spans AS in_spans, o.spans AS out_spans,
         {text('i.clients')} AS in_clients, {text('o.clients')} AS out_clients,
         i.n AS in_n, o.n AS out_n
  FROM {p}hh_in i JOIN {p}hh_out o ON i.hh = o.hh AND i.ips = o.ips AND i.lo = o.lo AND i.hi = o.hi
)"""


def ip_stats(rows: str, p: str = "") -> str:
    return f"""
{p}ip_stats AS (
  SELECT *, min(lo) OVER (PARTITION BY hh) AS hh_lo, max(hi) OVER (PARTITION BY hh) AS hh_hi
  FROM (SELECT hh, ip, min(s) AS lo, max(e) AS hi, count(*) FILTER (WHERE client IS NULL) AS empties,
               (SELECT string_agg(c || ':' || n, ',' ORDER BY c) FROM (
                  SELECT coalesce(x.client::varchar, '') AS c, count(*) AS n FROM {rows} x
                  WHERE x.hh = r.hh AND x.ip = r.ip GROUP BY x.client)) AS clients
        FROM {rows} r GROUP BY hh, ip)
)"""


def interleaving(rows: str, summary: str, p: str = "") -> str:
    return f"""
{p}interleaving AS (
  SELECT o.hh, o.ip, o.s, o.e FROM {summary} o
  JOIN (SELECT hh, ip, min(s) AS lo, max(e) AS hi FROM {rows} GROUP BY hh, ip) x
    ON x.hh = o.hh AND x.ip = o.ip
  WHERE NOT (o.s <= x.lo AND x.hi <= o.e)
)"""


MISMATCHES = """
mismatches AS (
  SELECT coalesce(i.hh, o.hh) AS hh,
         i.ips IS NOT DISTINCT FROM o.ips AS ips_ok,
         i.lo IS NOT DISTINCT FROM o.lo AND i.hi IS NOT DISTINCT FROM o.hi AS bounds_ok,
         coalesce(list_sort(i.clients) = list_sort(o.clients), false) AS clients_ok
  FROM hh_in i FULL JOIN hh_out o ON i.hh = o.hh
)"""

LOST = f"lost AS (SELECT * FROM all_rows WHERE {LOST_IP})"

SUMMARY_ROW = (
    "hh || '|' || ip || '|' || s || '|' || e || '|' || " + text("clients")
)


def diff(name: str, left: str, right: str, columns: str) -> str:
    """CTE {name}: rows of two tables with their number of copies on each side."""
    return f"""
{name} AS (
  SELECT {columns}, sum(x)::bigint AS n_expected, sum(y)::bigint AS n_actual FROM (
    SELECT {columns}, 1 AS x, 0 AS y FROM {left} UNION ALL
    SELECT {columns}, 0 AS x, 1 AS y FROM {right})
  GROUP BY {columns}
)"""


def comparison(names: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{label}' AS "table", coalesce(sum(n_expected), 0)::bigint AS "nExpected",
  coalesce(sum(n_actual), 0)::bigint AS "nActual",
  count(*) FILTER (WHERE n_expected <> n_actual) AS "nMismatched" FROM {cte}"""
        for label, cte in names
    )


def statistics(table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{field}' AS field, count({c}) AS "count", sum({c})::double / count({c}) AS mean,
  min({c}) AS "min", max({c}) AS "max" FROM {table}"""
        for field, c in (("startTimeMs", "s"), ("endTimeMs", "e"))
    )


def oracle_sql() -> dict[str, str]:
    all_stages = stages("all_rows")
    sql: dict[str, str] = {}

    sql["q01_scan_known_households"] = query(ROWS)
    sql["q01_scan_merged_schema"] = query(
        ROWS.replace("\nFROM", ", CASE WHEN customer = 1 THEN 'late' END AS origin\nFROM")
    )
    in_window = " WHERE customer IN (0, 1) AND dt >= DATE '2024-01-05' AND dt < DATE '2024-01-20'"
    sql["q02_scan_window"] = query(ROWS + in_window)
    for name in ("q02_scan_partitioned_layout", "q02_scan_catalog_partitions"):
        sql[name] = sql["q02_scan_window"]
    sql["q03_union_customers"] = query(ROWS)

    for name in (
        "q04_sink_roundtrip", "q09_household_summary", "q09_household_summary_sliced",
        "q10_merge_summary_increment", "q10_merge_summary_increment_sliced",
        "q10_merge_summary_increment_of_few",
    ):
        sql[name] = summary()
    place = (
        "assignmentSummary/HouseholdByIpClientSummary/cust=0_1/tailored/"
        "y=2023/dt=d2023_01_01_00_00_to_2026_01_01_00_00"
    )
    sql["q04_job_output_path"] = query(
        SUMMARY.format(ids=text("clients")).replace(" FROM absorbed", f", '{place}' AS place FROM absorbed"),
        stages("all_rows"),
    )
    sql["q09_household_summary_dense"] = summary("dense")
    sql["q09_household_summary_dense_sliced"] = summary("dense")

    for name in (
        "q05_islands", "q05_islands_session", "q05_islands_sliced", "q10_merge_increment",
        "q10_merge_increment_sliced", "q10_merge_increment_of_few",
    ):
        sql[name] = folded("islands")
    sql["q05_islands_dense"] = folded("islands", view="dense")
    for name in ("q06_household_timeline", "q06_household_timeline_sliced"):
        sql[name] = folded("timeline", ", position")
    for name in ("q07_runs", "q07_runs_sliced"):
        sql[name] = folded("runs", ", run::bigint AS run")
    sql["q07_runs_dense"] = folded("runs", ", run::bigint AS run", view="dense")
    for name in ("q08_absorb_empty_runs", "q08_absorb_empty_runs_sliced"):
        sql[name] = folded("absorbed")

    sql["q11_distinct_rows"] = query(
        "SELECT DISTINCT hh AS \"householdId\", ip, coalesce(client::varchar, '') AS client, "
        "dt::varchar AS dt FROM all_rows"
    )

    per_period = []
    for grain, unit in (("Daily", "day"), ("Monthly", "month")):
        per_period.append(
            f"{unit}_rows AS (SELECT *, date_trunc('{unit}', dt)::date AS period FROM all_rows)"
        )
        per_period.append(stages(f"{unit}_rows", f"{unit}_", period=unit))
    sql["q12_rollup_by_grain"] = query(
        " UNION ALL ".join(
            f"""SELECT '{grain}' AS grain, period::varchar AS period, count(*) AS n_rows,
  sum(e - s)::bigint AS "totalMs", sum(len(clients))::bigint AS "nClients"
FROM {unit}_absorbed GROUP BY period"""
            for grain, unit in (("Daily", "day"), ("Monthly", "month"))
        ),
        *per_period,
    )

    sql["q13_overall_counts"] = query(
        """SELECT 'Input' AS side, hhs AS "nHHs", ips AS "nIps", clients AS "nClients",
  empties AS "nEmptyRows" FROM in_counts
UNION ALL SELECT 'Output', hhs, ips, clients, empties FROM out_counts""",
        all_stages, COUNTS,
    )

    hh = household_stats("all_rows", "absorbed")
    sql["q14_household_stats"] = query(
        " UNION ALL ".join(
            f"""SELECT '{side}' AS side, hh AS "householdId", ips AS "ipCount",
  spans AS "timeSpanCount", {text('clients')} AS clients, has_empty AS "hasEmpty",
  n AS "recordCount", lo AS "minStartTime", hi AS "maxEndTime" FROM {table}"""
            for side, table in (("Input", "hh_in"), ("Output", "hh_out"))
        ),
        all_stages, hh,
    )

    sql["q15_household_ip_stats"] = query(
        """SELECT hh AS "householdId", ip, clients AS "inputClients", lo AS "minStartTime",
  hi AS "maxEndTime", empties AS "emptyClientIdCount", hh_lo AS "householdMinStart",
  hh_hi AS "householdMaxEnd" FROM ip_stats""",
        ip_stats("all_rows"),
    )

    sql["q16_output_with_empty_clients"] = query(
        f"""SELECT o.hh AS "householdId", o.ip, {text('o.clients')} AS "clientIds",
  x.lo AS "minStartTime", x.hi AS "maxEndTime", x.empties AS "emptyClientIdCount",
  x.hh_lo AS "householdMinStart", x.hh_hi AS "householdMaxEnd"
FROM absorbed o LEFT JOIN ip_stats x ON x.hh = o.hh AND x.ip = o.ip AND x.empties <> 0""",
        all_stages, ip_stats("all_rows"),
    )

    for suffix, view in (("", "default"), ("_dense", "dense")):
        sql[f"q17_household_consistency{suffix}"] = query(
            """SELECT hh AS "householdId", score AS "householdIdEncoding", ips AS "ipCount",
  lo AS "minStartTime", hi AS "maxEndTime", in_spans AS "inputTimeSpanCount",
  out_spans AS "outputTimeSpanCount", in_clients AS "inputClientIds",
  out_clients AS "outputClientIds", (in_clients = out_clients)::int AS "sameClientIds",
  in_n AS "inputRecordCount", out_n AS "outputRecordCount" FROM hh_both""",
            all_stages, hh, view=view,
        )

    for name in ("q17_household_consistency_placed", "q17_household_consistency_placed_hot"):
        sql[name] = sql["q17_household_consistency"]

    sql["q17_household_mismatches"] = query(
        """SELECT hh AS "householdId", ips_ok::int AS "sameIpCount", bounds_ok::int AS "sameBounds",
  clients_ok::int AS "sameClientIds" FROM mismatches
WHERE NOT (ips_ok AND bounds_ok AND clients_ok)""",
        LOST, stages("lost"), household_stats("all_rows", "absorbed"), MISMATCHES, view="dense",
    )

    for name in ("q17_household_mismatches_placed", "q17_household_mismatches_placed_hot"):
        sql[name] = sql["q17_household_mismatches"]

    for suffix, view in (("", "default"), ("_dense", "dense")):
        sql[f"q18_interleaving_ips{suffix}"] = query(
            'SELECT hh AS "householdId", ip, s AS "startMs", e AS "endMs" FROM interleaving',
            all_stages, interleaving("all_rows", "absorbed"), view=view,
        )
    sql["q18_unknown_clients"] = query(
        """SELECT hh AS "householdId", ip, client::varchar AS client
FROM (SELECT hh, ip, unnest(clients) AS client FROM absorbed) o
WHERE NOT EXISTS (SELECT 1 FROM lost r WHERE r.hh = o.hh AND r.ip = o.ip AND r.client = o.client)""",
        all_stages, LOST, view="dense",
    )

    sql["q18_spans_outside_household"] = query(
        """SELECT hh AS "householdId", ip, s - 7200000 AS "startMs", e AS "endMs",
  lo AS "householdMinStart", hi AS "householdMaxEnd"
FROM absorbed JOIN (SELECT hh, min(s) AS lo, max(e) AS hi FROM all_rows GROUP BY hh) b USING (hh)
WHERE ip = 1 AND s - 7200000 < lo""",
        all_stages,
    )

    per_client = """
per_client{n} AS (
  SELECT client, count(DISTINCT ip) AS ips, count(*) AS n FROM {rows} GROUP BY client
)"""
    sql["q19_cross_customer_ip_cardinality"] = query(
        """SELECT coalesce(a.client::varchar, '') AS client, a.ips AS "ipCount1",
  a.n AS "recordCount1", b.ips AS "ipCount2", b.n AS "recordCount2"
FROM per_client1 a JOIN per_client2 b ON a.client IS NOT DISTINCT FROM b.client
WHERE a.ips <> b.ips""",
        LOST, per_client.format(n=1, rows="all_rows"), per_client.format(n=2, rows="lost"),
        view="dense",
    )
    copies = """
copies AS (
  SELECT hh, ip, client, s, e, 1 AS copy FROM all_rows UNION ALL
  SELECT hh, ip, client, s, e, 2 AS copy FROM lost
)"""
    sql["q19_client_ip_spread"] = query(
        """SELECT coalesce(client::varchar, '') AS client, min(ips) AS "minIpCount",
  max(ips) AS "maxIpCount", count(*) AS "nCustomers"
FROM (SELECT copy, client, count(DISTINCT ip) AS ips FROM copies GROUP BY copy, client)
GROUP BY client HAVING min(ips) <> max(ips)""",
        LOST, copies, view="dense",
    )

    sql["q20_validation_report"] = query(
        """SELECT "check", expected::bigint AS expected, actual::bigint AS actual,
  (expected = actual)::int AS ok FROM (
  SELECT 'output nHHs' AS "check", i.hhs AS expected, o.hhs AS actual FROM in_counts i, out_counts o
  UNION ALL SELECT 'output nIps', i.ips, o.ips FROM in_counts i, out_counts o
  UNION ALL SELECT 'output nClients', i.clients, o.clients FROM in_counts i, out_counts o
  UNION ALL SELECT 'customers nHHs', min(hhs), max(hhs) FROM per_copy
  UNION ALL SELECT 'customers nIps', min(ips), max(ips) FROM per_copy
  UNION ALL SELECT 'customers nClients', min(clients), max(clients) FROM per_copy
  UNION ALL SELECT 'client ip counts', 0, (SELECT count(*) FROM (
    SELECT client FROM (SELECT customer, client, count(DISTINCT ip) AS ips FROM all_rows
      GROUP BY customer, client) GROUP BY client HAVING min(ips) <> max(ips)))
  UNION ALL SELECT 'household mismatches', 0, (SELECT count(*) FROM mismatches
    WHERE NOT (ips_ok AND bounds_ok AND clients_ok))
  UNION ALL SELECT 'unknown clients', 0, (SELECT count(*) FROM (
    SELECT hh, ip, unnest(clients) AS client FROM absorbed) o WHERE NOT EXISTS (
      SELECT 1 FROM all_rows r WHERE r.hh = o.hh AND r.ip = o.ip AND r.client = o.client))
  UNION ALL SELECT 'spans outside household', 0, (SELECT count(*) FROM absorbed o
    LEFT JOIN (SELECT hh, min(s) AS lo, max(e) AS hi FROM all_rows GROUP BY hh) b ON b.hh = o.hh
    WHERE NOT coalesce(b.lo <= o.s AND o.e <= b.hi, false))
)""",
        all_stages, COUNTS, hh, MISMATCHES,
        """per_copy AS (
  SELECT customer, count(DISTINCT hh) AS hhs, count(DISTINCT ip) AS ips,
         count(DISTINCT client) AS clients FROM all_rows GROUP BY customer
)""",
    )

    seen = """
seen{n} AS (
  SELECT hh, ip, coalesce(client::varchar, '') AS client, dt FROM all_rows WHERE customer = {n}
)"""
    customers = (
        seen.format(n=0), seen.format(n=1), diff("d", "seen0", "seen1", "hh, ip, client, dt"),
    )
    keys = 'hh AS "householdId", ip, client, dt::varchar AS dt'
    sql["q21_dataset_diff"] = query(
        f'SELECT {keys}, n_expected AS "nExpected", n_actual AS "nActual" '
        "FROM d WHERE n_expected <> n_actual",
        *customers,
    )
    sql["q21_diff_by_digest"] = sql["q21_dataset_diff"]
    of_all = "hh, ip, coalesce(client::varchar, '') AS client, dt FROM all_rows"
    sql["q21_diff_by_digest_of_few"] = query(
        f'SELECT {keys}, n_expected AS "nExpected", n_actual AS "nActual" '
        "FROM d WHERE n_expected <> n_actual",
        f"every AS (SELECT {of_all})",
        f"fewer AS (SELECT {of_all} WHERE NOT (ip = 2 AND hh IN ('5', '15')))",
        diff("d", "every", "fewer", "hh, ip, client, dt"),
        view="dense",
    )
    sql["q21_first_difference"] = sql["q21_dataset_diff"] + " ORDER BY hh, ip, client, dt LIMIT 1"
    sql["q21_multiset_difference"] = query(
        f"""SELECT 'expected' AS side, {keys} FROM (SELECT * FROM seen0 EXCEPT ALL SELECT * FROM seen1)
UNION ALL SELECT 'actual', {keys} FROM (SELECT * FROM seen1 EXCEPT ALL SELECT * FROM seen0)""",
        *customers,
    )

    two_runs = (
        all_stages, LOST, stages("lost", "l_"),
        household_stats("all_rows", "absorbed"), household_stats("lost", "l_absorbed", "l_"),
        interleaving("all_rows", "absorbed"), interleaving("lost", "l_absorbed", "l_"),
        f"rows_a AS (SELECT {SUMMARY_ROW} AS r FROM absorbed)",
        f"rows_b AS (SELECT {SUMMARY_ROW} AS r FROM l_absorbed)",
        diff("d_summary", "rows_a", "rows_b", "r"),
        diff("d_inter", "interleaving", "l_interleaving", "hh, ip, s, e"),
    )
    hh_all = "hh, score, ips, lo, hi, in_spans, out_spans, in_clients, out_clients, in_n, out_n"
    count_rows = """
{p}count_rows AS (
  SELECT 'Input' AS side, count(DISTINCT hh) AS hhs, count(DISTINCT ip) AS ips,
         count(DISTINCT client) AS clients, count(*) FILTER (WHERE client IS NULL) AS empties
  FROM {rows}
  UNION ALL
  SELECT 'Output', count(DISTINCT hh), count(DISTINCT ip),
         (SELECT count(DISTINCT c) FROM (SELECT unnest(clients) AS c FROM {p}absorbed)), 0
  FROM {p}absorbed
)"""
    statistics_of = [
        ("counts", "d_counts"), ("households", "d_hh_stats"), ("interleaving", "d_inter_stats"),
        ("with empty clients", "d_empty"),
    ]
    compared = (
        *two_runs,
        count_rows.format(p="", rows="all_rows"), count_rows.format(p="l_", rows="lost"),
        diff("d_counts", "count_rows", "l_count_rows", "side, hhs, ips, clients, empties"),
        "hh_a AS (SELECT *, in_clients = out_clients AS same FROM hh_both)",
        "hh_b AS (SELECT *, in_clients = out_clients AS same FROM l_hh_both)",
        diff("d_hh_stats", "hh_a", "hh_b", "score, ips, lo, hi, in_spans, out_spans, same, in_n, out_n"),
        f"stats_a AS ({statistics('interleaving')})",
        f"stats_b AS ({statistics('l_interleaving')})",
        diff("d_inter_stats", "stats_a", "stats_b", 'field, "count", mean, "min", "max"'),
        "empty_a AS (SELECT count(*) AS n FROM absorbed)",
        "empty_b AS (SELECT count(*) AS n FROM l_absorbed)",
        diff("d_empty", "empty_a", "empty_b", "n"),
    )
    sql["q22_compare_statistics"] = query(comparison(statistics_of), *compared, view="dense")
    with_empty = """
{p}empty_rows AS (
  SELECT o.hh, o.ip, {ids} AS ids, x.lo, x.hi, x.empties, x.hh_lo, x.hh_hi, x.clients
  FROM {p}absorbed o LEFT JOIN {p}ip_stats x ON x.hh = o.hh AND x.ip = o.ip AND x.empties <> 0
)"""
    sql["q22_compare_runs"] = query(
        comparison([
            *[(f"statistics of {name}", cte) for name, cte in statistics_of],
            ("households", "d_hh"), ("interleaving", "d_inter"), ("summary", "d_summary"),
            ("with empty clients", "d_empty_rows"),
        ]),
        *compared, diff("d_hh", "hh_both", "l_hh_both", hh_all),
        ip_stats("all_rows"), ip_stats("lost", "l_"),
        with_empty.format(p="", ids=text("o.clients")), with_empty.format(p="l_", ids=text("o.clients")),
        diff(
            "d_empty_rows", "empty_rows", "l_empty_rows",
            "hh, ip, ids, lo, hi, empties, hh_lo, hh_hi, clients",
        ),
        view="dense",
    )

    sql["q23_describe_spans"] = query(
        statistics("interleaving"), all_stages, interleaving("all_rows", "absorbed")
    )
    sql["q23_describe_summary"] = query(statistics("absorbed"), all_stages)

    ordered = """
{p}ordered AS (
  SELECT row_number() OVER (ORDER BY s, ip, hh, e, clients) - 1 AS position,
         hh || '|' || ip || '|' || s || '|' || e || '|' || clients AS r
  FROM (SELECT hh, ip, s, e, {ids} AS clients FROM {p}absorbed)
)"""
    positions = (
        all_stages, LOST, stages("lost", "l_"),
        ordered.format(p="", ids=text("clients")), ordered.format(p="l_", ids=text("clients")),
    )
    ordered_diff = """SELECT coalesce(a.position, b.position) AS position, a.r AS expected, b.r AS actual
FROM ordered a FULL JOIN l_ordered b ON a.position = b.position WHERE a.r IS DISTINCT FROM b.r"""
    sql["q24_ordered_diff"] = query(ordered_diff, *positions, view="dense")
    sql["q24_ordered_diff_as_written"] = sql["q24_ordered_diff"]
    sql["q24_first_ordered_difference"] = query(
        ordered_diff + " ORDER BY 1 LIMIT 1", *positions, view="dense"
    )

    hours = {
        "day": ("2024-01-05 06:00", "2024-01-05 12:00"), "midnight": ("2024-01-06 20:00", "2024-01-08 05:00"),
    }
    sql["q25_job_hourly_window"] = query(
        " UNION ALL ".join(
            SUMMARY.format(ids=text("clients")).replace(
                " FROM absorbed", f", '{w}' AS \"window\" FROM {w}_absorbed"
            )
            for w in hours
        ),
        *[
            f"{w}_rows AS (SELECT * FROM all_rows WHERE s >= epoch_ms(TIMESTAMP '{a}') "
            f"AND s < epoch_ms(TIMESTAMP '{b}'))"
            for w, (a, b) in hours.items()
        ],
        *[stages(f"{w}_rows", f"{w}_") for w in hours],
    )
    sql["q25_job_rejects"] = """
SELECT user_id::varchar AS "householdId", CASE WHEN event_id % 11 <> 0 THEN ip END AS ip,
       CASE WHEN event_id % 13 = 0 THEN e + 1 WHEN event_id % 17 <> 0 THEN s END AS "startMs",
       CASE WHEN event_id % 13 = 0 THEN s WHEN event_id % 17 <> 0 THEN e END AS "endMs",
       (event_id % 2)::int AS customer, ts::date::varchar AS dt
FROM (SELECT *, CASE WHEN event_id % 60 = 0 THEN 1 WHEN event_id % 60 = 1 THEN 2 ELSE 0 END AS ip,
             epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + floor(value * 600000)::bigint AS e FROM events)
WHERE user_id <> 0 AND (event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0)"""
    sql["q25_job_metrics"] = query(
        """SELECT (SELECT count(*) FROM all_rows) AS "nRead", (SELECT count(*) FROM kept_rows) AS "nUsable",
  (SELECT count(*) FROM all_rows) - (SELECT count(*) FROM kept_rows) AS "nRejected",
  (SELECT count(*) FROM kept_absorbed) AS "nWritten", (SELECT count(*) FROM kept_absorbed) AS "nSummary" """,
        "kept_rows AS (SELECT * FROM all_rows WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 "
        "AND event_id % 17 <> 0)",
        stages("kept_rows", "kept_"),
    )
    sql["q22_compare_stored_runs"] = sql["q22_compare_runs"]
    return sql
