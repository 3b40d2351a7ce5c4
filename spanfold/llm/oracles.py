"""DuckDB SQL for the registered operators."""

from __future__ import annotations

from spanfold.llm import secret_scan


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op3() -> str:
    """Matches and the gaps between them give positions."""
    parts = []
    for order, rule in enumerate(secret_scan.RULES):
        value = (
            "regexp_extract(m, '^[^:=]*[:=] *[\"'']?(.*)$', 1, 's')" if rule.value_only else "m"
        )
        parts.append(
            f"SELECT doc_id, {order} AS o, '{rule.kind}' AS kind, {rule.least} AS least, t, "
            f"regexp_extract_all(t, {_literal(rule.pattern)}) AS ms, "
            f"regexp_split_to_array(t, {_literal(rule.pattern)}) AS gaps, "
            f"list_transform(regexp_extract_all(t, {_literal(rule.pattern)}), lambda m: length({value})) AS sizes "
            "FROM texts"
        )
    base = ", ".join(f"'{k}'" for k in secret_scan.BASE)
    counts = ", ".join(
        f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in secret_scan.BASE
    )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
numbered AS (SELECT *, unnest(generate_series(1, len(ms))) AS i FROM found),
spans AS (
  SELECT doc_id, o, kind, length(ms[i]) AS size,
         list_sum(list_transform(gaps[1:i], lambda g: length(g)))
         + coalesce(list_sum(list_transform(ms[1:i - 1], lambda m: length(m))), 0) AS start
  FROM numbered WHERE sizes[i] >= least
),
shown AS (
  SELECT doc_id, o, kind, CAST(start AS BIGINT) AS start,
         kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT) AS s FROM spans
),
per_doc AS (
  SELECT doc_id, {counts}, string_agg(s, ',' ORDER BY start, o) FILTER (WHERE kind IN ({base})) AS base,
         string_agg(s, ',' ORDER BY start, o) AS spans
  FROM shown GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secret_scan.BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per_doc USING (doc_id)
"""


OP8 = r"""
WITH sized AS (
  SELECT doc_id, source,  
         CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS tie
  FROM documents
), per_source AS (
  SELECT k, min(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY k
), weighted AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w
  FROM per_source
), levels AS (
  SELECT *, (source_size * 3) / CAST(w AS DOUBLE) AS ratio,
         CAST(sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER filled, 0) AS DOUBLE)
         / CAST(sum(w) OVER () - coalesce(sum(w) OVER filled, 0) AS DOUBLE) AS level
  FROM weighted
  WINDOW filled AS (ORDER BY (source_size * 3) / CAST(w AS DOUBLE), source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT k, source_size,
         least((SELECT arg_min(level, ratio) FROM levels WHERE ratio >= level) * w,
               CAST(source_size * 3 AS DOUBLE)) AS target
  FROM levels
), units AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN CAST(floor(target / source_size * 16777216) AS BIGINT) ELSE 0 END AS units,
         CAST('0x' || substr(md5('mix' || k), 1, 6) AS BIGINT) AS start
  FROM goals
), summed AS (
  SELECT doc_id, size, source_size, target, units,
         start + CAST(sum(units) OVER (PARTITION BY k ORDER BY size, tie, doc_id
                                       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS reach
  FROM sized JOIN units USING (k)
)
SELECT doc_id, size, source_size, target, ((reach >> 24) - ((reach - units) >> 24)) * size AS taken
FROM summed
"""


OP9 = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
unit AS (SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS size FROM sound),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.v) = len(b.v) AND list_inner_product(a.v, b.v) / a.size / b.size >= 0.98
),
reach AS (
  SELECT vec_id AS u, vec_id AS w FROM embeddings
  UNION SELECT reach.u, link.w FROM reach JOIN link ON reach.w = link.u
),
least AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
links AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.u LEFT JOIN links ON vec_id = links.u
"""


OP11 = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), sized AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY t) < doc_id AS again
  FROM texts
), judged AS (
  SELECT part, doc_id, [
    len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
    100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(again, false)] AS fails
  FROM sized
), marked AS (
  SELECT part, fails, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = j.doc_id AND quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = j.doc_id AND toxic = 1) AS toxic
  FROM judged j
), combined AS (
  SELECT part, fails, good, toxic, count(*) AS n FROM marked GROUP BY ALL
), orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(f) WHERE NOT contains(o, f)
), steps AS (
  SELECT o AS filter_order, step, list_transform(generate_series(1, step), lambda i: ascii(o[i]) - 64) AS filters
  FROM orders, generate_series(1, 5) AS g(step) WHERE length(o) = 5
), seen AS (
  SELECT part, filter_order, step, filters[step] AS f, n, good, toxic, fails[filters[step]] AS bad,
         list_bool_or(list_transform(filters[1:step - 1], lambda i: fails[i])) AS gone,
         len(list_filter(fails, lambda x: x)) AS n_fails
  FROM combined, steps
), counted AS (
  SELECT part, filter_order, step, f,
         CAST(coalesce(sum(n) FILTER (WHERE NOT bad AND NOT coalesce(gone, false)), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (WHERE bad AND NOT coalesce(gone, false)), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (WHERE bad AND gone), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (WHERE bad AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (WHERE bad AND good AND NOT coalesce(gone, false)), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n) FILTER (WHERE bad AND toxic AND NOT coalesce(gone, false)), 0) AS BIGINT) AS toxic_lost
  FROM seen GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost,
       toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


OP12 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (SELECT digest, min(page_id) AS least FROM payloads WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN least <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN least <> page_id THEN least END AS refers_to
FROM payloads LEFT JOIN firsts USING (digest)
"""


OP13 = r"""
WITH doc_words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), sizes AS (SELECT doc_id, count(*) AS n FROM doc_words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM doc_words SEMI JOIN item_terms USING (term) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf
         + 8 * (100 - 90 + ((90 * n * docs) // words))))) AS BIGINT) AS score
  FROM item_terms JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_secrets": op3(), "op8_mixing": OP8, "op9_embeddings": OP9, "op11_filter_audit": OP11,
        "op12_warc": OP12, "op13_lexical_search": OP13,
    }
