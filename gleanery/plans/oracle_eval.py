"""The same results in ANSI SQL, for the queries of :mod:`catalog_eval`."""

from __future__ import annotations

from gleanery.plans.oracle_text import MARKDOWN_PAGES, windows, words

ROLLUP = """r AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, count(*)::BIGINT AS requests, avg(value) AS mean_latency_s,
         avg(length(props)) AS mean_answer_length,
         avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS refusal_rate,
         quantile_cont(value, 0.5) AS p50_latency_s, quantile_cont(value, 0.9) AS p90_latency_s
  FROM events GROUP BY 1)"""

SOURCES = """m AS (
  SELECT source, avg(1.0::DOUBLE - toxic) AS g, avg(quality) AS c,
         quantile_cont(n_chars / 1000.0::DOUBLE, 0.5) AS p50, quantile_cont(n_chars / 1000.0::DOUBLE, 0.9) AS p90
  FROM labels JOIN documents USING (doc_id) GROUP BY 1)"""


def _share(part: str, whole: str) -> str:
    return (f"CASE WHEN len({part}) = 0 THEN 0.0::DOUBLE "
            f"ELSE len(list_intersect({part}, {whole}))::DOUBLE / len({part}) END")


ORACLES = {
    "latency_stats": """SELECT round(quantile_cont(value, 0.5), 6) AS p50_seconds,
       round(quantile_cont(value, 0.9), 6) AS p90_seconds, round(avg(value), 6) AS mean_seconds FROM events""",
    "latency_stats_ranked": """SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50_seconds,
       round(quantile_cont(value, 0.9), 6) AS p90_seconds FROM events GROUP BY 1""",
    "daily_monitor": f"""WITH {ROLLUP}
SELECT day, requests, round(mean_latency_s, 6) AS mean_latency_s,
       round(mean_answer_length, 6) AS mean_answer_length, round(refusal_rate, 6) AS refusal_rate,
       round(p50_latency_s, 6) AS p50_latency_s, round(p90_latency_s, 6) AS p90_latency_s FROM r""",
    "daily_drift": f"""WITH {ROLLUP}, b AS (
  SELECT *, lag(mean_latency_s) OVER (ORDER BY day) AS l, lag(refusal_rate) OVER (ORDER BY day) AS f FROM r)
SELECT day, round(mean_latency_s - l, 6) AS mean_latency_s_change,
       round(mean_latency_s / nullif(l, 0), 6) AS mean_latency_s_ratio,
       round(refusal_rate - f, 6) AS refusal_rate_change,
       round(refusal_rate / nullif(f, 0), 6) AS refusal_rate_ratio FROM b""",
    "newest_log_rows": "SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 5",
    "judge_means": """SELECT round(avg(quality), 6) AS correctness_mean,
       round(avg(1.0::DOUBLE - toxic), 6) AS safety_mean FROM labels""",
    "quality_gate": f"""WITH {SOURCES}, f AS (
  SELECT *, list_filter([CASE WHEN g IS NULL OR g < 0.8 THEN 'groundedness_mean < 0.8' END,
                         CASE WHEN c IS NULL OR c < 0.7 THEN 'correctness_mean < 0.7' END,
                         CASE WHEN p90 IS NULL OR p90 > 3.0 THEN 'p90_seconds > 3.0' END],
                        lambda x: x IS NOT NULL) AS bad FROM m)
SELECT source, round(g, 6) AS groundedness_mean, round(c, 6) AS correctness_mean,
       round(p90, 6) AS p90_seconds, (len(bad) = 0)::BIGINT AS passed,
       array_to_string(bad, '; ') AS failed_checks FROM f""",
    "diagnosis": """WITH m AS (
  SELECT user_id % 40 AS team, avg((event_type <> 'error')::INT) AS c, avg((event_type <> 'view')::INT) AS p, avg((event_type <> 'click')::INT) AS r,
         avg((event_type <> 'purchase')::INT) AS g, avg((event_type <> 'signup')::INT) AS rel,
         quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90
  FROM events GROUP BY 1)
SELECT team, CASE WHEN rel < 0.79 AND c < 0.79 THEN 'retrieval failure'
  WHEN r < 0.79 THEN 'corpus gap or query mismatch'
  WHEN p < 0.79 AND r >= 0.81 THEN 'relevant page buried in noise'
  WHEN p >= 0.81 AND r >= 0.81 AND g < 0.79 THEN 'answer not grounded in context'
  WHEN rel >= 0.81 AND c < 0.79 THEN 'generation failure'
  WHEN rel < 0.79 THEN 'embedding mismatch'
  WHEN p90 > 3.0 * p50 THEN 'slow tail' ELSE 'no finding' END AS diagnosis FROM m""",
    "lexical_judges": f"""WITH t AS (
  SELECT a.conv_id, a.turn, list_distinct({words('a.text')}) AS a,
         list_distinct({words("coalesce(b.text, '')")}) AS b
  FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
  WHERE a.role = 'assistant'),
s AS (SELECT *, {_share('a', 'b')} AS p, {_share('b', 'a')} AS r FROM t)
SELECT conv_id, turn, round(p, 6) AS lexical_groundedness,
       round(CASE WHEN p + r = 0 THEN 0.0::DOUBLE ELSE 2 * p * r / (p + r) END, 6) AS lexical_correctness FROM s""",
    "stream_quantiles": """WITH e AS (SELECT date_trunc('day', ts) AS d, event_type, (SELECT max(ts) FROM events) AS newest FROM events)
SELECT strftime(d, '%Y-%m-%d') AS day, event_type, count(*) AS requests, true AS p50_within, true AS p90_within,
       d + INTERVAL 25 HOUR > any_value(newest) AS is_open
FROM e GROUP BY d, event_type
UNION ALL SELECT 'all', event_type, count(*), true, true, false FROM e GROUP BY event_type""",
    "distribution_drift": """WITH rows AS (SELECT strftime(ts, '%Y-%m-%d') AS day, value FROM events),
b AS (SELECT value AS v FROM rows WHERE day < '2024-01-15' AND value IS NOT NULL),
c AS (SELECT day, CASE WHEN day = '2024-01-20' THEN 2 * value ELSE value END AS v FROM rows WHERE day >= '2024-01-15' AND value IS NOT NULL),
cuts AS (SELECT list_sort(list_distinct(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS cuts FROM b),
bins AS (SELECT unnest(range(len(cuts) + 1)) AS bin FROM cuts),
bb AS (SELECT len(list_filter(cuts, lambda x: x < v)) AS bin, count(*) AS n FROM b, cuts GROUP BY 1),
cb AS (SELECT day, len(list_filter(cuts, lambda x: x < v)) AS bin, count(*) AS n FROM c, cuts GROUP BY 1, 2),
days AS (SELECT day, count(*) AS n FROM c GROUP BY 1),
shares AS (
  SELECT days.day, days.n, (coalesce(cb.n, 0) + 0.5::DOUBLE) / (days.n + 0.5::DOUBLE * (SELECT count(*) FROM bins)) AS s,
         (coalesce(bb.n, 0) + 0.5::DOUBLE) / ((SELECT count(*) FROM b) + 0.5::DOUBLE * (SELECT count(*) FROM bins)) AS e
  FROM days CROSS JOIN bins LEFT JOIN cb ON cb.day = days.day AND cb.bin = bins.bin LEFT JOIN bb ON bb.bin = bins.bin),
psi AS (SELECT day, n, sum((s - e) * ln(s / e)) AS psi FROM shares GROUP BY 1, 2),
points AS (SELECT days.day, v FROM days, (SELECT v FROM b UNION SELECT v FROM c) GROUP BY ALL),
bc AS (SELECT v, count(*) AS n FROM b GROUP BY 1), cc AS (SELECT day, v, count(*) AS n FROM c GROUP BY 1, 2),
steps AS (
  SELECT p.day, sum(coalesce(bc.n, 0)) OVER w / (SELECT count(*) FROM b)::DOUBLE AS fb, sum(coalesce(cc.n, 0)) OVER w / days.n::DOUBLE AS fc
  FROM points p JOIN days USING (day) LEFT JOIN bc ON bc.v = p.v LEFT JOIN cc ON cc.day = p.day AND cc.v = p.v
  WINDOW w AS (PARTITION BY p.day ORDER BY p.v)),
ks AS (SELECT day, max(abs(fb - fc)) AS ks FROM steps GROUP BY 1)
SELECT day, n, round(psi, 6) AS psi, round(ks, 6) AS ks, psi > 0.2 AS shifted FROM psi JOIN ks USING (day)""",
    "stratified_sample": """SELECT event_id, event_type FROM (
  SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY
    -ln((('0x' || substr(md5(event_id::VARCHAR), 1, 13))::BIGINT + 1.0::DOUBLE) / 4503599627370497.0::DOUBLE) / (1.0::DOUBLE + value), event_id) AS place
  FROM events WHERE 1.0 + value > 0)
WHERE place <= CASE WHEN event_type = 'error' THEN 200 ELSE 50 END""",
    "stream_store_buckets": f"""WITH {MARKDOWN_PAGES},
now AS (
  SELECT 'page/' || page_id AS url, CASE WHEN page_id % 3 = 0 THEN 'second' WHEN page_id % 5 = 0 THEN 'again' ELSE 'first' END || ' ' || content AS content
  FROM md WHERE page_id % 7 <> 0),
{windows('now', 'c')}
SELECT chunk_id, url, chunk_index, md5(chunk_text) AS text_md5 FROM c""",
    "stream_corpus_sync": f"""WITH {MARKDOWN_PAGES},
newest AS (
  SELECT p.url, content FROM md JOIN pages p USING (page_id)
  QUALIFY row_number() OVER (PARTITION BY p.url ORDER BY page_id DESC) = 1),
{windows('newest', 'c')}
SELECT chunk_id, url, chunk_index, md5(chunk_text) AS text_md5 FROM c""",
    "stream_log_tail": "SELECT event_id, value FROM events ORDER BY ts DESC, event_id LIMIT 5",
    # A window is written once the newest event is an hour past its end.
    "stream_monitor": """SELECT strftime(day, '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS requests,
       round(avg(value), 6) AS mean_latency_s,
       round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS refusal_rate
FROM (SELECT date_trunc('day', ts) AS day, event_type, value FROM events)
WHERE day + INTERVAL 25 HOUR <= (SELECT max(ts) FROM events)
GROUP BY 1, 2""",
    "stream_redelivered": "SELECT event_id, event_type FROM events",
}
