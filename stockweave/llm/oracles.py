"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from stockweave.llm.url_filter import CANONICAL, HREF, REFRESH, TAGS, TARGET

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
REST = "CASE WHEN contains({0}, '://') THEN substr({0}, strpos({0}, '://') + 3) END"


def _text(pattern: str) -> str:
    """A pattern as an SQL text."""
    return "'" + pattern.replace("'", "''") + "'"


def _host(url: str) -> str:
    return f"coalesce({LOWERED.format(f"regexp_extract({REST.format(url)}, '^[^/?#]*')")}, '')"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({REST.format(url)}, '^[^/?#]*([^?#]*)', 1), '')"


def _address(url: str) -> str:
    query = rf"coalesce(regexp_extract({REST.format(url)}, '(?s)^[^?#]*(\?[^#]*)', 1), '')"
    return f"concat({_host(url)}, {_path(url)}, {query})"


HREF_VALUE = "concat(" + ", ".join(f"regexp_extract(tag, {_text(HREF)}, {group})" for group in (1, 2, 3)) + ")"

#: Every url of a page or a link with the longest rule that fits it, and the links as edges.
JUDGED = f"""
    rules(verdict, host, path) AS (VALUES
        ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    tags AS (
        SELECT url, unnest(regexp_extract_all(html, {_text(TAGS)})) AS tag FROM pages WHERE url IS NOT NULL),
    targets AS (
        SELECT url, replace(trim(CASE
            WHEN regexp_matches(tag, {_text(CANONICAL)}) THEN {HREF_VALUE}
            WHEN regexp_matches(tag, {_text(REFRESH)}) THEN regexp_extract(tag, {_text(TARGET)}, 1)
            END), '&amp;', '&') AS target
        FROM tags),
    links AS (
        SELECT url, CASE
            WHEN contains(target, '://') THEN target
            WHEN starts_with(target, '//') THEN concat(regexp_extract(url, '(?s)^(.*?:)//', 1), target)
            WHEN starts_with(target, '/') THEN concat(regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1), target)
            WHEN starts_with(target, '?') OR starts_with(target, '#')
                THEN concat(regexp_extract(url, '(?s)^[^?#]*'), target)
            ELSE concat(regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1), '/',
                        regexp_extract(url, '(?s)^.*?://[^/?#]*/([^?#]*/)?', 1), target)
            END AS target
        FROM targets WHERE target <> ''),
    urls AS (SELECT DISTINCT url FROM (
        SELECT url FROM pages UNION ALL SELECT url FROM links UNION ALL SELECT target FROM links)),
    parts AS (
        SELECT url, {_host('url')} AS host, {_path('url')} AS path, {_address('url')} AS address FROM urls),
    judged AS (
        SELECT p.url, any_value(p.host) AS host, any_value(p.path) AS path, any_value(p.address) AS address,
               arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
               arg_max(r.verdict, length(r.host || r.path)) AS own
        FROM parts p LEFT JOIN rules r
          ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        GROUP BY p.url),
    ends AS (SELECT {_address('url')} AS a, {_address('target')} AS b FROM links),
    edges AS (
        SELECT a, b FROM ends WHERE a <> '' AND b <> '' UNION SELECT b, a FROM ends WHERE a <> '' AND b <> ''),
    caught AS (
        SELECT address FROM judged WHERE own = 'block' AND address IN (SELECT a FROM edges)
        UNION SELECT e.b FROM caught c JOIN edges e ON e.a = c.address)
"""

#: Documents by the letters of the filters they fail, and the 120 orders with their steps.
AUDITED = r"""
    docs AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    label AS (
        SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
        FROM labels GROUP BY doc_id),
    failed AS (
        SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic, concat(
            CASE WHEN len(words) < 200 THEN 'A' END,
            CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
            CASE WHEN 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 2 * length(body) THEN 'C' END,
            CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' END,
            CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY body) THEN 'E' END) AS fails
        FROM docs d LEFT JOIN label l ON l.doc_id = d.doc_id),
    grouped AS (
        SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM failed GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    steps AS (
        SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
        FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
    measured AS (
        SELECT part, filter_order, step, letter,
               sum(n) FILTER (contains(fails, letter)) AS failing,
               sum(n) FILTER (fails = letter) AS unique_fails,
               sum(n) FILTER (first_letter = letter) AS removed,
               sum(n) FILTER (first_letter <> '' AND contains(before || letter, first_letter)) AS gone,
               sum(n) AS total,
               sum(good) FILTER (first_letter = letter) AS good_lost,
               sum(toxic) FILTER (first_letter = letter) AS toxic_lost
        FROM (SELECT *, substr(regexp_replace(filter_order, '[^' || fails || '0]', '', 'g'), 1, 1) AS first_letter
              FROM grouped, steps)
        GROUP BY ALL)
"""

ORACLES = {
    "op5_exact_dedup": f"""
        WITH texts AS (SELECT doc_id, {LOWERED.format("coalesce(text, '')")} AS body FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               coalesce(doc_id = max(doc_id) OVER (PARTITION BY body),
                        max(doc_id) OVER (PARTITION BY body) IS NULL) AS kept,
               sha256(body) AS text_sha256
        FROM texts
    """,
    "op6_url_filter": f"""
        WITH RECURSIVE {JUDGED}
        SELECT p.page_id, j.host, j.path, j.rule,
               CASE WHEN j.own IS NOT NULL THEN j.own
                    WHEN j.host <> '' AND j.address IN (SELECT address FROM caught) THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM pages p JOIN judged j ON p.url IS NOT DISTINCT FROM j.url
    """,
    "op11_filter_audit": f"""
        WITH {AUDITED}
        SELECT part, filter_order, step,
               CAST(total - coalesce(gone, 0) AS BIGINT) AS kept,
               CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(failing, 0) - coalesce(removed, 0) AS BIGINT) AS redundant,
               CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
               CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM measured
    """,
}
