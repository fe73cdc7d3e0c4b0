"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

#: Lower-cases A-Z only.
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": f"""
        WITH t AS (SELECT doc_id, sha256({LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op8_warc_revisits": r"""
        WITH bare AS (
          SELECT page_id, html, regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages
        ), parts AS (
          SELECT page_id, html,
            regexp_replace(regexp_replace(translate(regexp_extract(u, '^([^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', ''), '^www\.', '') AS host,
            regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
            regexp_replace(regexp_replace(regexp_extract(u, '(?s)\?(.*)$', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query
          FROM bare
        ), captures AS (
          SELECT page_id AS p, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url, strlen(coalesce(html, ''))::VARCHAR AS size,
            '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag1, '"' || substr(md5(coalesce(html, '') || '2'), 1, 16) || '"' AS tag2,
            '"' || substr(md5(coalesce(html, '') || '3'), 1, 16) || '"' AS tag3, 'd' || (page_id % 7) AS day
          FROM parts
        ), responses AS (
          SELECT p * 8 AS id, canonical_url, p * 20 AS ts, size, CASE WHEN p % 5 <> 4 THEN tag1 END AS etag, CASE WHEN p % 5 <> 4 THEN day END AS modified FROM captures
          UNION ALL SELECT p * 8 + 1, canonical_url, p * 20 + 4, size, tag2, NULL FROM captures WHERE p % 3 = 0
          UNION ALL SELECT p * 8 + 2, canonical_url, p * 20 + 9, size, tag3, NULL FROM captures WHERE p % 2 = 0
        ), revisits AS (
          SELECT p * 8 + 3 AS id, canonical_url, p * 20 + 6 AS ts, CASE p % 4 WHEN 0 THEN 'W/' || CASE WHEN p % 3 = 0 THEN tag2 ELSE tag1 END WHEN 1 THEN tag1 END AS etag,
            CASE WHEN p % 4 = 2 THEN day END AS modified FROM captures
          UNION ALL SELECT p * 8 + 4, canonical_url, p * 20 - 1, tag1, NULL FROM captures WHERE p % 7 = 0
        ), matched AS (
          SELECT v.id, v.canonical_url, v.ts, v.etag, v.modified, arg_max(r.id, r.ts * 1000000000 + r.id) AS response
          FROM revisits v LEFT JOIN responses r ON r.canonical_url = v.canonical_url AND r.ts < v.ts GROUP BY ALL
        ), judged AS (
          SELECT m.*, r.size, r.etag AS their_etag, r.modified AS their_modified,
            CASE WHEN r.id IS NULL THEN 'none'
                 WHEN coalesce(ltrim(m.etag, 'W/') = ltrim(r.etag, 'W/'), m.modified = r.modified, false) THEN 'resolved' ELSE 'mismatch' END AS outcome
          FROM matched m LEFT JOIN responses r ON r.id = m.response
        )
        SELECT id AS record_id, canonical_url, ts, CASE WHEN outcome = 'resolved' THEN response END AS resolved_id, outcome,
          CASE WHEN outcome = 'resolved'
               THEN concat_ws('; ', 'cache-control: max-age=60', 'content-length: ' || size, 'content-type: text/html', 'etag: ' || coalesce(etag, their_etag), 'last-modified: ' || coalesce(modified, their_modified))
               ELSE concat_ws('; ', 'cache-control: max-age=60', 'content-length: 0', 'etag: ' || etag, 'last-modified: ' || modified, 'set-cookie: a=b') END AS headers
        FROM judged
    """,
    "op9_url_filter": r"""
        WITH rules(host, path, verdict) AS (
          VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
        ), listed AS (
          SELECT name || '.example.' || top AS host
          FROM (VALUES ('ads-track'), ('adult-x'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) a(name), (VALUES ('com'), ('net'), ('org')) b(top)
        ), cut AS (
          SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
          SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM cut
        )
        SELECT page_id, host, path, rule,
          CASE WHEN verdict IS NOT NULL THEN verdict
               WHEN starts_with(path, '/') AND EXISTS (SELECT 1 FROM listed l WHERE p.host = l.host OR ends_with(p.host, '.' || l.host)) THEN 'block'
               ELSE 'allow' END AS verdict
        FROM (
          SELECT p.*, r.host || r.path AS rule, r.verdict,
            row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) AS n
          FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        ) p WHERE n = 1
    """,
}
