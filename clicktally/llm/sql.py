"""SQL (DuckDB) that gives the same rows as a query of this package, where SQL can."""

from __future__ import annotations

from clicktally.llm import mixing, url_filter

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


MIXING = f"""
    WITH RECURSIVE sizes AS (
        SELECT coalesce(source, '') AS name, count(*) AS n FROM documents GROUP BY 1
    ), parts AS (
        SELECT name, greatest(1, CAST(floor({mixing.CYCLE} * sqrt(n) / (SELECT sum(sqrt(n)) FROM sizes) + 0.5) AS BIGINT)) AS a
        FROM sizes
    ), cycle AS (
        SELECT list(name ORDER BY name) AS names, list(a ORDER BY name) AS shares, CAST(sum(a) AS BIGINT) AS length FROM parts
    ), steps AS (
        SELECT CAST(-1 AS BIGINT) AS tick, list_transform(names, lambda x: CAST(0 AS BIGINT)) AS done, CAST(0 AS BIGINT) AS pick FROM cycle
        UNION ALL
        SELECT tick + 1, list_transform(range(1, len(done) + 1), lambda i: done[i] + CASE WHEN i = chosen THEN 1 ELSE 0 END), chosen
        FROM (
            SELECT tick, done, list_min(list_transform(
                list_filter(range(1, len(names) + 1), lambda i: done[i] < shares[i] AND done[i] * length // shares[i] <= tick + 1),
                lambda i: struct_pack(deadline := ((done[i] + 1) * length + shares[i] - 1) // shares[i], i := i))).i AS chosen
            FROM steps, cycle WHERE tick + 1 < length
        )
    ), schedule AS (
        SELECT names[pick] AS name, done[pick] - 1 AS step, tick FROM steps, cycle WHERE tick >= 0
    ), ranked AS (
        SELECT doc_id, source, coalesce(source, '') AS name,
               row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rank
        FROM documents
    ), blocks AS (
        SELECT doc_id, source, name, rank // {mixing.BLOCK} AS block, rank % {mixing.BLOCK} AS place FROM ranked
    )
    SELECT doc_id, source, block, place, block * length // a AS release,
           ((block + 1) * length + a - 1) // a AS deadline, (block // a) * length + tick AS slot
    FROM blocks JOIN parts USING (name) CROSS JOIN cycle
    JOIN schedule ON schedule.name = blocks.name AND schedule.step = block % parts.a
"""

DECONTAMINATE = f"""
    WITH docs AS (
        SELECT doc_id, {_words("text")} AS words FROM documents
    ), items AS (
        SELECT item_id, words, least(10, len(words)) AS n
        FROM (SELECT item_id, {_words("text")} AS words FROM benchmark) WHERE len(words) > 0
    ), windows AS (
        SELECT DISTINCT item_id, n, list_slice(words, i, i + n - 1) AS words
        FROM items, unnest(range(1, len(items.words) - n + 2)) AS t(i)
    ), places AS (
        SELECT doc_id, i, n, list_slice(words, i, i + n - 1) AS words
        FROM docs, (SELECT DISTINCT n FROM windows) AS sizes, unnest(range(1, len(docs.words) - n + 2)) AS t(i)
    ), found AS (
        SELECT doc_id, i, places.n, item_id FROM places JOIN windows USING (words)
    ), hit AS (
        SELECT doc_id, count(DISTINCT word) AS n_hit FROM found, unnest(range(i, i + n)) AS t(word) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

FILTER_AUDIT = r"""
    WITH texts AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
    ), measured AS (
        SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
               min(doc_id) OVER (PARTITION BY t) AS first_id
        FROM texts
    ), marks AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id
    ), flags AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
                   WHEN 'A' THEN len(words) < 200
                   WHEN 'B' THEN 100 * len(list_distinct(words)) < 50 * len(words)
                   WHEN 'C' THEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t)
                   WHEN 'D' THEN regexp_matches(t, '[#$%&*|]')
                   ELSE coalesce(doc_id > first_id, false) END) AS fails
        FROM measured LEFT JOIN marks USING (doc_id)
    ), cells AS (
        SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY part, fails
    ), letters AS (
        SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ), steps AS (
        SELECT part, filter_order, step, n, good, toxic, len(fails) AS n_fails,
               list_contains(fails, filter_order[step]) AS now,
               len(list_filter(fails, lambda f: instr(filter_order, f) < step)) > 0 AS gone
        FROM cells, orders, unnest(range(1, 6)) AS t(step)
    ), counted AS (
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter,
               CAST(sum(CASE WHEN NOT now AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
               CAST(sum(CASE WHEN now AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
               CAST(sum(CASE WHEN now AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
               CAST(sum(CASE WHEN now AND n_fails = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
               CAST(sum(CASE WHEN now AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
               CAST(sum(CASE WHEN now AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
        FROM steps GROUP BY part, filter_order, step
    )
    SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM counted
"""

ORACLE = {
    "op6_url_filter": url_filter.verdict_sql(),
    "op9_mixing": MIXING,
    "op10_decontaminate": DECONTAMINATE,
    "op11_filter_audit": FILTER_AUDIT,
}
