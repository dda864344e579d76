"""SQL (DuckDB) that gives the same rows as the registered queries, by plain comparison of all with all."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

NGRAM_JOIN = rf"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS words FROM documents
), grams AS (
    SELECT DISTINCT row_id, array_to_string(words[i : i + 2], ' ') AS gram
    FROM (SELECT row_id, words, unnest(generate_series(1, greatest(len(words) - 2, least(len(words), 1)))) AS i FROM docs)
), sizes AS (SELECT row_id, count(*) AS n FROM grams GROUP BY 1),
links AS (
    SELECT x, y FROM (
        SELECT a.row_id AS x, b.row_id AS y, count(*) AS common FROM grams a JOIN grams b USING (gram)
        WHERE a.row_id <> b.row_id GROUP BY 1, 2
    ) JOIN sizes s ON s.row_id = x JOIN sizes t ON t.row_id = y JOIN docs d ON d.row_id = x JOIN docs e ON e.row_id = y
    WHERE 100 * common >= 90 * (s.n + t.n - common) AND d.doc_id IS NOT NULL AND e.doc_id IS NOT NULL
), reach(x, y) AS (
    SELECT row_id, row_id FROM docs UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(e.doc_id) AS component_id
FROM docs d LEFT JOIN sizes USING (row_id) JOIN reach ON reach.x = d.row_id JOIN docs e ON e.row_id = reach.y
GROUP BY d.row_id, d.doc_id
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS row_id, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), usable AS (
    SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM vectors
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.row_id AS x, b.row_id AS y FROM usable a JOIN usable b
    ON a.label = b.label AND a.row_id <> b.row_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), degrees AS (SELECT x, count(*) AS n_links FROM links GROUP BY 1),
reach(x, y) AS (
    SELECT row_id, row_id FROM vectors UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), components AS (
    SELECT reach.x, min(vec_id) AS component_id FROM reach JOIN vectors ON row_id = reach.y GROUP BY 1
)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM vectors LEFT JOIN degrees ON degrees.x = row_id JOIN components ON components.x = row_id
"""

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, {WORDS} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {WORDS} AS words FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, least(13, len(words)) AS size, array_to_string(words[i : i + least(13, len(words)) - 1], ' ') AS gram
    FROM (SELECT item_id, words, unnest(generate_series(1, len(words) - least(13, len(words)) + 1)) AS i FROM items WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
    SELECT row_id, i, size, array_to_string(words[i : i + size - 1], ' ') AS gram
    FROM (SELECT row_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM docs, sizes WHERE len(words) >= size)
), hits AS (SELECT row_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, gram)),
covered AS (
    SELECT row_id, count(DISTINCT place) AS n_hit
    FROM (SELECT row_id, unnest(generate_series(i, i + size - 1)) AS place FROM (SELECT DISTINCT row_id, i, size FROM hits)) GROUP BY 1
), found AS (SELECT row_id, list_sort(list(DISTINCT item_id) FILTER (item_id IS NOT NULL)) AS ids FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (row_id) LEFT JOIN found USING (row_id)
"""

SUFFIX_DEDUP = """
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, hex(encode(coalesce(text, ''))) AS hexed FROM documents),
chunks AS (  -- of 400 string starts, so that each string is cut from a short text
    SELECT row_id, doc_id, k, substr(hexed, 2 * k + 1, 898) AS part
    FROM (SELECT row_id, doc_id, hexed, unnest(generate_series(0, len(hexed) // 2 - 50, 400)) AS k
          FROM docs WHERE doc_id IS NOT NULL AND len(hexed) >= 100)
), starts AS (
    SELECT row_id, doc_id, k + j AS i, md5_number(substr(part, 2 * j - 1, 100)) AS string
    FROM (SELECT *, unnest(generate_series(1, len(part) // 2 - 49)) AS j FROM chunks)
), sources AS (SELECT string, min(doc_id) AS source FROM starts GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT row_id, i FROM starts JOIN sources USING (string) WHERE source < doc_id),
marked AS (SELECT row_id, i, coalesce(i - lag(i) OVER (PARTITION BY row_id ORDER BY i) > 50, true) AS first FROM gone),
numbered AS (SELECT row_id, i, sum(CAST(first AS INTEGER)) OVER (PARTITION BY row_id ORDER BY i) AS run FROM marked),
runs AS (SELECT row_id, run, min(i) AS low, max(i) + 49 AS high FROM numbered GROUP BY 1, 2),
gaps AS (
    SELECT row_id, low, high, substr(hexed, 2 * before + 1, 2 * (low - 1 - before)) AS piece,
           CASE WHEN high = last THEN substr(hexed, 2 * high + 1) ELSE '' END AS tail
    FROM (SELECT *, coalesce(lag(high) OVER (PARTITION BY row_id ORDER BY low), 0) AS before,
                 max(high) OVER (PARTITION BY row_id) AS last FROM runs) JOIN docs USING (row_id)
), summed AS (
    SELECT row_id, sum(high - low + 1) AS n_removed, count(*) AS n_spans,
           string_agg(piece || tail, '' ORDER BY low) AS kept
    FROM gaps GROUP BY 1
)
SELECT doc_id, CAST(len(hexed) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, hexed))) AS kept_sha256
FROM docs LEFT JOIN summed USING (row_id)
"""


def chat_format(start: str, end: str, planted: str) -> str:
    escaped = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
    role = escaped.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
    frame = len(start) + 1 + len(end) + 1
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
        SELECT conv_id, turn, role, text FROM conversations UNION ALL
        VALUES (-1, 0, 'user', '{planted}'), (-1, 1, 'assistant', '{planted}')
    )
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({frame} + length({role}) + length({escaped.format('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def periodic_runs(least_words: int, least_times: int, gram: int) -> str:
    """Every pair of equal strings of ``gram`` words of one text, joined into stretches by their distance."""
    crc = """xor(list_reduce(
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
        lambda crc, byte: list_reduce(
            CAST(range(8) AS BIGINT[]),
            lambda bits, step: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, CAST(3988292384 AS BIGINT)) ELSE bits >> 1 END,
            xor(crc, byte)),
        CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""
    return rf"""
WITH cut AS MATERIALIZED (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {crc} AS h FROM documents
), planted AS (
    SELECT *, CAST(len(w) AS BIGINT) AS n, h % 10 = 0 AND len(w) > 0 AS periodic, (h // 10) % greatest(len(w), 1) AS a FROM cut
), docs AS MATERIALIZED (
    SELECT row_id, doc_id, n, CASE WHEN periodic
        THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END])
        ELSE w END AS v FROM planted
), grams AS MATERIALIZED (
    SELECT row_id, n, i, md5_number(array_to_string(v[i + 1 : i + {gram}], ' ')) AS gram
    FROM (SELECT row_id, n, v, unnest(range(n - {gram - 1})) AS i FROM docs WHERE n >= {gram})
), pairs AS (
    SELECT x.row_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.row_id = y.row_id AND x.gram = y.gram AND x.i < y.i
    WHERE {least_times} * (y.i - x.i) <= x.n
), stretches AS (
    SELECT row_id, q, min(i) AS start, count(*) + {gram - 1} + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY row_id, q ORDER BY i) AS stretch FROM pairs) GROUP BY row_id, q, stretch
), runs AS MATERIALIZED (
    SELECT row_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest({least_words}, {least_times} * q) GROUP BY 1, 2, 3
), gone AS (SELECT DISTINCT row_id, unnest(range(start + period, start + length)) AS i FROM runs),
collapsed AS (
    SELECT row_id, string_agg(word, ' ' ORDER BY i) AS text
    FROM (SELECT row_id, unnest(v) AS word, unnest(range(n)) AS i FROM docs SEMI JOIN runs USING (row_id)) ANTI JOIN gone USING (row_id, i)
    GROUP BY 1
), listed AS (
    SELECT row_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY 1
), longest AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY length DESC, start, period) = 1)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, array_to_string(v, ' '))) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (row_id) LEFT JOIN longest USING (row_id) LEFT JOIN collapsed c USING (row_id)
"""
