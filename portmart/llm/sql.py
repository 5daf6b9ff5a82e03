"""DuckDB SQL for the queries that SQL can express.

Absent: op1 and op5 (learnt models, tested on held-out rows), op3 (its slot
edits), op10 (parsing) and op12 (approximate), which tests/llm compares with
plain versions.
"""

from portmart.llm.quality_rules import STOP_WORD_FORMS

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(name: str, source: str, key: str, words: str) -> str:
    """CTEs ``name``: the distinct 5-word shingles of ``source`` by ``key``."""
    return f"""{name}_words AS (SELECT {key}, {words} AS w FROM {source}),
    {name} AS (
        SELECT DISTINCT {key}, array_to_string(w[p:p + 4], ' ') AS s
        FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM {name}_words WHERE len(w) > 0)
    )"""


OP2 = f"""
WITH {_shingles("doc", "documents", "doc_id", _WORDS.format("lower(coalesce(text, ''))"))},
    {_shingles("item", "benchmark", "item_id", _WORDS.format("lower(coalesce(text, ''))"))},
    size AS (SELECT item_id, count(*) AS item_shingles FROM item GROUP BY item_id),
    hit AS (SELECT doc_id, item_id, count(*) AS shared FROM doc JOIN item USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, item_shingles, shared FROM hit JOIN size USING (item_id)
WHERE shared >= 0.75 * item_shingles
"""

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    win AS (
        SELECT r, p, array_to_string(w[p:p + 34], ' ') AS s
        FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)
    ),
    often AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
    gone AS (
        SELECT DISTINCT r, p + k AS p
        FROM (SELECT r, p FROM win JOIN often USING (s)) CROSS JOIN range(0, 35) AS o(k)
    ),
    held AS (
        SELECT a.r, string_agg(a.word, ' ' ORDER BY a.p) AS t, count(*) AS n
        FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) a
        ANTI JOIN gone g ON a.r = g.r AND a.p = g.p
        GROUP BY a.r
    )
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN held USING (r)
"""

OP6 = f"""
WITH RECURSIVE {_shingles("doc", "documents", "doc_id", _WORDS.format(_LOWER))},
    size AS (SELECT doc_id, count(*) AS n FROM doc GROUP BY doc_id),
    pair AS (
        SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o
        FROM doc a JOIN doc b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY u, v
    ),
    link AS (
        SELECT u, v FROM pair JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v
        WHERE 100 * o >= 75 * (x.n + y.n - o)
    ),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, v FROM reach JOIN link ON u = b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN size USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

OP7 = r"""
WITH p AS (
        SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS x,
            regexp_replace(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(www[0-9]*\.)?|#.*$', '', 'g') AS rest
        FROM pages
    ),
    q AS (
        SELECT *, min(page_id) OVER (PARTITION BY t) AS first, regexp_extract(rest, '^[^/:?]*') AS host,
            list_transform(range(0, 8), lambda i: ('0x' || substr(x, 5 * i::INT + 1, 5))::BIGINT) AS parts
        FROM p
    )
SELECT page_id, strlen(t)::BIGINT AS payload_bytes,
    array_to_string(list_transform(parts, lambda v: array_to_string(list_transform([15, 10, 5, 0],
        lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to,
    array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
        || regexp_replace(substr(rest, length(host) + 1), '^:[0-9]+', '') AS urlkey,
    strftime(make_timestamp((1577836800 + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS ts
FROM q
"""

OP8 = f"""
WITH RECURSIVE d AS (
        SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size,
            md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS k
        FROM documents
    ),
    src AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
    weighed AS (
        SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w,
            2.0::DOUBLE * source_size AS stop
        FROM src
    ),
    level AS (
        SELECT *, least(sum(source_size) OVER () * 1.5::DOUBLE, sum(stop) OVER ()) AS budget, sum(w) OVER () AS all_w,
            coalesce(sum(stop) OVER before, 0.0) AS stops_before, coalesce(sum(w) OVER before, 0.0) AS w_before
        FROM weighed
        WINDOW before AS (ORDER BY stop / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    marked AS (SELECT *, stop * (all_w - w_before) <= (budget - stops_before) * w AS stopped FROM level),
    target AS (
        SELECT source, source_size, n, CASE WHEN stopped THEN stop ELSE
            w * (budget - coalesce(sum(CASE WHEN stopped THEN stop END) OVER (), 0.0))
            / sum(CASE WHEN NOT stopped THEN w END) OVER () END AS target
        FROM marked
    ),
    need AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS whole,
            CASE WHEN source_size > 0
                THEN (target - floor(target / source_size) * source_size) / source_size ELSE 0 END AS fraction,
            ceil(sqrt(n)) AS n_ranges
        FROM target
    ),
    placed AS (
        SELECT d.*, length(bin(size)) AS c, s.source_size, s.target, s.whole, s.fraction,
            floor(('0x' || substr(k, 1, 8))::BIGINT::DOUBLE * n_ranges / 4294967296.0)::BIGINT AS rng
        FROM d JOIN need s ON d.source IS NOT DISTINCT FROM s.source
    ),
    goals AS (
        SELECT source, c, fraction * sum(sum(size)) OVER (PARTITION BY source ORDER BY c DESC) AS goal,
            row_number() OVER (PARTITION BY source ORDER BY c DESC) AS i
        FROM placed GROUP BY source, c, fraction
    ),
    ranges AS (SELECT source, c, rng, sum(size)::BIGINT AS words FROM placed GROUP BY source, c, rng),
    by_range AS (
        SELECT source, c, rng AS pos, (sum(words) OVER (PARTITION BY source, c ORDER BY rng))::BIGINT AS w FROM ranges
        UNION ALL SELECT source, c, -1, 0 FROM goals
    ),
    range_cut AS (
        SELECT source, 0::BIGINT AS i, 0::BIGINT AS taken, -1 AS c, -1::BIGINT AS pos FROM src
        UNION ALL
        SELECT f.source, f.i + 1, f.taken + arg_min(o.w, (abs(o.w + f.taken - g.goal), o.pos)), g.c,
            arg_min(o.pos, (abs(o.w + f.taken - g.goal), o.pos))
        FROM range_cut f JOIN goals g ON g.source IS NOT DISTINCT FROM f.source AND g.i = f.i + 1
        JOIN by_range o ON o.source IS NOT DISTINCT FROM g.source AND o.c = g.c
        GROUP BY f.source, f.i, f.taken, g.c
    ),
    bounds AS (
        SELECT f.source, f.c, CASE WHEN f.pos < 0 THEN min(r.rng) ELSE f.pos END AS lo,
            coalesce(min(CASE WHEN r.rng > f.pos THEN r.rng END), f.pos) AS hi,
            coalesce(sum(CASE WHEN r.rng < f.pos THEN r.words END), 0)::BIGINT AS base
        FROM range_cut f JOIN ranges r ON r.source IS NOT DISTINCT FROM f.source AND r.c = f.c
        GROUP BY f.source, f.c, f.pos
    ),
    by_draw AS (
        SELECT p.source, p.c, k AS pos,
            (base + sum(sum(size)) OVER (PARTITION BY p.source, p.c ORDER BY k))::BIGINT AS w
        FROM placed p JOIN bounds b ON p.source IS NOT DISTINCT FROM b.source AND p.c = b.c AND rng BETWEEN lo AND hi
        GROUP BY p.source, p.c, k, base
        UNION ALL SELECT source, c, '', base FROM bounds
    ),
    draw_cut AS (
        SELECT source, 0::BIGINT AS i, 0::BIGINT AS taken, -1 AS c, '' AS pos FROM src
        UNION ALL
        SELECT f.source, f.i + 1, f.taken + arg_min(o.w, (abs(o.w + f.taken - g.goal), o.pos)), g.c,
            arg_min(o.pos, (abs(o.w + f.taken - g.goal), o.pos))
        FROM draw_cut f JOIN goals g ON g.source IS NOT DISTINCT FROM f.source AND g.i = f.i + 1
        JOIN by_draw o ON o.source IS NOT DISTINCT FROM g.source AND o.c = g.c
        GROUP BY f.source, f.i, f.taken, g.c
    )
SELECT p.doc_id, p.size, p.source_size, p.target,
    (p.size * (p.whole + (p.rng < b.lo OR p.k <= f.pos)::INT))::BIGINT AS taken
FROM placed p
JOIN bounds b ON p.source IS NOT DISTINCT FROM b.source AND p.c = b.c
JOIN draw_cut f ON p.source IS NOT DISTINCT FROM f.source AND p.c = f.c
"""

_STOPS = ", ".join(f"'{w}'" for w in STOP_WORD_FORMS)

OP9 = f"""
WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM documents
    ),
    win AS (
        SELECT r, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) > 2)
    ),
    often AS (SELECT r, p, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win),
    rep AS (
        SELECT r, count(DISTINCT p + k) AS n_repeat_words
        FROM often CROSS JOIN range(0, 3) AS o(k) WHERE n > 1 GROUP BY r
    ),
    m AS (
        SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
            coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
            len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop,
            len(list_filter(lines, lambda x: rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%…')) AS n_ellipsis,
            len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•–]'))) AS n_bullet
        FROM d LEFT JOIN rep USING (r)
    ),
    v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND n_symbols <= 0.05 * word_chars
        AND n_symbols <= 0.25 * n_words AND n_stop >= 0.03 * n_words AND n_dup_lines <= 0.5 * n_lines
        AND n_ellipsis <= 0.3 * n_lines AND n_bullet <= 0.9 * n_lines AS kept
FROM v
"""

# CRC-32 of a row's decimal doc_id: bytes are marked by adding 8, ones are bit steps.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda b: [ascii(b)::BIGINT + 8, 1, 1, 1, 1, 1, 1, 1, 1]))),
    lambda c, x: CASE WHEN x > 1 THEN xor(c, x - 8)
        WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""

OP13 = f"""
WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, {_CRC} AS h, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
    ),
    g AS (SELECT *, h // 10 AS g, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
    e AS (
        SELECT r, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
        FROM (SELECT *, unnest(range(0, n)) AS i FROM p)
    ),
    cell AS (
        SELECT x.r, x.i, x.i - y.i AS lag FROM e x JOIN e y ON x.r = y.r AND x.word = y.word AND x.i > y.i
        WHERE 4 * (x.i - y.i) <= x.n
    ),
    diagonal AS (
        SELECT r, lag, min(i) - lag AS start, max(i) - min(i) + 1 + lag AS length
        FROM (SELECT *, i - row_number() OVER (PARTITION BY r, lag ORDER BY i) AS island FROM cell)
        GROUP BY r, lag, island
    ),
    run AS (
        SELECT r, start, length, min(lag) AS period FROM diagonal
        WHERE length >= 6 AND length >= 4 * lag GROUP BY r, start, length
    ),
    best AS (
        SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines
        FROM run GROUP BY r
    ),
    top AS (
        SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY length * 1000000000000 // period DESC, start, period) = 1
    ),
    gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
    held AS (
        SELECT e.r, string_agg(word, ' ' ORDER BY e.i) AS t FROM e ANTI JOIN gone ON e.r = gone.r AND e.i = gone.i GROUP BY e.r
    )
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
    period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (r) LEFT JOIN top USING (r) LEFT JOIN held USING (r)
"""

OP11 = r"""
WITH d AS (
        SELECT coalesce(lang, 'und') AS lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    ),
    piece AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS t FROM d),
    numbered AS (SELECT row_number() OVER () AS q, lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
    word AS (SELECT q, lang, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS p FROM numbered),
    run AS (
        SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM word WINDOW o AS (PARTITION BY q ORDER BY p)
    ),
    gram AS (
        SELECT lang, 1 AS m, w1 AS s FROM run
        UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM run WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM run WHERE w3 IS NOT NULL
    ),
    f AS (SELECT lang, m, s, count(*) AS f, string_split(s, ' ') AS w FROM gram GROUP BY lang, m, s),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
    candidate AS (SELECT * FROM f WHERE m > 1 AND f >= 10),
    part AS (
        SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, m)) AS k FROM candidate)
    ),
    cut AS (
        SELECT c.lang, c.s, c.m, c.f AS a, x.f AS l, y.f AS r, k, 1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score
        FROM part c JOIN f x ON x.lang = c.lang AND x.s = c.head JOIN f y ON y.lang = c.lang AND y.s = c.rest
    ),
    worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, k) = 1),
    inner_pair AS (
        SELECT lang, s, max(a) AS most
        FROM (SELECT lang, f AS a, array_to_string(w[q:q + 1], ' ') AS s FROM candidate, range(1, 3) AS o(q) WHERE m = 3)
        GROUP BY lang, s
    ),
    ranked AS (
        SELECT worst.*, row_number() OVER (PARTITION BY worst.lang ORDER BY score DESC, a DESC, worst.s) AS rank
        FROM worst LEFT JOIN inner_pair i ON i.lang = worst.lang AND i.s = worst.s AND m = 2
        WHERE most IS NULL OR 100 * most < 50 * a
    )
SELECT lang, rank::BIGINT AS rank, s AS phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op2_decontamination": OP2,
    "op4_substring_dedup": OP4,
    "op6_ngram_join": OP6,
    "op7_warc": OP7,
    "op8_mixing": OP8,
    "op9_quality_rules": OP9,
    "op11_phrase_mining": OP11,
    "op13_periodic_runs": OP13,
}
