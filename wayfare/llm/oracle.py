"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from wayfare.llm.quality import STOP_WORDS
from wayfare.llm.queries import MIX_SEED
from wayfare.llm.urls import UNWANTED

ORACLE: dict[str, str] = {}

# Words: runs of anything but the six spaces.
_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
_UNWANTED = ", ".join(f"'{w}'" for w in UNWANTED)

ORACLE["op4_url_filters"] = rf"""
WITH parsed AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages),
seen AS (
    SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
        '(?is)<script[^<>]*>.*?(?:</script[^<>]*>|\z)', ' ', 'g'),
        '(?is)<style[^<>]*>.*?(?:</style[^<>]*>|\z)', ' ', 'g'),
        '(?s)<!--.*?(?:-->|\z)', ' ', 'g'), '<[^<>]*>', ' ', 'g'), '&#?[0-9A-Za-z]{{1,10}};', ' ', 'g') AS text
    FROM pages),
split AS (
    SELECT page_id, text, {_WORDS.format(text="text")} AS w, list_filter(string_split(text, chr(10)),
        lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM seen),
broken AS (
    SELECT page_id, NOT (length(array_to_string(w, '')) BETWEEN 2 * len(w) AND 15 * len(w)
        AND length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) <= 0.1::DOUBLE * len(w)
        AND length(regexp_replace(text, '[^!]', '', 'g')) <= 0.3::DOUBLE * len(w)
        AND (len(w) < 50 OR len(list_filter(w, lambda x: rtrim(lower(x), '.,;:!?') IN ({_STOPS})))
            >= 0.03::DOUBLE * len(w))
        AND len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) <= 0.2::DOUBLE * len(w)
        AND len(lines) - len(list_distinct(lines)) <= 0.5::DOUBLE * len(lines)) AS broken
    FROM split),
labelled AS (
    SELECT host, CAST(broken OR list_has_any(string_split_regex(host, '[^a-z]+'), [{_UNWANTED}]) AS INT) AS bad
    FROM parsed JOIN broken USING (page_id)),
named AS (
    SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
        string_split(host, '.') AS labels FROM labelled GROUP BY host),
hosts AS (
    SELECT host, n, bad, array_to_string(labels[-2:], '.') AS domain, labels[-1] AS suffix FROM named),
overall AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM hosts),
s0 AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM hosts, overall GROUP BY suffix),
s1 AS (
    SELECT 1 / least(greatest((sum((bad - n * m) ** 2) - sum(n * m * (1 - m)))
        / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.99) - 1 AS k FROM s0 WHERE n > 0),
s AS (SELECT suffix, (bad + round(k, 6) * m) / (n + round(k, 6)) AS m FROM s0, s1),
d0 AS (
    SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m
    FROM hosts JOIN s USING (suffix) GROUP BY domain, suffix),
d1 AS (
    SELECT 1 / least(greatest((sum((bad - n * m) ** 2) - sum(n * m * (1 - m)))
        / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.99) - 1 AS k FROM d0 WHERE n > 0),
d AS (SELECT domain, (bad + round(k, 6) * m) / (n + round(k, 6)) AS m FROM d0, d1),
h0 AS (SELECT host, n, bad, m FROM hosts JOIN d USING (domain)),
h1 AS (
    SELECT 1 / least(greatest((sum((bad - n * m) ** 2) - sum(n * m * (1 - m)))
        / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.99) - 1 AS k FROM h0 WHERE n > 0),
h AS (SELECT host, n + round(k, 6) AS w, (bad + round(k, 6) * m) / (n + round(k, 6)) AS m FROM h0, h1),
known AS (SELECT host, m - 1.645 * sqrt(m * (1 - m) / (w + 1)) > 0.25 AS blocked FROM h),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1')
            THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/')
            THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
        END AS rule FROM parsed)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN known USING (host)
"""

# Earlier is by document, then line; document ids do not repeat in the tables.
ORACLE["op6_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
    SELECT doc_id, k, list_filter(string_split_regex(translate(parts[k], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM split, unnest(range(1, len(parts) + 1)) AS t(k)),
worded AS (SELECT *, array_to_string(w, ' ') AS form FROM lines WHERE len(w) > 0),
placed AS (SELECT *, row_number() OVER (ORDER BY doc_id, k) AS at_row FROM worded),
forms AS (SELECT form, min(at_row) AS rank, any_value(w) AS w FROM placed GROUP BY form),
cut AS (
    SELECT rank, len(w) AS n, p, array_to_string(list_concat(w[1:p - 1], w[p + 1:]), ' ') AS v
    FROM forms, unnest(range(1, len(w) + 1)) AS t(p) WHERE len(w) >= 8),
swapped AS (SELECT rank, min(rank) OVER (PARTITION BY p, n, v) AS earliest FROM cut),
grown AS (
    SELECT greatest(cut.rank, forms.rank) AS rank FROM cut JOIN forms ON v = form WHERE len(forms.w) >= 8),
near AS (SELECT rank FROM swapped WHERE rank > earliest UNION SELECT rank FROM grown),
fate AS (
    SELECT doc_id, k, CASE WHEN near.rank IS NOT NULL THEN 'near' WHEN at_row > forms.rank THEN 'exact' END AS verdict
    FROM placed JOIN forms USING (form) LEFT JOIN near ON near.rank = forms.rank),
gone AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (verdict = 'exact') AS n_exact,
        count(*) FILTER (verdict = 'near') AS n_near,
        list(k) FILTER (verdict IS NOT NULL) AS dropped FROM fate GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
    sha256(array_to_string(list_transform(list_filter(range(1, len(parts) + 1),
        lambda k: NOT list_contains(coalesce(dropped, []), k)), lambda k: parts[k]), chr(10))) AS kept_sha256
FROM split LEFT JOIN gone USING (doc_id)
"""

# An independent template-free view: what is read back must be the turns themselves.
ORACLE["op7_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
    SELECT *,
        len(regexp_extract_all(role, '<\||</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '<\||</?s>|\[/?INST\]'))
        AS controls
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(role) + length(text) + length(regexp_replace(role || text, '[^\\]', '', 'g'))
        + controls + length('<|turn|><|text|><|end|>')) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

ORACLE["op8_quality_rules"] = rf"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format(text="coalesce(text, '')")} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
grams AS (
    SELECT *, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS g FROM split),
twice AS (
    SELECT *, CASE WHEN len(list_distinct(g)) = len(g) THEN []
        ELSE map_keys(map_from_entries(list_filter(map_entries(list_histogram(g)), lambda e: e.value > 1))) END AS again
    FROM grams),
placed AS (
    SELECT *, CASE WHEN len(again) = 0 THEN [] ELSE list_filter(range(1, len(g) + 1),
        lambda i: list_contains(again, g[i])) END AS pos FROM twice),
counted AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        length(regexp_replace(text, '[^!]', '', 'g')) AS ex,
        len(lines) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(list_sum(list_transform(range(1, len(pos) + 1),
            lambda k: least(5, coalesce(pos[k + 1] - pos[k], 5)))), 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(w, lambda x: rtrim(lower(x), '.,;:!?') IN ({_STOPS}))) AS stops,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS same
    FROM placed),
based AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words
    AND n_symbols <= 0.1::DOUBLE * n_words AND ex <= 0.3::DOUBLE * n_words
    AND (n_words < 50 OR stops >= 0.03::DOUBLE * n_words)
    AND same <= 0.2::DOUBLE * n_words AND n_dup_lines <= 0.5::DOUBLE * n_lines AS kept
FROM based
"""

# One pass of the draw: documents that fit, in order, up to what lacks.
_PASS = """
summed{n} AS (
    SELECT *, NOT took{p} AND f > 0 AND size <= {limit} AS open,
        sum(size) OVER (PARTITION BY source, NOT took{p} AND f > 0 AND size <= {limit} ORDER BY q, size) AS until,
        sum(size) OVER (PARTITION BY source, NOT took{p} AND f > 0 AND size <= {limit}, q, size) AS step
    FROM {of}),
drawn{n} AS (
    SELECT * EXCLUDE (open, until, step), took{p} OR (open AND {fits}) AS took{n},
        r{p} - coalesce(sum(size) FILTER (open AND {fits}) OVER (PARTITION BY source), 0) AS r{n}
    FROM summed{n})"""
_PASSES = ",".join(
    [
        _PASS.format(n=1, p=0, of="ranked", limit="'inf'::DOUBLE", fits="until <= r0"),
        _PASS.format(n=2, p=1, of="drawn1", limit="r1", fits="until <= r1"),
        _PASS.format(n=3, p=2, of="drawn2", limit="2 * r2", fits="2 * until - step <= 2 * r2"),
    ]
)
ORACLE["op9_mixing"] = rf"""
WITH sized AS (
    SELECT doc_id, source, len({_WORDS.format(text="coalesce(text, '')")}) AS size,
        (('0x' || substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
            || coalesce(text, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM documents),
docs AS (SELECT *, CASE WHEN size < 50 THEN 0.5::DOUBLE ELSE 1::DOUBLE END AS weight FROM sized),
sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS s, sum(weight * size) AS weighed,
        CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS share
    FROM docs GROUP BY source),
levels AS (
    SELECT *, row_number() OVER o AS pos,
        (sum(s) OVER () - coalesce(sum(3 * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(share) OVER () - coalesce(sum(share) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        AS level
    FROM sums WINDOW o AS (ORDER BY (3 * s)::DOUBLE / share::DOUBLE, source NULLS LAST)),
first AS (SELECT arg_min(level, pos) AS level, min(pos) AS pos FROM levels WHERE share * level <= 3 * s),
aims AS (
    SELECT source, s AS source_size, weighed,
        CASE WHEN levels.pos < first.pos THEN (3 * s)::DOUBLE ELSE share::DOUBLE * first.level END AS target
    FROM levels, first),
expected AS (
    SELECT docs.*, source_size, target,
        least(3::DOUBLE, (CASE WHEN weighed > 0 THEN target / weighed ELSE 0::DOUBLE END) * weight) AS e
    FROM docs JOIN aims ON docs.source IS NOT DISTINCT FROM aims.source),
parts AS (SELECT *, floor(e)::BIGINT AS c, e - floor(e) AS f FROM expected),
lacking AS (
    SELECT source, any_value(target) - sum(c * size)::DOUBLE AS r FROM parts GROUP BY source),
ranked AS (
    SELECT parts.*, r AS r0, CASE WHEN f > 0 THEN u / (1 - u) * (1 - f) / f END AS q, false AS took0
    FROM parts JOIN lacking ON parts.source IS NOT DISTINCT FROM lacking.source),
{_PASSES}
SELECT doc_id, size, source_size, target, CAST((c + took3::INT) * size AS BIGINT) AS taken FROM drawn3
"""

ORACLE["op10_topk_search"] = r"""
WITH codes AS (
    SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS code
    FROM embeddings WHERE embedding IS NOT NULL),
ranked AS (
    SELECT q.vec_id AS query, c.vec_id AS neighbour, hamming(q.code, c.code) AS distance,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY hamming(q.code, c.code), c.vec_id) AS rank
    FROM codes q, codes c WHERE q.vec_id % 50 = 0)
SELECT query, CAST(rank AS INT) AS rank, neighbour, CAST(distance AS INT) AS distance FROM ranked WHERE rank <= 10
"""

# The orders by a plain recursion over letters; each step looks at the cells for itself.
ORACLE["op11_filter_audit"] = rf"""
WITH RECURSIVE said AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
marks AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY doc_id),
masks AS (
    SELECT said.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CAST(len(w) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT)
        + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INT)
        + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
        + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INT) AS mask
    FROM said LEFT JOIN marks USING (doc_id)),
cells AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM masks GROUP BY part, mask),
filters (letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders (o, used) AS (
    SELECT '', 0 UNION ALL
    SELECT o || letter, used | bit FROM orders JOIN filters ON used & bit = 0),
placed AS (
    SELECT o, step, bit, coalesce((SELECT sum(g.bit) FROM filters g WHERE contains(o[1:step - 1], g.letter)), 0)::INT AS before
    FROM orders, unnest(range(1, 6)) AS t(step) JOIN filters ON letter = o[step] WHERE len(o) = 5),
found AS (
    SELECT part, o AS filter_order, step, bit,
        sum(n) FILTER (mask & (before | bit) = 0) AS kept,
        sum(n) FILTER (mask & before = 0 AND mask & bit <> 0) AS removed,
        sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0) AS redundant,
        sum(n) FILTER (mask = bit) AS unique_fails,
        sum(good) FILTER (mask & before = 0 AND mask & bit <> 0) AS good_lost,
        sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0) AS toxic_lost
    FROM cells, placed GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
    CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
    CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM found
"""

# All pairs that share a shingle, and what can be reached over those that are similar.
ORACLE["op12_minhash"] = rf"""
WITH RECURSIVE said AS (
    SELECT doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        END AS s FROM said),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b USING (item)
    WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached (x, y) AS (
    SELECT doc_id, doc_id FROM sets UNION
    SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, component_id = sets.doc_id AS kept
FROM sets JOIN (SELECT x, min(y) AS component_id FROM reached GROUP BY x) ON x = doc_id
"""

# Each prefix of each sequence for itself; CRC-32 bit by bit, as there is no function for it.
ORACLE["op13_prefix_trie"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
tokens AS (
    SELECT conv_id, turn, left(sha256(length(role) || ':' || role || text), 32) || printf('%08x', length(text)) AS token
    FROM said),
own AS (
    SELECT conv_id, list(token ORDER BY turn NULLS FIRST, token) AS t, CAST(conv_id AS VARCHAR) AS c
    FROM tokens GROUP BY conv_id),
sums AS (
    SELECT *, xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, len(c) + 1), lambda i: ascii(c[i])::BIGINT)),
        lambda x, b: list_reduce(list_prepend(xor(x, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda y, z: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END + z)))) % 6 AS h
    FROM own),
rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.t, [])[1:a.h], a.t[a.h + 1:]) AS t
    FROM sums a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
prefixes AS (
    SELECT conv_id, d, array_to_string(t[1:d], '') AS node, d = len(t) AS ends,
        CASE WHEN d = 0 THEN 0 ELSE ('0x' || right(t[d], 8))::BIGINT END AS chars
    FROM rebuilt, unnest(range(0, len(t) + 1)) AS u(d)),
nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends
    FROM prefixes GROUP BY node, d),
below AS (SELECT left(node, 40 * (d - 1)) AS node, count(*) AS children FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(children, 0) AS children FROM nodes LEFT JOIN below USING (node)),
subtrees AS (
    SELECT left(node, 40 * k) AS node, count(*) FILTER (children = 0) AS leaves, sum((n - 1) * chars) AS saved
    FROM counted, unnest(range(0, d + 1)) AS u(k) GROUP BY 1)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.children AS n_children,
    leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, c.ends AS ends_sha256
FROM counted c JOIN subtrees USING (node)
LEFT JOIN nodes p ON c.d > 0 AND p.node = left(c.node, 40 * (c.d - 1))
"""
