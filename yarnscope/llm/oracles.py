"""DuckDB SQL of the queries that SQL can express."""

from yarnscope.llm import license_scan

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_ITEM = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP3 = f"""
WITH items AS (SELECT DISTINCT item_id, w, len(w) AS n FROM (SELECT item_id, {_ITEM} AS w FROM benchmark) WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, least(n, 10) AS k, array_to_string(list_slice(w, i, i + least(n, 10) - 1), ' ') AS win
         FROM (SELECT item_id, w, n, unnest(range(1, greatest(1, n - 9) + 1)) AS i FROM items)),
docs AS (SELECT doc_id, row_number() OVER () AS r, {_ITEM} AS w FROM documents),
spots AS (SELECT r, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
          FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM wins) WHERE len(w) >= k)),
hits AS (SELECT r, i, s.k, item_id FROM spots s JOIN wins USING (k, win)),
cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN cover USING (r) LEFT JOIN named USING (r)
"""

_SAID = "chr(60) || '/s>[INST] ok [/INST]'"
OP5 = f"""
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', {_SAID} UNION ALL SELECT -7, 1, 'assistant', {_SAID}),
e AS (SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS x,
             replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;') AS y FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, x)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, x) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(16 + length(x) + length(y))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
words AS (SELECT r, lang, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
tri AS (SELECT r, i, word, lead(word) OVER s AS b, lead(word, 2) OVER s AS c FROM words WINDOW s AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, word, b, c) AS n FROM tri WHERE c IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_rep FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (SELECT d.r, doc_id, lang, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
                coalesce(n_rep, 0) AS n_repeat_words, length(t) AS chars,
                length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS c_upper, length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS c_digit,
                length(t) - length(regexp_replace(t, '[.,;:!?()"''-]', '', 'g')) AS c_mark, strlen(t) - length(t) AS c_wide
         FROM d LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)),
classes AS (SELECT r, lang, k, v FROM (SELECT r, lang, unnest([0, 1, 2, 3, 4, 5, 6]) AS k,
            unnest([chars - word_chars, n_symbols, c_upper, c_digit, c_mark, c_wide,
                    greatest(0, word_chars - n_symbols - c_upper - c_digit - c_mark - c_wide)]) AS v FROM base)),
top AS (SELECT lang, word FROM (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS k FROM words GROUP BY lang, word) WHERE k <= 24),
counted AS (SELECT r, lang, word AS k, count(*) AS v FROM words JOIN top USING (lang, word) GROUP BY r, lang, word),
frequent AS (SELECT * FROM counted UNION ALL
             SELECT base.r, base.lang, NULL, n_words - coalesce(s, 0) FROM base LEFT JOIN (SELECT r, sum(v) AS s FROM counted GROUP BY r) USING (r)),
pq1 AS (SELECT r, v / nullif(sum(v) OVER (PARTITION BY r), 0) AS p, sum(v) OVER (PARTITION BY lang, k) / sum(v) OVER (PARTITION BY lang) AS q FROM classes),
j1 AS (SELECT r, sum(coalesce(p * log2(nullif(p, 0) / ((p + q) / 2)), 0) + coalesce(q * log2(nullif(q, 0) / ((p + q) / 2)), 0)) / 2 AS j FROM pq1 GROUP BY r),
pairs AS (SELECT f.r, f.lang, coalesce(f.k, '') AS k, f.v FROM frequent f),
ref AS (SELECT lang, k, sum(v) AS v FROM pairs GROUP BY lang, k),
ref2 AS (SELECT lang, k, v / sum(v) OVER (PARTITION BY lang) AS q FROM ref),
pq2 AS (SELECT b.r, coalesce(p.v, 0) / nullif(b.n_words, 0) AS p, q FROM base b JOIN ref2 USING (lang) LEFT JOIN pairs p ON p.r = b.r AND p.k = ref2.k),
j2 AS (SELECT r, sum(coalesce(p * log2(nullif(p, 0) / ((p + q) / 2)), 0) + coalesce(q * log2(nullif(q, 0) / ((p + q) / 2)), 0)) / 2 AS j FROM pq2 GROUP BY r),
far AS (SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed,
               (n_words >= 50 AND coalesce(sqrt(greatest(0, j1.j)) > 0.33, false)) OR (n_words >= 80 AND coalesce(sqrt(greatest(0, j2.j)) > 0.42, false)) AS far
        FROM base LEFT JOIN j1 USING (r) LEFT JOIN j2 USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, failed AS base_failed, NOT failed AND NOT far AS kept
FROM far
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11 = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT row_number() OVER () AS r, lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT r, lang, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w),
runs AS (SELECT lang, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM words WINDOW p AS (PARTITION BY r ORDER BY i)),
grams AS (SELECT lang, 1 AS k, x AS phrase FROM runs UNION ALL SELECT lang, 2, x || ' ' || y FROM runs WHERE y IS NOT NULL
          UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM runs WHERE z IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
longer AS (SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM cand WHERE k = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE k = 3),
most AS (SELECT lang, phrase, max(a) AS b FROM longer GROUP BY ALL),
stay AS (SELECT c.* FROM cand c LEFT JOIN most m ON c.k = 2 AND m.lang = c.lang AND m.phrase = c.phrase WHERE 100 * coalesce(b, 0) < 50 * a),
cuts AS (SELECT lang, k, phrase, a, c, array_to_string(w[:c], ' ') AS x, array_to_string(w[c + 1:], ' ') AS y
         FROM (SELECT *, unnest(range(1, k)) AS c FROM stay)),
scored AS (SELECT cuts.lang, cuts.phrase, a, c, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
           FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
               FROM best JOIN n USING (lang)) WHERE rank <= 2000
"""


def _op12() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ",\n".join(f"({r.rank}, {r.priority}, {quoted(r.label)}, {r.weight}::DOUBLE, [{', '.join(map(quoted, r.keywords))}], {quoted(r.pattern)})"
                       for r in license_scan.rules())
    base = ", ".join(f"({quoted(''.join(f'<{w}>' for w in phrase.split()))}, {quoted(label)})" for phrase, label in license_scan.BASE)
    words = lambda x: f"(length({x}) - length(replace({x}, '<', '')))"
    return rf"""
WITH rules(rank, priority, label, weight, keywords, pattern) AS (VALUES {rules}),
base(phrase, label) AS (VALUES {base}),
docs AS (SELECT row_number() OVER () AS d, doc_id, array_to_string(list_transform({_ITEM}, lambda x: '<' || x || '>'), '') AS chain FROM documents),
matches AS (SELECT d, rank, priority, label, weight, string_split_regex(chain, pattern) AS gaps, regexp_extract_all(chain, pattern) AS hits
            FROM docs JOIN rules ON len(list_filter(keywords, lambda k: contains(chain, k))) > 0 AND regexp_matches(chain, pattern)),
parts AS (SELECT d, rank, priority, label, weight, unnest(list_transform(hits, lambda x: {words('x')})) AS n,
                 unnest(list_transform(gaps[:len(hits)], lambda x: {words('x')})) AS gap, unnest(range(1, len(hits) + 1)) AS i FROM matches),
placed AS (SELECT d, rank, priority, label, weight, n, sum(gap) OVER p + sum(n) OVER p - n AS s
           FROM parts WINDOW p AS (PARTITION BY d, rank ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
spans AS (SELECT d, s, s + n AS e, priority, rank, label, weight FROM placed),
swept AS (SELECT *, max(CASE WHEN priority <= 1 THEN e END) OVER p AS m1, max(CASE WHEN priority <= 2 THEN e END) OVER p AS m2, max(e) OVER p AS m3
          FROM spans WINDOW p AS (PARTITION BY d ORDER BY s, -e, priority, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stay AS (SELECT d, label, weight FROM swept WHERE coalesce(CASE priority WHEN 1 THEN m1 WHEN 2 THEN m2 ELSE m3 END, -1) < e),
words AS (SELECT d, unnest(string_split(replace(chain, '><', '> <'), ' ')) AS w, unnest(range(0, {words('chain')})) AS i FROM docs WHERE chain <> ''),
runs AS (SELECT d, i, w || coalesce(lead(w) OVER p, '') || coalesce(lead(w, 2) OVER p, '') AS three,
                w || coalesce(lead(w) OVER p, '') || coalesce(lead(w, 2) OVER p, '') || coalesce(lead(w, 3) OVER p, '') AS four
         FROM words WINDOW p AS (PARTITION BY d ORDER BY i)),
places AS (SELECT d, i, label FROM runs JOIN base ON three = phrase OR four = phrase),
based AS (SELECT d, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY d),
named AS (SELECT d, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT d, label FROM stay UNION ALL SELECT d, label FROM places) GROUP BY d),
weighed AS (SELECT d, max(weight) AS weight FROM (SELECT d, weight FROM stay UNION ALL SELECT d, {license_scan.VERSIONED} FROM places) GROUP BY d)
SELECT doc_id, {words('chain')}::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(weight, 0)::DOUBLE AS score
FROM docs LEFT JOIN based USING (d) LEFT JOIN named USING (d) LEFT JOIN weighed USING (d)
"""


OP13 = rf"""
WITH runs AS (SELECT id, run, count(*) AS n FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(id || ':' || run)) AS x FROM runs),
sums AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x) + 1, 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384)))) AS h FROM hexed),
typed AS (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM sums),
words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
dels AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n FROM dels a JOIN dels b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
         UNION SELECT dels.word, words.word, words.n FROM dels JOIN words ON d = words.word
         UNION SELECT words.word, dels.word, dels.n FROM dels JOIN words ON d = words.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS most FROM near GROUP BY word),
forms AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * words.n THEN other END AS form, CASE WHEN most >= 2 * words.n THEN most END AS form_n
          FROM words LEFT JOIN best ON best.word = words.word),
walk AS (WITH RECURSIVE w AS (SELECT word, word AS here FROM forms UNION ALL SELECT w.word, f.form FROM w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL) SELECT * FROM w)
SELECT f.word, f.form, walk.here AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN walk ON walk.word = f.word JOIN forms e ON e.word = walk.here AND e.form IS NULL
"""


SQL = {
    "op3_benchmark_decontamination": OP3,
    "op5_chat_formatting": OP5,
    "op9_quality_divergence": OP9,
    "op11_phrase_collocations": OP11,
    "op12_license_scan": _op12(),
    "op13_spelling_variants": OP13,
}
