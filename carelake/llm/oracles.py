"""DuckDB SQL of the registered queries that SQL can express."""

_WORDS = r"[x FOR x IN regexp_split_to_array({text}, '[\x20\x09-\x0D]+') IF x <> '']"

_OP4 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS g FROM d, unnest(generate_series(1, len(w) - 12)) AS t(i)),
low AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT win.doc_id, i + k AS p FROM win JOIN low USING (g), unnest(generate_series(0, 12)) AS t(k) WHERE m < win.doc_id),
kept AS (SELECT doc_id, i, w[i] AS word FROM d, unnest(generate_series(1, len(w))) AS t(i)
         WHERE (doc_id, i) NOT IN (SELECT (doc_id, p) FROM gone))
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.s, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS s FROM kept GROUP BY doc_id) k USING (doc_id)
"""

_OP10 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS g FROM d, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM pair JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
reach AS (SELECT doc_id AS u, doc_id AS v FROM d UNION SELECT r.u, e.v FROM reach r JOIN edge e ON e.u = r.v)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(reach.v) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.u = d.doc_id GROUP BY 1, 2
"""

_OP3 = """
WITH e AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum([c.v[i] * q.v[i] FOR i IN range(1, len(c.v) + 1)])::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP8 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS g FROM d, unnest(generate_series(1, len(w) - 49)) AS t(i)),
two AS (SELECT g FROM win GROUP BY g HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, i FROM win SEMI JOIN two USING (g)),
edge AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM hit),
run AS (SELECT doc_id, i, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM edge)
SELECT doc_id, (min(i) - 1)::BIGINT AS start_word, (max(i) - min(i) + 50)::BIGINT AS n_words FROM run GROUP BY doc_id, r
"""

# CRC-32 bit by bit; 3988292384 is the polynomial 0xEDB88320
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [get_bit({b}, ((i // 8) * 8 + 7 - i % 8)::INTEGER)::BIGINT
        FOR i IN range(0, bit_length({b}))]), lambda c, x: xor(c >> 1, 3988292384 * (xor(c, x) & 1))))"""
_RUNS = r"""
SELECT {key}, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))],
                                 [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) AS f
FROM (SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})"""

_OP11 = f"""
WITH df AS ({_RUNS.format(key="doc_id", table="documents")}), bf AS ({_RUNS.format(key="item_id", table="benchmark")}),
dn AS (SELECT doc_id, f, count(*) AS n FROM df GROUP BY 1, 2),
bit AS (SELECT f, encode(f)::BIT AS b FROM (SELECT f FROM dn UNION SELECT f FROM bf)),
k AS (SELECT f, {_CRC.format(b="b")} % 10000 AS bucket FROM bit),
s AS (SELECT bucket, sum(n) AS s FROM dn JOIN k USING (f) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN k USING (f) GROUP BY 1),
z AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS t_all),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000) / ((s::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS gain
      FROM s LEFT JOIN t USING (bucket), z),
w AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM dn JOIN k USING (f) JOIN g USING (bucket) GROUP BY 1),
c AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score,
             coalesce(n_features, 0) >= 57 AS fit
      FROM documents LEFT JOIN w USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS rank, 5 * count(*) OVER (PARTITION BY fit) // 100 AS k FROM c)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND rank <= k THEN rank END AS rank FROM r
"""

_OP13 = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
g AS (SELECT lang, list_slice(w, i, i + k - 1) AS g FROM p, unnest(generate_series(1, len(w))) AS s(i), unnest([1, 2, 3, 4]) AS m(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY 1, 2),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY 1),
c AS (SELECT lang, g, f AS a FROM f WHERE f >= 30 AND len(g) > 1),
side AS (SELECT lang, g, a, k, list_slice(g, 1, k) AS lg, list_slice(g, k + 1, len(g)) AS rg FROM c, unnest([1, 2, 3]) AS m(k) WHERE k < len(g)),
often AS (SELECT * FROM f WHERE f >= 30),
cut AS (SELECT s.lang, s.g, s.a, s.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * s.a) // (x.f + y.f))::BIGINT AS score
        FROM side s JOIN often x ON x.lang = s.lang AND x.g = s.lg JOIN often y ON y.lang = s.lang AND y.g = s.rg),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
part AS (SELECT lang, list_slice(g, i, i + k - 1) AS g, max(a) AS longer FROM c, unnest([1, 2, 3]) AS s(i), unnest([2, 3]) AS m(k)
         WHERE k < len(g) AND i + k - 1 <= len(g) GROUP BY 1, 2),
kept AS (SELECT low.*, array_to_string(low.g, ' ') AS phrase FROM low LEFT JOIN part ON part.lang = low.lang AND part.g = low.g
         WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLES = {"op13_phrase_collocations": _OP13, "op11_importance_resampling": _OP11, "op3_topk_search": _OP3, "op4_substring_dedup": _OP4, "op8_suffix_array": _OP8, "op10_jaccard_join": _OP10}
