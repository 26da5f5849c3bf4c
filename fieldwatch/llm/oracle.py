"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT t, min(doc_id) AS first FROM x GROUP BY t),
g AS (SELECT DISTINCT x.doc_id, unnest(range(i, i + 13)) AS p FROM x JOIN f USING (t) WHERE first < x.doc_id),
k AS (SELECT d.doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) d
      ANTI JOIN g USING (doc_id, p)),
s AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)""",
    "op6_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS size,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, first(doc_id ORDER BY size DESC, doc_id) AS keep_id FROM d GROUP BY norm)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept,
       sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)""",
    "op10_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, i, k, array_to_string(list_slice(l, i, i + k - 1), chr(10)) AS t
      FROM (SELECT doc_id, l, k, unnest(range(1, len(l) - k + 2)) AS i FROM d, (SELECT unnest([1, 2, 3]) AS k))),
r AS (SELECT doc_id, i, k, row_number() OVER (PARTITION BY k, t ORDER BY doc_id, i) AS n
      FROM x WHERE len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) >= CASE WHEN k = 3 THEN 1 ELSE 8 END),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM r WHERE n > 1),
k AS (SELECT a.doc_id, p, l[p] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS p FROM d) a
      ANTI JOIN g USING (doc_id, p)),
s AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS kept FROM k GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS runs FROM (SELECT doc_id, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step
      FROM g) WHERE step IS NULL OR step > 1 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(runs, 0) AS BIGINT) AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op11_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
e AS (SELECT *, length('<s>[INST][/INST]</s>')
                + length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\2\\\3', 'g'))
                + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\2\\\3', 'g')) AS size FROM c),
u AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR back = 1) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id""",
    "op12_spelling_variants": r"""
WITH RECURSIVE
t AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8),
        lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
      FROM (SELECT unnest(range(256)) AS i))),
r AS (SELECT doc_id, run, length(run) AS size, count(*) AS n
      FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, unnest(regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
      WHERE length(run) >= 6 GROUP BY doc_id, run),
b AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM r),
h AS (SELECT run, size, n, xor(4294967295, list_reduce(
        [4294967295] || list_transform(range(length(x) // 2), lambda i:
            16 * (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) + instr('0123456789ABCDEF', x[2 * i + 2]) - 1),
        lambda a, k: xor(t[1 + (xor(a, k) & 255)], a >> 8))) AS crc FROM b, t),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT CASE WHEN crc % 199 = 0 THEN run[: crc % size] || run[crc % size + 2:] ELSE run END AS word, n FROM h)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
x AS (SELECT word, n, length(word) AS size, unnest(range(1, length(word) + 1)) AS p FROM w),
y AS (SELECT word, n, size, p, word[: p - 1] AS head, word[p + 1:] AS tail FROM x),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM y a JOIN y b USING (size, p, head, tail) WHERE a.word <> b.word
      UNION SELECT y.word, y.n, w.word, w.n FROM y JOIN w ON w.word = head || tail
      UNION SELECT w.word, w.n, y.word, y.n FROM y JOIN w ON w.word = head || tail),
c AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS best, max(near_n) AS best_n FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
             CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n FROM w LEFT JOIN c USING (word)),
g AS (SELECT word, form AS at FROM f WHERE form IS NOT NULL
      UNION ALL SELECT g.word, f.form FROM g JOIN f ON f.word = g.at WHERE f.form IS NOT NULL),
z AS (SELECT g.word, g.at FROM g JOIN f ON f.word = g.at WHERE f.form IS NULL)
SELECT f.word, n, n_near, form, form_n, coalesce(z.at, f.word) AS root FROM f LEFT JOIN z USING (word)""",
    "op13_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, list_slice(w, i, i + k - 1) AS p, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
s AS (SELECT lang, f, p, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2)),
o AS (SELECT lang, list_slice(p, i, i + m - 1) AS p, max(f) AS around FROM s GROUP BY ALL),
c AS (SELECT lang, k, p, f AS a, unnest(range(1, k)) AS cut FROM f LEFT JOIN o USING (lang, p)
      WHERE k > 1 AND (around IS NULL OR 100 * around < 100 * f)),
x AS (SELECT c.lang, c.p, a, cut, h.f AS l, t.f AS r, n.n,
             (1000 * a::HUGEINT * n.n::HUGEINT) // (h.f::HUGEINT * t.f::HUGEINT) AS score
      FROM c JOIN f h ON h.lang = c.lang AND h.p = list_slice(c.p, 1, cut)
             JOIN f t ON t.lang = c.lang AND t.p = list_slice(c.p, cut + 1, c.k) JOIN n ON n.lang = c.lang),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
       array_to_string(p, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM b QUALIFY rank <= 2000""",
}
