"""The corpus queries: each applies one operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import (decontaminate, hard_negatives, html_text, jaccard_join, line_templates, mixing, neighbours,
                           prefix_trie, quality, simhash, substring, suffixes, warc)
from cardwatch.llm.catalog import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

MIXING_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS HUGEINT) AS w
      FROM d GROUP BY source),
level(n, remaining, share) AS (
  SELECT 0, sum(source_size), sum(w) FROM s
  UNION ALL
  SELECT n + 1,
         (SELECT sum(source_size) - coalesce(sum(3 * source_size) FILTER (WHERE w * remaining > 3 * source_size * share), 0) FROM s),
         (SELECT coalesce(sum(w) FILTER (WHERE w * remaining <= 3 * source_size * share), 0) FROM s)
  FROM level WHERE n < (SELECT count(*) FROM s)),
last AS (SELECT remaining, share FROM level ORDER BY n DESC LIMIT 1),
t AS (SELECT source, source_size, share,
             w * remaining > 3 * source_size * share AS capped,
             CASE WHEN w * remaining > 3 * source_size * share THEN CAST(3 * source_size AS DOUBLE)
                  ELSE CAST(w * remaining AS DOUBLE) / CAST(share AS DOUBLE) END AS target,
             CASE WHEN source_size = 0 THEN 0 WHEN w * remaining > 3 * source_size * share THEN 3
                  ELSE (w * remaining) // (source_size * share) END AS whole,
             CASE WHEN source_size = 0 OR w * remaining > 3 * source_size * share THEN 0
                  ELSE (w * remaining) % (source_size * share) END AS rest
      FROM s, last),
g AS (SELECT source, u, sum(size) AS words FROM d GROUP BY source, u),
m AS (SELECT source, u, 2 * (sum(words) OVER (PARTITION BY source ORDER BY u)) - words AS middle FROM g)
SELECT d.doc_id, d.size, CAST(t.source_size AS BIGINT) AS source_size, t.target,
       CAST(d.size * (t.whole + CASE WHEN t.rest > 0 AND m.middle * t.share <= 2 * t.rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
       JOIN m ON d.source IS NOT DISTINCT FROM m.source AND d.u = m.u
"""


@query("op2_mixing", MIXING_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.n_words("text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
w AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d)),
f AS (SELECT win, min(doc_id) AS least FROM w GROUP BY win),
c AS (SELECT doc_id, list(DISTINCT p + k) AS gone
      FROM (SELECT w.doc_id, w.p, unnest(range(13)) AS k FROM w JOIN f ON w.win = f.win AND w.doc_id > f.least)
      GROUP BY doc_id),
k AS (SELECT d.doc_id, len(ws) AS n_words, len(coalesce(gone, [])) AS n_removed,
             CASE WHEN gone IS NULL THEN ws
                  ELSE [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(gone, i)] END AS kept
      FROM d LEFT JOIN c ON d.doc_id = c.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


@query("op9_substring_dedup", SUBSTRING_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), words=13).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


WARC_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
      FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to, true AS intact
FROM f
"""


@query("op10_warc", WARC_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), usable=~quality.held_out())
    return quality.scored(docs, model).select(
        "doc_id", F.coalesce(quality.held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


LINES_SQL = r"""
WITH p AS (SELECT doc_id, pos, trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')) AS plain,
                  trim(regexp_replace(regexp_replace(raw, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'),
                                      '[\x20\x09-\x0D]+', ' ', 'g')) AS masked
           FROM (SELECT doc_id, unnest(ls) AS raw, unnest(range(len(ls))) AS pos
                 FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
l AS (SELECT doc_id, pos, CASE WHEN 2 * (length(masked) - length(replace(masked, '<*>', ''))) > 3 * len(string_split(masked, ' '))
                               THEN plain ELSE masked END AS line FROM p),
t AS (SELECT *, string_split(line, ' ') AS ws, len(string_split(line, ' ')) AS n,
             array_to_string(string_split(line, ' ')[1:3], ' ') AS lead FROM l WHERE line <> ''),
f0 AS (SELECT t.* FROM t JOIN (SELECT n, lead FROM t WHERE n >= 2 GROUP BY n, lead HAVING count(DISTINCT doc_id) >= 5) x
      ON t.n = x.n AND t.lead = x.lead),
@LEVELS@
r AS (SELECT n, lead, line, min({'d': doc_id, 'p': pos}) AS first FROM f3 GROUP BY n, lead, line
      HAVING count(DISTINCT doc_id) >= 5),
g AS (SELECT doc_id, list(DISTINCT pos) AS gone
      FROM (SELECT f3.doc_id, f3.pos FROM f3 JOIN r ON f3.n = r.n AND f3.lead = r.lead AND f3.line = r.line
            WHERE {'d': f3.doc_id, 'p': f3.pos} <> r.first
            UNION ALL FROM g0 UNION ALL FROM g1 UNION ALL FROM g2) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(g.gone), 0) AS BIGINT) AS n_dropped,
       CASE WHEN g.gone IS NULL THEN d.text
            ELSE coalesce(array_to_string([string_split(d.text, chr(10))[i + 1] FOR i IN range(len(string_split(d.text, chr(10))))
                                           IF NOT list_contains(g.gone, i)], chr(10)), '') END AS text
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""


#: One level of the tree: lines f@ with their leaf, main templates, members, recurring ones, dropped lines, lines left.
LEVEL_SQL = """
a@ AS (SELECT *, BRANCH AS leaf FROM f@),
m@ AS (SELECT n, lead, leaf, string_split(line, ' ') AS main
       FROM (SELECT n, lead, leaf, line, count(DISTINCT doc_id) AS k FROM a@ GROUP BY n, lead, leaf, line)
       QUALIFY row_number() OVER (PARTITION BY n, lead, leaf ORDER BY k DESC, line) = 1),
i@ AS MATERIALIZED (
  SELECT a@.*, a@.n <= 3 OR (list_sum([CASE WHEN ws[i] = main[i] THEN 1 ELSE 0 END FOR i IN range(1, a@.n + 1)]) - 3)
                            / CAST(a@.n - 3 AS DOUBLE) >= 0.7 AS inside
  FROM a@ JOIN m@ ON a@.n = m@.n AND a@.lead = m@.lead AND a@.leaf = m@.leaf),
r@ AS (SELECT n, lead, leaf, min({'d': doc_id, 'p': pos}) AS first FROM i@ WHERE inside GROUP BY n, lead, leaf
       HAVING count(DISTINCT doc_id) >= 5),
p@ AS MATERIALIZED (
  SELECT i@.*, coalesce(inside AND first IS NOT NULL, false) AS member, {'d': doc_id, 'p': pos} = first AS is_first
  FROM i@ LEFT JOIN r@ ON i@.n = r@.n AND i@.lead = r@.lead AND i@.leaf = r@.leaf),
g@ AS (SELECT doc_id, pos FROM p@ WHERE member AND NOT is_first),
fNEXT AS (SELECT doc_id, pos, line, ws, n, lead FROM p@ WHERE NOT member),"""

BRANCHES = ["''", "array_to_string(ws[1:6], ' ')", "array_to_string(ws[greatest(n - 2, 1):n], ' ')"]
LINES_SQL = LINES_SQL.replace("@LEVELS@", "".join(
    LEVEL_SQL.replace("@", str(i)).replace("BRANCH", leaf).replace("NEXT", str(i + 1)) for i, leaf in enumerate(BRANCHES)))


@query("op1_line_templates", LINES_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring(docs)


LEAKS_SQL = r"""
WITH a AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
b AS (SELECT side, id, regexp_extract_all(lower(regexp_replace(regexp_replace(regexp_replace(
               text, '([^.!?\x20\x09-\x0D] )(\p{Lu}\p{Ll}+)', '\1' || chr(1) || '\2', 'g'),
               '([^.!?\x20\x09-\x0D] )(\p{Lu}\p{Ll}+)', '\1' || chr(1) || '\2', 'g'),
               '(^|[^\p{L}\p{N}\x01])(\p{Lu}\p{Ll}+)', '\1' || chr(2) || '\2', 'g')), '[\x01\x02]?[\p{L}\p{N}]+') AS ms FROM a),
c AS (SELECT side, id, [t[1] = chr(2) FOR t IN ms] AS first, [replace(t, chr(2), '') FOR t IN ms] AS ps FROM b WHERE len(ms) >= 5),
k AS (SELECT side, id, first, [replace(t, chr(1), '') FOR t IN ps] AS ws, [(t < ':' OR list_contains([UNITS], t)) FOR t IN ps] AS slot,
             [CASE WHEN t < '0' THEN '<name>' WHEN t < ':' THEN '<number>' WHEN list_contains([UNITS], t) THEN '<unit>' ELSE t END FOR t IN ps] AS ts
      FROM c),
s AS (SELECT DISTINCT least(len(ws), 8) AS n FROM k WHERE side = 'i'),
p AS (SELECT side, id, n, first, ws, slot, ts, unnest(range(1, len(ws) - n + 2)) AS pos FROM k, s
      WHERE len(ws) >= n AND (side = 'd' OR n = 8 OR n = len(ws))),
w AS (SELECT side, id, n, pos, array_to_string(ts[pos:pos + n - 1], ' ') AS tpl, array_to_string(ws[pos:pos + n - 1], ' ') AS own,
             CASE WHEN first[pos] AND n = 8 THEN '<name> ' || array_to_string(ts[pos + 1:pos + n - 1], ' ') END AS second,
             len([x FOR x IN slot[pos:pos + n - 1] IF NOT x]) AS plain FROM p),
f AS (SELECT id, n, pos, tpl AS win, plain * 2 >= n AS tpl, tpl = own AS same FROM w WHERE side = 'i'
      UNION ALL SELECT id, n, pos, own, false, true FROM w WHERE side = 'i' AND tpl <> own
      UNION ALL SELECT id, n, pos, second, (plain - 2) * 2 >= n, false FROM w WHERE side = 'i' AND second IS NOT NULL),
e AS (SELECT DISTINCT id, n, pos, unnest([tpl, own, second]) AS win FROM w WHERE side = 'd'),
h AS (SELECT e.id AS doc_id, f.id AS item_id, e.pos - f.pos AS shift,
             list_distinct(flatten(coalesce(list(range(f.pos, f.pos + f.n)) FILTER (WHERE f.tpl), []))) AS cov,
             list_distinct(flatten(coalesce(list(range(f.pos, f.pos + f.n)) FILTER (WHERE f.same), []))) AS exact
      FROM e JOIN f ON e.n = f.n AND e.win = f.win WHERE f.tpl OR f.same GROUP BY ALL),
q AS (SELECT h.doc_id, h.item_id, cov, exact, len(i.ws) AS n,
             list_distinct([{'i': i.ws[x], 'd': d.ws[x + shift]} FOR x IN cov IF i.slot[x] OR i.first[x]]) AS pairs
      FROM h JOIN k i ON i.side = 'i' AND i.id = h.item_id JOIN k d ON d.side = 'd' AND d.id = h.doc_id),
r AS (SELECT doc_id, item_id, n, list_concat(exact, CASE WHEN len(list_distinct([z.i FOR z IN pairs])) = len(pairs) THEN cov ELSE [] END) AS cov FROM q)
SELECT doc_id, item_id, CAST(len(list_distinct(flatten(list(cov)))) AS BIGINT) AS n_covered, CAST(max(n) AS BIGINT) AS n_item_words
FROM r GROUP BY doc_id, item_id HAVING len(list_distinct(flatten(list(cov)))) >= least(13, max(n))
""".replace("UNITS", ", ".join(f"'{unit}'" for unit in decontaminate.UNITS))


@query("op6_decontaminate", LEAKS_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


JACCARD_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct([array_to_string(ws[i:i + 2], ' ') FOR i IN range(1, len(ws) - 1)])
                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS ss FROM d),
n AS (SELECT doc_id, CAST(len(ss) AS BIGINT) AS n_shingles FROM s),
u AS (SELECT doc_id, unnest(ss) AS sh FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM u a JOIN u b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
      WHERE 100 * k >= 90 * (a.n_shingles + b.n_shingles - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT r.x AS doc_id, any_value(n.n_shingles) AS n_shingles, min(r.y) AS component_id
FROM r JOIN n ON n.doc_id = r.x GROUP BY r.x
"""


@query("op7_jaccard_join", JACCARD_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.grouped(table(spark, sf_dir, "documents"), size=3, share=90)


@query("op3_suffix_array")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(table(spark, sf_dir, "documents"))


@query("op4_html_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extracted(pages, html_text.train(pages)).withColumn("n_chars", F.length("text").cast("bigint"))


@query("op5_nearest")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("_id") % 20 == 0, k=20)


TRIE_SQL = r"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                  sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p,
                  length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'s': said, 'n': n} ORDER BY p) AS ts FROM t GROUP BY c),
k AS (SELECT c, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(ascii(s) AS BIGINT) FOR s IN string_split(CAST(c AS VARCHAR), '')]),
             lambda a, b: list_reduce(list_concat([xor(a, b)], [CAST(i AS BIGINT) FOR i IN range(8)]),
             lambda q, i: CASE WHEN q % 2 = 1 THEN xor(q // 2, 3988292384) ELSE q // 2 END)), 4294967295) % 4 AS h FROM o),
r AS (SELECT o.c, list_concat(coalesce(b.ts[1:k.h], []), o.ts[k.h + 1:]) AS ts
      FROM o JOIN k ON o.c = k.c LEFT JOIN o b ON b.c = o.c - o.c % 20),
x AS (SELECT c, ts, len(ts) AS len, unnest(range(len(ts) + 1)) AS depth FROM r),
n AS (SELECT depth, ts[1:depth] AS path, min(c) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len = depth), '') AS ends
      FROM x GROUP BY depth, ts[1:depth]),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children, p.conv_id AS parent_conv_id,
             CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * n.path[-1].n END AS saved
      FROM n LEFT JOIN (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL) k
             ON n.depth = k.depth AND n.path = k.path
             LEFT JOIN n p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
u AS (SELECT depth, path[1:depth] AS path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
      FROM (SELECT path, unnest(range(depth + 1)) AS depth, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, saved FROM m)
      GROUP BY depth, path[1:depth])
SELECT m.conv_id, m.depth, m.parent_conv_id, m.n_convs, CAST(m.n_children AS BIGINT) AS n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN u ON m.depth = u.depth AND m.path = u.path
"""


@query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("_conv")
    return prefix_trie.trie(table(spark, sf_dir, "conversations"), base=conv - conv % 20,
                            kept=F.crc32(conv.cast("string")) % 4)


NEGATIVES_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
      FROM e a JOIN e ON a.vec_id <> e.vec_id AND len(a.v) = len(e.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.anchor_id = n.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 3
"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("_id") % 50 == 0)


@query("op13_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents"))
