"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, decontaminate, html_extract, jaccard_join, language_id, lm_score, merkle, mixing, pii, resample, suffix_dedup, token_output, toxicity
from .store import bounded_batches


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(_read(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_read(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_read(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.report(_read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_read(spark, sf_dir, "documents"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_read(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_html_extraction, op3_decontamination, op4_lm_scoring, op5_jaccard_join, op6_token_output, op7_mixing, op8_suffix_dedup,
        op9_nearest_neighbours, op10_toxicity, op11_pii, op12_importance_resampling, op13_merkle_manifest
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32 of the bytes of `x` in hex, with the polynomial's table made by its rule.
_TABLE = "(SELECT list(v ORDER BY n) AS crc FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS v FROM (SELECT unnest(range(256)) AS n)))"
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
  lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"""

ORACLES: dict[str, str] = {
    "op3_decontamination": rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
x AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, x.n, item_id FROM x JOIN g ON x.t = g.t AND x.n = g.n),
p AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS t FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN m ON d.doc_id = m.doc_id
""",
    "op5_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS t FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON r.v = e.a WHERE r.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(k.root, d.doc_id)::BIGINT AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT v, min(root) AS root FROM r GROUP BY v) k ON d.doc_id = k.v
""",
    "op7_mixing": r"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
  md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS mark, row_number() OVER () AS key FROM documents),
g AS (SELECT source, sum(size)::BIGINT AS size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s GROUP BY source),
r AS (SELECT *, 3 * size / weight::DOUBLE AS room FROM g),
f AS (SELECT *, (sum(size) OVER () - 3 * coalesce(sum(size) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM r),
t AS (SELECT source, size AS source_size, least(3.0::DOUBLE * size, coalesce((SELECT max(level) FROM f WHERE level <= room), 'inf'::DOUBLE) * weight) AS target FROM f),
w AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
x AS (SELECT *, target - whole * source_size AS rest FROM w),
d AS (SELECT s.doc_id, s.size, s.mark, s.key, x.*, CASE WHEN s.size > 0 AND s.size <= x.rest THEN s.size END AS fits,
  (('0x' || substr(mark, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u FROM s JOIN x ON s.source IS NOT DISTINCT FROM x.source),
z AS (SELECT source, rest, fits, count(*)::HUGEINT AS c FROM d WHERE fits IS NOT NULL GROUP BY source, rest, fits),
y AS (SELECT source, fits, (rest - coalesce(sum(c * fits) OVER (PARTITION BY source ORDER BY fits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / (sum(c * fits * fits) OVER (PARTITION BY source ORDER BY fits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS l FROM z),
k AS (SELECT source, arg_max(l, fits) AS l FROM y WHERE l * fits <= 1 GROUP BY source),
p AS (SELECT d.*, least(coalesce(k.l * size, 1.0::DOUBLE), 1.0::DOUBLE) AS p FROM d LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source),
o AS (SELECT *, CASE WHEN fits IS NULL THEN NULL WHEN p >= 1 THEN 0.0 ELSE (u / (1 - u)) / (p / (1 - p)) END AS q FROM p),
c AS (SELECT *, CASE WHEN q > 0 THEN q / (1 + q) ELSE q END AS rank FROM o),
m AS (SELECT *, CASE WHEN fits IS NOT NULL AND sum(fits) OVER (PARTITION BY source ORDER BY rank, mark, key ROWS UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END AS more FROM c),
n AS (SELECT *, rest - (sum(more * size) OVER (PARTITION BY source))::DOUBLE AS gap FROM m),
e AS (SELECT source, key AS last_key, size AS filled FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(size - gap), coalesce(rank, 1.0), mark, key) AS k FROM n WHERE more = 0 AND size > 0 AND abs(size - gap) < gap) WHERE k = 1),
n2 AS (SELECT n.* REPLACE (gap - filled AS gap) FROM n JOIN e ON n.source IS NOT DISTINCT FROM e.source WHERE key <> last_key),
e2 AS (SELECT key AS last_key FROM (SELECT key, row_number() OVER (PARTITION BY source ORDER BY abs(size - gap), coalesce(rank, 1.0), mark, key) AS k FROM n2 WHERE more = 0 AND size > 0 AND abs(size - gap) < gap) WHERE k = 1),
l AS (SELECT last_key FROM e UNION ALL SELECT last_key FROM e2)
SELECT doc_id, size, source_size, target, ((whole + more + CASE WHEN last_key IS NOT NULL THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM n LEFT JOIN l ON key = last_key
""",
    "op8_suffix_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
n AS (SELECT *, (length(x) // 2)::BIGINT AS n FROM d),
-- a row's bytes in pieces, as a substring is found from the start of its text
q AS (SELECT r, a, substr(x, 2 * a + 1, 2 * 2199) AS y, least(2000, n - a - 199) AS k FROM (SELECT r, x, n, unnest(range(0, greatest(n - 199, 0), 2000)) AS a FROM n)),
s AS (SELECT r, a + i AS i, md5_number(substr(y, 2 * i + 1, 400)) AS h FROM (SELECT r, a, y, unnest(range(0, k)) AS i FROM q)),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS c FROM s) WHERE c > 1),
u AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS f FROM t),
v AS (SELECT r, i, sum(f) OVER (PARTITION BY r ORDER BY i) AS g FROM u),
w AS (SELECT r, g, min(i) AS a, max(i) + 200 AS b FROM v GROUP BY r, g),
z AS (SELECT r, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed FROM w GROUP BY r),
-- what is kept lies before each span, and after the last
p AS (SELECT r, a AS until, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM w UNION ALL SELECT r, NULL, max(b) FROM w GROUP BY r),
k AS (SELECT n.r, string_agg(substr(x, 2 * since + 1, 2 * (coalesce(until, n) - since)), '' ORDER BY since) AS kept FROM p JOIN n ON p.r = n.r GROUP BY n.r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM n LEFT JOIN z ON n.r = z.r LEFT JOIN k ON n.r = k.r
""",
    "op12_importance_resampling": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
e AS (SELECT r, unnest(w) AS f FROM d),
t AS (SELECT unnest(coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])) AS f FROM benchmark),
k AS (SELECT f, {_CRC} % 10000 AS b FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM e UNION SELECT f FROM t)), {_TABLE}),
s AS (SELECT b, count(*) AS s FROM e JOIN k USING (f) GROUP BY b),
u AS (SELECT b, count(*) AS t FROM t JOIN k USING (f) GROUP BY b),
g AS (SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM e) + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM t) + 10000))::DOUBLE))::BIGINT AS gain
      FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN s USING (b) LEFT JOIN u USING (b)),
w AS (SELECT r, sum(gain)::BIGINT AS weight FROM e JOIN k USING (f) JOIN g USING (b) GROUP BY r),
n AS (SELECT d.r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN w ON d.r = w.r),
x AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM n),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank, count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, rank::BIGINT AS rank FROM x LEFT JOIN (SELECT r, rank FROM o WHERE rank <= 10 * n // 100) q ON x.r = q.r
""",
    "op13_merkle_manifest": rf"""
WITH RECURSIVE d AS (SELECT *, {_CRC} % 5 = 0 AS hit FROM (SELECT doc_id, source, lang, n_chars, text, hex(encode(doc_id::VARCHAR)) AS x FROM documents), {_TABLE}),
e AS (SELECT doc_id, source, text, hit, list_reduce([CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END FOR v IN [doc_id::VARCHAR, source, lang, n_chars::VARCHAR]], lambda a, b: a || b) AS head FROM d),
h AS (SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
      sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || CASE WHEN hit THEN {_LOWER} ELSE text END END) AS seen FROM e),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS no FROM h),
tree AS (SELECT no, 0 AS level, list(leaf ORDER BY place) AS nodes FROM l GROUP BY no
  UNION ALL SELECT no, level + 1, list_transform(range(0, (len(nodes) + 15) // 16), lambda i: sha256(array_to_string(nodes[16 * i + 1:16 * i + 16], ''))) FROM tree WHERE len(nodes) > 1),
sub AS (SELECT no, nodes[1] AS subroot FROM tree WHERE len(nodes) = 1),
top AS (SELECT 0 AS level, list(subroot ORDER BY no) AS nodes FROM sub
  UNION ALL SELECT level + 1, list_transform(range(0, (len(nodes) + 15) // 16), lambda i: sha256(array_to_string(nodes[16 * i + 1:16 * i + 16], ''))) FROM top WHERE len(nodes) > 1),
step AS (SELECT l.no, place, level, place >> (4 * level) AS k, nodes FROM l JOIN tree ON l.no = tree.no WHERE len(nodes) > 1
  UNION ALL SELECT no, place, 1000 + level, no >> (4 * level), nodes FROM l, top WHERE len(nodes) > 1),
side AS (SELECT no, place, level, array_to_string(nodes[k // 16 * 16 + 1:k], '') AS a, array_to_string(nodes[k + 2:k // 16 * 16 + 16], '') AS b FROM step),
path AS (SELECT no, place, sha256(string_agg(a || b, '' ORDER BY level)) AS proof, list({{'a': a, 'b': b}} ORDER BY level) AS steps FROM side GROUP BY no, place),
f AS (SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
      list_reduce(list_prepend({{'a': seen, 'b': ''}}, coalesce(steps, [])), lambda x, y: {{'a': sha256(y.a || x.a || y.b), 'b': ''}}).a AS folded_root
      FROM l JOIN sub ON l.no = sub.no LEFT JOIN path p ON p.no = l.no AND p.place = l.place)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f
""",
}
