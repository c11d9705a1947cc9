"""The registered queries of this subpackage, each over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.llm import bpe, langid, mixing, pii, quality, ranking, simhash, telephony, topk, toxicity, units, whitening
from gamelake.llm.common import materialise, table


def _shown(spans: str = "removed_spans") -> Column:
    """Offsets as text: start-end, in order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start_char"].cast("string"), s["end_char"].cast("string"))), ",")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose something: their text without it, and its original offsets."""
    docs = units.drop_repeated_passages(table(spark, sf_dir, "documents"), changed_only=True)
    return docs.select("doc_id", "text", F.size("removed_spans").cast("long").alias("n_removed"), _shown().alias("removed_spans"))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 on single lines only: each long line that repeats an earlier one."""
    spans = units.repeated_lines(table(spark, sf_dir, "documents"))
    return spans.select(
        "doc_id", F.col("unit").alias("line_no"), "start_char", "end_char", "n_words", F.lower(F.hex("digest")).alias("digest"), "kept_doc_id", "kept_start_char"
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialise(topk.integer_vectors(table(spark, sf_dir, "embeddings")), "vectors")
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = units.drop_repeated_chunks(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "text", F.size("removed_spans").cast("long").alias("n_removed"), _shown().alias("removed_spans"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), "source")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op6_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The media are written to the shared folder and read back; PCM and features come from what is read."""
    stored = materialise(telephony.store_texts(table(spark, sf_dir, "documents")), "media")
    return telephony.features(telephony.to_pcm(stored))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # beyond 63 bits only the exact column has the value
    return rows.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_email to n_phone and base_sha256 tell the spans of the rules; spans has those of the model, too."""
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs.select("doc_id", "text"), pii.fit(docs)).drop("text")
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("pii", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    many = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    digest = F.sha2(F.array_join(F.transform(base, shown), ","), 256)
    return found.select("doc_id", *many, digest.alias("base_sha256"), F.array_join(F.transform("pii", shown), ",").alias("spans"))


def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, repeated_lines, op2_topk, op3_line_dedup, op4_mixing, op5_toxicity, op6_telephony, op7_langid, op8_bpe, op9_simhash, op10_quality, op11_whitening, op12_pii, op13_ranking)}

#: White space as in units.SPACE, and what is none.
_SPACES = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WHITE, _WORD = f"[{_SPACES}]", f"[^{_SPACES}]"
#: DuckDB SQL for the operators that SQL can express.
ORACLE_SQL = {
    "op1_substring_dedup": rf"""
WITH tokens AS (
  SELECT doc_id, text, regexp_extract_all(text, '{_WHITE}*{_WORD}+') AS ts FROM documents WHERE text IS NOT NULL
), each AS (
  SELECT doc_id, unnest(range(1, len(ts) + 1)) AS i, unnest(ts) AS t FROM tokens
), word AS (
  SELECT doc_id, i, lower(regexp_extract(t, '{_WORD}+$')) AS w, length(regexp_extract(t, '{_WORD}+$')) AS n, contains(regexp_extract(t, '^{_WHITE}*'), chr(10)) AS broken,
         CAST(sum(length(t)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS e FROM each
), pair AS (SELECT *, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM word
), opened AS (
  SELECT *, i = 1 OR broken OR w = p OR right(p, 1) IN ('.', '!', '?', ';', ':')
    OR (17 * unicode(p) + 101 * unicode(right(p, 1)) + 43 * length(p) + 61 * unicode(w) + 31 * unicode(right(w, 1)) + 7 * length(w)) % 2147483648 * 1103515245 % 4294967296 < 536870912 AS opens FROM pair
), line_end AS (SELECT doc_id, i FROM opened WHERE i > 1 AND broken UNION ALL SELECT doc_id, max(i) + 1 FROM opened GROUP BY doc_id
), doc AS (SELECT doc_id, list(w ORDER BY i) AS ws, list(e - n ORDER BY i) AS ss, list(e ORDER BY i) AS es FROM opened GROUP BY doc_id
), edge AS (SELECT doc_id, i FROM opened WHERE opens UNION ALL SELECT doc_id, len(ws) + 1 FROM doc
), run AS (
  SELECT a.doc_id, a.i AS a, z.i AS z FROM edge a ASOF JOIN edge z ON a.doc_id = z.doc_id AND a.i + 20 <= z.i
  UNION SELECT z.doc_id, a.i, z.i FROM line_end z ASOF JOIN edge a ON a.doc_id = z.doc_id AND z.i - 20 >= a.i
), unit AS (SELECT r.doc_id, ss[a] AS s, es[z - 1] AS e, md5(array_to_string(ws[a:z - 1], ' ')) AS digest FROM run r JOIN doc d ON d.doc_id = r.doc_id
), again AS (SELECT DISTINCT doc_id, s, e FROM (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY doc_id, s) AS n FROM unit) WHERE n > 1
), reach AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM again
), joined AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM reach
), span AS (SELECT doc_id, min(s) AS s, max(e) AS e FROM joined GROUP BY doc_id, g
), cut AS (SELECT doc_id, count(*) AS n_removed, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es FROM span GROUP BY doc_id
), kept AS (
  SELECT c.*, length(d.text) AS size, array_to_string(list_transform(range(0, len(ss) + 1), lambda k: substring(d.text, CASE WHEN k = 0 THEN 1 ELSE es[k] + 2 END,
    CASE WHEN k = len(ss) THEN length(d.text) ELSE greatest(0, ss[k + 1] - CASE WHEN k = 0 THEN 0 ELSE es[k] + 1 END) END)), '') AS text
  FROM cut c JOIN documents d ON d.doc_id = c.doc_id
)
SELECT doc_id, CASE WHEN es[len(es)] >= size THEN regexp_replace(text, '\n\z', '') ELSE text END AS text, n_removed,
  array_to_string(list_transform(range(1, len(ss) + 1), lambda k: ss[k] || '-' || es[k]), ',') AS removed_spans
FROM kept""",
    "repeated_lines": r"""
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL
), pos AS (
  SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line,
         unnest(list_transform(range(len(ls)), lambda i: CAST(coalesce(list_sum(list_transform(ls[1:i], lambda x: length(x) + 1)), 0) AS BIGINT))) AS start_char
  FROM lines
), unit AS (
  SELECT doc_id, line_no, start_char, start_char + length(line) AS end_char, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS norm FROM pos
), longer AS (
  SELECT *, len(string_split(norm, ' ')) AS n_words, md5(norm) AS digest FROM unit WHERE len(string_split(norm, ' ')) >= 25
), ranked AS (
  SELECT *, row_number() OVER w AS n, first_value(doc_id) OVER w AS kept_doc_id, first_value(start_char) OVER w AS kept_start_char
  FROM longer WINDOW w AS (PARTITION BY digest ORDER BY doc_id, start_char)
)
SELECT doc_id, CAST(line_no AS INT) AS line_no, CAST(start_char AS INT) AS start_char, CAST(end_char AS INT) AS end_char,
       CAST(n_words AS INT) AS n_words, digest, kept_doc_id, CAST(kept_start_char AS INT) AS kept_start_char
FROM ranked WHERE n > 1""",
    "op2_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op3_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, CAST(i AS INT) AS i, ls[i + 1] AS line, len(ls) AS n,
         CAST('0x' || md5(ls[i + 1])[1:8] AS BIGINT) AS h
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL)
), place AS (
  SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char,
         (h + 31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % 4294967296 AS two
  FROM lines
), seeded AS (
  SELECT place.*, s, CAST(two AS UBIGINT) * CAST(s AS UBIGINT) % 4294967296 AS roll FROM place, (VALUES (1), (2654435761), (2246822519), (3266489917)) AS seeds(s)
), ends AS (
  SELECT *, i = n - 1 OR coalesce(roll < lag(roll) OVER w AND roll <= lead(roll) OVER w, false) AS is_end FROM seeded WINDOW w AS (PARTITION BY s, doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(CAST(is_end AS INT)) OVER (PARTITION BY s, doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM ends
), chunks AS (
  SELECT doc_id, s, chunk, string_agg(line, chr(10) ORDER BY i) AS body, min(i) AS a, max(i) AS z FROM numbered GROUP BY ALL
), around AS (
  SELECT *, coalesce(greatest(0, lag(a) OVER c - 2), a) AS low, coalesce(lead(z) OVER c, z) AS high FROM chunks WINDOW c AS (PARTITION BY doc_id, s ORDER BY chunk)
), units AS (
  SELECT doc_id, a, z, body, min(low) AS low, max(high) AS high FROM around WHERE z > a AND trim(body, ' ' || chr(9) || chr(10) || chr(13)) <> '' GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER f AS n, first_value(doc_id) OVER f AS k_doc, first_value(a) OVER f AS k_a, first_value(z) OVER f AS k_z, first_value(low) OVER f AS k_low, first_value(high) OVER f AS k_high
  FROM units WINDOW f AS (PARTITION BY body ORDER BY doc_id, a)
), found_line AS (
  SELECT DISTINCT doc_id, CAST(unnest(range(a, z + 1)) AS INT) AS i FROM ranked WHERE n > 1
), sides AS (
  SELECT doc_id, a AS edge, k_doc, k_a AS k_edge, -1 AS way, least(a - low, k_a - k_low) AS far FROM ranked WHERE n > 1
  UNION SELECT doc_id, z, k_doc, k_z, 1, least(high - z, k_high - k_z) FROM ranked WHERE n > 1
), steps AS (
  SELECT s.*, unnest(range(1, far + 1)) AS j FROM sides s LEFT JOIN found_line g ON g.doc_id = s.doc_id AND g.i = s.edge + s.way WHERE g.doc_id IS NULL
), same AS (
  SELECT s.*, p.line, bool_and(p.line = q.line) OVER (PARTITION BY s.doc_id, edge, k_doc, k_edge, way, far ORDER BY j) AS alike
  FROM steps s JOIN place p ON p.doc_id = s.doc_id AND p.i = edge + way * j JOIN place q ON q.doc_id = k_doc AND q.i = k_edge + way * j
), longer AS (
  SELECT doc_id, edge, way, max(j) AS m FROM same WHERE alike AND trim(line, ' ' || chr(9) || chr(13)) <> '' GROUP BY ALL
), gone_line AS (
  SELECT doc_id, i FROM found_line UNION SELECT doc_id, CAST(edge + way * unnest(range(1, m + 1)) AS INT) FROM longer
), kept AS (
  SELECT p.doc_id, string_agg(line, chr(10) ORDER BY p.i) AS text FROM place p LEFT JOIN gone_line g ON g.doc_id = p.doc_id AND g.i = p.i WHERE g.doc_id IS NULL GROUP BY p.doc_id
), island AS (
  SELECT doc_id, min(start_char) AS start_char, max(start_char + length(line)) AS end_char
  FROM (SELECT p.*, p.i - row_number() OVER (PARTITION BY p.doc_id ORDER BY p.i) AS g FROM place p JOIN gone_line USING (doc_id, i)) GROUP BY doc_id, g
), gone AS (
  SELECT doc_id, count(*) AS n_removed, string_agg(start_char || '-' || end_char, ',' ORDER BY start_char) AS removed_spans FROM island GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(g.n_removed, 0) AS n_removed, coalesce(g.removed_spans, '') AS removed_spans
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = d.doc_id""",
    "op4_mixing": """
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, CAST((SELECT count(*) FROM documents) AS DOUBLE) * 1.0 / CAST((SELECT count(*) FROM n) AS DOUBLE) / n AS rate FROM n),
parts AS (SELECT source, greatest(1, CAST(ceil(rate / 16.0) AS INT)) AS parts, rate / greatest(1, CAST(ceil(rate / 16.0) AS INT)) AS mean FROM rates),
cdf AS (
  SELECT source, parts, mean, 0 AS k, exp(-mean) AS term, exp(-mean) AS total FROM parts
  UNION ALL
  SELECT source, parts, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1) FROM cdf WHERE k < CAST(mean + 12.0 * sqrt(mean) + 40.0 AS INT)
),
drawn AS (
  SELECT d.doc_id, d.source, j, (CAST('0x' || md5('42:' || CAST(d.doc_id AS VARCHAR) || ':' || CAST(j AS VARCHAR))[1:13] AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents d JOIN parts p ON p.source IS NOT DISTINCT FROM d.source, unnest(range(1, p.parts + 1)) AS t(j)
),
counts AS (
  SELECT doc_id, sum(k) AS times FROM (SELECT w.doc_id, w.j, min(c.k) AS k FROM drawn w JOIN cdf c ON c.source IS NOT DISTINCT FROM w.source AND c.total >= w.u GROUP BY w.doc_id, w.j) GROUP BY doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, CAST(c AS INT) AS copy, md5('42:order:' || CAST(d.doc_id AS VARCHAR) || ':' || CAST(c AS VARCHAR)) AS mix_key
FROM documents d JOIN counts USING (doc_id), unnest(range(1, CAST(times AS BIGINT) + 1)) AS t(c)""",
    "op13_ranking": r"""
WITH dt AS (
  SELECT doc_id, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT *, row_number() OVER () AS r FROM documents)
), tf AS (SELECT doc_id, r, t, count(*) AS tf FROM dt GROUP BY ALL
), size AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r
), tot AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM size
), w AS (SELECT t, CAST(floor(1000 * ln((2.0 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, tot GROUP BY t, big_n
), it AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), part AS (SELECT tf.doc_id, tf.r, tf.t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))) AS c FROM tf JOIN size USING (r) JOIN w USING (t), tot
), scored AS (SELECT item_id, doc_id, r, CAST(sum(c) AS BIGINT) AS score FROM it JOIN part USING (t) GROUP BY item_id, doc_id, r
), ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
