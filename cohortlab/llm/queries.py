"""Registered queries of the training-data operators: name -> callable
(spark, sf_dir), and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlab.llm import byte_bpe, decontaminate, html_extract, language_id, line_dedup, merkle, mixing, quality_model, quality_rules, simhash, spelling, toxicity, url_filter
from cohortlab.llm.common import id_remainder, n_words, prepare, table

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT page_id, host, path,
       (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT arg_max(verdict, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM parts
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_duplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.length("text").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


#: Pairs of lines by the number of words they share; lines of a word set are one class with its first place.
OP2_SQL = """
WITH docs AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS line_no FROM docs
), sets AS (
  SELECT doc_id, line_no, line, list_sort(list_distinct(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))) AS toks FROM lines
), classes AS (
  SELECT row_number() OVER () AS c, toks, len(toks) AS n, min((doc_id, line_no)) AS first FROM sets WHERE len(toks) > 0 GROUP BY toks
), tokens AS (
  SELECT c, n, first, unnest(toks) AS tok FROM classes
), near AS (
  SELECT DISTINCT c FROM (
    SELECT a.c AS c, a.n AS na, b.n AS nb, count(*) AS shared FROM tokens a JOIN tokens b
      ON a.tok = b.tok AND b.first < a.first AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY a.c, b.c, a.n, b.n
  ) WHERE 9 * shared >= 4 * (na + nb)
), judged AS (
  SELECT s.doc_id, s.line_no, s.line, len(s.toks) > 0 AND (k.first < (s.doc_id, s.line_no) OR k.c IN (SELECT c FROM near)) AS gone
  FROM sets s LEFT JOIN classes k ON s.toks = k.toks
), kept AS (
  SELECT doc_id, count(*)::INT AS n_lines, (count(*) FILTER (gone))::INT AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT coalesce(gone, false)), '') AS text FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::INT AS n_lines, coalesce(n_removed, 0)::INT AS n_removed, length(text)::INT AS kept_chars, md5(text) AS kept_md5
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder("doc_id", 3) == 1
    model = language_id.fit(docs, ~held_out)
    return language_id.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder("doc_id", 5) == 0
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality_model.score(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _class_sql(pattern: str) -> str:
    return f"(length(t) - length(regexp_replace(t, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g')))"


_CLASS_LIST = ", ".join(map(_class_sql, quality_rules.CLASSES.values()))
_JS = "sqrt(greatest(0, list_sum([CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END FOR z IN list_zip({0}, {1})]) / 2))"
_COMMON = quality_rules.COMMON_WORDS
#: Reference '*' is that of all texts; a language has its own from 1,000 words on.
OP7_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents
), windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d WHERE len(w) >= 3)
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM windows) WHERE k > 1
  ) GROUP BY r
), classes AS (
  SELECT r, lang, [{_CLASS_LIST}] AS c, length(t) AS chars FROM d
), full_classes AS (
  SELECT r, lang, chars, list_append(c, chars - list_sum(c)) AS c FROM classes
), word_counts AS (
  SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM d) GROUP BY lang, word
), langs AS (
  SELECT lang FROM word_counts WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n) >= {quality_rules.MIN_REFERENCE_WORDS}
), keyed AS (
  SELECT r, CASE WHEN lang IN (SELECT lang FROM langs) THEN lang ELSE '*' END AS k FROM d
), ref_words AS (
  SELECT k, word, n, row_number() OVER (PARTITION BY k ORDER BY n DESC, word) AS rank, sum(n) OVER (PARTITION BY k) AS total FROM (
    SELECT lang AS k, word, n FROM word_counts WHERE lang IN (SELECT lang FROM langs)
    UNION ALL SELECT '*', word, sum(n) FROM word_counts GROUP BY word
  )
), ref_common AS (
  SELECT k, list(word ORDER BY rank) AS ws, list_append(list(n / total ORDER BY rank), (any_value(total) - sum(n)) / any_value(total)) AS q, (any_value(total) - sum(n)) / any_value(total) AS rest FROM ref_words WHERE rank <= {_COMMON} GROUP BY k
), ref_classes AS (
  SELECT k, list(s / total ORDER BY i) AS q FROM (
    SELECT k, i, s, sum(s) OVER (PARTITION BY k) AS total FROM (
      SELECT k, i, sum(x) AS s FROM (
        SELECT lang AS k, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM full_classes WHERE lang IN (SELECT lang FROM langs)
        UNION ALL SELECT '*', unnest(c), generate_subscripts(c, 1) FROM full_classes
      ) GROUP BY k, i
    )
  ) GROUP BY k
), drawn AS (
  SELECT d.r, ws, rc.q AS wq, cl.q AS cq,
         (1 - rest + log2(2 / (1 + rest)) + CASE WHEN rest > 0 THEN rest * log2(2 * rest / (1 + rest)) ELSE 0 END) / 2 AS foreign_js, len(w) AS n, [len(list_filter(w, lambda x: x = y)) / len(w) FOR y IN ws] AS p
  FROM d JOIN keyed USING (r) JOIN ref_common rc USING (k) JOIN ref_classes cl USING (k) WHERE len(w) > 0
), distances AS (
  SELECT drawn.r, sqrt({quality_rules.MAX_WORD_SHARE ** 2} * foreign_js + {quality_rules.WORD_CHANCE} / n) AS word_limit, {_JS.format("list_append(p, 1 - list_sum(p))", "wq")} AS word_distance, {_JS.format("[x / chars FOR x IN c]", "cq")} AS class_distance
  FROM drawn JOIN full_classes f ON drawn.r = f.r
), base AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered ON d.r = covered.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND (n_words < {quality_rules.MIN_WORDS_FOR_HISTOGRAM} OR (class_distance <= {quality_rules.MAX_CLASS_DISTANCE} AND word_distance <= word_limit)) AS kept
FROM base LEFT JOIN distances ON base.r = distances.r
"""


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.array_join("items", ",").alias("items"), "containment", (F.size("items") > 0).alias("contaminated"))


OP8_SQL = f"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM benchmark WHERE text IS NOT NULL
), doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents
), item_shingles AS (
  SELECT DISTINCT item_id, w[i : i + 4] AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM item_words WHERE len(w) > 0)
), doc_shingles AS (
  SELECT DISTINCT r, w[i : i + 4] AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM doc_words WHERE len(w) > 0)
), sizes AS (
  SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id
), shares AS (
  SELECT r, item_id, count(*) / any_value(n) AS share FROM doc_shingles JOIN item_shingles USING (s) JOIN sizes USING (item_id) GROUP BY r, item_id
), held AS (
  SELECT r, string_agg(item_id, ',' ORDER BY item_id) AS items, max(share) AS share FROM shares WHERE share >= {decontaminate.CONTAINMENT} GROUP BY r
)
SELECT doc_id, coalesce(items, '') AS items, coalesce(share, 0.0)::DOUBLE AS containment, items IS NOT NULL AS contaminated FROM doc_words LEFT JOIN held ON doc_words.r = held.r
"""


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prepare(spark)
    taken = mixing.with_takes(docs, mixing.mixing_plan(docs)).withColumn("size", n_words(F.col("text")))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


#: Level of the water: sources in order of the level at which they reach their cap; the first level at which the next one is not reached holds.
OP10_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source
), w AS (
  SELECT source, n, 2.0::DOUBLE * n AS cap,
         [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)]::DOUBLE AS weight FROM s
), levels AS (
  SELECT *, cap / weight AS reached,
         sum(cap) OVER (ORDER BY cap / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below,
         sum(weight) OVER (ORDER BY cap / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above FROM w
), water AS (
  SELECT arg_min(lvl, reached) FILTER (lvl < reached) AS level
  FROM (SELECT reached, (1.5::DOUBLE * (SELECT sum(n) FROM w) - coalesce(below, 0)) / above AS lvl FROM levels)
), t AS (
  SELECT source, n, CASE WHEN level IS NULL THEN cap ELSE least(cap, weight * level) END AS target FROM w, water
), p AS (
  SELECT source, n, target, CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END AS whole FROM t
), units AS (
  SELECT source, k, sum(size) AS unit, sum(sum(size)) OVER (PARTITION BY source ORDER BY k) - sum(size) / 2 AS mid FROM d GROUP BY source, k
)
SELECT d.doc_id, d.size, p.n AS source_size, p.target,
       (d.size * (p.whole + CASE WHEN units.mid < p.target - p.whole * p.n THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
JOIN units ON d.source IS NOT DISTINCT FROM units.source AND d.k = units.k
"""

def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    seen = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return merkle.merkle_manifest(docs, observed=seen).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: The table of crc32 by bytes, and crc32 of a list of bytes by it.
CRC_TABLE = "SELECT list(" + "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end ORDER BY i) AS t FROM " + "(SELECT i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end AS c FROM " * 7 + "(SELECT i, i AS c FROM range(256) r(i))" + ")" * 7


def _crc32(byte_list: str) -> str:
    return f"xor(list_reduce({byte_list}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"


def _framed(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


#: Levels of the trees and then the paths, upwards, one step of the recursion a level.
OP11_SQL = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}), d AS (
  SELECT doc_id, lang, sha256({" || ".join(map(_framed, merkle.FIELDS))}) AS leaf,
         sha256({" || ".join(_framed("seen_chars" if f == "n_chars" else f) for f in merkle.FIELDS)}) AS seen
  FROM (SELECT *, CASE WHEN {_crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 7 = 0
                       THEN n_chars + 1 ELSE n_chars END AS seen_chars FROM documents, crc)
), g AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) AS k FROM (SELECT DISTINCT lang FROM d)
), leaves AS (
  SELECT k, doc_id, leaf, seen, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY k) AS total
  FROM d JOIN g ON d.lang IS NOT DISTINCT FROM g.lang
), nodes AS (
  SELECT k, 0 AS lvl, pos, leaf AS node, total FROM leaves
  UNION ALL
  SELECT k, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (total + 1) // 2 FROM nodes WHERE total > 1 GROUP BY k, lvl, pos // 2, total
), tops AS (
  SELECT k - 1 AS pos, node, k, count(*) OVER () AS total FROM nodes WHERE total = 1
), upper AS (
  SELECT 0 AS lvl, pos, node, total FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (total + 1) // 2 FROM upper WHERE total > 1 GROUP BY lvl, pos // 2, total
), walk AS (
  SELECT k, pos AS leaf_pos, lvl, pos, total, seen AS node, '' AS proof FROM (SELECT k, 0 AS lvl, pos, total, seen FROM leaves)
  UNION ALL
  SELECT w.k, leaf_pos, w.lvl + 1, w.pos // 2, (w.total + 1) // 2,
         sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(n.node, '') || w.node ELSE w.node || coalesce(n.node, '') END), proof || coalesce(n.node, '')
  FROM walk w LEFT JOIN nodes n ON n.k = w.k AND n.lvl = w.lvl AND n.pos = xor(w.pos, 1) WHERE w.total > 1
), walk_up AS (
  SELECT w.k, leaf_pos, 0 AS lvl, t.pos, t.total, w.node, w.proof FROM walk w JOIN tops t ON t.k = w.k WHERE w.total = 1
  UNION ALL
  SELECT w.k, leaf_pos, w.lvl + 1, w.pos // 2, (w.total + 1) // 2,
         sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(n.node, '') || w.node ELSE w.node || coalesce(n.node, '') END), proof || coalesce(n.node, '')
  FROM walk_up w LEFT JOIN upper n ON n.lvl = w.lvl AND n.pos = xor(w.pos, 1) WHERE w.total > 1
), root AS (SELECT node AS root FROM upper WHERE total = 1)
SELECT doc_id, leaf, t.node AS subroot, root, sha256(proof) AS proof_sha256, w.node AS folded_root, w.node = root AS verified
FROM leaves l JOIN walk_up w ON w.k = l.k AND w.leaf_pos = l.pos AND w.total = 1 JOIN tops t ON t.k = l.k, root
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), drop_every=199)
    return spelling.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


#: Near words by the word without one code point: two words have it in common at the same place, or it is the other word.
OP12_SQL = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2
), hashed AS (
  SELECT run, n, {_crc32("flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))")} AS h
  FROM runs, crc
), vocabulary AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {spelling.MIN_LENGTH} AND sum(n) >= {spelling.MIN_COUNT}
), cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS k FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, v.word, v.n FROM cut c JOIN vocabulary v ON c.k = v.word
  UNION SELECT v.word, c.word, c.n FROM cut c JOIN vocabulary v ON c.k = v.word
), ranked AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM near
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= {spelling.RATIO} * v.n THEN near END AS form, CASE WHEN near_n >= {spelling.RATIO} * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN (SELECT * FROM ranked WHERE r = 1) x ON v.word = x.word
), chain AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL
  SELECT c.word, f.form, steps + 1 FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word) r ON f.word = r.word
"""


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode_documents(docs, path, pattern).select("doc_id", "n_tokens", "ids")
    coded = byte_bpe.decode_documents(coded, path, pattern)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_language": op4_language,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontaminate": op8_decontaminate,
    "op9_main_text": op9_main_text,
    "op10_mix_sources": op10_mix_sources,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_byte_bpe": op13_byte_bpe,
    "pipeline": corpus_pipeline.run,
}
SQL = {"op1_url_filter": OP1_SQL, "op2_line_dedup": OP2_SQL, "op7_quality_rules": OP7_SQL, "op8_decontaminate": OP8_SQL, "op10_mix_sources": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op12_spelling_variants": OP12_SQL}
