"""The registered queries of this package, their production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemill.llm.bpe import bpe_digest
from wavemill.llm.chat import prefix_targets, read_back
from wavemill.llm.common import delete_at_exit, scratch_path
from wavemill.llm.embed_dedup import embedding_components
from wavemill.llm.jaccard import jaccard_components
from wavemill.llm.langid import fit_trigrams, fuse_evidence, page_evidence
from wavemill.llm.mixing import mixing_plan, taken_words
from wavemill.llm.negatives import hard_negatives
from wavemill.llm.spelling import spelling_forms, word_counts
from wavemill.llm.token_counts import sentencepiece_vocabulary, word_piece_counts
from wavemill.llm.token_orc import token_offsets, write_token_orc
from wavemill.llm.topk import top_k
from wavemill.llm.toxicity import fit_toxicity, score_toxicity
from wavemill.llm.url_filter import Rule, judge_urls

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece tokens of every document: doc_id, n_words, n_tokens, n_unknown."""
    return word_piece_counts(_table(spark, sf_dir, "documents"), sentencepiece_vocabulary(PIECES))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every 20th vector: query_id, rank, vec_id, score."""
    rows = _table(spark, sf_dir, "embeddings").where(usable_or_zero("embedding"))
    rows = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(64 * x.cast("double"))).alias("vector"))
    return top_k(rows.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), rows, 20)


def usable_or_zero(name: str) -> Column:
    """Whether a vector is there and holds finite numbers only; unlike for a cosine it may be all zero."""
    fine = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(name).isNotNull() & F.coalesce(fine, F.lit(False))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe_digest(_table(spark, sf_dir, "documents"), MULTI_RANKS)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model that learns from four fifths of the labels: doc_id, held_out, score, predicted."""
    docs = _table(spark, sf_dir, "documents")
    scores = score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language from all its evidence: page_id, lang, probability, text_lang, declared, suffix, host."""
    model = fit_trigrams(_table(spark, sf_dir, "documents"))
    found = fuse_evidence(page_evidence(_table(spark, sf_dir, "pages")), model)
    return found.withColumnRenamed("id", "page_id").drop("per_gram")


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as ORC and read back: doc_id, start, n_tokens, ids_crc32."""
    path = scratch_path(spark, "token-orc")
    write_token_orc(_table(spark, sf_dir, "documents"), path, BPE_FILE, end_id=2)
    delete_at_exit(spark, path)
    return token_offsets(spark, path)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a Jaccard similarity of 0.85 on four words: doc_id, n_shingles, component_id."""
    found = jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that imitates the template's marks, formatted and read back. Should the table have a
    conversation -1, its turns and those are one."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return read_back(prefix_targets(turns.unionByName(more)))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of equal labels linked at a cosine of 0.93: vec_id, n_links, component_id, kept."""
    return embedding_components(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the training order takes of every document: doc_id, size, source_size, target, taken, and where it comes first and last."""
    found = taken_words(mixing_plan(_table(spark, sf_dir, "documents")))
    return found.withColumns({c: F.round(c, 9) for c in ("first_position", "last_position")})


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector near its five positives: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score."""
    rows = _table(spark, sf_dir, "embeddings").where(usable_or_zero("embedding"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), moved.alias("label"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vector"))
    return hard_negatives(rows.where("id % 100 = 0"), rows, positives=5, negatives=5, lowest=80, highest=100)


URL_RULES = (Rule("allow", "org"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules and, where none fits, by character models: page_id, host, path, rule, verdict, score, threshold."""
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of seven code points or more with its near words and its form: word, form, root, n, n_near, form_n."""
    return spelling_forms(word_counts(_table(spark, sf_dir, "documents")), ratio=10)


def _level(order: int) -> str:
    """SQL of one order of the URL models, from the order below."""
    p = "(SELECT count(*) FROM g0)"
    gram = f"substr(gram, {5 - order}, {order + 1})"
    smoothed = ", ".join(f"CASE WHEN n_{c} > 0 THEN ({c} + t_{c} * p_{c}) / (n_{c} + t_{c}) ELSE p_{c} END AS q_{c}" for c in "ar")
    stats = ", ".join(f"sum({c}) OVER w AS n_{c}, count(*) FILTER ({c} > 0) OVER w AS t_{c}" for c in "ar")
    below = f"CROSS JOIN (SELECT 1.0::DOUBLE / {p} AS p_a, 1.0::DOUBLE / {p} AS p_r)" if order == 0 else f"JOIN (SELECT gram AS shorter, q_a AS p_a, q_r AS p_r FROM m{order - 1}) ON substr(gram, 2) = shorter"
    return f"""g{order} AS (SELECT {gram} AS gram, sum(a)::DOUBLE AS a, sum(r)::DOUBLE AS r FROM counts GROUP BY 1),
m{order} AS (SELECT gram, {smoothed} FROM (SELECT *, {stats} FROM g{order} WINDOW w AS (PARTITION BY substr(gram, 1, {order}))) {below})"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_token_orc": op6_token_orc,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_chat_format": op8_chat_format,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_url_filter": op12_url_filter,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op2_exact_top_k": """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
  FROM rows q JOIN rows r ON r.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op11_hard_negatives": """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS alike, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.id <> r.id WHERE a.id % 100 = 0),
positive AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
    "op12_url_filter": f"""
WITH cut AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    translate(CASE WHEN contains(url, '://') THEN rest ELSE coalesce(url, '') END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM cut),
ruled AS (
  SELECT *, row_number() OVER () AS k, substr(md5(text), 1, 1) IN ('0', '1', '2') AS held, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM parsed),
labelled AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS fixed FROM ruled),
each AS (SELECT k, held, fixed, substr(repeat(chr(2), 4) || text || chr(3), i, 5) AS gram FROM labelled, unnest(range(1, length(text) + 2)) u(i)),
counts AS (SELECT gram, count(*) FILTER (NOT held AND fixed = 'allow') AS a, count(*) FILTER (NOT held AND fixed = 'block') AS r FROM each GROUP BY 1),
{", ".join(_level(order) for order in range(5))},
scores AS (SELECT k, round(sum(ln(q_a) - ln(q_r)) / count(*), 9) AS score FROM each JOIN m4 USING (gram) GROUP BY 1),
scored AS (SELECT * FROM labelled JOIN scores USING (k)),
steps AS (SELECT floor(score * 64) AS step, count(*) FILTER (fixed = 'allow') AS a, count(*) FILTER (fixed = 'block') AS r FROM scored WHERE held AND fixed IS NOT NULL GROUP BY 1),
tried AS (SELECT * FROM steps UNION ALL SELECT max(step) + 1, 0, 0 FROM steps HAVING count(*) > 0),
gains AS (SELECT step, round((sum(r) OVER w - r) / sum(r) OVER () - (sum(a) OVER w - a) / sum(a) OVER (), 12) AS gain FROM tried WINDOW w AS (ORDER BY step)),
best AS (SELECT coalesce((SELECT step / 64 FROM gains WHERE isfinite(gain) ORDER BY gain DESC, abs(step), step LIMIT 1), 0.0::DOUBLE) AS threshold)
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN score >= threshold THEN 'allow' ELSE 'block' END) AS verdict, score, threshold FROM scored, best""",
    "op13_spelling_variants": """
WITH RECURSIVE poly AS (  -- the table of the crc32, a byte's remainder after eight halvings
  SELECT list(x ORDER BY b) AS t FROM (SELECT b, list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS x FROM (SELECT unnest(range(256)) AS b))),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all("text", '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
coded AS (SELECT run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs),
hashed AS (SELECT run, xor(list_reduce(list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS crc FROM coded, poly),
damaged AS (SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM damaged WHERE length(word) >= 7 GROUP BY 1 HAVING count(*) >= 2),
shorter AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS s FROM words, unnest(range(length(word))) u(i)),
near AS (
  SELECT DISTINCT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.s = b.s AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.s = w.word UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.s = w.word),
best AS (SELECT near.word, count(*) AS n_near, max(n) AS other_n FROM near JOIN words ON other = words.word GROUP BY 1),
ties AS (SELECT near.word, min(other) AS other FROM near JOIN words ON other = words.word JOIN best ON best.word = near.word AND n = other_n GROUP BY 1),
forms AS (SELECT word, CASE WHEN other_n >= 10 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word) LEFT JOIN ties USING (word)),
chain(word, root) AS (SELECT word, word FROM forms UNION SELECT chain.word, form FROM chain JOIN forms ON root = forms.word WHERE form IS NOT NULL),
ends AS (SELECT chain.word, root FROM chain JOIN forms ON root = forms.word WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)""",
    "op7_ngram_jaccard": """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m
  FROM members a JOIN members b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT x, y FROM common WHERE 100 * c >= 85 * (n + m - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low.y, doc_id)) AS component_id
FROM sets LEFT JOIN low ON low.x = doc_id""",
    "op10_mixing": """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS draw FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources),
stopping AS (SELECT *, 3.0::DOUBLE * source_size / weight AS stops FROM weighed),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY stops, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY stops, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM stopping),
share AS (SELECT level AS share FROM levels WHERE level <= stops ORDER BY stops, source NULLS LAST LIMIT 1),
targets AS (SELECT source, source_size, weight, least(3.0::DOUBLE * source_size, weight * share) AS target FROM levels, share),
laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0::DOUBLE AS middle FROM sized),
-- a source's demand is the integral of its weight over training: 1.5 t - t^2 / 2, t, or 0.5 t + t^2 / 2 of its target
shares AS (
  SELECT doc_id, laid.source, size, source_size, target, middle, weight, k, (middle + k * source_size) / target AS met
  FROM laid JOIN targets ON laid.source IS NOT DISTINCT FROM targets.source, range(3) r(k)),
demands AS (SELECT *, CASE weight WHEN 1 THEN 1.5 - sqrt(2.25 - 2 * met) WHEN 2 THEN met ELSE sqrt(0.25 + 2 * met) - 0.5 END AS position FROM shares WHERE size > 0 AND met <= 1),
ordered AS (SELECT *, sum(size) OVER (ORDER BY position, doc_id, middle, k ROWS UNBOUNDED PRECEDING) - size AS start FROM demands),
found AS (
  SELECT source, doc_id, middle, sum(size) AS taken, min(position) AS first_position, max(position) AS last_position, min(start) AS first_start FROM ordered GROUP BY 1, 2, 3)
SELECT laid.doc_id, laid.size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, round(first_position, 9) AS first_position, round(last_position, 9) AS last_position,
  CAST(first_start AS BIGINT) AS first_start
FROM laid JOIN targets ON laid.source IS NOT DISTINCT FROM targets.source LEFT JOIN found
  ON laid.source IS NOT DISTINCT FROM found.source AND laid.doc_id IS NOT DISTINCT FROM found.doc_id AND laid.middle = found.middle AND laid.size > 0""",
    "op9_embedding_dedup": """
WITH RECURSIVE rows AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM rows),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM whole a JOIN whole b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY 1),
degrees AS (SELECT x, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(degrees.n, 0) AS n_links, least(vec_id, coalesce(low.y, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low.y, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON low.x = vec_id LEFT JOIN degrees ON degrees.x = vec_id""",
    "op8_chat_format": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
  SELECT *, length(replace(replace(replace(role, '\\', '\\0'), '<|', '<\\1|'), chr(10), '\\2'))
      + length(replace(replace(text, '\\', '\\0'), '<|', '<\\1|')) + 24 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM turns),
summed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM sized)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY k)) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR k = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id""",
}
