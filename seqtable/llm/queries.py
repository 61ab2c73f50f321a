"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, hard_negatives, html_text, minhash, mixing, pieces, pii, quality_model, quality_rules, spelling, token_ids, toxicity, url_filter

#: Production parameters. The key of pseudonyms is the setting KEY_SETTING of the session; the one here is for trials,
#: since whoever has the key can undo the pseudonyms.
KEY_SETTING, KEY = "spark.seqtable.pseudonym.key", "trial-key"
SEED = 17
URL_ENTRIES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, KEY)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text in frequency-ranked shards, read back from them: doc_id, start, n_tokens, ids_crc32. Null texts have the end id only."""
    return token_ids.digest(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal values replaced, and how many: doc_id, text, n_replaced. Null texts stay null."""
    return pii.pseudonymise(_table(spark, sf_dir, "documents"), pseudonym_key(spark), found="n_replaced").select("doc_id", "text", "n_replaced")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between vectors of equal label with cosine >= 0.93: vec_id, n_links, component_id, kept. Unusable vectors link with nothing."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.93)


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge dropout and decoded again; ``lossless`` compares the texts."""
    return pieces.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), dropout=0.1, seed=SEED)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars. Null pages have an empty text."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every url: page_id, host, path, rule, verdict. Null urls have empty parts and are allowed."""
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_ENTRIES)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document: the base columns, base_failed, kept, failed_rules. Null texts fail the base check."""
    out = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken, n_taken. Null texts have size 0."""
    return mixing.mix(_table(spark, sf_dir, "documents"), seed=SEED).select("doc_id", "size", "source_size", "target", "taken", "n_taken")


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out: doc_id, held_out, score, predicted."""
    return quality_model.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by 4-word shingles: doc_id, n_shingles, component_id, kept."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart and the frequent form that each stands for: word, form, root, n, n_near, form_n. Null texts have no words."""
    return spelling.group_variants(spelling.counted_words(_table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of other labels just below each positive of the anchors: anchor_id, positive_id, rank, negative_id and both scores."""
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and offending spans of every document, learned from the labels that are not held out: doc_id, held_out, score, predicted, spans."""
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_ids, op2_pseudonyms, op3_embedding_dedup, op4_pieces, op5_html_text, op6_url_filter, op7_quality_rules, op8_mixing, op9_quality_model, op10_minhash, op11_spelling, op12_hard_negatives, op13_toxicity)}


_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_ENTRIES)

_OP3 = """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(m.m, v.vec_id)) AS component_id,
  least(v.vec_id, coalesce(m.m, v.vec_id)) = v.vec_id AS kept
FROM embeddings v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = v.vec_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) m ON m.a = v.vec_id
"""

_OP6 = rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(v, h, p) AS (VALUES {_RULES}),
hits AS (
  SELECT page_id, arg_max(h || p, length(h) + length(p)) AS rule, arg_max(v, length(h) + length(p)) AS v
  FROM named JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT n.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM named n LEFT JOIN hits USING (page_id)
"""

_OP10 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_ AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_ ON least_.a = d.doc_id
"""

#: crc32 of UTF-8 from its 256-row table; words meet by what is left when one letter is taken out, at the same place or not.
_OP11 = r"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, CAST(i AS UINTEGER) FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS UINTEGER)) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
one AS (SELECT doc_id, w, count(*) AS k FROM runs GROUP BY 1, 2),
hashed AS (
  SELECT doc_id, w, k, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UINTEGER), flatten(list_transform(string_split(concat(doc_id, ':', w), ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS UINTEGER)] ELSE [CAST(192 + (unicode(c) >> 6) AS UINTEGER), CAST(128 + (unicode(c) & 63) AS UINTEGER)] END))),
    lambda acc, b: xor(acc >> 8, t[CAST(1 + (xor(acc, b) & 255) AS BIGINT)])), CAST(4294967295 AS UINTEGER)) AS BIGINT) AS h FROM one, crc),
damaged AS (SELECT CASE WHEN h % 31 = 0 AND doc_id IS NOT NULL THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cut AS (
  SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
first AS (SELECT word, n_near, most, (SELECT min(other) FROM near x WHERE x.word = best.word AND x.n = most) AS other FROM best),
forms AS (
  SELECT w.word, CASE WHEN most >= 10 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words w LEFT JOIN first f ON f.word = w.word),
walk(word, root) AS (SELECT word, form FROM forms WHERE form IS NOT NULL UNION SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT f.word, form, coalesce((SELECT arg_max(root, x.n) FROM walk JOIN words x ON x.word = walk.root WHERE walk.word = f.word), f.word) AS root, n, n_near, form_n FROM forms f
"""

_OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, vec_id AS positive_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 80 * p.score AND 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries it can express; the others are tested against brute force, round trips or held-out labels."""
    return {"op3_embedding_dedup": _OP3, "op6_url_filter": _OP6, "op10_minhash": _OP10, "op11_spelling": _OP11, "op12_hard_negatives": _OP12}
