"""The named queries of these operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.llm import decontamination, embedding_whitening, html_extraction, ngram_jaccard, oracles, quality_classifier, quality_rules, sentencepiece_lattice, sharding, substring_dedup, suffix_dedup, token_alignment, url_filter, word_bpe
from millwatch.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts, the base verdict and the certified verdict."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the probability that its quality label is 1."""
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its 0.9-similar documents, on 3-word shingles."""
    return ngram_jaccard.link(table(spark, sf_dir, "documents"))


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as piece ids, and whether they decode to the text again."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    decoded = sentencepiece_lattice.decode(sentencepiece_lattice.encode(documents))
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", (F.col("decoded") == F.col("text")).alias("restored"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word windows that a smaller document also has."""
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url with the rule or the model's verdict."""
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("score")


@query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that also start elsewhere."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept", "kept_text", "p")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    return html_extraction.extract(table(spark, sf_dir, "pages"))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item whose 5-word shingles it holds to four fifths."""
    return decontamination.found_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the groups and links of its tokens under two tokenizers."""
    aligned = token_alignment.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding projected on the 16 leading components, each of unit variance."""
    return embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the word BPE and decoded again."""
    decoded = word_bpe.decode(word_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    ids = F.array_join("ids", " ")
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


ORACLES["op3_ngram_jaccard"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(words[i:i + 2], ' ')) AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 2) + 1)) AS i FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(r.first, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT x, min(y) AS first FROM reach GROUP BY x) r ON r.x = d.doc_id
"""

ORACLES["op5_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS start, words FROM docs WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, start, md5(array_to_string(words[start:start + 49], ' ')) AS w FROM starts
), firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 50)) AS at FROM windows JOIN firsts USING (w) WHERE doc_id > first
), positions AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS at, unnest(words) AS word FROM docs
), kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.at) AS text, count(*) AS n
  FROM positions p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.at = g.at GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(len(d.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

ORACLES["op10_decontamination"] = r"""
WITH docs AS (
  SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM documents
), items AS (
  SELECT item_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM benchmark
), sized AS (
  SELECT id, words, least(5, len(words)) AS k FROM items WHERE len(words) > 0
), b AS (
  SELECT DISTINCT id, array_to_string(words[i:i + k - 1], ' ') AS s FROM (SELECT id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM sized)
), lengths AS (
  SELECT DISTINCT k FROM sized
), d AS (
  SELECT DISTINCT id, array_to_string(words[i:i + k - 1], ' ') AS s
  FROM (SELECT id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM docs JOIN lengths ON len(words) >= k)
), sizes AS (
  SELECT id, count(*) AS n FROM b GROUP BY id
)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, n AS n_item
FROM d JOIN b USING (s) JOIN sizes ON sizes.id = b.id GROUP BY d.id, b.id, n HAVING count(*) * 100 >= 80 * n
"""

ORACLES["op1_quality_rules"] = oracles.quality_rules()
ORACLES["op6_url_filter"] = oracles.url_filter()
