"""Registered queries of the operators, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from access_spark.llm import alignment, main_text, mixing, near_vectors, neighbours, ngram_join, pieces, ranked_search, repeats, resampling, token_counts, toxicity, url_rules
from access_spark.llm.common import table

#: Model file of the sentencepiece queries, one of the public vocabularies of the machine.
PIECE_MODEL = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> bytes:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op9_source_mix"] = r"""
WITH rows AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':mix')) AS shuffled
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
  FROM sources
), seen AS (
  SELECT *, 3 * source_size / weight AS ratio,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
    coalesce(sum(weight) OVER (ORDER BY 3 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS weight_sum
  FROM placed
), levels AS (
  SELECT *, (total - caps)::DOUBLE / (weight_sum - weights) AS level FROM seen
), common AS (
  SELECT coalesce(arg_min(level, struct_pack(r := ratio, p := place)), 0.0) AS level FROM levels WHERE level <= ratio
), targets AS (
  SELECT p.*, least((3 * source_size)::DOUBLE, c.level * weight) AS target FROM placed p, common c
), queued AS (
  SELECT r.*, t.source_size, t.target, t.place,
    row_number() OVER (ORDER BY r.source NULLS LAST, shuffled, doc_id NULLS FIRST, size) AS n,
    coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY shuffled, doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size AS passed
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, coalesce((k * source_size + passed)::DOUBLE / nullif(target, 0), 0.0) AS finish
  FROM queued, generate_series(0, 2) g(k) WHERE k = 0 OR size > 0
), served AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, n, k ROWS UNBOUNDED PRECEDING) AS queue FROM copies
)
SELECT doc_id, size, source_size, target,
  CAST(sum(CASE WHEN queue <= (SELECT sum(source_size) FROM sources) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM served GROUP BY n, doc_id, size, source_size, target
"""

#: verdict, host and path of the rules of op10
URL_RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)


@query
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


ORACLES["op10_url_filters"] = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM urls
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_MODEL), keep=["doc_id"])


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_MODEL), keep=["doc_id"])


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


@query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op12_ranked_search"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS own FROM documents WHERE text IS NOT NULL
), sized AS (
  SELECT r, doc_id, CAST(len(own) AS BIGINT) AS size, own FROM docs WHERE len(own) > 0
), whole AS (
  SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(size) AS BIGINT) AS all_terms FROM sized
), counted AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(own) AS term FROM sized) GROUP BY r, term
), asked AS (
  SELECT i, item_id, term, CAST(count(*) AS BIGINT) AS times
  FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL)
  GROUP BY i, item_id, term
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM counted GROUP BY term), whole
), scored AS (
  SELECT a.i, a.item_id, s.doc_id, CAST(sum(a.times * (w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (75 + (25 * s.size * all_docs) // all_terms))))) AS BIGINT) AS score
  FROM asked a JOIN counted c ON a.term = c.term JOIN weighed w ON w.term = a.term JOIN sized s ON s.r = c.r, whole
  GROUP BY a.i, a.item_id, s.r, s.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20
"""


#: Byte-level file of op11.
BYTE_MODEL = "byte_bpe_50k.json"


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_MODEL), tokenizer_file(PIECE_MODEL), keep=["doc_id"])
