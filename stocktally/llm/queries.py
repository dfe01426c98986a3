"""The registered queries of this folder and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stocktally.llm.common import table
from stocktally.llm.lang_id import identify_language
from stocktally.llm.line_dedup import dedup_lines
from stocktally.llm.line_quality import LineRules, clean_lines
from stocktally.llm.mixing import mix_sources
from stocktally.llm.near_duplicates import near_duplicates
from stocktally.llm.neighbours import nearest
from stocktally.llm.pieces import encode_pieces
from stocktally.llm.quality_knn import classify_quality
from stocktally.llm.sharding import shard_documents
from stocktally.llm.token_alignment import ByteBpe, PieceModel, align_tokenizers
from stocktally.llm.toxicity import score_toxicity
from stocktally.llm.url_filter import filter_urls
from stocktally.llm.whitening import by_component, whiten
from stocktally.session import tune

TOKENIZERS = "/opt/tokenizers"
URL_RULES = [
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
]


def _documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    tune(spark)
    return table(spark, folder, "documents").select("doc_id", *columns)


def op1_line_quality(spark, folder):
    cleaned = clean_lines(_documents(spark, folder, "text"), keep=["doc_id"])
    return cleaned.withColumn("clean_md5", F.md5("clean_text")).drop("clean_text")


def op2_source_mix(spark, folder):
    return mix_sources(_documents(spark, folder, "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark, folder):
    return score_toxicity(_documents(spark, folder, "text"), table(spark, folder, "labels"), keep=["doc_id"])


def op4_near_duplicates(spark, folder):
    return near_duplicates(_documents(spark, folder, "text"))


def op5_quality(spark, folder):
    return classify_quality(_documents(spark, folder, "text"), table(spark, folder, "labels"), keep=["doc_id"])


def op6_nearest_vectors(spark, folder):
    tune(spark)
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_shards(spark, folder):
    placed = shard_documents(_documents(spark, folder, "text"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_url_filter(spark, folder):
    tune(spark)
    judged = filter_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op9_pieces(spark, folder):
    return encode_pieces(_documents(spark, folder, "text"), verify=True, keep=["doc_id"])


def op10_language(spark, folder):
    return identify_language(_documents(spark, folder, "text", "lang"), keep=["doc_id"])


def op11_whitening(spark, folder):
    tune(spark)
    return by_component(whiten(table(spark, folder, "embeddings"), components=8, keep=["vec_id"]), ["vec_id"])


def op12_token_alignment(spark, folder):
    a, b = ByteBpe.read(f"{TOKENIZERS}/byte_bpe_50k.json"), PieceModel.read(f"{TOKENIZERS}/piece_bpe_32k.model")
    return align_tokenizers(_documents(spark, folder, "text"), a, b, digest=True, keep=["doc_id"])


def op13_line_dedup(spark, folder):
    cleaned = dedup_lines(_documents(spark, folder, "text"), keep=["doc_id"])
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def pipeline(spark, folder):
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_line_quality, op2_source_mix, op3_toxicity, op4_near_duplicates, op5_quality, op6_nearest_vectors, op7_shards, op8_url_filter,
    op9_pieces, op10_language, op11_whitening, op12_token_alignment, op13_line_dedup, pipeline,
)}

_LINE = LineRules()
_LIKE = " OR ".join(f"contains(lower(line), '{p}')" for p in _LINE.boilerplate)
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS words FROM documents
), windows AS (
  SELECT r, i, array_to_string(words[i : i + {_LINE.window - 1}], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - {_LINE.window - 2})) AS i FROM texts WHERE len(words) >= {_LINE.window})
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, range({_LINE.window}) t(k) GROUP BY r
), lines AS (
  SELECT r, pos, line, len({_WORDS.format("line")}) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM texts)
), judged AS (
  SELECT r, pos, line, n,
    CASE WHEN seps >= {_LINE.min_separators} AND seps * {_LINE.words_per_separator} >= n THEN 'navigation'
         WHEN {_LIKE} THEN 'boilerplate'
         WHEN NOT regexp_matches(rtrim(line, {_SPACES}), '[.!?:;,"'')\]”»’…]$')
           OR 100 * (length(line) - length(replace(line, '!', ''))) > {_LINE.max_exclaim_percent} * n THEN 'punctuation' END AS rule,
    row_number() OVER (PARTITION BY r, line ORDER BY pos) AS nth
  FROM (SELECT *, len(regexp_extract_all(line, '{_LINE.separators}')) AS seps FROM lines WHERE n > 0)
), summed AS (
  SELECT r, count(*) FILTER (WHERE nth > 1) AS dups,
    coalesce(sum(n) FILTER (WHERE rule = 'punctuation'), 0)::BIGINT AS p, coalesce(sum(n) FILTER (WHERE rule = 'navigation'), 0)::BIGINT AS v,
    coalesce(sum(n) FILTER (WHERE rule = 'boilerplate'), 0)::BIGINT AS b,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE rule IS NULL), '') AS clean
  FROM judged GROUP BY r
), counted AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dups, 0) AS n_dup_lines,
    coalesce(repeats.n, 0) AS n_repeat_words, coalesce(p, 0) AS lost_punctuation, coalesce(v, 0) AS lost_navigation,
    coalesce(b, 0) AS lost_boilerplate, md5(coalesce(clean, '')) AS clean_md5
  FROM texts t LEFT JOIN summed USING (r) LEFT JOIN repeats USING (r)
)
SELECT *, NOT base_failed AND 100 * (lost_punctuation + lost_navigation + lost_boilerplate) <= {_LINE.max_lost_percent} * n_words AS kept
FROM (SELECT *, n_words < {_LINE.min_words} OR 100 * n_repeat_words > {_LINE.max_repeat_percent} * n_words AS base_failed FROM counted)
"""

_OP2 = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM sized GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][turn + 1]::BIGINT AS weight, 3 * source_size AS bound FROM sources
), ordered AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(bound) OVER w, 0) AS remaining, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open,
    row_number() OVER (ORDER BY bound / weight, weight, source NULLS LAST) AS place
  FROM weighted WINDOW w AS (ORDER BY bound / weight, weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), fitting AS (
  SELECT *, bound::DOUBLE >= (weight * remaining)::DOUBLE / open::DOUBLE AS fits FROM ordered
), level AS (
  SELECT remaining, open FROM fitting WHERE fits ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size, n, CASE WHEN fits THEN (weight * level.remaining)::DOUBLE / level.open::DOUBLE ELSE bound::DOUBLE END AS target
  FROM fitting LEFT JOIN level ON TRUE
), spread AS (
  SELECT s.*, source_size, target, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % ceil(n / 2000)::BIGINT AS bucket,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS per,
    ('0x' || substr(md5('0:' || coalesce(s.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY bucket, size, doc_id) AS k FROM spread
)
SELECT doc_id, size, source_size, target, (floor(k * per + shift) - floor((k - 1) * per + shift))::BIGINT * size AS taken FROM placed
"""

_OP4 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM texts WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b, common = x.n AND common = y.n AS equal FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE common >= 0.8 * (x.n + y.n - common) - 1e-9
), reach AS (
  SELECT doc_id, doc_id AS label FROM documents UNION SELECT b, label FROM reach JOIN links ON a = doc_id
), classes AS (
  SELECT doc_id, min(label) AS class_id FROM reach GROUP BY doc_id
), counted AS (
  SELECT a AS doc_id, count(*) AS n_links, count(*) FILTER (WHERE equal) AS copies, min(b) FILTER (WHERE equal) AS first FROM links GROUP BY a
)
SELECT doc_id, class_id, least(doc_id, coalesce(first, doc_id)) AS copy_of, coalesce(copies, 0) + 1 AS n_copies,
  coalesce(n_links, 0) AS n_links, coalesce(n, 0) AS n_shingles
FROM classes LEFT JOIN counted USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

_OP13 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM texts
), keyed AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), often AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3
), judged AS (
  SELECT r, k.doc_id, pos, line, o.key IS NOT NULL AND k.doc_id IS DISTINCT FROM o.last AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""

ORACLE_SQL = {"op1_line_quality": _OP1, "op2_source_mix": _OP2, "op4_near_duplicates": _OP4, "op13_line_dedup": _OP13}
