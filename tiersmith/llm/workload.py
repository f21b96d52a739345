"""The registered queries of this package, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.llm import subword_quality, toxic_segments
from tiersmith.llm.byte_bpe import read_ranks, round_trip
from tiersmith.llm.hash_index import exact_duplicates
from tiersmith.llm.licence_scan import licence_paragraphs
from tiersmith.llm.lm_scores import score_documents
from tiersmith.llm.odd_sketch import near_duplicates
from tiersmith.llm.shard_table import SLOTS, filled_slots, with_shard
from tiersmith.llm.source_mix import mix
from tiersmith.llm.stratified_index import build_index, search
from tiersmith.llm.subword_quality import held_out
from tiersmith.llm.suffix_match import item_automata, match_documents
from tiersmith.llm.token_alignment import link_counts, read_file
from tiersmith.llm.weak_rules import judge_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


@_query
def op8_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents by three-word shingles, 85 % of the union."""
    found = near_duplicates(_documents(spark, sf_dir, "doc_id", "text"), words=3, percent=85)
    return found.selectExpr("doc_id", "n_shingles", "component_id", "doc_id = component_id AS kept")


def _crc_remainder(modulus: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1)) % modulus


@_query
def op10_deleted_interpolation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents, learned from nine tenths of them."""
    remainder = _crc_remainder(10)
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return score_documents(docs, train=remainder != 0, tune=remainder == 1)


@_query
def op5_extendible_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents; the largest doc_id of equal texts stays."""
    found = exact_duplicates(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op5_extendible_hash_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query
def op6_byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all whole texts, and the bytes they decode to."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    ranks = read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return round_trip(docs, ranks, public_tokenizers.PATTERN)


def _training_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    return labels.where(~held_out())


@_query
def op1_subword_embedding_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents, learned from labels of four fifths of them."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    model = subword_quality.learn(docs, _training_labels(spark, sf_dir, "quality"))
    scored = subword_quality.score_documents(docs, model, threshold=0.3)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@_query
def op4_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents, learned from labels of four fifths of them."""
    docs = _documents(spark, sf_dir, "doc_id", "text")
    scorer = toxic_segments.learn(docs, _training_labels(spark, sf_dir, "toxic"))
    scored = toxic_segments.score_documents(docs, scorer)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_passages")


@_query
def op3_weak_supervision_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents, and whether rules weighed without labels keep them."""
    judged = judge_documents(_documents(spark, sf_dir, "doc_id", "text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "posterior")


@_query
def op2_systematic_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of all sources takes."""
    taken = mix(_documents(spark, sf_dir, "doc_id", "source", "text"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op2_systematic_source_mix"] = r"""
WITH sized AS (
    SELECT doc_id, source,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
           (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), placed AS (
    SELECT *, row_number() OVER by_cap AS place, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
           CAST(coalesce(sum(cap) OVER (by_cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS capped,
           CAST(sum(weight) OVER (by_cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS onward
    FROM sources WINDOW by_cap AS (ORDER BY CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE), source ASC NULLS LAST)
), leveled AS (
    SELECT *, (total - capped) / onward AS level FROM placed
), targets AS (
    SELECT source, source_size,
           least(CAST(cap AS DOUBLE),
                 weight * (SELECT level FROM leveled WHERE level * weight <= cap ORDER BY place LIMIT 1)) AS target
    FROM leveled
), rates AS (
    SELECT *, least(CAST(floor(target * CAST(16777216 AS DOUBLE) / nullif(source_size, 0)) AS BIGINT), 3 * 16777216) AS rate,
           CAST('0x' || substr(md5('mix' || coalesce('=' || source, '')), 1, 6) AS BIGINT) AS shift
    FROM targets
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS n FROM sized
)
SELECT r.doc_id, r.size, t.source_size, t.target,
       r.size * ((t.shift + coalesce(t.rate, 0) * r.n) // 16777216 - (t.shift + coalesce(t.rate, 0) * (r.n - 1)) // 16777216) AS taken
FROM ranked r JOIN rates t ON r.source IS NOT DISTINCT FROM t.source
"""

SHARDS = [f"shard-{n:02d}" for n in range(64)]


@_query
def op7_permutation_table_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document."""
    return with_shard(_documents(spark, sf_dir, "doc_id"), SHARDS)


ORACLE["op7_permutation_table_shards"] = f"""
WITH keyed AS (
    SELECT doc_id,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SLOTS} AS slot
    FROM documents
)
SELECT doc_id, slot, printf('shard-%02d', ([{",".join(map(str, filled_slots(SHARDS)))}])[slot + 1]) AS shard FROM keyed
"""


@_query
def op9_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All paragraphs of all documents that hold a licence word, and their licence."""
    return licence_paragraphs(_documents(spark, sf_dir, "doc_id", "text"))


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")


@_query
def op11_length_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of all for every benchmark item."""
    index = build_index(_documents(spark, sf_dir, "doc_id", "text"))
    return search(index, _benchmark(spark, sf_dir), k=20)


ORACLE["op11_length_stratified_search"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT row_number() OVER () AS q, item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), total AS (
    SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM doc WHERE len(w) > 0
), posting AS (
    SELECT r, doc_id, term, CAST(count(*) AS BIGINT) AS tf, 75 + (25 * n * n_docs) // n_terms AS m
    FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM doc), total
    GROUP BY r, doc_id, term, n, n_docs, n_terms
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM posting, total GROUP BY term
), scored AS (
    SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM (SELECT q, item_id, unnest(w) AS term FROM item) JOIN posting USING (term) JOIN weight USING (term)
    GROUP BY q, item_id, r, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS INT) AS rank,
           doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@_query
def op12_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a byte-level and a piece vocabulary align on all whole texts."""
    files = [read_file(spark, public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return link_counts(_documents(spark, sf_dir, "doc_id", "text"), *files)


@_query
def op13_suffix_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents inside ten-word windows of benchmark items."""
    found = match_documents(_documents(spark, sf_dir, "doc_id", "text"), item_automata(_benchmark(spark, sf_dir)))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op13_suffix_automaton_decontamination"] = r"""
WITH item AS (
    SELECT item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), found AS (
    SELECT r, i, size, item_id FROM (
        SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM windows)
        WHERE len(w) >= size
    ) JOIN windows USING (size) WHERE array_to_string(w[i : i + size - 1], ' ') = words
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
