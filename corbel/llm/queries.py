"""One query for each operator, over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corbel.llm import alignment, jaccard, licences, mixing, outliers, packing, rangecoder
from corbel.llm import sharding, snapshots, spelling, tokencount, toxicity, vectors
from corbel.llm.common import read, settle
from corbel.llm.tokens import vocabulary_path

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
TOKEN_LIMIT = 512

GROUPS = ["lang", "source"]

#: Sources are numbered; four domains share them out.
DOMAINS = 4
MIX_WEIGHTS = {
    "domain": {"d0": 1, "d1": 3, "d2": 2, "d3": 2},
    "lang": {"en": 3},
    "source": {"src0": 2, "src5": 3},
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (3, 5), 2, 17


def op1_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as coded blocks in document order, and read back."""
    written = rangecoder.write_ids(
        read(spark, sf_dir, "documents"), vocabulary_path(BYTE_VOCABULARY)
    )
    return rangecoder.read_ids(written).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def domain():
    number = F.regexp_extract("source", r"(\d+)$", 1)
    return F.concat(F.lit("d"), F.nullif(number, F.lit("")).cast("int") % DOMAINS)


def mix_documents(df: DataFrame, epochs: int = MIX_EPOCHS, share=MIX_SHARE) -> DataFrame:
    levels = {"domain": domain(), "lang": F.col("lang"), "source": F.col("source")}
    return mixing.mix(df, levels, MIX_WEIGHTS, share, epochs, MIX_SEED)


def op2_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fifths of all words, mixed by domain, language and source."""
    return mix_documents(read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("mix_domain").alias("domain"),
        "lang",
        "source",
        "epoch",
        "n_tokens",
        "taken_tokens",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.md5("text").alias("text_md5"),
    )


def op3_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts from the tables of counts at every prefix."""
    counted = tokencount.prefix_counts(
        read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path(BYTE_VOCABULARY)
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def pack_documents(df: DataFrame) -> DataFrame:
    return packing.pack(
        df.select("doc_id", "text", "source"), vocabulary_path(WORD_VOCABULARY), F.col("source")
    )


def op4_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 tokens, each with the corpus's mixture of sources."""
    return packed_digest(pack_documents(read(spark, sf_dir, "documents")))


def packed_digest(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op5_vector_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors with cosine 0.9 or more, all against all."""
    return vectors.link_vectors(read(spark, sf_dir, "embeddings"))


def op6_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that no longer one continues, rendered."""
    return snapshots.collapse(read(spark, sf_dir, "conversations"))


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Classifier:
    labels = read(spark, sf_dir, "labels").where(~held_out())
    return toxicity.train(docs.select("doc_id", "text"), labels)


def op7_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from four fifths of the labels."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.classify(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share three quarters of their five-word shingles."""
    return jaccard.group_documents(read(spark, sf_dir, "documents"))


def op9_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules and outliers of each language and source."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", *GROUPS)
    stats = settle(outliers.statistics(docs).drop("text"), "statistics")
    judged = outliers.judge(stats, outliers.estimate(stats, GROUPS), GROUPS)
    return judged.select("doc_id", *outliers.STATISTICS, "base_failed", "kept")


def op10_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal bytes."""
    return sharding.shard(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned by bytes, with the corpus's counts of linked ids."""
    return alignment.align(
        read(spark, sf_dir, "documents").select("doc_id", "text"),
        vocabulary_path(BYTE_VOCABULARY),
        vocabulary_path(PIECE_VOCABULARY),
    )


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return licences.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent spellings one letter away."""
    return spelling.spelling_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_id_files,
        op2_source_mixture,
        op3_prefix_token_counts,
        op4_mixture_packing,
        op5_vector_groups,
        op6_snapshot_collapse,
        op7_ngram_toxicity,
        op8_jaccard_groups,
        op9_robust_outliers,
        op10_histogram_shards,
        op11_token_alignment,
        op12_licence_scan,
        op13_spelling_groups,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Conversations as lists of turns, without those that another one begins with.
SNAPSHOT_SQL = """
WITH turns AS (
  SELECT conv_id, list({r: role, t: "text"} ORDER BY turn NULLS FIRST, role NULLS FIRST, "text" NULLS FIRST) AS l
  FROM conversations GROUP BY conv_id
), prefixes AS (
  SELECT DISTINCT l[1:k] AS p FROM (SELECT l, unnest(range(1, len(l))) AS k FROM turns)
), kept AS (
  SELECT min(conv_id) AS conv_id, l FROM turns WHERE NOT EXISTS (SELECT 1 FROM prefixes WHERE p = l) GROUP BY l
), parts AS (
  SELECT conv_id, l, unnest(range(0, (len(l) - 1) // 512 + 1)) AS segment FROM kept
)
SELECT conv_id, CAST(segment AS BIGINT) AS segment, CAST(len(l) AS BIGINT) AS n_turns,
  array_to_string(list_transform(l[segment * 512 + 1 : segment * 512 + 512],
    lambda x: '<|im_start|>' || coalesce(x.r, 'unknown') || chr(10) || coalesce(x.t, '') || '<|im_end|>' || chr(10)), '')
  AS rendered
FROM parts"""

#: All pairs that share a shingle, and what their links reach.
JACCARD_SQL = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3),
    lambda i: array_to_string(w[i : i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM cut
), each AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n_a, b.n AS n_b, count(*) AS n
  FROM each AS a JOIN each AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM pairs WHERE 100 * n >= 75 * (n_a + n_b - n)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""

ORACLES: dict[str, str] = {
    "op6_snapshot_collapse": SNAPSHOT_SQL,
    "op8_jaccard_groups": JACCARD_SQL,
    "op12_licence_scan": licences.oracle_sql(),
}
