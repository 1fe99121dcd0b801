"""The corpus pipeline: language, near duplicates, contamination, secrets, tokens.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return the columns of ``documents``. ``run`` writes each stage as Parquet to the shared scratch folder and
reads it again as the next one's documents.

Rows with a null id go through every stage like others (they are never taken for the same document). Null
and empty texts are rejected by the first stage, as they have no language. Repeated rows are copies, of which the
second stage keeps one; rows that share an id with other texts are judged each by itself. Extra columns are dropped, empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latentgrid.llm import bpe, decontam, langid, secrets, simhash
from latentgrid.llm.common import bounded_batches, table, written
from latentgrid.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least probability of the language that a document is kept with.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or with no likely language."""
    # five operators in turn share the executors' memory
    bounded_batches(spark, "2m")
    found = langid.identify(docs.select(COLUMNS))
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates: the one with the smallest id, of rows with that id the smallest text.

    A row is judged by its own id and fingerprint: another row with an id that is kept goes if its class has a smaller one.
    """
    docs = docs.select(COLUMNS)
    classes = written(simhash.near_duplicates(docs, shingle=4, distance=4, class_to="class"), "classes")
    first = F.col("doc_id") == F.col("component_id")
    kept = written(classes.where("doc_id IS NOT NULL").groupBy("doc_id")
                   .agg(F.count("*").alias("rows"), F.count_if(first).alias("firsts")).where("firsts > 0"), "kept")
    # the ids are the small side at any size; hashed, they need no sorted texts
    named = docs.where("doc_id IS NOT NULL").join(kept.hint("shuffle_hash"), "doc_id")
    out = named.where("rows = 1").select(COLUMNS)
    # ids that repeat, and rows without one, which stand for a class only if it has no id
    repeated = not kept.where("rows > 1").isEmpty()
    unnamed = not classes.where("doc_id IS NULL").isEmpty()
    if repeated or unnamed:
        open_ = named.where("rows > 1").select(COLUMNS).union(docs.where("doc_id IS NULL"))
        own = simhash.with_fingerprint(open_, "text", 4, "fingerprint").withColumn("fingerprint", simhash.hex_digits("fingerprint"))
        stay = (classes.where(first | (F.col("doc_id").isNull() & F.col("component_id").isNull()))
                .select(F.col("doc_id").alias("id"), F.col("fingerprint").alias("print"), "class").distinct())
        own = own.join(stay, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fingerprint") == F.col("print")))
        one = own.groupBy("doc_id", "class").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("row"))
        out = out.union(one.select("doc_id", "row.*"))
    return out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item; a row is judged by its own text, whatever others share its id."""
    docs = docs.select(COLUMNS)
    key = F.xxhash64("doc_id", "text")
    leaked = written(decontam.contaminated(docs.withColumn("doc_id", key), table(spark, sf_dir, "benchmark"))
                     .select(F.col("doc_id").alias("leaked")), "leaked")
    return docs.join(leaked, key == F.col("leaked"), "left_anti").select(COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace each secret by its kind in brackets; all documents stay."""
    found = secrets.mask_secrets(docs.select(COLUMNS))
    return found.withColumn(
        "n_chars", F.when(F.size("secrets") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, source, n_tokens, token_ids, round_trip)`` of each document; ``round_trip``: decoding gives the text."""
    codec = bpe.Codec(spark, tokenizer_path("byte_bpe_50k.json"))
    coded = docs.select("doc_id", "lang", "source", "text", codec.encode("text").alias("ids"))
    return coded.select(
        "doc_id", "lang", "source", F.expr("cast(octet_length(ids) DIV 4 AS bigint)").alias("n_tokens"),
        codec.array("ids").alias("token_ids"),
        (codec.decode("ids") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_tokens", tokens),
]

#: No stage but the mask of the secret scan can be expressed in SQL; tests/llm compares each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
