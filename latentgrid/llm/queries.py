"""The queries of this package: thin uses of its operators on the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latentgrid.llm import bpe, chunkbpe, decontam, embeddings, langid, periodic, pii, quality, secrets, simhash, spelling, tokencount, warc
from latentgrid.llm.common import table
from latentgrid.session import scratch_path


#: Code points of the words whose spellings are grouped.
LEAST_WORD = 7
#: Folder of the public vocabulary files; the driver reads them.
TOKENIZERS = "/opt/tokenizers"


def tokenizer_path(name: str, folder: str = TOKENIZERS) -> str:
    return f"{folder}/{name}"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 4-word SimHash fingerprints link at 4 bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = [k.name for k in pii.BASE]
    base = F.expr(f"filter(pii, s -> s.kind IN ({', '.join(map(repr, names))}))")
    return found.withColumn("base", base).select(
        "doc_id",
        *(F.expr(f"cast(size(filter(base, s -> s.kind = '{n}')) AS bigint)").alias(f"n_{n}") for n in names),
        F.expr(f"sha2({pii.digest('base')}, 256)").alias("base_sha256"),
        F.expr(pii.digest("pii")).alias("spans"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back from the archives."""
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path, least=0)
    return warc.page_records(spark, path).withColumnRenamed("record", "page_id")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    codec = bpe.Codec(spark, tokenizer_path("byte_bpe_50k.json"))
    coded = table(spark, sf_dir, "documents").select("doc_id", codec.encode("text").alias("ids"))
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) DIV 4 AS bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(codec.decode("ids").cast("binary"), 256).alias("decoded_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, as it is or with other numbers and names."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of all documents under a model of those labelled good, and whether it keeps them."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.classify(table(spark, sf_dir, "documents"), good)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, from flat token files written from them."""
    codec = bpe.Codec(spark, tokenizer_path("byte_bpe_50k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", codec.encode("text").alias("ids"))
    path = scratch_path(spark, "tokens")
    tokencount.write_flat(docs.select(tokencount.with_header(F.col("ids"), F.col("doc_id")).alias("value")), path)
    counts = tokencount.token_counts(spark, path, header=tokencount.HEADER)
    return counts.select(F.col("key").alias("doc_id"), "n_tokens")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from those that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = [r.name for r in secrets.BASE]
    base = F.expr(f"filter(secrets, s -> s.kind IN ({', '.join(map(repr, names))}))")
    return found.withColumn("base", base).select(
        "doc_id",
        *(F.expr(f"cast(size(filter(base, s -> s.kind = '{n}')) AS bigint)").alias(f"n_{n}") for n in names),
        F.expr(f"sha2({pii.digest('base')}, 256)").alias("base_sha256"),
        F.expr(pii.digest("secrets")).alias("spans"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all embeddings at a cosine of 0.95 or more."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some occurrences with a letter left out, and the frequent spelling that each is near to."""
    runs = spelling.letter_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), least=LEAST_WORD)
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.select("run", h.alias("h"))
    word = F.expr("if(h % 31 = 0, concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2)), run)")
    words = runs.select(word.alias("word")).where(F.length("word") >= LEAST_WORD)
    return spelling.variants(words.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2"))


def op12_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by a rank file in overlapping chunks, and decoded to bytes."""
    codec = chunkbpe.Codec(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = codec.encode(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) DIV 4 AS bigint)").alias("n_tokens"),
        F.sha2(codec.decimal("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(codec.decode("ids"), 256).alias("decoded_sha256"))


def repeated(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the documents with words that repeat the first ones after a place, both chosen by the id's CRC-32."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(words):
        n = F.size(words)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: words[F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")])
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(again, " "))

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(h % 10 == 0, F.transform(F.array(words), repeat)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, some of which are made to repeat."""
    found = periodic.find_runs(repeated(table(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    every = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(-best.less * 1000) DIV best.period").alias("exponent_milli"),
        F.sha2(every.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {"op1_simhash": op1_simhash, "op2_pii": op2_pii, "op3_warc": op3_warc, "op4_bpe": op4_bpe,
           "op5_decontamination": op5_decontamination, "op6_quality": op6_quality, "op7_token_counts": op7_token_counts,
           "op8_langid": op8_langid, "op9_secrets": op9_secrets,
           "op10_embeddings": op10_embeddings, "op11_spelling": op11_spelling,
           "op12_bytes": op12_bytes, "op13_runs": op13_runs, "pipeline": pipeline}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hex_digits: str) -> str:
    """SQL for the base32 form of 40 hex digits: four letters for each five of them."""
    return " || ".join(
        f"substr('{_BASE32}', CAST(((('0x' || substr({hex_digits}, {k}, 5))::INTEGER >> {bit}) & 31) + 1 AS INTEGER), 1)"
        for k in range(1, 41, 5) for bit in (15, 10, 5, 0))


ORACLES: dict[str, str] = {
    "op3_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
top AS (SELECT h, max(page_id) AS page FROM p GROUP BY h),
d AS (SELECT p.page_id, p.h, top.page, sha1(p.h) AS x FROM p JOIN top USING (h))
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, {_base32("x")} AS payload_digest,
       CASE WHEN page_id = page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> page THEN page END AS refers_to FROM d""",
    "op10_embeddings": """WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
pair AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM reach r JOIN pair p ON p.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pair GROUP BY a)
SELECT v.vec_id, coalesce(links.n, 0) AS n_links, least.component_id, v.vec_id = least.component_id AS kept
FROM v JOIN least ON least.a = v.vec_id LEFT JOIN links ON links.a = v.vec_id""",
}
