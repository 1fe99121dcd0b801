"""WARC archives as tables of chunks.

A payload longer than a chunk is written as the segments that the WARC standard provides for
(``WARC-Segment-Number``, ``continuation`` records), so no writer, reader or digest holds more than
a chunk of a record beside the table cell it came from. One row is one (record, chunk number).

The archives are plain ``.warc`` text written by Spark's own text writer, whose line separator is the
blank line that ends each record; they go wherever Spark can write. Reading splits them at the
start line of the next record, in parallel within a file; a payload never holds that start line,
because chunks are also cut inside it.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latentgrid.llm.common import bounded_batches, flat, written

#: Bytes of payload in a chunk, and so in a WARC record.
CHUNK = 1 << 16
END = "\r\n\r\n"
START = "WARC/1.1\r\n"


def cuts(payload: memoryview, size: int = CHUNK) -> list[int]:
    """Ends of the chunks of ``payload``: every ``size`` bytes, and inside each record start line.

    A chunk follows the blank line of its header: it is also cut inside a start line that it begins with.
    """
    out = list(range(size, len(payload), size))
    out += [m.start() + 8 for m in re.finditer(re.escape(b"\r\n\r\nWARC/1.1"), payload)]
    out += [k + 4 for k in [0, *out] if re.match(rb"(\r\n)?WARC/1\.1", payload[k:k + 10])]
    return sorted({*out, len(payload)})


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(df: DataFrame, id: str, payload: str, uri: str | None = None, size: int = CHUNK) -> DataFrame:
    """``(record, uri, chunk, chunks, bytes, upto, sha1, total, digest)``: the chunks of each payload.

    ``upto`` and ``sha1`` are the length and digest of the payload up to the end of the chunk, carried
    from chunk to chunk; ``total`` and ``digest`` are those of the last one. Payloads are UTF-8; a null
    payload is empty and has one empty chunk.
    """
    def cut(batches):
        for batch in batches:
            data, at = flat(batch.column(2))
            ids, uris = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, held = [], 0
            for k, record in enumerate(ids):
                body = memoryview(data[at[k]:at[k + 1]])
                ends = cuts(body, size)
                digest, marks = hashlib.sha1(), []
                for begin, end in zip([0, *ends], ends):
                    digest.update(body[begin:end])
                    marks.append(b32(digest.digest()))
                for no, (begin, end) in enumerate(zip([0, *ends], ends)):
                    rows.append((record, uris[k], no, len(ends), bytes(body[begin:end]), end, marks[no],
                                 len(body), marks[-1]))
                    held += end - begin + 200
                    if held > BATCH:
                        yield _batch(rows, CHUNKS)
                        rows, held = [], 0
            yield _batch(rows, CHUNKS)

    bounded_batches(df.sparkSession)
    target = F.col(uri).cast("string") if uri else F.lit(None).cast("string")
    return df.select(F.col(id).cast("bigint"), target, F.col(payload).cast("binary")).mapInArrow(
        cut, "record bigint, uri string, chunk int, chunks int, bytes binary, upto bigint, sha1 string, "
             "total bigint, digest string")


#: Bytes of the batches that the tasks hand on.
BATCH = 4 << 20
CHUNKS = pa.schema([("record", pa.int64()), ("uri", pa.string()), ("chunk", pa.int32()), ("chunks", pa.int32()),
                    ("bytes", pa.binary()), ("upto", pa.int64()), ("sha1", pa.string()), ("total", pa.int64()),
                    ("digest", pa.string())])
RECORDS = pa.schema([("record", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.types)], schema=fields)


def revisits(chunks: DataFrame, least: int = 0) -> DataFrame:
    """``(record, digest, total, refers_to)``: records whose payload, of at least ``least`` bytes, is that of a
    larger record, and the largest one. Counted before they meet, so that a payload which a third of
    the records hold is one row of each task."""
    whole = chunks.where("chunk = 0 AND total >= " + str(int(least))).select("record", "digest", "total")
    whole = written(whole, "digests")
    largest = whole.groupBy("digest", "total").agg(F.max("record").alias("refers_to"))
    return (whole.distinct().join(largest, ["digest", "total"])
            .where(F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("record")))
            .select("record", "digest", "total", "refers_to"))


def write_warc(df: DataFrame, path: str, id: str = "page_id", payload: str = "html", uri: str | None = "url",
               least: int = 0, size: int = CHUNK) -> None:
    """Write a WARC record per row of ``df``, ``response`` or ``revisit``, to the folder ``path``.

    Equal payloads of at least ``least`` bytes are stored once, under the largest id. Only ids and
    digests are shuffled, and payloads only where the revisits are too many to be broadcast. Null
    payloads are empty; rows with a null id are written under the id ``null``.
    """
    chunks = chunk_table(df, id, payload, uri, size)
    # written first, so that the planner knows its size when it chooses how to join the payloads
    others = written(revisits(chunk_table(df, id, payload, uri, size), least), "revisits").alias("o")
    c = chunks.alias("c")
    same = F.expr("c.record <=> o.record AND c.digest = o.digest AND c.total = o.total")
    rows = c.join(others, same, "left").where("o.refers_to IS NULL OR c.chunk = 0").select("c.*", "o.refers_to")
    name = F.coalesce(F.col("record").cast("string"), F.lit("null"))
    again = F.col("refers_to").isNotNull()

    def field(key: str, value) -> F.Column:
        return F.concat(F.lit(f"\r\n{key}: "), value)

    def only(when, *parts) -> F.Column:
        return F.when(when, F.concat(*parts)).otherwise("")

    # line breaks and blanks in a URI are escaped, so that a header stays one line
    target = F.regexp_replace(F.regexp_replace(F.coalesce("uri", F.lit("")), r"[\r\n]+", "%0A"), " ", "%20")
    lines = rows.select(F.concat(
        F.lit(START.rstrip()),
        field("WARC-Type", F.when(again, "revisit").when(F.col("chunk") == 0, "response").otherwise("continuation")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), name, F.lit(":"), F.col("chunk"), F.lit(">"))),
        field("WARC-Target-URI", target),
        field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        only(again, field("WARC-Profile", F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(":0>")))),
        only(~again & (F.col("chunks") > 1), field("WARC-Segment-Number", F.col("chunk") + 1)),
        only(F.col("chunk") > 0,
             field("WARC-Segment-Origin-ID", F.concat(F.lit("<urn:page:"), name, F.lit(":0>")))),
        only(~again & (F.col("chunks") > 1) & (F.col("chunk") == F.col("chunks") - 1),
             field("WARC-Segment-Total-Length", F.col("total"))),
        field("Content-Type", F.lit("application/octet-stream")),
        field("Content-Length", F.when(again, F.lit(0)).otherwise(F.octet_length("bytes"))),
        F.lit(END),
        F.when(again, F.lit("")).otherwise(F.col("bytes").cast("string")),
    ).alias("value"))
    lines.write.text(path, lineSep=END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(record, chunk, type, segmented, refers_to, declared, bytes)``: a row per record of such an archive.

    An empty folder gives no rows. Raises if a record is shorter than its Content-Length.
    """
    value = F.when(F.col("value").startswith(START), F.expr(f"substring(value, {len(START) + 1})")).otherwise(F.col("value"))
    rows = (spark.read.text(path, lineSep=END + START).select(value.alias("text"))
            .withColumn("head", F.concat(F.lit("\r\n"), F.substring_index("text", END, 1), F.lit("\r\n"))))

    def field(name: str, pattern: str = "(.*?)") -> F.Column:
        return F.regexp_extract("head", rf"\r\n{name}: {pattern}\r\n", 1)

    # the head has two more bytes in front here, and its blank line has two after those that it ends with
    body = F.expr("substring(cast(text AS binary), cast(octet_length(head) + 1 AS int), cast(size AS int))")
    rows = rows.withColumn("size", field("Content-Length", "([0-9]+)").try_cast("bigint")).withColumn("bytes", body)
    whole = F.when(F.octet_length("bytes") == F.col("size"), F.col("bytes")).otherwise(
        F.raise_error(F.concat(F.lit("damaged WARC record: "), F.col("head"))).cast("binary"))
    return rows.select(
        field("WARC-Record-ID", "<urn:page:(-?[0-9]+):.*?").try_cast("bigint").alias("record"),
        field("WARC-Record-ID", "<urn:page:[^:]*:([0-9]+)>").try_cast("int").alias("chunk"),
        field("WARC-Type").alias("type"), (field("WARC-Segment-Number") != "").alias("segmented"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]+):.*?").try_cast("bigint").alias("refers_to"),
        field("WARC-Payload-Digest", "sha1:(.*?)").alias("declared"), whole.alias("bytes"))


def payload_digests(records: DataFrame) -> DataFrame:
    """``(record, payload_bytes, payload_digest)`` of each response in ``records``, from its bytes.

    The segments of a payload meet by record, in order, and go through a running digest; no payload
    is put together. Records in one piece aren't shuffled.
    """
    def run(batches):
        now, last, digest, size, times = None, -1, None, 0, 0
        for batch in batches:
            done = []
            data, at = flat(batch.column(3))
            for k, (record, key, chunk) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)))):
                if digest is None or chunk == 0 and last != 0 or (record, key) != now:
                    if digest is not None:
                        done += [(now[0], size, b32(digest.digest()))] * times
                    now, last, digest, size, times = (record, key), -1, hashlib.sha1(), 0, 0
                if chunk != last:  # the same chunk once more is that of a repeated row
                    digest.update(memoryview(data[at[k]:at[k + 1]]))
                    size += int(at[k + 1] - at[k])
                times += chunk == 0
                last = chunk
            yield _batch(done, RECORDS)
        if digest is not None:
            yield _batch([(now[0], size, b32(digest.digest()))] * times, RECORDS)

    def each(batches):
        for batch in batches:
            data, at = flat(batch.column(1))
            rows = [(record, int(b - a), b32(hashlib.sha1(memoryview(data[a:b])).digest()))
                    for record, a, b in zip(batch.column(0).to_pylist(), at[:-1], at[1:])]
            yield _batch(rows, RECORDS)

    kind = "record bigint, payload_bytes bigint, payload_digest string"
    alone = records.where("type = 'response' AND NOT segmented").select("record", "bytes").mapInArrow(each, kind)
    parts = (records.where("segmented").repartition("record", "declared")
             .sortWithinPartitions("record", "declared", "chunk"))
    return alone.union(parts.select("record", "declared", "chunk", "bytes").mapInArrow(run, kind))


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """``(record, payload_bytes, payload_digest, record_type, refers_to)`` of each record of an archive,
    revisits with the size and digest of the payload that they refer to.

    Rows that share an id are records of their own; a revisit means the one with its id and its declared digest."""
    records = read_warc(spark, path)
    own = written(payload_digests(records), "payloads")
    again = records.where("type = 'revisit'").select("record", "refers_to", "declared").alias("r")
    there = own.dropDuplicates(["record", "payload_digest"]).alias("o")
    return own.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to")).union(
        again.join(there, F.expr("r.refers_to = o.record AND r.declared = o.payload_digest"), "left")
        .select("r.record", "payload_bytes", "payload_digest", F.lit("revisit"), "r.refers_to"))
