"""SimHash near duplicates: byte-position inverted index, count filter, verification."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import bounded_batches, flat, smallest_labels, written
from latentgrid.llm.graph import components

SEED = 42
BYTES = 8
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
#: Fingerprints of one posting list that meet in one task; longer lists are dealt into tiles.
TILE = 2048


def _pieces(text: bytes):
    """Words of ``text`` in lists of about PIECE bytes; cut at ASCII white space only."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of the XXH64 (seed 42) of the word shingles of a text in UTF-8."""
    text = text.lower()  # of bytes: A-Z only
    ones, total, carry, short = np.zeros(64, np.int64), 0, [], True
    for words in _pieces(text):
        words = carry + words
        if len(words) >= shingle:
            short = False
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = ends - np.fromiter(map(len, words), np.int64, len(words))
            hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED)
                      for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
            bits = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, BYTES)
            for k in range(0, len(bits), 1 << 16):
                ones += np.unpackbits(bits[k:k + (1 << 16)], axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(hashes)
            carry = words[len(words) - shingle + 1:]
        else:
            carry = words
    if short:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED) if carry else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = 4, to: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of the whole text as a signed 64-bit column (null text: 0, as an empty one)."""
    bounded_batches(df.sparkSession)

    @F.arrow_udf("bigint")
    def simhash(column: pa.Array) -> pa.Array:
        data, at = flat(column)
        prints = [fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.array(np.array(prints, np.uint64).view(np.int64))

    return df.withColumn(to, simhash(F.col(text)))


def hex_digits(fingerprint: str) -> F.Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def byte_subsets(need: int, size: int = 3) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions of which each ``need`` positions hold at least one (greedy cover)."""
    open_ = set(combinations(range(BYTES), need))
    out = []
    while open_:
        best = max(combinations(range(BYTES), size), key=lambda s: (sum(set(s) <= set(q) for q in open_), s))
        out.append(best)
        open_ = {q for q in open_ if not set(best) <= set(q)}
    return out


def _links(lists: pa.Array, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the lists, each with the smallest one that it is linked to within this batch."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    prints, node = np.unique(values, return_inverse=True)
    a_all, b_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    left = np.arange(len(values))
    for k in range(1, len(values)):
        left = left[left + k < len(values)]
        left = left[rows[left] == rows[left + k]]
        if not len(left):
            break
        x = values[left] ^ values[left + k]
        tally = (x.view(np.uint8).reshape(-1, BYTES) == 0).sum(1)  # shared positional bytes of each pair
        some = np.flatnonzero(tally >= BYTES - distance)
        some = some[np.bitwise_count(x[some]) <= distance]
        a_all.append(node[left[some]])
        b_all.append(node[left[some] + k])
        if sum(map(len, a_all)) > 1_000_000:  # only what connects them is kept
            lab = smallest_labels(len(prints), np.concatenate(a_all), np.concatenate(b_all))
            a_all, b_all = [np.flatnonzero(lab != np.arange(len(lab)))], [lab[lab != np.arange(len(lab))]]
    lab = smallest_labels(len(prints), np.concatenate(a_all), np.concatenate(b_all))
    far = np.flatnonzero(lab != np.arange(len(lab)))
    return prints[far].view(np.int64), prints[lab[far]].view(np.int64)


def links(prints: DataFrame, distance: int = 4, subset: int = 3) -> DataFrame:
    """Edges ``(a, b)`` that connect all values of ``prints(fingerprint)`` at ``distance`` bits or fewer.

    Two 64-bit values that differ in d bits share at least 8 - d of their 8 positional bytes, and
    so all bytes of one of ``byte_subsets(8 - d)``. Each value is posted under its bytes at these
    positions. The values of one posting list meet in numpy: their shared positional bytes are
    tallied, pairs with at least 8 - d are kept and verified by the count of differing bits. Only
    edges that connect what a batch has found are returned, not all pairs. Lists over TILE values
    are dealt into parts of which each two meet, so no task holds an unbounded list.
    """
    if not 0 <= distance < BYTES:
        raise ValueError("distance must be 0 to 7")
    need = BYTES - distance
    fp = F.col("fingerprint")
    keys = F.array(*(
        F.concat_ws(":", F.lit(str(k)), *(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)) for p in s))
        for k, s in enumerate(byte_subsets(need, min(subset, need)))))
    posted = (prints.where(fp.isNotNull()).select("fingerprint").distinct()
              .select("fingerprint", F.explode(keys).alias("key"))
              .select("fingerprint", F.xxhash64("key").alias("key")))
    posted = written(posted, "postings")
    sizes = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / TILE).cast("int")
    cells = (posted.join(sizes, "key")
             .withColumn("parts", parts)
             .withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0)))
                                            .otherwise(F.expr("filter(sequence(0, parts - 1), q -> q != part)"))))
             .groupBy("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
             .agg(F.collect_list("fingerprint").alias("prints")))

    def meet(batches):
        for batch in batches:
            lists = batch.column(0)
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            long = np.flatnonzero(size > 64)
            for part in [np.flatnonzero(size <= 64), *([k] for k in long)]:
                if len(part):
                    a, b = _links(lists.take(pa.array(part)), distance)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return cells.select("prints").mapInArrow(meet, "a bigint, b bigint").distinct()


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4,
                    distance: int = 4, class_to: str | None = None) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row of ``df``.

    ``class_to`` names a further column with a key of the row's class, which tells classes of one id apart.

    ``fingerprint`` has 16 hex digits. ``component_id`` is the smallest id reachable over
    fingerprints that differ in at most ``distance`` bits, the row's own included. Texts without
    a word (null, empty, white space) have fingerprint zero and are linked like any other;
    repeated rows give repeated rows; rows with a null id are classed, but name a class only if it
    has no other row (component_id null). Only ids and fingerprints are shuffled, never texts.
    """
    own = written(with_fingerprint(df.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), "text", shingle)
                  .select("doc_id", "fingerprint"), "fingerprints")
    prints = written(own.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    roots = written(components(links(prints, distance)), "roots")
    classes = (prints.join(roots, prints.fingerprint == roots.node, "left")
               .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(named, "root").select("fingerprint", "component_id", "root")
    return own.join(named, "fingerprint").select(
        "doc_id", hex_digits("fingerprint").alias("fingerprint"), "component_id",
        *([F.col("root").alias(class_to)] if class_to else []))
