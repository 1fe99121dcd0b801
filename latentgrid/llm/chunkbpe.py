"""Byte-level BPE from a rank file: overlapping chunks, pre-tokens stitched where they resynchronise.

A long text becomes rows of overlapping chunks. Each is split into pre-tokens by itself, as if the text began
there; the first place that is a boundary in a chunk and in the one before it is where both agree from then on,
as a match depends only on the text after its start. The texts between such places are the pieces, encoded in
parallel; chunks without a common boundary (inside one pre-token longer than the overlap) are joined to one piece.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latentgrid.llm.common import bounded_batches, discard, flat, passes, written

#: Code points of a chunk, and of the text that it shares with the next.
CHUNK, OVERLAP = 1 << 14, 256
#: Code points behind a match that can still change it, at most (a contraction's two letters; one after white space).
AHEAD = 4
#: Pre-tokens over so many bytes are merged through a heap and not remembered.
SHORT = 64
#: Pre-tokens whose ids a task remembers.
REMEMBERED = 1 << 17
NONE = np.int64(2**62)


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank (the id) of each token of a file of base64 tokens and ranks; all 256 bytes must be tokens."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    if not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("a single byte is missing from the rank file")
    return ranks


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys ``left << 32 | right`` of all pairs of tokens that join to a token, sorted, and the ranks of those."""
    pairs = {ranks[t[:k]] << 32 | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t))
             if t[:k] in ranks and t[k:] in ranks}
    keys = np.fromiter(pairs, np.int64, len(pairs))
    order = np.argsort(keys)
    return keys[order], np.fromiter(pairs.values(), np.int64, len(pairs))[order]


class Merger:
    """Ids of pre-tokens: the whole one if it is a token, else neighbours joined, lowest rank and then leftmost first."""

    def __init__(self, ranks: dict[bytes, int], keys: np.ndarray, values: np.ndarray):
        self.ranks, self.keys, self.values = ranks, keys, values
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE) if len(self.keys) else np.full(len(key), NONE)

    def _together(self, words: list[bytes]) -> list[bytes]:
        """Many short words at once: each turn joins one pair in every word that still has one."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        part = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        out = [b""] * len(words)
        while len(part):
            rank = np.full(len(part), NONE)
            inner = np.flatnonzero(word[1:] == word[:-1])
            rank[inner] = self._pairs(part[inner], part[inner + 1])
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.minimum.reduceat(rank, begin)
            size = np.diff(np.append(begin, len(part)))
            for k in np.flatnonzero(low == NONE).tolist():
                out[word[begin[k]]] = part[begin[k]:begin[k] + size[k]].astype("<u4").tobytes()
            least = np.repeat(low, size)
            hit = np.flatnonzero((rank == least) & (least != NONE))
            hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])] if len(hit) else hit
            part[hit] = rank[hit]
            keep = least != NONE
            keep[hit + 1] = False
            part, word = part[keep], word[keep]
        return out

    def _alone(self, word: bytes) -> bytes:
        """One long word, its pairs kept in a heap."""
        parts: list[bytes | None] = [word[k:k + 1] for k in range(len(word))]
        right, left, heap = [*range(1, len(word)), -1], [*range(-1, len(word) - 1)], []

        def offer(i: int) -> None:
            if i >= 0 and right[i] >= 0 and (r := self.ranks.get(joined := parts[i] + parts[right[i]])) is not None:
                heapq.heappush(heap, (r, i, len(joined)))

        for i in range(len(word)):
            offer(i)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i] if parts[i] is not None else -1
            if j < 0 or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two has been joined to another since
            parts[i], parts[j], right[i] = parts[i] + parts[j], None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return np.array([self.ranks[p] for p in parts if p is not None], "<u4").tobytes()

    def ids(self, texts: list[list[str]]) -> list[bytes]:
        """Packed ids of texts given as lists of pre-tokens."""
        new = list(set().union(*texts).difference(self.known))
        coded = [w.encode() for w in new]
        several = []
        for k, word in enumerate(coded):
            if (r := self.ranks.get(word)) is not None:
                self.known[new[k]] = r.to_bytes(4, "little")
            elif len(word) > SHORT:
                self.known[new[k]] = self._alone(word)
            else:
                several.append(k)
        if several:
            self.known.update(zip((new[k] for k in several), self._together([coded[k] for k in several])))
        out = [b"".join(map(self.known.__getitem__, words)) for words in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        else:
            for k, word in enumerate(coded):
                if len(word) > SHORT:
                    del self.known[new[k]]
        return out


def _own(words: list[str], size: int) -> list[str]:
    """The pre-tokens of the first ``size`` code points; what follows them was only looked at."""
    total = sum(map(len, words))
    while total > size:
        total -= len(words.pop())
    return words


class Codec:
    """Encoder and decoder for one rank file and one pattern of pre-tokens.

    The pattern's matches must cover every text, without looking behind, and depend on at most AHEAD code points
    after their end. Ids are packed as little-endian unsigned 32-bit integers. There are no special tokens.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        bounded_batches(spark)
        ranks = read_ranks(path)
        self._tables = spark.sparkContext.broadcast((ranks, *pair_table(ranks)))
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            tokens[k] = token
        shared, self._pattern = spark.sparkContext.broadcast(tokens), pattern

        @F.arrow_udf("binary")
        def unpack(column: pa.Array) -> pa.Array:
            tokens, (data, at) = shared.value, flat(column)
            every = pa.array(tokens, pa.large_binary())
            out: list[bytes] = []
            for i, j in passes(at):
                ids = data[at[i]:at[j]].view("<u4")
                if len(ids) and ids.max() >= len(tokens):
                    raise ValueError("an id is not in the vocabulary")
                body, ends = flat(every.take(pa.array(ids)))
                body = body.tobytes()
                upto = ends[(at[i:j + 1] - at[i]) // 4].tolist()
                out += [body[a:b] for a, b in zip(upto, upto[1:])]
            return pa.array(out, pa.binary())

        @F.arrow_udf("string")
        def digits(column: pa.Array) -> pa.Array:
            data, at = flat(column)
            out: list[pa.Array] = [pa.array([], pa.string())]
            for i, j in passes(at):
                ids = pc.cast(pa.array(data[at[i]:at[j]].view("<u4")), pa.string())
                rows = pa.ListArray.from_arrays(pa.array(((at[i:j + 1] - at[i]) // 4).astype(np.int32)), ids)
                out.append(pc.binary_join(rows, ","))
            return pa.concat_arrays(out)

        self._unpack, self._digits = unpack, digits

    def decode(self, packed: Column | str) -> Column:
        """The raw bytes of the ids' tokens, one after another; no ids, no bytes."""
        return self._unpack(packed)

    def decimal(self, packed: Column | str) -> Column:
        """The ids as decimal numbers joined by commas."""
        return self._digits(packed)

    def _coded(self, df: DataFrame) -> DataFrame:
        """``text`` replaced by ``ids``: of its first ``own`` code points, or of all where that is null."""
        tables, pattern = self._tables, self._pattern
        keep = [f for f in df.schema.fields if f.name not in ("text", "own")]

        def run(batches):
            split, merger = regex.compile(pattern).findall, Merger(*tables.value)
            for batch in batches:
                _, at = flat(batch.column("text"))
                own = batch.column("own").to_pylist()
                for i, j in passes(at, 1 << 20):
                    texts = [split(t or "") for t in batch.column("text").slice(i, j - i).to_pylist()]
                    texts = [w if size is None else _own(w, size) for w, size in zip(texts, own[i:j])]
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(f.name).slice(i, j - i) for f in keep), pa.array(merger.ids(texts), pa.binary())],
                        [*(f.name for f in keep), "ids"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
        return df.mapInArrow(run, f"{schema}, ids binary")

    def _chunks(self, long: DataFrame) -> DataFrame:
        """``(row, k, start, size, last, key, text)``: overlapping chunks of long texts, dealt to all tasks."""
        key = long.schema["key"].dataType.simpleString()

        def cut(batches):
            for batch in batches:
                for r in range(batch.num_rows):
                    text = batch.column("text")[r].as_py()
                    starts = [s for s in range(0, len(text), CHUNK) if s == 0 or s + OVERLAP < len(text)]
                    for a in range(0, len(starts), 16):
                        some = starts[a:a + 16]
                        parts = [text[s:s + CHUNK + OVERLAP] for s in some]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("row").take(pa.array([r] * len(some))), pa.array(range(a, a + len(some)), pa.int32()),
                             pa.array(some, pa.int32()), pa.array(map(len, parts), pa.int32()),
                             pa.array([s + len(p) == len(text) for s, p in zip(some, parts)]),
                             batch.column("key").take(pa.array([r] * len(some))), pa.array(parts, pa.string())],
                            ["row", "k", "start", "size", "last", "key", "text"])

        rows = long.select(F.monotonically_increasing_id().alias("row"), "key", "text")
        chunks = rows.mapInArrow(cut, f"row bigint, k int, start int, size int, last boolean, key {key}, text string")
        return written(chunks.repartition("row", "k"), "chunks")

    def _boundaries(self, chunks: DataFrame) -> DataFrame:
        """``(row, k, start, size, head, tail)``: boundaries of a chunk's pre-tokens in what it shares with its neighbours."""
        pattern = self._pattern

        def mark(batches):
            find = regex.compile(pattern).finditer
            for batch in batches:
                heads, tails = [], []
                for text, start, last in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "last"))):
                    sure = len(text) if last else len(text) - AHEAD
                    ends = [0, *(m.end() for m in find(text) if m.end() <= sure)]
                    heads.append([start + e for e in ends if e <= OVERLAP])
                    tails.append([start + e for e in ends if e >= CHUNK])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "k", "start", "size")),
                     pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                    ["row", "k", "start", "size", "head", "tail"])

        return chunks.select("row", "k", "start", "size", "last", "text").mapInArrow(
            mark, "row bigint, k int, start int, size int, head array<int>, tail array<int>")

    def _cuts(self, marks: DataFrame) -> DataFrame:
        """``(row, k, piece, first, until, closed, alone)``: the part of each chunk's text, and the piece that it belongs to.

        A piece begins at the first boundary that a chunk shares with the one before it. ``closed``: the piece ends in this
        chunk; ``alone``: it also begins there.
        """
        w = Window.partitionBy("row").orderBy("k")
        sync = F.when(F.col("k") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect(F.lag("tail").over(w), "head")))
        met = marks.select("row", "k", "start", "size", sync.alias("sync"))
        met = met.withColumns({"piece": F.count("sync").over(w), "next": F.lead("start").over(w), "meets": F.lead("sync").over(w)})
        closed = F.col("next").isNull() | F.col("meets").isNotNull()
        until = F.coalesce("meets", "next", F.col("start") + F.col("size"))
        return met.select("row", "k", "piece", F.coalesce("sync", "start").alias("first"), until.alias("until"),
                          closed.alias("closed"), (closed & F.col("sync").isNotNull()).alias("alone"))

    def _stitched(self, long: DataFrame) -> DataFrame:
        """``(key, ids)`` of long texts."""
        chunks = self._chunks(long)
        if chunks.isEmpty():
            return self._coded(long.withColumn("own", F.lit(None).cast("int")).limit(0))
        cuts = written(self._cuts(self._boundaries(chunks)), "cuts")
        parts = chunks.join(cuts, ["row", "k"]).withColumn("own", F.col("until") - F.col("first")).withColumn(
            "text", F.expr(f"substring(text, first - start + 1, own + if(closed, {AHEAD}, 0))"))
        pieces = self._coded(parts.where("alone").select("row", "piece", "key", "text", "own"))
        if not cuts.where("NOT alone").isEmpty():
            joined = parts.where("NOT alone").groupBy("row", "piece").agg(
                F.any_value("key").alias("key"), F.sort_array(F.collect_list(F.struct("k", "text"))).alias("list"),
                F.sum("own").cast("int").alias("own"))
            pieces = pieces.union(self._coded(joined.select(
                "row", "piece", "key", F.array_join("list.text", "").alias("text"), "own")))
        whole = pieces.groupBy("row").agg(F.any_value("key").alias("key"),
                                          F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("list"))

        @F.arrow_udf("binary")
        def glued(column: pa.Array) -> pa.Array:
            return pa.array([b"".join(row) for row in column.to_pylist()], pa.binary())

        out = written(whole.select("key", glued(F.col("list.ids")).alias("ids")), "long_ids")
        discard(chunks, cuts)
        return out

    def encode(self, df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """``(id, ids)`` for each row of ``df``.

        Null and empty texts have no ids. Rows are on their own: repeated rows, and ids that repeat or are null, give a row
        each; other columns are dropped; an empty table gives an empty one.
        """
        docs = df.select(F.col(id).alias("key"), F.col(text).alias("text"))
        fits = F.coalesce(F.length("text"), F.lit(0)) <= CHUNK
        short = self._coded(docs.where(fits).withColumn("own", F.lit(None).cast("int")))
        return short.union(self._stitched(docs.where(~fits))).select(F.col("key").alias(id), "ids")
