"""Quality by a language model: interpolated modified Kneser-Ney over word pairs, trained on trusted text.

Texts are not shuffled, but read three times by the same tasks. The first time a chunk of texts asks for the counts of its
distinct pairs and hands in those of its trusted texts: a block of sorted 64-bit hashes for each shard, where the
counts of all chunks are added up and answered in the order of the block. One chunk is told to own a pair, so
the second time each pair adds once to the tables of its words, which are asked for in the same way. The third time the
logarithms are added up. No count is dropped and none is gathered on the driver. Words are 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import (PASS_BYTES, bounded_batches, discard, flat, mix, passes, scratch_path, span_hashes, stored,
                                   written)

#: What stands in front of the first and behind the last word of a text.
BEGIN, END = np.uint64(1), np.uint64(2)
#: A key that holds more than one in HOT of all rows is looked up by broadcast; there are fewer than HOT such keys.
HOT = 10_000
PAIR = ["before", "word"]
#: Bytes of text whose pairs are asked for together, by one task. More bytes share more pairs, and take more memory.
CHUNK_BYTES = 3 << 23
#: Pairs that are scored together.
STEP = 1 << 18
#: Shards for each task that reads texts.
SHARDS = 4


def tokens(data: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of each token of concatenated UTF-8 texts; ``fresh`` marks first bytes of texts.

    A token is a run of ASCII letters, digits and other characters, or a run of ASCII signs; A-Z count as a-z.
    """
    white = (data <= 32) | (data == 127)
    low = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    sign = ~white & (data < 128) & ~((data >= 48) & (data <= 57)) & ~((low >= 97) & (low <= 122))
    begin = ~white
    begin[1:] &= white[:-1] | (sign[1:] != sign[:-1]) | fresh[1:len(data)]
    at = np.flatnonzero(begin)
    kept = np.append(0, np.cumsum(~white))
    return at, span_hashes(low[~white].astype(np.uint64) + np.uint64(1), kept[at], kept[np.append(at[1:], len(data))])


def _counted(row: np.ndarray, before: np.ndarray, word: np.ndarray, n: np.ndarray):
    """Equal (row, before, word) as one, with the sum of ``n``."""
    order = np.lexsort((word, before, row))
    row, before, word, n = row[order], before[order], word[order], n[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1]) | (word[1:] != word[:-1])
    first = np.flatnonzero(new)
    return row[first], before[first], word[first], np.add.reduceat(n, first) if len(first) else n


def _short(data: np.ndarray, at: np.ndarray):
    """Counted word pairs of some texts."""
    fresh = np.zeros(len(data) + 1, bool)
    fresh[at] = True
    start, value = tokens(data, fresh)
    row = np.searchsorted(at, start, "right") - 1
    lead = np.ones(len(row), bool)
    lead[1:] = row[1:] != row[:-1]
    ends = np.append(np.flatnonzero(lead)[1:], len(row)) - 1 if len(row) else np.zeros(0, np.int64)
    before = np.where(lead, BEGIN, np.roll(value, 1))
    return _counted(np.concatenate([row, row[ends]]), np.concatenate([before, value[ends]]),
                    np.concatenate([value, np.full(len(ends), END)]), np.ones(len(row) + len(ends), np.int64))


def _long(data: np.ndarray, size: int):
    """Counted word pairs of one text, in parts that end at white space."""
    found, last, begin = [], BEGIN, 0
    while begin < len(data):
        end = begin + size
        while end < len(data):
            gap = np.flatnonzero(data[end:end + size] <= 32)
            end += int(gap[0]) if len(gap) else size
            if len(gap):
                break
        part = data[begin:end]
        value = tokens(part, np.zeros(len(part) + 1, bool))[1]
        if len(value):
            found.append(_counted(np.zeros(len(value), np.int64), np.append(last, value[:-1]), value, np.ones(len(value), np.int64)))
            last = value[-1]
        begin = end
    if found:
        found.append((np.zeros(1, np.int64), np.array([last]), np.array([END]), np.ones(1, np.int64)))
        return _counted(*map(np.concatenate, zip(*found)))
    return _short(data[:0], np.zeros(2, np.int64))


def pairs(column: pa.Array, size: int = PASS_BYTES):
    """(row, before, word, n) of the word pairs of whole texts, for some rows at once."""
    data, at = flat(column)
    for i, j in passes(at, size):
        body = data[at[i]:at[j]]
        row, before, word, n = _short(body, at[i:j + 1] - at[i]) if len(body) <= size else _long(body, size)
        yield row + i, before, word, n


def pair_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``(before, word, n)``: counts of the word pairs of all texts; each task adds up what it reads together."""
    def count(batches):
        for batch in batches:
            for row, before, word, n in pairs(batch.column(0)):
                _, before, word, n = _counted(np.zeros_like(row), before, word, n)
                yield pa.RecordBatch.from_arrays([pa.array(before.view(np.int64)), pa.array(word.view(np.int64)), pa.array(n)],
                                                 [*PAIR, "n"])

    return (df.select(text).mapInArrow(count, "before bigint, word bigint, n bigint")
            .groupBy(*PAIR).agg(F.sum("n").alias("n")))


def lookup(rows: DataFrame, found: DataFrame, keys: list[str], sizes: DataFrame) -> DataFrame:
    """Left join of ``rows`` with ``found``, which has each key once; ``sizes``: ``(*keys, rows)``.

    Keys with more than one in HOT of all rows, fewer than HOT, are broadcast with what is found for them; only the
    others meet ``found`` in one task a key. ``rows`` is evaluated once.
    """
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    values = [c for c in found.columns if c not in keys]
    often = written(sizes.where(F.col("rows") * HOT > total).select(*keys), "often")
    known = found.join(F.broadcast(often), keys)
    hot = written(often.join(F.broadcast(known), keys, "left").select(*keys, F.struct(*values).alias("known")), "hot")
    # rows of hot keys are spread by a column in which nothing matches them; pmod(_, 1) is 0, but not folded
    spread = F.when(F.col("known").isNotNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)) + 1).otherwise(F.lit(0))
    return (rows.join(F.broadcast(hot), keys, "left").withColumn("spread", spread.cast("bigint"))
            .join(found.withColumn("spread", F.pmod(F.xxhash64(*keys), F.lit(1)).cast("bigint")), [*keys, "spread"], "left")
            .select(*rows.columns, *(F.when(F.col("known").isNotNull(), F.col(f"known.{v}")).otherwise(F.col(v)).alias(v)
                                     for v in values)))


def _discounts(n: list[int]) -> list[float]:
    """Discounts of n-grams seen once, twice, and more often, by the numbers of n-grams seen 1 to 4 times."""
    if not all(n):
        return [0.5, 0.75, 0.9]  # too few texts for the estimate
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.01), k) for k in (1, 2, 3)]


def _times(counts: DataFrame) -> list[int]:
    """How many n-grams were seen once, twice, 3 and 4 times."""
    return list(counts.agg(*(F.count_if(F.col("n") == k) for k in (1, 2, 3, 4))).first())


def _cut(n: Column, d: list[float]) -> Column:
    return F.when(n <= 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


class Model:
    """A model of trusted texts. It scores texts, and has tables to look up word pairs that come without a text.

    ``two`` (before, word, n), ``left`` (before, total, gamma), ``one`` (word, p) are made when first used.
    ``unseen`` is the probability of each word that the trusted texts don't have, taken as one more word.
    """

    def __init__(self, trusted: DataFrame, text: str = "text"):
        self.trusted = trusted.select(F.col(text).alias("text"))

    @functools.cached_property
    def two(self) -> DataFrame:
        return written(pair_counts(self.trusted), "pairs")

    @functools.cached_property
    def discounts(self) -> list[float]:
        return _discounts(_times(self.two))

    @functools.cached_property
    def left(self) -> DataFrame:
        return written(self.two.groupBy("before").agg(
            F.sum("n").alias("total"), F.sum(_cut(F.col("n"), self.discounts)).alias("cut"))
            .select("before", "total", (F.col("cut") / F.col("total")).alias("gamma")), "contexts")

    @functools.cached_property
    def _words(self) -> tuple[DataFrame, float]:
        n = F.col("n")
        one = written(self.two.groupBy("word").agg(F.count("*").alias("n")), "words")
        d = _discounts(_times(one))
        words, total, cut = one.agg(F.count("*"), F.sum("n"), F.sum(_cut(n, d))).first()
        unseen = cut / total / (words + 1) if words else 1.0
        return one.select("word", ((n - _cut(n, d)) / (total or 1) + unseen).alias("p")), unseen

    @property
    def one(self) -> DataFrame:
        return self._words[0]

    @property
    def unseen(self) -> float:
        return self._words[1]

    def probabilities(self, grams: DataFrame) -> DataFrame:
        """``grams`` (before, word) with the count n, the total and gamma of the context, and p of the word alone."""
        def sizes(key):
            return grams.groupBy(key).agg(F.count("*").alias("rows"))

        out = grams.join(self.two, PAIR, "left")
        out = lookup(out, self.left, ["before"], sizes("before"))
        out = lookup(out, self.one, ["word"], sizes("word"))
        return out.select(*PAIR, F.coalesce("n", F.lit(0)).alias("seen"), F.coalesce("total", F.lit(0)).alias("total"),
                          (F.coalesce("gamma", F.lit(1.0)) * F.coalesce("p", F.lit(self.unseen))).alias("rest"),
                          F.coalesce("p", F.lit(self.unseen)).alias("alone"))

    def perplexities(self, df: DataFrame) -> DataFrame:
        """``(key, perplexity, without)`` of each row of ``(key, text)`` whose text has a word; see ``scores``."""
        rows = df.select("key", "text", F.lit(False).alias("good"))
        trusted = self.trusted.select(F.lit(None).cast(df.schema["key"].dataType).alias("key"), "text", F.lit(True).alias("good"))
        return scores(trusted.unionAll(rows)).where("NOT good AND perplexity IS NOT NULL").select("key", "perplexity", "without")


def _ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of 64-bit hashes, and the hashes in it. Sorts their high bits with the places in the low ones."""
    low = np.uint64((1 << max(len(keys) - 1, 1).bit_length()) - 1)
    order = keys & ~low
    order |= np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order &= low
    order = order.view(np.int64)
    out = keys[order]
    if (out[1:] < out[:-1]).any():  # different hashes with equal high bits; almost sorted, so this is quick
        again = np.argsort(out, kind="stable")
        order, out = order[again], out[again]
    return order, out


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Marks the first of equal values."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers, byte by byte: bytes that are all alike take no room."""
    n = len(columns[0])
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(n, 8).T.tobytes() for c in columns)
    return n.to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpack(body: bytes, columns: int) -> list[np.ndarray]:
    n = int.from_bytes(body[:8], "little")
    raw = np.frombuffer(pa.decompress(body[8:], n * 8 * columns, "zstd", asbytes=True), np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(c.T).view(np.uint64).ravel() for c in raw]


def _blocks(chunk: int, keys: np.ndarray, values: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """``(chunk, shard, mark, body)``: ascending distinct keys, and what they add, dealt to shards by their high bits."""
    edges = np.searchsorted(keys >> np.uint64(32), [-(-(s << 32) // shards) for s in range(shards + 1)])
    some = [(s, slice(a, b)) for s, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())) if a < b]
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk] * len(some), pa.int64()), pa.array([s for s, _ in some], pa.int32()),
         pa.array([int(np.bitwise_xor.reduce(keys[at]).view(np.int64)) for _, at in some], pa.int64()),
         pa.array([_pack(np.diff(keys[at], prepend=np.uint64(0)), *(v[at].astype(np.uint64) for v in values)) for _, at in some],
                  pa.binary())], ["chunk", "shard", "mark", "body"])


BLOCK = "chunk bigint, shard int, mark bigint, body binary"
#: Of the last number: keys whose sum is 1, 2, 3, 4; keys whose sum isn't 0; the sum of all.
STATS = ["n1", "n2", "n3", "n4", "some", "total"]


def _answered(asked: DataFrame, values: int, owners: bool, name: str) -> tuple[DataFrame, list[int]]:
    """The sums over all chunks for each key of each block, a folder a chunk; and STATS.

    With ``owners`` a sum is doubled, and 1 is added for one of the chunks that add something to it.
    """
    def merge(table: pa.Table) -> pa.Table:
        parts = [_unpack(body, 1 + values) for body in table.column("body").to_pylist()]
        order, keys = _ordered(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]))
        new = _firsts(keys)
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        del keys
        out = []
        for k in range(1, 1 + values):
            own = np.concatenate([p[k] for p in parts])[order]
            sums = np.add.reduceat(own, first)
            answer = np.empty_like(own)
            answer[order] = sums[group]
            if owners:
                adds = np.flatnonzero(own)
                answer *= np.uint64(2)
                answer[order[adds[_firsts(group[adds])]]] += np.uint64(1)
            out.append(answer)
        stats = [*(int(np.count_nonzero(sums == k)) for k in (1, 2, 3, 4)), int(np.count_nonzero(sums)), int(sums.sum())]
        ends = np.cumsum([0, *(len(p[0]) for p in parts)]).tolist()
        body = [_pack(*(v[a:b] for v in out)) for a, b in zip(ends, ends[1:])]
        rest = [pa.array([v] + [0] * (len(body) - 1), pa.int64()) for v in stats]
        return pa.table([*(table.column(c) for c in ("chunk", "shard", "mark")), pa.array(body, pa.binary()), *rest],
                        ["chunk", "shard", "mark", "body", *STATS])

    found = asked.groupBy("shard").applyInArrow(merge, f"{BLOCK}, {', '.join(f'{s} bigint' for s in STATS)}")
    found = written(found.repartition("chunk"), name, by="chunk")
    return found, [v or 0 for v in found.agg(*(F.sum(s) for s in STATS)).first()]


def _answer(path: str, chunk: int, keys: np.ndarray, values: int) -> list[np.ndarray]:
    """What ``_answered`` wrote for a chunk, in the order of its keys."""
    rows = stored(f"{path}/chunk={chunk}", ["shard", "mark", "body"]).sort_by("shard") if len(keys) else None
    parts = [_unpack(body, values) for body in rows.column("body").to_pylist()] if rows else []
    out = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.uint64)] * values
    mark = np.bitwise_xor.reduce(rows.column("mark").to_numpy()) if rows else 0
    if len(out[0]) != len(keys) or mark != np.bitwise_xor.reduce(keys.view(np.int64)):
        raise ValueError("texts came in another order when they were read again; write them first")
    return out


def _chunks(batches, places: str | None, size: int) -> Iterator[tuple[int, list[pa.RecordBatch], list[np.ndarray]]]:
    """(number, batches, trusted rows of each) of chunks of ``size`` bytes of text and the rest of a text.

    Trusted are the rows named in ``places`` (see ``_places``), without it those whose column good is true.
    """
    part = TaskContext.get().partitionId()
    known = stored(f"{places}/part={part}", ["row", "mark"]).sort_by("row") if places else None
    row, mark = (known.column(c).to_numpy() for c in ("row", "mark")) if places else (None, None)
    held, good, number, total, begin = [], [], 0, 0, 0
    for batch in batches:
        at = flat(batch.column("text"))[1]
        if places:
            a, b = np.searchsorted(row, [begin, begin + len(batch)])
            trusted = np.zeros(len(batch), bool)
            trusted[row[a:b] - begin] = True
            if not np.array_equal(batch.column("mark").to_numpy()[trusted], mark[a:b]):
                raise ValueError("rows came in another order when they were read again; write them first")
        else:
            trusted = batch.column("good").to_numpy(zero_copy_only=False)
        of = (total + at[:-1]) // size
        edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(batch)]
        for i, j in zip(edges, edges[1:]):
            if i == j:
                continue
            if held and of[i] != number:
                yield (part << 32) + number, held, good
                held, good = [], []
            number = int(of[i])
            held.append(batch.slice(i, j - i))
            good.append(trusted[i:j])
        total, begin = total + int(at[-1]), begin + len(batch)
    if places and len(row) and row[-1] >= begin:
        raise ValueError("rows were missing when they were read again; write them first")
    if held:
        yield (part << 32) + number, held, good


def _chunk_pairs(held: list[pa.RecordBatch], names: str) -> list[np.ndarray]:
    """Columns of a chunk's counted pairs by text: row in the chunk, key, before, word, n, and how often before leads a pair of the text."""
    begin, out = 0, {name: [] for name in names.split()}
    for batch in held:
        for row, before, word, n in pairs(batch.column("text")):
            at = {"row": row + begin, "key": mix(mix(before) + word), "before": before, "word": word, "n": n}
            if "lead" in out:
                new = _firsts(row)
                new[1:] |= before[1:] != before[:-1]
                at["lead"] = np.add.reduceat(n, np.flatnonzero(new))[np.cumsum(new) - 1] if len(n) else n
            for name, some in out.items():
                some.append(at[name] if at[name].dtype == np.uint64 else at[name].astype(np.int32))
        begin += len(batch)
    # one column after another, so that the parts of only one are held beside the whole
    return [np.concatenate([np.zeros(0, np.uint64 if name in ("key", *PAIR) else np.int32), *out.pop(name)]) for name in names.split()]


def _distinct_words(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    out = np.sort(np.concatenate([before, word]))
    return out[_firsts(out)]


def _places(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Where the rows with one of ``ids`` stand: (part, row, mark), a folder a part; only ids are shuffled."""
    place = F.monotonically_increasing_id()
    at = rows.select("doc_id", "mark", place.alias("place")).join(ids, "doc_id", "left_semi")
    at = at.select(F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("row"), "mark")
    return written(at.repartition("part"), "trusted", by="part")


def scores(rows: DataFrame, places: DataFrame | None = None, chunk: int = CHUNK_BYTES) -> DataFrame:
    """The columns of ``rows`` but text and mark, with good, perplexity and without (null for texts without words).

    The model is that of the good rows: those in ``places`` or, without it, those whose column good is true.
    ``without`` is the perplexity after the pairs of the text itself are taken from the counts. Rows are read three times
    and must come in the same order each time, as they do from files; if they don't, an error is raised. ``chunk``: bytes of
    text whose pairs are asked for together.
    """
    where = places.scratch if places else None
    shards = max(SHARDS * rows.rdd.getNumPartitions(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def ask_pairs(batches):
        for number, held, good in _chunks(batches, where, chunk):
            row, keys, n = _chunk_pairs(held, "row key n")
            trusted = np.concatenate(good)[row]
            order, own = _ordered(keys[trusted])
            first = np.flatnonzero(_firsts(own))
            adds = np.add.reduceat(n[trusted][order], first, dtype=np.int64) if len(first) else first
            own = own[first]
            del row, n, trusted, order
            keys.sort()
            keys = keys[_firsts(keys)]
            counts = np.zeros(len(keys), np.uint64)
            counts[np.searchsorted(keys, own)] = adds
            yield _blocks(number, keys, [counts], shards)

    text = rows.select("text", *({"mark", "good"} & set(rows.columns)))
    answers, (*times, _, _) = _answered(text.mapInArrow(ask_pairs, BLOCK), 1, True, "pairs")
    d, pairs_at = _discounts(times), answers.scratch

    def ask_words(batches):
        for number, held, _ in _chunks(batches, where, chunk):
            keys, before, word = _chunk_pairs(held, "key before word")
            order, keys = _ordered(keys)
            new = _firsts(keys)
            order, keys = order[new], keys[new]
            before, word = before[order], word[order]
            del order, new
            n, = _answer(pairs_at, number, keys, 1)
            words = _distinct_words(before, word)
            own = (n & np.uint64(1)).astype(bool)
            n = (n[own] >> np.uint64(1)).astype(np.int64)
            left, right = np.searchsorted(words, before[own]), np.searchsorted(words, word[own])
            yield _blocks(number, words, [np.bincount(left, n, len(words)),
                                         *(np.bincount(left[m], minlength=len(words)) for m in (n == 1, n == 2, n > 2)),
                                         np.bincount(right, minlength=len(words))], shards)

    words_table, (*times, some, total) = _answered(text.mapInArrow(ask_words, BLOCK), 5, False, "words")
    e, words_at = _discounts(times), words_table.scratch
    once, twice = times[:2]
    unseen = (e[0] * once + e[1] * twice + e[2] * (some - once - twice)) / total / (some + 1) if some else 1.0

    def cut(n, by):
        return np.array([0.0, *by])[np.clip(n, 0, 3)]

    def score(batches):
        for number, held, good in _chunks(batches, where, chunk):
            row, keys, before, word, n, lead = _chunk_pairs(held, "row key before word n lead")
            order, keys = _ordered(keys)
            new = _firsts(keys)
            keys, before, word = keys[new], before[order[new]], word[order[new]]
            pair = np.empty(len(order), np.int32)
            pair[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
            del order, new
            seen = (_answer(pairs_at, number, keys, 1)[0] >> np.uint64(1)).astype(np.int64)
            del keys
            words = _distinct_words(before, word)
            all_, *cuts, contexts = (v.astype(np.int64) for v in _answer(words_at, number, words, 5))
            gamma = np.where(all_ > 0, sum(k * c for k, c in zip(d, cuts)) / np.maximum(all_, 1), 1.0)
            p = (contexts - cut(contexts, e)) / (total or 1) + unseen
            left, right = np.searchsorted(words, before), np.searchsorted(words, word)
            del before, word
            rest, alone, all_ = gamma[left] * p[right], p[right], all_[left]
            del left, right
            weight, *logs = np.zeros((3, sum(map(len, held))))
            for at in range(0, len(row), STEP):
                to = slice(at, at + STEP)
                k, here = pair[to], slice(row[at], int(row[to][-1]) + 1)  # rows ascend
                of, many = row[to] - row[at], n[to]
                weight[here] += np.bincount(of, many)
                for log, own, first in ((logs[0], 0, 0), (logs[1], many, lead[to])):
                    count, whole = seen[k] - own, all_[k] - first
                    share = np.maximum(count - cut(count, d), 0.0) / np.maximum(whole, 1) + rest[k]
                    log[here] += np.bincount(of, many * np.log(np.where(whole > 0, share, alone[k])))
            out = [pa.array(np.exp(-log / np.maximum(weight, 1)), mask=weight == 0) for log in logs]
            begin = 0
            for batch, trusted in zip(held, good):
                to = slice(begin, begin + len(batch))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array(trusted), *(v[to] for v in out)], [*kept, "good", "perplexity", "without"])
                begin += len(batch)

    kept = [c for c in rows.columns if c not in ("text", "mark", "good")]
    shape = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), "good boolean, perplexity double, without double"])
    scored = written(rows.mapInArrow(score, shape), "scored")
    discard(answers, words_table)
    return scored


def classify(df: DataFrame, trusted: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
             quantile: float = 0.75, factor: float = 1.5) -> DataFrame:
    """``(doc_id, lang, perplexity, threshold, keep)`` for each row of ``df``.

    The model is trained on all rows whose id is in ``trusted``; such a row itself is judged without its own counts.
    The threshold of a language (null is one) is ``factor`` times the ``quantile`` of the perplexities of its trusted
    rows; languages without any have that of all. Rows above it, and texts without words (perplexity null),
    are not kept. Rows with a null id are never trusted; repeated rows count each time. The rows of ``df`` must come in the
    same order each time that they are read, as they do from files (see ``scores``).
    """
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(id)).alias("mark"))
    ids = trusted.select(F.col(trusted.columns[0]).alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    places = _places(rows, ids)
    scored = scores(rows, places).select(
        "doc_id", "lang", "good", F.when(F.col("good"), F.col("without")).otherwise(F.col("perplexity")).alias("perplexity"))
    discard(places)
    limit = (F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)) * factor).alias("threshold")
    known = scored.where("good")
    own = known.groupBy("lang").agg(limit).select(F.col("lang").alias("own"), "threshold")
    every = known.agg(limit).first()[0]
    return (scored.join(own, F.col("lang").eqNullSafe(F.col("own")), "left")
            .withColumn("threshold", F.coalesce("threshold", F.lit(every).cast("double")))
            .select("doc_id", "lang", "perplexity", "threshold",
                    F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("keep")))
