"""Byte-level BPE: encoding by a contiguous rank array per word, and decoding.

The vocabulary file is read on the driver and broadcast; its size is that of the vocabulary. Texts
are cut into words in numpy, each distinct word of a pass is encoded once.
"""

from __future__ import annotations

import functools
import heapq
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from latentgrid.llm.common import (LETTER, PASS_BYTES, SPACE, bounded_batches, char_classes, code_points, flat, passes, ragged)

#: Words over so many bytes are merged through a heap, which doesn't scan a long array again and again.
SHORT = 32
NONE = np.int32(2**31 - 1)
#: Bytes of text that are cut into words at once; its distinct words are encoded together.
PASS = 2 * PASS_BYTES


def _byte_chars() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Tables of a byte-level BPE: bytes of each id, ids of single bytes, merges, special strings."""

    tokens: list[bytes]
    byte_ids: np.ndarray
    pairs: np.ndarray    # (a << 32 | b) of the merges, sorted
    ranks: np.ndarray    # rank of each
    merged: np.ndarray   # id by rank
    special: dict[bytes, int]

    @functools.cached_property
    def by_pair(self) -> dict[int, int]:
        return dict(zip(self.pairs.tolist(), self.ranks.tolist()))

    @functools.cached_property
    def arrow(self) -> pa.Array:
        return pa.array(self.tokens, pa.large_binary())

    @functools.cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(t) for t in self.tokens], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where there is no merge."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)


def load(path: str) -> Vocabulary:
    """Read a tokenizers file of a byte-level BPE without prefix space or normaliser."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if (model["type"], pre["type"], pre["add_prefix_space"], spec["normalizer"]) != ("BPE", "ByteLevel", False, None):
        raise ValueError("only byte-level BPE without prefix space and normaliser")
    chars = _byte_chars()
    special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
    tokens = [b""] * (max([*model["vocab"].values(), *special.values()]) + 1)
    for token, k in model["vocab"].items():
        tokens[k] = bytes(chars[c] for c in token)
    for token, k in special.items():
        tokens[k] = token
    byte_ids = np.zeros(256, np.int32)
    for c, b in chars.items():
        byte_ids[b] = model["vocab"][c]
    halves = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    keys = np.array([model["vocab"][a] << 32 | model["vocab"][b] for a, b in halves], np.int64)
    order = np.argsort(keys)
    return Vocabulary(tokens, byte_ids, keys[order], order.astype(np.int32),
                      np.array([model["vocab"][a + b] for a, b in halves], np.int32), special)


def word_starts(cps: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Mask of the code points that start a word of the byte-level pattern.

    ``fresh`` marks the first code points of independent texts. The pattern is: a contraction, or an
    optional blank with letters, digits or other signs, or white space up to the last one before a word.
    """
    n = len(cps)
    kind = char_classes()[cps]
    turn = np.ones(n, bool)
    turn[1:] = (kind[1:] != kind[:-1]) | fresh[1:]
    out = turn.copy()
    at = np.flatnonzero(turn)
    end = np.append(at[1:], n)
    closed = np.append(fresh[at[1:]], True)  # the text ends with the run
    space = (kind[at] == SPACE) & ~closed
    last = end[space] - 1
    out[last] = True
    out[end[space][cps[last] == 32]] = False
    # contractions: an apostrophe alone, without a blank, before letters
    sign = at[(end - at == 1) & (cps[at] == 39) & out[at] & ~closed]
    sign = sign[kind[sign + 1] == LETTER]
    for tail in ("s", "t", "re", "ve", "m", "ll", "d"):
        fits = cps[sign + 1] == ord(tail[0])
        if len(tail) == 2:
            near = np.minimum(sign + 2, n - 1)
            fits &= (sign + 2 < n) & (cps[near] == ord(tail[1])) & ~turn[near]
        hit = sign[fits]
        out[hit + 1] = False
        after = hit + 1 + len(tail)
        after = after[after < n]
        out[after[~turn[after]]] = True
    return out


def _merge_long(vocabulary: Vocabulary, word: bytes) -> list[int]:
    """Merges of one long word, lowest rank and then leftmost first, through a heap."""
    ids = vocabulary.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
    ranks, heap = vocabulary.by_pair, []

    def push(i: int) -> None:
        if i >= 0 and after[i] >= 0 and (r := ranks.get(ids[i] << 32 | ids[after[i]])) is not None:
            heapq.heappush(heap, (r, i, ids[i], ids[after[i]]))

    for i in range(len(ids)):
        push(i)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue
        ids[i], ids[j], after[i] = int(vocabulary.merged[r]), -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        after[j] = -1
        push(before[i])
        push(i)
    return [k for k in ids if k >= 0]


def _merge_short(vocabulary: Vocabulary, data: np.ndarray, at: np.ndarray, size: np.ndarray):
    """Ids and their number of each short word: a row of parts and a row of ranks of neighbours each.

    Every turn finds each word's minimum rank, deletes the boundary there and refreshes the ranks
    on both sides; words without a rank left are done.
    """
    width = int(size.max())
    parts = np.full((len(at), width), -1, np.int32)
    row = np.repeat(np.arange(len(at)), size)
    col = ragged(np.zeros(len(at), np.int64), size)
    parts[row, col] = vocabulary.byte_ids[data[ragged(at, size)]]
    ranks = np.full((len(at), width), NONE, np.int32)
    inner = col + 1 < np.repeat(size, size)
    r, c = row[inner], col[inner]
    ranks[r, c] = vocabulary.rank(parts[r, c], parts[r, c + 1])
    left, count, out = np.arange(len(at)), size.copy(), parts
    live_p, live_r = parts, ranks
    cols = np.arange(width)
    while True:
        best = live_r.argmin(1) if len(left) else np.zeros(0, np.int64)
        low = live_r[np.arange(len(left)), best]
        going = low != NONE
        if not going.all():
            out[left[~going]] = live_p[~going]
            left, live_p, live_r, best, low = left[going], live_p[going], live_r[going], best[going], low[going]
        if not len(left):
            break
        k = np.arange(len(left))
        shift = cols[None, :] > best[:, None]
        p = np.concatenate([live_p[:, 1:], np.full((len(left), 1), -1, np.int32)], 1)
        q = np.concatenate([live_r[:, 1:], np.full((len(left), 1), NONE, np.int32)], 1)
        live_p = np.where(shift, p, live_p)
        live_r = np.where(shift, q, live_r)
        live_p[k, best] = vocabulary.merged[low]
        count[left] -= 1
        size_now = count[left]
        tail = best + 1 < size_now
        live_r[k, best] = NONE
        live_r[k[tail], best[tail]] = vocabulary.rank(live_p[k[tail], best[tail]], live_p[k[tail], best[tail] + 1])
        head = best > 0
        live_r[k[head], best[head] - 1] = vocabulary.rank(live_p[k[head], best[head] - 1], live_p[k[head], best[head]])
    return out[np.arange(width)[None, :] < count[:, None]], count


def _encode_words(vocabulary: Vocabulary, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words, one word after another, and the number of ids of each."""
    data, at = flat(words)
    size = np.diff(at)
    count = np.zeros(len(words), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for low, high in ((0, 4), (4, 8), (8, 12), (12, 16), (16, SHORT)):
        rows = np.flatnonzero((size > low) & (size <= high))
        if len(rows):
            ids, count[rows] = _merge_short(vocabulary, data, at[rows], size[rows])
            found.append((rows, ids))
    for k in np.flatnonzero(size > SHORT):
        word = data[at[k]:at[k + 1]].tobytes()
        ids = [vocabulary.special[word]] if word in vocabulary.special else _merge_long(vocabulary, word)
        count[k] = len(ids)
        found.append((np.array([k]), np.array(ids, np.int32)))
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.int32)
    for rows, ids in found:
        out[ragged(start[rows], count[rows])] = ids
    return out, count


def _encode_pass(vocabulary: Vocabulary, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts (bytes and offsets), and the offsets of the texts' ids."""
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
    cps, byte_at = code_points(data)
    fresh_byte = np.zeros(len(data) + 1, bool)
    fresh_byte[at] = True
    whole = data.tobytes()
    inside: list[tuple[int, int, int]] = []
    for token, k in vocabulary.special.items():
        p = whole.find(token)
        while p >= 0:
            if not fresh_byte[p + 1:p + len(token)].any():  # not across two texts
                inside.append((p, p + len(token), k))
                p = whole.find(token, p + len(token))
            else:
                p = whole.find(token, p + 1)
    for a, b, _ in inside:
        fresh_byte[[a, b]] = True
    starts = word_starts(cps, fresh_byte[byte_at[:-1]])
    start_byte = byte_at[:-1][starts]
    fixed = np.full(len(start_byte), -1, np.int64)
    if inside:
        drop = np.zeros(len(start_byte), bool)
        for a, b, k in inside:
            i, j = np.searchsorted(start_byte, [a, b])
            drop[i + 1:j] = True
            fixed[i] = k
        start_byte, fixed = start_byte[~drop], fixed[~drop]
    offsets = np.append(start_byte, len(data)).astype(np.int32 if len(data) < 2**31 else np.int64)
    words = pa.Array.from_buffers(pa.binary() if offsets.dtype == np.int32 else pa.large_binary(), len(start_byte),
                                  [None, pa.py_buffer(offsets), pa.py_buffer(whole)])
    coded = words.dictionary_encode()
    ids, count = _encode_words(vocabulary, coded.dictionary)
    index = coded.indices.to_numpy()
    length = count[index]
    begin = (np.cumsum(count) - count)[index]
    special = np.flatnonzero(fixed >= 0)
    if len(special):
        ids = np.append(ids, fixed[special].astype(np.int32))
        begin[special] = len(ids) - len(special) + np.arange(len(special))
        length[special] = 1
    out = ids[ragged(begin, length)]
    upto = np.append(0, np.cumsum(length))
    return out, upto[np.searchsorted(start_byte, at)]


def _safe_cuts(data: np.ndarray, most: int) -> list[int]:
    """Cuts of one long text at about ``most`` bytes, each after a sign and before a blank.

    A word never spans such a place, and what follows it doesn't depend on what is before it.
    """
    out, at = [0], most
    while at < len(data):
        end = min(at + most, len(data))
        before = data[at - 1:end - 1]
        sign = np.isin(before, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8), invert=True) & (before < 0x80)
        here = np.flatnonzero((data[at:end] == 32) & sign)
        if len(here):
            out.append(at + int(here[0]))
            at = out[-1] + most
        else:
            at = end
    return [*out, len(data)]


def encode(vocabulary: Vocabulary, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of an Arrow column, one text after another, and the n + 1 offsets of the texts."""
    data, at = flat(column)
    ids, ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    total = 0
    for i, j in passes(at, PASS):
        text = data[at[i]:at[j]]
        if len(text) > PASS:
            cut = _safe_cuts(text, PASS)
            found = [_encode_pass(vocabulary, text[a:b], np.array([0, b - a]))[0] for a, b in zip(cut, cut[1:])]
            some, upto = np.concatenate(found), np.array([0, sum(map(len, found))])
        else:
            some, upto = _encode_pass(vocabulary, text, at[i:j + 1] - at[i])
        ids.append(some)
        ends.append(upto[1:] + total)
        total += int(upto[-1])
    return np.concatenate(ids), np.concatenate(ends)


def decode(vocabulary: Vocabulary, ids: np.ndarray, at: np.ndarray) -> list[str]:
    """Texts of ids with their offsets; bytes that aren't UTF-8 become U+FFFD."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(vocabulary.tokens)):
        raise ValueError("an id is not in the vocabulary")
    data, _ = flat(vocabulary.arrow.take(pa.array(ids)))
    ends = np.append(0, np.cumsum(vocabulary.sizes[ids]))[at]
    whole = data.tobytes()
    return [whole[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


class Codec:
    """Column functions for one vocabulary file.

    ``encode(text)`` gives the ids packed as little-endian unsigned 32-bit integers, ``decode`` the
    text of such a column, ``array`` the ids as an array. A null or empty text has no ids; each row is
    on its own, so repeated rows and other columns don't matter. Strings of special tokens in a text
    become their ids, and ids of special tokens decode to their strings.
    """

    def __init__(self, spark: SparkSession, path: str):
        bounded_batches(spark)
        shared = spark.sparkContext.broadcast(load(path))

        @F.arrow_udf("binary")
        def pack(column: pa.Array) -> pa.Array:
            ids, at = encode(shared.value, column)
            return _binary(ids, at)

        @F.arrow_udf("string")
        def unpack(column: pa.Array) -> pa.Array:
            data, at = flat(column)
            out: list[str] = []
            for i, j in passes(at, PASS):
                ids = data[at[i]:at[j]].view("<u4").astype(np.int64)
                out += decode(shared.value, ids, (at[i:j + 1] - at[i]) // 4)
            return pa.array(out, pa.string())

        @F.arrow_udf("array<int>")
        def unpacked(column: pa.Array) -> pa.Array:
            data, at = flat(column)
            return pa.ListArray.from_arrays(pa.array((at // 4).astype(np.int32)), pa.array(data.view("<i4")))

        # not deterministic, for the planner: else it puts a copy of the encoder under each use of its column
        self._pack, self._unpack, self._array = pack.asNondeterministic(), unpack, unpacked

    def encode(self, text: Column | str) -> Column:
        return self._pack(text)

    def decode(self, packed: Column | str) -> Column:
        return self._unpack(packed)

    def array(self, packed: Column | str) -> Column:
        return self._array(packed)


def _binary(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    packed = ids.astype("<u4")
    if len(packed) * 4 >= 2**31:
        return pa.array([packed[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.large_binary())
    return pa.Array.from_buffers(pa.binary(), len(at) - 1,
                                 [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(packed)])
