"""Periodic runs of words: minimizers at doubling scales, direct lag scans for short periods.

At the scale of K words a run of period q, K/2 < q <= K, with four periods holds a window of K/2 starts of K-word
grams and, q words on, the same window again. Its smallest gram hash is selected in both, and between the two no
gram is equal to it, as grams of q or more words of a primitive period differ at all smaller distances. So each run
shows as a pair of selected grams that follow one another among equal ones at distance q. Such pairs are extended
to both sides word by word; periods up to DIRECT are found by comparing the words at each lag.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import bounded_batches, flat, mix, passes, ragged

#: Periods up to so many words are scanned directly; the first scale is twice that.
DIRECT = 16
_ODD = np.uint64(0x9FB21C651E98DF25)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _blank() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[32, *range(9, 14)]] = True
    return out


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word of texts given as bytes and offsets."""
    blank = _blank()[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[at] = True
    begin = ~blank
    begin[1:] &= blank[:-1] | fresh[1:-1]
    start = np.flatnonzero(begin)
    stops = np.append(np.flatnonzero(blank | fresh[:-1]), len(data))
    return start, stops[np.searchsorted(stops, start, "right")]


def _numbered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words."""
    if not len(start):
        return np.zeros(0, np.int64)
    offsets = np.append(np.column_stack([start, end]).ravel(), len(data))
    slices = pa.Array.from_buffers(pa.large_binary(), 2 * len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return slices.dictionary_encode().indices.to_numpy()[::2].astype(np.int64)


def _slide(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) of each ``width`` neighbours."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = choose(out[:-step], out[step:])
        have += step
    return out


def _lag_stretches(seq: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and number of the positions in a row that equal the one ``lag`` on, where at least ``least``."""
    same = np.zeros(max(len(seq) - lag, 0) + 2, np.int8)
    same[1:-1] = seq[:len(same) - 2] == seq[lag:]
    turn = np.diff(same)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    long = end - start >= least
    return start[long], (end - start)[long]


def _seeds(seq: np.ndarray, doc: np.ndarray, size: np.ndarray, times: int):
    """(position, lag) arrays per scale: selected grams and the distance to the next equal one."""
    gram, at, k, top = mix(seq.view(np.uint64) * _ODD), np.arange(len(seq)), 1, int(size.max(initial=0))
    while times * (k + 1) <= top:
        after = np.zeros_like(gram)
        after[:-k] = gram[k:]
        gram, k = mix(gram * _ODD + after), 2 * k  # of k words now; those over a text's end hold its own mark
        if k <= DIRECT:
            continue
        room = size[doc[at]] >= times * (k // 2 + 1)
        gram, at = gram[room], at[room]
        width = k // 2
        low = _slide(gram, width, np.minimum)
        edge = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(_slide(np.concatenate([edge, low, edge]), width, np.maximum) == gram)
        chosen = chosen[np.argsort(gram[chosen], kind="stable")]
        a, b = chosen[:-1], chosen[1:]
        pair = (gram[a] == gram[b]) & (b - a > k // 2) & (b - a <= k)
        yield at[a[pair]], (b - a)[pair]


def _extend(seq: np.ndarray, p: int, lag: int) -> tuple[int, int]:
    """The positions [s, e) around ``p`` in a row that equal the one ``lag`` on."""
    e, step = p, 64
    while True:
        ahead = seq[e + lag:e + lag + step]
        off = np.flatnonzero(seq[e:e + len(ahead)] != ahead)
        if len(off) or len(ahead) < step:
            e += int(off[0]) if len(off) else len(ahead)
            break
        e, step = e + step, 2 * step
    s, step = p, 64
    while s:
        low = max(s - step, 0)
        off = np.flatnonzero(seq[low:s] != seq[low + lag:s + lag])
        if len(off):
            s = low + int(off[-1]) + 1
            break
        s, step = low, 2 * step
    return s, e


def runs_of(seq: np.ndarray, doc: np.ndarray, size: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``seq``, by start and then period.

    ``seq`` holds texts of ``size`` words one after another, each followed by a negative mark of its own.
    """
    found = [np.zeros((0, 3), np.int64)]
    for q in range(1, DIRECT + 1):
        s, same = _lag_stretches(seq, q, max(least, times * q) - q)
        found.append(np.column_stack([s, same + q, np.full(len(s), q)]))
    for at, lag in _seeds(seq, doc, size, times):
        order = np.lexsort((at, lag))
        upto, last = 0, 0
        rows = []
        for p, q in zip(at[order].tolist(), lag[order].tolist()):
            if q == last and p < upto:
                continue  # in the stretch just extended
            s, upto = _extend(seq, p, q)
            last = q
            if upto - s + q >= max(least, times * q):
                rows.append((s, upto - s + q, q))
        found.append(np.array(rows, np.int64).reshape(-1, 3))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # one stretch under several lags: the smallest is its period, the others are multiples
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1)) if len(rows) else np.zeros(0, bool)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Words one after another with a blank between them, none behind those marked ``last``."""
    out = [np.zeros(0, np.uint8)]
    for k in range(0, len(start), 1 << 16):
        s, size = start[k:k + (1 << 16)], (end - start)[k:k + (1 << 16)] + 1
        part = data[np.minimum(ragged(s, size), len(data) - 1)]
        sep = np.cumsum(size) - 1
        part[sep] = 32
        out.append(np.delete(part, sep[last[k:k + (1 << 16)]]))
    return np.concatenate(out)


def _of_texts(data: np.ndarray, at: np.ndarray, least: int, times: int):
    """Word counts, run offsets, runs (start in the text), collapsed bytes and their offsets of texts."""
    start, end = word_bounds(data, at)
    doc = np.searchsorted(at, start, "right") - 1
    n = len(at) - 1
    size = np.bincount(doc, minlength=n)
    first = np.cumsum(size + 1) - (size + 1)
    place = np.arange(len(start)) + doc
    seq = np.empty(len(start) + n, np.int64)
    seq[place] = _numbered(data, start, end)
    seq[first + size] = -1 - np.arange(n)
    doc_at = np.repeat(np.arange(n), size + 1)
    rows = runs_of(seq, doc_at, size, least, times)
    gone = np.zeros(len(seq) + 1, np.int64)
    np.add.at(gone, rows[:, 0] + rows[:, 2], 1)
    np.add.at(gone, rows[:, 0] + rows[:, 1], -1)
    keep = np.cumsum(gone)[place] == 0
    kept, bytes_ = doc[keep], (end - start)[keep] + 1
    last = np.append(kept[1:] != kept[:-1], True) if len(kept) else np.zeros(0, bool)
    body = _joined(data, start[keep], end[keep], last)
    length = np.bincount(kept, bytes_, n).astype(np.int64)
    length -= length > 0
    owner = doc_at[rows[:, 0]]
    rows[:, 0] -= first[owner]
    return size, np.append(0, np.cumsum(np.bincount(owner, minlength=n))), rows, body, np.append(0, np.cumsum(length))


def find_runs(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` for each row of ``df``.

    Words are split at ASCII white space. A run is a stretch of words with smallest period ``period``, of at least
    ``least`` words and ``times`` periods (4 or more), that can't be extended; runs are ordered by start, then period.
    ``collapsed`` has the words that no run holds after its first period, with one blank between them. A null or empty
    text has no words; rows are on their own, so repeated rows and null ids give a row each; other columns are dropped;
    an empty table gives an empty one. Gram hashes only propose; a run is what word by word comparison gives.
    """
    if times < 4:
        raise ValueError("runs need four periods or more")
    bounded_batches(df.sparkSession)

    def scan(batches):
        kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))
        for batch in batches:
            data, at = flat(batch.column(1))
            for i, j in passes(at):
                size, upto, rows, body, ends = _of_texts(data[at[i]:at[j]], at[i:j + 1] - at[i], least, times)
                runs = pa.ListArray.from_arrays(
                    pa.array(upto.astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)], fields=list(kind.value_type)))
                collapsed = pa.Array.from_buffers(pa.string(), j - i, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(size), runs, collapsed],
                                                 ["key", "n_words", "runs", "collapsed"])

    key = df.schema[id].dataType.simpleString()
    return (df.select(F.col(id).alias("key"), F.col(text).alias("text"))
            .mapInArrow(scan, f"key {key}, n_words bigint, runs {RUNS}, collapsed string").withColumnRenamed("key", id))
