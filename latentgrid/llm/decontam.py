"""Benchmark decontamination by template windows and slot consistency.

Texts are cut into words without ASCII signs, in lower case. In a template, numbers (digits or words), names
(title-case words) and units after a number become typed placeholders, a name or number of several words one.
There are two templates of a text: in the second, title-case words that open a sentence are names as well.
Windows of words, and of both templates, are hashed and joined by hash. A template match counts if its slots are
filled consistently: along one alignment of a document with an item, equal slot values of the item stand for equal values.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import PASS_BYTES, bounded_batches, flat, mix, passes, ragged, span_hashes, written

#: Words of a window; items of fewer words have one window.
WINDOW = 8
#: Words of a template window that must not be placeholders: a window short of them is longer.
LITERAL = 5
#: Least tokens, and words among them, of a template window that ends with its item before it has LITERAL words.
LEAST, FEW = 4, 2
#: Most words of a name or number; each word of a longer run is a placeholder.
RUN = 6
#: Words at an end of a part of a text whose classes the words outside may change.
MARGIN = RUN + 2
#: The filter in front of the join has 2**FILTER bits, whatever the size of the benchmark.
FILTER = 26
# Units of measurement that stand behind a number.
UNITS = ("mm cm m km in ft yd mi g kg mg lb oz t l ml s sec min h hr day days hour hours minute minutes week weeks "
         "year years month months meter meters metre metres mile miles kilometer kilometers gram grams kilogram "
         "kilograms pound pounds dollar dollars euro euros cent cents percent usd eur w kw v hz mhz ghz kb mb gb tb").split()
# Title-case words that open a sentence and are no names.
FUNCTION = ("the an this that these those what which who whom whose when where why how if in on at by for from to of with "
            "without and or but so as then than there here it its he she they we you his her their our your my is are was "
            "were be do does did has have had can could will would shall should may might must not no yes all any each "
            "every some both many much more most after before during while because since until let given find").split()
SMALL = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
         "seventeen eighteen nineteen").split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
LARGE = {"hundred": 100, "thousand": 1000, "million": 10**6, "billion": 10**9}
NUMBER, NAME, UNIT = 1, 2, 3
#: Kinds of windows: words as they are, templates, templates with names that open sentences.
PLAIN, TEMPLATE, NAMED = 0, 1, 2
_Q = np.uint64(0xD6E8FEB86659FD93)


def _hashes(plain) -> np.ndarray:
    data, at = flat(pa.array(plain))
    return span_hashes(data.astype(np.uint64) + np.uint64(1), at[:-1], at[1:])


@functools.cache
def _fixed() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of units, of function words, and of number words in order with those of their digits."""
    named = {w: n for n, w in enumerate(SMALL)} | LARGE
    for k, ten in enumerate(TENS):
        named |= {ten + (SMALL[n] if n else ""): 20 + 10 * k + n for n in range(10)}
    key, digits = _hashes(list(named)), _hashes([str(n) for n in named.values()])
    order = np.argsort(key)
    return _hashes(UNITS), _hashes(FUNCTION), key[order], digits[order]


class Words(NamedTuple):
    """Words of concatenated texts."""
    start: np.ndarray  # first byte
    value: np.ndarray  # hash
    kind: np.ndarray   # 0, NUMBER, NAME, UNIT
    opens: np.ndarray  # may be a name that opens a sentence
    filled: np.ndarray  # hash as a slot value: of the digits of a number word
    spelt: np.ndarray  # is a number word
    glued: np.ndarray  # no sign, line or text ends before it
    front: np.ndarray  # of a number with its unit: hash of the number, or 0
    back: np.ndarray   # and of the unit


def words(data: np.ndarray, fresh: np.ndarray) -> Words:
    """Words of concatenated UTF-8 texts.

    ``fresh`` marks the first bytes of texts. Words are cut at ASCII white space and consist of their
    ASCII letters and digits and all other characters; words of signs alone don't count.
    """
    white = (data == 32) | ((data >= 9) & (data <= 13))
    upper = (data >= 65) & (data <= 90)
    low = data + np.uint8(32) * upper
    after_c3 = np.zeros(len(data), bool)
    after_c3[1:] = data[:-1] == 0xC3
    accent = after_c3 & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    low = low + np.uint8(32) * accent
    digit = (data >= 48) & (data <= 57)
    kept = digit | ((low >= 97) & (low <= 122)) | (data >= 0x80)
    begin = ~white
    begin[1:] &= white[:-1] | fresh[1:len(data)]
    at = np.flatnonzero(begin)
    if not len(at):
        none, no = np.zeros(0, np.uint64), np.zeros(0, bool)
        return Words(at, none, np.zeros(0, np.uint8), no, none, no, no, none, none)
    units, function, spelt_keys, spelt_digits = _fixed()
    count = np.append(0, np.cumsum(kept))
    place = np.append(np.flatnonzero(kept), 0)
    chars = low[kept].astype(np.uint64) + np.uint64(1)
    end = np.append(at[1:], len(data))
    a, b = count[at], count[end]
    digits = np.append(0, np.cumsum(digit[place[:-1]]))
    n_digits = digits[b] - digits[a]
    mixed = np.flatnonzero((n_digits > 0) & (n_digits < b - a))
    mixed = mixed[digits[a[mixed] + n_digits[mixed]] - digits[a[mixed]] == n_digits[mixed]]
    mid = a[mixed] + n_digits[mixed]
    value, number, unit = np.split(span_hashes(chars, np.concatenate([a, a[mixed], mid]), np.concatenate([b, mid, b[mixed]])),
                                   [len(a), len(a) + len(mixed)])
    front, back = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    joint = np.isin(unit, units)
    front[mixed[joint]], back[mixed[joint]] = number[joint], unit[joint]
    capital = upper | accent
    capitals = np.append(0, np.cumsum(capital))
    first = place[a]
    lead = upper[first] | ((data[first] == 0xC3) & accent[np.minimum(first + 1, len(data) - 1)])
    # the last byte of the word before, and a line break between, end a sentence
    last = np.zeros(len(at), np.uint8)
    full = np.flatnonzero(~white)
    before = full[np.searchsorted(full, at[1:]) - 1]
    last[1:] = data[before]
    lines = np.append(0, np.cumsum(data == 10))
    text = np.searchsorted(np.flatnonzero(fresh[:len(data)]), at, "right")
    apart = np.ones(len(at), bool)
    apart[1:] = (text[1:] > text[:-1]) | (lines[at[1:]] > lines[at[:-1]])
    opening = np.isin(last, np.frombuffer(b".!?:;", np.uint8)) | apart
    glued = ~apart
    glued[1:] &= kept[before]
    title = lead & (capitals[end] - capitals[at] == 1) & (b - a >= 2)
    k = np.minimum(np.searchsorted(spelt_keys, value), len(spelt_keys) - 1)
    spelt = spelt_keys[k] == value
    kind = np.zeros(len(at), np.uint8)
    kind[title & ~opening] = NAME
    kind[(n_digits == b - a) | spelt] = NUMBER
    opens = title & opening & (kind == 0)
    opens[opens] = ~np.isin(value[opens], function)
    out = Words(at, value, kind, opens, np.where(spelt, spelt_digits[k], value), spelt, glued, front, back)
    out = Words(*(x[b > a] for x in out))
    text = text[b > a]
    after = np.isin(out.value, units)
    after[1:] &= (out.kind[:-1] == NUMBER) & (text[1:] == text[:-1])
    after[:1] = False
    out.kind[after & (out.kind != NUMBER)] = UNIT
    out.opens[after] = False
    return out


class Tokens(NamedTuple):
    """A template of some texts, token by token."""
    kind: np.ndarray
    value: np.ndarray   # hash of the word, or of what fills the slot
    first: np.ndarray   # first word
    behind: np.ndarray  # word behind the last one
    stop: np.ndarray    # token behind the text


def tokens(w: Words, row: np.ndarray, named: bool) -> Tokens:
    kind = np.where(w.opens, np.uint8(NAME), w.kind) if named else w.kind
    value, spelt, glued, word = w.filled, w.spelt, w.glued, np.arange(len(kind))
    if (split := w.front > 0).any():
        word = np.repeat(word, 1 + split)
        kind, value, spelt, glued = kind[word], value[word], spelt[word], glued[word]
        at = np.flatnonzero(split)
        new = at + np.arange(len(at))
        kind[new], kind[new + 1], glued[new], glued[new + 1] = NUMBER, UNIT, False, False
        value[new], value[new + 1] = w.front[at], w.back[at]
    joined = np.zeros(len(kind), bool)
    joined[1:] = glued[1:] & (((kind[1:] == NAME) & (kind[:-1] == NAME)) | (spelt[1:] & (kind[:-1] == NUMBER)))
    head = np.flatnonzero(~joined)
    size = np.diff(np.append(head, len(kind)))
    joined &= np.repeat(size <= RUN, size)
    head = np.flatnonzero(~joined)
    tail = np.append(head[1:], len(kind))
    out = value[head]
    if len(many := np.flatnonzero(tail - head > 1)):
        out[many] = span_hashes(value, head[many], tail[many])
    first = word[head]
    stop = np.searchsorted(row[first], row[first], "right")
    return Tokens(kind[head], out, first, word[tail - 1] + 1, stop)


def window_hashes(value: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` values."""
    n = len(value) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, power = np.full(n, np.uint64(length)), np.uint64(1)
    for k in range(length):
        with np.errstate(over="ignore"):
            out = out + value[k:k + n] * power
            power = power * _Q
    return mix(out)


def _template_chars(t: Tokens) -> np.ndarray:
    return np.where(t.kind > 0, t.kind.astype(np.uint64), t.value)


def _ends(t: Tokens, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the window that begins at each token ends (maybe behind the text), and running numbers of words."""
    plain = np.append(0, np.cumsum(t.kind == 0))
    return np.maximum(np.arange(len(t.kind)) + window,
                      np.searchsorted(plain, plain[:-1] + min(LITERAL, max(window - 1, 1)))), plain


def _slots(t: Tokens, a: np.ndarray, b: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """The columns' values at the slots of each window of tokens."""
    cells = ragged(a, b - a)
    open_ = t.kind[cells] > 0
    ends = np.append(0, np.cumsum(np.append(0, np.cumsum(t.kind > 0))[np.stack([a, b])].astype(np.int64).T @ [-1, 1]))
    at = pa.array(ends.astype(np.int32))
    return [pa.ListArray.from_arrays(at, pa.array(c[cells[open_]])) for c in columns]


class Shape(NamedTuple):
    """What the windows of a benchmark look like."""
    window: int
    plain: list[int]  # lengths of windows of words
    short: list[int]  # lengths of template windows that end with an item short of words
    widest: int       # most tokens of a template window


_STEP = 20_000
_ITEM = "id bigint, kind int, hash bigint, class bigint, at int, width int, head bigint, label array<int>, own array<bigint>"


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _item_rows(ids: pa.Array, w: Words, row: np.ndarray, window: int):
    n = len(row)
    start, stop = np.searchsorted(row, row), np.searchsorted(row, row, "right")
    size = np.minimum(window, stop - start)
    for length in np.unique(size).tolist():
        h = window_hashes(w.value, length)
        every = np.flatnonzero((size[:len(h)] == length) & (np.arange(len(h)) + length <= stop[:len(h)]))
        for k in np.split(every, range(_STEP, len(every), _STEP)):
            none = pa.ListArray.from_arrays(pa.array(np.zeros(len(k) + 1, np.int32)), pa.array([], pa.int64()))
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(row[k])), pa.array(np.full(len(k), PLAIN, np.int32)), _signed(h[k]),
                pa.array(np.zeros(len(k), np.int64)), pa.array((k - start[k]).astype(np.int32)),
                pa.array(np.full(len(k), length, np.int32)), pa.nulls(len(k), pa.int64()),
                none.cast(pa.list_(pa.int32())), none], names=_names(_ITEM))
    for variant in (TEMPLATE, NAMED) if n else ():
        t = tokens(w, row, variant == NAMED)
        i, chars, item = np.arange(len(t.kind)), _template_chars(t), row[t.first]
        begin = np.searchsorted(item, item)
        # label of a slot: the first slot of the item with the same value
        order = np.lexsort((i, t.value, t.kind, item))
        new = np.ones(len(i), bool)
        new[1:] = ((item[order][1:] != item[order][:-1]) | (t.kind[order][1:] != t.kind[order][:-1])
                   | (t.value[order][1:] != t.value[order][:-1]))
        label = np.empty(len(i), np.int64)
        label[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        label -= begin
        pattern = np.where(t.kind > 0, (t.kind.astype(np.uint64) << np.uint64(32)) + label.astype(np.uint64), t.value)
        class_ = span_hashes(pattern, begin, t.stop)
        end, plain = _ends(t, window)
        whole = end <= t.stop
        b = np.minimum(end, t.stop)
        some = plain[b] - plain[i]
        ok = (b - i > some) & (whole | ((some >= min(FEW, window - 1)) & (b - i >= min(LEAST, window))
                                        & ((b - i >= window) | (i == begin))))
        every = np.flatnonzero(ok)
        for k in np.split(every, range(_STEP, len(every), _STEP)):
            head = span_hashes(chars, k, np.minimum(k + min(LEAST, window), b[k]))
            labels, own = _slots(t, k, b[k], label.astype(np.int32), t.value.view(np.int64))
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(item[k])), pa.array(np.full(len(k), variant, np.int32)),
                _signed(span_hashes(chars, k, b[k])), _signed(class_[k]), pa.array((k - begin[k]).astype(np.int32)),
                pa.array((b[k] - k).astype(np.int32)), pa.array(head.view(np.int64), mask=whole[k]), labels, own],
                names=_names(_ITEM))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def item_windows(df: DataFrame, id: str, text: str, window: int = WINDOW) -> DataFrame:
    """Windows of benchmark items, each item read whole.

    ``class`` is a key of the whole item's template and of which of its slots are equal, ``label`` and ``own`` are
    the number and value of each slot of the window, ``head`` is set if it ends with the item short of words.
    """
    bounded_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            data, at = flat(batch.column(1))
            for i, j in passes(at):
                body, own = data[at[i]:at[j]], at[i:j + 1] - at[i]
                w = words(body, _fresh(body, own))
                yield from _item_rows(batch.column(0).slice(i), w, np.searchsorted(own, w.start, "right") - 1, window)

    return df.select(F.col(id).cast("bigint"), F.col(text)).mapInArrow(run, _ITEM)


def _fresh(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(body) + 1, bool)
    out[at] = True
    return out


def _parts(body: np.ndarray, most: int, shared: int):
    """A long text in parts: (words, words before the part, words whose windows are done, words to do)."""
    def cut(at: int) -> int:
        for k in range(at, len(body), most):
            gap = np.flatnonzero((body[k:k + most] == 32) | (body[k:k + most] == 10))
            if len(gap):
                return k + int(gap[0])
        return len(body)

    begin, base, done = 0, 0, 0
    while True:
        end = begin
        while True:
            end = cut(end + most)
            w = words(body[begin:end], _fresh(body[begin:end], np.zeros(1, np.int64)))
            if len(w.start) > 2 * shared or end >= len(body):
                break
        n = len(w.start)
        to_do = base + n - (MARGIN if end < len(body) else 0)
        yield w, base, done, to_do
        if end >= len(body):
            return
        done, base, begin = to_do, base + n - shared, begin + int(w.start[n - shared])


_DOC = "id bigint, row bigint, pos int, kind int, hash bigint, place int, value array<bigint>"


def _doc_rows(ids: pa.Array, keys: pa.Array, w: Words, row: np.ndarray, shape: Shape, keep, base=0, done=0,
              to_do=1 << 60, last: dict | None = None):
    """Windows that pass ``keep`` and end behind word ``done``, up to word ``to_do``, of its text or texts.

    ``last`` keeps the tokens of a text's part, by which those of the next part are numbered.
    """
    if not len(row):
        return
    first = np.searchsorted(row, np.arange(row[-1] + 1))

    def rows(variant, k, pos, place, h, values):
        return pa.RecordBatch.from_arrays([
            ids.take(pa.array(row[k])), keys.take(pa.array(row[k])), pa.array(pos.astype(np.int32)),
            pa.array(np.full(len(k), variant, np.int32)), _signed(h), pa.array(place.astype(np.int32)), values],
            names=_names(_DOC))

    for length in shape.plain:
        h = window_hashes(w.value, length)
        every = np.flatnonzero(keep(h) & (row[:len(h)] == row[length - 1:])) if len(h) else np.zeros(0, np.int64)
        every = every[(every + length + base > done) & (every + length + base <= to_do)]
        for k in np.split(every, range(_STEP, len(every), _STEP)):
            pos = k - first[row[k]] + base
            yield rows(PLAIN, k, pos, pos, h[k], pa.ListArray.from_arrays(
                pa.array(np.zeros(len(k) + 1, np.int32)), pa.array([], pa.int64())))
    for variant in (TEMPLATE, NAMED) if shape.widest else ():
        t = tokens(w, row, variant == NAMED)
        i, chars = np.arange(len(t.kind)), _template_chars(t)
        before = 0
        if last is not None:
            if variant in last:
                old, old_base, old_before = last[variant]
                here = min(int(np.searchsorted(t.first, MARGIN)), len(i) - 1)
                before = old_before + int(np.searchsorted(old, t.first[here] + base - old_base)) - here
            last[variant] = t.first, base, before
        end, plain = _ends(t, shape.window)
        b = np.minimum(end, t.stop)
        a = np.flatnonzero((end <= t.stop) & (end - i <= shape.widest) & (b - i > plain[b] - plain[i]))
        spans = [(a, end[a])]
        if shape.short:
            least = min(LEAST, shape.window)
            near = np.flatnonzero(i + least <= t.stop)
            near = near[keep(span_hashes(chars, near, near + least))]
            for length in shape.short:
                a = near[(near + length <= t.stop[near]) & (near + length < end[near])]
                spans.append((a, a + length))
        a, b = (np.concatenate(x) for x in zip(*spans))
        h = span_hashes(chars, a, b)
        behind = t.behind[b - 1] + base
        ok = np.flatnonzero(keep(h) & (behind > done) & (behind <= to_do))
        text = np.searchsorted(row[t.first], np.arange(row[-1] + 1))
        for k in np.split(ok, range(_STEP, len(ok), _STEP)):
            word = t.first[a[k]]
            yield rows(variant, word, word - first[row[word]] + base, a[k] - text[row[word]] + before, h[k],
                       *_slots(t, a[k], b[k], t.value.view(np.int64)))


def doc_windows(df: DataFrame, id: str, text: str, shape: Shape, keep, most: int = PASS_BYTES) -> DataFrame:
    """``(id, row, pos, kind, hash, place, value)``: windows of whole texts whose hash passes ``keep``.

    ``row`` is a key of the id with the text: rows that repeat an id, or have none, are told apart by it. ``pos`` is
    the first word, ``place`` the first token, ``value`` what fills the slots.
    """
    bounded_batches(df.sparkSession)
    shared = max(RUN * shape.widest, max(shape.plain, default=1)) + 2 * MARGIN

    def run(batches):
        for batch in batches:
            data, at = flat(batch.column(2))
            for i, j in passes(at, most):
                own, body = (batch.column(0).slice(i), batch.column(1).slice(i)), data[at[i]:at[j]]
                if len(body) <= most:
                    texts = at[i:j + 1] - at[i]
                    w = words(body, _fresh(body, texts))
                    yield from _doc_rows(*own, w, np.searchsorted(texts, w.start, "right") - 1, shape, keep)
                else:
                    last: dict = {}
                    for w, base, done, to_do in _parts(body, most, shared):
                        yield from _doc_rows(*own, w, np.zeros(len(w.start), np.int64), shape, keep, base, done, to_do, last)

    key = F.col(id).cast("bigint")
    return df.select(key, F.xxhash64(key, F.col(text)), F.col(text)).mapInArrow(run, _DOC)


def _filter(hashes: DataFrame, bits: int = FILTER):
    """Broadcast of a bit table of the top ``bits`` bits of all hashes: 2**bits / 8 bytes at any input size."""
    each = 15
    top = F.shiftrightunsigned("hash", 64 - bits)

    def pack(key, rows):
        cell = np.zeros(1 << each, np.uint8)
        cell[rows.column("bit").to_numpy()] = 1
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int64()), "body": pa.array([np.packbits(cell).tobytes()])})

    packed = (hashes.select(F.shiftrightunsigned(top, each).alias("cell"),
                            top.bitwiseAND(F.lit((1 << each) - 1)).cast("int").alias("bit")).distinct()
              .groupBy("cell").applyInArrow(pack, "cell bigint, body binary").toArrow())
    table = np.zeros((1 << (bits - each), 1 << (each - 3)), np.uint8)
    for cell, body in zip(packed.column("cell").to_pylist(), packed.column("body").to_pylist()):
        table[cell] = np.frombuffer(body, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(table.ravel())


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document that holds a window of an item: ``(doc_id, item_ids, n_windows, n_literal, slots)``.

    A window of ``window`` words counts if an item has the same words (``n_literal``), or the same template with
    consistently filled slots along the alignment with an item. A template window with fewer than LITERAL words
    besides its slots goes on until it has them or the item ends. Items under ``window`` words match as a
    whole; as templates, if they have LEAST tokens and FEW words besides slots. Of items that share a window of words,
    the smallest id stands for all; for templates, of items with the same whole template and the same slots equal,
    which no filling tells apart. ``n_windows`` counts a position once, ``slots`` adds the most
    slots along one alignment of each item. Texts without words (null, empty) match nothing; rows with the same id (or
    null) are matched each by itself, equal ones once, and reported as one; no benchmark means no rows. Items
    without an id match like others, but have no place in ``item_ids``, which may be empty for that.
    Texts aren't shuffled, only the windows that pass the filter.
    """
    named, unnamed = benchmark.where(F.col(item).isNotNull()), benchmark.where(F.col(item).isNull())
    by_text = unnamed.select(F.xxhash64(item_text).alias(item), F.col(item_text)).distinct()
    every = written(item_windows(named, item, item_text, window).withColumn("unnamed", F.lit(False))
                    .union(item_windows(by_text, item, item_text, window).withColumn("unnamed", F.lit(True))), "items")
    index = written(
        every.groupBy("kind", "hash", "class", F.when(F.col("kind") > PLAIN, F.col("at")).alias("place_at"))
        .agg(F.min(F.struct("unnamed", "id", "at", "width", "head", "label", "own")).alias("w"))
        .select("kind", "hash", "class", "w.unnamed", F.col("w.id").alias("item"), "w.at", "w.width", "w.head", "w.label", "w.own"),
        "index")
    plain, short, widest = index.agg(
        F.collect_set(F.when(F.col("kind") == PLAIN, F.col("width"))),
        F.collect_set(F.when(F.col("head").isNotNull(), F.col("width"))),
        F.max(F.when(F.col("kind") > PLAIN, F.col("width")))).first()
    shape = Shape(window, sorted(plain), sorted(short), widest or 0)
    bits = _filter(index.select("hash").union(index.where("head IS NOT NULL").select("head")))

    def keep(h: np.ndarray) -> np.ndarray:
        top = (h >> np.uint64(64 - FILTER)).astype(np.int64)
        return (bits.value[top >> 3] >> (7 - (top & 7)).astype(np.uint8)) & 1 == 1

    one = ["row", "unnamed", "item", "kind", "class", "shift"]
    hits = (doc_windows(docs, id, text, shape, keep).join(index, ["kind", "hash"])
            .where(F.size("value") == F.size("label")).where((F.col("kind") == PLAIN) | (F.col("value") != F.col("own")))
            .withColumn("shift", F.col("place") - F.col("at")).select("id", *one, "pos", "label", "value"))
    hits = written(hits, "hits")
    filled = hits.where(F.col("kind") > PLAIN)
    slots = (filled.select(*one, F.explode(F.arrays_zip("label", "value")).alias("s"))
             .groupBy(*one, "s.label").agg(F.min("s.value").alias("low"), F.max("s.value").alias("high"))
             .groupBy(*one).agg(F.count("*").alias("slots"), F.count_if(F.expr("low != high")).alias("odd"))
             .where("odd = 0"))
    matched = written(
        filled.join(slots, one).select("id", "row", "unnamed", "item", "pos", "slots", F.lit(0).alias("literal"))
        .union(hits.where(F.col("kind") == PLAIN).select("id", "row", "unnamed", "item", "pos", F.lit(0), F.lit(1))), "matched")
    windows = (matched.groupBy("id", "row", "pos").agg(F.max("literal").alias("literal"))
               .select("id", F.lit(None).cast("bigint").alias("item"), F.lit(1).alias("n"), "literal", F.lit(0).alias("slots")))
    items = (matched.groupBy("id", "row", "unnamed", "item").agg(F.max("slots").alias("slots"))
             .select("id", F.when(~F.col("unnamed"), F.col("item")), F.lit(0), F.lit(0), "slots"))
    return windows.union(items).groupBy(F.col("id").alias("doc_id")).agg(
        F.sort_array(F.collect_set("item")).alias("item_ids"), F.sum("n").alias("n_windows"),
        F.sum("literal").alias("n_literal"), F.sum("slots").alias("slots"))
