"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import LETTER, PASS_BYTES, bounded_batches, char_classes, code_points, flat, passes

ORDERS = (1, 2, 3)
#: n-grams are hashed into 2**BITS buckets, so the model has that many numbers per language.
BITS = 16
#: Most languages that a model may have; the broadcast is at most MOST_LANGS * 2**BITS * 8 bytes.
MOST_LANGS = 200
UNKNOWN = "und"
_FACTORS = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
PASS = PASS_BYTES
_lower: np.ndarray | None = None


def lower_table() -> np.ndarray:
    """Lower-case code point of each letter whose lower case is one character; 32 for all but letters."""
    global _lower
    if _lower is None:
        out = np.full(0x110000, 32, np.uint32)
        letters = np.flatnonzero(char_classes() == LETTER)
        out[letters] = letters
        for k in letters.tolist():
            small = chr(k).lower()
            if len(small) == 1:
                out[k] = ord(small)
        _lower = out
    return _lower


def grams(data: np.ndarray, at: np.ndarray, orders=ORDERS, bits: int = BITS):
    """(text, bucket) of the n-grams of letters of some texts, text by text and order by order.

    Other characters are one blank, blanks in a row count once; n-grams of a single blank don't count.
    """
    cps, byte_at = code_points(data)
    text = np.searchsorted(at, byte_at[:-1], "right") - 1
    chars = lower_table()[cps]
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32) | (text[1:] != text[:-1])
    chars, text = chars[keep], text[keep]
    for order in orders:
        n = len(chars) - order + 1
        if n <= 0:
            continue
        h = np.full(n, np.uint32(order), np.uint32)
        for k in range(order):
            h = (h ^ chars[k:k + n]) * _FACTORS[k % 3]
            h ^= h >> np.uint32(15)
        ok = text[:n] == text[order - 1:]
        if order == 1:
            ok &= chars != 32
        yield text[:n][ok], (h[ok] >> np.uint32(32 - bits)).astype(np.int64)


def parts(data: np.ndarray, at: np.ndarray):
    """Texts in passes (first row, bytes, offsets); a long text comes in parts cut at blanks."""
    for i, j in passes(at, PASS):
        body = data[at[i]:at[j]]
        if len(body) <= PASS:
            yield i, body, at[i:j + 1] - at[i]
            continue
        begin = 0
        while begin < len(body):
            gap = np.flatnonzero(body[begin + PASS:begin + 2 * PASS] == 32)
            # without a blank, before a byte that starts a character
            first = np.flatnonzero((body[begin + PASS:begin + PASS + 8] & 0xC0) != 0x80)
            end = begin + PASS + int(gap[0] if len(gap) else first[0]) if begin + PASS < len(body) and len(first) else len(body)
            yield i, body[begin:end], np.array([0, end - begin])
            begin = end


@dataclass
class Model:
    """Languages in alphabetical order and, by bucket, the log-probabilities of each."""

    langs: list[str]
    prior: np.ndarray
    log_p: np.ndarray  # (langs, buckets)
    orders: tuple[int, ...] = ORDERS
    bits: int = BITS

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and its posterior probability of each text."""
        data, at = flat(column)
        n = len(at) - 1
        score = np.zeros((n, len(self.langs)))
        letters = np.zeros(n, np.int64)
        for i, body, ends in parts(data, at):
            for order, (text, bucket) in zip(self.orders, grams(body, ends, self.orders, self.bits)):
                if not len(text):
                    continue
                first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                rows = i + text[first]
                if order == 1:
                    letters[rows] += np.diff(np.append(first, len(text)))
                for k in range(len(self.langs)):
                    score[rows, k] += np.add.reduceat(self.log_p[k][bucket], first)
        if not self.langs:
            return [UNKNOWN] * n, np.zeros(n)
        score += self.prior
        best = score.argmax(1)  # of equal ones the first language
        top = 1 / np.exp(score - score.max(1)[:, None]).sum(1)
        known = letters > 0
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, top, 0.0)


def train(df: DataFrame, text: str = "text", lang: str = "lang", orders=ORDERS, bits: int = BITS,
          smoothing: float = 0.5) -> Model:
    """Count hashed n-grams of all rows with a text and a language, and estimate the model.

    Each task adds up its rows and hands on one row per language and bucket it has seen, whatever the
    number of rows of a language; the sums, at most MOST_LANGS * 2**bits, make up the model. No such
    rows: a model without languages, which predicts ``und``.
    """
    def count(batches):
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            data, at = flat(batch.column(0))
            names = np.array(batch.column(1).to_pylist(), object)
            for name in set(names):
                docs[name] = docs.get(name, 0) + int((names == name).sum())
                totals.setdefault(name, np.zeros(1 << bits, np.int64))
            for i, body, ends in parts(data, at):
                for row, bucket in grams(body, ends, orders, bits):
                    own = names[i + row] if len(row) else row
                    for name in set(names[i:i + len(ends) - 1]):
                        totals[name] += np.bincount(bucket[own == name], minlength=1 << bits)
        for name, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(some) + 1)), pa.array(np.append(some, -1).astype(np.int32)),
                 pa.array(np.append(total[some], docs[name]))], ["lang", "bucket", "n"])

    bounded_batches(df.sparkSession)
    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, F.col(lang).cast("string"))
    sums = (rows.mapInArrow(count, "lang string, bucket int, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    langs = sorted(r[0] for r in rows.select(F.col(rows.columns[1])).distinct().limit(MOST_LANGS + 1).collect())
    if len(langs) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    found = sums.toArrow()
    which = np.searchsorted(np.array(langs, object), np.array(found.column("lang").to_pylist(), object)) if langs else np.zeros(0, int)
    bucket, n = found.column("bucket").to_numpy(), found.column("n").to_numpy()
    docs, counts = np.zeros(len(langs)), np.zeros((len(langs), 1 << bits))
    docs[which[bucket < 0]] = n[bucket < 0]
    counts[which[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    log_p = np.log(counts + smoothing) - np.log(counts.sum(1, keepdims=True) + smoothing * (1 << bits))
    return Model(langs, np.log(docs / max(docs.sum(), 1)), log_p, tuple(orders), bits)


def with_language(df: DataFrame, model: Model, text: str = "text", to: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted language and its probability; texts that are null or have no letter get ``und`` and 0.

    Columns of ``df`` that are called ``to`` or ``score`` are replaced, also if ``text`` is one of them; all others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(column: pa.Array) -> pa.Array:
        langs, top = shared.value.predict(column)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(top)], ["lang", "score"])

    name = "_" + "_".join(df.columns)  # longer than any of them
    return (df.withColumn(name, predict(F.col(text)))
            .withColumn(to, F.col(f"{name}.lang")).withColumn(score, F.col(f"{name}.score")).drop(name))


def held_out(id: str = "doc_id") -> F.Column:
    """Whether a row is kept from training: crc32 of its id as text (null: empty) is a multiple of 5."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % 5 == 0


def identify(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", to: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """Train on the rows of ``df`` that aren't held out and predict all rows; adds ``to`` and ``score``."""
    return with_language(df, train(df.where(~held_out(id)), text, lang), text, to, score)
