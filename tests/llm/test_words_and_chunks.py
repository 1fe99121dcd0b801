"""Spelling variants, chunked byte BPE and periodic runs against brute force and the tiktoken library."""

import collections
import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from corpus_fixtures import docs  # noqa: F401
from latentgrid.llm import chunkbpe, periodic, queries, spelling

SF = "/root/testdata/sf0.001"


def texts(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# -- spelling variants -------------------------------------------------------

def slow_variants(n, factor=10):
    """Pairs that share a word with one code point cut out, at the same place or being that word itself."""
    cut, near = collections.defaultdict(set), collections.defaultdict(set)
    for w in n:
        for k in range(len(w)):
            cut[w[:k] + w[k + 1:]].add((w, k))
    for short, owners in cut.items():
        for w, k in owners:
            near[w] |= {x for x, j in owners if j == k and x != w}
            if short in n:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_spelling_query_equals_brute_force(spark):
    n = collections.Counter()
    for i, text in texts(spark):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 7
    want = slow_variants({w: c for w, c in n.items() if c >= 2})
    assert as_rows(queries.op11_spelling(spark, SF)) == want
    assert any(r[1] for r in want)


def test_spelling_of_short_long_and_repetitive_words(spark):
    random.seed(11)
    n = {}
    for _ in range(250):
        w = "".join(random.choices("ab", k=random.randint(1, 9)))
        n[w] = random.choice([1, 1, 2, 10, 20, 100, 1000])
    long = "".join(random.choices("abcd", k=3000))
    n |= {long: 1, long[:-1]: 10, long[1:]: 10, long[:1500] + "é" + long[1500:]: 100, "😀ab": 3, "😀ac": 40, "ÿab": 5}
    df = spark.createDataFrame([(w, c, "x", 1) for w, c in n.items()], "word string, n long, form string, wid int")
    assert as_rows(spelling.variants(df)) == slow_variants(n)


def test_spelling_edge_rows(spark):
    rows = [("aaaaaaa", 3), ("aaaaaaa", 7), (None, 5), ("", 5), ("aaaaaab", None), ("aaaaaac", 1), ("aaaaaad", 10), ("aaaaaa", 10)]
    df = spark.createDataFrame(rows, "word string, n long")
    assert as_rows(spelling.variants(df)) == slow_variants({"aaaaaaa": 10, "aaaaaac": 1, "aaaaaad": 10, "aaaaaa": 10})
    assert spelling.variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(df, factor=1)


def test_letter_runs(docs):
    df = docs([(1, "AbÉd x ABCÿ1abcd"), (2, None), (3, ""), (1, "AbÉd")])
    got = sorted((r.doc_id, r.run) for r in spelling.letter_runs(df, least=4).collect())
    assert got == [(1, "abcd"), (1, "abcÿ"), (1, "abÉd"), (1, "abÉd")]


# -- chunked byte BPE --------------------------------------------------------

@pytest.fixture(scope="module")
def rank_path():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library(rank_path):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=chunkbpe.read_ranks(rank_path), special_tokens={})


def test_bytes_query_equals_library(spark, library):
    want = []
    for i, text in texts(spark):
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = queries.op12_bytes(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def packed(library, text):
    return np.array(library.encode_ordinary(text or ""), "<u4").tobytes()


def test_long_texts_are_stitched(spark, docs, library, rank_path):
    # the library's tables and those of the regex package know the code points of Unicode 15 alike
    known = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    random.Random(1).shuffle(known)
    some = ["".join(known[k:k + 30_000]) for k in range(0, len(known), 30_000)]
    some += ["a" * 100_000, "'s" * 30_000, " \n" * 30_000 + "x", "x " + " " * 40_000 + "y", "word\n\n" * 20_000, "z'" + "'re" * 20_000,
             "ab" * 50_000 + " " + "'ll" * 9_000, "日本語" * 10_000, "1 " * chunkbpe.CHUNK, "x" * chunkbpe.CHUNK, "x " * (chunkbpe.CHUNK // 2) + "y",
             None, "", "plain", "plain"]
    rows = [(None if k % 5 == 0 else k % 7, t) for k, t in enumerate(some)]
    codec = chunkbpe.Codec(spark, rank_path, public_tokenizers.PATTERN)
    got = codec.encode(docs(rows)).select("doc_id", "ids", codec.decode("ids").alias("bytes")).collect()
    want = collections.Counter((i, packed(library, t), (t or "").encode()) for i, t in rows)
    assert collections.Counter((r.doc_id, bytes(r.ids), bytes(r.bytes)) for r in got) == want
    assert codec.encode(docs(rows).limit(0)).count() == 0


def test_stitching_of_tiny_chunks(spark, docs, library, rank_path, monkeypatch):
    monkeypatch.setattr(chunkbpe, "CHUNK", 40)
    monkeypatch.setattr(chunkbpe, "OVERLAP", 12)
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice([" ", "  ", "\n", "it's", "we'll", "''", "a" * rng.randint(1, 90), "7" * 20, "é!", "\t "])
                        for _ in range(rng.randint(0, 80)))) for k in range(150)]
    codec = chunkbpe.Codec(spark, rank_path, public_tokenizers.PATTERN)
    got = {r.doc_id: bytes(r.ids) for r in codec.encode(docs(rows)).collect()}
    assert got == {i: packed(library, t) for i, t in rows}


def test_long_pre_token_equals_library(library, rank_path):
    ranks = chunkbpe.read_ranks(rank_path)
    merger = chunkbpe.Merger(ranks, *chunkbpe.pair_table(ranks))
    rng = random.Random(2)
    for size in (2, 30, chunkbpe.SHORT, 400, 5000):
        word = "".join(rng.choices("aeinrst", k=size))
        assert merger.ids([[word]]) == [packed(library, word)] == [merger._alone(word.encode())]


# -- periodic runs -----------------------------------------------------------

def slow_runs(words, least=6, times=4):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def slow_collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_query_equals_brute_force(spark):
    want = []
    for i, text in texts(spark):
        words, h = split(text), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = slow_runs(words)
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        want.append((i, len(runs), s, length, q, length and 1000 * length // q, hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(slow_collapsed(words, runs).encode()).hexdigest()))
    got = queries.op13_runs(spark, SF).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(r[1] for r in want)


def test_runs_of_random_texts(docs):
    rng = random.Random(5)

    def text():
        words = []
        for _ in range(rng.randint(0, 5)):
            part = [str(rng.randint(0, rng.choice([2, 3, 50]))) for _ in range(rng.choice([1, 2, 3, 5, 16, 17, 31, 32, 33, 64, 65]))]
            words += part * rng.choice([1, 3, 4, 5, 9])
            words = words[:len(words) - rng.choice([0, 0, 7])]
        return rng.choice([" ", "\n ", "\x0b"]).join(words * rng.choice([1, 1, 4]))

    rows = [(k, text()) for k in range(60)]
    for row in periodic.find_runs(docs(rows)).collect():
        words = split(rows[row.doc_id][1])
        want = slow_runs(words)
        assert [tuple(r) for r in row.runs] == want
        assert (row.n_words, row.collapsed) == (len(words), slow_collapsed(words, want))


def test_runs_edge_rows(docs):
    rows = [(None, "a " * 5), (1, None), (1, ""), (2, " \n"), (3, "x " * 200_000), (3, "x " * 200_000), (4, "é ü " * 4), (5, "a b c d " * 3),
            (6, "a a a a a a"), (7, "           "), (8, " ".join(map(str, range(5000))) + " " + " ".join(map(str, range(4999))) + " 1")]
    got = collections.Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic.find_runs(docs(rows)).collect())
    want = collections.Counter()
    for i, text in rows:
        words = split(text)
        runs = [(0, len(words), 1)] if len(words) > 100_000 else slow_runs(words)
        want[(i, len(words), tuple(runs), slow_collapsed(words, runs))] += 1
    assert got == want
    assert periodic.find_runs(docs(rows).limit(0)).count() == 0
    assert periodic.find_runs(docs([(1, "a " * 50)]).withColumn("runs", F.lit(1)).withColumn("n_words", F.lit(2))).first().n_words == 50
