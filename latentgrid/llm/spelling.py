"""Spelling variants: words one edit apart, found by a frontier of states that walks a trie kept as an edge table.

All pairs at one edit are found twice over: once in a trie of the words, once in a trie of the words read
backwards. One of the two meets the edit in the second half, so a walk starts at the middle of a word, at the
node of its first half, where few words are left. There is a trie for each word length: a word of n code points
walks the trie of length n (one replacement) and that of n - 1 (one deletion; insertions are the same pairs
seen from the longer word). Chains of nodes with one child are one edge with a longer label, so the number of
levels grows with the branchings on a path and not with the length of a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import bounded_batches, code_points, discard, flat, ragged, span_hashes, written

MAX_LEVELS = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"


def letter_runs(df: DataFrame, text: str = "text", least: int = 7, to: str = "run") -> DataFrame:
    """A row for each maximal run of ``LETTERS`` with at least ``least`` code points, A-Z lower-cased.

    Null and empty texts give none; repeated rows count again; the other columns are kept.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{least},}})"))
    keep = [c for c in df.columns if c not in (text, to)]
    plain = F.octet_length(to) == F.length(to)
    low = F.when(plain, F.lower(to)).otherwise(F.translate(to, UPPER, LOWER))
    return df.select(*keep, F.explode(found).alias(to)).withColumn(to, low)


def _nodes(chars: np.ndarray, start: np.ndarray, pos: np.ndarray, size: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Trie node of the first ``pos`` code points of strings that begin at ``start``: a hash of direction, length and prefix."""
    salt = (size * 2 + back).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (span_hashes(chars, start, start + pos) ^ salt).view(np.int64)


def _prefixes(strings: DataFrame) -> DataFrame:
    """``(wid, back, pos, node, next)``: the trie nodes of each string from its middle on, with the code point that follows.

    The last node of a string has next = -1. Linear in the string.
    """
    bounded_batches(strings.sparkSession)

    def walk(batches):
        for batch in batches:
            data, at = flat(batch.column("s"))
            cps, byte_at = code_points(data)
            chars = cps.astype(np.uint64) + np.uint64(1)
            start = np.searchsorted(byte_at, at)
            size = np.diff(start)
            back = batch.column("back").to_numpy(zero_copy_only=False)
            count = size - size // 2 + 1
            row = np.repeat(np.arange(len(size)), count)
            pos = ragged(size // 2, count)
            node = _nodes(chars, start[:-1][row], pos, size[row], back[row])
            follow = np.where(pos < size[row], np.append(cps, 0)[start[:-1][row] + pos].astype(np.int64), -1)
            step = 1 << 16
            for k in range(0, len(row), step):
                s = slice(k, k + step)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("wid").take(pa.array(row[s])), pa.array(back[row[s]]), pa.array(pos[s].astype(np.int32)),
                     pa.array(node[s]), pa.array(follow[s].astype(np.int32))], ["wid", "back", "pos", "node", "next"])

    return strings.select("wid", "back", "s").mapInArrow(walk, "wid bigint, back boolean, pos int, node bigint, next int")


def _edges(strings: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``(parent, label, first, last, size, child, words, ends, follow)``: the tries' edges.

    ``words`` is the number of words below, ``ends`` the word that ends there, ``follow`` the code points that the labels
    after this one begin with. Kept nodes: the middle of a word, its end, and those that more than one code point follows.
    """
    branching = (prefixes.groupBy("node").agg(F.min("next").alias("low"), F.max("next").alias("high"))
                 .where("low != high").select("node"))
    middle = F.col("pos") == F.expr("size DIV 2")
    sized = prefixes.join(strings.select("wid", "back", F.length("s").alias("size")), ["wid", "back"])
    inner = sized.where(~middle & (F.col("next") >= 0)).join(branching, "node", "left_semi")
    path = (inner.select("wid", "back", "pos", "node")
            .union(sized.where(middle | (F.col("next") < 0)).select("wid", "back", "pos", "node"))
            .groupBy("wid", "back").agg(F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("path")))
    steps = path.join(strings, ["wid", "back"]).select(
        "wid", "s", "path", F.explode(F.expr("sequence(0, size(path) - 2)")).alias("k"))
    here, after = F.col("path")[F.col("k")], F.col("path")[F.col("k") + 1]
    leaf = F.col("k") == F.size("path") - 2
    edges = written(steps.select(
        here.node.alias("parent"), F.substring(F.col("s"), here.pos + 1, after.pos - here.pos).alias("label"),
        after.node.alias("child"), F.when(leaf, F.col("wid")).alias("end"))
        .groupBy("parent", "label", "child").agg(F.count("*").alias("words"), F.collect_set("end").alias("ends")), "labels")
    first = F.substring("label", 1, 1)
    follow = edges.groupBy(F.col("parent").alias("child")).agg(F.array_join(F.collect_set(first), "").alias("follow"))
    out = written(edges.join(follow, "child", "left").select(
        "parent", "label", first.alias("first"), F.substring("label", -1, 1).alias("last"), F.length("label").alias("size"),
        "child", "words", "ends", F.coalesce("follow", F.lit("")).alias("follow")), "edges")
    discard(edges)
    return out


def _starts(strings: DataFrame) -> DataFrame:
    """The first frontier: each string at the middle node of the trie of its own length, and of the next shorter one's."""

    def middles(batches):
        for batch in batches:
            data, at = flat(batch.column("s"))
            cps, byte_at = code_points(data)
            chars = cps.astype(np.uint64) + np.uint64(1)
            start = np.searchsorted(byte_at, at)
            back = batch.column("back").to_numpy(zero_copy_only=False)
            for shorter in (False, True):
                size = np.diff(start) - shorter
                some = np.flatnonzero(size > 0)
                pos = size[some] // 2
                node = _nodes(chars, start[:-1][some], pos, size[some], back[some])
                take = pa.array(some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("wid").take(take), pa.array(node), batch.column("s").take(take), pa.array(pos.astype(np.int32)),
                     pa.array(np.full(len(some), shorter))], ["wid", "node", "s", "pos", "shorter"])

    return (strings.select("wid", "back", "s").mapInArrow(middles, "wid bigint, node bigint, s string, pos int, shorter boolean")
            .select("wid", "node", F.expr("substring(s, pos + 1)").alias("rest"), "shorter", F.lit(0).alias("edits")))


def _advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States after one edge: the label as it is, or with the one edit in it. States that no later label can follow are left out."""

    def goes(at):
        return F.instr(F.col("follow"), F.substring(F.col("rest"), at + 1, F.lit(1))) > 0

    def ahead(used):  # the word ends with this label, or one of the next begins as it goes on
        return (F.col("follow") == "") | goes(used)

    far = F.col("size") + F.col("shorter").cast("int")
    part = F.expr("substring(rest, 1, size + cast(shorter AS int))")
    same = F.col("rest").startswith(F.col("label")) & F.when(F.col("edits") == 1, ahead(F.col("size"))).otherwise(
        F.when(F.col("shorter"), goes(F.col("size")) | goes(F.col("size") + 1)).otherwise(F.col("words") > 1))
    # strings one edit apart share their first or their last code point, but for single ones
    close = (part.startswith(F.col("first")) | part.endswith(F.col("last")) | (far == 1)) & (
        (far == 1) | (F.levenshtein(part, F.col("label"), 1) == 1))
    # of two words of equal length the one with the larger code point at the edit finds the pair
    edit = ((F.col("edits") == 0) & (F.length("rest") >= far) & (F.col("shorter") | (F.col("label") < part)) & close & ahead(far))
    step = F.filter(F.array(F.struct(F.col("edits").alias("edits"), F.col("size").alias("used"), same.alias("ok")),
                            F.struct(F.lit(1).alias("edits"), far.alias("used"), edit.alias("ok"))), lambda x: x.ok)
    # the edges of a node are few, so the hash of a partition of them is the smaller side; most pairs end in the join's condition
    moved = states.join(edges.hint("shuffle_hash"), (states.node == edges.parent) & (same | edit)).select(
        "wid", F.col("child").alias("node"), "rest", "shorter", "ends", F.explode(step).alias("step"))
    return moved.select("wid", "node", F.expr("substring(rest, step.used + 1)").alias("rest"), "shorter",
                        F.col("step.edits").alias("edits"), "ends")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, b)``: ids of all pairs of ``words(wid, word)`` that differ by one edit, once each; b is the shorter or, at the edit, smaller.

    Words are distinct and not empty, ids unique. Node hashes that collide only add candidates, and the caller's
    pairs are verified here against the words themselves.
    """
    strings = written(words.select("wid", F.lit(False).alias("back"), F.col("word").alias("s"))
                      .union(words.select("wid", F.lit(True), F.reverse("word"))), "strings")
    prefixes = written(_prefixes(strings), "prefixes")
    edges = _edges(strings, prefixes)
    table = frontier = written(_starts(strings), "states")
    discard(strings, prefixes)
    found = []
    for _ in range(MAX_LEVELS):
        if frontier.isEmpty():
            break
        moved = written(_advance(frontier, edges), "states")
        found.append(written(moved.where("edits = 1 AND rest = ''").select("wid", F.explode("ends").alias("other")), "pairs"))
        discard(table)
        table, frontier = moved, moved.where("size(ends) = 0").drop("ends")
    else:
        raise RuntimeError(f"the tries have over {MAX_LEVELS} levels")
    discard(edges, table)
    pairs = found[0] if found else words.select("wid", F.col("wid").alias("other")).limit(0)
    for more in found[1:]:
        pairs = pairs.union(more)
    pairs = pairs.distinct().withColumnsRenamed({"wid": "a", "other": "b"})
    a, b = words.select(F.col("wid").alias("a"), F.col("word").alias("wa")), words.select(F.col("wid").alias("b"), F.col("word").alias("wb"))
    return pairs.join(a, "a").join(b, "b").where(F.levenshtein("wa", "wb", 1) == 1).select("a", "b")


def _roots(links: DataFrame) -> DataFrame:
    """``(wid, root)`` for each of ``links(wid, form)``: the end of its chain, by doubling the steps taken."""
    now = written(links.select("wid", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("wid").alias("at"), F.col("root").alias("next"))
        new = written(now.join(ahead, now.root == ahead["at"], "left")
                      .select("wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(now)
        now = new.select("wid", "root")
        if new.where("moved").isEmpty():
            return now


def variants(counts: DataFrame, word: str = "word", n: str = "n", factor: int = 10) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each distinct word of ``counts``.

    ``form`` is the near word (one inserted, deleted or replaced code point) with the largest count, of equal ones
    the smallest in code-point order, if that count is at least ``factor`` times the word's; else null. ``root`` is
    the last word on the way over forms, the word itself without one. Counts grow on that way, so it has no circle.
    Repeated rows of a word are added up; rows with a null or empty word or a null count are ignored; an empty table
    gives an empty one; other columns are dropped. Words may have any length.
    """
    if factor <= 1:
        raise ValueError("factor must be over 1")
    kept = counts.select(F.col(word).alias("word"), F.col(n).cast("bigint").alias("n")).where("word != '' AND n IS NOT NULL")
    kept = kept.groupBy("word").agg(F.sum("n").alias("n"))
    words = written(kept.withColumn("wid", F.monotonically_increasing_id()), "words")
    pairs = written(near_pairs(words.select("wid", "word")), "pairs")
    both = pairs.union(pairs.select("b", "a"))
    other = words.select(F.col("wid").alias("b"), F.col("n").alias("form_n"), F.col("word").alias("form"))
    near = (both.join(other, "b").groupBy("a")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form", "b")).alias("best")))
    form_n = -F.col("best.less")
    far = form_n >= F.col("n") * factor
    judged = written(words.join(near, words.wid == near.a, "left").select(
        "wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(far, F.col("best.form")).alias("form"), F.when(far, form_n).alias("form_n"),
        F.when(far, F.col("best.b")).alias("form_wid")), "judged")
    roots = _roots(judged.where("form_wid IS NOT NULL").select("wid", F.col("form_wid").alias("form")))
    named = roots.join(words.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root").select("wid", "root_word")
    return judged.join(named, "wid", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
