"""Secrets in texts: a trigram inverted index picks the texts that a rule can match, the rule verifies them.

For each rule, a Boolean query of trigrams is derived from its pattern. Each batch of texts is
an index segment: the texts of each needed trigram are posted, postings are intersected and united by
the query, and only the texts left are searched. Rules without mandatory trigrams search every text.
"""

from __future__ import annotations

import functools
import itertools
import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.common import PASS_BYTES, bounded_batches, flat, passes


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count if their group ``group`` has at least ``least`` characters."""

    name: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @functools.cached_property
    def compiled(self) -> re.Pattern:
        # ASCII: letters in either case are A-Z and a-z, not the signs that fold to them
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
)


def trigram_query(pattern: str):
    """Boolean query that every match satisfies: ``("and", parts)``, ``("or", parts)``, a trigram, or None.

    None: no trigram is mandatory. Runs of literal characters give the trigrams that they hold, branches an
    "or" of their queries; an optional or unknown part ends a run. Trigrams are lower-case ASCII.
    """
    return _query(_parser.parse(pattern))


def _query(items):
    needs, run = [], ""

    def close() -> None:
        nonlocal run
        needs.extend(run[k:k + 3] for k in range(len(run) - 2))
        run = ""

    def visit(items) -> None:
        nonlocal run
        for op, value in items:
            if op is C.LITERAL and value < 128:
                run += chr(value).lower()
            elif op is C.SUBPATTERN and not (value[1] or value[2]):
                visit(value[3])
            elif op is C.MAX_REPEAT and value[0] == value[1] == 1:
                visit(value[2])
            else:
                close()
                if op is C.BRANCH:
                    needs.append(_any(_query(b) for b in value[1]))
                elif op is C.MAX_REPEAT and value[0] >= 1:
                    needs.append(_query(value[2]))
    visit(items)
    close()
    needs = list(dict.fromkeys(n for n in needs if n))
    return needs[0] if len(needs) == 1 else ("and", tuple(needs)) if needs else None


def _any(queries):
    queries = list(dict.fromkeys(queries))
    return None if None in queries else queries[0] if len(queries) == 1 else ("or", tuple(queries))


def trigrams_of(query) -> set[str]:
    if query is None or isinstance(query, str):
        return {query} - {None}
    return set().union(*map(trigrams_of, query[1]))


@functools.cache
def _codes(names: tuple[str, ...]) -> np.ndarray:
    """For each three bytes: 1 + the number of the trigram among ``names``, or 0."""
    table = np.zeros(1 << 24, np.uint8)
    for k, name in enumerate(names):
        a, b, c = name.encode()
        table[a << 16 | b << 8 | c] = k + 1
    return table


class Segment:
    """Postings of the needed trigrams over some texts: sorted text numbers by trigram."""

    def __init__(self, data: np.ndarray, at: np.ndarray, table: np.ndarray, names: tuple[str, ...]):
        low = data.astype(np.uint32) + np.uint32(32) * ((data >= 65) & (data <= 90))
        self.texts = len(at) - 1
        self.postings = {name: np.zeros(0, np.int64) for name in names}
        if len(low) < 3:
            return
        code = table[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        hit = np.flatnonzero(code)
        text = np.searchsorted(at, hit, "right") - 1
        inside = hit + 3 <= at[text + 1]
        which, text = code[hit[inside]] - 1, text[inside]
        for k, name in enumerate(names):
            self.postings[name] = np.unique(text[which == k])

    def answer(self, query) -> np.ndarray:
        """Numbers of the texts that satisfy ``query``."""
        if query is None:
            return np.arange(self.texts)
        if isinstance(query, str):
            return self.postings[query]
        if query[0] == "or":
            return functools.reduce(np.union1d, map(self.answer, query[1]))
        return functools.reduce(np.intersect1d, sorted(map(self.answer, query[1]), key=len))


def matches(rule: Rule, text: str) -> list[tuple[int, int]]:
    """(start, end) of the leftmost non-overlapping matches that are long enough; others are dropped."""
    return [m.span() for m in rule.compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


SPANS = "array<struct<kind: string, start: int, end: int>>"


def _finder(rules: tuple[Rule, ...]):
    """Function of an Arrow column of texts: rows (text number, start, rule number, end) by text, start and rule."""
    queries = [trigram_query(r.pattern) for r in rules]
    names = tuple(sorted(set().union(*map(trigrams_of, queries))))
    if len(names) > 254:
        raise ValueError("the rules need more than 254 trigrams")

    def find(column: pa.Array) -> list[tuple[int, int, int, int]]:
        data, at = flat(column)
        found: list[tuple[int, int, int, int]] = []
        for i, j in passes(at, PASS_BYTES):
            own, ends = data[at[i]:at[j]], at[i:j + 1] - at[i]
            segment = Segment(own, ends, _codes(names), names)
            held: dict[int, str] = {}
            for k, (rule, query) in enumerate(zip(rules, queries)):
                for t in segment.answer(query).tolist():
                    body = held.get(t)
                    if body is None:
                        body = held[t] = own[ends[t]:ends[t + 1]].tobytes().decode("utf-8", "replace")
                    found += [(i + t, a, k, b) for a, b in matches(rule, body)]
        found.sort()
        return found

    return find


def _lists(found: list[tuple[int, int, int, int]], rules: tuple[Rule, ...], n: int) -> pa.Array:
    count = np.bincount([f[0] for f in found], minlength=n) if found else np.zeros(n, int)
    values = pa.StructArray.from_arrays(
        [pa.array([rules[f[2]].name for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32()),
         pa.array([f[3] for f in found], pa.int32())], ["kind", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), values)


def find_secrets(df: DataFrame, text: str = "text", to: str = "secrets", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """Add ``to``: ``array<struct<kind, start, end>>`` by start and then rule; code points, ends exclusive.

    Whole texts, map-only. A null text counts as empty and gives an empty array; repeated rows give
    repeated results; other columns stay. A column ``to`` must not exist.
    """
    if to in df.columns:
        raise ValueError(f"column {to} exists")
    bounded_batches(df.sparkSession)
    search = _finder(rules)

    @F.arrow_udf(SPANS)
    def find(column: pa.Array) -> pa.Array:
        return _lists(search(column), rules, len(column))

    return df.withColumn(to, find(F.col(text)))


def covered(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each span (start, end, kind) replaced by its kind in brackets; one that overlaps an earlier one only widens it."""
    out, at = [], 0
    for start, end, kind in spans:
        if start < at:
            at = max(at, end)
        else:
            out += [text[at:start], f"[{kind}]"]
            at = end
    return "".join([*out, text[at:]])


def mask_secrets(df: DataFrame, text: str = "text", to: str = "secrets", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """``find_secrets`` with the spans (which refer to the text as it was) replaced by their kinds in ``text``.

    The text is put together where its spans are found, in time linear in both; a text without secrets stays as it is.
    """
    if to in df.columns:
        raise ValueError(f"column {to} exists")
    bounded_batches(df.sparkSession)
    search = _finder(rules)

    @F.arrow_udf(f"struct<spans: {SPANS}, text: string>")
    def find(column: pa.Array) -> pa.Array:
        found = search(column)
        masked: list[str | None] = [None] * len(column)
        for t, rows in itertools.groupby(found, lambda f: f[0]):
            masked[t] = covered(column[t].as_py(), [(a, b, rules[k].name) for _, a, k, b in rows])
        return pa.StructArray.from_arrays([_lists(found, rules, len(column)), pa.array(masked, pa.string())], ["spans", "text"])

    # not deterministic, for the planner: else it puts a copy of the search under each use
    both = df.withColumn("__found", find.asNondeterministic()(F.col(text)))
    return both.withColumns({to: F.col("__found.spans"), text: F.coalesce("__found.text", text)}).drop("__found")
