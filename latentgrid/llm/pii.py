"""Personal data in texts, found by DataFrame functions alone.

Regular expressions propose spans, checksums (Luhn, mod 97) and ranges confirm them, and words
near a span adjust its score.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentgrid.llm.secrets import covered

#: Characters on each side of a span that are searched for context words.
CONTEXT = 40


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes; ``check`` (SQL over ``p.m``) confirms; a context word adds to ``score``.

    Spans whose adjusted score is under ``least`` are dropped. ``needs`` is a string without which
    the pattern can't match.
    """

    name: str
    pattern: str
    check: str = "true"
    score: float = 0.8
    least: float = 0.0
    context: str = ""
    needs: str = ""


_OCTET = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_DIGITS = "regexp_replace(p.m, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s +
    CASE WHEN i % 2 = 1 THEN int(substring(reverse({_DIGITS}), i, 1))
         ELSE int(substring('0246813579', int(substring(reverse({_DIGITS}), i, 1)) + 1, 1)) END) % 10 = 0"""
_MOD97 = """aggregate(split(replace(concat(substring(p.m, 5), substring(p.m, 1, 4)), ' ', ''), ''), 0, (s, c) ->
    CASE WHEN c = '' THEN s WHEN c BETWEEN '0' AND '9' THEN (s * 10 + int(c)) % 97
         ELSE (s * 100 + ascii(c) - 55) % 97 END) = 1"""

# A proposal that fails its check is dropped and not tried again from a later start. The patterns
# look for whole runs (possessive, and starting where a run or the search starts), so that each
# text is searched in linear time; they match what the plain forms match.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         context="(?i)mail|contact|write", needs="@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", rf"p.m RLIKE r'^{_OCTET}([.]{_OCTET}){{3}}$'",
         score=0.6, context="(?i)address|host|server|login", needs="."),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}",
         score=0.7, context="(?i)card|visa|pay|credit"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15",
         score=0.6, context="(?i)phone|call|tel|fax|mobile", needs="+"),
)
EXTRA = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", _MOD97,
         context="(?i)iban|account|bank"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         r"p.m NOT RLIKE r'^(000|666|9..)|-00-|-0000$'",
         score=0.3, least=0.5, context="(?i)ssn|social security|tax id", needs="-"),
)
BONUS = 0.2


EMPTY = "cast(array() AS array<struct<kind: string, start: int, end: int, score: double>>)"


#: Matches whose lengths are added up together.
BLOCK = 256


def _bound(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _sum(values: str) -> str:
    return f"aggregate({values}, 0, (a, v) -> a + v)"


def spans_sql(kind: Kind, text: str) -> str:
    """SQL for the spans of one kind in the string ``text``: ``array<struct<kind, start, end, score>>``.

    Offsets count code points, ends are exclusive. The text is cut at the matches; a match starts after the pieces
    and matches before it, whose lengths are added up in two levels: within its block of matches, and over the
    blocks before. The ends of the neighbouring pieces are the context.
    """
    found = f"named_struct('m', regexp_extract_all({text}, r'{kind.pattern}', 0), 'g', split({text}, r'{kind.pattern}', -1))"
    lengths = "transform(z.m, (m, i) -> length(z.g[i]) + length(m))"
    totals = f"transform(sequence(0, int((size(n) - 1) div {BLOCK})), b -> {_sum(f'slice(n, b * {BLOCK} + 1, {BLOCK})')})"
    before = f"transform(sequence(0, size(t) - 1), i -> {_sum('slice(t, 1, i)')})"
    start = f"at[int(i div {BLOCK})] + {_sum(f'slice(n, int(i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK})')} + length(z.g[i])"
    proposals = f"""transform(z.m, (m, i) -> named_struct('m', m, 's', {start},
        'near', concat(right(z.g[i], {CONTEXT}), ' ', left(z.g[i + 1], {CONTEXT}))))"""
    placed = _bound(found, "z", _bound(lengths, "n", _bound(totals, "t", _bound(before, "at", proposals))))
    return f"""CASE WHEN {f"contains({text}, '{kind.needs}')" if kind.needs else "true"} THEN
    filter(transform(filter({placed}, p -> {kind.check}),
      p -> named_struct('kind', '{kind.name}', 'start', p.s, 'end', p.s + length(p.m), 'score',
        least(1D, {kind.score}D + if(p.near RLIKE r'{kind.context}', {BONUS}D, 0D)))),
      s -> s.score >= {kind.least}D)
    ELSE {EMPTY} END"""


def find_pii(df: DataFrame, text: str = "text", to: str = "pii", kinds: tuple[Kind, ...] = BASE + EXTRA) -> DataFrame:
    """Add ``to``: the spans of all ``kinds`` in the order listed, then by start.

    Map-only and native. A null text counts as empty and gives an empty array; repeated rows give
    repeated results; other columns stay as they are. Spans of different kinds may overlap.
    """
    if to in df.columns:
        raise ValueError(f"column {to} exists")
    own = f"coalesce(`{text}`, '')"
    return df.withColumn(to, F.expr(f"concat({', '.join(spans_sql(k, own) for k in kinds)})"))


def redact(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Replace each span of ``text`` by its kind in brackets; a span that overlaps an earlier one only widens it.

    The text is put together in an Arrow function, linear in text and spans; finding them needs none.
    """
    @F.arrow_udf("string")
    def cover(column: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([t if not rows else covered(t, sorted((s["start"], s["end"], s["kind"]) for s in rows))
                         for t, rows in zip(column.to_pylist(), found.to_pylist())], pa.string())

    return df.withColumn(text, cover(F.col(text), F.col(spans)))


def digest(spans: str) -> str:
    """SQL: ``kind:start:end`` of all spans, comma-joined."""
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
