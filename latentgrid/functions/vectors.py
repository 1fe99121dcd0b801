"""Vector and text column expressions (all JVM-side, inside whole-stage codegen
where Spark allows it). Vectors are ``ARRAY<DOUBLE>`` (or ``ARRAY<FLOAT>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b, check_length: bool = True, k: int | None = None) -> Column:
    """Dot product, summed left to right. Unequal lengths raise, as do lengths other than ``k``.

    With the length ``k`` known the sum is unrolled into plain arithmetic on
    the elements, which whole-stage codegen compiles (the higher-order
    ``aggregate``/``zip_with`` form is interpreted); both sum in the same order.
    """
    a, b = _c(a), _c(b)
    if k is not None and k > 0:
        s = F.lit(0.0).cast("double")
        for i in range(k):
            s = s + a.getItem(i) * b.getItem(i)
    else:
        s = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"),
                        lambda acc, v: acc + v)
    if not check_length:
        return s
    wrong = F.size(a) != F.size(b)
    if k is not None and k > 0:
        wrong = wrong | (F.size(a) != k)
    return F.when(wrong,
                  F.raise_error(F.lit("dot: vectors of different length"))).otherwise(s)


def scale(v, c) -> Column:
    """``c * v`` elementwise."""
    c = c if isinstance(c, Column) else F.lit(c)
    return F.transform(_c(v), lambda x: c * x)


def axpy(v, g, eta) -> Column:
    """``v - eta * g`` elementwise (the gradient step)."""
    eta = eta if isinstance(eta, Column) else F.lit(eta)
    return F.zip_with(_c(v), _c(g), lambda a, b: a - eta * b)


def join_text(v, sep: str = ",") -> Column:
    """Numbers joined into one line, each written as Spark spells the double."""
    return F.array_join(F.transform(_c(v), lambda x: x.cast("string")), sep)


def join_fixed(v, decimals: int = 6, sep: str = ",") -> Column:
    """Numbers joined with a fixed count of decimals (engine-independent text)."""
    fmt = f"%.{decimals}f"
    return F.array_join(F.transform(_c(v), lambda x: F.format_string(fmt, x)), sep)


def parse_numbers(s, sep: str = ",") -> Column:
    """Split a line and read every cell as a double; empty or unreadable -> NaN."""
    return F.transform(F.split(_c(s), sep, -1),
                       lambda t: F.coalesce(_try_double(t), F.lit(float("nan"))))


def _try_double(t: Column) -> Column:
    # ``try_cast`` keeps malformed cells as NULL instead of failing the task
    return F.trim(t).try_cast("double")


def parse_nonempty_numbers(s, sep: str = ",") -> Column:
    """Split, skip empty cells, cast the rest to double (packed-text reader)."""
    toks = F.filter(F.split(_c(s), sep, -1), lambda t: F.trim(t) != F.lit(""))
    return F.transform(toks, lambda t: F.trim(t).cast("double"))
