"""DuckDB SQL oracles for the registered queries (same column names and types).

The driver pre-registers the tables as views. Every statement derives the
fixture from ``lineitem`` and ``orders`` itself.
"""

from __future__ import annotations

P = 8
K = 4
VECTOR_DIM = 100
VECTOR_K = 64
PACK_PIECE = 50
FACTOR_PIECE = 30
ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"

R = f"""r AS (
  SELECT o_custkey AS x_id, l_partkey AS y_id,
         CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating,
         {ORDER}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

G = f"""g AS (
  SELECT max(x_id) AS max_x, max(y_id) AS max_y,
         (max(x_id) + {P}) // {P} AS xd, (max(y_id) + {P}) // {P} AS yd FROM r)"""

B = """b AS (
  SELECT r.*, CAST(x_id // xd AS INTEGER) AS xb, CAST(y_id // yd AS INTEGER) AS yb FROM r, g)"""

FULL = f"""fullgrid AS (
  SELECT CAST(i // {P} AS INTEGER) AS xb, CAST(i % {P} AS INTEGER) AS yb FROM range({P * P}) t(i))"""


def pmod(a: str, p: int = P) -> str:
    return f"((({a}) % {p}) + {p}) % {p}"


def hash_value(side: str, idc: str, k: int, seed: int = 1) -> str:
    return (f"(('0x' || substr(md5(concat_ws(':', '{seed}', {side}, CAST({idc} AS VARCHAR), "
            f"'{k}')), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE")


INIT = f"""ids AS (
  SELECT 'W' AS side, unnest(range(0, {P} * xd)) AS id, xd AS dim FROM g
  UNION ALL
  SELECT 'H' AS side, unnest(range(0, {P} * yd)) AS id, yd AS dim FROM g),
init AS (
  SELECT side, id, CAST(id // dim AS INTEGER) AS block,
         [{", ".join(hash_value("side", "id", k) for k in range(K))}] AS v
  FROM ids)"""


INIT_SEEN = f"""ids AS (
  SELECT DISTINCT 'W' AS side, x_id AS id, xd AS dim FROM r, g
  UNION ALL
  SELECT DISTINCT 'H' AS side, y_id AS id, yd AS dim FROM r, g),
init AS (
  SELECT side, id, CAST(id // dim AS INTEGER) AS block,
         [{", ".join(hash_value("side", "id", k) for k in range(K))}] AS v
  FROM ids)"""

VECTORS = f"""init AS (
  SELECT 'W' AS side, vec_id AS id, CAST(vec_id // {VECTOR_DIM} AS INTEGER) AS block,
         list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  UNION ALL
  SELECT 'H' AS side, vec_id AS id, CAST(vec_id // {VECTOR_DIM} AS INTEGER) AS block,
         list_transform(embedding, lambda x: x::DOUBLE * 2) AS v FROM embeddings)"""


def spread(v: str = "v", decimals: int | None = 6, prefix: str = "f", n: int = K) -> str:
    if decimals is None:
        return ", ".join(f"{v}[{k + 1}] AS {prefix}{k}" for k in range(n))
    return ", ".join(f"round({v}[{k + 1}], {decimals}) AS {prefix}{k}" for k in range(n))


def fixed(v: str) -> str:
    """Six decimals, ties (such as 0.2578125, which the whole embeddings hold) away from zero, as Java formats them."""
    return f"printf('%.6f', round({v}, 6))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


QUARANTINE_LINES = """lines AS (
  SELECT CASE
    WHEN l_linenumber = 7 THEN concat_ws(',', CAST(x_id AS VARCHAR), 'p' || CAST(y_id AS VARCHAR), CAST(rating AS VARCHAR))
    WHEN l_quantity = 50 THEN concat_ws(',', CAST(x_id AS VARCHAR), CAST(y_id AS VARCHAR))
    WHEN l_quantity = 49 THEN concat_ws(',', CAST(x_id AS VARCHAR), CAST(y_id AS VARCHAR), 'n/a')
    ELSE concat_ws(',', CAST(x_id AS VARCHAR), CAST(y_id AS VARCHAR), CAST(rating AS VARCHAR), CAST(l_orderkey AS VARCHAR))
  END AS line FROM r),
toks AS (SELECT line, string_split(line, ',') AS t FROM lines),
parsed AS (
  SELECT line, len(t) AS nt,
    CASE WHEN regexp_matches(t[1], '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim(t[1]) AS BIGINT) END AS x,
    CASE WHEN regexp_matches(t[2], '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim(t[2]) AS BIGINT) END AS y,
    TRY_CAST(trim(t[3]) AS DOUBLE) AS rr
  FROM toks),
judged AS (
  SELECT *, CASE WHEN nt < 3 THEN 'fewer than three fields'
                 WHEN x IS NULL THEN 'bad row id'
                 WHEN y IS NULL THEN 'bad column id'
                 WHEN rr IS NULL THEN 'bad rating' END AS reason
  FROM parsed)"""

EVAL_JOIN = """pred AS (
  SELECT r.*, list_dot_product(w.v, h.v) AS prediction
  FROM r JOIN init w ON w.side = 'W' AND w.id = r.x_id
         JOIN init h ON h.side = 'H' AND h.id = r.y_id)"""

SEGMENT_W = """segw AS (
  SELECT i.* FROM init i WHERE i.side = 'W'
    AND i.id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))"""


def _one_sample() -> str:
    c = "(-2.0::DOUBLE * e)"
    w2 = ", ".join(f"w[{k + 1}] - 0.001::DOUBLE * ({c} * h[{k + 1}]) AS w2_{k}" for k in range(K))
    h2 = ", ".join(f"h[{k + 1}] - 0.001::DOUBLE * ({c} * w2_{k}) AS h2_{k}" for k in range(K))
    outw = ", ".join(f"round(w2_{k}, 6) AS w{k}" for k in range(K))
    outh = ", ".join(f"round(h2_{k}, 6) AS h{k}" for k in range(K))
    return (with_(R, G, INIT, """j AS (
  SELECT r.*, w.v AS w, h.v AS h, r.rating - list_dot_product(w.v, h.v) AS e
  FROM r JOIN init w ON w.side = 'W' AND w.id = r.x_id
         JOIN init h ON h.side = 'H' AND h.id = r.y_id)""",
                  f"j2 AS (SELECT *, {w2} FROM j)", f"j3 AS (SELECT *, {h2} FROM j2)")
            + f"SELECT x_id, y_id, {ORDER}, {outw}, {outh} FROM j3")


ORACLES = {
    "ratings_scan": with_(R) + "SELECT * FROM r",
    "ratings_parse_text": with_(R) + "SELECT x_id, y_id, rating FROM r",
    "ratings_parse_double_colon": with_(R) + "SELECT x_id, y_id, rating FROM r",
    "ratings_quarantine": with_(R, QUARANTINE_LINES) + """
SELECT 'good' AS status, x AS x_id, y AS y_id, rr AS rating, CAST(NULL AS VARCHAR) AS reason
FROM judged WHERE reason IS NULL
UNION ALL
SELECT 'bad', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), reason
FROM judged WHERE reason IS NOT NULL""",
    "ratings_prefix": with_(R) + f"SELECT * FROM r ORDER BY {ORDER} LIMIT (SELECT count(*) // 6 FROM r)",
    "grid_dims": with_(R, G) + f"SELECT CAST({P} AS BIGINT) AS p, max_x, max_y, xd AS x_dim, yd AS y_dim FROM g",
    "block_assign": with_(R, G, B) + "SELECT * FROM b",
    "block_offset": with_(R, G) + """SELECT r.*, CAST(x_id % xd AS INTEGER) AS x_off,
       CAST(y_id % yd AS INTEGER) AS y_off FROM r, g""",
    "block_counts": with_(R, G, B, FULL, "c AS (SELECT xb, yb, count(*) AS n FROM b GROUP BY xb, yb)") +
        f"""SELECT f.xb, f.yb, CAST({pmod("f.yb - f.xb")} AS INTEGER) AS stratum,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM fullgrid f LEFT JOIN c ON c.xb = f.xb AND c.yb = f.yb""",
    "rating_faults": with_(R, G, f"""d AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN CASE WHEN l_quantity = 48 THEN -1 - x_id ELSE x_id END END AS x,
         CASE WHEN l_quantity = 47 THEN y_id + {P} * yd ELSE y_id END AS y, {P} * xd AS nx, {P} * yd AS ny,
         CASE WHEN l_quantity IN (49, 50) THEN NULL ELSE rating END AS v FROM r, g)""", """f AS (
  SELECT x IS NULL OR y IS NULL AS f1, v IS NULL AS f2,
         coalesce(x < 0, false) OR coalesce(y < 0, false) AS f3, coalesce(x >= nx, false) OR coalesce(y >= ny, false) AS f4 FROM d)""",
        "c AS (SELECT count(*) AS clean FROM f WHERE NOT (f1 OR f2 OR f3 OR f4))") + " UNION ALL ".join(
        f"SELECT '{name}' AS fault, (SELECT count(*) FROM f WHERE {col}) AS n, clean FROM c" for name, col in (
            ("null_id", "f1"), ("null_rating", "f2"), ("negative_id", "f3"), ("outside_grid", "f4"))),
    "step_layout": with_(R, G, B) + f"""SELECT CAST({pmod("yb - xb")} AS INTEGER) AS step, xb, count(*) AS n
FROM b GROUP BY 1, 2""",
    "stratum_rows": with_(R, G, B) + f"""SELECT *, CAST({pmod("yb - xb")} AS INTEGER) AS stratum,
       xb AS work FROM b""",
    "stratum_counts": with_(R, G, B) + f"""SELECT CAST({pmod("yb - xb")} AS INTEGER) AS stratum,
       count(*) AS n, count(DISTINCT xb) AS row_blocks, count(DISTINCT yb) AS col_blocks
FROM b GROUP BY 1""",
    "schedule_diagonal": with_(R, G, B, FULL, "c AS (SELECT xb, yb, count(*) AS n FROM b GROUP BY xb, yb)") +
        f"""SELECT CAST({pmod("f.yb - f.xb")} AS INTEGER) AS step, f.xb, f.yb,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM fullgrid f LEFT JOIN c ON c.xb = f.xb AND c.yb = f.yb""",
    "schedule_row_major": with_(R, G, B, FULL, "c AS (SELECT xb, yb, count(*) AS n FROM b GROUP BY xb, yb)") +
        """SELECT CAST(f.xb + f.yb AS INTEGER) AS step, f.xb, f.yb,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM fullgrid f LEFT JOIN c ON c.xb = f.xb AND c.yb = f.yb""",
    "rotation_identity": with_(R, G, "hs AS (SELECT DISTINCT y_id AS id, yd FROM r, g)",
                               "st AS (SELECT CAST(s AS INTEGER) AS step FROM range(%d) t(s))" % P,
                               f"""hw AS (SELECT id, CAST(id // yd AS INTEGER) AS block, step,
       CAST({pmod("CAST(id // yd AS INTEGER) - step")} AS INTEGER) AS work FROM hs, st)""") +
        f"SELECT id, block, step, work, CAST({pmod('work + step')} AS INTEGER) AS back FROM hw",
    "blocks_packed": with_(R, G, B, FULL, f"""ps AS (
  SELECT *, row_number() OVER (PARTITION BY xb, yb ORDER BY {ORDER}) - 1 AS pos FROM b),
pk AS (
  SELECT xb, yb, pos - pos % {PACK_PIECE} AS start, string_agg(CAST(x_id AS VARCHAR) || ',' || CAST(y_id AS VARCHAR) || ',' ||
                            CAST(rating AS VARCHAR) || ';', '' ORDER BY pos) AS packed
  FROM ps GROUP BY xb, yb, start)""") + f"""SELECT f.xb, f.yb, CAST(f.xb * {P} + f.yb AS INTEGER) AS line_no,
       CAST(coalesce(pk.start, 0) AS BIGINT) AS start, coalesce(pk.packed, '') AS packed
FROM fullgrid f LEFT JOIN pk ON pk.xb = f.xb AND pk.yb = f.yb""",
    "blocks_unpacked": with_(R, G, B) + f"""SELECT xb, yb,
       CAST(row_number() OVER (PARTITION BY xb, yb ORDER BY {ORDER}) - 1 AS BIGINT) AS pos,
       x_id, y_id, rating FROM b""",
    "factors_init": with_(R, G, INIT_SEEN) + f"SELECT side, id, block, {spread(decimals=None)} FROM init",
    "factors_text": with_(VECTORS) + "SELECT side, id, " +
        " || ',' || ".join(fixed(f"v[{k + 1}]") for k in range(VECTOR_K)) + " AS line FROM init",
    "factors_parsed": with_(VECTORS) + "SELECT side, id, " +
        ", ".join(f"CAST({fixed(f'v[{k + 1}]')} AS DOUBLE) AS f{k}" for k in range(VECTOR_K)) + " FROM init",
    "factors_packed": with_(VECTORS) + "SELECT side, block, string_agg(" +
        " || ".join(f"{fixed(f'v[{k + 1}]')} || ','" for k in range(VECTOR_K)) +
        " || ';', '' ORDER BY id) AS packed FROM init GROUP BY side, block",
    "factors_packed_pieces": with_(VECTORS) + f"SELECT side, block, id % {VECTOR_DIM} - id % {VECTOR_DIM} % {FACTOR_PIECE} AS start, string_agg(" +
        " || ".join(f"{fixed(f'v[{k + 1}]')} || ','" for k in range(VECTOR_K)) +
        " || ';', '' ORDER BY id) AS packed FROM init GROUP BY 1, 2, 3",
    "factors_flattened": with_(VECTORS) + "SELECT side, id, block, " +
        ", ".join(f"CAST({fixed(f'v[{k + 1}]')} AS DOUBLE) AS f{k}" for k in range(VECTOR_K)) + " FROM init",
    "dot_products": with_("v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)") +
        """SELECT a.vec_id, a.label, round(list_dot_product(a.v, a.v), 6) AS self_dot,
       round(list_dot_product(a.v, b.v), 6) AS next_dot
FROM v a LEFT JOIN v b ON b.vec_id = a.vec_id + 1""",
    "vector_axpy": with_("v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
                         "x AS (SELECT a.vec_id, a.v AS v, b.v AS w FROM v a JOIN v b ON b.vec_id = a.vec_id + 1)",
                         "y AS (SELECT vec_id, v, w, unnest(range(0, len(v))) AS k FROM x)") +
        """SELECT vec_id, CAST(k AS INTEGER) AS k, round(2.0::DOUBLE * v[k + 1], 6) AS scaled,
       round(v[k + 1] - 0.25::DOUBLE * w[k + 1], 6) AS stepped FROM y""",
    "predictions": with_(R, G, INIT, EVAL_JOIN) +
        "SELECT * EXCLUDE (prediction), round(prediction, 6) AS prediction FROM pred",
    "predictions_drop": with_(R, G, INIT, SEGMENT_W) + """SELECT r.*, round(list_dot_product(w.v, h.v), 6) AS prediction
FROM r JOIN segw w ON w.id = r.x_id JOIN init h ON h.side = 'H' AND h.id = r.y_id""",
    "missing_ids": with_(R, G, INIT, SEGMENT_W) + "SELECT r.* FROM r WHERE r.x_id NOT IN (SELECT id FROM segw)",
    "rmse_global": with_(R, G, INIT, EVAL_JOIN) + """SELECT round(sum((rating - prediction) * (rating - prediction)), 4) AS squared_error,
       count(*) AS n,
       round(sqrt(sum((rating - prediction) * (rating - prediction)) / count(*)), 6) AS rmse
FROM pred""",
    "rmse_blocks": with_(R, G, INIT, EVAL_JOIN) + f"""SELECT CAST(x_id // xd AS INTEGER) AS xb, CAST(y_id // yd AS INTEGER) AS yb,
       CAST({pmod("CAST(y_id // yd AS INTEGER) - CAST(x_id // xd AS INTEGER)")} AS INTEGER) AS stratum,
       round(sum((rating - prediction) * (rating - prediction)), 6) AS squared_error,
       count(*) AS n,
       round(sqrt(sum((rating - prediction) * (rating - prediction)) / count(*)), 6) AS rmse
FROM pred, g GROUP BY 1, 2, 3""",
    "rmse_rollup": with_(R, G, INIT, EVAL_JOIN, f"""pb AS (
  SELECT CAST({pmod("CAST(y_id // yd AS INTEGER) - CAST(x_id // xd AS INTEGER)")} AS INTEGER) AS stratum,
         CAST(x_id // xd AS INTEGER) AS xb, (rating - prediction) * (rating - prediction) AS se
  FROM pred, g)""") + """SELECT CASE grouping(stratum, xb) WHEN 0 THEN 'block' WHEN 1 THEN 'stratum' ELSE 'total' END AS level,
       stratum, xb, round(sum(se), 4) AS squared_error, count(*) AS n,
       round(sqrt(sum(se) / count(*)), 6) AS rmse
FROM pb GROUP BY ROLLUP (stratum, xb)""",
    "sgd_one_sample": _one_sample(),
    "ratings_prefix_large": with_(R) + f"SELECT * FROM r ORDER BY {ORDER} LIMIT (SELECT count(*) // 2 FROM r)",
    "ratings_text_file": with_(R) + "SELECT x_id, y_id, rating FROM r",
    "ratings_header_file": with_(R) + "SELECT x_id, y_id, rating FROM r",
    "ratings_blocked_stratum": with_(R, G, B) + f"""SELECT * FROM (
  SELECT *, CAST({pmod("yb - xb")} AS INTEGER) AS stratum FROM b) WHERE stratum = 3""",
    "factors_text_file": with_(VECTORS) + f"SELECT side, id, {spread(decimals=None, n=VECTOR_K)} FROM init",
    "factors_native": with_(VECTORS) + f"SELECT side, id, block, {spread(decimals=None, n=VECTOR_K)} FROM init",
}


# -- one seeded stream, drawn one after another ------------------------------------------

ORACLES["ratings_appended"] = with_(R, G, B) + f"SELECT *, CAST({pmod('yb - xb')} AS INTEGER) AS stratum FROM b"

ORACLES["factors_init_stream"] = with_(R, G, f"""draws(n, x1, x2) AS (
  SELECT CAST(0 AS BIGINT), CAST(3 * 40014 % 2147483563 AS BIGINT), CAST(4 * 40692 % 2147483399 AS BIGINT)
  UNION ALL
  SELECT n + 1, x1 * 40014 % 2147483563, x2 * 40692 % 2147483399 FROM draws, g WHERE n + 1 < {P} * (xd + yd) * {K}),
u AS (
  SELECT n // {K} AS row, n % {K} AS k,
         CASE WHEN {pmod("x1 - x2", 2147483562)} = 0 THEN 2147483562 ELSE {pmod("x1 - x2", 2147483562)} END::DOUBLE
           / 2147483563.0::DOUBLE AS v FROM draws),
wide AS (SELECT row, {", ".join(f"max(v) FILTER (k = {k}) AS f{k}" for k in range(K))} FROM u GROUP BY row)""").replace(
    "WITH ", "WITH RECURSIVE ", 1) + f"""SELECT CASE WHEN row < {P} * xd THEN 'W' ELSE 'H' END AS side,
       CASE WHEN row < {P} * xd THEN row ELSE row - {P} * xd END AS id,
       CAST(CASE WHEN row < {P} * xd THEN row // xd ELSE (row - {P} * xd) // yd END AS INTEGER) AS block,
       {", ".join(f"f{k}" for k in range(K))} FROM wide, g"""

ORACLES["missing_id_set"] = with_(R) + """SELECT DISTINCT 'W' AS side, x_id AS id FROM r
WHERE x_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""


ORACLES["blocks_packed_file"] = with_(R, G, B, FULL, f"""pk AS (
  SELECT xb, yb, string_agg(CAST(x_id AS VARCHAR) || ',' || CAST(y_id AS VARCHAR) || ',' || CAST(rating AS VARCHAR) || ';', ''
                            ORDER BY {ORDER}) AS packed FROM b GROUP BY xb, yb)""") + f"""
SELECT CAST(f.xb * {P} + f.yb AS BIGINT) AS line_no, coalesce(pk.packed, '') AS packed
FROM fullgrid f LEFT JOIN pk ON pk.xb = f.xb AND pk.yb = f.yb"""
ORACLES["factors_packed_file"] = ORACLES["factors_packed"]

# the blocks' edges by counts: the id of each side at rank ceil(n * k / P), and the one after it
CROWDED = R.replace("r AS (", "r0 AS (") + """,
r AS (SELECT x_id * x_id // 4096 AS x_id, y_id * y_id // 4096 AS y_id, * EXCLUDE (x_id, y_id) FROM r0)"""
EDGES = f"""cuts AS (
  SELECT unnest(range(1, {P})) AS k, (SELECT count(*) FROM r) AS n),
ranked AS (
  SELECT x_id, y_id, row_number() OVER (ORDER BY x_id) AS rx, row_number() OVER (ORDER BY y_id) AS ry FROM r),
ex AS (SELECT x_id + 1 AS e FROM ranked, cuts WHERE rx = CAST(ceil(n * k / {P}.0) AS BIGINT)),
ey AS (SELECT y_id + 1 AS e FROM ranked, cuts WHERE ry = CAST(ceil(n * k / {P}.0) AS BIGINT)),
bx AS (SELECT i.id, CAST(count(e) AS INTEGER) AS b FROM (SELECT unnest(range(0, {P} * xd)) AS id FROM g) i LEFT JOIN ex ON e <= i.id GROUP BY i.id),
byy AS (SELECT i.id, CAST(count(e) AS INTEGER) AS b FROM (SELECT unnest(range(0, {P} * yd)) AS id FROM g) i LEFT JOIN ey ON e <= i.id GROUP BY i.id)"""


def _largest(name: str, side: str, block: str) -> str:
    return (f"SELECT '{name}' AS balance, '{side}' AS side, max(n) AS largest, CAST(sum(n) AS BIGINT) AS n "
            f"FROM (SELECT {block} AS b, count(*) AS n FROM r, g, bx, byy WHERE bx.id = x_id AND byy.id = y_id GROUP BY 1)")


ORACLES["block_counts_balanced"] = with_(CROWDED, G, EDGES) + " UNION ALL ".join(
    _largest(*a) for a in (("range", "xb", "x_id // xd"), ("range", "yb", "y_id // yd"), ("counts", "xb", "bx.b"), ("counts", "yb", "byy.b")))


# -- training: serial SGD as a set-based recursive query --------------------------------
#
# One stratum's blocks share no x and no y, so the fit equals serial SGD over
# the samples ordered by (epoch, step order, order columns). The recursion
# keeps one row per factor id with the number of its samples applied so far;
# each round applies every sample that is next in line for both its x and its
# y (such samples touch distinct rows), which is the serial result.

ETA0 = "0.001::DOUBLE"
ETA1 = "0.001::DOUBLE * 0.99::DOUBLE"


def _upd(base: str, other: str) -> str:
    c = "(-2.0::DOUBLE * u.e)"
    return "[" + ", ".join(f"{base}[{k + 1}] - u.eta * ({c} * {other}[{k + 1}])" for k in range(K)) + "]"


def _sgd_ctes(order: str, epochs: list, sample_filter: str = "TRUE") -> str:
    ep = " UNION ALL ".join(f"SELECT {e} AS epoch, {eta} AS eta" for e, eta in epochs)
    return f"""ep AS ({ep}),
s0 AS (
  SELECT r.*, CAST(x_id // xd AS INTEGER) AS xb, CAST(y_id // yd AS INTEGER) AS yb FROM r, g),
s1 AS (
  SELECT s0.*, CAST({pmod("yb - xb")} AS INTEGER) AS stratum FROM s0 WHERE {sample_filter}),
samples AS (
  SELECT s1.x_id, s1.y_id, s1.rating, ep.epoch, ep.eta,
         row_number() OVER (PARTITION BY s1.x_id ORDER BY ep.epoch, {order}) - 1 AS rx,
         row_number() OVER (PARTITION BY s1.y_id ORDER BY ep.epoch, {order}) - 1 AS ry
  FROM s1, ep),
first_epoch AS (
  SELECT 'W' AS side, x_id AS id, count(*) AS n0 FROM samples WHERE epoch = 0 GROUP BY x_id
  UNION ALL
  SELECT 'H', y_id, count(*) FROM samples WHERE epoch = 0 GROUP BY y_id),
init2 AS (
  SELECT i.side, i.id, i.block, i.v, coalesce(f.n0, 0) AS n0
  FROM init i LEFT JOIN first_epoch f ON f.side = i.side AND f.id = i.id),
st(it, side, id, block, v, cnt, n0, snap) AS (
  SELECT 0, side, id, block, v, CAST(0 AS BIGINT), n0, CASE WHEN n0 = 0 THEN v END FROM init2
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT * FROM st),
    ready AS (
      SELECT s.x_id, s.y_id, s.rating, s.eta, w.v AS w, h.v AS h
      FROM samples s
      JOIN cur w ON w.side = 'W' AND w.id = s.x_id AND w.cnt = s.rx
      JOIN cur h ON h.side = 'H' AND h.id = s.y_id AND h.cnt = s.ry),
    u0 AS (SELECT *, rating - list_dot_product(w, h) AS e FROM ready),
    u1 AS (SELECT u.*, {_upd("u.w", "u.h")} AS w2 FROM u0 u),
    u2 AS (SELECT u.*, {_upd("u.h", "u.w2")} AS h2 FROM u1 u),
    nxt AS (
      SELECT c.it, c.side, c.id, c.block, c.v, c.cnt, c.n0, c.snap,
             coalesce(uw.w2, uh.h2) AS nv
      FROM cur c
      LEFT JOIN u2 uw ON c.side = 'W' AND uw.x_id = c.id
      LEFT JOIN u2 uh ON c.side = 'H' AND uh.y_id = c.id
      WHERE EXISTS (SELECT 1 FROM u2))
    SELECT it + 1, side, id, block, coalesce(nv, v),
           cnt + CASE WHEN nv IS NULL THEN 0 ELSE 1 END, n0,
           CASE WHEN nv IS NOT NULL AND cnt + 1 = n0 THEN nv ELSE snap END
    FROM nxt)),
final AS (SELECT * FROM st WHERE it = (SELECT max(it) FROM st))"""


def sgd_factors_sql(order: str, epochs: list, sample_filter: str = "TRUE") -> str:
    body = with_(R, G, INIT, _sgd_ctes(order, epochs, sample_filter)).replace(
        "WITH ", "WITH RECURSIVE ", 1)
    return body + f"SELECT side, id, block, {spread('v')} FROM final"


def sgd_history_sql(order: str) -> str:
    body = with_(R, G, INIT, _sgd_ctes(order, [(0, ETA0), (1, ETA1)])).replace(
        "WITH ", "WITH RECURSIVE ", 1)
    return body + f"""SELECT e.epoch, e.eta,
       round(sum((r.rating - list_dot_product(CASE e.epoch WHEN 0 THEN w.snap ELSE w.v END,
                                              CASE e.epoch WHEN 0 THEN h.snap ELSE h.v END)) *
                 (r.rating - list_dot_product(CASE e.epoch WHEN 0 THEN w.snap ELSE w.v END,
                                              CASE e.epoch WHEN 0 THEN h.snap ELSE h.v END))), 4)
         AS squared_error,
       count(*) AS n,
       round(sqrt(sum((r.rating - list_dot_product(CASE e.epoch WHEN 0 THEN w.snap ELSE w.v END,
                                                   CASE e.epoch WHEN 0 THEN h.snap ELSE h.v END)) *
                      (r.rating - list_dot_product(CASE e.epoch WHEN 0 THEN w.snap ELSE w.v END,
                                                   CASE e.epoch WHEN 0 THEN h.snap ELSE h.v END))) / count(*)), 6)
         AS rmse
FROM r JOIN final w ON w.side = 'W' AND w.id = r.x_id
       JOIN final h ON h.side = 'H' AND h.id = r.y_id
       CROSS JOIN ep e
GROUP BY e.epoch, e.eta"""


def sgd_history_blocks_sql(order: str) -> str:
    body = with_(R, G, INIT, _sgd_ctes(order, [(0, ETA0), (1, ETA1)])).replace(
        "WITH ", "WITH RECURSIVE ", 1)
    return body + """, miss AS (
  SELECT e.epoch, w.block AS xb, h.block AS yb,
         r.rating - list_dot_product(CASE e.epoch WHEN 0 THEN w.snap ELSE w.v END,
                                     CASE e.epoch WHEN 0 THEN h.snap ELSE h.v END) AS d
  FROM r JOIN final w ON w.side = 'W' AND w.id = r.x_id
         JOIN final h ON h.side = 'H' AND h.id = r.y_id
         CROSS JOIN ep e)
SELECT epoch, xb, yb, round(sum(d * d), 4) AS squared_error, count(*) AS n FROM miss GROUP BY epoch, xb, yb"""


DIAGONAL_ORDER = f"stratum, xb, {ORDER}"
ROW_MAJOR_ORDER = f"xb, yb, {ORDER}"

ORACLES.update({
    "sgd_one_stratum": sgd_factors_sql(DIAGONAL_ORDER, [(0, ETA0)], "stratum = 0"),
    "sgd_one_epoch": sgd_factors_sql(DIAGONAL_ORDER, [(0, ETA0)]),
    "sgd_fit": sgd_factors_sql(DIAGONAL_ORDER, [(0, ETA0), (1, ETA1)]),
    "sgd_history": sgd_history_sql(DIAGONAL_ORDER),
    "sgd_history_blocks": sgd_history_blocks_sql(DIAGONAL_ORDER),
    "sgd_resume": sgd_factors_sql(DIAGONAL_ORDER, [(0, ETA0), (1, ETA1)]),
    "sgd_row_major": sgd_factors_sql(ROW_MAJOR_ORDER, [(0, ETA0), (1, ETA1)]),
    "sgd_warm_start": sgd_factors_sql(DIAGONAL_ORDER, [(0, ETA0), (1, ETA1)]),
})

# the same fit on the grid with edges by counts
ORACLES["sgd_balanced"] = sgd_factors_sql(DIAGONAL_ORDER, [(0, ETA0)]).replace(
    R, CROWDED).replace(G, G + ",\n" + EDGES).replace(
    "CAST(x_id // xd AS INTEGER) AS xb, CAST(y_id // yd AS INTEGER) AS yb FROM r, g)",
    "bx.b AS xb, byy.b AS yb FROM r, g, bx, byy WHERE bx.id = x_id AND byy.id = y_id)").replace(
    "CAST(id // dim AS INTEGER) AS block", "CASE side WHEN 'W' THEN (SELECT b FROM bx WHERE bx.id = ids.id) ELSE (SELECT b FROM byy WHERE byy.id = ids.id) END AS block")


def sgd_float_history_sql(order: str) -> str:
    """The history of a fit in 32-bit arithmetic; errors are summed in 64 bits."""
    init = INIT.replace("         [(", "         CAST([(", 1).replace("] AS v", "] AS FLOAT[]) AS v", 1)
    steps = _sgd_ctes(order, [(0, ETA0), (1, ETA1)]).replace("-2.0::DOUBLE", "-2.0::FLOAT").replace(
        "u.eta *", "u.eta::FLOAT *").replace("rating - list_dot_product(w, h) AS e", "rating::FLOAT - list_dot_product(w, h) AS e")
    return with_(R, G, init, steps).replace("WITH ", "WITH RECURSIVE ", 1) + """, miss AS (
  SELECT e.epoch, e.eta, r.rating - list_dot_product(CAST(CASE e.epoch WHEN 0 THEN w.snap ELSE w.v END AS DOUBLE[]),
                                                     CAST(CASE e.epoch WHEN 0 THEN h.snap ELSE h.v END AS DOUBLE[])) AS d
  FROM r JOIN final w ON w.side = 'W' AND w.id = r.x_id
         JOIN final h ON h.side = 'H' AND h.id = r.y_id
         CROSS JOIN ep e)
SELECT epoch, eta, count(*) AS n, round(sqrt(sum(d * d) / count(*)), 4) AS rmse FROM miss GROUP BY epoch, eta"""


ORACLES["sgd_float_history"] = sgd_float_history_sql(DIAGONAL_ORDER)
# read from files, the samples of a block are ordered by their ids and rating alone (equal ones are interchangeable)
ORACLES["train_then_evaluate"] = with_(R, G, INIT, _sgd_ctes(f"stratum, xb, x_id, y_id, rating, {ORDER}", [(0, ETA0)])).replace(
    "WITH ", "WITH RECURSIVE ", 1) + """SELECT count(*) AS n, round(sum(d * d), 4) AS squared_error, round(sqrt(sum(d * d) / count(*)), 6) AS rmse
FROM (SELECT r.rating - list_dot_product(w.v, h.v) AS d
      FROM r JOIN final w ON w.side = 'W' AND w.id = r.x_id JOIN final h ON h.side = 'H' AND h.id = r.y_id)"""
