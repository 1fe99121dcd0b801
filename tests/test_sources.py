import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, data
from latentgrid.functions.init import init_factors
from latentgrid.operators.grid import Grid, compute_grid
from latentgrid.plans import fixtures
from latentgrid.sources.blocks import pack_blocks, read_stratum, unpack_blocks, write_blocked
from latentgrid.sources.factors import (load_factors, pack_factor_pieces, pack_factors, read_factors,
                                        unpack_factors, with_blocks, write_factors, write_factors_text)
from latentgrid.sources.ratings import parse_rating_lines, prefix_sample, read_ratings


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_extra_columns_ignored(spark):
    assert rows(read_ratings(spark, data("extra.csv")), "x_id", "y_id", "rating") == \
        [(1, 10, 4.0), (2, 20, 3.5)]


def test_spaces_accepted(spark):
    assert rows(read_ratings(spark, data("spaces.csv")), "x_id", "y_id", "rating") == \
        [(1, 7, 2.0), (3, 8, 4.5)]


def test_double_colon(spark):
    df = read_ratings(spark, data("colon.dat"), sep="::")
    assert rows(df, "x_id", "y_id", "rating") == [(1, 1193, 5.0), (2, 661, 3.0)]


def test_header_strict_fails_quarantine_isolates(spark):
    with pytest.raises(Exception, match="malformed rating line"):
        read_ratings(spark, data("header.csv")).collect()
    good, bad = read_ratings(spark, data("header.csv"), mode="quarantine")
    assert good.count() == 2
    assert [r["line"] for r in bad.collect()] == ["userId,movieId,rating,timestamp"]
    hdr = read_ratings(spark, data("header.csv"), header=True)
    assert rows(hdr, "x_id", "y_id", "rating") == [(1, 10, 4.0), (2, 20, 3.5)]


def test_bad_lines(spark):
    with pytest.raises(Exception, match="malformed rating line"):
        read_ratings(spark, data("bad.csv")).collect()
    assert rows(read_ratings(spark, data("bad.csv"), mode="drop"), "x_id", "y_id", "rating") == \
        [(1, 2, 3.0), (6, 7, 8.0)]
    _, bad = read_ratings(spark, data("bad.csv"), mode="quarantine")
    assert sorted(r["reason"] for r in bad.collect()) == \
        ["bad row id", "fewer than three fields", "fewer than three fields"]


def test_duplicates_are_two_samples(spark):
    assert read_ratings(spark, data("dups.csv")).filter("x_id = 1 and y_id = 2").count() == 2


def test_empty_file(spark):
    from latentgrid.operators.evaluate import evaluate
    from latentgrid.plans.train import fit
    r = read_ratings(spark, data("empty.csv"))
    with pytest.raises(ValueError, match="no ratings"):
        fit(r, 2, blocks=2, epochs=1)
    f = init_factors(spark, Grid(2, 3, 3, 2, 2), 2)
    e = evaluate(r, f).first()
    assert e["n"] == 0 and e["rmse"] is None and e["squared_error"] == 0.0


def test_factor_text_nan_and_k1(spark):
    f = read_factors(spark, data("factors_nan.csv"), "W").first()
    v = f["factors"]
    assert v[0] == 1.5 and math.isnan(v[1]) and math.isnan(v[2]) and v[3] == 2.0
    k1 = read_factors(spark, data("k1.csv"), "H").orderBy("id").collect()
    assert [(r["id"], r["factors"]) for r in k1] == [(0, [0.5]), (1, [0.25]), (2, [0.125])]


def test_factor_text_roundtrip_multi_file(spark, scratch):
    g = Grid(4, 99, 49, 25, 13)
    f = init_factors(spark, g, 3)
    write_factors_text(f, "W", scratch + "/w", files=3)
    back = read_factors(spark, scratch + "/w", "W")
    a = {r["id"]: r["factors"] for r in f.filter("side = 'W'").collect()}
    b = {r["id"]: r["factors"] for r in back.collect()}
    assert a == b
    with pytest.raises(FileExistsError):
        write_factors_text(f, "W", scratch + "/w")


def test_native_roundtrip(spark, scratch):
    g = Grid(2, 9, 9, 5, 5)
    f = init_factors(spark, g, 2)
    write_factors(f, scratch + "/n")
    back = load_factors(spark, scratch + "/n")
    assert rows(back, "side", "id", "block", "factors") == rows(f, "side", "id", "block", "factors")
    # text round trip keeps blocks when they are recomputed
    wb = with_blocks(back, 5, 5)
    assert rows(wb, "side", "id", "block") == rows(f, "side", "id", "block")


def test_packed_factors_roundtrip(spark):
    g = Grid(3, 8, 5, 3, 2)
    f = init_factors(spark, g, 2)
    packed = pack_factors(f)
    assert packed.count() == 6
    back = unpack_factors(packed, {"W": 3, "H": 2})
    assert rows(back, "side", "id", "block", "factors") == rows(f, "side", "id", "block", "factors")


@pytest.mark.parametrize("piece", [1, 2, 3, 100])
def test_packed_factor_pieces(spark, piece):
    from latentgrid.sources.packed import factor_block_lines

    dims = {"W": 5, "H": 2}
    f = init_factors(spark, Grid(3, 14, 5, 5, 2), 2).repartition(7)
    pieces = pack_factor_pieces(f, dims, piece=piece)
    assert {(r.side, r.block, r.start) for r in pieces.collect()} == {
        (s, b, k) for s in dims for b in range(3) for k in range(0, dims[s], piece)}
    assert rows(unpack_factors(pieces, dims), "side", "id", "block", "factors") == rows(f, "side", "id", "block", "factors")
    whole = pack_factors(f)
    for side in dims:
        assert rows(factor_block_lines(pieces, side), "line_no", "packed") == rows(factor_block_lines(whole, side), "line_no", "packed")
    assert pack_factor_pieces(f.limit(0), dims, piece=piece).count() == 0


def test_packed_factor_pieces_tell_gaps(spark):
    from latentgrid.sources.packed import factor_block_lines

    f = init_factors(spark, Grid(3, 14, 5, 5, 2), 2)
    dims = {"W": 5, "H": 2}
    with pytest.raises(Exception, match="gap or a repeated id"):
        pack_factor_pieces(f.where("id != 6"), dims, piece=3).collect()
    with pytest.raises(Exception, match="gap or a repeated id"):
        pack_factor_pieces(f.union(f.where("side = 'H' AND id = 3")), dims, piece=3).collect()
    gap = pack_factor_pieces(f.where("side = 'W' AND id != 7"), dims, piece=3)
    assert rows(unpack_factors(gap, dims), "id") == [(i,) for i in range(15) if i != 7]
    with pytest.raises(Exception, match="rows are missing"):
        factor_block_lines(gap, "W").collect()


def test_packed_blocks_roundtrip_and_empty_blocks(spark):
    r = read_ratings(spark, data("gaps.csv"))
    g = compute_grid(r, 4)
    packed = pack_blocks(r, g)
    assert packed.count() == 16
    assert packed.filter("packed = ''").count() == 16 - 5  # blocks (0,0) (1,1) (3,3) (0,3) (3,0)
    back = unpack_blocks(packed)
    assert rows(back, "x_id", "y_id", "rating") == rows(r, "x_id", "y_id", "rating")


def test_blocked_store_prunes(spark, scratch):
    r = fixtures.ratings(spark, SF_SMALL)
    g = compute_grid(r, 4)
    write_blocked(r, g, scratch + "/b")
    s1 = read_stratum(spark, scratch + "/b", 1)
    plan = s1._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stratum" in plan and "(stratum#" in plan
    from latentgrid.operators.grid import assign_blocks
    assert s1.count() == assign_blocks(r, g).filter("stratum = 1").count()


def test_prefix_equals_topk(spark, scratch):
    r = fixtures.ratings(spark, SF_SMALL)
    a = r.orderBy(*fixtures.ORDER_COLS).limit(1234)
    b = prefix_sample(r, 1234, fixtures.ORDER_COLS, scratch + "/p", partitions=5)
    cols = fixtures.ORDER_COLS
    assert rows(a, *cols) == rows(b, *cols)


def test_large_blocks_are_packed_in_pieces(spark):
    r = fixtures.ratings(spark, SF_SMALL)
    g = compute_grid(r, 2)
    packed = pack_blocks(r, g, fixtures.ORDER_COLS, piece=100)
    sizes = sorted(p["n"] for p in packed.selectExpr("size(split(packed, ';')) - 1 AS n").collect())
    assert sizes[-1] == 100 and len(sizes) > 50 and sum(sizes) == r.count()
    back, whole = unpack_blocks(packed), unpack_blocks(pack_blocks(r, g, fixtures.ORDER_COLS))
    cols = ("xb", "yb", "pos", "x_id", "y_id", "rating")
    assert rows(back, *cols) == rows(whole, *cols)


def test_line_numbers_across_files_and_splits(spark, scratch):
    from latentgrid.sources.factors import line_numbers
    # three part files, each cut into several splits by a tiny split size
    df = spark.range(0, 3000).selectExpr("id", "concat('v', cast(id as string)) AS line")
    df.repartitionByRange(3, "id").sortWithinPartitions("id").select("line").write.text(scratch + "/t")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = {r["pos"]: r["line"] for r in line_numbers(spark, scratch + "/t").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: f"v{i}" for i in range(3000)}


def test_text_sink_refuses_gapped_ids(spark, scratch):
    g = Grid(2, 9, 9, 5, 5)
    f = init_factors(spark, g, 2).filter("NOT (side = 'W' AND id = 3)")
    with pytest.raises(ValueError, match="not 0..n-1"):
        write_factors_text(f, "W", scratch + "/gap")
    write_factors_text(f, "H", scratch + "/ok")


def test_factor_lines_survive_another_split_layout(spark, scratch):
    f = spark.range(5000).select(F.lit("W").alias("side"), "id", F.lit(0).alias("block"),
                                 F.array(F.col("id").cast("double"), F.lit(0.5)).alias("factors"))
    write_factors_text(f, "W", scratch, files=2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        back = read_factors(spark, scratch, "W")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
        assert back.filter(F.col("factors")[0] == F.col("id")).count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_factor_text_needs_each_id_once(spark, scratch):
    f = spark.createDataFrame([("W", i, 0, [1.0]) for i in (0, 0, 2)],
                              "side string, id long, block int, factors array<double>")
    with pytest.raises(ValueError, match="not 0..n-1"):
        write_factors_text(f, "W", scratch)


def test_quoted_separator_in_a_header_file_raises(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('x,y,r\n1,2,"4,5"\n')
    with pytest.raises(Exception, match="bad rating"):
        read_ratings(spark, str(p), header=True).collect()
    with pytest.raises(ValueError, match="mode"):
        read_ratings(spark, str(p), header=True, mode="other")
    assert read_ratings(spark, str(p), header=True, mode="drop").count() == 0


def test_store_grows_by_appends(spark, scratch):
    from latentgrid.operators.grid import compute_grid
    from latentgrid.plans import fixtures
    from latentgrid.session import list_files, list_names
    from latentgrid.sources.blocks import append_blocked, read_stratum, stored_grid, write_blocked
    r = fixtures.ratings_slice(spark, SF_SMALL).select("x_id", "y_id", "rating", "l_orderkey", "l_linenumber")
    g = compute_grid(r, 4)
    write_blocked(r, g, scratch + "/whole")
    write_blocked(r.where("l_linenumber = 1"), g, scratch + "/grown")
    append_blocked(r.where("l_linenumber IN (2, 3)"), scratch + "/grown")
    append_blocked(r.where("l_linenumber > 3"), scratch + "/grown", g)
    for i in range(4):
        a, b = (sorted(map(tuple, read_stratum(spark, scratch + p, i).select(r.columns).collect())) for p in ("/whole", "/grown"))
        assert a == b
    now = stored_grid(spark, scratch + "/grown")
    assert (now.p, now.x_dim, now.y_dim, now.max_x) == (g.p, g.x_dim, g.y_dim, g.max_x)
    # one block's rating: the folders of the other strata keep their files
    before = {n: list_files(spark, f"{scratch}/grown/{n}") for n in list_names(spark, scratch + "/grown") if n.startswith("stratum=")}
    append_blocked(spark.createDataFrame([(0, 0, 3.0, 1, 1)], r.schema), scratch + "/grown")
    after = {n: list_files(spark, f"{scratch}/grown/{n}") for n in before}
    assert [n for n in before if before[n] != after[n]] == ["stratum=0"] and set(before["stratum=0"]) < set(after["stratum=0"])
    assert append_blocked(r.limit(0), scratch + "/grown") == stored_grid(spark, scratch + "/grown")
    with pytest.raises(ValueError, match="outside the grid"):
        append_blocked(spark.createDataFrame([(10**6, 0, 3.0, 1, 1)], r.schema), scratch + "/grown")
    with pytest.raises(ValueError, match="the store has"):
        append_blocked(r, scratch + "/grown", compute_grid(r, 3))


@pytest.mark.parametrize("files", [1, 3])
def test_packed_lines_are_read_by_their_ranges(spark, scratch, files):
    from latentgrid.session import list_files
    from latentgrid.sources.packed import packed_index, read_packed, write_packed
    rows = [(k, "" if k % 5 == 0 else f"{k},é,😀;" * (k * 40)) for k in range(23)]
    df = spark.createDataFrame(rows, "line_no long, packed string").repartition(4)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        write_packed(df, scratch + "/p", files)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, read_packed(spark, scratch + "/p").collect())) == rows
    assert [tuple(r) for r in read_packed(spark, scratch + "/p", [7]).collect()] == [rows[7]]
    assert read_packed(spark, scratch + "/p", [99]).count() == 0
    # the files' lines, one after another, are the blocks; the index has one range for each
    text = "".join(open(f.replace("file:", "")).read() for f in list_files(spark, scratch + "/p"))
    assert text == "".join(t + "\n" for _, t in rows)
    assert packed_index(spark, scratch + "/p").where("line_no = 7").count() == 1
    with pytest.raises(ValueError, match="line numbers"):
        write_packed(df.where("line_no != 3"), scratch + "/q", files)


@pytest.mark.parametrize("header", [False, True])
def test_least_number_of_splits(spark, tmp_path, header):
    p = tmp_path / "r.csv"
    p.write_text("x,y,r\n" * header + "".join(f"{k},{k % 7},{k % 5}\n" for k in range(500)))
    few, many = (read_ratings(spark, str(p), header=header, splits=n) for n in (None, 6))
    assert few.rdd.getNumPartitions() < 6 <= many.rdd.getNumPartitions()
    assert rows(few, "x_id", "y_id", "rating") == rows(many, "x_id", "y_id", "rating")


@pytest.mark.parametrize("sep", [",", "|", "::", "\\"])
def test_each_line_is_split_and_read_once(spark, sep):
    lines = spark.createDataFrame([(sep.join(p),) for p in (("1", "2", "3.5", "x"), ("1", "2"), ("a", "2", "3"), ("1", "b", "3"), ("1", " 2 ", "c"), ("+7", "8", " 9 "))]
                                  + [(None,), ("",)], "value string")
    good, bad = parse_rating_lines(lines, sep, "quarantine")
    assert sorted(map(tuple, good.collect())) == [(1, 2, 3.5), (7, 8, 9.0)]
    assert sorted((r.line or "", r.reason) for r in bad.collect()) == sorted(
        [("", "bad row id"), ("", "fewer than three fields"), (sep.join("12"), "fewer than three fields"), (sep.join("a23"), "bad row id"),
         (sep.join("1b3"), "bad column id"), (sep.join(("1", " 2 ", "c")), "bad rating")])
    for df in (good, bad, parse_rating_lines(lines, sep, "strict")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1 and plan.count("RLIKE") == 2
