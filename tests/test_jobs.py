import pytest

from conftest import SF_SMALL


def test_train_then_evaluate(spark, scratch):
    from jobs import evaluate as ev
    from jobs import train as tr
    from latentgrid.plans import fixtures
    from latentgrid.sources.ratings import rating_lines
    csv = scratch + "/ratings"
    rating_lines(fixtures.ratings_slice(spark, SF_SMALL)).write.text(csv)
    tr.main(["--ratings", csv, "--rank", "3", "--out-w", scratch + "/w", "--out-h", scratch + "/h",
             "--out", scratch + "/native", "--blocks", "2", "--epochs", "2", "--eval-every", "1",
             "--text-files", "2"])
    from latentgrid.operators.evaluate import evaluate
    from latentgrid.sources.factors import load_factors, read_factors
    from latentgrid.sources.ratings import read_ratings
    r = read_ratings(spark, csv)
    a = evaluate(r, load_factors(spark, scratch + "/native")).first()["rmse"]
    f = read_factors(spark, scratch + "/w", "W").unionByName(read_factors(spark, scratch + "/h", "H"))
    b = evaluate(r, f).first()["rmse"]
    assert abs(a - b) < 1e-12
    ev.main([scratch + "/w", scratch + "/h", csv])
    ev.main(["--native", scratch + "/native", csv])


def test_train_stops_and_resumes(spark, scratch, capsys, monkeypatch):
    from jobs import train as tr
    from latentgrid.plans import fixtures
    from latentgrid.plans.train import FactorStore
    from latentgrid.sources.ratings import rating_lines
    rating_lines(fixtures.ratings_slice(spark, SF_SMALL)).write.text(scratch + "/ratings")
    args = ["--ratings", scratch + "/ratings", "--rank", "3", "--blocks", "2", "--epochs", "2", "--eval-every", "1", "--init-method", "stream"]
    tr.main([*args, "--out-w", scratch + "/w", "--out-h", scratch + "/h"])
    real, n = FactorStore.write, []

    def failing(self, records, path):
        n.append(path)
        if len(n) == 5:
            raise OSError("stopped")
        real(self, records, path)

    capsys.readouterr()
    with monkeypatch.context() as m:
        m.setattr(FactorStore, "write", failing)
        with pytest.raises(OSError):
            tr.main([*args, "--run", scratch + "/run", "--out-w", scratch + "/w2", "--out-h", scratch + "/h2"])
    assert capsys.readouterr().out.startswith("0 ")  # the first epoch was reported when it ended
    tr.main(["--resume", scratch + "/run", "--out-w", scratch + "/w2", "--out-h", scratch + "/h2"])
    assert capsys.readouterr().out.startswith("1 ")
    for side in "wh":
        a, b = ([r.value for r in spark.read.text(f"{scratch}/{side}{k}").collect()] for k in ("", "2"))
        assert sorted(a) == sorted(b)
    # from text factors: one epoch more
    tr.main([*args[:6], "--epochs", "1", "--init-w", scratch + "/w", "--init-h", scratch + "/h", "--out", scratch + "/more"])
    assert spark.read.parquet(scratch + "/more").count() == spark.read.text(scratch + "/w").count() + spark.read.text(scratch + "/h").count()


def test_evaluate_reads_headers_and_skips_malformed_lines(spark, scratch, tmp_path, capsys):
    from jobs import evaluate as ev
    from latentgrid.sources.factors import write_factors
    f = spark.createDataFrame([("W", 0, 0, [2.0]), ("H", 0, 0, [2.0])], "side string, id bigint, block int, factors array<double>")
    write_factors(f, scratch + "/f")
    p = tmp_path / "h.csv"
    p.write_text("x,y,r\n0,0,5\n0,zero,1\n")
    ev.main(["--native", scratch + "/f", "--header", "--mode", "drop", str(p)])
    assert "Calculated_RMSE=1.000000" in capsys.readouterr().out
