import os
import re
import subprocess
import sys
import time

import corpus_pipeline as P
import __spark_entry__ as E
from corpus_fixtures import docs  # noqa: F401
from latentgrid.llm import decontam, langid, secrets, simhash
from latentgrid.llm.common import written

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(P.__file__))


def test_queries_are_registered():
    names = set(E.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "decontamination", "secret_scan", "bpe_tokens"]


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in P.STAGES:
        kept.append(written(stage(spark, kept[-1], SF), name))
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert all(k.columns == P.COLUMNS for k in kept[:-1])
    assert all(k.count() == len(i) for k, i in zip(kept, ids))
    found = langid.identify(docs.select(P.COLUMNS)).where("lang_pred = 'und' OR score < 0.5")
    assert ids[0] - ids[1] == {r.doc_id for r in found.collect()}
    classes = simhash.near_duplicates(kept[1]).collect()
    assert ids[2] == {r.component_id for r in classes}
    leaked = decontam.contaminated(kept[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert ids[3] == ids[2] - {r.doc_id for r in leaked} and ids[3] < ids[2]
    assert ids[4] == ids[3] == ids[5]
    # the masked texts have no span left of those that the texts before had
    before = {r.doc_id: (r.text, r.secrets) for r in secrets.find_secrets(kept[3]).collect()}
    for r in kept[4].collect():
        text, spans = before[r.doc_id]
        assert (r.text == text) == (not spans) and not any(text[s.start:s.end] in r.text for s in spans)
    assert kept[5].where("NOT round_trip OR n_tokens != size(token_ids)").count() == 0


def test_rows_without_ids_and_empty_tables(spark, docs):
    text = "Hello world this is a text with password = abcdef12 yes"
    rows = docs([(1, text), (1, text), (None, text), (None, "quite another text about things"), (None, "quite another text about things"),
                 (2, None), (3, ""), (4, "12 34")])
    out = rows
    for name, stage in P.STAGES:
        out = written(stage(spark, out, SF), name)
    assert sorted(((r.doc_id, r.n_tokens) for r in out.collect()), key=repr) == [(1, 12), (None, 5)]
    out = rows.limit(0)
    for name, stage in P.STAGES:
        out = written(stage(spark, out, SF), name)
    assert out.count() == 0


def test_rows_that_share_an_id_are_judged_alone(spark, docs):
    x, a, b = ("the first of these texts has many words " * 9, "an unlike text about something else entirely here " * 9, "short other words on a page " * 20)
    rows = docs([(3, x), (7, a), (7, x), (7, b), (7, a + "end"), (9, b + "x"), (None, x), (None, "a text without an id that stands alone " * 5)])
    kept = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, rows, SF).collect()), key=repr)
    classes = {}
    for r in simhash.near_duplicates(rows, class_to="k").collect():
        classes.setdefault(r.k, set()).add(r.fingerprint)
    assert len(kept) == len(classes)
    assert (3, x) in kept and (7, x) not in kept and (7, b) in kept and all(t != x for i, t in kept if i is None)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = docs([(1, item), (1, "clean words stay " * 9), (None, item), (None, "clean words stay too " * 9)])
    left = {(r.doc_id, r.text) for r in P.decontamination(spark, rows, SF).collect()}
    assert left == {(1, "clean words stay " * 9), (None, "clean words stay too " * 9)}


def test_masks_are_linear_in_the_secrets(spark, docs):
    def seconds(n):
        df = docs([(1, "password=abcdef12 " * n)])
        t = time.time()
        out = secrets.mask_secrets(df).first()
        assert len(out.secrets) == n and out.text == "[assign] " * n
        return time.time() - t

    seconds(100)
    assert seconds(50_000) < 15 * max(seconds(5_000), 0.3)


def test_entry_lists_the_core_without_a_module_that_corpus_operators_need():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as E; print(len(E.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert int(out.stdout) >= 44, out.stderr


def test_workers_away_from_the_repository(tmp_path):
    """The corpus queries that need this package on the workers, run from another folder."""
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from latentgrid.session import build_session
sys.path.remove({ROOT!r})
spark = build_session(master="local[4]", shuffle_partitions=4)
for name in ("op4_bpe", "op5_decontamination", "op7_token_counts", "op8_langid", "op9_secrets", "op12_bytes", "op13_runs"):
    print(name, len(E.queries()[name](spark, {SF!r}).collect()) > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.stdout.count("True") == 7, out.stderr[-2000:]
