"""Session helpers: building a local session for tests and the bench, and
finding the shared scratch folder that training writes its step tables to."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "latentgrid",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session as used by tests, the bench and the jobs when run locally.

    A checkpoint folder is set only when the configuration does not name one.
    """
    master = master or os.environ.get("LATENTGRID_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    On a cluster this must be a shared folder and is taken from
    ``spark.checkpoint.dir`` (or ``SparkContext.setCheckpointDir``). Only a
    local master gets a folder of its own when none is configured.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set; point it at a folder on shared storage")
        d = tempfile.mkdtemp(prefix="latentgrid-ckpt-", dir="/tmp")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def fixed_plan_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` with its settings, but without adaptive execution.

    For many short jobs whose partitioning is known beforehand: planning them stage by stage takes a third of their time and
    has nothing to choose. Cached tables are shared between the two.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.get(key, None) != value and (not key.startswith("spark.") or other.conf.isModifiable(key)):
            other.conf.set(key, value)
    other.conf.set("spark.sql.adaptive.enabled", "false")
    # a task of a step writes the folders of a few blocks: all at once, without a sort by folder
    other.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")
    return other


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Hand texts and records to Python in batches of ``size``, where the session doesn't set it.

    Spark's own bound of 64 MB a batch is held several times at once: by the JVM, in transit and by each worker.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, size)


_SHIPPED = "spark.latentgrid.shipped"


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, as a zip in the shared scratch folder.

    Workers start in folders of their own, where the repository need not be on the path.
    """
    sc = spark.sparkContext
    if sc.getLocalProperty(_SHIPPED):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in sorted(os.walk(here)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    path = scratch_path(spark, "package") + ".zip"
    write_bytes(spark, path, body.getvalue())
    sc.addPyFile(path)
    sc.setLocalProperty(_SHIPPED, path)


def write_bytes(spark: SparkSession, path: str, body: bytes) -> None:
    """Write a small file, whole or not at all: under another name first, then renamed."""
    fs, p = _fs_and_path(spark, path)
    part = p.suffix(".part")
    out = fs.create(part, True)
    try:
        out.write(body)
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"can't write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file that ``write_bytes`` wrote."""
    fs, p = _fs_and_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote (a finished step table)."""
    fs, p = _fs_and_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it doesn't exist."""
    fs, p = _fs_and_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a folder (or the file itself), sorted by name."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    st = fs.getFileStatus(p)
    if not st.isDirectory():
        return [st.getPath().toString()]
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isFile() and not name.startswith(("_", ".")):
            out.append(s.getPath().toString())
    return sorted(out)
