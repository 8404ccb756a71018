"""Session helpers: building a session for local runs, and locating the shared scratch folder.

Everything this library materialises (the stored log, sinks, ledgers, stream checkpoints) goes under the
folder the cluster names in ``spark.checkpoint.dir``. A session that has none (a bare test session) gets
a fresh folder; on a cluster the setting is always read, never replaced.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """A session configured the way the library expects (UTC, AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # checkpoints of intermediate ranks are removed once their DataFrames are garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local session that has none gets a temporary folder; on a cluster,
    where such a folder would be another disk on every node, that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder; ``unique`` appends a fresh id so runs never collide."""
    root = checkpoint_root(spark).rstrip("/")
    tail = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    return "/".join([root, "ledgerline", *tail])


def scratch_table(df, name: str):
    """``df`` written to the scratch folder and read back: nothing stays cached, lineage ends in a place that all
    executors see, and a lost one costs no second run of what is behind it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make the package importable on executors (once per context) for Arrow/pandas tasks.

    The zip is built in memory and written to the shared scratch folder (Hadoop file system, so
    ``file:``, HDFS and object stores alike), then added with ``addPyFile``.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _shipped:
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as zf:
        for folder, _dirs, files in os.walk(_PACKAGE_DIR):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE_DIR)))
    target = scratch_path(spark, "pyfiles") + "/ledgerline.zip"
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(target)
    out = hpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(hpath, True)
    try:
        out.write(bytearray(buffer.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _shipped.add(key)


def sized_session(spark: SparkSession, shuffle_partitions: int) -> SparkSession:
    """A sibling session (same context, own SQL conf) whose shuffles use ``shuffle_partitions``.

    For stateful streams whose state is small and bounded: the number of state partitions is the
    shuffle partition count at the first run and stays fixed in the checkpoint.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.shuffle.partitions", str(int(shuffle_partitions)))
    return sibling


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS, object store) as seen by Hadoop."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)



def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the entries of a folder, none if there is no such folder."""
    _, hpath, fs = _hadoop(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def input_stamp(spark: SparkSession, path: str) -> str:
    """Path, sizes and times of an input's files: another value once it has been written again."""
    _, hpath, fs = _hadoop(spark, path)
    status = fs.getFileStatus(hpath)
    files = fs.listStatus(hpath) if status.isDirectory() else [status]
    return "|".join([status.getPath().toString(), *sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in files)])


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    jvm, hpath, fs = _hadoop(spark, path)
    stream = fs.open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file put in place whole: written beside its place, then renamed. Fails if it exists."""
    jvm, hpath, fs = _hadoop(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f"_{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # no options: the rename is refused where the file is there already
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context.rename(beside, hpath, spark.sparkContext._gateway.new_array(rename, 0))


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder of this library's own."""
    _, hpath, fs = _hadoop(spark, path)
    fs.delete(hpath, True)
