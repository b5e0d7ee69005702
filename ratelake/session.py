"""Session construction and the shared working folder.

Everything the library materialises (lake, DLQ, topic files, stream sinks and
checkpoints, lineage cuts) lives under the folder the cluster names in
``spark.checkpoint.dir``. The library reads that setting from the session and
only sets its own when it is unset (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SUBDIR = "ratelake"
#: paths written by ``materialize``, by application
_made: dict[str, list[str]] = {}


def build_session(
    master: str | None = None,
    app_name: str = "ratelake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    state_store: str | None = None,
) -> SparkSession:
    """Session with the settings this library is written for.

    ``master`` is only set when given (a cluster submit supplies its own).
    AQE stays on so shuffle partition counts, skewed joins and broadcast
    conversions are re-planned from runtime statistics. ``state_store=
    "rocksdb"`` keeps streaming state (dedup keys) off the JVM heap.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # lineage cuts of small tables go through RDD checkpoints: compress
        # them, and delete them once no plan references them (a long-running
        # ETL cuts one per micro-batch)
        "spark.checkpoint.compress": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if state_store == "rocksdb":
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set one only if none is set.

    Order: the SparkContext's current checkpoint dir, then the
    ``spark.checkpoint.dir`` setting, then (tests only) a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            conf = None
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share"
            )
        conf = tempfile.mkdtemp(prefix="ratelake-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder for ``name``.

    ``unique=True`` appends a fresh id so concurrent or repeated runs never
    share output; pass ``unique=False`` for a stable location (e.g. a lake that
    accumulates batches across runs).
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{root}/{_SUBDIR}/{leaf}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop) file system; metadata only."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared folder and return a
    DataFrame reading it back: a lineage cut for large intermediates
    (columnar and compressed, unlike an RDD checkpoint), and every later pass
    sees exactly the same rows even if executors are lost. The table stays
    until ``clean_up`` is called."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> int:
    """Delete every table that ``materialize`` wrote in this application, and
    return how many there were. To be called when no DataFrame built on them
    is needed any more: after a job's results are written."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    return sum(delete_path(spark, path) for path in paths)


def list_batch_ids(spark: SparkSession, root: str, column: str = "batch_id") -> list[int]:
    """Batch ids present as ``<root>/<column>=<N>`` folders (one listing call,
    no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(column + "="):
            try:
                out.append(int(name.split("=", 1)[1]))
            except ValueError:
                pass
    return sorted(out)


def complete_batch_ids(spark: SparkSession, root: str, column: str = "batch_id") -> list[int]:
    """Ids of the batch folders whose write has ended (``_SUCCESS`` is there)."""
    base = root.rstrip("/")
    return [n for n in list_batch_ids(spark, root, column) if path_exists(spark, f"{base}/{column}={n}/_SUCCESS")]


def require_version(spark: SparkSession, path: str) -> None:
    """Raise unless the version folder ``path`` is there: running totals must
    not start again from nothing when the version before is missing."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"the previous version {path} is missing; rebuild it before going on")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file atomically (temp file, then rename), the way a
    streaming offset log commits: a reader sees the whole file or none.
    Raises ``FileExistsError`` if ``path`` is there already: of two runs of
    the same batch only one commits. Metadata-sized; no Spark job."""
    final, fs = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp-{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(final):
        fs.delete(tmp, False)
        raise FileExistsError(f"{path} has been committed by another run")
    if not fs.rename(tmp, final):
        raise OSError(f"could not commit {path}")


def read_marker(spark: SparkSession, path: str) -> str:
    """Read a marker written by ``write_marker``."""
    p, fs = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        while (line := reader.readLine()) is not None:
            lines.append(line)
        return "\n".join(lines)
    finally:
        stream.close()


def list_markers(spark: SparkSession, root: str, suffix: str = ".json") -> list[str]:
    """Names of the committed markers under ``root`` (temp files excluded)."""
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return []
    return sorted(
        st.getPath().getName()
        for st in fs.listStatus(p)
        if st.isFile() and st.getPath().getName().endswith(suffix)
    )


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` if it exists (metadata operation)."""
    p, fs = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def swap_path(spark: SparkSession, new: str, final: str) -> None:
    """Put the folder ``new`` in the place of ``final``. What was there is
    moved aside first and deleted last, and is put back if the move fails; a
    reader may miss the folder between two renames, never see half of it."""
    p, fs = _fs(spark, final)
    jvm = spark.sparkContext._jvm
    source, aside = jvm.org.apache.hadoop.fs.Path(new), jvm.org.apache.hadoop.fs.Path(f"{new}.replaced")
    fs.mkdirs(p.getParent())
    fs.mkdirs(source.getParent())
    there = fs.exists(p)
    if there and not fs.rename(p, aside):
        raise OSError(f"could not move {final} aside")
    if not fs.rename(source, p):
        if there:
            fs.rename(aside, p)
        raise OSError(f"could not move {new} to {final}")
    if there:
        fs.delete(aside, True)


def modified(spark: SparkSession, path: str) -> int | None:
    """When the folder was put in its place (milliseconds), None if absent."""
    p, fs = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime()) if fs.exists(p) else None


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def list_folders(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Names of the folders under ``root`` that start with ``prefix``."""
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [(st.getPath().getName(), st.isDirectory()) for st in fs.listStatus(p)]
    return sorted(name for name, folder in names if folder and name.startswith(prefix))
