"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(app_name: str = "farebox", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          # no Python call-site capture on every Column call (error context only)
          .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_PRIVATE_DIRS: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only when the session names none (local tests) a
    private folder is created and registered with ``setCheckpointDir``; the
    core setting itself is never changed at runtime.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    sc = None
    try:
        sc = spark.sparkContext
        d = d or sc.getConf().get(CHECKPOINT_CONF, None)
        if not d:
            jdir = sc._jsc.sc().getCheckpointDir()
            d = jdir.get() if jdir.isDefined() else None
    except Exception:      # no JVM context (e.g. a remote session): conf only
        sc = None
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(a machine-local temporary folder is only used in local mode)")
        d = _PRIVATE_DIRS.get(id(spark)) or tempfile.mkdtemp(prefix="farebox-ckpt-")
        _PRIVATE_DIRS[id(spark)] = d
    if sc is not None and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _local(path: str) -> str | None:
    """Local file-system path of ``path``, or None for a remote URI."""
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix):]
    return None if "://" in path else path


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        fs, p = _fs(spark, path)
        return bool(fs.exists(p))
    except Exception:
        loc = _local(path)
        if loc is None:
            raise
        return os.path.exists(loc)


def file_fingerprint(spark: SparkSession, path: str) -> str:
    """Size and modification time of a file or folder tree (no data read)."""
    try:
        fs, p = _fs(spark, path)
    except Exception:
        loc = _local(path)
        if loc is None:
            raise
        if not os.path.exists(loc):
            return f"{path}:missing"
        total, newest = 0, 0
        for root, _, files in os.walk(loc) if os.path.isdir(loc) else [("", [], [loc])]:
            for f in files:
                st = os.stat(os.path.join(root, f) if root else f)
                total, newest = total + st.st_size, max(newest, int(st.st_mtime * 1000))
        return f"{path}:{total}:{newest}"
    if not fs.exists(p):
        return f"{path}:missing"
    st = fs.getFileStatus(p)
    if st.isDirectory():
        total, newest = 0, 0
        it = fs.listFiles(p, True)
        while it.hasNext():
            f = it.next()
            total += f.getLen()
            newest = max(newest, f.getModificationTime())
        return f"{path}:{total}:{newest}"
    return f"{path}:{st.getLen()}:{st.getModificationTime()}"


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def list_files(spark: SparkSession, paths: list[str], suffix: str = ".csv") -> list[dict]:
    """Files (full path, size, modification time in ms) named by ``paths``: files as
    they are, folders by their files with ``suffix``. Any file system Spark reads."""
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            raise FileNotFoundError(path)
        found = [fs.getFileStatus(p)]
        if found[0].isDirectory():
            found = [f for f in fs.listStatus(p) if f.isFile() and f.getPath().getName().endswith(suffix)]
        out += [{"source_file": f.getPath().toString(), "size": f.getLen(), "modified": f.getModificationTime()} for f in found]
    return sorted(out, key=lambda f: f["source_file"])


class session_conf:
    """Temporarily set SQL confs on a session (restored on exit)."""

    def __init__(self, spark: SparkSession, **confs: str):
        self.spark, self.confs, self.old = spark, confs, {}

    def __enter__(self):
        for k, v in self.confs.items():
            key = k.replace("__", ".")
            self.old[key] = self.spark.conf.get(key, None)
            self.spark.conf.set(key, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False
