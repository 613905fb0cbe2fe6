"""Session construction and the shared scratch location.

Everything this library writes outside a user-given path (round-trip
checks, lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local runs,
tests) do we pick one ourselves.
"""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_LOCK = threading.Lock()

# Settings a local or test session gets; a cluster session brings its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


# Settings suggested for a large cluster (about 100 TB input); not applied
# automatically -- a cluster's own configuration decides.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffle fan-out: about input bytes / 256 MB; AQE merges what is small
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # parallel listing of many delivery folders
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    # one writer per folder per task, files cut at a bounded size
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "arrivals", extra: dict | None = None) -> SparkSession:
    """Get or create a session with this library's defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for scratch output: ``spark.checkpoint.dir``.

    Read from the session; set to a fresh local folder only when unset in
    local mode (tests), so a cluster's own setting always wins.  A cluster
    session without the setting is an error, never a machine-local folder.
    """
    with _LOCK:
        sc = spark.sparkContext
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not root:
            try:
                root = spark.conf.get("spark.checkpoint.dir")
            except Exception:  # noqa: BLE001 - unset key
                root = None
        if not root:
            if not str(sc.master).startswith("local"):
                # A machine-local folder is not shared between executors.
                raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
            root = tempfile.mkdtemp(prefix="arrivals-ckpt-")
            sc.setCheckpointDir(root)
        elif not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return sc.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder path below the shared root (not created)."""
    root = shared_root(spark).rstrip("/")
    return f"{root}/{label}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def _file_system(spark: SparkSession, path: str):
    """The path's Hadoop FileSystem (the default one for a path without a
    scheme, as Spark's readers and writers see it) and the path."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    fs, jold = _file_system(spark, old)
    jnew = _file_system(spark, new)[1]
    fs.mkdirs(jnew.getParent())
    if not fs.rename(jold, jnew):
        raise OSError(f"cannot rename {old} to {new}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None where there is no such file."""
    fs, jpath = _file_system(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old text or the new one.

    It is written beside the old file and renamed over it, which file systems
    do in one step; a store without such a rename replaces an object in one
    step itself.
    """
    jvm = spark.sparkContext._jvm
    fs, jpath = _file_system(spark, path)
    fresh = f"{path}.{uuid.uuid4().hex[:12]}"
    _, jfresh = _file_system(spark, fresh)
    for target in (jfresh, jpath):
        stream = fs.create(target, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if target is jpath:
            break
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                jpath.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
        except Exception:  # noqa: BLE001 - no such rename for this store
            fs.delete(jfresh, False)
            continue
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        context.rename(fs.makeQualified(jfresh), fs.makeQualified(jpath), how)
        break


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes below a folder: one listing."""
    fs, jpath = _file_system(spark, path)
    if not fs.exists(jpath):
        return 0, 0
    summary = fs.getContentSummary(jpath)
    return summary.getFileCount(), summary.getLength()


def files_below(spark: SparkSession, root: str, levels: int) -> list[tuple[str, int]]:
    """Files in the folders ``levels`` below ``root``, as (relative path,
    bytes): one listing."""
    fs, jpath = _file_system(spark, root.rstrip("/") + "/*" * (levels + 1))
    found = []
    for status in fs.globStatus(jpath) or []:
        if status.isFile():
            path = "/".join(status.getPath().toString().rsplit("/", levels + 1)[1:])
            found.append((path, status.getLen()))
    return found


def remove_empty_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    if fs.exists(jpath) and not any(s.getPath().getName()[:1] not in "._" for s in fs.listStatus(jpath)):
        fs.delete(jpath, True)


def folders_below(spark: SparkSession, root: str, levels: int) -> set[str]:
    """Folders ``levels`` below ``root``, as paths relative to it: one listing."""
    fs, jpath = _file_system(spark, root.rstrip("/") + "/*" * levels)
    found = set()
    for status in fs.globStatus(jpath) or []:
        if status.isDirectory():
            found.add("/".join(status.getPath().toString().rsplit("/", levels)[1:]))
    return found
