"""Session construction and shared scratch locations.

On a cluster the checkpoint folder is named by the cluster in ``spark.checkpoint.dir``
(shared storage such as HDFS or an object store). We read it from the session and only
create a local one when it is unset, which happens in tests and local benchmarks.
Everything the library writes as an intermediate (checkpoints, round-trip extracts)
lives below that folder, never in a machine-local temporary directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_SCRATCH_SUBDIR = "starmart-scratch"


def build_session(
    master: str | None = None,
    app_name: str = "starmart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the library is designed for.

    AQE is on so that shuffle partitions coalesce, skewed join partitions split and
    small join sides are converted to broadcast at run time from measured sizes.
    The UI is off: no web server is started.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where the cluster named none."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = _local_dirs.get(id(spark))
    if not configured:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a folder on shared "
                "storage (checkpoints and intermediate tables are written below it)")
        # Local runs and tests only: a fresh folder per session.
        configured = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("STARMART_TMP", "/tmp"))
        _local_dirs[id(spark)] = configured
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_local_dirs: dict[int, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    ck = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{ck}/{_SCRATCH_SUBDIR}/{name}-{uuid.uuid4().hex[:12]}"
    for paths in _open_scopes.get():
        paths.append(path)
    return path


# The scopes around the code that is running, outermost first. A context variable belongs to
# its thread, so jobs on other threads neither see nor fill it.
_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("starmart_scratch_scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside the block when it ends.

    The block owns what its own thread makes, and what ``in_scope`` functions make on other
    threads on its behalf; tables of jobs beside it are never touched. For jobs whose results
    are written elsewhere; a DataFrame that still reads a scratch table must not leave the block.
    """
    paths: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), paths))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in paths:
            delete_path(spark, path)


def in_scope(fn: Callable) -> Callable:
    """``fn`` for a pool thread, with the scratch scopes that are open here and now."""
    context = copy_context()

    def run(*args, **kwargs):
        # a context can be entered by one thread at a time, so each call gets a copy
        return context.copy().run(fn, *args, **kwargs)

    return run


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system its path names."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def read_text(spark: SparkSession, path: str) -> str:
    """Contents of one small file (a manifest, a reservation)."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _hidden_copy(spark: SparkSession, path: str, text: str) -> str:
    """``text`` in a hidden file beside ``path``: complete before anybody can see it."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex[:12]}"
    fs, target = _file_system(spark, hidden)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return hidden


def _rename(spark: SparkSession, source: str, target: str, mode: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    kinds = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = getattr(kinds, mode)
    context = hadoop.FileContext.getFileContext(hadoop.Path(target).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(hadoop.Path(source), hadoop.Path(target), options)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file by one rename: a reader finds the old text or the new one, whole."""
    _rename(spark, _hidden_copy(spark, path, text), path, "OVERWRITE")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one; of several writers at once one gets ``True``."""
    hidden = _hidden_copy(spark, path, text)
    fs, target = _file_system(spark, path)
    try:
        if fs.getScheme() == "file":   # a rename on a local disk may replace: a hard link never does
            os.link(_local(hidden), _local(path))
        else:
            _rename(spark, hidden, path, "NONE")
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as failure:
        if "FileAlreadyExists" in str(failure.java_exception) or fs.exists(target):
            return False
        raise
    finally:
        delete_path(spark, hidden)


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the visible entries of a folder, sorted; none where there is no such folder."""
    fs, target = _file_system(spark, folder)
    if not fs.exists(target):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(target))
    return sorted(n for n in names if not n.startswith((".", "_")))


def list_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of the visible files of a folder, by name."""
    fs, target = _file_system(spark, folder)
    found = ((s.getPath().getName(), s.getLen()) for s in fs.listStatus(target) if s.isFile())
    return sorted((n, size) for n, size in found if not n.startswith((".", "_")))


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, target = _file_system(spark, folder)
    fs.mkdirs(target)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a scratch table and read back: computed once for several readers,
    with its lineage cut. Not a cache: a later run writes a table of its own."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
