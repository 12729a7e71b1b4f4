"""Session settings and the shared folder that derived tables are written to."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the models rely on.

    Calendar parts are UTC parts, whatever the host's zone is.

    The mart is wide: fused into one method, its stage passes 8000 bytes of bytecode, and
    such a method the JVM only ever interprets. Nodes of many columns therefore run as
    separate compiled projections, while the narrow parts of a stage stay fused.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.codegen.maxFields", "25")
    return spark


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """Single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skytune")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


_SHIPPED: set[str] = set()


#: Rows of texts that go to a Python worker at once; the operators cut them further by bytes.
ARROW_ROWS = 2000


def ship_package(spark: SparkSession) -> SparkSession:
    """Give Python workers this package, wherever they start; once per application.

    Rows hold whole texts, so fewer of them make a batch: an executor holds one of each task twice.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="skytune-code-")  # the driver serves it to the executors
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        name = shutil.make_archive(f"{folder}/skytune", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(name)
    return spark


#: Folders of local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}
#: Copies written and not yet released, with the session that wrote them.
_COPIES: dict[str, SparkSession] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    A local session, where one machine is the whole cluster, gets a folder of its own if it names
    none; it goes when the process ends. Any other session must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="skytune-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
    return _LOCAL_ROOTS[app]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder, reachable by every executor, for one written table or checkpoint."""
    path = f"{shared_root(spark)}/skytune/{purpose}-{uuid.uuid4().hex}"
    _COPIES[path] = spark
    return path


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Inside, the session has this setting."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_cleanup(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, shuffle files go as soon as the job that wrote them has ended."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def written(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Lineage is cut in a way that outlives lost executors, and the optimizer then
    knows the real size in bytes, so it broadcasts the table only if it is small.
    The copy stays until ``release`` or the end of the process.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    with shuffle_cleanup(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


#: Large values sent to the executors and not yet taken back, by application.
_SENT: dict[str, list[Broadcast]] = {}


def sent(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of a large value that ``free_workers`` takes from the executors."""
    shared = spark.sparkContext.broadcast(value)
    _SENT.setdefault(spark.sparkContext.applicationId, []).append(shared)
    return shared


def give_back() -> None:
    """Return memory of arrays that are gone to the system; allocators of this process keep it else."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim:
        trim(0)


def free_workers(spark: SparkSession) -> None:
    """Take large values of earlier jobs from the executors; a job that still needs one gets it again.

    This runs nothing on them. What Python workers derived from such a value goes with the task.
    """
    for shared in _SENT.pop(spark.sparkContext.applicationId, []):
        shared.unpersist()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _COPIES.pop(path, None)


def release(*frames: DataFrame | None) -> None:
    """Delete copies made by ``written`` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_written_to", None)
        if path in _COPIES:
            delete(df.sparkSession, path)


@atexit.register
def release_all() -> None:
    """Delete every copy whose session still runs."""
    for path, spark in list(_COPIES.items()):
        try:
            delete(spark, path)
        except Exception:  # the session ended first: its owner cleans the shared folder
            _COPIES.pop(path, None)
