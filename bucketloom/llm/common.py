"""Shared plumbing: shared-folder tables, joins that survive hot keys, Arrow batch helpers."""

from __future__ import annotations

import atexit
import ctypes
import functools
import io
import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key is hot when it holds more than this share of the rows, so at most 1/HOT_SHARE keys are hot.
HOT_SHARE = 1 / 1000
#: Rows of one hot group that meet in one task.
SALT_ROWS = 128

#: Distinct codes that a task counts before it hands them on.
HELD = 1 << 20

#: Rows of a batch between the JVM and Python.
ARROW_ROWS = 2000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for clusters where it isn't installed; and Arrow batches of whole texts
    shall have ARROW_ROWS rows, where the session leaves Spark's default."""
    sc = spark.sparkContext
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, str(ARROW_ROWS))
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    name = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(os.path.join(root, name)):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    folder = tempfile.mkdtemp(prefix="ship")
    path = os.path.join(folder, f"{name}.zip")
    with open(path, "wb") as out:
        out.write(buf.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


#: Seconds after which a worker without a task lets its tables go.
IDLE = 2.0

_kept: dict[str, object] = {}
_running = 0
_turn = 0
_lean = False


def be_lean() -> None:
    """Once a worker: Arrow takes memory from malloc, and malloc gives large blocks back to the system as they are freed."""
    global _lean
    if not _lean:
        _lean = True
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            libc = ctypes.CDLL(None)
            for option, value in ((-3, 1 << 18), (-1, 1 << 20), (-8, 2)):  # M_MMAP_THRESHOLD, M_TRIM_THRESHOLD, M_ARENA_MAX
                libc.mallopt(option, value)
        except (OSError, AttributeError):  # not glibc
            pass


def _trim() -> None:
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def kept(make: Callable[[], object], name: str):
    """A worker's object of that name, made at first use; it stays until a task of another module runs in the worker (``in_worker``)."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def _let_go(turn: int) -> None:
    if turn == _turn and not _running:
        _kept.clear()
        _trim()


# What ``wrapped`` does to the worker's state stands in functions of the module: those are pickled by name, whereas ``wrapped``
# is pickled by value, with copies of the globals that it names itself.
def _begin(module: str) -> None:
    global _running, _turn
    be_lean()
    _running += 1
    _turn += 1
    if _kept.get("") != module:
        _kept.clear()
        _trim()
        _kept[""] = module


def _end() -> None:
    global _running
    _running -= 1
    _trim()
    later = threading.Timer(IDLE, _let_go, (_turn,))
    later.daemon = True
    later.start()


def in_worker(run):
    """Wraps a function of Arrow batches. Workers are reused by all operators, so each keeps tables of one module at a time, and none while it has no task."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(run.__module__)
        try:
            yield from run(batches)
        finally:
            _end()

    return wrapped


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a folder of our own only where a local session has none (tests)."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        at = sc._jsc.sc().getCheckpointDir()
        if at.isDefined():
            found = at.get()
        elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        else:
            found = "file://" + tempfile.mkdtemp(prefix="loom-checkpoint-")
            sc.setCheckpointDir(found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Tables:
    """Tables written into the shared folder to cut lineage; an executor's loss can't take them away.

    ``cut`` writes and rereads a frame; ``drop`` deletes one that no later plan reads. What is left goes
    when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.base = spark, f"{shared_dir(spark)}/loom-{uuid.uuid4().hex}"
        self.n = 0
        self.paths: dict[int, str] = {}
        atexit.register(self._close)

    def cut(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self._keep = [*getattr(self, "_keep", []), out]
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = self.paths.pop(id(df), None)
            if path:
                _delete(self.spark, path)

    def _close(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                _delete(self.spark, self.base)
        except Exception:  # the session may have ended before
            pass


def spread(*cols: Column) -> Column:
    """A pseudo-random long from the given columns."""
    return F.xxhash64(*cols)


def join_unique(left: DataFrame, right: DataFrame, key: str, count: str, total: int, spread_by: list[str]) -> DataFrame:
    """Left join with ``right``, unique by ``key``, that no hot key can bring into one task.

    ``count`` is right's column with the key's rows in ``left`` and ``total`` the rows of ``left``. Keys with
    more than HOT_SHARE of the rows, 1/HOT_SHARE at most, are joined by a broadcast of that bounded size; the
    rest meet in a shuffle, where rows of hot keys carry a random key. The result has left's columns
    and right's others (null where the key isn't in right).
    """
    least = max(2000.0, total * HOT_SHARE)
    values = [c for c in right.columns if c != key]
    kind = right.schema[key].dataType
    packed = right.select(F.col(key), F.col(count).alias("__n"), F.struct(*values).alias("__v"))
    hot = packed.where(F.col("__n") > least).select(F.col(key).alias("__hk"), F.col("__v").alias("__hv"))
    cold = packed.where(F.col("__n") <= least).select(F.col(key).alias("__ck"), F.col("__v").alias("__cv"))
    rand = spread(*[F.col(c) for c in spread_by])
    other = rand if isinstance(kind, T.LongType) else F.concat(F.lit("~"), rand.cast("string"))
    out = left.join(F.broadcast(hot), left[key] == F.col("__hk"), "left")
    out = out.withColumn("__jk", F.when(F.col("__hk").isNotNull() | F.col(key).isNull(), other).otherwise(F.col(key)))
    # Always a shuffle: a broadcast at small sizes only would be another plan than the one for large ones.
    out = out.join(cold.hint("merge"), F.col("__jk") == F.col("__ck"), "left")
    v = F.when(F.col("__hk").isNotNull(), F.col("__hv")).when(F.col(key).isNotNull(), F.col("__cv"))
    out = out.withColumn("__v", v)
    return out.select(*[F.col(c) for c in left.columns], *[F.col(f"__v.{c}").alias(c) for c in values])


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow with state made once per task: ``make()`` gives the function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for part in bounded(b):
                out = f(part)
                if out is not None and out.num_rows:
                    yield out

    run.__module__ = make.__module__
    return df.mapInArrow(in_worker(run), schema)


def bounded(batch: pa.RecordBatch, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about max_bytes each (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    size = batch.nbytes
    step = max(1, min(n, int(n * max_bytes / max(size, 1)) or 1))
    for i in range(0, n, step):
        part = batch.slice(i, step)
        if step > 1 and part.nbytes > 4 * max_bytes:
            for j in range(part.num_rows):
                yield part.slice(j, 1)
        else:
            yield part


def texts_of(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null as empty."""
    return [x if x is not None else b"" for x in col.cast(pa.binary()).to_pylist()]


class Recent:
    """A bounded table of what was met before: two generations, of which the older goes when the younger is full."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found


class Counts:
    """Distinct codes and how often each occurs, by key; handed on when there are many."""

    def __init__(self):
        self.held: dict = {}
        self.n = 0

    def add(self, key, code: np.ndarray, n: np.ndarray) -> None:
        self.held.setdefault(key, []).append((code, n))
        self.n += len(code)
        if self.n > HELD:
            self._merge()

    def _merge(self) -> None:
        for key, parts in self.held.items():
            if len(parts) > 1:
                codes, of = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                self.held[key] = [(codes, np.bincount(of, np.concatenate([n for _, n in parts])).astype(np.int64))]
        self.n = sum(len(parts[0][0]) for parts in self.held.values())

    @property
    def many(self) -> bool:
        return self.n > HELD // 2

    def take(self):
        self._merge()
        for key, parts in self.held.items():
            for i in range(0, len(parts[0][0]), 1 << 16):
                yield key, parts[0][0][i : i + (1 << 16)], parts[0][1][i : i + (1 << 16)]
        self.__init__()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **names: str) -> DataFrame:
    """Just the wanted columns under our own names, so that other columns can't clash."""
    return df.select(*[df[c].alias(a) for a, c in names.items()])
