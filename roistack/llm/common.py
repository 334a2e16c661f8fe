"""Shared helpers: table access, scratch tables and vectorised text scanning.

Text operators run as ``mapInArrow`` over whole documents.  The helpers here
look at the UTF-8 bytes of an Arrow batch through numpy, so that splitting,
case folding and hashing of words never create Python strings.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are looked at together; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 20

#: Spark's setting to remove the shuffle files of an execution at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scratch: dict[str, str] = {}
#: What a Python worker keeps: each with the tasks that use it and the timer that ends it.
_kept: dict[tuple, list] = {}
_lock = threading.RLock()
#: Seconds after which a Python worker frees what no task uses: the tasks of a stage follow each other faster.
IDLE_S = 1.0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only where the setting is absent (tests on one machine) a local temporary
    folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _scratch.setdefault("local", "file://" + tempfile.mkdtemp(prefix="spark-shared-"))
    return root.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session is already gone at exit
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; all of them are removed when the driver's Python ends."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = f"{shared_folder(spark)}/scratch-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_drop, spark, _scratch[app])
    return f"{_scratch[app]}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffles behind the table are of no use once it is written, and are removed then.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove the files of a table that :func:`materialize` wrote, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        _drop(table.sparkSession, folder)


@contextmanager
def kept(key: tuple, make: Callable[[], object]) -> Iterator[object]:
    """What ``make`` gives, one for each Python worker, kept from task to task.

    It goes when a task of something else begins, or once no task has used it for ``IDLE_S`` seconds.
    """
    with _lock:
        if key not in _kept:
            let_go()
            _kept[key] = [make(), 0, None]
        own = _kept[key]
        if own[2]:
            own[2].cancel()
        own[1] += 1
    try:
        yield own[0]
    finally:
        with _lock:
            own[1] -= 1
            if not own[1]:
                own[2] = threading.Timer(IDLE_S, _let_go_unused, [own])
                own[2].daemon = True
                own[2].start()


def _let_go_unused(own: list) -> None:
    with _lock:
        if not own[1] and any(x is own for x in _kept.values()):
            let_go()


def let_go() -> None:
    """Free what earlier tasks of this Python worker kept, and give their memory back: workers outlive the query that started them."""
    for own in _kept.values():
        own[0] = None  # its timer holds it too
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- vectorised text scanning ------------------------------------------------


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 truth values that is true on the given closed byte ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Bytes of words between ASCII white space.
NON_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words made of ASCII letters, digits and all characters beyond ASCII.
ALNUM = ~byte_table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each row; a null counts as empty."""
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes, or of a single longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def fold_case(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``table`` bytes that don't cross rows, and each row's first word."""
    mask = table[data].view(np.int8)
    step = np.diff(mask, prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    inner = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    cut = inner[(mask[inner - 1] & mask[inner]) == 1] if len(inner) else inner
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums of a polynomial; the same for equal words anywhere."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right")), i + 1)
        first, last = int(starts[i]), int(ends[j - 1])
        power, inverse = _grown(last - first + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * power[: last - first], out=sums[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def hash_of(word: str) -> int:
    """:func:`word_hashes` of one word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0]) if len(data) else 0


def shingle_hashes(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``n`` words, and each row's first one.

    A row of fewer words has its whole sequence as one; a row without words has none.
    ``first`` holds the rows' first words, and the end.
    """
    counts = np.diff(first)
    have = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    row_first = np.concatenate([[0], np.cumsum(have)])
    rows = np.repeat(np.arange(len(counts)), have)
    at = first[:-1][rows] + np.arange(len(rows)) - row_first[:-1][rows]
    size = np.minimum(counts, n)[rows]
    out = size.astype(np.uint64)
    for k in range(n):
        live = k < size
        part = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else np.zeros(0, np.uint64)
        out = np.where(live, mix(out * np.uint64(0x100000001B3) + part), out)
    return out, row_first
