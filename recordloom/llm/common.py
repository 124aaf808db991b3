"""What several operators share: the shared folder, checked broadcasts and vectorised word hashing."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table of narrow rows (a few numbers each) up to which it may be broadcast.
BROADCAST_ROWS = 500_000
#: Rows and bytes of an Arrow batch (one row at least): few, as documents may be very long.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Rows of a file of narrow rows, where a result is written from rows that are there already.
FILE_ROWS = 250_000


_made: set[str] = set()
_kept: dict[str, list[DataFrame]] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path under the one that the cluster names in spark.checkpoint.dir; under a temporary one only where that is unset, as in tests.

    What is left in it when the driver's process ends is deleted then; operators delete what their results don't read any more."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or _own_root()
    path = f"{root.rstrip('/')}/recordloom-{uuid.uuid4().hex}"
    _made.add(path)
    return path


def made() -> set[str]:
    """The folders' paths that operators have made and that aren't deleted yet."""
    return set(_made)


@functools.cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="recordloom-")


@atexit.register
def _clear() -> None:
    with contextlib.suppress(Exception):
        spark = SparkSession.getActiveSession()
        if spark is not None and not spark.sparkContext._jsc.sc().isStopped():
            for path in list(_made):
                remove(spark, path)
    if _own_root.cache_info().currsize:
        shutil.rmtree(_own_root(), ignore_errors=True)


def remove(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> None:
    """Delete a folder of the shared file system, but for the entries to keep."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not keep:
        fs.delete(hadoop, True)
        _made.discard(path)
    elif fs.exists(hadoop):
        for entry in fs.listStatus(hadoop):
            if entry.getPath().getName() not in keep:
                fs.delete(entry.getPath(), True)


def table(df: DataFrame, path: str, rows: int = BATCH_ROWS) -> DataFrame:
    """Write df and read it again: its lineage ends there, and a lost executor costs no more than the tasks it ran. While it is written,
    Arrow batches have at most so many rows; the session's own setting stands again when this returns."""
    with batch_rows(df.sparkSession, rows):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, work: str, rows: int = BATCH_ROWS) -> tuple[DataFrame, int]:
    """df, computed now and kept in blocks on the executors' disks until `result` or `let_go` of the same folder, and its number of rows.

    For narrow rows that several steps read. What is lost with an executor is computed again. A table has a file for each task, for each
    of which an executor without Hadoop's native library starts processes (chmod), and one just started counts as a second JVM; blocks start none."""
    with batch_rows(df.sparkSession, rows):
        df = df.persist(StorageLevel.DISK_ONLY)
        _kept.setdefault(work, []).append(df)
        n = df.count()
        # By its blocks alone: else plans that are built on it hold its plan, and the driver many copies of it.
        blocks = df.sparkSession._jsparkSession.internalCreateDataFrame(df.select("*")._jdf.queryExecution().toRdd(), df._jdf.schema(), False)
        return DataFrame(blocks, df.sparkSession), n


def let_go(work: str) -> None:
    """Delete what `kept` has kept for this folder."""
    for df in _kept.pop(work, []):
        df.unpersist()


def result(df: DataFrame, work: str, rows: int = BATCH_ROWS) -> DataFrame:
    """df as a table, and nothing else left in the folder `work` or kept for it."""
    out = table(df, f"{work}/result", rows)
    let_go(work)
    remove(df.sparkSession, work, ("result",))
    return out


def free(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def make_room(df: DataFrame, *names: str) -> DataFrame:
    """df, its columns of these names (in any case) renamed to <name>_input, with more underscores if that is taken: results don't replace them."""
    for c in df.columns:
        if c.lower() in names:
            new = f"{c}_input"
            while new.lower() in {x.lower() for x in df.columns} | set(names):
                new += "_"
            df = df.withColumnRenamed(c, new)
    return df


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df for the side of a join: with a broadcast hint if it was counted to have at most so many rows, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """While it lasts, Arrow batches have at most so many rows, and no more once they have BATCH_BYTES: for wide rows."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    before = {key: spark.conf.get(key) for key in limits}
    for key, most in limits.items():
        spark.conf.set(key, most)
    try:
        yield
    finally:
        for key, most in before.items():
            spark.conf.set(key, most)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one in fewer files than there are cores is dealt out to all of them (a small file is often one row group, which is one task)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def crc_mod(column: str, n: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


# ---- words as 64-bit numbers -------------------------------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes that are hashed at once: they fit a cache, and a worker needs little memory beside its batch.
_WINDOW = 1 << 17
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_CODES[65:91] = _CODES[97:123]  # A-Z count as a-z
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        for name, base in (("_POWERS", _BASE), ("_INVERSES", pow(_BASE, -1, 1 << 64))):
            x = np.full(max(n, _WINDOW), np.uint64(base))
            x[0] = 1
            globals()[name] = np.multiply.accumulate(x)
    return _POWERS, _INVERSES


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column, and where each row begins (one entry more than rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def characters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character of UTF-8 rows, and each row's first. A character: a lead byte and the continuation bytes after it, of
    which three count; so bytes that aren't UTF-8 have numbers, too. Places are made a window at a time, as they take more room than the text."""
    lead = (data & 0xC0) != 0x80
    some = np.flatnonzero(np.diff(off))
    lead[off[some]] = True
    first = np.zeros(len(off), np.int64)
    if len(some):
        first[some + 1] = np.add.reduceat(lead, off[some], dtype=np.int64)
    np.cumsum(first, out=first)
    codes, done = np.empty(first[-1], np.uint32), 0
    for a in range(0, len(data), _WINDOW):
        at = np.flatnonzero(lead[a : a + _WINDOW]) + a
        own, on = data[at].astype(np.uint32), np.arange(len(at))
        for k in (1, 2, 3):
            on = on[at[on] + k < len(data)]
            on = on[~lead[at[on] + k]]
            own[on] |= data[at[on] + k].astype(np.uint32) << np.uint32(8 * k)
        codes[done : done + len(at)] = own
        done += len(at)
    return codes, first


def windows(off: np.ndarray, most: int):
    """Rows [i, j) of at most so many elements together, or a larger row's pieces: (i, j, begin, end). A row's pieces depend on it alone."""
    i = 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        if j == i + 1:
            for a in range(int(off[i]), max(int(off[j]), int(off[i]) + 1), most):
                yield i, j, a, min(a + most, int(off[j]))
        else:
            yield i, j, int(off[i]), int(off[j])
        i = j


def ngram_hashes(codes: np.ndarray, begin: np.ndarray, orders: int) -> list[np.ndarray]:
    """For each n up to `orders` a hash of the n characters that end at each place; a text's start (places `begin`, ascending) stands before
    it once, and n-grams reach back no further."""
    own = mix(codes.astype(np.uint64) + np.uint64(301))
    begin = begin[begin < len(codes)]
    out, h = [own], own
    for _ in range(orders - 1):
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[begin] = 7
        h = own + np.uint64(0x9E3779B97F4A7C15) * before
        out.append(h)
    return out


def row_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each row's sum, by itself: it doesn't depend on what rows stand beside it."""
    out = np.zeros(len(off) - 1)
    some = np.flatnonzero(np.diff(off))
    if len(some):
        out[some] = np.add.reduceat(values, off[some], dtype=np.float64)
    return out


#: As SPACE, with all ASCII punctuation: what remains are words without it.
PUNCT = SPACE.copy()
PUNCT[[c for c in range(128) if not chr(c).isalnum()]] = True


def word_bounds(data: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each run of other bytes than white space; no word spans two rows. Third: each row's first word, one entry more than rows."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~space[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = np.ones(n, bool)
    before[1:] = ~solid[:-1]
    after = np.ones(n, bool)
    after[:-1] = ~solid[1:]
    start = np.flatnonzero(solid & (before | cut[:n]))
    end = np.flatnonzero(solid & (after | cut[1:])) + 1
    return start, end, np.searchsorted(start, off)


def words(column, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, and each row's first word (one entry more than rows).

    A polynomial over the bytes' random codes, by prefix sums in windows; equal words have equal hashes wherever they stand.
    Different words share one with probability about pairs / 2**64.
    """
    data, off = text_bytes(column)
    start, end, first = word_bounds(data, off, space)
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _WINDOW, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        power, inverse = _powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_CODES[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        out[i:j] = (sums[end[i:j] - lo] - sums[start[i:j] - lo]) * inverse[start[i:j] - lo]
        i = j
    return mix(out), first


_PLACE = mix(np.arange(11, 43, dtype=np.uint64))


def shingles(hashes: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of n words (a shorter row: all its words as one run), with each row's first run; repeats stay."""
    count = np.diff(first)
    total = len(hashes)
    runs = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    begin = np.zeros(len(first), np.int64)
    np.cumsum(runs, out=begin[1:])
    if not total:
        return np.zeros(0, np.uint64), begin
    place = np.repeat(first[:-1] - begin[:-1], runs) + np.arange(begin[-1])
    out = np.zeros(len(place), np.uint64)
    length = np.repeat(np.minimum(count, n), runs)
    for k in range(n):
        on = length > k
        out[on] += hashes[place[on] + k] * (_PLACE[k] | np.uint64(1))
    return mix(out + length.astype(np.uint64) * _PLACE[20]), begin
