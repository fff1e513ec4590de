"""Shared pieces: folders that all executors see, files on any file system, vectorised words and hashes."""

from __future__ import annotations

import contextlib
import math
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes that part words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"

_M64 = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; bounds the arrays that hashing makes, whatever a text's length.
SEGMENT = 1 << 19


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which every executor sees. Where it is unset, a local one if driver and
    executors are one process (tests); on a cluster that is an error, as executors would not see each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.gettempdir()}/tideline-checkpoints"
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 512, size: int = 8 << 20) -> None:
    """From now on the session hands texts to Python in small batches: copies of a batch, not of ten thousand texts, are
    what a worker and its executor hold. Smaller settings of the session stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


#: Files whose names are sent to the executors to number them, at most; the rows of more files are written once.
NUMBERED_FILES = 100_000
_ROW_BITS = 40


def _one_table(df: DataFrame) -> bool:
    """Whether df is a projection or filter of one Parquet table, whose rows Spark can name by file and place."""
    if "_metadata" in [c.lower() for c in df.columns]:
        return False
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        if not node.deterministic():
            return False
        node = node.children().head()
    if node.getClass().getSimpleName() != "LogicalRelation" or node.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return False
    relation = node.relation()
    return relation.fileFormat().toString() == "Parquet" and relation.location().rootPaths().size() == 1


def _plain(path: Column | str) -> Column | str:
    """A file's URI with one slash after its scheme, as Spark writes it both ways."""
    if isinstance(path, str):
        return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", path)
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def free_names(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, each with as many underscores after it as make it none of df's columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def keyed(df: DataFrame) -> tuple[DataFrame, str]:
    """(df with one more column, that column's name): a long that tells df's rows apart, the same at every read.

    Of a Parquet table it is made of the file's rank by name and the row's place in the file, so it doesn't depend on how
    a read splits the files. Other inputs are written to the shared folder once, with a key, and read from there. The
    column's name is one that df doesn't have. Keys rise with files and rows.
    """
    spark, (name,) = df.sparkSession, free_names(df, "__row_key")
    files = sorted({_plain(f) for f in df.inputFiles()}) if _one_table(df) else None
    if files is None or len(files) > NUMBERED_FILES:
        return written(df.withColumn(name, F.monotonically_increasing_id()), "keyed-rows"), name
    own = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    ranks = spark.createDataFrame(list(zip(files, range(len(files)), strict=True)) or [("", 0)], f"{name}f string, {name}k long")
    placed = df.select(*own, _plain(F.col("_metadata.file_path")).alias(f"{name}f"), F.col("_metadata.row_index").alias(f"{name}i"))
    placed = placed.join(F.broadcast(ranks), f"{name}f", "left")
    rank = F.coalesce(F.col(f"{name}k"), F.raise_error(F.concat(F.lit("a file that the table doesn't list: "), F.col(f"{name}f"))).cast("long"))
    return placed.select(*own, (F.shiftleft(rank, _ROW_BITS) + F.col(f"{name}i")).alias(name)), name


def row_keyed(df: DataFrame, *columns: Column, key: str | None = None) -> DataFrame:
    """The columns and a key `rid` of each row: df's column `key`, or one of its own (see `keyed`). Rows that repeat an id
    or have none stay apart by it. Texts go to Python in bounded batches from here on."""
    bounded_batches(df.sparkSession)
    if key is not None:
        return df.select(*columns, F.col(key).alias("rid"))
    rows, key = keyed(df.select(*columns))
    return rows.withColumnRenamed(key, "rid")


#: A key that at least that many rows and that share of them have is hot; so there are at most 1 / HOT_SHARE hot keys.
HOT_ROWS, HOT_SHARE = 500, 1e-4


def joined(left: DataFrame, right: DataFrame, keys: list[str], n: str, how: str = "inner", total: int | None = None) -> DataFrame:
    """left joined with right, a table with one row for each key whose column n has the number of left's rows of that key.

    Hot keys, of which there are at most 1 / HOT_SHARE whatever the size, are joined by broadcast where their rows lie, so
    no task gets all rows of a key; all others meet by an exchange. left and right are read twice: they should be tables.
    The column n is dropped; how is `inner` or `left`; total is the number of left's rows, if known.
    """
    total = left.count() if total is None else total
    hot = F.col(n) >= max(HOT_ROWS, math.ceil(total * HOT_SHARE))
    (mark,) = free_names(left, "__hot")
    few = right.filter(hot).drop(n).withColumn(mark, F.lit(True))
    near = left.join(F.broadcast(few), keys, "left")
    others = [c for c in right.columns if c not in keys and c != n]
    far = near.filter(F.col(mark).isNull()).drop(mark, *others).join(right.filter(~hot).drop(n), keys, how)
    return near.filter(F.col(mark)).drop(mark).unionByName(far)


def file_system(uri: str):
    """(pyarrow file system, path in it) of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_file(uri: str, chunks: Iterator[bytes]) -> int:
    """Writes under a name of this attempt, then renames: a task that runs twice leaves one whole file. Returns bytes."""
    system, path = file_system(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    own, size = f"{path}.{uuid.uuid4().hex}.part", 0
    with system.open_output_stream(own, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    with contextlib.suppress(FileNotFoundError):
        system.delete_file(path)
    system.move(own, path)
    return size


def read_file(uri: str) -> bytes:
    system, path = file_system(uri)
    with system.open_input_stream(path, compression=None) as f:
        return f.read()


def mapped_file(uri: str) -> memoryview:
    """The file's bytes, memory-mapped. One that isn't on a local path is first copied to an unlinked temporary file,
    which goes when the mapping does, so executors keep nothing."""
    import mmap

    system, path = file_system(uri)
    if type(system).__name__ == "LocalFileSystem":
        with open(path, "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)) if os.fstat(f.fileno()).st_size else memoryview(b"")
    with tempfile.TemporaryFile() as f, system.open_input_stream(path, compression=None) as source:
        while part := source.read(1 << 22):
            f.write(part)
        f.flush()
        return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)) if f.tell() else memoryview(b"")


def column_bytes(column: pa.Array) -> list[bytes]:
    """A text column's values in UTF-8; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def slices(texts: list[bytes], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of texts of about `most` bytes, so that work arrays stay small; a longer text is alone."""
    a, size = 0, 0
    for i, x in enumerate(texts):
        if size and size + len(x) > most:
            yield a, i
            a, size = i, 0
        size += len(x)
    if a < len(texts):
        yield a, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.empty(SEGMENT + 1, dtype=np.uint64)
    out[0] = 1
    np.multiply.accumulate(np.full(SEGMENT, base & _M64, dtype=np.uint64), out=out[1:])
    return out


class _Tables:
    """Random values of bytes and the powers of the base; built at first use in each worker."""

    def __init__(self) -> None:
        self.byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        self.up, self.down = _powers(_BASE), _powers(_INVERSE)


_tables: list[_Tables] = []


def words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(joined bytes, starts, ends, words before each text and in all): the words of all texts, in order."""
    joined = b" ".join(texts) + b" "
    space = _SPACE[np.frombuffer(joined, dtype=np.uint8)]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate((np.zeros(1, dtype=edge.dtype), edge))
    starts, ends = edge[0::2], edge[1::2]
    first = np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts])))
    return joined, starts, ends, np.searchsorted(starts, first)


def word_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes, the same wherever the word stands. Made by segments of bounded size."""
    if not _tables:
        _tables.append(_Tables())
    t, out, data, k = _tables[0], np.empty(len(starts), dtype=np.uint64), np.frombuffer(joined, dtype=np.uint8), 0
    while k < len(starts):
        at = int(starts[k])
        stop = int(np.searchsorted(ends, at + SEGMENT, side="right"))
        if stop <= k:  # one word longer than a segment
            out[k] = _long_word(t, data[at : int(ends[k])])
            k += 1
            continue
        part = data[at : int(ends[stop - 1])]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(t.byte[part] * t.up[: len(part)], out=sums[1:])
        s = starts[k:stop] - at
        out[k:stop] = (sums[ends[k:stop] - at] - sums[s]) * t.down[s]
        k = stop
    return mix(out ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def _long_word(t: _Tables, data: np.ndarray) -> int:
    total, scale = 0, 1
    for i in range(0, len(data), SEGMENT):
        part = data[i : i + SEGMENT]
        total = (total + scale * int((t.byte[part] * t.up[: len(part)]).sum(dtype=np.uint64))) & _M64
        scale = scale * int(t.up[SEGMENT]) & _M64
    return total


def ngram_hashes(h: np.ndarray, n: int, seed: int = 0, times: int = 0xA0761D6478BD642F) -> np.ndarray:
    """Hash of every run of n items of h (len(h) - n + 1 of them, none if shorter)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(m, seed + 1, dtype=np.uint64)
    for k in range(n):
        out *= np.uint64(times)
        out += h[k : k + m]
    return mix(out)


def lower_ascii(data: bytes) -> bytes:
    """A-Z to a-z; other bytes stay."""
    return data.lower()  # bytes.lower changes ASCII letters only


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def folded(blocks: DataFrame, key: str, start, schema: str, piece: int = 8 << 20) -> DataFrame:
    """Each group of blocks (key, data) by key, folded in pieces, so that a task holds what the group comes to and not all
    its blocks, however many they are.

    start(key) gives an object with add(list of data), called with about `piece` bytes at a time, and done(); both give
    out record batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, held, size = None, None, [], 0
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if state is None or k != now:
                    if state is not None:
                        yield from state.add(held)
                        yield from state.done()
                    now, state, held, size = k, start(k), [], 0
                held.append(data.as_py())
                size += len(held[-1])
                if size >= piece:
                    yield from state.add(held)
                    held, size = [], 0
        if state is not None:
            yield from state.add(held)
            yield from state.done()

    return blocks.select(key, "data").repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)
