"""Token ids in files of Simple-8b words: encoder, decoder, and a table of documents written and read back.

A word has a selector in its top four bits and, under it, as many ids as their widths allow. Blocks of BLOCK ids start at
a word, and each segment lists its blocks' words, so all blocks are encoded and decoded side by side. An id of over 60
bits is escaped: selector 15 and the id's place in the segment's list of such ids.

Defined cases: a null text counts as empty and has its end id alone; rows with null or repeated ids are written like
others, null first; a very long text is encoded whole, in one segment; an empty table gives no files and no rows. Only
doc_id and text are read, so other columns clash with nothing.

A file is a run of segments of whole documents, each readable by its offset alone:
magic `TDL-S8B1`, then as 64-bit little-endian integers the numbers of documents, ids, blocks, words and escapes; then
the documents' ids (int64), their null flags (uint8), their lengths (uint64), the blocks' first words (uint64), the
escaped ids (uint64) and the words (uint64).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _common as common
from . import tokens
from .substrings import ranges

MAGIC = b"TDL-S8B1"
BLOCK = 1024
#: Fixed values of the coding: (ids in a word, bits of each) by selector.
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
#: Ids of a segment at least (but the last), so that a task holds little and a reader can start anywhere.
SEGMENT = 1 << 19
#: Bytes of input for each file, and of files for each task that reads; so files and tasks grow in number, not in size.
FILE_BYTES, READ_BYTES = 128 << 20, 64 << 20


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, up to 60 for what takes no more."""
    if int(ids.max(initial=0)) < 1 << 53:  # a double's exponent is the number of bits
        exponent = ids.astype(np.float64).view(np.uint64) >> np.uint64(52)
        return np.where(ids > 0, exponent.astype(np.int64) - 1022, 0).astype(np.uint8)
    out = np.zeros(len(ids), dtype=np.uint8)
    for k in range(1, 61):
        out[ids >= np.uint64(1 << (k - 1))] = k
    return out


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, the blocks' first words, escaped ids) of unsigned ids."""
    ids = ids.astype(np.uint64)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    wide = ids >> np.uint64(60) > 0
    escaped = ids[wide]
    grid = np.zeros((blocks, BLOCK + 64), dtype=np.uint64)
    flat = np.zeros(blocks * BLOCK, dtype=np.uint64)
    flat[:n] = ids
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    bits = np.zeros((blocks, BLOCK + 64), dtype=np.uint8)
    bits[:, :BLOCK] = widths(flat).reshape(blocks, BLOCK)
    if len(escaped):
        bits[:, :BLOCK] = np.where(_padded(wide, len(flat)).reshape(blocks, BLOCK), 61, bits[:, :BLOCK])
    # The largest width in the next 1, 2, 4 ... ids, and from these in the next `count` ids.
    most = [bits]
    while 2 ** len(most) <= 60:
        last, step = most[-1], 2 ** (len(most) - 1)
        most.append(np.maximum(last, np.concatenate((last[:, step:], np.zeros((blocks, step), np.uint8)), axis=1)))
    choice = np.full((blocks, BLOCK), ESCAPE, dtype=np.uint8)
    for selector in range(len(SELECTORS) - 1, -1, -1):
        count, width = SELECTORS[selector]
        k = count.bit_length() - 1
        shift = count - 2**k
        reach = np.maximum(most[k][:, :BLOCK], most[k][:, shift : shift + BLOCK])
        choice = np.where(reach <= width, np.uint8(selector), choice)
    counts = np.array([c for c, _ in SELECTORS] + [0, 1])
    length = np.full(blocks, BLOCK)
    if blocks:
        length[-1] = n - BLOCK * (blocks - 1)
    at, alive, rows, places = np.zeros(blocks, dtype=np.int64), np.arange(blocks), [], []
    while len(alive):
        here = at[alive]
        rows.append(alive)
        places.append(here)
        at[alive] = here + counts[choice[alive, here]]
        alive = alive[at[alive] < length[alive]]
    if not rows:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), escaped
    row, place = np.concatenate(rows), np.concatenate(places)
    order = np.argsort(row.astype(np.uint16) if blocks < 1 << 16 else row, kind="stable")  # places rise already
    row, place = row[order], place[order]
    picked = choice[row, place]
    words = picked.astype(np.uint64) << np.uint64(60)
    for selector, (count, width) in enumerate(SELECTORS):
        at_word = np.flatnonzero(picked == selector)
        for k in range(count if len(at_word) else 0):
            words[at_word] |= grid[row[at_word], place[at_word] + k] << np.uint64(k * width)
    if len(escaped):
        words[picked == ESCAPE] |= np.arange(len(escaped), dtype=np.uint64)
    return words, np.searchsorted(row, np.arange(blocks)).astype(np.uint64), escaped


def _padded(flags: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate((flags, np.zeros(n - len(flags), dtype=bool)))


def decode(words: np.ndarray, firsts: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The n ids that encode() was given, as uint64."""
    picked = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in SELECTORS] + [0, 1])[picked]
    before = np.cumsum(counts) - counts
    block = np.searchsorted(firsts, np.arange(len(words)), side="right") - 1
    place = before - before[firsts.astype(np.int64)][block] + block * BLOCK if len(words) else before
    limit = np.minimum((block + 1) * BLOCK, n)
    out = np.zeros(n, dtype=np.uint64)
    for selector, (count, width) in enumerate(SELECTORS):
        at_word = np.flatnonzero(picked == selector)
        mask = np.uint64((1 << width) - 1)
        for k in range(count if len(at_word) else 0):
            to = place[at_word] + k
            fits = to < limit[at_word]
            out[to[fits]] = (words[at_word[fits]] >> np.uint64(k * width)) & mask
    if len(escaped):
        at_word = picked == ESCAPE
        out[place[at_word]] = escaped[(words[at_word] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


def segment_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    words, firsts, escaped = encode(ids)
    head = np.array([len(doc_ids), len(ids), len(firsts), len(words), len(escaped)], dtype="<u8")
    keys = np.array([x or 0 for x in doc_ids], dtype="<i8")
    nulls = np.array([x is None for x in doc_ids], dtype="u1")
    return b"".join((MAGIC, *(x.tobytes() for x in (head, keys, nulls, np.array(lengths, "<u8"), firsts.astype("<u8"), escaped.astype("<u8"), words.astype("<u8")))))


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(documents' ids, their lengths, all ids) of a segment."""
    if data[:8] != MAGIC:
        raise ValueError("not a segment of token ids")
    docs, n, blocks, words, escapes = np.frombuffer(data, "<u8", 5, 8).tolist()
    at, parts = 48, []
    for kind, count in (("<i8", docs), ("u1", docs), ("<u8", docs), ("<u8", blocks), ("<u8", escapes), ("<u8", words)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    keys, nulls, lengths, firsts, escaped, coded = parts
    return [None if z else k for k, z in zip(keys.tolist(), nulls.tolist(), strict=True)], lengths, decode(coded, firsts, escaped, n)


def write_ids(docs: DataFrame, folder: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Writes the ids of all texts, each followed by end_id, in ascending order of doc_id (null first; among equal ids by
    a hash of the text) to files under folder, one for each partition of a range partitioning, as many as the input's size
    asks for.

    Returns the list of segments: file_no, segment, file, at, n_bytes, n_docs, n_ids. A null text counts as empty. An
    empty table gives an empty list. Running it writes; so write its result to a table before use.
    """
    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        file, code, end = f"{folder}/ids-{number:06d}.s8b", tokens.encoder(path), np.array([end_id], dtype=np.uint32)
        rows: list[tuple] = []

        def segments() -> Iterator[bytes]:
            keys: list[int | None] = []
            lengths: list[int] = []
            parts: list[np.ndarray] = []
            held = at = 0

            def close() -> bytes:
                nonlocal at
                data = segment_bytes(keys, lengths, np.concatenate(parts))
                rows.append((number, len(rows), file, at, len(data), len(keys), held))
                at += len(data)
                return data

            for batch in batches:
                for a in range(0, batch.num_rows, 64):
                    part = batch.slice(a, 64)
                    for key, ids in zip(part.column(0).to_pylist(), code([x or "" for x in part.column(1).to_pylist()]), strict=True):
                        keys.append(key)
                        lengths.append(len(ids) + 1)
                        parts += [ids, end]
                        held += len(ids) + 1
                        if held >= SEGMENT:
                            yield close()
                            keys, lengths, parts, held = [], [], [], 0
            if keys:
                yield close()

        if common.write_file(file, segments()):
            columns = list(zip(*rows, strict=True))
            names = ["file_no", "segment", "file", "at", "n_bytes", "n_docs", "n_ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "file" else pa.int64()) for c, k in zip(columns, names, strict=True)], names)

    n = ranges(docs, FILE_BYTES)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .mapInArrow(run, "file_no long, segment long, file string, at long, n_bytes long, n_docs long, n_ids long")
    )


def read_ids(segments: DataFrame) -> DataFrame:
    """Documents of the listed segments: doc_id, start (ids of all documents before it), n_tokens, ids (binary, unsigned
    32-bit little-endian). Segments are read side by side; only totals of files meet in one task."""
    spark = segments.sparkSession
    files = segments.groupBy("file_no").agg(F.sum("n_ids").alias("file_ids"))
    files = files.select("file_no", (F.sum("file_ids").over(Window.orderBy("file_no")) - F.col("file_ids")).alias("file_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("file_no").orderBy("segment")) - F.col("n_ids")
    listed = segments.withColumn("inside", inside).join(files, "file_no")
    listed = listed.select("file", "at", "n_bytes", (F.col("file_start") + F.col("inside")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = common.file_system(row["file"])
                with system.open_input_file(path) as f:
                    keys, lengths, ids = read_segment(f.read_at(row["n_bytes"], row["at"]))
                ends = np.cumsum(lengths).astype(np.int64)
                starts = ends - lengths.astype(np.int64)
                data, code = ids.astype("<u4"), pa.binary()
                for a in range(0, len(keys), 512):
                    b = min(a + 512, len(keys))
                    own = [data[x:y].tobytes() for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
                    columns = [pa.array(keys[a:b], pa.int64()), pa.array(starts[a:b] + row["first"]), pa.array(lengths[a:b].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(own, code)], ["doc_id", "start", "n_tokens", "ids"])

    size = segments.agg(F.sum("n_bytes").alias("n")).first().n or 0
    return listed.repartition(max(1, common.partitions(spark), size // READ_BYTES), "file", "at").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Writes all ids to files in the shared folder and reads them back."""
    spark = docs.sparkSession
    return read_ids(common.written(write_ids(docs, common.new_folder(spark, "ids"), end_id, path), "ids-segments"))
