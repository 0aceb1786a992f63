"""Token ids in binary files of directly addressable codes.

An id is cut into chunks of bits, lowest first. Level 0 holds the first chunk of every id,
level 1 the second chunk of those ids that need one, and so on. A bitmap per level tells
which of its entries go on, and a directory of ones before every 512th entry turns a place
of one level into the place of the next. So any token, or any stretch of tokens, is read
by a few short reads at computed places; no block has to be decoded.

A file: ``DAC1``, length of the header (u32), header (JSON), sections. Sections: per level
the chunks (packed bits, low bit first), the bitmap and the directory (u64) for all levels
but the last; then the first token of every document (u64, one more than documents) and the
documents' keys (an Arrow stream). All numbers are little-endian.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revrank.llm.common import running_totals, small_batches
from revrank.llm.word_pieces import shared_encoder
from revrank.session import checkpoint_folder

MAGIC = b"DAC1"
# Entries between two entries of a directory of ones.
RANK_STEP = 512
SEGMENT_TOKENS = 1 << 22
# Text encoded at once: the more, the fewer pieces are looked up again.
BATCH_BYTES = 8_000_000
# Tokens read at once when a whole file is read.
STRETCH = 1 << 18


def level_widths(ids: np.ndarray) -> list[int]:
    """The cut of ids into chunk widths with the fewest bits in all, directories included."""
    top = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    if top <= 20:
        counts = np.bincount(ids, minlength=1)
        longer = [len(ids)] + [int(counts[1 << b :].sum()) for b in range(1, top)]
    else:
        longer = [len(ids)] + [int(np.count_nonzero(ids >= (1 << b))) for b in range(1, top)]
    best: list[tuple[float, list[int]]] = [(0.0, [])] * (top + 1)
    for start in range(top - 1, -1, -1):
        options = []
        for stop in range(start + 1, top + 1):
            bits = stop - start + (0 if stop == top else 1 + 64 / RANK_STEP)
            options.append((longer[start] * bits + best[stop][0], [stop - start, *best[stop][1]]))
        best[start] = min(options)
    return best[0][1]


def pack(values: np.ndarray, width: int) -> bytes:
    """``width`` bits of every value, low bit first; eight values take ``width`` bytes."""
    kind = np.uint32 if width <= 25 else np.uint64
    rows = np.zeros((-(-len(values) // 8), 8), kind)
    rows.reshape(-1)[: len(values)] = values
    out = np.zeros((len(rows), width), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        moved = rows[:, j] << kind(shift)
        for k in range(-(-(shift + width) // 8)):
            out[:, byte + k] |= (moved >> kind(8 * k)).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, skip: int, n: int, width: int) -> np.ndarray:
    """``n`` values of ``width`` bits after the first ``skip`` ones of ``data`` (whole groups of eight)."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, width)
    kind = np.uint32 if width <= 25 else np.uint64
    out = np.empty((len(rows), 8), np.uint32)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        value = rows[:, byte].astype(kind)
        for k in range(1, -(-(shift + width) // 8)):
            value |= rows[:, byte + k].astype(kind) << kind(8 * k)
        out[:, j] = (value >> kind(shift)) & kind((1 << width) - 1)
    return out.reshape(-1)[skip : skip + n]


def write_codes(out, ids: np.ndarray, starts: np.ndarray, keys: pa.Array) -> None:
    """One file of ``ids``; document k has those from ``starts[k]`` to ``starts[k + 1]``."""
    sections: list[bytes] = []
    levels = []

    def add(data: bytes) -> int:
        sections.append(data)
        return len(sections) - 1

    widths = level_widths(ids)
    rest = ids.astype(np.uint32)
    for depth, width in enumerate(widths):
        level = {"width": width, "n": len(rest), "chunks": add(pack(rest & np.uint32((1 << width) - 1), width))}
        if depth + 1 < len(widths):
            rest = rest >> np.uint32(width)
            more = rest > 0
            level["more"] = add(np.packbits(more, bitorder="little").tobytes())
            ones = np.add.reduceat(more, np.arange(0, len(more), RANK_STEP), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
            level["ones"] = add((np.cumsum(ones, dtype=np.uint64) - ones).astype("<u8").tobytes())
            rest = rest[more]
        levels.append(level)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("key", keys.type)])) as stream:
        stream.write_batch(pa.RecordBatch.from_arrays([keys], names=["key"]))
    header = {
        "tokens": len(ids), "docs": len(keys), "levels": levels,
        "starts": add(starts.astype("<u8").tobytes()), "keys": add(sink.getvalue().to_pybytes()),
    }
    header["places"] = np.concatenate(([0], np.cumsum([len(s) for s in sections]))).tolist()
    text = json.dumps(header).encode()
    out.write(MAGIC + len(text).to_bytes(4, "little") + text)
    for s in sections:
        out.write(s)


class CodeFile:
    """Random access to a file written by ``write_codes`` (an open Arrow file)."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        head = file.read_at(8, 0)
        if bytes(head[:4]) != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(head[4:8], "little")
        self.header = json.loads(file.read_at(size, 8))
        self.base = 8 + size
        self.tokens_in_all, self.docs = self.header["tokens"], self.header["docs"]

    def _read(self, section: int, start: int, stop: int) -> bytes:
        places = self.header["places"]
        stop = min(stop, places[section + 1] - places[section])
        return self.file.read_at(stop - start, self.base + places[section] + start) if stop > start else b""

    def _bits(self, section: int, start: int, stop: int) -> np.ndarray:
        data = np.frombuffer(self._read(section, start // 8, -(-stop // 8)), np.uint8)
        return np.unpackbits(data, count=start % 8 + stop - start, bitorder="little")[start % 8 :].astype(bool)

    def _rank(self, level: dict, place: int) -> int:
        """Ones of the level's bitmap before ``place``."""
        block = min(place // RANK_STEP, max(0, -(-level["n"] // RANK_STEP) - 1))
        before = int.from_bytes(self._read(level["ones"], 8 * block, 8 * block + 8), "little")
        return before + int(self._bits(level["more"], block * RANK_STEP, place).sum())

    def read(self, start: int, stop: int) -> np.ndarray:
        """Tokens from place ``start`` to before ``stop``."""
        ids = np.zeros(0, np.uint32)
        where, shift = np.arange(stop - start), 0
        for level in self.header["levels"]:
            if not len(where):
                break
            width = level["width"]
            data = self._read(level["chunks"], start // 8 * width, -(-stop // 8) * width)
            chunks = unpack(data, start % 8, stop - start, width) << np.uint32(shift)
            if shift:
                ids[where] |= chunks
            else:
                ids = chunks
            if "more" not in level:
                break
            where = where[self._bits(level["more"], start, stop)]
            start = self._rank(level, start)
            stop, shift = start + len(where), shift + width
        return ids

    def token(self, place: int) -> int:
        if not 0 <= place < self.tokens_in_all:
            raise IndexError(place)
        return int(self.read(place, place + 1)[0])

    def starts(self, first: int = 0, last: int | None = None) -> np.ndarray:
        last = self.docs if last is None else last
        return np.frombuffer(self._read(self.header["starts"], 8 * first, 8 * (last + 1)), "<u8").astype(np.int64)

    def document(self, k: int) -> np.ndarray:
        start, stop = self.starts(k, k + 1)
        return self.read(int(start), int(stop))

    def keys(self) -> pa.Array:
        places, section = self.header["places"], self.header["keys"]
        data = self._read(section, 0, places[section + 1] - places[section])
        return pa.ipc.open_stream(data).read_all().column(0).combine_chunks()


@lru_cache(maxsize=8)
def _store(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return fs.FileSystem.from_uri(folder)


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 0, text: str = "text", key: str = "doc_id",
    segment_tokens: int = SEGMENT_TOKENS,
) -> DataFrame:
    """Encode all texts, append ``end_id`` to each, write files in ascending order of ``key``.

    Returns the list of files, itself a written table: part, seq, file, docs, tokens; files follow
    each other by (part, seq). Files lie in ``folder`` (default: a new one in the shared folder),
    which all executors must reach. A file's name has its task attempt in it and only files of
    successful attempts are listed, so a lost executor leaves at most files nobody lists.

    Null text counts as empty: the end id alone. Null keys come first, rows of one key follow
    each other by a digest of the text, equal rows are written as often as they occur. Other
    columns are not looked at. An empty table gives an empty list. Rows are dealt out by ranges of
    (key, digest), so a key with many different texts is split. A task holds one segment of
    about ``segment_tokens`` ids, or one whole text if that is longer.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer_path)
    name = tokenizer_path.rsplit("/", 1)[-1]
    folder = folder or f"{checkpoint_folder(spark)}/tokens-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(SparkFiles.get(name))
        context = TaskContext.get()
        part, attempt, seq = context.partitionId(), context.taskAttemptId(), 0
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        keys: list[pa.Array] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq
            where, path = _store(folder)
            where.create_dir(path, recursive=True)
            file = f"part-{part:06d}-{seq:04d}-{attempt}.dac"
            flat, sizes = np.concatenate(ids), np.concatenate(counts)
            with where.open_output_stream(f"{path}/{file}") as out:
                write_codes(out, flat, np.concatenate(([0], np.cumsum(sizes))), pa.concat_arrays(keys))
            row = [[part], [seq], [f"{folder}/{file}"], [len(sizes)], [len(flat)]]
            seq += 1
            ids.clear(), counts.clear(), keys.clear()
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["part", "seq", "file", "docs", "tokens"])

        held = 0
        for batch in small_batches(batches, 1, BATCH_BYTES):
            if not batch.num_rows:
                continue
            flat, n = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            ids.append(np.insert(flat, np.cumsum(n), end_id))
            counts.append(n + 1)
            keys.append(batch.column(0))
            held += len(ids[-1])
            if held >= segment_tokens:
                yield flush()
                held = 0
        if held:
            yield flush()

    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    order = [F.asc_nulls_first("key"), "tie"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "text")
    listed = rows.mapInArrow(run, "part bigint, seq bigint, file string, docs bigint, tokens bigint")
    listed.write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def _with_first(files: DataFrame) -> DataFrame:
    """``first``: ids in all files before."""
    sums = running_totals(files.groupBy("part").agg(F.sum("tokens").alias("tokens")), [], "part", "tokens")
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("tokens").over(earlier), F.lit(0))
    return files.withColumn("inside", inside).join(sums.select("part", "before"), "part").withColumn("first", F.col("before") + F.col("inside"))


def _read_files(files: DataFrame, key_type: str, columns: str, make) -> DataFrame:
    """Rows made by ``make(ids, starts)`` of stretches of documents, one task for a few files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder, name = file.rsplit("/", 1)
                where, path = _store(folder)
                with where.open_input_file(f"{path}/{name}") as opened:
                    codes = CodeFile(opened)
                    keys, starts, at = codes.keys(), codes.starts(), 0
                    while at < codes.docs:
                        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + STRETCH, "right")) - 1)
                        own = starts[at : stop + 1]
                        ids = codes.read(int(own[0]), int(own[-1]))
                        made = make(ids, own - own[0])
                        arrays = [keys[at:stop], pa.array(own[:-1] + first, pa.int64()), pa.array(np.diff(own), pa.int64()), *made]
                        yield pa.RecordBatch.from_arrays(arrays, names=names)
                        at = stop

    schema = f"doc_id {key_type}, start bigint, n_tokens bigint, {columns}"
    names = [c.split()[0] for c in schema.split(", ")]
    tasks = 2 * files.sparkSession.sparkContext.defaultParallelism
    return _with_first(files).select("file", "first").repartition(tasks, "file").mapInArrow(run, schema)


def read_token_files(files: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Per document, read back: doc_id, start (ids of all documents before it), n_tokens, ids."""

    def make(ids: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int64)))]

    return _read_files(files, key_type, "ids array<bigint>", make)


def token_file_digests(files: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Per document, read back: doc_id, start, n_tokens, crc32 of its ids as unsigned 32-bit integers."""

    def make(ids: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
        raw = memoryview(ids.astype("<u4").tobytes())
        ends = (4 * starts).tolist()
        return [pa.array([zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())]

    return _read_files(files, key_type, "ids_crc32 bigint", make)
