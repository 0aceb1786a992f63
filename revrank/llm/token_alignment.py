"""Alignment of two tokenizers over the same bytes, in Arrow tables.

Each batch of texts goes through both tokenizers. List flattening and parent indices give one
row per token, cumulative sums per document the byte its token ends at. A hash join of both
token tables on (document, end) finds the common ends, which cut the tokens into groups; as an
outer join it has one row for every overlapping pair of tokens. Pairs are counted by document
inside a chunk of batches, Spark adds the chunks' counts up and brings each chunk the totals
of its own pairs back.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.llm.common import small_batches
from revrank.llm.word_pieces import PieceEncoder, shared_encoder
from revrank.session import cut

# A chunk is closed from so many different (document, pair) rows on.
CHUNK_PAIRS = 4_000_000
B_BITS = 24


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable characters stand for themselves, the rest follows from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_level_entries(encoder: PieceEncoder) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    byte_of = _byte_of()
    vocabulary = encoder.library.get_vocab()
    entries = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        entries[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return entries


def piece_entries(library: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of every id of a piece vocabulary; U+2581 is a space."""
    entries = []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode())
    return entries


@dataclass
class Aligner:
    """Both tokenizers of a worker, and per id its bytes and its number as text."""

    a: PieceEncoder
    b: sentencepiece.SentencePieceProcessor

    def __post_init__(self) -> None:
        self.a_bytes = pa.array(byte_level_entries(self.a), pa.binary())
        self.b_bytes = pa.array(piece_entries(self.b), pa.binary())
        self.a_sizes, self.b_sizes = pc.binary_length(self.a_bytes), pc.binary_length(self.b_bytes)
        na, nb = len(self.a_bytes), len(self.b_bytes)
        # Ids as text: of A inside and at the end of a group, of B inside and at the end.
        self.texts = pa.array([f"{i}{s}" for n, s in ((na, ","), (na, "|"), (nb, ","), (nb, ";")) for i in range(n)], pa.string())

    def lists(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids by A of a space and the text, and by B of the text."""
        flat, n = self.a.encode(texts, space_first=True)
        a = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(flat))
        return a, pa.array(self.b.encode(texts, num_threads=1), pa.list_(pa.int32()))


def _joined(tokens: pa.ListArray, entries: pa.Array) -> list[memoryview]:
    """Per list the bytes of its tokens in a row."""
    taken = entries.take(pc.list_flatten(tokens))
    data = memoryview(taken.buffers()[2] or b"").cast("B")
    offsets = np.frombuffer(taken.buffers()[1], np.int32)[: len(taken) + 1]
    ends = offsets[tokens.offsets.to_numpy()].tolist()
    return [data[s:e] for s, e in zip(ends, ends[1:])]


def _token_table(tokens: pa.ListArray, sizes: pa.Array, keep: np.ndarray, name: str) -> pa.Table:
    """doc, end (bytes from the start of the document), place and id of the tokens of kept documents."""
    table = pa.table({"doc": pc.list_parent_indices(tokens), f"{name}_id": pc.list_flatten(tokens)})
    table = table.filter(pa.array(keep[table["doc"].to_numpy()]))
    ends = pc.cumulative_sum(pc.cast(sizes.take(table[f"{name}_id"].combine_chunks()), pa.int64())).to_numpy()
    doc = table["doc"].to_numpy()
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    base = np.concatenate((np.zeros(1, np.int64), ends))[first]
    ends = ends - np.repeat(base, np.diff(first, append=len(doc)))
    return table.append_column("end", pa.array(ends)).append_column(name, pa.array(np.arange(len(doc), dtype=np.int64)))


def _group_texts(aligner: Aligner, a: pa.Table, b: pa.Table, a_last: np.ndarray, b_last: np.ndarray) -> tuple[memoryview, np.ndarray, np.ndarray]:
    """The groups of all documents as text, its offsets per token, and the document of each token in that order."""
    na, nb = len(aligner.a_bytes), len(aligner.b_bytes)
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    groups = int(a_last.sum())
    b_before = np.cumsum(np.bincount(b_group, minlength=groups)) - np.bincount(b_group, minlength=groups)
    a_upto = np.cumsum(np.bincount(a_group, minlength=groups))
    a_at, b_at = np.arange(len(a_group)) + b_before[a_group], np.arange(len(b_group)) + a_upto[b_group]
    index = np.zeros(len(a_at) + len(b_at), np.int64)
    index[a_at] = a["a_id"].to_numpy() + na * a_last
    index[b_at] = 2 * na + b["b_id"].to_numpy() + nb * b_last
    doc = np.zeros(len(index), np.int64)
    doc[a_at], doc[b_at] = a["doc"].to_numpy(), b["doc"].to_numpy()
    taken = aligner.texts.take(pa.array(index))
    return memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], np.int32)[: len(index) + 1], doc


def align(aligner: Aligner, texts: list[str | None]) -> tuple[pa.Table, pa.Table]:
    """(documents: n_a, n_b, n_groups, n_links, groups_sha256; pairs: doc, pair, n) of one batch."""
    texts = [t or "" for t in texts]
    a_lists, b_lists = aligner.lists(texts)
    wanted = [b" " + t.encode() for t in texts]
    keep = np.array(
        [len(w) > 1 and x == w and y == w for w, x, y in zip(wanted, _joined(a_lists, aligner.a_bytes), _joined(b_lists, aligner.b_bytes))], bool
    )
    a, b = _token_table(a_lists, aligner.a_sizes, keep, "a"), _token_table(b_lists, aligner.b_sizes, keep, "b")
    both = a.join(b, ["doc", "end"], join_type="full outer", use_threads=False).sort_by([("doc", "ascending"), ("end", "ascending")])
    common = pc.and_(pc.is_valid(both["a"]), pc.is_valid(both["b"])).to_numpy().astype(bool)
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[both["a"].to_numpy()[common].astype(np.int64)] = 1
    b_last[both["b"].to_numpy()[common].astype(np.int64)] = 1

    n = len(texts)
    doc = both["doc"].to_numpy().astype(np.int64)
    data, offsets, owner = _group_texts(aligner, a, b, a_last, b_last)
    ends = offsets[np.searchsorted(owner, np.arange(n + 1))].tolist()
    documents = pa.table({
        "n_a": np.bincount(a["doc"].to_numpy(), minlength=n), "n_b": np.bincount(b["doc"].to_numpy(), minlength=n),
        "n_groups": np.bincount(doc[common], minlength=n), "n_links": np.bincount(doc, minlength=n),
        "groups_sha256": [hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(ends, ends[1:])],
    })
    # A token that goes on past this end has its own end further down, in the same document.
    a_id = pc.fill_null_backward(both["a_id"]).cast(pa.int64())
    b_id = pc.fill_null_backward(both["b_id"]).cast(pa.int64())
    pair = pc.add(pc.shift_left(a_id, B_BITS), b_id)
    pairs = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([("pair", "count")])
    return documents, pairs.rename_columns(["doc", "pair", "n"])


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _chunk_row(number: int, parts: list[tuple[pa.Array, pa.Table, pa.Table]]) -> pa.RecordBatch:
    """A chunk's documents with their pairs by number, and its pairs with the documents that hold them."""
    keys = pa.concat_arrays([k for k, _, _ in parts])
    documents = pa.concat_tables([d for _, d, _ in parts]).append_column("key", keys)
    first = np.cumsum([0] + [len(k) for k, _, _ in parts])
    doc = np.concatenate([p["doc"].to_numpy() + f for f, (_, _, p) in zip(first, parts)])
    pair, n = (pa.concat_tables([p for _, _, p in parts])[c] for c in ("pair", "n"))
    counted = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([("pair", "count")]).sort_by("pair")
    number_of = np.searchsorted(counted["pair"].to_numpy(), pair.to_numpy())
    order = np.lexsort((number_of, doc))
    doc, number_of = doc[order], number_of[order].astype(np.int32)
    # Differences of ascending numbers are small and shrink well.
    step = np.diff(number_of, prepend=np.int32(0))
    links = pa.table({"step": step, "n": n.to_numpy()[order].astype(np.int32)})
    documents = documents.append_column("pairs", pa.array(np.bincount(doc, minlength=len(keys))))
    types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    row = [[number], [_packed(documents)], [_packed(links)], [counted["pair"].to_numpy()], [counted["pair_count"].to_numpy()]]
    names = ["chunk", "documents", "links", "pair", "docs"]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)


def aligned_chunks(
    docs: DataFrame, byte_level_path: str, piece_path: str, text: str = "text", key: str = "doc_id", chunk_pairs: int = CHUNK_PAIRS
) -> DataFrame:
    """One row per chunk of rows of ``docs``: chunk, documents, links (both packed), pair, docs."""
    context = docs.sparkSession.sparkContext
    for path in (byte_level_path, piece_path):
        context.addFile(path)
    a_name, b_name = (p.rsplit("/", 1)[-1] for p in (byte_level_path, piece_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _shared_aligner(SparkFiles.get(a_name), SparkFiles.get(b_name))
        parts, held, chunk = [], 0, TaskContext.get().partitionId() << 32
        for batch in small_batches(batches, 1):
            if not batch.num_rows:
                continue
            documents, pairs = align(aligner, batch.column(1).to_pylist())
            parts.append((batch.column(0), documents, pairs))
            held += len(pairs)
            if held >= chunk_pairs:
                yield _chunk_row(chunk, parts)
                parts, held, chunk = [], 0, chunk + 1
        if parts:
            yield _chunk_row(chunk, parts)

    columns = "chunk bigint, documents binary, links binary, pair array<bigint>, docs array<bigint>"
    return docs.select(key, text).mapInArrow(run, columns)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _shared_aligner(a_path: str, b_path: str) -> Aligner:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (a_path, b_path) not in _ALIGNERS:
        b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        _ALIGNERS[a_path, b_path] = Aligner(shared_encoder(a_path, special_as_text=True), b)
    return _ALIGNERS[a_path, b_path]


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, docs, best): documents that hold a pair linked; ``best``: no pair of its A id has more."""
    listed = chunks.select(F.explode(F.arrays_zip("pair", "docs")).alias("p")).select("p.*")
    counts = cut(listed.groupBy("pair").agg(F.sum("docs").alias("docs"))).withColumn("a", F.shiftright("pair", B_BITS))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align_tokenizers(
    docs: DataFrame, byte_level_path: str, piece_path: str, text: str = "text", key: str = "doc_id", chunk_pairs: int = CHUNK_PAIRS
) -> DataFrame:
    """Per row of ``docs``: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A (byte-level) encodes a space and the text, B (pieces) the text, both without special
    tokens. Null and empty texts, and texts that one of the two changes (its tokens' bytes are
    not the space and the text), have no tokens: zeros and an empty string. Rows are counted as
    documents, so repeated rows count as often as they occur; null keys stay null; other
    columns are not looked at; an empty table gives an empty one. Texts are read whole.

    A chunk's pairs are different ones, at most about ``chunk_pairs`` or those of one text, and
    only they travel to be counted; a pair in every document is one row per chunk.
    """
    kind = docs.schema[key].dataType.simpleString()
    chunks = cut(aligned_chunks(docs, byte_level_path, piece_path, text, key, chunk_pairs))
    listed = chunks.select("chunk", F.posexplode("pair").alias("at", "pair"))
    wanted = listed.join(pair_counts(chunks), "pair").select("chunk", "at", "docs", "best")
    names = [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def finish(own: pa.Table, counted: pa.Table) -> pa.Table:
        docs_of, best_of = np.zeros(len(counted), np.int64), np.zeros(len(counted), np.int64)
        at = counted["at"].to_numpy()
        docs_of[at], best_of[at] = counted["docs"].to_numpy(), counted["best"].to_numpy()
        out = []
        for packed_documents, packed_links in zip(own["documents"], own["links"]):
            documents = pa.ipc.open_stream(packed_documents.as_buffer()).read_all()
            links = pa.ipc.open_stream(packed_links.as_buffer()).read_all()
            sizes, step = documents["pairs"].to_numpy(), links["step"].to_numpy().astype(np.int64)
            number = np.cumsum(step)
            n = links["n"].to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            sums = []
            for value in (n * best_of[number], n * docs_of[number]):
                total = np.concatenate((np.zeros(1, np.int64), np.cumsum(value)))
                sums.append(total[ends] - total[ends - sizes])
            found = {key: documents["key"], "n_best": sums[0], "count_sum": sums[1]}
            found |= {c: documents[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            out.append(pa.table({c: found[c] for c in names}))
        return pa.concat_tables(out)

    schema = f"{key} {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    left = chunks.select(F.col("chunk").alias("own"), "documents", "links").groupBy("own")
    return left.cogroup(wanted.groupBy("chunk")).applyInArrow(finish, schema)
