"""SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes characters; again and again the adjacent pair whose union is the best-scored
piece is merged, ties to the left. Characters left without a piece fall back to their bytes.

A merge never crosses a place that no piece of the vocabulary spans, so a text is cut there
first and every distinct chunk is encoded once per worker and kept. Long chunks use an
agenda (a heap of scored pairs); the many short ones go through the same merges in lock step,
one merge per chunk and step, in arrays.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from revrank.llm.common import small_batches
from revrank.llm.word_pieces import Remembered

SPACE = "▁"
# Chunks up to this many characters go through the arrays.
SHORT = 48
KEPT_CHUNKS = 600_000
KEPT_CHARACTERS = 12_000_000
# As a stage between others a worker has less room: it keeps a fifth of that, and takes less text at once.
STAGE_SHARE = 5
STAGE_BATCH_BYTES = 500_000


class PieceTable:
    """What the merges need from a model file: pieces, their scores, safe cuts."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        self.ids: dict[str, int] = {}
        for i in range(lib.get_piece_size()):
            if lib.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not merge-only")
            if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)):
                self.ids[lib.id_to_piece(i)] = i
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if lib.unk_id() in self.bytes:
            raise ValueError("the vocabulary has no byte fallback")
        self._prepare_cuts()
        self._prepare_arrays()

    def _prepare_cuts(self) -> None:
        longer = [p for p in self.ids if len(p) > 1]
        joined = set("".join(longer)) - {SPACE}
        inner = "".join(sorted(re.escape(c) for c in joined))
        self.chunks = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|[^{inner}{SPACE}]")
        # A space mark inside a piece, after another character, would make the cut unsafe.
        self.safe = not any(SPACE in p.lstrip(SPACE) for p in longer)

    def _prepare_arrays(self) -> None:
        # Symbols are piece ids; characters without a piece get numbers from here on.
        self.first_unknown = max(self.ids.values()) + 1
        rank = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = np.full(self.first_unknown, np.iinfo(np.int32).max, np.int32)
        for p, i in self.ids.items():
            self.rank[i] = rank[self.score[p]]
        keys, made = [], []
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    keys.append((a << 32) | b)
                    made.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.pair_made = np.append(np.array(made, np.int32)[order], -1).astype(np.int32)

    def finish(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is None:
                out.extend(self.bytes[b] for b in s.encode())
            else:
                out.append(i)
        return out

    def by_agenda(self, chunk: str) -> list[int]:
        """One chunk of any length: a heap of scored neighbour pairs, dead entries skipped."""
        symbols: list[str | None] = list(chunk)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, str]] = []
        score = self.score

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0:
                union = symbols[a] + symbols[b]
                s = score.get(union)
                if s is not None:
                    heapq.heappush(agenda, (-s, a, b, union))

        for a in range(n - 1):
            offer(a, a + 1)
        while agenda:
            _, a, b, union = heapq.heappop(agenda)
            if symbols[a] is None or symbols[b] is None or right[a] != b or symbols[a] + symbols[b] != union:
                continue
            symbols[a], symbols[b] = union, None
            right[a] = right[b]
            if right[a] >= 0:
                left[right[a]] = a
            offer(left[a], a)
            offer(a, right[a])
        return self.finish([s for s in symbols if s is not None])

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Piece made by each pair of symbols, -1 where there is none."""
        keys = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_made[at], -1)

    def in_lock_step(self, chunks: list[str]) -> list[list[int]]:
        """Short chunks together: each step makes the best merge of every chunk."""
        unknown: dict[str, int] = {}
        ids, first = self.ids, self.first_unknown
        lengths = np.array([len(c) for c in chunks])
        width = int(lengths.max())
        number = {c: ids.get(c, -1) for c in set("".join(chunks))}
        for c, i in number.items():
            if i < 0:
                number[c] = unknown.setdefault(c, first + len(unknown))
        sym = np.full((len(chunks), width + 1), -1, np.int32)
        inside = np.arange(width + 1) < lengths[:, None]
        flat = "".join(chunks)
        codes, place = np.unique(np.frombuffer(flat.encode("utf-32-le"), np.uint32), return_inverse=True)
        sym[inside] = np.array([number[chr(c)] for c in codes], np.int32)[place]
        no_rank = np.iinfo(np.int32).max
        made = np.full((len(chunks), width), -1, np.int32)
        both = inside[:, 1:]
        made[both] = self._pairs(sym[:, :-1][both], sym[:, 1:][both])
        rank = np.where(made >= 0, self.rank[made], no_rank)
        live = np.arange(len(chunks))
        out: list[list[int] | None] = [None] * len(chunks)
        names = {i: self.finish([c]) for c, i in unknown.items()}

        def put(rows: np.ndarray, where: np.ndarray) -> None:
            for row, values in zip(where.tolist(), rows.tolist()):
                if -1 in values:
                    values = values[: values.index(-1)]
                if names and max(values) >= first:
                    values = list(chain.from_iterable(names.get(v, (v,)) for v in values))
                out[row] = values

        while len(live):
            best = rank.argmin(axis=1)
            rows = np.arange(len(live))
            going = rank[rows, best] != no_rank
            if not going.all():
                put(sym[~going], live[~going])
                sym, made, rank, live, best = sym[going], made[going], rank[going], live[going], best[going]
                if not len(live):
                    break
                rows = np.arange(len(live))
            sym[rows, best] = made[rows, best]
            # Close the gap of the right symbol in all three arrays.
            columns = np.arange(width)
            after = columns > best[:, None]
            moved = np.where(after, np.minimum(columns + 1, width), columns)
            sym[:, :-1] = np.take_along_axis(sym, moved, axis=1)
            sym[:, -1] = -1
            last = np.minimum(moved, width - 1)
            made = np.take_along_axis(made, last, axis=1)
            rank = np.take_along_axis(rank, last, axis=1)
            made[:, -1], rank[:, -1] = -1, no_rank
            for at in (best - 1, best):
                ok = (at >= 0) & (sym[rows, at + 1] >= 0)
                r, c = rows[ok], at[ok]
                union = self._pairs(sym[r, c], sym[r, c + 1])
                made[r, c] = union
                rank[r, c] = np.where(union >= 0, self.rank[union], no_rank)
                r, c = rows[(at >= 0) & ~ok], at[(at >= 0) & ~ok]
                made[r, c], rank[r, c] = -1, no_rank
        return out

    def encode_chunks(self, chunks: list[str]) -> dict[str, list[int]]:
        done: dict[str, list[int]] = {}
        short = sorted((c for c in chunks if len(c) <= SHORT), key=len)
        for start in range(0, len(short), 4096):
            part = short[start : start + 4096]
            done.update(zip(part, self.in_lock_step(part)))
        done.update((c, self.by_agenda(c)) for c in chunks if len(c) > SHORT)
        return done


class Encoder:
    """Whole texts through the piece table, chunks kept between texts."""

    def __init__(self, model: bytes, checked: bool = True, share: int = 1):
        self.table = PieceTable(model)
        self.share = share
        self.forget()
        self.checked = checked
        # Digests of chunks the library agreed on, one per place; a chunk that lost its place is asked for again.
        self.agreed = np.zeros((1 << 21) // (1 << (share.bit_length() - 1)), np.int64)

    def forget(self) -> None:
        self.known = Remembered(KEPT_CHUNKS // self.share, KEPT_CHARACTERS // self.share)

    def _learn(self, chunks: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        found = self.table.encode_chunks(chunks)
        if self.checked:
            digests = np.fromiter(map(hash, chunks), np.int64, len(chunks))
            places = digests & (len(self.agreed) - 1)
            fresh = np.flatnonzero(self.agreed[places] != digests)
            self._check([chunks[i] for i in fresh.tolist()], found)
            self.agreed[places[fresh]] = digests[fresh]
        ids = [found[c] for c in chunks]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        yield chunks, np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths

    def _check(self, chunks: list[str], found: dict[str, list[int]]) -> None:
        """Chunks against the library.

        The library puts a space mark before a text; a chunk without one is asked for after
        a line break, which no piece joins to anything.
        """
        lib = self.table.library
        for marked in (True, False):
            own = [c for c in chunks if c.startswith(SPACE) == marked]
            if not own or not marked and self.table.chunks.fullmatch("\n\n"):
                continue
            plain = [(c[1:] if marked else "\n" + c).replace(SPACE, " ") for c in own]
            lead = 0 if marked else len(lib.encode("\n"))
            for c, p, ids in zip(own, plain, lib.encode(plain, num_threads=1)):
                if found[c] != ids[lead:] and lib.normalize(p) == (c if marked else f"{SPACE}\n{c}"):
                    raise AssertionError(f"library disagrees on {c!r}: {ids[lead:]}, not {found[c]}")

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, without end ids; number of ids of each)."""
        lib, table = self.table.library, self.table
        normal = [lib.normalize(t) if t else "" for t in texts]
        if not table.safe:
            found = [table.by_agenda(t) for t in normal]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts
        # Few chunks at a time, so that what one round adds stays far below the limit.
        flat, counts, start = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
        while start < len(normal):
            stop, size = start, 0
            while stop < len(normal) and (stop == start or size + len(normal[stop]) < 500_000):
                size += len(normal[stop])
                stop += 1
            split = [table.chunks.findall(t) for t in normal[start:stop]]
            ids, lengths = self.known.ids(list(chain.from_iterable(split)), self._learn)
            ends = np.cumsum([0, *map(len, split)])
            flat.append(ids)
            counts.append(np.diff(np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)))[ends]))
            start = stop
        return np.concatenate(flat), np.concatenate(counts)

    def with_end(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(ids of all texts with end ids, where each text starts and the last one ends, decoded texts)."""
        lib = self.table.library
        flat, counts = self.encode_all(texts)
        ids = np.insert(flat, np.cumsum(counts), lib.eos_id())
        starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts + 1)))
        listed = ids.tolist()
        bounds = starts.tolist()
        return ids, starts, [lib.decode(listed[s:e]) for s, e in zip(bounds, bounds[1:])]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(name: str, share: int = 1) -> Encoder:
    if (name, share) not in _ENCODERS:
        with open(SparkFiles.get(name), "rb") as f:
            _ENCODERS[name, share] = Encoder(f.read(), share=share)
    return _ENCODERS[name, share]


def _share_model(docs: DataFrame, model_path: str) -> str:
    """Send the model file (a fixed size) to every executor; its name there."""
    docs.sparkSession.sparkContext.addFile(model_path)
    return model_path.rsplit("/", 1)[-1]


def encode_texts(docs: DataFrame, model_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, ids (with end id), decoded text.

    Null text counts as empty: the end id alone, decoded to the empty text. Rows are
    independent: repeated rows and ids give repeated results, other columns are not looked
    at, an empty table gives an empty one. Texts of any length are encoded whole.
    """
    name = _share_model(docs, model_path)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, STAGE_SHARE)
        for batch in small_batches(batches, 1, STAGE_BATCH_BYTES):
            ids, starts, decoded = encoder.with_end([t or "" for t in batch.column(1).to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(decoded, pa.string())], names=[key, "ids", "decoded"])
        # As a stage between others: the worker is to be small again for what comes next.
        encoder.forget()

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, model_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``encode_texts`` as key, n_tokens, ids_sha256, decoded_sha256, without shipping the ids."""
    name = _share_model(docs, model_path)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name)
        # Every id as text with a blank after it: a text's ids are then one stretch of bytes.
        numbers = pa.array([f"{i} " for i in range(encoder.table.library.get_piece_size())])
        for batch in small_batches(batches, 1):
            ids, starts, decoded = encoder.with_end([t or "" for t in batch.column(1).to_pylist()])
            written = numbers.take(pa.array(ids, pa.int64()))
            data = memoryview(written.buffers()[2] or b"").cast("B")
            ends = np.frombuffer(written.buffers()[1], np.int32)[starts].tolist()
            ids_sha = [hashlib.sha256(data[s : e - 1]).hexdigest() for s, e in zip(ends, ends[1:])]
            decoded_sha = [hashlib.sha256(t.encode()).hexdigest() for t in decoded]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts), pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(key, text).mapInArrow(
        run, f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
