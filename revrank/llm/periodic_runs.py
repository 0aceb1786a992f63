"""Periodic runs of words: recursive frequency splitting, then lag scans of what survives.

A run is a maximal stretch of words with smallest period q that is at least
max(6, 4 * q) words long, so each of its words occurs four times in it at least. Words that
occur less often in a segment can be in none of its runs and split it; the parts are counted
anew, until nothing splits. What is left, the segments of all texts of a batch, is scanned
lag by lag: at every q-th place four equally spaced words must agree, which costs n / q looks
for lag q, and only there the stretch is followed to both ends.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.llm.common import WORD, small_batches

LEAST_LENGTH = 6
LEAST_PERIODS = 4
# Looks per step of a scan.
LOOKS = 1 << 16

_WORD = re.compile(WORD)


def surviving_segments(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, segment number of each place) of the words that frequency splitting leaves.

    ``words``: word numbers of all texts in a row; ``owner``: the text of each, ascending.
    """
    places, segment = np.arange(len(words)), owner.astype(np.int64)
    while len(places):
        width = int(words.max()) + 1
        _, back, n = np.unique(segment * width + words[places], return_inverse=True, return_counts=True)
        keep = n[back] >= LEAST_PERIODS
        # A new segment starts after every gap and wherever the old segment changes.
        kept = places[keep]
        old = segment[keep]
        first = np.ones(len(kept), bool)
        first[1:] = (np.diff(kept) > 1) | (np.diff(old) > 0)
        number = np.cumsum(first) - 1
        long = np.bincount(number)[number] >= LEAST_LENGTH if len(kept) else np.zeros(0, bool)
        if len(kept) == len(places) and long.all():
            return places, segment
        places, segment = kept[long], number[long]
    return places, segment


def _grow(x: np.ndarray, lag: int, at: int, step: int) -> int:
    """How many places from ``at`` on in direction ``step`` agree with those ``lag`` further."""
    n, size = 0, 64
    while True:
        if step > 0:
            stop = min(at + n + size, len(x) - lag)
            same = x[at + n : stop] == x[at + n + lag : stop + lag]
        else:
            stop = max(at - n - size + 1, 0)
            same = (x[stop : at - n + 1] == x[stop + lag : at - n + 1 + lag])[::-1]
        if not len(same):
            return n
        wrong = int(np.argmin(same))
        if not same[wrong]:
            return n + wrong
        n += len(same)
        size *= 4


def lag_scan(x: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in ``x``: segments of ``lengths``, no word in two of them.

    Lags go up, so a stretch with a smaller period is found under that one first and known
    by its ends later on. Segments shorter than four lags are left out as the lags grow.
    """
    runs: dict[tuple[int, int], int] = {}
    # Runs that may hold stretches of the current lag, by place in ``x``.
    wide: list[tuple[int, int, int]] = []
    top = int(lengths.max()) // LEAST_PERIODS if len(lengths) else 0
    place, y, lag = np.arange(len(x)), x, 1
    while lag <= top:
        fits = lengths >= LEAST_PERIODS * lag
        if lengths[fits].sum() < 0.7 * len(y):
            place = np.flatnonzero(np.repeat(fits, lengths))
            y = x[place]
        size = len(y)
        lags = np.arange(lag, min(top, lag + LOOKS * lag // size) + 1)
        at = np.arange(-(-size // lag))[None, :] * lags[:, None]
        row, column = np.nonzero(at + 3 * lags[:, None] < size)
        at, q = at[row, column], lags[row]
        for times in (1, 2, 3):
            same = y[at] == y[at + times * q]
            at, q = at[same], q[same]
        wide = [w for w in wide if w[1] - w[0] >= 2 * lag]
        for own in np.unique(q).tolist():
            # Stretches inside a run whose period divides the lag are that run's.
            looks = place[at[q == own]]
            for start, end, period in wide:
                if own % period == 0:
                    looks = looks[(looks < start) | (looks + 2 * own > end)]
            done = -1
            for look in np.searchsorted(place, looks).tolist():
                if look < done:
                    continue
                right = _grow(y, own, look, 1)
                left = _grow(y, own, look - 1, -1) if look else 0
                done = look + right
                start, length = int(place[look - left]), left + right + own
                if length >= max(LEAST_LENGTH, LEAST_PERIODS * own) and (start, length) not in runs:
                    runs[start, length] = own
                    wide.append((start, start + length, own))
        lag = int(lags[-1]) + 1
    return [(start, length, period) for (start, length), period in runs.items()]


def find_runs(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """Per text (its words): its runs (start, length, period), by start, then period."""
    numbers: dict[str, int] = {}
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(texts)), np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    places, segment = surviving_segments(words, owner)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(places):
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        lengths = np.diff(first, append=len(places))
        number = np.repeat(np.arange(len(first)), lengths)
        _, own = np.unique(number * len(numbers) + words[places], return_inverse=True)
        begins = np.cumsum(sizes) - sizes
        for start, length, period in lag_scan(own, lengths):
            at = int(places[start])
            text = int(owner[at])
            found[text].append((at - int(begins[text]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that some run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(
    docs: DataFrame, text: str = "text", key: str = "doc_id", rewrite: Callable[[object, list[str]], list[str]] | None = None
) -> DataFrame:
    """Per row of ``docs``: key, n_words, runs (array of start, length, period), collapsed.

    Words are what stands between ASCII white space, numbered from 0. ``collapsed``: the words
    that no run contains after its first period, joined by one space. ``rewrite`` may change
    the words of a row (key, words) before the scan. Null and empty text, and text of white
    space only: no words, no runs, the empty string. Rows are independent, so repeated rows
    and keys, null keys and an empty table are no matter; other columns are not looked at.
    Texts are scanned whole, of any length.
    """
    kind = docs.schema[key].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            texts = [_WORD.findall(t or "") for t in batch.column(1).to_pylist()]
            if rewrite is not None:
                texts = [rewrite(k, words) for k, words in zip(batch.column(0).to_pylist(), texts)]
            found = find_runs(texts)
            names = ("start", "length", "period")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(map(len, texts), pa.int64()),
                    pa.array([[dict(zip(names, r)) for r in runs] for runs in found], run_type),
                    pa.array([" ".join(collapse(w, r)) for w, r in zip(texts, found)], pa.string()),
                ],
                names=[key, "n_words", "runs", "collapsed"],
            )

    columns = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, {columns}")


def longest(runs: str) -> Column:
    """The longest run, of equals that with the smallest start, then period; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.struct((-best["s"]).alias("start"), best["l"].alias("length"), (-best["p"]).alias("period"))


def repeated_tail(doc_id: object, words: list[str]) -> list[str]:
    """For one id in ten, by crc32: from some word on the text goes on periodically."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * -(-(n - a) // len(period)))[: n - a]
