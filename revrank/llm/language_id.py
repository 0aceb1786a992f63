"""Language ID with bit-sliced Bloom filters of n-grams.

One Bloom filter per language, stored by slices: place ``b`` of the table holds, as a bit
mask, which languages have bit ``b`` set. Looking an n-gram up means ANDing the masks of its
few places, which gives all languages containing it at once. Counting the ones per language
over a text's n-grams, less what each filter's fill lets through by chance, decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revrank.llm.common import small_batches
from revrank.session import cut

UNKNOWN = "und"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 1 << 19


@lru_cache(maxsize=1)
def _normal_forms() -> np.ndarray:
    """Per code point: its lower-case letter, or a blank for what is not a letter."""
    forms = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            forms[c] = ord(low) if len(low) == 1 else c
    return forms


def letters(text: str) -> np.ndarray:
    """Lower-case letters as code points, every run of other characters one blank, blanks around."""
    codes = _normal_forms()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate(([np.uint32(32)], codes, [np.uint32(32)]))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep].astype(np.uint64)


def gram_hashes(codes: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    """64-bit hashes of all n-grams of the sizes that hold a letter."""
    found = []
    for n in sizes:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for i in range(n):
                h = (h ^ codes[i : len(codes) - n + 1 + i]) * MULTIPLIER
                h ^= h >> np.uint64(29)
            found.append(h)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


@dataclass
class LanguageFilters:
    """``planes[p, b]``: mask of languages 8p..8p+7 at place b. ``chance``: rate of false hits."""

    languages: list[str]
    planes: np.ndarray
    chance: np.ndarray
    sizes: tuple[int, ...]
    hashes: int

    def places(self, grams: np.ndarray) -> list[np.ndarray]:
        bits = np.uint64(self.planes.shape[1].bit_length() - 1)
        step = np.uint64(64) - bits
        return [(grams * np.uint64(2 * k + 1)) >> step if k else grams >> step for k in range(self.hashes)]

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Per language: how many of the n-grams its filter contains."""
        counts = np.zeros(8 * len(self.planes), np.int64)
        at = [p.astype(np.int64) for p in self.places(grams)]
        for p, plane in enumerate(self.planes):
            mask = plane[at[0]]
            for more in at[1:]:
                mask = mask & plane[more]
            seen = np.bincount(mask, minlength=256)
            ones = (np.arange(256)[:, None] >> np.arange(8)) & 1
            counts[8 * p : 8 * p + 8] = seen @ ones
        return counts[: len(self.languages)]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, evidence). ``evidence``: corrected share of n-grams the language has."""
        codes = letters(text or "")
        if len(codes) < 2 or not len(self.languages):
            return UNKNOWN, 0.0, 0.0
        total, n = np.zeros(len(self.languages), np.int64), 0
        longest = max(self.sizes)
        for start in range(0, len(codes), CHUNK):
            for size in self.sizes:
                # Every n-gram belongs to the chunk in which it starts.
                grams = gram_hashes(codes[start : start + CHUNK + size - 1], (size,))
                n += len(grams)
                total += self.hits(grams)
        if not n:
            return UNKNOWN if len(codes) < longest and not (codes != 32).any() else self.languages[0], 0.0, 0.0
        share = np.clip((total / n - self.chance) / (1 - self.chance), 0, 1)
        best = int(share.argmax())
        whole = float(share.sum())
        return self.languages[best], float(share[best]) / whole if whole > 0 else 0.0, float(share[best])


def training_sample(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, text): for each language the ``per_language`` documents of smallest id digest.

    Counts per language come first: only digests that can be among the smallest (a share of
    twice the wanted number) meet in the ranking, so it is as small for a language of any size.
    """
    keyed = docs.filter(F.col("lang").isNotNull()).select("doc_id", "lang", F.xxhash64("doc_id", F.lit(7)).alias("h"))
    sizes = cut(keyed.groupBy("lang").agg(F.count("*").alias("n")))
    share = F.shiftrightunsigned("h", 11) / float(1 << 53)
    few = keyed.join(sizes, "lang").filter(share * F.col("n") <= 2 * per_language + 100)
    first = Window.partitionBy("lang").orderBy(share, "doc_id")
    chosen = few.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= per_language)
    chosen = cut(chosen.select("doc_id", "lang").distinct())
    return docs.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"]).select("lang", "text")


def train_filters(
    docs: DataFrame,
    per_language: int = 1500,
    sizes: tuple[int, ...] = (3, 4),
    bits: int = 18,
    hashes: int = 2,
    grams_per_language: int = 12_000,
    ratio: float = 0.25,
) -> LanguageFilters:
    """Bloom filters from labelled documents (doc_id, lang, text).

    Fitted on at most ``per_language`` documents of each language. An n-gram enters a
    language's filter if it is among the language's ``grams_per_language`` most frequent ones
    and its share there is at least ``ratio`` times its largest share in any language, so text
    of other languages inside the documents does no harm. The driver gets the set places: at
    most 2^bits masks, whatever the corpus.
    """
    sample = training_sample(docs, per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_language: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    by_language.setdefault(lang, []).append(gram_hashes(letters(text), sizes))
            for lang, parts in by_language.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"],
                )

    counted = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = cut(counted)
    sizes_of = counted.groupBy("lang").agg(F.sum("n").alias("all"))
    languages = [r["lang"] for r in sizes_of.orderBy("lang").collect()]
    filters = LanguageFilters(languages, np.zeros((max(1, -(-len(languages) // 8)), 1 << bits), np.uint8), np.zeros(len(languages)), sizes, hashes)
    if not languages:
        return filters
    shares = counted.join(sizes_of, "lang").withColumn("share", F.col("n") / F.col("all"))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = shares.withColumn("r", F.row_number().over(most)).filter(F.col("r") <= grams_per_language)
    largest = shares.groupBy("gram").agg(F.max("share").alias("largest"))
    chosen = top.join(largest, "gram").filter(F.col("share") >= F.col("largest") * ratio).select("lang", "gram")
    number = {lang: i for i, lang in enumerate(languages)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            who = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            for at in filters.places(grams):
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(who)], names=["place", "who"])

    slices = chosen.mapInArrow(place, "place bigint, who bigint").distinct().toPandas()
    at, who = slices["place"].to_numpy(), slices["who"].to_numpy()
    for i in range(len(languages)):
        mine = at[who == i]
        filters.planes[i // 8, mine] |= np.uint8(1 << (i % 8))
        filters.chance[i] = min(0.99, (len(mine) / (1 << bits)) ** hashes)
    return filters


def identify(docs: DataFrame, filters: LanguageFilters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``lang_pred``, ``score`` (0 to 1), ``evidence`` (0 to 1).

    ``score`` is the share of the best language among the corrected popcounts, ``evidence``
    the corrected share of the text's n-grams that the language has. Null text and text
    without a letter: ``und``, 0, 0; so is everything if nothing was learned. A text whose
    n-grams are in no filter gets the first learned language with score 0. Ties go to the
    language first by name. Texts are read whole in chunks; rows are independent.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in small_batches(batches, 1):
            found = [own.predict(t) for t in batch.column(1).to_pylist()]
            langs, scores, evidence = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(evidence, pa.float64())],
                names=[key, "lang_pred", "score", "evidence"],
            )

    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, lang_pred string, score double, evidence double")


def held_out(doc_id: str = "doc_id"):
    """True for the third of the ids that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, filters: LanguageFilters, least_evidence: float = 0.15) -> DataFrame:
    """The rows of ``docs`` in a known language, unchanged.

    A row goes if its text has no letter or less than ``least_evidence`` of its n-grams are in
    the best language. Works on whole rows, so repeated and null ids are no matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in small_batches(batches, at):
            found = [own.predict(t) for t in batch.column(at).to_pylist()]
            keep = [lang != UNKNOWN and evidence >= least_evidence for lang, _, evidence in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
