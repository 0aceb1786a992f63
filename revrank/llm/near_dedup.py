"""Near-duplicate classes: MinHash bands for candidates, sketches to sift them, exact sets to confirm.

Documents with equal shingle sets are one class and go on as their smallest id, so thousands
of copies cost one row. Classes meet in band buckets. A bucket's pairs are never listed:
first every class is paired with random pivots of its buckets, of which its odd sketch picks
the most alike; only between parts of a bucket that these links left apart, the remaining
pairs are looked at, again through their sketches and a parity map of the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.llm.common import bit_table, maybe_in, small_batches
from revrank.session import cut

SAMPLES = 240
BAND_ROWS = 6
# The odd sketches of classes that share a bucket: samples folded into so many bits.
SKETCH_SAMPLES = 2048
SKETCH_BITS = 4096
# 4.5 standard deviations of the estimate at a similarity of 0.8.
MARGIN = 0.05
CHUNK = 1 << 20
# So many pivots, at most, a class meets in its buckets with one group of near copies.
PIVOT_ORDERS = 20

_rng = np.random.default_rng(20240607)
_BYTES = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_BANDS = [_rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) for _ in range(2)]
_ODD = [_rng.integers(0, 1 << 32, SKETCH_SAMPLES, dtype=np.uint32) for _ in range(2)]
_PLACE = _rng.integers(0, 1 << 64, SKETCH_SAMPLES, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(0, 1 << 64, (SAMPLES // BAND_ROWS, BAND_ROWS), dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x5851F42D4C957F2D
    up, down = np.full(n, base, np.uint64), np.full(n, _inverse(base), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _word_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(1 << max(12, int(len(raw)).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up[: len(raw)], dtype=np.uint64)))
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word: A-Z lower-cased, words between ASCII white space."""
    data = text.encode("utf-8", "surrogatepass").lower()
    if len(data) <= CHUNK:
        return _word_hashes(data) if data else np.zeros(0, np.uint64)
    parts, start = [], 0
    while start < len(data):
        stop = start + CHUNK
        while stop < len(data) and not _SPACE[data[stop]]:
            stop += 1
        parts.append(_word_hashes(data[start:stop]))
        start = stop
    return np.concatenate(parts)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all ``words``-word shingles; fewer words: the whole sequence."""
    hashes = word_hashes(text or "")
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    found = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        found = _mix(found * _STEP + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(found)


def min_hashes(shingles: np.ndarray, functions: list[np.ndarray]) -> np.ndarray:
    factor, shift = functions[0] | np.uint32(1), functions[1]
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(shift), 0xFFFFFFFF, np.uint32)
    step = (1 << 16) // len(shift)
    for start in range(0, len(short), step):
        least = np.minimum(least, (short[start : start + step, None] * factor + shift).min(axis=0))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    return _mix((_mix(least.astype(np.uint64).reshape(-1, BAND_ROWS) + np.uint64(1)) * _BAND).sum(axis=1, dtype=np.uint64)).view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples: each one flips the bit its value hashes to."""
    at = (_mix(least.astype(np.uint64) + np.uint64(1)) * _PLACE) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1).view(np.int64)


def parity_map(shingles: np.ndarray) -> np.ndarray:
    """Every shingle flips one bit. Two maps differ in no more bits than their sets in shingles."""
    at = _mix(shingles * _STEP) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1).view(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, two digests of the set, band keys."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            n, one, two, bands = [], [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, words)
                n.append(len(s))
                one.append(int(_mix(s * _STEP).sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0)
                two.append(int(np.bitwise_xor.reduce(_mix(s + _STEP)).astype(np.int64)) if len(s) else 0)
                bands.append(band_keys(min_hashes(s, _BANDS)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "one", "two", "bands"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, text_hash bigint, n_shingles bigint, one bigint, two bigint, bands array<bigint>",
    )


def _row_key(doc_id: str = "doc_id", text_hash: str = "text_hash") -> Column:
    return F.xxhash64(doc_id, text_hash)


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, n_shingles, shingles, odd, parity) of the rows ``wanted`` (doc_id, text_hash): sets for confirming, the rest for sifting.

    Texts are not shuffled: a bit table of fixed size picks the rows in the scan, and the join
    that drops those it let through by chance sees sets only.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(wanted.select(_row_key())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        picked = (b.filter(pa.array(maybe_in(shared.value, b.column(2).to_numpy()))) for b in batches)
        for batch in small_batches(picked, 3):
            sets = [shingle_set(t, words) for t in batch.column(3).to_pylist()]
            odd = [odd_sketch(min_hashes(s, _ODD)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], longs), pa.array(odd, longs),
                 pa.array([parity_map(s) for s in sets], longs)],
                names=["doc_id", "text_hash", "n_shingles", "shingles", "odd", "parity"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").select("doc_id", "text_hash", _row_key().alias("key"), "text")
    made = rows.mapInArrow(
        run, f"doc_id {kind}, text_hash bigint, n_shingles bigint, shingles array<bigint>, odd array<bigint>, parity array<bigint>"
    )
    made = made.join(wanted, ["doc_id", "text_hash"]).dropDuplicates(["doc_id"])
    return made.select(F.col("doc_id").alias("rep"), "n_shingles", "shingles", "odd", "parity")


def flipped(a: str, b: str) -> Column:
    """Ones in the XOR of two odd sketches."""
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_BITS // 64)])


def most_flips(similarity: float) -> int:
    """Largest XOR count whose estimate 1 + n / (4k) ln(1 - 2x / n) is within the margin."""
    n = SKETCH_BITS
    return int(n / 2 * (1 - np.exp((similarity - MARGIN - 1) * 4 * SKETCH_SAMPLES / n)))


def cut_slim(df: DataFrame) -> DataFrame:
    """``cut`` of a table of a few numbers per row, in two tasks per core: not one small file per partition."""
    return cut(df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism))


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component): the smallest id reachable over ``links`` (a, b).

    Every round passes the smallest label to all neighbours and then follows labels once
    (pointer jumping). All tables stay distributed; each round is written.
    """
    both = cut_slim(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_slim(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("doc_id"), F.least("a", "low").alias("component")))
    while True:
        near = both.join(labels, F.col("b") == F.col("doc_id")).groupBy("a").agg(F.min("component").alias("low"))
        lower = labels.join(near, F.col("doc_id") == F.col("a")).select(
            "doc_id", F.col("component").alias("before"), F.least("component", "low").alias("component")
        )
        lower = cut_slim(lower)
        up = lower.select(F.col("doc_id").alias("up"), F.col("component").alias("up_component"))
        jumped = lower.join(up, F.col("component") == F.col("up")).select("doc_id", "before", F.col("up_component").alias("component"))
        jumped = cut_slim(jumped)
        labels = jumped.select("doc_id", "component")
        if not jumped.filter(F.col("before") != F.col("component")).limit(1).count():
            return labels


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact sets are at least ``similarity`` alike (in hundredths)."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    joined = pairs.join(left, "a").join(right, "b")
    return joined.filter(both * 100 >= union * round(similarity * 100)).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, best: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_shingles, component_id, kept.

    Rows are linked where their shingle sets are at least ``similarity`` alike (Jaccard);
    ``component_id`` is the smallest id reachable. With 40 bands of 6 samples a pair at 0.8
    misses all buckets with probability 5e-6, and each link found is checked on full sets.

    Null or empty text, or only white space: no shingles, linked with nothing, kept. Null
    ids: linked with nothing, component null, kept. Repeated rows are equal sets and so one
    class; rows that share an id but not a text are treated as linked. Extra columns are not
    looked at. Texts of any length are read whole. An empty table gives an empty one.
    """
    rows = cut(sketches(docs, words))
    # cut() reads back what it wrote: the class table is one row per distinct set.
    useful = rows.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    digest = ["n_shingles", "one", "two"]
    classes = cut_slim(
        useful.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    )
    # A repeated id with two texts represents the class whose digest it is, so join on both.
    reps = cut(
        useful.join(classes, digest).filter(F.col("doc_id") == F.col("rep"))
        .dropDuplicates(["doc_id", *digest]).select("rep", "bands")
    )
    members = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    # Fewer orders than bands: the buckets of one group of near copies share pivots.
    order = F.struct(F.xxhash64("rep", F.col("band") % PIVOT_ORDERS), F.col("rep"))
    buckets = cut_slim(
        members.groupBy("key").agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .filter(F.col("n") > 1).select("key", F.col("first.rep").alias("pivot"))
    )
    # Only classes that share a bucket go on.
    shared = cut_slim(members.drop("band").join(buckets, "key"))
    meeting = shared.select("rep").distinct()
    chosen = useful.join(meeting, F.col("doc_id") == F.col("rep")).select("doc_id", "text_hash").distinct()
    sets = cut(shingle_sets(docs, cut_slim(chosen), words))

    limit = most_flips(similarity)
    least = round(similarity * 100)
    in_reach = (F.col("na") * 100 >= F.col("nb") * least) & (F.col("nb") * 100 >= F.col("na") * least)

    def side(name: str) -> DataFrame:
        return sets.select(F.col("rep").alias(name), F.col("n_shingles").alias(f"n{name}"), F.col("odd").alias(f"o{name}"))

    def nearest(pairs: DataFrame) -> DataFrame:
        """For every a the ``best`` of its pairs by sketch, confirmed. An a has a few pivots per band."""
        sifted = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("flips", flipped("oa", "ob"))
        sifted = sifted.filter(in_reach & (F.col("flips") <= limit)).select("a", F.struct("flips", "b").alias("p"))
        top = sifted.groupBy("a").agg(F.slice(F.array_sort(F.collect_list("p")), 1, best).alias("best"))
        return cut_slim(confirmed(cut_slim(top.select("a", F.explode("best.b").alias("b"))), sets, similarity))

    def apart(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows (key, rep, component, largest) of buckets that hold several components; rows outside the largest."""
        named = shared.select("key", "rep").join(labels, F.col("rep") == F.col("doc_id"), "left")
        named = cut_slim(named.select("key", "rep", F.coalesce("component", "rep").alias("component")))
        parts = named.groupBy("key", "component").agg(F.count("*").alias("n"))
        split = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"))
        split = cut_slim(split.filter(F.col("parts") > 1).select("key", F.col("top.component").alias("largest")))
        rows = cut_slim(named.join(split, "key"))
        return rows, rows.filter(F.col("component") != F.col("largest"))

    pairs = shared.filter(F.col("rep") != F.col("pivot")).select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    links = nearest(cut_slim(pairs.distinct()))
    labels = components(links)

    # Who is left outside of a bucket's largest component meets more pivots from inside it.
    rows_apart, outside = apart(labels)
    pivots = rows_apart.filter(F.col("component") == F.col("largest")).groupBy("key").agg(
        F.array(*[F.min(F.struct(F.xxhash64("rep", "key", F.lit(i)), F.col("rep"))) for i in range(4)]).alias("p")
    )
    pivots = cut_slim(pivots.select("key", F.explode(F.array_distinct("p.rep")).alias("b")))
    again = cut_slim(outside.select("key", F.col("rep").alias("a")).join(pivots, "key").select("a", "b").distinct())
    links = cut_slim(links.union(nearest(again)))
    labels = components(links)

    # Who is left now is compared with all others of its buckets, through the sketches. Parity maps let
    # through hardly more than true links, so the pairs just below ``similarity`` are not listed.
    rows_apart, outside = apart(labels)
    may_link = flipped("pa", "pb") * (100 + least) <= (F.col("na") + F.col("nb")) * (100 - least)

    def banded(name: str) -> DataFrame:
        maps = sets.select(F.col("rep").alias(name), F.col("n_shingles").alias(f"n{name}"), F.col("odd").alias(f"o{name}"), F.col("parity").alias(f"p{name}"))
        return maps.join(reps.select(F.col("rep").alias(name), F.col("bands").alias(f"k{name}")), name)

    left = outside.select("key", F.col("component").alias("ca"), F.col("rep").alias("a")).join(banded("a"), "a")
    right = rows_apart.select(
        "key", F.col("component").alias("cb"), F.col("rep").alias("b"), (F.col("component") == F.col("largest")).alias("big")
    ).join(banded("b"), "b")
    # A pair comes out of the first bucket it shares only.
    first_shared = F.element_at("ka", F.array_position(F.zip_with("ka", "kb", lambda x, y: x == y), True).cast("int"))
    across = cut(left).join(cut(right), "key").filter(
        (F.col("ca") != F.col("cb")) & (F.col("big") | (F.col("a") < F.col("b"))) & in_reach & may_link
        & (flipped("oa", "ob") <= limit) & (first_shared == F.col("key"))
    )
    more = confirmed(cut_slim(across.select("a", "b")), sets, similarity)
    all_links = cut_slim(links.union(more))
    labels = components(all_links)

    # Back to rows: classes that are more than one document.
    named_classes = classes.join(labels, F.col("rep") == F.col("doc_id"), "left").filter(
        (F.col("copies") > 1) | F.col("component").isNotNull()
    )
    named_classes = cut_slim(named_classes.select(*digest, F.coalesce("component", "rep").alias("component_id")))
    result = rows.select("doc_id", "text_hash", *digest).join(named_classes, digest, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    result = result.withColumn("component_id", component)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return result.select("doc_id", "text_hash", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates: that with the smallest id.

    Of rows equal in id and text one stays; rows with a null id all stay.
    """
    found = near_duplicates(docs, words, similarity)
    gone = cut_slim(found.filter(~F.col("kept")).select("doc_id", F.col("text_hash").alias("__hash")).distinct())
    twice = found.filter(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").select("doc_id")
    twice = cut_slim(twice)
    keyed = docs.withColumn("__hash", F.xxhash64("text")).withColumn("__key", _row_key("doc_id", "__hash"))
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(gone.select(_row_key("doc_id", "__hash"))))
    at = len(keyed.columns) - 1

    def picked(hit: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(maybe_in(shared.value, batch.column(at).to_numpy()) == hit))

        return keyed.mapInArrow(run, keyed.schema)

    # Only rows that may go are joined, so most texts are not shuffled.
    rest = picked(False).unionByName(picked(True).join(gone, ["doc_id", "__hash"], "left_anti").select(*keyed.columns))
    if twice.isEmpty():
        return rest.select(*docs.columns)
    once = rest.join(twice, "doc_id", "left_anti")
    again = rest.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "__hash"])
    return once.unionByName(again).select(*docs.columns)
