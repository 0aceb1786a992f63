"""Personal data: patterns find protected entities, corpus co-occurrence finds what reveals them.

A term reveals an entity as far as knowing the term tells it: pointwise mutual information
over the entity's own information, log(p(t, e) / (p(t) p(e))) / -log p(e). It is 1 for a term
that never occurs without the entity near it. Terms above a threshold are generalised, above
a second one removed, wherever they occur. Copies of a text count once, and a pair only counts
if that many texts with both would hardly come together by chance.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.llm.common import bit_table, small_batches
from revrank.session import cut

KINDS = ("email", "ip", "card", "phone", "term")
TERM = len(KINDS) - 1
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start at the first digit of a run, so no other start is tried.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")
_NOT_DIGIT = re.compile(r"[^0-9]+")

BLOOM_BITS = 1 << 23
SEED = 42
KEPT_WORDS = 600_000
# A term counts for an entity within so many words (of 24 characters on average at most) on either side.
WINDOW = 32
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            last = domain.end()
            yield start, last
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches that pass their check, in that order."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _entity(text: str, span: tuple[int, int, int]) -> str:
    value = text[span[0] : span[2]]
    return f"{KINDS[span[1]]}:{value.lower() if span[1] == 0 else value if span[1] == 1 else _NOT_DIGIT.sub('', value)}"


def _near(text: str, spans: list[tuple[int, int, int]], window: int) -> list[tuple[str, str]]:
    """(entity, term) for the words near each entity, once per entity and term."""
    found: dict[tuple[str, str], None] = {}
    starts = [s for s, _, _ in spans]
    reached = list(accumulate((e for _, _, e in spans), max))
    for span in spans:
        start, end = span[0], span[2]
        left = list(_WORD.finditer(text, max(0, start - 24 * window), start))[-window:]
        right = list(_WORD.finditer(text, end, end + 24 * window))[:window]
        entity = _entity(text, span)
        for m in left + right:
            before = bisect_left(starts, m.end())
            if not before or reached[before - 1] <= m.start():
                found[entity, m.group().lower()] = None
    return list(found)


def find_entities(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, text_hash, base (spans), near (entity, term, context).

    The context is the digest of the whole text: copies of one text are one context, a phrase
    repeated in different texts is as many as there are texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    near_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("context", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            spans, near = [], []
            for text_hash, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = base_spans(text or "")
                spans.append([dict(zip(("start", "kind", "end"), s)) for s in found])
                near.append([{"entity": e, "term": t, "context": text_hash} for e, t in _near(text, found, window)] if found else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, span_type), pa.array(near, near_type)],
                names=["doc_id", "text_hash", "base", "near"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, text_hash bigint, base {SPAN}, near array<struct<entity:string,term:string,context:bigint>>",
    )


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_hash, term, places): where the words that may be ``terms`` occur.

    A Bloom filter of the terms lets some other words through; whoever joins the terms drops
    them. If there are very many terms it lets every word through, which is slow but right.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(terms.select(F.xxhash64("term")), BLOOM_BITS))
    kind = docs.schema["doc_id"].dataType.simpleString()
    place_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        known: set[str] = set()
        wanted: set[str] = set()

        def listed(word: str) -> bool:
            h = xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"), SEED)
            return all(table[p >> 3] >> (p & 7) & 1 for p in (h & (BLOOM_BITS - 1), h >> 32 & (BLOOM_BITS - 1)))

        for batch in small_batches(batches, 2):
            rows: list[tuple] = []
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = set(_WORD.findall(text or ""))
                new = words - known
                if new:
                    if len(known) + len(new) > KEPT_WORDS:
                        known, wanted, new = set(), set(), words
                    known |= new
                    wanted.update(w for w in new if listed(w))
                if not wanted.isdisjoint(words):
                    places: dict[str, list[dict[str, int]]] = {}
                    for m in _WORD.finditer(text):
                        if m.group() in wanted:
                            places.setdefault(m.group().lower(), []).append({"start": m.start(), "end": m.end()})
                    rows.extend((doc_id, text_hash, t, p) for t, p in places.items())
            ids, hashes, found, places = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column(0).type), pa.array(hashes, pa.int64()), pa.array(found, pa.string()), pa.array(places, place_type)],
                names=["doc_id", "text_hash", "term", "places"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(
        run, f"doc_id {kind}, text_hash bigint, term string, places array<struct<start:int,end:int>>"
    )


def revealing_terms(
    docs: DataFrame, found: DataFrame, generalise_at: float, remove_at: float, least_contexts: int, chance: float | None = None
) -> tuple[DataFrame, DataFrame]:
    """((term, disclosure, removed), places of those terms) from the whole corpus.

    All counts are of different texts. Only pairs in ``least_contexts`` of them count: a rare
    word next to one entity once would else look fully revealing. With ``chance``, the
    probability that some pair of the corpus gets there without a bond is at most that.
    """
    near = found.select(F.explode("near").alias("n")).select("n.entity", "n.term", "n.context")
    entities = near.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("e_docs"))
    pairs = near.distinct().groupBy("entity", "term").agg(F.count("*").alias("both"))
    n = float(max(1, found.select("text_hash").distinct().count()))
    tested = found.agg(F.sum(F.size("near"))).first()[0] or 0
    information = -F.log(F.col("e_docs") / n)

    def disclosure(t_docs: str):
        mutual = F.log(F.col("both") * n / (F.col(t_docs) * F.col("e_docs")))
        return F.when(information > 0, F.least(F.lit(1.0), mutual / information)).otherwise(0.0)

    def bonded():
        """Chernoff's bound of the term's texts that hold the entity, over all pairs looked at."""
        share, rate = F.least(F.lit(1.0), F.col("both") / F.col("t_docs")), F.col("e_docs") / n
        rest = F.when((share < 1) & (rate < 1), (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
        return F.col("t_docs") * (share * F.log(share / rate) + rest) >= math.log(max(1, tested) / chance)

    # A term occurs at least in the documents where it is near some entity: that bounds its
    # disclosure from above and rules common words out before their places are looked for.
    near_docs = near.select("term", "context").distinct().groupBy("term").agg(F.count("*").alias("n_docs"))
    known = pairs.filter(F.col("both") >= least_contexts).join(entities, "entity").join(near_docs, "term")
    pairs = cut(known.filter(disclosure("n_docs") >= generalise_at).select("entity", "term", "both", "e_docs"))
    places = cut(term_places(docs, pairs.select("term").distinct()))
    terms = places.select("term", "text_hash").distinct().groupBy("term").agg(F.count("*").alias("t_docs"))
    scored = pairs.join(terms, "term").withColumn("disclosure", disclosure("t_docs"))
    if chance is not None:
        scored = scored.filter(bonded())
    flagged = scored.groupBy("term").agg(F.max("disclosure").alias("disclosure")).filter(F.col("disclosure") >= generalise_at)
    return cut(flagged.withColumn("removed", F.col("disclosure") >= remove_at)), places


def revealing_spans(
    docs: DataFrame, found: DataFrame, generalise_at: float = 0.9, remove_at: float = 0.98, least_contexts: int = 2,
    chance: float = 0.01,
) -> DataFrame:
    """(doc_id, text_hash, terms): spans of revealing terms, ``kind`` -1 for those to remove."""
    flagged, places = revealing_terms(docs, found, generalise_at, remove_at, least_contexts, chance)
    hits = places.join(flagged.select("term", "removed"), "term").dropDuplicates(["doc_id", "text_hash", "term"])
    spans = hits.select("doc_id", "text_hash", "removed", F.explode("places").alias("p"))
    span = F.struct(
        F.col("p.start").alias("start"), F.when(F.col("removed"), -1).otherwise(TERM).alias("kind"), F.col("p.end").alias("end")
    )
    return cut(spans.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(span)).alias("terms")))


def scan_pii(docs: DataFrame, **thresholds) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base and terms (span arrays).

    ``base`` holds the pattern matches, ``terms`` the spans the corpus adds, outside of base
    spans. Null text counts as empty and has no spans. Rows with equal id and text get equal
    spans; null ids are rows like others. Extra columns are not looked at; an empty table
    gives an empty one. Texts are read whole. Spans are code points, end exclusive.
    Words within ``WINDOW`` words of an entity are looked at. Those of an entity in a single
    text are no evidence, as every rare word of it would be.
    """
    found = cut(find_entities(docs))
    terms = revealing_spans(docs, found, **thresholds).withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    rows = found.drop("near").join(terms, same, "left").drop("__id", "__hash")
    free = F.filter(
        "terms", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    rows = rows.withColumn("terms", F.coalesce(free, F.array().cast(SPAN)))

    def count(kind: int):
        return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(TERM)]
    return rows.select("doc_id", *counts, "base", "terms")


def span_text(spans):
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def one(s):
        kind = F.when(s["kind"] < 0, TERM).otherwise(s["kind"])
        return F.concat_ws(":", F.element_at(names, kind + 1), s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def _rewritten(text: str, base: list[tuple[int, int, int]], terms: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    taken = sorted(base + [t for t in terms if not any(s < t[2] and t[0] < e for s, _, e in base)])
    for start, kind, end in taken:
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start])
            out.append("" if kind < 0 else f"[{KINDS[kind].upper()}]")
        at = end
    out.append(text[at:])
    return "".join(out)


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """``docs`` with entities and generalised terms replaced by their kind, removed terms gone.

    Every row stays; ``text`` and ``n_chars`` change where something was found. Pattern
    matches are found again in the pass that rewrites, so only term spans are joined.
    """
    found = cut(find_entities(docs))
    terms = revealing_spans(docs, found, **thresholds)
    spans = terms.withColumnsRenamed({"doc_id": "__id", "text_hash": "__thash", "terms": "__terms"})
    keyed = docs.withColumn("__hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__thash"))
    joined = keyed.join(spans, same, "left").select(*[F.col(f"`{c}`") for c in docs.columns], "__terms")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, at):
            texts = []
            for text, terms in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if text:
                    base = base_spans(text)
                    if base or terms:
                        text = _rewritten(text, base, [(t["start"], t["kind"], t["end"]) for t in terms or ()])
                texts.append(text)
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    clean = joined.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return clean
