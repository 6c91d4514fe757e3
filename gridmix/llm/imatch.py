"""I-Match fingerprints with randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band.  A text keeps its terms of the
lexicon, distinct and sorted.  Each of several random subsets of the lexicon keeps a share of them and gives one hash of what it
keeps.  Shares fall from one in 2 to one in 4096 terms, so any text has subsets that keep few of its terms.  The
likeness of two fingerprints is the share of equal hashes among the thinnest subsets that keep something of either.

Frequencies count rows, so the terms of a text with very many copies or near copies are above the band.  A fingerprint
therefore has the same subsets a second time, over all terms of the text.  These are compared where the lexicon says too
little of either text: less than one in ``FEW`` of its terms.

The band's upper end is a document frequency of N / ``RARE`` at least.  A document has a bounded
number of distinct terms (D on average), so the band holds D * ``RARE`` terms at most, however many documents
there are.  That list goes to every task; its size is checked, and beyond ``LEXICON_BYTES`` the run stops.

Every text is compared with the next one by descending id and with itself, its last third replaced by the next
one's beginning.  Rows are dealt out by ranges of ids and sorted there.  The first row of each range also goes to the
range before it, so every row finds its next one in its own task; texts are moved once.

Ranges are of ids, so rows that share an id lie in one range, however many they are.

Defined results: a null text is empty; equal ids are ordered by text, nulls last of all; a single row is its
own next one; a text with too few terms in the lexicon has a fingerprint over all its terms only; where no subset keeps a
term of either text, they are alike if their terms are the same; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.llm import common

#: The band of document frequencies: from N / RARE to N / COMMON.
COMMON, RARE = 10, 2000
#: Fewest documents that make a term, in tables so small that N / RARE is below.
LEAST = 2
#: Subset j keeps one term in 2 ** LEVELS[j].
LEVELS = tuple(1 + j // 8 for j in range(96))
#: Likeness looks at the thinnest subsets that keep something, this many at least.
TOLD = 16
#: The lexicon tells of a text if it holds one in FEW of its terms at least.
FEW = 4
#: Terms outside the lexicon whose subsets a task remembers, and terms of a text that are looked at together (products of
#: so few stay in one thread).
REMEMBERED = 1 << 14
TOGETHER = 1 << 10
SEED = 7
LEXICON_BYTES = 64 << 20
NOTHING = "-"


def _lower(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def terms(text: str) -> set[bytes]:
    return set(_lower(text).split())


def _hash(data: bytes, seed: int = SEED) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data, seed)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with the number of texts that hold them, summed over the task as far as memory is bounded."""
    from collections import Counter

    def out(n):
        return pa.RecordBatch.from_pydict({"term": pa.array(list(n.keys()), pa.binary()),
                                           "df": pa.array(list(n.values()), pa.int64())})

    n: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            n.update(terms(text))
        if len(n) > 500_000:
            yield out(n)
            n = Counter()
    yield out(n)


def lexicon(docs: DataFrame) -> list[bytes]:
    """Sorted terms of the band.  Their number is bounded by the band (see above), and checked."""
    n = docs.count()
    low, high = max(LEAST, n / RARE), n / COMMON
    counted = (docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_frequencies, "term binary, df long")
               .groupBy("term").agg(F.sum("df").alias("df")))
    band = common.materialize(counted.filter(F.col("df").between(low, high)).select("term"), "lexicon")
    size = band.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    if size > LEXICON_BYTES:
        raise ValueError(f"the lexicon takes {size} bytes; narrow the band (RARE) to stay under {LEXICON_BYTES}")
    return sorted(r.term for r in band.collect())


def _seed(j: int) -> np.uint64:
    return np.uint64(_hash(str(j).encode()))


def _mixed(x: np.ndarray, seed: np.uint64 | np.ndarray) -> np.ndarray:
    x = (x ^ seed) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Fingerprinter:
    """Fingerprints of texts over a lexicon, its terms in order."""

    def __init__(self, words: list[bytes], levels: tuple[int, ...] = LEVELS):
        self.size = len(words)
        self.number = {w: i for i, w in enumerate(words)}
        self.place = dict(self.number)  # rows of all terms at hand: the lexicon's, then remembered others
        self.hashes = np.zeros(len(words) + REMEMBERED, np.uint64)
        self.keeps = np.zeros((len(self.hashes), len(levels)), bool)
        self.seeds = np.array([_seed(j) for j in range(len(levels))], np.uint64)
        self.masks = np.array([(1 << level) - 1 for level in levels], np.uint64)
        for at in range(0, len(words), TOGETHER):
            self._put(at, words[at:at + TOGETHER])

    def _put(self, at: int, words: list[bytes]) -> None:
        from xxhash import xxh64_intdigest

        hashes = np.array([xxh64_intdigest(w, SEED) for w in words], np.uint64)
        self.hashes[at:at + len(words)] = hashes
        self.keeps[at:at + len(words)] = _mixed(hashes[:, None], self.seeds) & self.masks == 0

    def _rows(self, some: list[bytes]) -> np.ndarray:
        """Rows of terms, TOGETHER at most; those of neither the lexicon nor memory are put there."""
        rows = self._places(some)
        new = np.flatnonzero(rows < 0)
        if len(new):
            if len(self.place) + len(new) > len(self.hashes):
                self.place = dict(self.number)
                rows = self._places(some)
                new = np.flatnonzero(rows < 0)
            words, at = [some[i] for i in new.tolist()], len(self.place)
            self._put(at, words)
            self.place.update(zip(words, range(at, at + len(words))))
            rows[new] = np.arange(at, at + len(words))
        return rows

    def _places(self, some: list[bytes]) -> np.ndarray:
        """Rows of terms, -1 for those not at hand."""
        return np.fromiter(map(self.place.get, some, repeat(-1)), np.int64, len(some))

    def __call__(self, text: str) -> list[str]:
        """Hashes of the lexicon's subsets, of the same subsets over all terms, and one hash of all terms.

        NOTHING where a subset keeps no term, and for all of the lexicon's where that holds too few of the terms.
        """
        return self.of(self.sums(terms(text)))

    def of(self, told: "Sums") -> list[str]:
        """The fingerprint of the terms that were summed."""
        from xxhash import xxh64_hexdigest

        kept = np.sort(told.lexicon)  # in the terms' order
        out = [NOTHING] * len(self.seeds)
        if len(kept) * FEW >= told.n:
            keeps = np.ascontiguousarray(self.keeps[kept].T)
            data = np.broadcast_to(self.hashes[kept], keeps.shape)[keeps].tobytes()  # subset by subset, each in the terms' order
            start = 0
            for j, n in enumerate(np.count_nonzero(keeps, axis=1).tolist()):
                if n:
                    out[j] = xxh64_hexdigest(data[start:start + 8 * n], SEED)[8:]
                    start += 8 * n
        whole = (told.sums[0] % (1 << 32)).astype(">u4").tobytes().hex()
        return (out + [whole[8 * j:8 * j + 8] if n else NOTHING for j, n in enumerate(told.sums[1].tolist())]
                + [f"{int(told.every):016x}"])

    def sums(self, of: set[bytes]) -> "Sums":
        of = list(of)
        sums, every, lexicon = np.zeros((2, len(self.seeds))), np.uint64(0), []
        for at in range(0, len(of), TOGETHER):
            rows = self._rows(of[at:at + TOGETHER])
            hashes = self.hashes[rows]
            # lower halves: their sums stay below 2 ** 53, so they are exact
            both = np.ones((2, len(rows)))
            both[0] = hashes & np.uint64(0xFFFFFFFF)
            sums += both @ self.keeps[rows]
            sums[0] %= 1 << 32
            every = np.add(every, hashes.sum(dtype=np.uint64), dtype=np.uint64)
            lexicon.append(rows[rows < self.size])
        return Sums(len(of), sums, every, np.concatenate(lexicon) if lexicon else np.zeros(0, np.int64))

    def prepare(self, text: str) -> "Prepared":
        """The fingerprint of a text, with what its edited text shares: terms that end before the last third begins."""
        cut = len(text) - len(text) // 3
        head = _lower(text[:cut])
        words = head.split()
        begun = b"" if not words or head[-1:].isspace() else words.pop()
        stay = set(words)
        shared = self.sums(stay)
        own = Prepared(text, stay, begun, shared, [])
        return own._replace(fingerprint=self._ending(own, text[cut:]))

    def _ending(self, own: "Prepared", tail: str) -> list[str]:
        """The fingerprint of a text's beginning with another last third: only that is split again."""
        return self.of(own.shared + self.sums(set((own.begun + _lower(tail)).split()) - own.stay))

    def edited(self, own: "Prepared", following: str) -> tuple[str, list[str]]:
        """The edited text and its fingerprint."""
        third = len(own.text) // 3
        return own.text[:len(own.text) - third] + following[:third], self._ending(own, following[:third])


class Sums(NamedTuple):
    """Of a set of terms: their number, per subset the sum of its terms' hashes and their number, the sum of all hashes, and the rows of
    those in the lexicon.  None depends on an order, and those of disjoint sets add up."""

    n: int
    sums: np.ndarray
    every: np.uint64
    lexicon: np.ndarray

    def __add__(self, other: "Sums") -> "Sums":
        return Sums(self.n + other.n, self.sums + other.sums, np.add(self.every, other.every, dtype=np.uint64),
                    np.concatenate([self.lexicon, other.lexicon]))


class Prepared(NamedTuple):
    text: str
    stay: set[bytes]
    #: The word that the beginning ends in the middle of, if any.
    begun: bytes
    shared: Sums
    fingerprint: list[str]


def likeness(a: list[str], b: list[str]) -> float:
    """Share of equal hashes among the thinnest TOLD (or more, to the end of a level) subsets that tell something.

    The lexicon's subsets, or those over all terms where the lexicon tells nothing of one of the texts.
    """
    n = len(a) // 2
    own = slice(0, n)
    if a[own].count(NOTHING) == n or b[own].count(NOTHING) == n:
        own = slice(n, 2 * n)
    told = [(level, x == y) for level, x, y in zip(LEVELS, a[own], b[own]) if x != NOTHING or y != NOTHING]
    told.sort(key=lambda t: -t[0])
    if len(told) > TOLD:
        told = [t for t in told if t[0] >= told[TOLD - 1][0]]
    return sum(same for _, same in told) / len(told) if told else float(a[-1] == b[-1])


_OUT = [("id", None), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _compare(batches: Iterator[pa.RecordBatch], words: "F.Broadcast", kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows come in order within a range; a range's last row is the first one of the next range."""
    fingerprinter, held, schema = None, None, pa.schema([(n, t or kind) for n, t in _OUT])
    for batch in batches:
        fingerprinter = fingerprinter or Fingerprinter(words.value)
        out = []
        for id, text, span in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "span"))):
            now = (id, span, fingerprinter.prepare(text))
            if held is not None and held[1] == span:
                out.append(_row(held[0], held[2], now[2], fingerprinter))
            held = now
        yield pa.RecordBatch.from_pylist(out, schema)


def _row(id, own: Prepared, following: Prepared, fingerprinter: Fingerprinter) -> dict:
    edited, other = fingerprinter.edited(own, following.text)
    return {"id": id, "n_chars": len(own.text),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": ",".join(own.fingerprint), "edited_fingerprint": ",".join(other),
            "near_edited": likeness(own.fingerprint, other), "near_next": likeness(own.fingerprint, following.fingerprint)}


def with_next(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """Rows (span, halo, id, text) in which every row that is no halo is followed by its next one.

    The plan's size doesn't depend on the number of ranges: their cuts, and each range's first row, are small tables."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    n = common.partitions(spark)
    # ranges of ids from quantiles: bounded by the number of partitions
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else None
    cuts = np.array(sorted(set(cuts or [])))

    @F.arrow_udf("int")
    def span_of(ids: pa.Array) -> pa.Array:
        """Descending ids: a range begins below each cut; null ids are last."""
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        spans = np.full(len(ids), len(cuts), np.int32)
        spans[known] = len(cuts) - np.searchsorted(cuts, ids.drop_null().to_numpy(zero_copy_only=False), "right")
        return pa.array(spans)

    rows = rows.withColumn("span", span_of("id")) if len(cuts) else rows.withColumn("span", F.lit(0))
    firsts = rows.groupBy("span").agg(F.max("id").alias("id")).collect()  # a row per range
    spans = sorted((r.span, r.id) for r in firsts)
    if not spans:
        return rows.select("span", F.lit(False).alias("halo"), "id", "text")
    # first rows: the largest id of the range, by text where rows share it; they also go to the range before
    places = [(s, i, spans[k - 1][0]) for k, (s, i) in enumerate(spans)]
    places = F.broadcast(spark.createDataFrame(places, T.StructType([
        T.StructField("span", T.IntegerType()), T.StructField("first", rows.schema["id"].dataType),
        T.StructField("before", T.IntegerType())])))
    heads = (rows.join(places, "span").filter(F.col("id").eqNullSafe(F.col("first"))).groupBy("before", "id")
             .agg(F.min("text").alias("text")).select(F.col("before").alias("span"), F.lit(True).alias("halo"), "id", "text"))
    every = rows.select("span", F.lit(False).alias("halo"), "id", "text").unionByName(heads)
    return (every.repartitionById(len(cuts) + 1, F.col("span"))
            .sortWithinPartitions("span", "halo", F.desc_nulls_last("id"), "text"))


def compare(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses."""
    spark = docs.sparkSession
    words = spark.sparkContext.broadcast(lexicon(docs))
    rows = with_next(docs, id)
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["id"].dataType
    out = f"id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, " \
          "edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(lambda b: _compare(b, words, to_arrow_type(kind)), out)


def digest(compared: DataFrame) -> DataFrame:
    return compared.withColumnRenamed("id", "doc_id")
