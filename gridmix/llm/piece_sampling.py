"""Sampled SentencePiece segmentations, reproducible by row key, and lossless decoding.

A text is a lattice of pieces: an edge for every piece of the vocabulary that matches at a place, and the bytes of a
character where no piece is that character.  Forward filtering sums the probabilities of all paths to each place;
backward sampling then draws a path from the end, so a segmentation comes up with its probability under
the unigram model.  Random numbers are a hash of the row key and of the place in the text.

No piece has the space mark behind another character, and line feeds have no piece, so paths never cross the
beginning of a word.  The lattice is filtered once for each distinct word of a batch of texts, and drawn for every
occurrence, all words of the batch at a time.

The vocabulary is a public BPE model whose scores are merge ranks.  Its pieces get the probabilities of Zipf's law over
their ranks, raised to ``alpha``.  Nothing is trained.

Decoding joins pieces and bytes and gives back the text exactly: spaces become marks and back, a mark in the
text itself is written in bytes, and no text is normalised.

Defined results: a null text gives null pieces and null text; an empty one none; rows that repeat give the
same segmentation; a null key is drawn from the text alone; an empty table gives an empty result; further columns are
ignored by ``round_trip`` and kept by ``encode`` and ``decode``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 8
MARK = "▁"
#: Rank that bytes count as: behind all pieces.
BYTE_RANK = 64_000
#: Characters that are filtered and drawn together.
BATCH_CHARS = 1_000_000
#: A word with the spaces before it; spaces before a line feed or the end; a line feed.
_WORDS = re.compile(r" *[^ \n]+| +|\n")
#: What a mark in the text itself counts as: no piece has it.
_LITERAL = 0x110000

_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def _seed(key: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), SEED)


class Vocabulary:
    """Pieces by hash of their characters, their log probabilities, and the bytes that they stand for."""

    def __init__(self, model: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        self.data = [b""] * size  # what a piece decodes to
        self.byte_id = np.zeros(256, np.int32)
        spelled = []
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[1:-1], 16)
                self.data[i], self.byte_id[b] = bytes([b]), i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if MARK in piece.lstrip(MARK) or "\n" in piece:
                    raise ValueError(f"piece {i} crosses the beginning of a word")
                self.data[i] = piece.replace(MARK, " ").encode()
                spelled.append((piece, i, -sp.get_score(i)))
        self.longest = max(len(p) for p, _, _ in spelled)
        hashes = np.zeros(len(spelled), np.uint64)
        for n, (piece, _, _) in enumerate(spelled):
            h = np.zeros(1, np.uint64)
            for c in piece:
                h = self.extend(h, np.array([ord(c)], np.uint64))
            hashes[n] = h[0]
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        self.ids = np.array([i for _, i, _ in spelled], np.int32)[order]
        # Zipf: rank 0 is the first merge; single characters come last
        ranks = np.array([r for _, _, r in spelled])[order]
        total = np.log(np.sum(1 / (ranks + 2)))
        self.logp = alpha * (-np.log(ranks + 2) - total)
        self.byte_logp = float(alpha * (-np.log(BYTE_RANK) - total))
        # open addressing: slots by the top bits, so that most lookups touch one place
        self.bits = int(np.ceil(np.log2(len(self.hashes) * 8)))
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.probes = 1
        for n, h in enumerate(self.hashes.tolist()):
            at, steps = h >> (64 - self.bits), 1
            while self.slots[at] >= 0:
                at, steps = (at + 1) & ((1 << self.bits) - 1), steps + 1
            self.slots[at], self.probes = n, max(self.probes, steps)

    @staticmethod
    def extend(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        return _mix((h + c + np.uint64(1)) * _C1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Positions of the pieces with these hashes, -1 where there is none."""
        found = np.full(len(h), -1, np.int32)
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        open_ = np.arange(len(h))
        for _ in range(self.probes):
            n = self.slots[at[open_]]
            hit = (n >= 0) & (self.hashes[n] == h[open_])
            found[open_[hit]] = n[hit]
            open_ = open_[(n >= 0) & ~hit]
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
        return found


@lru_cache(maxsize=4)
def vocabulary(model: str = MODEL, alpha: float = ALPHA) -> Vocabulary:
    return Vocabulary(model, alpha)


class Lattice:
    """The lattices of distinct words, places numbered through.  Edges are sorted by the place where they end."""

    def __init__(self, words: list[str], v: Vocabulary):
        lengths = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(lengths + 1) - (lengths + 1)  # a word's place before its first character
        self.last = self.first + lengths
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        codes = np.where(codes == ord(MARK), _LITERAL, np.where(codes == 0x20, ord(MARK), codes)).astype(np.uint64)
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(codes)) + owner  # where a character begins
        room = self.last[owner] - place
        begins, ends, pieces, logps = [], [], [], []
        h, at = np.zeros(len(codes), np.uint64), np.arange(len(codes))
        for n in range(1, v.longest + 1):
            h = v.extend(h, codes[at + n - 1])
            found = v.find(h)
            hit = found >= 0
            begins.append(place[at[hit]])
            ends.append(begins[-1] + n)
            pieces.append(v.ids[found[hit]].astype(np.int64))
            logps.append(v.logp[found[hit]])
            if n == 1:
                single = hit
            more = room[at] > n
            at, h = at[more], h[more]
        rest = np.flatnonzero(~single)  # characters without a piece: an edge of bytes, piece -1 - character
        c = np.where(codes[rest] == _LITERAL, ord(MARK), codes[rest])
        wide = 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)
        begins.append(place[rest])
        ends.append(place[rest] + 1)
        pieces.append(-1 - c.astype(np.int64))
        logps.append(wide * v.byte_logp)
        begin, end, piece, logp = (np.concatenate(x) for x in (begins, ends, pieces, logps))
        order = np.lexsort((begin, end))
        self.begin, self.piece, logp, end = begin[order], piece[order], logp[order], end[order]
        places = int(self.last[-1]) + 1 if len(words) else 0
        self.edges = np.searchsorted(end, np.arange(places + 1))  # edges of a place: edges[p] to edges[p + 1]
        self._filter(logp, end, places, lengths)

    def _filter(self, logp: np.ndarray, end: np.ndarray, places: int, lengths: np.ndarray) -> None:
        """Forward sums of the probabilities, place by place in all words at once; then edges' shares of them."""
        forward = np.full(places, -np.inf)
        forward[self.first] = 0.0
        depth = end - np.repeat(self.first, lengths + 1)[end] if places else end
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, int(depth.max(initial=0)) + 2))
        weight = np.empty(len(end))
        for a, b in zip(cuts[:-1], cuts[1:]):
            e = order[a:b]  # edges that end at this depth, by place
            w = forward[self.begin[e]] + logp[e]
            starts = np.flatnonzero(np.diff(end[e], prepend=-1))
            top = np.maximum.reduceat(w, starts)
            many = np.diff(starts, append=len(e))
            share = np.exp(w - np.repeat(top, many))
            total = np.add.reduceat(share, starts)
            forward[end[e][starts]] = top + np.log(total)
            weight[e] = share / np.repeat(total, many)
        # running sums inside each place; the last edge of a place takes whatever is left
        run = np.cumsum(weight)
        start = self.edges[end]
        self.below = run - (run[start] - weight[start])
        closing = np.flatnonzero(np.diff(end, append=-1))
        self.below[closing] = np.inf

    def draw(self, words: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(occurrence, piece) of a path through each occurrence's word, in the order of the text."""
        at, who, step = self.last[words], np.arange(len(words)), 0
        owners, taken, steps = [], [], []
        live = at > self.first[words]
        at, who = at[live], who[live]
        while len(at):
            move = np.uint64((step + 1) * int(_C1) % 2 ** 64)
            u = (_mix(seeds[who] + move) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            e = self.edges[at]
            open_ = np.flatnonzero(u >= self.below[e])
            while len(open_):
                e[open_] += 1
                open_ = open_[u[open_] >= self.below[e[open_]]]
            owners.append(who)
            taken.append(self.piece[e])
            steps.append(np.full(len(who), step, np.int32))
            at = self.begin[e]
            step += 1
            live = at > self.first[words[who]]
            at, who = at[live], who[live]
        if not owners:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        owner, piece, step_ = np.concatenate(owners), np.concatenate(taken), np.concatenate(steps)
        n = np.bincount(owner, minlength=len(words))
        place = (np.cumsum(n) - 1)[owner] - step_  # backward: the first step is the last piece
        out = np.empty_like(piece)
        out[place] = piece
        return np.repeat(np.arange(len(words)), n), out


def _spread(piece: np.ndarray, owner: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Edges of bytes as the pieces of their bytes."""
    raw = np.flatnonzero(piece < 0)
    if not len(raw):
        return piece, owner
    data = [chr(c).encode("utf-8", "surrogatepass") for c in (-1 - piece[raw]).tolist()]
    many = np.ones(len(piece), np.int64)
    many[raw] = [len(d) for d in data]
    out, own = np.repeat(piece, many), np.repeat(owner, many)
    at = np.repeat((np.cumsum(many) - many)[raw], many[raw])
    inside = np.arange(len(at)) - np.repeat(np.cumsum(many[raw]) - many[raw], many[raw])
    out[at + inside] = v.byte_id[np.frombuffer(b"".join(data), np.uint8)]
    return out, own


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def segment(keys: list[str], texts: list[str], v: Vocabulary) -> list[np.ndarray]:
    """A sampled segmentation of each text: piece ids."""
    numbers = _Numbers()
    ids = [np.array(list(map(numbers.__getitem__, _WORDS.findall(t))), np.int64) for t in texts]
    if not numbers:
        return [np.empty(0, np.int32) for _ in texts]
    words, many = np.concatenate(ids), np.array([len(i) for i in ids])
    row = np.repeat(np.arange(len(texts)), many)
    nth = np.arange(len(words)) - np.repeat(np.cumsum(many) - many, many)
    seeds = _mix(np.array([_seed(k) for k in keys], np.uint64)[row] + nth.astype(np.uint64) * _C3)
    owner, piece = Lattice(list(numbers), v).draw(words, seeds)
    piece, owner = _spread(piece, owner, v)
    cuts = np.searchsorted(row[owner], np.arange(len(texts) + 1))
    return [piece[a:b].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:])]


def joined(pieces: np.ndarray, v: Vocabulary) -> str:
    """The text of a segmentation."""
    return b"".join(map(v.data.__getitem__, pieces.tolist())).decode("utf-8", "surrogatepass")


def _groups(keys: list[str], texts: list[str]) -> Iterator[slice]:
    """Rows of about BATCH_CHARS characters (a longer text alone)."""
    start = chars = 0
    for n, t in enumerate(texts):
        if chars and chars + len(t) > BATCH_CHARS:
            yield slice(start, n)
            start, chars = n, 0
        chars += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _segments(batches: Iterator[pa.RecordBatch], key: str, text: str, model: str, alpha: float):
    """(batch, rows, keys, texts, pieces): each batch in slices of bounded length."""
    v = vocabulary(model, alpha)
    for batch in batches:
        texts = [t or "" for t in batch.column(text).to_pylist()]
        keys = [str(k) if k is not None else f"null:{hashlib.sha256(t.encode('utf-8', 'surrogatepass')).hexdigest()}"
                for k, t in zip(batch.column(key).to_pylist(), texts)]
        for part in _groups(keys, texts):
            yield batch.slice(part.start, part.stop - part.start), texts[part], segment(keys[part], texts[part], v), v


def _list_array(pieces: list[np.ndarray], none: list[bool]) -> pa.Array:
    ends = np.cumsum([0, *[len(p) for p in pieces]])
    offsets = pa.array([None if n else int(e) for n, e in zip([*none, False], ends)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pieces), pa.int32()))


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, alpha: float = ALPHA,
           out: str = "pieces") -> DataFrame:
    """The documents with the ids of a sampled segmentation (a column of that name is replaced)."""
    kept = docs.drop(out)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch, _, pieces, _ in _segments(batches, key, text, model, alpha):
            none = batch.column(text).is_null().to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, _list_array(pieces, none)],
                                             names=[*batch.schema.names, out])

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, pieces: str = "pieces", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """The rows with the text that their pieces stand for."""
    kept = encoded.drop(out)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        v = vocabulary(model, ALPHA)
        for batch in batches:
            texts = [None if p is None else joined(np.array(p, np.int32), v) for p in batch.column(pieces).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, out])

    return kept.mapInArrow(run, schema)


def round_trip(docs: DataFrame, id: str = "doc_id", model: str = MODEL, alpha: float = ALPHA) -> DataFrame:
    """(id, n_pieces, pieces_sha256, decoded_sha256, lossless): encoding and decoding in one pass.

    ``pieces_sha256`` is over the ids as little-endian 32-bit integers, ``decoded_sha256`` over UTF-8; a null
    text has 0 pieces, null digests, and is lossless.
    """
    rows = docs.select(F.col(id).alias("id"), F.col("text").alias("text"))

    def run(batches):
        for batch, texts, pieces, v in _segments(batches, "id", "text", model, alpha):
            none = batch.column("text").is_null().to_pylist()
            back = [joined(p, v) for p in pieces]
            sha = [[None if n else hashlib.sha256(d).hexdigest() for n, d in zip(none, data)] for data in (
                [p.astype("<i4").tobytes() for p in pieces], [b.encode("utf-8", "surrogatepass") for b in back])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(p) for p in pieces], pa.int64()), pa.array(sha[0], pa.string()),
                 pa.array(sha[1], pa.string()), pa.array([a == b for a, b in zip(texts, back)])],
                names=["id", "n_pieces", "pieces_sha256", "decoded_sha256", "lossless"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_pieces long, pieces_sha256 string, decoded_sha256 string, lossless boolean")


def digest(trips: DataFrame) -> DataFrame:
    return trips.withColumnRenamed("id", "doc_id")
