"""Language-model scores by deleted interpolation.

A token's probability mixes maximum-likelihood estimates: of the bigram, of the word, and the uniform one,

    p(w | v) = l2 * c(v, w) / c(v) + l1 * c(w) / N + l0 / (V + 1),

with weights (l2, l1, l0) for each bucket of the context's frequency c(v).  Expectation-maximisation learns the
weights on held-out counts: a share of the training documents is deleted from the counts, and the weights are those that
make the deleted documents likeliest.  Scores then use the counts of all training documents.

Counting and looking up are one exchange.  Documents are dealt out by hash; each group sends every distinct word and bigram
once, with its count, to the part that owns its hash (parts are ranges of hashes; keys travel sorted, as
differences).  A part adds up what all groups sent and answers each group in the order in which it asked.  A
frequent word or a text with many copies therefore costs one key per group, and no table of the vocabulary exists in any
one place.  Words and bigrams travel as 64-bit hashes.  A group holds ``SPLIT_BYTES`` of text and a part answers for
``PART_BYTES`` of it, about, so both stay small as the input grows; there are as many as shuffle partitions at least.

Defined results: a null text is empty, one end token; a null id counts as training; rows that repeat are
scored and counted each; without training tokens only the uniform part is left; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm import common

#: crc32(doc_id) modulo FOLDS is HELD_OUT: no training.
FOLDS, HELD_OUT = 7, 2
#: Of the training documents, those deleted for learning the weights: crc32(doc_id) div FOLDS modulo DELETED is 0.
DELETED = 20
#: Buckets of c(v): 0, then powers of two, the last one open.
BUCKETS = 24
ITERATIONS = 12
#: Added to each weight's expected count, so that none becomes 0.
PRIOR = 0.1
SEED = 6
#: The end of a text as a token; words hold no space.
END = b" end"
#: Bytes of text in a group, and bytes of all groups' text that a part answers for, about.
SPLIT_BYTES, PART_BYTES = 32 << 20, 128 << 20

_REQUEST = "part int, split int, n int, sizes binary, keys binary, counts binary"
_REPLY = "split int, part int, counts binary, tokens long, words long"
_PROFILE = ("id {id}, held_out boolean, deleted boolean, n_tokens long, n_known long, train_tokens long, "
            "train_words long, base_score double, counts binary")


def flagged(docs: DataFrame, splits: int, id: str = "doc_id") -> DataFrame:
    """(split, id, text, held_out, deleted); deleted rows are training rows."""
    crc = F.coalesce(F.crc32(F.col(id).cast("string")), F.lit(-1))
    held = common.crc_mod(F.col(id), FOLDS) == HELD_OUT
    deleted = ~held & (crc >= 0) & (F.floor(crc / FOLDS) % DELETED == 0)
    text = F.coalesce(F.col("text"), F.lit(""))
    split = F.pmod(F.xxhash64(F.lit(SEED), F.col(id), F.col("text")), F.lit(splits)).cast("int")
    return docs.select(split.alias("split"), F.col(id).alias("id"), text.alias("text"), held.alias("held_out"),
                       deleted.alias("deleted"))


class _Words(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _mix(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes."""
    x = v * np.uint64(0x9E3779B97F4A7C15) + (w ^ (w >> np.uint64(32)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Tokens:
    """The tokens of a group's documents, and its distinct keys: words and bigrams, sorted by hash."""

    def __init__(self, texts: list[str]):
        import xxhash

        words = _Words()
        end = words[END]
        ids, lengths = [], []
        for text in texts:
            of = list(map(words.__getitem__, text.encode("utf-8", "surrogatepass").lower().split()))
            of.append(end)
            lengths.append(len(of))
            ids.append(np.array(of, np.int32))
        self.lengths = np.array(lengths, np.int64)
        hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], np.uint64)
        token = np.concatenate(ids)
        del ids
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[0] = end  # a text begins where one ended
        self.word_keys, number = np.unique(hashes, return_inverse=True)
        self.words = number[token]
        pairs = _mix(hashes[before], hashes[token])
        del before, token
        self.pair_keys, self.pairs = np.unique(pairs, return_inverse=True)

    def counts(self, at: np.ndarray, n: int, weight: np.ndarray) -> np.ndarray:
        return np.bincount(at, weights=np.repeat(weight, self.lengths), minlength=n).astype(np.int64)


def _bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's range of hashes begins among sorted keys, and the end."""
    edges = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges, "left"), [len(keys)]]).astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as hold them all, low bytes first and together, then the higher ones, compressed."""
    import zstandard

    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def _unpack(data: bytes, n: int) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :len(raw) // n] = raw.reshape(-1, n).T
    return out.view(np.int64).reshape(-1)


def _keys(sorted_keys: np.ndarray) -> bytes:
    """Sorted distinct hashes: how many, the first one, then the packed differences."""
    return np.uint64(len(sorted_keys)).tobytes() + sorted_keys[:1].tobytes() + _pack(np.diff(sorted_keys))


def _hashes(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.uint64, 1)[0])
    if not n:
        return np.empty(0, np.uint64)
    gaps = _unpack(data[16:], n - 1).view(np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(data, np.uint64, 1, 8), gaps]), dtype=np.uint64)


def _ask(table: pa.Table, parts: int) -> pa.Table:
    """A group's requests: a row for each part, with words first, then bigrams."""
    t = Tokens(table.column("text").to_pylist())
    held, deleted = (np.array(table.column(c).to_pylist(), bool) for c in ("held_out", "deleted"))
    split = table.column("split")[0].as_py()
    rows, sides = [], []
    for keys, at in ((t.word_keys, t.words), (t.pair_keys, t.pairs)):
        sides.append((keys, _bounds(keys, parts), t.counts(at, len(keys), ~held), t.counts(at, len(keys), deleted)))
    for p in range(parts):
        cut = [(k[b[p]:b[p + 1]], c[b[p]:b[p + 1]], d[b[p]:b[p + 1]]) for k, b, c, d in sides]
        keys = [_keys(k) for k, _, _ in cut]
        counts = np.concatenate([x for _, c, d in cut for x in (c, d)])
        sizes = np.array([len(cut[0][0]), len(cut[1][0]), len(keys[0])], np.int64)
        rows.append({"part": p, "split": split, "n": len(counts), "sizes": sizes.tobytes(),
                     "keys": b"".join(keys), "counts": _pack(counts)})
    return pa.Table.from_pylist(rows, pa.schema([("part", pa.int32()), ("split", pa.int32()), ("n", pa.int32()),
                                                 ("sizes", pa.binary()), ("keys", pa.binary()),
                                                 ("counts", pa.binary())]))


def _answer(table: pa.Table) -> pa.Table:
    """A part's replies: for every request the sums over all groups, in its order, and the part's totals."""
    rows = table.to_pylist()
    keys: tuple[list, list] = ([], [])
    counts: tuple[list, list] = ([], [])
    for r in rows:
        words, pairs, cut = np.frombuffer(r["sizes"], np.int64)
        c = _unpack(r["counts"], r["n"])
        keys[0].append(_hashes(r["keys"][:cut]))
        keys[1].append(_hashes(r["keys"][cut:]))
        counts[0].append(c[:2 * words].reshape(2, -1))
        counts[1].append(c[2 * words:].reshape(2, -1))
    replies: list[list[np.ndarray]] = [[] for _ in rows]
    tokens = distinct = 0
    for side in range(2):
        own, at = np.unique(np.concatenate(keys[side]), return_inverse=True)
        every = np.concatenate(counts[side], axis=1)
        sums = [np.bincount(at, weights=every[i], minlength=len(own)).astype(np.int64) for i in range(2)]
        if side == 0:
            tokens, distinct = int(sums[0].sum()), int((sums[0] > 0).sum())
        ends = np.cumsum([len(k) for k in keys[side]])
        for reply, start, end in zip(replies, [0, *ends[:-1]], ends):
            reply += [s[at[start:end]] for s in sums]
    return pa.table({
        "split": pa.array([r["split"] for r in rows], pa.int32()),
        "part": pa.array([r["part"] for r in rows], pa.int32()),
        "counts": pa.array([_pack(np.concatenate(r)) for r in replies], pa.binary()),
        "tokens": pa.array([tokens] * len(rows), pa.int64()), "words": pa.array([distinct] * len(rows), pa.int64())})


def _profile(docs: pa.Table, replies: pa.Table, parts: int, schema: pa.Schema) -> pa.Table:
    """Every document's counts of its tokens and of its bigrams; for deleted ones what deletion takes off, too."""
    if not docs.num_rows:
        return schema.empty_table()
    t = Tokens(docs.column("text").to_pylist())
    bounds = [_bounds(k, parts) for k in (t.word_keys, t.pair_keys)]
    got = {r["part"]: r for r in replies.to_pylist()}
    found = [np.empty((2, len(k)), np.int64) for k in (t.word_keys, t.pair_keys)]
    for p in range(parts):
        n = [int(b[p + 1] - b[p]) for b in bounds]
        c = _unpack(got[p]["counts"], 2 * sum(n))
        for f, b, values in zip(found, bounds, (c[:2 * n[0]], c[2 * n[0]:])):
            f[:, b[p]:b[p + 1]] = values.reshape(2, -1)
    tokens, words = (sum(r[c] for r in got.values()) for c in ("tokens", "words"))
    word, pair = found[0][:, t.words], found[1][:, t.pairs]
    base = np.log10((word[0] + 1) / (tokens + words + 1))
    ends = np.cumsum(t.lengths)
    starts = ends - t.lengths
    deleted = docs.column("deleted").to_pylist()
    packed = []
    for a, b, d in zip(starts, ends, deleted):
        sides = [word[0, a:b], pair[0, a:b]] + ([word[1, a:b], pair[1, a:b]] if d else [])
        packed.append(_pack(np.concatenate(sides)))
    columns = [docs.column("id").combine_chunks(), docs.column("held_out").combine_chunks(),
               docs.column("deleted").combine_chunks(), pa.array(t.lengths),
               pa.array(np.add.reduceat((word[0] > 0).astype(np.int64), starts)),
               pa.array([tokens] * len(ends), pa.int64()), pa.array([words] * len(ends), pa.int64()),
               pa.array(np.add.reduceat(base, starts)), pa.array(packed, pa.binary())]
    return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def profiles(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row per document: base score and packed counts, all that the model's score needs."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    splits, parts = (max(common.partitions(spark), -(-size // share)) for share in (SPLIT_BYTES, PART_BYTES))
    rows = flagged(docs, splits, id)
    schema = pa.schema([("id", _arrow_type(rows, "id")), ("held_out", pa.bool_()), ("deleted", pa.bool_()),
                        ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("train_words", pa.int64()), ("base_score", pa.float64()), ("counts", pa.binary())])
    asked = rows.groupBy("split").applyInArrow(lambda t: _ask(t, parts), _REQUEST)
    answered = asked.groupBy("part").applyInArrow(_answer, _REPLY)
    out = rows.groupBy("split").cogroup(answered.groupBy("split")).applyInArrow(
        lambda left, right: _profile(left, right, parts, schema),
        _PROFILE.format(id=rows.schema["id"].dataType.simpleString()))
    return common.materialize(out, "profiles")


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def _estimates(word: np.ndarray, pair: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, bigram estimate, word estimate) of a document's tokens; its last token is the end."""
    context = np.concatenate([word[-1:], word[:-1]])  # every text begins once and ends once
    bucket = np.where(context > 0, np.minimum(1 + np.log2(np.maximum(context, 1)).astype(np.int64), BUCKETS - 1), 0)
    bigram = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
    return bucket, bigram, word / max(1, tokens)


def _events(batches: Iterator[pa.RecordBatch], kept: int) -> Iterator[pa.RecordBatch]:
    """Estimates without the deleted documents, of each token of those; equal ones counted together."""
    for batch in batches:
        parts = []
        for n, data in zip(batch.column("n_tokens").to_pylist(), batch.column("counts").to_pylist()):
            word, pair, less_word, less_pair = _unpack(data, 4 * n).reshape(4, n)
            parts.append(np.stack(_estimates(word - less_word, pair - less_pair, kept), axis=1))
        if parts:
            rows, times = np.unique(np.concatenate(parts), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[:, 0].astype(np.int32)), pa.array(rows[:, 1]), pa.array(rows[:, 2]),
                 pa.array(times.astype(np.int64))], names=["bucket", "bigram", "word", "n"])


def learn(events: DataFrame, words: int) -> np.ndarray:
    """Weights (BUCKETS, 3) by expectation-maximisation; each round is one aggregate over all events."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(ITERATIONS):
        l2, l1, l0 = (F.element_at(F.array(*[F.lit(float(x)) for x in weights[:, i]]), F.col("bucket") + 1)
                      for i in range(3))
        parts = [l2 * F.col("bigram"), l1 * F.col("word"), l0 * F.lit(1 / (words + 1))]
        whole = parts[0] + parts[1] + parts[2]
        sums = events.groupBy("bucket").agg(*[F.sum(F.col("n") * p / whole).alias(f"s{i}")
                                              for i, p in enumerate(parts)]).collect()  # a row per bucket
        for r in sums:
            s = np.array([r.s0, r.s1, r.s2]) + PRIOR
            weights[r.bucket] = s / s.sum()
    return weights


def _scores(batches: Iterator[pa.RecordBatch], weights: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for n, deleted, tokens, words, data in zip(*(batch.column(c).to_pylist() for c in (
                "n_tokens", "deleted", "train_tokens", "train_words", "counts"))):
            counts = _unpack(data, (4 if deleted else 2) * n).reshape(-1, n)
            bucket, bigram, word = _estimates(counts[0], counts[1], tokens)
            w = weights[bucket]
            out.append(float(np.log10(w[:, 0] * bigram + w[:, 1] * word + w[:, 2] / (words + 1)).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(out, pa.float64())],
                                         names=[*names, "score"])


def score(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    rows = profiles(docs, id)
    deleted = rows.filter("deleted")
    totals = rows.select("train_tokens", "train_words").first()
    weights = np.full((BUCKETS, 3), 1 / 3)
    if totals is not None:
        kept = totals.train_tokens - (deleted.agg(F.sum("n_tokens")).first()[0] or 0)
        events = deleted.select("n_tokens", "counts").mapInArrow(
            lambda b: _events(b, kept), "bucket int, bigram double, word double, n long")
        weights = learn(common.materialize(events, "events"), totals.train_words)
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(names).schema)
    return rows.mapInArrow(lambda b: _scores(b, weights, names), f"{kinds}, score double")


def digest(scored: DataFrame) -> DataFrame:
    return scored.withColumnRenamed("id", "doc_id")
