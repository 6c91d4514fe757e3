"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

Tokens of a text and the text's bytes make an incidence matrix, kept in compressed sparse rows (CSR): a row for each token, a
column for each byte, and one matrix for each tokenizer, A and B.  The product A.Bt has an entry for every pair of
tokens that share bytes, its value the number of bytes: the overlap links.  Byte offsets where tokens of both end cut the text
into groups; products of the token-group matrices have an entry for every pair of tokens of one group: the shared-group
links.  ``multiply`` forms rows of a product after Gustavson, from the rows of the right matrix that a row of the left one
names.  It works on runs of rows of bounded work; where only the number of links is asked for, the first half (the
rows' sizes) is enough, so pairs within a long group aren't written out.

Neither tokenizer has a token that holds a space behind another character, nor one that depends on what was before such a
place.  So a text is the chunks between these places, a chunk is encoded and aligned once for all its occurrences that a task
sees, and a document's links are a product too: of the document-chunk matrix and the chunk-pair matrix.

How many documents hold a pair of ids linked is counted over the corpus.  Documents are packed into blocks by bytes; a block
keeps a CSR matrix of its documents over its distinct pairs.  A pair leaves a block once, with the number of the block's
documents, and its corpus-wide count comes back to the block once; the matrix times these counts gives the
documents' sums.  So neither a common pair nor a long list of links goes through one task.

Tokenizer files are read by the driver and shipped to tasks by value (2 MB, fixed size).

Defined results: a null or empty text has no tokens, nor has one whose joined token bytes differ from a space and the text, for
instance where it holds U+2581 itself; its numbers are 0 and its hash is empty; special tokens in a text are plain text; null ids and rows that
repeat are rows like any other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm import common

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text in a block (or one document), and in what is encoded and aligned together.
BLOCK_BYTES, TOGETHER_BYTES = 8 << 20, 1 << 20
#: Entries of a product that are formed together.
WORK = 1 << 21
#: Characters of chunks that a task remembers.
REMEMBERED = 8 << 20
#: Between chunks: behind anything but white space, before a space.
_CHUNK = re.compile(r"(?<=\S)(?= )")
_BLANK_AND_SPACE = re.compile(r"\s ")


# --- sparse matrices ----------------------------------------------------------------------------

class Csr(NamedTuple):
    """Row i has the columns ``indices[indptr[i]:indptr[i + 1]]``, each with its value."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1


def incidence(row_sizes: np.ndarray, indices: np.ndarray, columns: int) -> Csr:
    return Csr(np.concatenate([[0], np.cumsum(row_sizes)]), indices, np.ones(len(indices), np.int64), columns)


def transpose(m: Csr) -> Csr:
    row = np.repeat(np.arange(m.rows), np.diff(m.indptr))
    order = np.argsort(m.indices, kind="stable")
    sizes = np.bincount(m.indices, minlength=m.columns)
    return Csr(np.concatenate([[0], np.cumsum(sizes)]), row[order], m.values[order], m.rows)


def work(left: Csr, right: Csr) -> np.ndarray:
    """Entries of the right matrix that each row of the left one calls for; the product's row sizes where no two meet."""
    per_entry = np.diff(right.indptr)[left.indices]
    total = np.concatenate([[0], np.cumsum(per_entry)])
    return total[left.indptr[1:]] - total[left.indptr[:-1]]


def multiply(left: Csr, right: Csr, bound: int = WORK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, values) of the product, by runs of its rows; a run takes about ``bound`` entries, or one row."""
    upto = np.concatenate([[0], np.cumsum(work(left, right))])
    at = 0
    while at < left.rows:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + bound, "right")) - 1)
        lo, hi = left.indptr[at], left.indptr[end]
        k = left.indices[lo:hi]
        sizes = right.indptr[k + 1] - right.indptr[k]
        row = np.repeat(np.repeat(np.arange(at, end), np.diff(left.indptr[at:end + 1])), sizes)
        # entry j of each row k of the right matrix
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(right.indptr[k], sizes)
        key = row * right.columns + right.indices[place]
        value = np.repeat(left.values[lo:hi], sizes) * right.values[place]
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        if len(first):
            yield key[first] // right.columns, key[first] % right.columns, np.add.reduceat(value, first)
        at = end


# --- tokens and their bytes ---------------------------------------------------------------------

def _byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable Latin-1 stands for itself, other bytes for U+0100 and up."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(rest)}


class Aligned(NamedTuple):
    """Tokens of both sides for some texts, one after the other, as matrices over bytes and over groups."""

    ids: tuple[np.ndarray, np.ndarray]
    doc: tuple[np.ndarray, np.ndarray]
    over_bytes: tuple[Csr, Csr]
    over_groups: tuple[Csr, Csr]
    group_doc: np.ndarray

    def links(self, kind: str = "overlap") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, bytes shared) or, for kind 'group', (A token, B token, 1), tokens by place."""
        a, b = self.over_bytes if kind == "overlap" else self.over_groups
        return multiply(a, transpose(b))

    def group_links(self) -> np.ndarray:
        """Number of shared-group links of every A token, without forming them."""
        return work(self.over_groups[0], transpose(self.over_groups[1]))


class Aligner:
    """Encodes texts with both tokenizers and aligns what they give."""

    def __init__(self, byte_bpe: str, pieces: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, n in vocabulary.items():
            self.a_bytes[n] = bytes(alphabet[c] for c in token)
        self.b_bytes = []
        self.space = self.b.piece_to_id(MARK)
        for n in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(n)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {n} has a space behind another character")
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(n) else piece.replace(MARK, " ").encode())
        self.sizes = [np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes)]
        # decimal ids with what follows: a comma, or the mark that ends a group's side
        self.spelled = [b"%d%s" % (n, mark) for table, end in ((self.a_bytes, b"|"), (self.b_bytes, b";"))
                        for n in range(len(table)) for mark in (b",", end)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of a space and each text; none where the bytes of either differ from these."""
        spaced = [" " + t for t in texts]
        ours = [x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        theirs = self.b.encode(texts, num_threads=1)
        for i, (s, x, y) in enumerate(zip(spaced, ours, theirs)):
            data, y = s.encode(), y or [self.space]  # it has nothing to say of the space alone
            theirs[i] = y
            if b"".join([self.a_bytes[n] for n in x]) != data or b"".join([self.b_bytes[n] for n in y]) != data:
                ours[i], theirs[i] = [], []
        return ours, theirs

    def align(self, texts: list[str]) -> Aligned:
        sides, ends, ids, docs = self.encode(texts), [], [], []
        for side, sizes in zip(sides, self.sizes):
            flat = np.fromiter((n for ids_ in side for n in ids_), np.int64)
            ids.append(flat)
            docs.append(np.repeat(np.arange(len(side)), [len(x) for x in side]))
            ends.append(np.cumsum(sizes[flat]))
        total = int(ends[0][-1]) if len(ends[0]) else 0
        over_bytes = tuple(incidence(sizes[x], np.arange(total), total) for x, sizes in zip(ids, self.sizes))
        cuts = np.intersect1d(*ends)
        groups = [np.searchsorted(cuts, e) for e in ends]
        over_groups = tuple(incidence(np.ones(len(g), np.int64), g, len(cuts)) for g in groups)
        group_doc = docs[0][np.searchsorted(ends[0], cuts)]
        return Aligned(tuple(ids), tuple(docs), over_bytes, over_groups, group_doc)

    def spell(self, aligned: Aligned, n_texts: int) -> list[bytes]:
        """Every text's groups, `a1,a2|b1;a3|b2,b3`."""
        groups = [m.indices for m in aligned.over_groups]
        n_a, n_b = (np.bincount(g, minlength=len(aligned.group_doc)) for g in groups)
        before_a, before_b = np.cumsum(n_a), np.cumsum(n_b) - n_b  # of groups up to, and of groups before
        order = np.empty(len(groups[0]) + len(groups[1]), np.int64)
        shift = 0
        for g, ids, other in zip(groups, aligned.ids, (before_b, before_a)):
            last = np.concatenate([g[1:] != g[:-1], [True]]) if len(g) else np.zeros(0, bool)
            order[np.arange(len(g)) + other[g]] = 2 * ids + last + shift
            shift = 2 * len(self.a_bytes)
        upto = np.cumsum(sum(np.bincount(d, minlength=n_texts) for d in aligned.doc)).tolist()
        words, out, at = [self.spelled[n] for n in order.tolist()], [], 0
        for end in upto:
            out.append(b"".join(words[at:end])[:-1])
            at = end
        return out


def chunks(text: str) -> list[str]:
    """A space and the text, cut before spaces that follow anything but white space; the space that each begins with is left out."""
    if not _BLANK_AND_SPACE.search(text) and text[:1] != " ":
        return text.split(" ")
    return [c[1:] for c in _CHUNK.split(" " + text)]


class Chunks(dict):
    """Chunks by text: their place among those seen, and what is known of each."""

    def __init__(self, tool: Aligner):
        self.tool, self.new, self.size = tool, [], 0
        self.counts = np.zeros((0, len(_COUNTS)), np.int64)
        self.whole = np.zeros(0, bool)
        self.spelled: list[bytes] = []
        self.pairs = Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0)

    def __missing__(self, text: str) -> int:
        n = self[text] = len(self)
        self.new.append(text)
        return n

    def learn(self) -> None:
        """Encode and align the chunks that came in since."""
        done, at = [], 0
        while at < len(self.new):
            size, end = 0, at
            while end < len(self.new) and (size < TOGETHER_BYTES or end == at):
                size, end = size + len(self.new[end]), end + 1
            done.append(self._learn(self.new[at:end]))
            self.size, at = self.size + size, end
        self.new = []
        if done:
            counts, whole, spelled, sizes, keys, times = zip(*done)
            self.counts = np.concatenate([self.counts, *counts])
            self.whole = np.concatenate([self.whole, *whole])
            self.spelled += [s for some in spelled for s in some]
            indptr = np.concatenate([self.pairs.indptr, self.pairs.indptr[-1] + np.cumsum(np.concatenate(sizes))])
            self.pairs = Csr(indptr, np.concatenate([self.pairs.indices, *keys]), np.concatenate([self.pairs.values, *times]), 0)

    def _learn(self, texts: list[str]):
        got, n = self.tool.align(texts), len(texts)
        parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y, _ in got.links():
            parts[0].append(got.doc[0][x])
            parts[1].append(got.ids[0][x] << 32 | got.ids[1][y])
        doc, key = map(np.concatenate, parts)
        order = np.lexsort((key, doc))
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(key) else doc
        n_links = np.bincount(doc, minlength=n)
        n_a, n_b = (np.bincount(d, minlength=n) for d in got.doc)
        in_group = np.bincount(got.doc[0], weights=got.group_links(), minlength=n).astype(np.int64)
        counts = np.stack([n_a, n_b, np.bincount(got.group_doc, minlength=n), n_links, in_group], axis=1)
        return (counts, n_a > 0, self.tool.spell(got, n), np.bincount(doc[first], minlength=n), key[first],
                np.diff(np.append(first, len(key))))


@lru_cache(maxsize=2)
def aligner(byte_bpe: str, pieces: bytes) -> Aligner:
    return Aligner(byte_bpe, pieces)


def _files(docs: DataFrame, byte_bpe: str, pieces: str):
    with open(byte_bpe, encoding="utf-8") as a, open(pieces, "rb") as b:
        return docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))


def _texts(docs: DataFrame, id: str) -> DataFrame:
    return docs.select(F.col(id).cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], int]]:
    """Ids and texts of about TOGETHER_BYTES, whatever the batches."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(id)
            texts.append(text)
            size += len(text)
            if size >= TOGETHER_BYTES:
                yield ids, texts, size
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts, size


# --- links --------------------------------------------------------------------------------------

_LINKS = pa.schema([("id", pa.int64()), ("a_place", pa.int64()), ("b_place", pa.int64()), ("a", pa.int32()),
                    ("b", pa.int32()), ("shared", pa.int64())])


def links(docs: DataFrame, kind: str = "overlap", id: str = "doc_id", byte_bpe: str = BYTE_BPE,
          pieces: str = PIECES) -> DataFrame:
    """Every link as a row: places of both tokens in their document, their ids, and the bytes that they share (overlap
    links) or 1 (kind 'group': all pairs of a group)."""
    files = _files(docs, byte_bpe, pieces)

    def run(batches):
        tool = aligner(*files.value)
        for ids, texts, _ in _some(batches):
            ids, texts = zip(*((i, t) for i, t in zip(ids, texts) if t)) if any(texts) else ((), ())
            got = tool.align(list(texts))
            starts = [np.searchsorted(d, np.arange(len(texts))) for d in got.doc]
            for x, y, shared in got.links(kind):
                doc = got.doc[0][x]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()).take(pa.array(doc)), pa.array(x - starts[0][doc]), pa.array(y - starts[1][doc]),
                    pa.array(got.ids[0][x], pa.int32()), pa.array(got.ids[1][y], pa.int32()), pa.array(shared)],
                    schema=_LINKS)

    return _texts(docs, id).mapInArrow(run, "id long, a_place long, b_place long, a int, b int, shared long")


# --- documents and the corpus -------------------------------------------------------------------

_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]
_BLOCK = ("block long, pairs array<long>, docs array<int>, ids array<long>, " + ", ".join(f"{c} array<long>" for c in _COUNTS)
          + ", sha array<string>, indptr binary, indices binary, times binary")
_BLOCK_ARROW = pa.schema(
    [("block", pa.int64()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64()))]
    + [(c, pa.list_(pa.int64())) for c in _COUNTS] + [("sha", pa.list_(pa.string()))]
    + [(c, pa.binary()) for c in ("indptr", "indices", "times")])


class _Block:
    """Documents up to BLOCK_BYTES, their numbers, and the chunks that they hold."""

    def __init__(self, known: Chunks):
        self.known, self.size = known, 0
        self.ids, self.texts = [], []

    def add(self, ids: list, texts: list[str], size: int) -> None:
        self.ids += ids
        self.texts += [np.array([self.known[c] for c in chunks(t)], np.int64) if t else np.zeros(0, np.int64) for t in texts]
        self.size += size

    def row(self, block: int) -> pa.RecordBatch:
        known, n = self.known, len(self.texts)
        known.learn()
        held = [x if known.whole[x].all() else x[:0] for x in self.texts]
        sha = [hashlib.sha256(b";".join([known.spelled[i] for i in x.tolist()])).hexdigest() if len(x) else "" for x in held]
        doc, chunk = np.repeat(np.arange(n), [len(x) for x in held]), np.concatenate(held)
        counts = [np.bincount(doc, weights=known.counts[chunk, i], minlength=n).astype(np.int64) for i in range(len(_COUNTS))]
        # documents over their chunks, times chunks over their pairs
        used, at = np.unique(chunk, return_inverse=True)
        key, times = np.unique(doc * max(len(used), 1) + at, return_counts=True)
        row = np.searchsorted(key, np.arange(n + 1) * max(len(used), 1))
        of_docs = Csr(row, key % max(len(used), 1), times, len(used))
        sizes = np.diff(known.pairs.indptr)[used]
        place = np.arange(sizes.sum()) + np.repeat(known.pairs.indptr[used] - np.cumsum(sizes) + sizes, sizes)
        pairs, column = np.unique(known.pairs.indices[place], return_inverse=True)
        of_chunks = Csr(np.concatenate([[0], np.cumsum(sizes)]), column, known.pairs.values[place], len(pairs))
        parts = [[np.zeros(0, np.int64)] for _ in range(3)]
        for run in multiply(of_docs, of_chunks):
            for part, values in zip(parts, run):
                part.append(values)
        doc, at, times = map(np.concatenate, parts)
        indptr = np.searchsorted(doc, np.arange(n + 1))
        few = np.int32 if times.max(initial=0) < 2 ** 31 else np.int64
        values = [block, pairs, np.bincount(at, minlength=len(pairs)).astype(np.int32), self.ids, *counts, sha,
                  indptr.astype(np.int64).tobytes(), at.astype(np.int32).tobytes(),
                  np.dtype(few).char.encode() + times.astype(few).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK_ARROW)], schema=_BLOCK_ARROW)


def blocks(docs: DataFrame, id: str = "doc_id", byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """Documents in blocks, as a table that is written: blocks are named by task and place, so they are fixed by it."""
    files = _files(docs, byte_bpe, pieces)

    def run(batches):
        known, n = Chunks(aligner(*files.value)), TaskContext.get().partitionId() << 32
        block = _Block(known)
        for some in _some(batches):
            block.add(*some)
            if block.size >= BLOCK_BYTES:
                yield block.row(n)
                known = known if known.size < REMEMBERED else Chunks(known.tool)
                block, n = _Block(known), n + 1
        if block.ids:
            yield block.row(n)

    return common.materialize(_texts(docs, id).mapInArrow(run, _BLOCK), "alignment")


def pair_counts(blocked: DataFrame) -> DataFrame:
    """(pair, count, best): documents of the corpus that hold a pair linked, and whether no pair of its A id has more."""
    each = blocked.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = common.materialize(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count")), "pairs")
    a = F.shiftright("pair", 32)
    # an A id has at most as many pairs as B has ids
    best = counts.groupBy(a.alias("a")).agg(F.max("count").alias("most"))
    counts = counts.withColumn("a", a).join(best.hint("merge"), "a")
    return counts.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


_DOC_ARROW = pa.schema([("id", pa.int64())] + [(c, pa.int64()) for c in _COUNTS]
                       + [("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def _sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's matrix times its pairs' counts, and times whether they are best."""
    row = {c: left.column(c)[0] for c in left.column_names}
    indptr = np.frombuffer(row["indptr"].as_py(), np.int64)
    at = np.frombuffer(row["indices"].as_py(), np.int32)
    packed = row["times"].as_py()
    times = np.frombuffer(packed[1:], np.dtype(packed[:1].decode())).astype(np.int64)
    place = right.column("place").to_numpy()
    out = []
    for name in ("best", "count"):
        per_pair = np.zeros(len(place), np.int64)
        per_pair[place] = right.column(name).to_numpy().astype(np.int64)
        total = np.concatenate([[0], np.cumsum(times * per_pair[at])])
        out.append(pa.array(total[indptr[1:]] - total[indptr[:-1]]))
    return pa.Table.from_arrays([row["ids"].values, *(row[c].values for c in _COUNTS), *out, row["sha"].values], schema=_DOC_ARROW)


def align(docs: DataFrame, id: str = "doc_id", byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """A row per document: tokens of both sides, groups, links of both kinds, and its links' corpus-wide counts."""
    blocked = blocks(docs, id, byte_bpe, pieces)
    asked = blocked.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(blocked).hint("merge"), "pair").select(F.col("block").alias("home"), "place", "count", "best")
    rows = blocked.drop("pairs", "docs")
    return rows.groupBy("block").cogroup(answers.groupBy("home")).applyInArrow(
        _sums, "id long, " + ", ".join(f"{c} long" for c in [*_COUNTS, "n_best", "count_sum"]) + ", groups_sha256 string")


def digest(aligned: DataFrame) -> DataFrame:
    return aligned.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
                          "n_group_links")
