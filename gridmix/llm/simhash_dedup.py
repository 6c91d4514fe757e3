"""SimHash near-duplicates by a range join in a space of segment bit counts.

A fingerprint is cut into segments and mapped to the vector of their bit counts.  Two fingerprints that differ
in k bits lie at Manhattan distance k or less there, so that distance is a lower bound of theirs.  With two
halves of the vector, one half lies within k // 2.  The grid has a cell for every vector of a half.  Each
fingerprint enters its own cell and those within half of that distance, so any two within k // 2 meet
in a cell between them.  Pairs that meet are kept if their whole vectors lie within k, then if their
fingerprints do.

Copies share a fingerprint and enter once.  A cell whose members exceed ``CELL_LIMIT`` is dealt out
anew as pairs of chunks, so no group is held whole by one task and no pair is lost.  Of the links found in a batch a
spanning forest is passed on, never all pairs.

Defined results: null and wordless texts have fingerprint 0, linked like any other; rows that repeat are kept,
one result each; a null id is kept, and a component's id is the smallest id that is not null (null if there
is none); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm import common

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Bits of a segment and segments of a fingerprint.
SEGMENT_BITS, SEGMENTS = 2, 32
HALF = SEGMENTS // 2
#: Members of a cell that one task compares at once; beyond it the cell is dealt out as pairs of chunks.
CELL_LIMIT = 4096
#: Shingles hashed at once, for long texts.
CHUNK = 1 << 18

#: For every byte, which of its bits are set.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LOW = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the XXH64 values of the text's word shingles; 0 without words."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    digest, ones = xxhash.xxh64_intdigest, np.zeros((8, 8), dtype=np.int64)
    for at in range(0, n, CHUNK):
        some = w[at:at + CHUNK + words - 1]
        shingles = map(b" ".join, zip(*[some[i:] for i in range(words)])) if len(w) >= words else [b" ".join(w)]
        h = np.array([digest(s, SEED) for s in shingles], dtype=np.uint64).view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            ones[byte] += np.bincount(h[:, byte], minlength=256) @ _BITS
    return int(np.packbits((2 * ones > n).reshape(-1), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp.view(np.int64))], names=["id", "fp"])


def fingerprints(docs: DataFrame, id: str = "doc_id", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the fingerprint of every whole text as a signed long."""
    rows = docs.select(F.col(id).alias("id"), F.col("text").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lambda b: _fingerprints(b, words), f"id {kind}, fp long")


def embed(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the segments, (n, SEGMENTS)."""
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fp), SEGMENTS, SEGMENT_BITS).sum(axis=2, dtype=np.int8)


def manhattan(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of the embedded x and y: in unary, two counts differ in as many bits as they differ by."""
    def unary(v):
        return ((v | v >> np.uint64(1)) & _LOW) | ((v & v >> np.uint64(1)) & _LOW) << np.uint64(1)

    return np.bitwise_count(unary(x) ^ unary(y))


def cells(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, position in fp): the cells that each fingerprint enters, each once."""
    counts, powers = embed(fp).astype(np.int64), 3 ** np.arange(HALF, dtype=np.int64)
    steps = (max_bits // 2 + 1) // 2
    out = []
    for half in range(2):
        c = counts[:, half * HALF:(half + 1) * HALF]
        at, who = [c], [np.arange(len(fp))]
        for _ in range(steps):
            more, whose = [], []
            for axis in range(HALF):
                for move in (-1, 1):
                    ok = (at[-1][:, axis] + move >= 0) & (at[-1][:, axis] + move <= SEGMENT_BITS)
                    moved = at[-1][ok].copy()
                    moved[:, axis] += move
                    more.append(moved)
                    whose.append(who[-1][ok])
            at.append(np.concatenate(more))
            who.append(np.concatenate(whose))
        key = np.concatenate(at) @ powers + half * 3 ** HALF
        owner = np.concatenate(who)
        if steps > 1:  # two ways to one cell
            key, owner = np.unique(np.stack([key, owner]), axis=1)
        out.append((key, owner))
    return np.concatenate([k for k, _ in out]), np.concatenate([o for _, o in out])


def _enter(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        for at in range(0, len(fp), 4096):
            some = np.ascontiguousarray(fp[at:at + 4096])
            key, owner = cells(some.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[owner])], names=["cell", "fp"])


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Those of the links (a, b) that join two trees."""
    parent: dict[int, int] = {}

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[rx] = ry
            kept.append((x, y))
    return kept


def _links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows with equal keys; rows are sorted by key."""
    bits, at, lag, found = fp.view(np.uint64), np.arange(len(key)), 0, []
    while len(at):
        lag += 1
        at = at[at + lag < len(key)]
        at = at[key[at] == key[at + lag]]
        near = at[manhattan(bits[at], bits[at + lag]) <= max_bits]
        near = near[np.bitwise_count(bits[near] ^ bits[near + lag]) <= max_bits]
        found += zip(fp[near].tolist(), fp[near + lag].tolist())
        if len(found) > 200_000:  # bounded memory in a dense cell
            found = _forest(*np.array(found, dtype=np.int64).T)
    return _forest(*np.array(found, dtype=np.int64).T) if found else []


def _meet(batches: Iterator[pa.RecordBatch], max_bits: int, limit: int | None) -> Iterator[pa.RecordBatch]:
    """Links of cells that arrive sorted.  Rows of cells over the limit come out as they are (link null)."""
    def out(links, key=(), fp=()):
        n, m = len(links), len(key)
        columns = [[*[None] * n, *key], [*[x for x, _ in links], *fp], [*[y for _, y in links], *[None] * m]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cell", "a", "b"])

    key, fp, over = np.empty(0, np.int64), np.empty(0, np.int64), None
    for batch in batches:
        k, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "fp"))
        if over is not None:  # the rest of a cell that is over the limit already
            n = int(np.searchsorted(k, over, "right"))
            if n:
                yield out([], k[:n].tolist(), f[:n].tolist())
            if n == len(k):
                continue
            k, f, over = k[n:], f[n:], None
        key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
        last = int(np.searchsorted(key, key[-1], "left"))  # the last cell may go on in the next batch
        if limit is not None and len(key) - last > limit:
            over = key[-1]
            yield out([], key[last:].tolist(), fp[last:].tolist())
            key, fp = key[:last], fp[:last]
        if last:
            yield from _emit(key[:last], fp[:last], max_bits, limit, out)
            key, fp = key[last:], fp[last:]
    if len(key):
        yield from _emit(key, fp, max_bits, limit, out)


def _emit(key, fp, max_bits, limit, out):
    if limit is not None:
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        if (n > limit).any():
            large = np.repeat(n > limit, n)
            yield out([], key[large].tolist(), fp[large].tolist())
            key, fp = key[~large], fp[~large]
    yield out(_links(key, fp, max_bits))


_MEETING = "cell long, a long, b long"


def links(nodes: DataFrame, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that differ in max_bits or fewer bits."""
    spark = nodes.sparkSession
    entered = nodes.select("fp").mapInArrow(lambda b: _enter(b, max_bits), "cell long, fp long")
    met = (entered.repartition(common.partitions(spark), "cell").sortWithinPartitions("cell", "fp")
           .mapInArrow(lambda b: _meet(b, max_bits, cell_limit), _MEETING))
    with common.narrow_batches(spark):
        met = common.materialize(met, "met")
        # cells over the limit: chunks of half of it, every pair of chunks a group of its own
        over = met.filter("cell is not null").select("cell", F.col("a").alias("fp"))
        chunks = over.groupBy("cell").agg(F.ceil(F.count("*") / (cell_limit / 2)).cast("int").alias("chunks"))
        own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        dealt = (over.join(chunks, "cell").withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                 .select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "fp"))
        rest = (dealt.repartition(common.partitions(spark), "cell").sortWithinPartitions("cell", "fp")
                .mapInArrow(lambda b: _meet(b, max_bits, None), _MEETING))
        found = met.filter("cell is null").select("a", "b")
        if over.limit(1).count():
            found = found.unionByName(common.materialize(rest, "met").select("a", "b"))
    return found


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(id, fp, component): every row with its fingerprint and the smallest id linked to it, itself included."""
    spark = docs.sparkSession
    prints = common.materialize(fingerprints(docs, "doc_id", words), "fingerprints")
    nodes = common.materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = common.connected_components(links(nodes, max_bits, cell_limit))
    rooted = common.materialize(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left"), "rooted")
    alone, linked = rooted.filter("root is null"), rooted.filter("root is not null")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    component = alone.selectExpr("fp", "least as component").unionByName(
        common.dealt_join(linked, least, "root", "fp").select("fp", "component"))  # a component may hold most of the links
    component = common.materialize(component, "components")
    spark.conf.set(common.ARROW_ROWS, str(common.TEXT_BATCH_ROWS))
    return prints.join(component, "fp")


def digest(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: that with the smallest id (of rows that share it, that with the smallest digest
    of its text), rows without an id last."""
    key = common.row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumn("llm_key_", key)
    by_key = keyed.select(F.col("llm_key_").alias("doc_id"), "text")
    found = near_duplicates(by_key, words, max_bits).join(
        keyed.select(F.col("llm_key_").alias("id"), F.col("doc_id").alias("number")).distinct(), "id")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("number").isNull(), "number", "id")).alias("first"))
    kept = common.materialize(first.select(F.col("first.id").alias("llm_key_")), "kept")
    return keyed.join(kept.hint("merge"), "llm_key_", "left_semi").dropDuplicates(["llm_key_"]).select(*[f"`{c}`" for c in docs.columns])
