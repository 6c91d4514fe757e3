"""Exact top-k by inner product with block-at-a-time pruning.

Vectors are seen as documents whose terms are their dimensions.  Ranges of ids form blocks; a block keeps its
vectors (its forward index) and each term's largest and smallest weight.  For a query, the sum over terms of its
weight times the block's extreme is a bound on every score in the block.  A query goes through the blocks by falling
bound, scores them through the forward index, and stops when the bound falls below its kth score.

Queries are packed into tiles and blocks into groups.  Tiles meet groups in an equi-join that streams
(a tile and a group are a few MB), so nothing that grows with the data is broadcast or held by a task.  A first
pass scores each query in its own group, which gives every other group a kth score to prune against.

Defined results: vectors that are null or hold null or non-finite components, and rows with a null id, take
no part; rows equal in id and vector count once, and a query's candidates exclude its id; shorter vectors count as padded with zeros;
an empty vector scores 0; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmix.llm import common

K = 5
EVERY = 50
SCALE = 256
BLOCK = 256
#: Blocks of a group and queries of a tile.
GROUP = 64
TILE = 2048

_PACKED = "n int, dims int, kind string, ids binary, floors binary, vectors binary"
_HITS = "query_id long, vec_id long, score long"


def vectors(table: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): integer vectors of the rows that take part."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (table.select(F.col(id).cast("long").alias("vec_id"), x.alias("x"))
            .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~bad)
            .select("vec_id", F.transform("x", lambda c: F.floor(c * float(SCALE))).alias("v")).distinct())


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows as one row: ids, floors and a matrix of the narrowest integers that hold it."""
    def packed(ids, rows, floors):
        dims = max(len(r) for r in rows)
        m = np.zeros((len(rows), dims), np.int64)
        for i, r in enumerate(rows):
            m[i, :len(r)] = r
        kind = np.int16 if np.abs(m).max(initial=0) < 2 ** 15 else np.int64
        return pa.RecordBatch.from_pydict({
            "n": pa.array([len(rows)], pa.int32()), "dims": pa.array([dims], pa.int32()),
            "kind": pa.array([np.dtype(kind).name]), "ids": pa.array([np.array(ids, np.int64).tobytes()]),
            "floors": pa.array([np.array(floors, np.float64).tobytes()]),
            "vectors": pa.array([m.astype(kind).tobytes()])})

    held: tuple[list, list, list] = ([], [], [])
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "v", "floor"))):
            for into, value in zip(held, row):
                into.append(value)
            if len(held[0]) == size:
                yield packed(*held)
                held = ([], [], [])
    if held[0]:
        yield packed(*held)


def pack(rows: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, v, floor) packed by ranges of ids, ``size`` to a row (fewer at the end of a task's range)."""
    ranged = rows.repartitionByRange(common.partitions(rows.sparkSession), "vec_id").sortWithinPartitions("vec_id")
    return ranged.mapInArrow(lambda b: _pack(b, size), _PACKED)


def _unpack(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, floors = (np.frombuffer(row[prefix + c], t) for c, t in (("ids", np.int64), ("floors", np.float64)))
    m = np.frombuffer(row[prefix + "vectors"], row[prefix + "kind"]).reshape(row[prefix + "n"], row[prefix + "dims"])
    return ids, floors, m.astype(np.float64)


def _best(q: np.ndarray, s: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best (query, score, id) of every query, with their ranks."""
    order = np.lexsort((i, -s, q))
    q, s, i = q[order], s[order], i[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
    keep = rank < k
    return q[keep], s[keep], i[keep], rank[keep]


def search(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, matrix: np.ndarray, ids: np.ndarray,
           k: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(position of the query, score, id) of a query's k best here, and how many query-block pairs were scored.

    A floor is a score that the query's kth best is known to reach (-inf if none); lower scores are left out.
    Sums of products of integers are exact in doubles below 2 ** 53.
    """
    width = max(queries.shape[1], matrix.shape[1])
    queries, matrix = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, matrix))
    starts = np.arange(0, len(ids), block)
    up, low = np.maximum.reduceat(matrix, starts, axis=0), np.minimum.reduceat(matrix, starts, axis=0)
    bound = np.maximum(queries, 0) @ up.T + np.minimum(queries, 0) @ low.T  # (queries, blocks)
    order = np.argsort(-bound, axis=1, kind="stable")
    kth, every, scored = floors.copy(), np.arange(len(queries)), 0
    q, s, i = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
    for r in range(len(starts)):
        chosen = order[:, r]
        active = np.flatnonzero(bound[every, chosen] >= kth)
        if not len(active):
            break
        parts = [(q, s, i)]
        for b in np.unique(chosen[active]):
            who, part = active[chosen[active] == b], slice(starts[b], starts[b] + block)
            score = queries[who] @ matrix[part].T
            own = query_ids[who][:, None] == ids[part][None, :]
            row, column = np.nonzero((score >= kth[who][:, None]) & ~own)
            parts.append((who[row], score[row, column], ids[part][column]))
            scored += len(who)
        q, s, i, rank = _best(*(np.concatenate(x) for x in zip(*parts)), k)
        kth[q[rank == k - 1]] = np.maximum(kth[q[rank == k - 1]], s[rank == k - 1])
    return q, s, i, scored


def _own(batches: Iterator[pa.RecordBatch], k: int, every: int) -> Iterator[pa.RecordBatch]:
    """kth scores of a group's own queries within the group."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, _, m = _unpack(row)
            mine = np.flatnonzero(ids % every == 0)
            if not len(mine):
                continue
            q, s, i, _ = search(m[mine], ids[mine], np.full(len(mine), -np.inf), m, ids, k)
            q, s, i, rank = _best(q, s, i, k)
            last = rank == k - 1
            yield pa.RecordBatch.from_pydict({"vec_id": pa.array(ids[mine][q[last]]), "floor": pa.array(s[last])})


def _score(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            query_ids, floors, queries = _unpack(row, "q_")
            ids, _, matrix = _unpack(row)
            q, s, i, _ = search(queries, query_ids, floors, matrix, ids, k)
            yield pa.RecordBatch.from_pydict({"query_id": pa.array(query_ids[q]), "vec_id": pa.array(i),
                                              "score": pa.array(s.astype(np.int64))})


def top_k(table: DataFrame, k: int = K, every: int = EVERY, id: str = "vec_id", vector: str = "embedding",
          group: int = GROUP, tile: int = TILE) -> DataFrame:
    """(query_id, rank, vec_id, score): for ids divisible by ``every`` the k best others."""
    spark = table.sparkSession
    rows = common.materialize(vectors(table, id, vector), "vectors")
    none = F.lit(float("-inf")).alias("floor")
    spark.conf.set(common.ARROW_ROWS, "4096")
    groups = common.materialize(pack(rows.select("vec_id", "v", none), BLOCK * group), "groups")
    spark.conf.set(common.ARROW_ROWS, "4")  # packed rows are a few MB each
    floors = common.materialize(groups.mapInArrow(lambda b: _own(b, k, every), "vec_id long, floor double")
                                .groupBy("vec_id").agg(F.max("floor").alias("floor")), "floors")
    spark.conf.set(common.ARROW_ROWS, "4096")
    queries = rows.filter(F.col("vec_id") % every == 0).join(floors, "vec_id", "left")
    tiles = common.materialize(pack(queries.select("vec_id", "v", F.coalesce("floor", none).alias("floor")), tile),
                               "tiles")
    spark.conf.set(common.ARROW_ROWS, "4")
    # every group gets every tile: groups lie in numbered slots, and tiles go to all slots
    slots = max(1, groups.count())
    slot = F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int").alias("slot")
    dealt = tiles.select(F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
                         *[F.col(c).alias(f"q_{c}") for c in tiles.columns])
    met = dealt.join(groups.select(slot, "*"), "slot")
    hits = common.materialize(met.mapInArrow(lambda b: _score(b, k), _HITS), "hits")
    spark.conf.set(common.ARROW_ROWS, str(common.TEXT_BATCH_ROWS))
    best = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (hits.distinct().withColumn("rank", best).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


ORACLE = f"""
with parts as (
    select distinct vec_id, [cast(floor({SCALE} * cast(x as double)) as bigint) for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
terms as (select vec_id, unnest(v) as x, generate_subscripts(v, 1) as d from parts),
scores as (
    select q.vec_id as query_id, c.vec_id as vec_id, cast(sum(q.x * c.x) as bigint) as score
    from terms q join terms c on q.d = c.d and q.vec_id <> c.vec_id
    where q.vec_id % {EVERY} = 0 group by 1, 2)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank,
       vec_id, score
from scores
qualify row_number() over (partition by query_id order by score desc, vec_id) <= {K}
"""
