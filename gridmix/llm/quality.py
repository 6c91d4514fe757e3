"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Every whole text gives a vector of statistics.  Random Fourier features of the standardised vector approximate a
Gaussian kernel.  Ridge scores come from normal equations: each task sums its rows' outer products, and sums
of tasks are added up by rows of the matrix, so what reaches the driver has the size of the matrix alone.  Isotonic
regression maps raw scores to probabilities, on labelled rows that the ridge has not seen.

Labels are learnt from rows whose crc32(doc_id as text) mod ``FOLDS`` is not ``HELD_OUT`` only; the fold ``CALIBRATION`` is for
the calibration.  Inputs of a score are the text's statistics and nothing else.

Defined results: a null text is empty; an empty text has a score like any other; a null label is no label, and where rows of labels repeat a
document, each counts; a null id is scored and never learnt from; without labels every score is ``PRIOR``; an
empty table gives an empty result; further columns are ignored by ``score`` and kept by ``scored``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.llm import common

FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
THRESHOLD = 0.3
PRIOR = 0.5
#: Random features, the kernel's width in standard deviations, and the ridge.
DIMENSIONS = 256
WIDTH = 4.0
RIDGE = 1.0
SEED = 10
#: Raw scores are binned for the calibration: this many bins to a unit, so what is collected is bounded.
BINS = 200
#: A document's statistics, as a column beside its own ones.
MEASURED = "llm_statistics_"

STATISTICS = (
    "log_chars", "log_words", "word_length", "long_words", "distinct_words", "top_word", "top_pair", "repeats",
    "distinct_lines", "log_lines", "line_length", "short_lines", "line_ends", "upper", "digits", "punctuation",
    "sentence_ends", "shouts", "symbols", "bars", "spaces", "beyond_ascii", "letters", "upper_words",
    "word_variance", "distinct_pairs", "entropy", "hashes", "brackets", "bullets")

_UPPER, _DIGIT, _LETTER = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = True


def _of(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SETS = {"digits": _DIGIT, "upper": _UPPER, "letters": _LETTER, "spaces": _of(b" \t\n\r\x0b\x0c"),
         "punctuation": _of(b".,;:!?"), "sentence_ends": _of(b".!?"), "shouts": _of(b"!?"), "bars": _of(b"|"),
         "symbols": _of(b"#$%&*+/<=>@\\^_`~"), "hashes": _of(b"#"), "brackets": _of(b"()[]{}")}
_BULLET = re.compile(rb"\s*(?:[-*\x95|>]|\xe2\x80\xa2|\d+[.)])")


def statistics(text: str | None) -> list[float]:
    """The values of STATISTICS for a whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = {name: float(counts[which].sum()) / n for name, which in _SETS.items()}
    words = data.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    tally = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x.strip() for x in data.split(b"\n")]
    lines = [x for x in lines if x]
    m = max(1, len(lines))
    p = counts[counts > 0] / n
    return [
        float(np.log1p(len(data))), float(np.log1p(len(words))), float(lengths.mean()), float((lengths > 12).mean()),
        len(tally) / w, max(tally.values(), default=0) / w, max(pairs.values(), default=0) / w,
        sum(map(bytes.__eq__, words, words[1:])) / w, len(set(lines)) / m, float(np.log1p(len(lines))),
        float(np.log1p(len(data) / m)), sum(len(x) < 30 for x in lines) / m, sum(x.endswith((b".", b"!", b"?")) for x in lines) / m,
        share["upper"], share["digits"], share["punctuation"], share["sentence_ends"], share["shouts"], share["symbols"],
        share["bars"], share["spaces"], float(counts[128:].sum()) / n, share["letters"],
        sum(x.isupper() for x in words) / w, float(np.log1p(lengths.std())), len(pairs) / w,
        float(-(p * np.log2(p)).sum()), share["hashes"], share["brackets"],
        sum(bool(_BULLET.match(x)) for x in lines) / m]


def statistics_of(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, x): the statistics of every document."""
    rows = docs.select(F.col(id).alias("id"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>")


@dataclass
class Model:
    """What scores need: the scale of the statistics, ridge weights, and the calibration's steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    chance: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.raw):
            return np.full(len(x), PRIOR)
        return np.interp(fourier(x, self.mean, self.scale) @ self.weights, self.raw, self.chance)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A constant and random Fourier features: cosines of random projections with random phases."""
    rng = np.random.default_rng(SEED)
    d = len(mean)
    directions = rng.normal(size=(d, DIMENSIONS)) / WIDTH
    phases = rng.uniform(0, 2 * np.pi, DIMENSIONS)
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([np.ones((len(x), 1)), z / 8, np.sqrt(2 / DIMENSIONS) * np.cos(z @ directions + phases)])


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return np.array(batch.column(column).to_pylist(), float).reshape(batch.num_rows, len(STATISTICS))


def _equations(batches: Iterator[pa.RecordBatch], mean: np.ndarray, scale: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of the task's sum of outer products of (features, label)."""
    total = None
    for batch in batches:
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        z = np.hstack([fourier(_matrix(batch), mean, scale), y[:, None]])
        total = z.T @ z if total is None else total + z.T @ z
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "row"])


def _added(table: pa.Table) -> pa.Table:
    """One row of the matrix: the tasks' sums added up."""
    row = sum(np.frombuffer(r, float) for r in table.column("row").to_pylist())
    return pa.table({"i": table.column("i")[:1], "row": pa.array([row.tobytes()], pa.binary())})


def _binned(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Labelled rows as bins of their raw scores."""
    for batch in batches:
        raw = fourier(_matrix(batch), model.mean, model.scale) @ model.weights
        bins = np.clip(np.floor(raw * BINS), -4 * BINS, 5 * BINS).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y").cast(pa.int64())], names=["bin", "y"])


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to the values, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for v, w in zip(value, weight):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.empty(0)


def fit(x: DataFrame, labels: DataFrame) -> Model:
    """Learn from the statistics (id, x) of the labelled training rows."""
    spark = x.sparkSession
    fold = common.crc_mod(F.col("id"), FOLDS)
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y")).filter("y in (0, 1)")
    rows = common.materialize(x.join(known, "id").withColumn("fold", fold)
                              .filter((F.col("fold") != HELD_OUT) & (F.col("fold") >= 0)).select("fold", "x", "y"), "labelled")
    columns = [F.element_at("x", i + 1) for i in range(len(STATISTICS))]
    sums = rows.agg(F.count("*"), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    none = np.empty(0)
    d = len(STATISTICS)
    if not sums[0]:
        return Model(none, none, none, none, none)
    mean, scale = np.array(sums[1:1 + d]), np.array(sums[1 + d:])
    scale = np.where(scale > 1e-9, scale, 1.0)
    ridge_rows = rows.filter(F.col("fold") != CALIBRATION)
    with common.narrow_batches(spark):
        parts = (ridge_rows.mapInArrow(lambda b: _equations(b, mean, scale), "i int, row binary")
                 .groupBy("i").applyInArrow(_added, "i int, row binary"))
        matrix = [np.frombuffer(r.row, float) for r in parts.orderBy("i").collect()]  # DIMENSIONS rows at most
        if not matrix:
            return Model(mean, scale, none, none, none)
        m = np.array(matrix)
        a, b = m[:-1, :-1], m[:-1, -1]
        penalty = np.full(len(a), RIDGE)
        penalty[0] = 0.0
        model = Model(mean, scale, np.linalg.lstsq(a + np.diag(penalty), b, rcond=None)[0], none, none)
        calibration = rows.filter(F.col("fold") == CALIBRATION)
        if not calibration.limit(1).count():
            calibration = ridge_rows  # too few labels for a fold of its own
        bins = (calibration.mapInArrow(lambda b: _binned(b, model), "bin long, y long")
                .groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect())
    model.raw = (np.array([r.bin for r in bins], float) + 0.5) / BINS
    model.chance = isotonic(np.array([r.y for r in bins]), np.array([r.n for r in bins], float))
    return model


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    x = common.materialize(statistics_of(docs, id), "statistics")
    model = fit(x, labels)
    kind = x.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(_matrix(batch)))], names=["id", "score"])

    scored = x.mapInArrow(run, f"id {kind}, score double")
    return scored.select("id", (common.crc_mod(F.col("id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def digest(scored: DataFrame) -> DataFrame:
    return scored.withColumnRenamed("id", "doc_id")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold.

    Documents are written once beside their statistics, so each text is measured once and no text is shuffled; only labelled
    statistics move.
    """
    schema = T.StructType([*docs.schema.fields])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([statistics(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, x], names=[*batch.schema.names, MEASURED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = model.score(_matrix(batch, MEASURED)) >= THRESHOLD if batch.num_rows else np.empty(0, bool)
            yield batch.drop_columns([MEASURED]).filter(pa.array(good))

    measured = docs.mapInArrow(measure, T.StructType([*schema, T.StructField(MEASURED, T.ArrayType(T.DoubleType()))]))
    measured = common.materialize(measured, "measured")
    model = fit(measured.select(F.col("doc_id").alias("id"), F.col(MEASURED).alias("x")), labels)
    return measured.mapInArrow(run, schema)
