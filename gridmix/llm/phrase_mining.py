"""Phrase collocations from unions of weighted acyclic automata.

Tasks count the phrases of shards of text and build an automaton of each shard's sorted phrases (``count_transducer``).  It is cut by
ranges of prefixes, which is how it is dealt out: the slices of a range meet in one place, where they are united and
their weights summed, a few at a time.  Phrases below ``LEAST`` go, and what is left of the range is again an automaton.

A phrase is scored by its parts.  Each range asks for the parts of its phrases by an automaton of these, cut by ranges; a range
composes what it is asked with its own, and the asking range gets its parts back with their counts.  So a word that very many
phrases share is asked for once by each range.

The cuts are quantiles of (language, first word, second word) in a sample of texts.  They only steer how even the
ranges are: every phrase of every text is counted, wherever the cuts lie.  There is one for every ``RANGE_BYTES`` of text (about 30
bytes each, which is what the driver collects and tasks are sent).  A range is never finer than one pair of words, whose
phrases are summed by shard before.

Defined results: a null text is empty, a null language is ``und``; rows that repeat count each time; texts without words give
nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmix.llm import common
from gridmix.llm import count_transducer as ct

LONGEST, LEAST, TOP = 3, 10, 2000
#: A phrase goes if a longer one around it has this share of its count, in hundredths.
INSIDE_SHARE = 50
SCALE = 1_000_000
UNKNOWN = "und"
#: Tokens of a shard, bytes that are split at once, phrases that wait for a union.
SHARD_TOKENS, SPLIT_BYTES, PENDING = 1 << 22, 4 << 20, 1 << 22
RANGE_BYTES = 32 << 20
#: Texts that the cuts are taken from: so many, and so many a range.
CUT_TEXTS, CUT_TEXTS_A_RANGE = 1000, 2
#: Automata in an Arrow batch.
AUTOMATA_ROWS = 8
#: Parts into which a language's candidates are dealt before its last ranking.
DEALT = 64

# Fixed values of the contract: what ends a piece (becomes the mark), what parts words (becomes a space), A-Z.
_MARK = b"\xff"  # in no UTF-8 text
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", _MARK * 10 + b" abcdefghijklmnopqrstuvwxyz")


def split(text: str) -> Iterator[list[bytes]]:
    """Words with marks between pieces; a long text in several lists, each but the last ending in a mark."""
    data = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while at < len(data):
        end = data.find(_MARK, at + SPLIT_BYTES)
        end = len(data) if end < 0 else end + 1
        yield data[at:end].replace(_MARK, b" \xff ").split()
        at = end


class _Ids(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class Shard:
    """Tokens of some texts by language."""

    def __init__(self):
        self.ids, self.tokens, self.size = _Ids({_MARK: 0}), {}, 0

    def add(self, lang: str, text: str) -> None:
        held, ids = self.tokens.setdefault(lang, []), self.ids
        for words in split(text):
            held.append(np.array([ids[w] for w in words], np.int32))
            self.size += len(words)
        held.append(np.zeros(1, np.int32))

    def levels(self, longest: int) -> Iterator[tuple[str, ct.Levels]]:
        """(language, its counted phrases)."""
        words = list(self.ids)
        order = sorted(range(1, len(words)), key=words.__getitem__)
        rank = np.full(len(words), -1, np.int64)
        rank[order] = np.arange(len(order))
        vocabulary = [words[i] for i in order]
        for lang in sorted(self.tokens):
            yield lang, ct.from_tokens(rank[np.concatenate(self.tokens[lang])], vocabulary, longest)


_SLICES = pa.schema([("range", pa.int32()), ("origin", pa.int32()), ("lang", pa.string()), ("words", pa.int64()),
                     ("automaton", pa.binary())])
SLICES = "range int, origin int, lang string, words long, automaton binary"


def _slice(range_: int, origin: int, lang: str, levels: ct.Levels, words: int = 0) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip((range_, origin, lang, words, ct.pack(levels)), _SLICES)], schema=_SLICES)


def _shards(batches: Iterator[pa.RecordBatch], cuts, longest: int) -> Iterator[pa.RecordBatch]:
    """Slices of the automata of shards."""
    def out(shard):
        for lang, levels in shard.levels(longest):
            for r, part in ct.ranges(levels, lang, cuts.value):
                yield _slice(r, -1, lang, part)

    shard = Shard()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            shard.add(lang, text)
            if shard.size >= SHARD_TOKENS:
                yield from out(shard)
                shard = Shard()
    yield from out(shard)


def _union(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Slices sorted by (range, language), united: a row each, with the number of words and the phrases of ``least`` or more."""
    now, parts, waiting = None, [], 0

    def done():
        whole = ct.union(parts)
        return _slice(*now[:1], -1, now[1], ct.at_least(whole, least), int(whole.count[0].sum()))

    for batch in batches:
        for r, lang, data in zip(*(batch.column(c).to_pylist() for c in ("range", "lang", "automaton"))):
            if now != (r, lang):
                if parts:
                    yield done()
                now, parts, waiting = (r, lang), [], 0
            parts.append(ct.unpack(data))
            waiting += parts[-1].size
            if waiting >= PENDING:
                parts, waiting = [ct.union(parts)], 0
    if parts:
        yield done()


@contextmanager
def _few_rows(spark):
    """Small Arrow batches for the action inside: a row is an automaton."""
    spark.conf.set(common.ARROW_ROWS, str(AUTOMATA_ROWS))
    try:
        yield
    finally:
        spark.conf.set(common.ARROW_ROWS, str(common.TEXT_BATCH_ROWS))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word with the one behind it in its piece (or nothing)."""
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for words in split(text):
                then = [b"" if w == _MARK else w for w in [*words[1:], _MARK]]
                rows = [(a, b) for a, b in zip(words, then) if a != _MARK]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(rows), pa.string()), "a": pa.array([a for a, _ in rows], pa.binary()),
                    "b": pa.array([b for _, b in rows], pa.binary())})


def find_cuts(texts: DataFrame, range_bytes: int) -> list[tuple[str, bytes, bytes]]:
    """Sorted (language, first word, second word) between ranges of about as much text."""
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    k = max(-(-size // range_bytes), common.partitions(texts.sparkSession))
    share = min(1.0, max(CUT_TEXTS, CUT_TEXTS_A_RANGE * k) / max(n, 1))
    pairs = texts.sample(share, 13).mapInArrow(_pairs, "lang string, a binary, b binary")
    firsts = (pairs.repartitionByRange(k, "lang", "a", "b").groupBy(F.spark_partition_id().alias("part"))
              .agg(F.min(F.struct("lang", "a", "b")).alias("first")))
    return sorted({(r.first["lang"], bytes(r.first["a"]), bytes(r.first["b"])) for r in firsts.collect()})[1:]


def _to_range(slices: DataFrame, n: int) -> DataFrame:
    """Slices by range: neighbouring ranges share a partition where there are more of them."""
    parts = min(n, common.partitions(slices.sparkSession))
    return slices.repartitionById(parts, F.floor(F.col("range").cast("long") * parts / n).cast("int"))


def transducers(docs: DataFrame, cuts, longest: int, least: int) -> DataFrame:
    """(range, origin, lang, words, automaton): the phrases of every range with ``least`` or more, written as a table."""
    slices = docs.mapInArrow(lambda b: _shards(b, cuts, longest), SLICES)
    dealt = _to_range(slices, len(cuts.value) + 1).sortWithinPartitions("range", "lang")
    with _few_rows(docs.sparkSession):
        return common.materialize(dealt.mapInArrow(lambda b: _union(b, least), SLICES), "transducers")


# --- parts and scores ---------------------------------------------------------------------------

def parts(levels: ct.Levels) -> tuple[ct.Levels, dict[tuple[int, int, int], np.ndarray]]:
    """The automaton that asks for both parts of every phrase at every cut, and the place of each part in it, by
    (level of the phrase, words before the cut, side)."""
    keys, groups = [], []
    for level in range(1, len(levels.word)):
        phrases = levels.words(level)[levels.count[level] > 0]
        for k in range(1, level + 1):
            for side, some in enumerate((phrases[:, :k], phrases[:, k:])):
                keys.append((level, k, side))
                groups.append(some)
    asked, places = ct.from_phrases(groups, levels.vocabulary)
    return asked, dict(zip(keys, places))


def _ask(batches: Iterator[pa.RecordBatch], cuts) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r, lang, data in zip(*(batch.column(c).to_pylist() for c in ("range", "lang", "automaton"))):
            asked, _ = parts(ct.unpack(data))
            if asked.word:
                for to, some in ct.ranges(asked, lang, cuts.value):
                    yield _slice(to, r, lang, some)


def _answer(asked: pa.Table, own: pa.Table) -> pa.Table:
    """What each origin asked of a range, with the range's counts."""
    counts = ct.unpack(own.column("automaton")[0].as_py()) if own.num_rows else None
    out = []
    for origin, lang, data in zip(*(asked.column(c).to_pylist() for c in ("origin", "lang", "automaton"))):
        if counts is not None:
            out.append(_slice(origin, -1, lang, ct.compose(ct.unpack(data), counts)))
    return pa.Table.from_batches(out, _SLICES)


_FOUND = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("l", pa.int64()), ("r", pa.int64()),
                    ("cut", pa.int32()), ("score", pa.int64())])


def score(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """floor(SCALE * a * a / (left * right)), exact: whole numbers of any size where 64 bits don't hold the products."""
    if len(a) and (int(a.max()) ** 2 * SCALE >= 2 ** 63 or int(left.max()) * int(right.max()) >= 2 ** 63):
        a, left, right = (x.astype(object) for x in (a, left, right))
    return (SCALE * a * a // (left * right)).astype(np.int64)


def _scored(own: pa.Table, answers: pa.Table) -> pa.Table:
    """The candidates of a range with their lowest-scoring cut."""
    out = []
    if own.num_rows:
        lang, levels = own.column("lang")[0].as_py(), ct.unpack(own.column("automaton")[0].as_py())
        asked, places = parts(levels)
        if asked.word:
            got = ct.compose(asked, ct.union([ct.unpack(d) for d in answers.column("automaton").to_pylist()]))
            for level in range(1, len(levels.word)):
                counted = levels.count[level] > 0
                a, best = levels.count[level][counted], None
                for k in range(1, level + 1):
                    left, right = got.count[k - 1][places[level, k, 0]], got.count[level - k][places[level, k, 1]]
                    new = np.stack([left, right, np.full(len(a), k), score(a, left, right)])
                    best = new if best is None else np.where(new[3] < best[3], new, best)
                spelled = [b" ".join(levels.vocabulary[i] for i in row).decode("utf-8", "surrogatepass")
                           for row in levels.words(level)[counted].tolist()]
                out.append(pa.Table.from_arrays(
                    [pa.array([lang] * len(a), pa.string()), pa.array(spelled, pa.string()), pa.array(a),
                     pa.array(best[0]), pa.array(best[1]), pa.array(best[2], pa.int32()), pa.array(best[3])], schema=_FOUND))
    return pa.concat_tables(out) if out else _FOUND.empty_table()


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a, l, r, cut, score): all candidates with the parts of their lowest-scoring cut; and (lang, n), words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = spark.sparkContext.broadcast(find_cuts(texts, range_bytes))
    tables = transducers(texts, cuts, longest, least)
    ours = tables.select(F.col("range").alias("home"), F.col("lang").alias("home_lang"), "lang", "automaton")
    with _few_rows(spark):
        asked = common.materialize(tables.mapInArrow(lambda b: _ask(b, cuts), SLICES), "asked")
        answers = common.materialize(
            asked.groupBy("range", "lang").cogroup(ours.groupBy("home", "home_lang")).applyInArrow(_answer, SLICES), "answers")
        found = ours.groupBy("home", "home_lang").cogroup(answers.groupBy("range", "lang")).applyInArrow(
            _scored, "lang string, phrase string, a long, l long, r long, cut int, score long")
        return common.materialize(found, "phrases"), tables.groupBy("lang").agg(F.sum("words").alias("n"))


def outermost(found: DataFrame, share: int = INSIDE_SHARE) -> DataFrame:
    """Candidates without those inside a longer one that has ``share`` hundredths of their count."""
    words = F.split("phrase", " ")
    sizes = F.sequence(F.lit(2), F.size("w") - 1)
    inside = (found.select("lang", "a", words.alias("w")).filter(F.size("w") > 2)
              .select("lang", "a", "w", F.explode(sizes).alias("k"))
              .select("lang", "a", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1),
                                                         lambda i: F.array_join(F.slice("w", i, F.col("k")), " "))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = found.join(inside.hint("merge"), ["lang", "phrase"], "left")
    return kept.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")


def top(found: DataFrame, words: DataFrame, k: int = TOP) -> DataFrame:
    """Each language's first ``k`` with their rank and the language's number of words (lang, n)."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = found.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(DEALT)).cast("int"))
    some = dealt.withColumn("rank", F.row_number().over(W.partitionBy("lang", "deal").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= k).join(words.hint("merge"), "lang").drop("deal")


def digest(docs: DataFrame) -> DataFrame:
    found, words = mine(docs)
    return top(outermost(found), words).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
with pieces as (
    select coalesce(lang, '{UNKNOWN}') as lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
words as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
grams as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from places, (values (1), (2), (3)) t(k)
          where i + k - 1 <= len(w)),
counted as (select lang, k, phrase, count(*) as f from grams group by all),
candidates as (select lang, k, phrase, f, string_split(phrase, ' ') as w from counted where k > 1 and f >= {LEAST}),
cuts as (select *, unnest(range(1, k)) as c from candidates),
scored as (
    select cuts.lang, cuts.phrase, cuts.k, cuts.w, c, cuts.f as a, first.f as l, rest.f as r,
           cast({SCALE}::hugeint * cuts.f * cuts.f // (first.f::hugeint * rest.f) as bigint) as score
    from cuts join counted first on first.lang = cuts.lang and first.phrase = array_to_string(cuts.w[:c], ' ')
              join counted rest on rest.lang = cuts.lang and rest.phrase = array_to_string(cuts.w[c + 1:], ' ')),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
longer as (
    select lang, phrase, max(a) as most
    from (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from lowest where k = 3)
    group by all),
kept as (select lowest.* from lowest left join longer using (lang, phrase)
         where most is null or 100 * most < {INSIDE_SHARE} * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, score
from ranked join (select lang, sum(f) as n from counted where k = 1 group by lang) using (lang) where rank <= {TOP}
"""
