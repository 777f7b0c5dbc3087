"""A hidden Markov language model: Baum-Welch over partitions, exact likelihoods by scaled recursion."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.text import SPACED, bounded_batches, scan, slices, utf8
from touchline.session import scratch_path

STATES = 8
#: Words with an emission of their own; the bound of the model's tables.
CLASSES = 1 << 14
#: Words whose training counts are broadcast; the others are joined. 16 bytes each.
KNOWN = 1 << 20
#: Baum-Welch rounds, each over all training texts.
ROUNDS = 17
#: Ids of a training sequence; longer texts are trained on as several.
PIECE = 512
#: Steps of the recursions between two scalings; that many probabilities multiplied stay far above the least double.
SCALED = 8
#: Tokens whose probabilities a training task holds at once, about; fewer leave steps of few texts.
RUN = 500_000
#: Tokens whose texts a scoring task walks side by side; it holds their classes and the narrow columns of their rows.
SIDE = 1 << 22
#: Rows of the expected counts that travel together.
BLOCK = 256
#: Bytes of text in a row of the written sequences; a longer text has one by itself.
ROW = 1 << 18
END = np.uint64(0x5EED0F7E47)  # the token that ends a text


def _tokens(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a run of texts, each closed by END, and the bounds of the texts."""
    words = scan(raw, bounds, SPACED)
    return np.insert(words.hash, words.first[1:], END), words.first + np.arange(len(words.first))


class Lookup:
    """Places of 64-bit hashes in a sorted table, -1 where there is none."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.shift = np.uint64(64 - max(1, min(22, len(keys).bit_length() + 1)))
        edges = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)
        self.start = np.searchsorted(keys, edges[:-1] << self.shift).astype(np.int64)
        self.start = np.append(self.start, len(keys))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        bucket = hashes >> self.shift
        at, last = self.start[bucket], self.start[bucket + np.uint64(1)]
        open_ = np.flatnonzero(at < last)
        while len(open_):
            same = self.keys[at[open_]] == hashes[open_]
            out[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < last[open_]]
        return out


@dataclass
class Vocabulary:
    """What the corpus counts: all training tokens, distinct ones, and the frequent words by hash.

    ``cls`` numbers the words that have an emission of their own; all others, seen or not, share the class
    ``classes``, inside which a word has probability (count + 1) / (rare_tokens + rare_words + 1).
    """

    tokens: int
    distinct: int
    hashes: np.ndarray
    counts: np.ndarray
    cls: np.ndarray
    classes: int
    rare_tokens: int
    rare_words: int

    @cached_property
    def _table(self) -> np.ndarray:
        return np.append(self.cls, self.classes)  # -1 is the last

    def class_of(self, place: np.ndarray) -> np.ndarray:
        return self._table[place]


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes + 1 x states


class Sequences:
    """Runs of a class array, longest first, walked step by step side by side."""

    def __init__(self, classes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        self.order = np.argsort(-size, kind="stable")
        self.classes, self.begin, size = classes, begin[self.order], size[self.order]
        self.steps = int(size[0]) if len(size) else 0
        # how many are longer than t
        self.active = len(size) - np.searchsorted(size[::-1], np.arange(self.steps), side="right")

    def at(self, t: int) -> np.ndarray:
        return self.classes[self.begin[:self.active[t]] + t]


def log_likelihood(model: Model, classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log probabilities of whole class sequences; every one has at least one class."""
    s = Sequences(classes, bounds[:-1], np.diff(bounds))
    total = np.zeros(len(bounds) - 1)
    emit, move, alpha = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T), model.start[:, None]
    for t in range(s.steps):
        ids = s.at(t)
        alpha, ending = (move @ alpha[:, :len(ids)] if t else alpha) * emit.take(ids, axis=1), s.active[t + 1] if t + 1 < s.steps else 0
        if t % SCALED == 0:
            scale = alpha.sum(axis=0)
            total[:len(ids)] += np.log(scale)
            alpha /= scale
        if ending < len(ids):  # what has multiplied up since the last scaling
            total[ending:len(ids)] += np.log(alpha[:, ending:].sum(axis=0))
    out = np.empty_like(total)
    out[s.order] = total
    return out


@dataclass
class Expected:
    """Expected counts of one pass: starts, moves and emissions."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def none(cls, states: int, classes: int) -> Expected:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((classes + 1, states)))

    def add(self, model: Model, classes: np.ndarray, bounds: np.ndarray) -> None:
        """The forward-backward recursion over texts cut into pieces, about RUN tokens at a time."""
        sizes = np.diff(bounds)
        pieces = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(sizes)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = bounds[:-1][text] + number * PIECE
        size = np.minimum(sizes[text] - number * PIECE, PIECE)
        total = int(size.sum())
        parts = max(1, round(total / RUN))  # equal ones: a short rest would take as many steps
        for a, b in slices(np.append(0, np.cumsum(size)), -(-total // parts) + PIECE):
            self._walk(model, Sequences(classes, begin[a:b], size[a:b]))

    def _walk(self, model: Model, s: Sequences) -> None:
        """The same for some pieces. A state is a row and a step a block of its own, so that a step adds and multiplies whole rows that lie together."""
        states, cut = len(model.start), np.append(0, np.cumsum(s.active)).tolist()
        emit, move = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T)
        ids, shares = np.empty(cut[-1], np.int64), np.empty((states, cut[-1]))
        alphas, scaled = [], []
        for t in range(s.steps):
            ids[cut[t]:cut[t + 1]] = s.at(t)
            here = emit.take(ids[cut[t]:cut[t + 1]], axis=1)
            alpha = (move @ alphas[-1][:, :here.shape[1]] if t else model.start[:, None]) * here
            if t % SCALED == 0:
                scale = 1.0 / alpha.sum(axis=0)
                alpha *= scale
                here *= scale
            alphas.append(alpha)
            scaled.append(here)
        met, ahead = np.zeros_like(move), np.empty((states, 0))
        for t in range(s.steps - 1, -1, -1):
            alpha, m = alphas.pop(), ahead.shape[1]
            beta = np.empty_like(alpha)
            if m:
                met += alpha[:, :m] @ ahead.T
                np.matmul(model.move, ahead, out=beta[:, :m])
            if m < alpha.shape[1]:
                beta[:, m:] = 1.0 / alpha[:, m:].sum(axis=0)  # pieces that end here
            np.multiply(alpha, beta, out=shares[:, cut[t]:cut[t + 1]])
            ahead = scaled.pop()
            ahead *= beta
        self.move += met * model.move
        self.start += shares[:, :cut[1]].sum(axis=1)
        for k in range(states):
            self.emit[:, k] += np.bincount(ids, shares[k], len(self.emit))

    def model(self, prior: np.ndarray) -> Model:
        """The most likely model for these counts, each with a little of the words' overall shares."""
        start = self.start + 1.0
        move = self.move + 1.0
        emit = self.emit + prior[:, None] * 50.0
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0, keepdims=True))


def count_tokens(docs: DataFrame, path: str) -> None:
    """Write hash and count of every token of ``docs`` (column text); tasks add up what they read first."""
    schema = T.StructType([T.StructField("hash", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([c for _, c in held])).astype(np.int64)

        for batch in batches:
            raw, bounds = utf8(batch.column(0))
            for a, b in slices(bounds):
                held.append(np.unique(_tokens(raw, bounds[a:b + 1])[0], return_counts=True))
                size += len(held[-1][0])
            if size > 1_000_000 and len(held) > 1:  # what is held stays bounded: a large sum goes on its way
                held = [merged()]
                size = len(held[0][0])
                if size > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], schema.names)
                    held, size = [], 0
        if held:
            keys, counts = merged()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], schema.names)

    docs.select("text").mapInArrow(run, schema).groupBy("hash").agg(F.sum("n").alias("n")).write.parquet(path)


def load_vocabulary(counts: DataFrame, classes: int, known: int) -> tuple[Vocabulary, int]:
    """The frequent words, ``known`` at most, and the least count that makes a word one of them.

    The limit is a count, found from a histogram with eight steps for each doubling, so equal
    counts fall on the same side and no sort of all words is needed.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    histogram = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect()
    least, words = None, 0
    for r in sorted(histogram, key=lambda r: -r.step):
        words += r.words
        if words > known:
            break
        least = r.least
    least = least if least is not None else (1 << 62)
    table = counts.filter((F.col("n") >= least) | (F.col("hash") == int(END))).toArrow()
    hashes = table["hash"].to_numpy().astype(np.int64).view(np.uint64)
    counts_ = table["n"].to_numpy().astype(np.int64)
    if END not in hashes:
        hashes, counts_ = np.append(hashes, END), np.append(counts_, 0)
    order = np.argsort(hashes)
    hashes, counts_ = hashes[order], counts_[order]
    place = np.lexsort((hashes, -counts_))
    end = int(np.flatnonzero(hashes == END)[0])
    chosen = np.unique(np.append(place[:max(classes - 1, 0)], end))
    cls = np.full(len(hashes), len(chosen), np.int64)
    cls[chosen] = np.arange(len(chosen))
    seen = int((counts_[chosen] > 0).sum())
    return Vocabulary(int(total.tokens), int(total.words), hashes, counts_, cls, len(chosen),
                      int(total.tokens - counts_[chosen].sum()), int(total.words) - seen), least


def prior_of(v: Vocabulary) -> np.ndarray:
    own = np.zeros(v.classes + 1)
    mine = v.cls < v.classes
    own[v.cls[mine]] = v.counts[mine] + 1
    own[v.classes] = v.rare_tokens + 1
    return own / own.sum()


def start_model(v: Vocabulary, states: int) -> Model:
    """The model before the first round: the states are random tilts of the words' shares and mostly stay."""
    prior, rng = prior_of(v), np.random.default_rng(10)
    emit = prior[:, None] * np.exp(rng.normal(0, 1, (len(prior), states)))
    move = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(move, 0.95)
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


SEQUENCES = T.StructType([T.StructField("classes", T.BinaryType()), T.StructField("sizes", T.BinaryType())])


def _number(classes: int) -> str:
    return "<u2" if classes < 1 << 16 else "<u4"


def write_sequences(docs: DataFrame, shared_vocabulary, path: str) -> None:
    """Write the classes of all tokens of ``docs`` (column text) and the texts' numbers of tokens, as bytes.

    Every training round reads these and not the words again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared_vocabulary.value
        find, number = Lookup(v.hashes), _number(v.classes)
        for batch in batches:
            raw, bounds = utf8(batch.column(0))
            for a, b in slices(bounds, ROW):
                hashes, cut = _tokens(raw, bounds[a:b + 1])
                row = v.class_of(find(hashes)).astype(number).tobytes(), np.diff(cut).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], SEQUENCES.names)

    docs.select("text").mapInArrow(run, SEQUENCES).write.parquet(path)


COUNTS = T.StructType([T.StructField("block", T.LongType()), T.StructField("at", T.BinaryType()), T.StructField("sums", T.BinaryType())])


def _blocks(rows: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """The rows with counts, BLOCK by BLOCK: number of the block, places in it and counts."""
    for k in range(0, len(rows), BLOCK):
        block = rows[k:k + BLOCK]
        at = np.flatnonzero(block.any(axis=1))
        if len(at):
            yield k // BLOCK, at.astype("<u4").tobytes(), block[at].astype("<f8").tobytes()


def _added(blocks, rows: dict[int, np.ndarray], states: int) -> dict[int, np.ndarray]:
    for number, at, sums in blocks:
        rows.setdefault(number, np.zeros((BLOCK, states)))[np.frombuffer(at, "<u4")] += np.frombuffer(sums, "<f8").reshape(-1, states)
    return rows


def _batch(blocks) -> pa.RecordBatch:
    columns = list(zip(*blocks, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], COUNTS.names)


def train_round(sequences: DataFrame, model: Model, prior: np.ndarray) -> Model:
    """One Baum-Welch round over all of ``sequences``: expected counts are added up by class across tasks.

    Tasks send them in blocks of classes, which are dealt out by number and added as they come.
    """
    spark, states, classes = sequences.sparkSession, len(model.start), len(prior) - 1
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen, held, size = shared.value, Expected.none(states, classes), [], 0
        number = np.dtype(_number(classes))

        def add() -> None:
            ids, sizes = (np.concatenate([np.frombuffer(x[k], n) for x in held]).astype(np.int64) for k, n in ((0, number), (1, "<u4")))
            seen.add(m, ids, np.append(0, np.cumsum(sizes)))
            held.clear()

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                held.append(row)
                size += len(row[0])
                if size >= RUN * number.itemsize:
                    add()
                    size = 0
        if held:
            add()
        yield _batch(_blocks(np.concatenate([seen.emit, seen.move, seen.start[None, :]])))

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            _added(zip(*(column.to_pylist() for column in batch.columns), strict=True), rows, states)
        every = np.arange(BLOCK).astype("<u4").tobytes()
        yield _batch((k, every, block.tobytes()) for k, block in rows.items())

    summed = sequences.mapInArrow(run, COUNTS).repartition("block").mapInArrow(together, COUNTS).toArrow()
    total = np.zeros((-(-(len(prior) + states + 1) // BLOCK), BLOCK, states))
    for k, block in _added(zip(*(summed[n].to_pylist() for n in COUNTS.names), strict=True), {}, states).items():
        total[k] = block
    rows = total.reshape(-1, states)[:len(prior) + states + 1]
    shared.unpersist()
    return Expected(rows[-1], rows[len(prior):-1], rows[:len(prior)]).model(prior)


SCORED = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()),
    T.StructField("own", T.DoubleType()),
    T.StructField("rare", T.ArrayType(T.StructType([T.StructField("hash", T.LongType()), T.StructField("n", T.LongType())]))),
])


def _scored(batches: Iterator[pa.RecordBatch], v: Vocabulary, m: Model, number: int) -> Iterator[pa.RecordBatch]:
    """Rows of SCORED for batches of doc_id, held_out, text; ``number`` is that of the first row.

    Texts of SIDE tokens are walked side by side: a step of the recursion costs the same for one long text as for hundreds.
    """
    find = Lookup(v.hashes)
    logs = np.append(np.log10(v.counts + 1.0), 0.0)  # -1 is the last: a count that is looked up later
    seen = np.append(v.counts > 0, False)
    in_rare = math.log10(v.rare_tokens + v.rare_words + 1)
    held: list[tuple[list[pa.Array], np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []
    size = 0

    def walked() -> pa.RecordBatch:
        columns, classes, sizes, in_class, lists = zip(*held, strict=True)
        own = log_likelihood(m, np.concatenate(classes), np.append(0, np.cumsum(np.concatenate(sizes))))
        own = own / math.log(10) + np.concatenate(in_class)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [*(pa.concat_arrays(c) for c in zip(*columns, strict=True)), pa.array(own), pa.concat_arrays(lists)], SCORED.names)

    for batch in batches:
        raw, bounds = utf8(batch.column(2))
        for a, b in slices(bounds):
            hashes, cut = _tokens(raw, bounds[a:b + 1])
            place = find(hashes)
            classes = v.class_of(place)
            rare = classes == v.classes
            text = np.repeat(np.arange(b - a), np.diff(cut))

            def by_text(values: np.ndarray) -> np.ndarray:
                return np.bincount(text, values, b - a)  # noqa: B023 - used at once

            left = np.flatnonzero(place < 0)
            order = left[np.lexsort((hashes[left], text[left]))]
            t, h = text[order], hashes[order]
            new = np.ones(len(order), bool)
            new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
            at = np.flatnonzero(new)
            pairs = pa.StructArray.from_arrays([
                pa.array(h[at].view(np.int64)), pa.array(np.diff(np.append(at, len(order)))),
            ], ["hash", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(t[at], np.arange(b - a + 1)), pa.int32()), pairs)
            here = pa.array(np.arange(a, b))  # what is taken is a copy and does not hold the batch
            columns = [
                pa.array(np.arange(number, number + b - a)), batch.column(0).take(here), batch.column(1).take(here),
                pa.array(np.diff(cut)), pa.array(by_text(seen[place]).astype(np.int64)), pa.array(by_text(logs[place])),
            ]
            in_class = by_text(np.where(rare, logs[place] - in_rare, 0.0))
            held.append((columns, classes.astype(_number(v.classes)), np.diff(cut), in_class, lists))
            number += b - a
            size += len(classes)
            if size >= SIDE:
                yield walked()
                size = 0
    if held:
        yield walked()


def _score(docs: DataFrame, shared_vocabulary, model: Model) -> DataFrame:
    """Rows of SCORED for doc_id, held_out, text; what the broadcast counts don't have is left in ``rare``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scored(batches, shared_vocabulary.value, shared.value, TaskContext.get().partitionId() << 40)

    return docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(run, SCORED)


def score_documents(
    docs: DataFrame, held_out: Column, states: int = STATES, classes: int = CLASSES, known: int = KNOWN, rounds: int = ROUNDS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Tokens are the words between white space, A-Z lower-cased, and one end of each text. All rows that are not
    held out are learned from: their tokens are counted, by a 64-bit hash, and a hidden Markov
    model is trained on them, which emits the ``classes`` most frequent words by state and any other, seen or
    not, as one class, inside which counts plus one decide. score is the exact probability of the whole
    token sequence, from the scaled forward recursion over all of it. base_score is the sum of log10((c + 1) / (N + V + 1)).

    Baum-Welch starts from random tilts of the words' shares and runs ``rounds`` times over all training texts, in pieces of
    PIECE tokens; no round reads fewer. The counts of frequent words, ``known`` at most, are broadcast;
    those of all other words are joined to the documents that use them. Null and empty texts are the single
    end. A null in ``held_out`` counts as learned from. Repeated rows count each. Without any row to
    learn from, all counts are zero. An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.filter(~F.col("held_out"))
    path = scratch_path(spark, "counts")
    count_tokens(train, path)
    counts = spark.read.schema("hash long, n long").parquet(path)
    vocabulary, least = load_vocabulary(counts, classes, known)
    prior, shared = prior_of(vocabulary), spark.sparkContext.broadcast(vocabulary)
    path = scratch_path(spark, "sequences")
    write_sequences(train, shared, path)
    sequences = spark.read.schema(SEQUENCES).parquet(path)
    model = start_model(vocabulary, states)
    for _ in range(rounds):
        model = train_round(sequences, model, prior)

    path = scratch_path(spark, "scored")
    _score(rows, shared, model).write.parquet(path)
    scored = spark.read.schema(SCORED).parquet(path)
    used = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.hash").alias("hash"), F.col("r.n").alias("times"))
    others = counts.filter(F.col("n") < least)
    more = used.join(others, "hash").groupBy("row").agg(
        F.sum("times").alias("times"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    in_all = math.log10(vocabulary.tokens + vocabulary.distinct + 1)
    logs = F.coalesce("logs", F.lit(0.0))  # of tokens that are known to be rare already
    return scored.drop("rare").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("times", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(in_all)).alias("base_score"), (F.col("own") + logs).alias("score"),
    )
