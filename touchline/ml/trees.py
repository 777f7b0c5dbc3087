"""Tree models on Spark: many candidates of a search grown together and scored at every prefix.

Features are binned once per fold and kept as blocks of rows. What a search asks for is grouped into jobs: a *forest* job grows each
tree once for all candidates that differ in depth, number of trees or leaf sizes; a *chain* job grows boosted trees once for all
candidates that differ in their number. Where the blocks of all folds are small (their bytes are counted), they are broadcast and the jobs run
beside each other. Otherwise the jobs advance in step: tasks add up histograms of their own rows for every open node, a shuffle adds them and picks the
splits. Both ways use the same arithmetic on the same whole numbers and give the same trees.
"""

from __future__ import annotations

import io
import math
import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.ml.growth import BINS, CUTS, Boost, Grown, Spec, Tree, choose, drawn, frontier, grow, histograms, may_split, member_tree, poisson, root, rounded
from touchline.ml.growth import Level, Splits
from touchline.session import scratch_path

#: Bytes of blocks, all folds together, that may be broadcast; counted before.
BROADCAST_BYTES = 64 << 20
BROADCAST_CONF = "spark.touchline.treeBroadcastBytes"
#: Trees of a forest that one task grows, and trees that advance in step where blocks are not broadcast.
TREES_AT_ONCE, TREES_IN_STEP = 25, 64
#: Bytes of histograms that a task holds before it hands them on.
HELD_BYTES = 64 << 20

BLOCK_SCHEMA = "fold int, block long, rows int, fit_rows long, positives long, bins binary, y binary, fit binary"
SCORE_SCHEMA = "candidate int, fold int, fit boolean, y double, score double"
PART_SCHEMA = "candidate int, fold int, block long, part binary"


@dataclass(frozen=True)
class Binned:
    """Blocks of all folds, cut points by fold and feature, and rows to fit and positives among them by fold."""

    blocks: DataFrame
    cuts: Mapping[int, list[np.ndarray]]
    counts: Mapping[int, tuple[int, int]]
    size: int
    features: int

    @property
    def spark(self) -> SparkSession:
        return self.blocks.sparkSession

    @property
    def small(self) -> bool:
        return self.size <= int(self.spark.conf.get(BROADCAST_CONF, str(BROADCAST_BYTES)))


def cut_points(rows: DataFrame, features: str, width: int) -> list[np.ndarray]:
    """Up to CUTS values of each feature at even ranks, without the greatest; a row goes left if it is at most the value."""
    shares = [0.0, 0.01, *[i / (CUTS - 2) for i in range(1, CUTS - 2)], 0.99]
    entries = [F.col("x")[i] for i in range(width)]
    found = rows.select(vector_to_array(features).alias("x")).agg(
        F.array(*[F.percentile_approx(e, shares, 20_000) for e in entries]).alias("cuts"), F.array(*[F.max(e) for e in entries]).alias("most")).first()
    return [np.array(sorted({v for v in cuts or () if v < most})) for cuts, most in zip(found.cuts, found.most, strict=True)]


def _blocks(rows: DataFrame, fold: int, cuts: list[np.ndarray], features: str, label: str) -> DataFrame:
    """One block for each batch of rows; its number is that of the task and of the batch, and stays once it is written."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for at, frame in enumerate(frames):
            if not len(frame):
                continue
            x = np.vstack(frame["x"].to_numpy())
            bins = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
            y, fit = frame["y"].to_numpy().astype(np.uint8), frame["fit"].to_numpy().astype(np.uint8)
            yield pd.DataFrame([(fold, (part << 32) + at, len(frame), int(fit.sum()), int((fit * y).sum()), bins.tobytes(), y.tobytes(), fit.tobytes())],
                               columns=["fold", "block", "rows", "fit_rows", "positives", "bins", "y", "fit"])

    return rows.select(vector_to_array(features).alias("x"), F.col(label).alias("y"), "fit").mapInPandas(run, BLOCK_SCHEMA)


def bin_folds(folds: Mapping[int, DataFrame], features: str, label: str) -> Binned:
    """Binned rows of every fold, written to the shared folder. A fold's rows say in ``fit`` which of them are fitted on; the cut points are theirs."""
    cuts, frames, spark, width = {}, None, None, 0
    for fold, rows in folds.items():
        spark = rows.sparkSession
        first = rows.select(vector_to_array(features).alias("x")).first()
        width = len(first.x) if first else 0
        cuts[fold] = cut_points(rows.filter("fit"), features, width)
        blocks = _blocks(rows, fold, cuts[fold], features, label)
        frames = blocks if frames is None else frames.unionByName(blocks)
    path = scratch_path(spark, "binned")
    frames.write.parquet(path)
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    counts = {r.fold: (r.fit_rows or 0, r.positives or 0) for r in stored.groupBy("fold").agg(F.sum("fit_rows").alias("fit_rows"), F.sum("positives").alias("positives")).collect()}
    size = stored.agg(F.sum(F.octet_length("bins") + 2 * F.col("rows"))).first()[0] or 0
    return Binned(stored, cuts, counts, size, width)


@dataclass(frozen=True)
class Rows:
    """Rows of one block, or of a whole fold that is broadcast. ``number`` names a row in samples."""

    bins: np.ndarray
    y: np.ndarray
    fit: np.ndarray
    number: np.ndarray

    @staticmethod
    def of(block: int, bins: bytes, y: bytes, fit: bytes) -> Rows:
        y, fit = np.frombuffer(y, np.uint8), np.frombuffer(fit, np.uint8)
        number = (np.uint64(block & (1 << 63) - 1) << np.uint64(20)) + np.arange(len(y), dtype=np.uint64)
        return Rows(np.frombuffer(bins, np.uint8).reshape(len(y), -1), y.astype(float), fit.astype(float), number)

    @staticmethod
    def joined(parts: Sequence[Rows]) -> Rows:
        return Rows(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("bins", "y", "fit", "number")))


@dataclass(frozen=True)
class Forest:
    """Trees ``first`` to ``last``; wanted: (candidate, member of the spec, depth)."""

    spec: Spec
    bootstrap: bool
    first: int
    last: int
    wanted: tuple[tuple[int, int, int], ...]

    @property
    def depth(self) -> int:
        return max(d for _, _, d in self.wanted)

    def sums(self, rows: Rows, tree: int) -> tuple[np.ndarray, ...]:
        w = rows.fit * poisson(rows.number, tree, self.spec.seed) if self.bootstrap else rows.fit
        return w, w * rows.y

    def values(self, level: Level | Tree) -> np.ndarray:
        return rounded(level.s / np.maximum(level.n, 1e-300))

    def scores(self, rows: Rows) -> Iterator[tuple[int, np.ndarray]]:
        """Sums over the trees of each candidate's leaf values, taken while the trees are grown."""
        total = {c: np.zeros(len(rows.y)) for c, _, _ in self.wanted}
        for tree in range(self.first, self.last):
            for at, (level, splits, own, nodes) in enumerate(grow(rows.bins, self.sums(rows, tree), self.spec, self.depth, tree)):
                inner = np.zeros(len(level.n), np.int64)
                np.bitwise_or.at(inner, splits.node, splits.mask)
                value = self.values(level)
                for candidate, member, depth in self.wanted:
                    if at <= depth:
                        ends = level.mask if at == depth else level.mask & ~inner
                        here = (ends >> member & 1).astype(bool)[nodes]
                        total[candidate][own[here]] += value[nodes[here]]
        yield from total.items()

    def trees(self, rows: Rows) -> Iterator[Tree]:
        for tree in range(self.first, self.last):
            levels, splits = zip(*((a, b) for a, b, _, _ in grow(rows.bins, self.sums(rows, tree), self.spec, self.depth, tree)), strict=True)
            yield member_tree(list(levels), list(splits), self.wanted[0][1], self.wanted[0][2])


@dataclass(frozen=True)
class Chain:
    """Boosted trees; wanted: (candidate, number of trees)."""

    boost: Boost
    wanted: tuple[tuple[int, int], ...]

    @property
    def rounds(self) -> int:
        return max(r for _, r in self.wanted)

    def advance(self, rows: Rows, count: tuple[int, int]) -> Iterator[tuple[Tree, np.ndarray]]:
        """Every further tree, and the margins after it."""
        boost, margin = self.boost, np.full(len(rows.y), self.boost.start(count[1], count[0]))
        for at in range(self.rounds):
            grown = [(a, b) for a, b, _, _ in grow(rows.bins, boost.derivatives(margin, rows.y, rows.fit), boost.scaled(), boost.depth, at)]
            tree = boost.cut_back(member_tree([a for a, _ in grown], [b for _, b in grown], 0, boost.depth))
            margin = margin + boost.values(tree)[tree.leaves(rows.bins)]
            yield tree, margin

    def scores(self, rows: Rows, count: tuple[int, int]) -> Iterator[tuple[int, np.ndarray]]:
        for at, (_, margin) in enumerate(self.advance(rows, count), 1):
            for candidate, rounds in self.wanted:
                if rounds == at:
                    yield candidate, self.boost.probability(margin)


Job = Forest | Chain


def _pack(x: np.ndarray) -> bytes:
    return x.astype("<f8").tobytes()


def _whole(binned: Binned) -> dict[int, Rows]:
    """All folds on the driver, within the counted bound."""
    parts: dict[int, list[Rows]] = {}
    for r in binned.blocks.orderBy("fold", "block").collect():
        parts.setdefault(r.fold, []).append(Rows.of(r.block, r.bins, r.y, r.fit))
    return {fold: Rows.joined(own) for fold, own in parts.items()}


def _side_by_side(binned: Binned, tasks: Sequence[tuple[int, Job]], out: Callable, schema: str) -> DataFrame:
    """Rows that ``out`` makes of (rows, counts, fold, job) for every task, each in a task of its own; written to the shared folder."""
    spark = binned.spark
    held = spark.sparkContext.broadcast((_whole(binned), list(tasks), dict(binned.counts)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole, todo, counts = held.value
        for frame in frames:
            for number in frame["id"]:
                fold, job = todo[number]
                made = list(out(whole[fold], counts[fold], fold, job))
                yield pd.DataFrame(made, columns=[c.split()[0] for c in schema.split(", ")])

    path = scratch_path(spark, "grown")
    spark.range(0, len(tasks), 1, max(1, len(tasks))).mapInPandas(run, schema).write.parquet(path)
    held.unpersist()
    return spark.read.schema(schema).parquet(path)


@dataclass
class Growing:
    """A tree that advances in step with others: its fold, what it is grown from, and what there is of it."""

    fold: int
    job: Job
    tree: int
    start: float = 0.0
    before: list[Tree] = field(default_factory=list)
    grown: Grown | None = None

    @property
    def spec(self) -> Spec:
        return self.job.spec if isinstance(self.job, Forest) else self.job.boost.scaled()

    @property
    def depth(self) -> int:
        return self.job.depth if isinstance(self.job, Forest) else self.job.boost.depth

    def margin(self, rows: Rows) -> np.ndarray:
        out = np.full(len(rows.y), self.start)
        for tree in self.before:
            out = out + self.job.boost.values(tree)[tree.leaves(rows.bins)]
        return out

    def sums(self, rows: Rows) -> tuple[np.ndarray, ...]:
        if isinstance(self.job, Forest):
            return self.job.sums(rows, self.tree)
        return self.job.boost.derivatives(self.margin(rows), rows.y, rows.fit)


def _in_step(binned: Binned, roots: list[Growing]) -> None:
    """Grow all roots level by level; each level is one aggregation of histograms over the blocks and one row back for each split."""
    spark = binned.spark
    blocks = binned.blocks

    def by_block(make: Callable, schema: str, held) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, total, size = [c.split()[0] for c in schema.split(", ")], {}, 0

            def given():
                rows = [(*k, _pack(v)) for k, v in total.items()]
                total.clear()
                return pd.DataFrame(rows, columns=names)

            for frame in frames:
                for r in frame.itertuples():
                    for key, value in make(held.value, r.fold, Rows.of(r.block, r.bins, r.y, r.fit)):
                        size += 0 if key in total else value.nbytes
                        total[key] = total[key] + value if key in total else value
                        if size >= HELD_BYTES:
                            yield given()
                            size = 0
            if total:
                yield given()

        return blocks.mapInPandas(run, schema)

    def totals(held, fold: int, rows: Rows):
        for k, r in enumerate(held):
            if r.fold == fold:
                sums = r.sums(rows)
                yield (k,), np.array([sums[0].sum(), sums[1].sum(), sums[-1].sum()])

    held = spark.sparkContext.broadcast(roots)
    three = by_block(totals, "root int, part binary", held)
    found: dict[int, np.ndarray] = {}
    for r in three.collect():  # three sums a root and task
        found[r.root] = found.get(r.root, 0) + np.frombuffer(r.part, "<f8")
    for k, r in enumerate(roots):
        sums = found.get(k, np.zeros(3))
        r.grown = Grown([root(sums[:1], sums[1:2], sums[2:], r.spec, r.tree)])
    open_ = [k for k, r in enumerate(roots) if r.depth > 0]
    width = binned.features
    while open_:
        held = spark.sparkContext.broadcast([(k, roots[k]) for k in open_])

        def parts(held, fold: int, rows: Rows):
            for k, r in held:
                if r.fold != fold:
                    continue
                level, sums = r.grown.levels[-1], r.sums(rows)
                own, nodes = frontier(r.grown, rows.bins)
                going = may_split(level, r.spec)[nodes] & (sums[0][own] > 0)
                present, nodes = np.unique(nodes[going], return_inverse=True)
                tried = drawn(level.path[present], width, r.spec.features, r.spec.seed)
                hist = histograms(rows.bins, own[going], nodes, len(present), sums, tried)
                for i, node in enumerate(present.tolist()):
                    yield (k, node), hist[:, i].ravel()

        def split(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            k, node = int(key[0]), int(key[1])
            r = dict(held.value)[k]
            level = r.grown.levels[-1]
            tried = drawn(level.path[node:node + 1], width, r.spec.features, r.spec.seed)
            kinds = 2 if isinstance(r.job, Forest) else 3
            hist = sum(np.frombuffer(p, "<f8") for p in frame["part"]).reshape(kinds, 1, -1, BINS)
            return pd.DataFrame([(k, *x) for x in choose(hist, level, node, r.spec, tried)],
                                columns=["root", "node", "mask", "feature", "cut", "gain", "ln", "ls", "lh"])

        made = by_block(parts, "root int, node long, part binary", held).groupBy("root", "node").applyInPandas(
            split, "root int, node long, mask long, feature long, cut long, gain double, ln double, ls double, lh double")
        rows: dict[int, list[tuple]] = {k: [] for k in open_}
        for r in made.collect():
            rows[r.root].append(tuple(r)[1:])
        open_ = [k for k in open_ if roots[k].grown.extend(Splits.of(sorted(rows[k], key=lambda x: x[:2]))) and len(roots[k].grown.levels) <= roots[k].depth]


def _scores_of_blocks(binned: Binned, roots: list[Growing], wanted: Callable) -> DataFrame:
    """PART_SCHEMA rows: what ``wanted`` makes of every block and root."""
    held = binned.spark.sparkContext.broadcast(roots)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b in frame.itertuples():
                rows, total = Rows.of(b.block, b.bins, b.y, b.fit), {}
                for r in held.value:
                    if r.fold == b.fold:
                        for candidate, score in wanted(r, rows):
                            total[candidate] = total.get(candidate, 0) + score
                yield pd.DataFrame([(c, b.fold, b.block, _pack(s)) for c, s in total.items()], columns=["candidate", "fold", "block", "part"])

    return binned.blocks.mapInPandas(run, PART_SCHEMA)


def _grown_in_step(binned: Binned, tasks: Sequence[tuple[int, Job]], keep: Callable[[Growing], None] | None = None) -> DataFrame:
    """Partial scores of every task, or, with ``keep``, the trees themselves."""
    spark, path = binned.spark, scratch_path(binned.spark, "scores")
    forests = [Growing(f, job, t) for f, job in tasks if isinstance(job, Forest) for t in range(job.first, job.last)]
    for a in range(0, len(forests), TREES_IN_STEP):
        batch = forests[a:a + TREES_IN_STEP]
        _in_step(binned, batch)

        def forest(r: Growing, rows: Rows):
            for candidate, member, depth in r.job.wanted:
                tree = member_tree(r.grown.levels, r.grown.splits, member, depth)
                yield candidate, r.job.values(tree)[tree.leaves(rows.bins)]

        if keep:
            for r in batch:
                keep(r)
        else:
            _scores_of_blocks(binned, batch, forest).write.mode("append").parquet(path)
    chains = [Growing(f, job, 0, job.boost.start(binned.counts[f][1], binned.counts[f][0])) for f, job in tasks if isinstance(job, Chain)]
    for at in range(1, max((r.job.rounds for r in chains), default=0) + 1):
        live = [r for r in chains if r.job.rounds >= at]
        for r in live:
            r.tree = at - 1
        _in_step(binned, live)
        for r in live:
            r.before.append(r.job.boost.cut_back(member_tree(r.grown.levels, r.grown.splits, 0, r.depth)))
            r.grown = None
        done = [r for r in live if any(n == at for _, n in r.job.wanted)]
        if keep or not done:
            continue

        def chain(r: Growing, rows: Rows, at: int = at):
            for candidate, rounds in r.job.wanted:
                if rounds == at:
                    yield candidate, r.job.boost.probability(r.margin(rows))

        _scores_of_blocks(binned, done, chain).write.mode("append").parquet(path)
    if keep:
        for r in chains:
            keep(r)
        return None
    return spark.read.schema(PART_SCHEMA).parquet(path)


def candidate_scores(binned: Binned, jobs: Sequence[Job], shares: Mapping[int, int]) -> DataFrame:
    """Score of every row by every candidate and fold, SCORE_SCHEMA. ``shares``: by how many trees a candidate's sum is divided."""
    tasks = sorted(((fold, job) for fold in binned.cuts for job in jobs), key=lambda t: -_effort(t[1]))
    if binned.small:
        def out(rows, count, fold, job):
            found = job.scores(rows, count) if isinstance(job, Chain) else job.scores(rows)
            return [(c, fold, -1, _pack(x)) for c, x in found]

        parts = _side_by_side(binned, tasks, out, PART_SCHEMA)
        held = binned.spark.sparkContext.broadcast({f: (r.y, r.fit) for f, r in _whole(binned).items()})

        def told(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            y, fit = held.value[int(key[1])]
            total = sum(np.frombuffer(p, "<f8") for p in frame["part"])
            return _score_rows(key, y, fit, total / shares.get(int(key[0]), 1))

        return parts.groupBy("candidate", "fold", "block").applyInPandas(told, SCORE_SCHEMA)
    parts = _grown_in_step(binned, tasks)
    own = binned.blocks.select("fold", "block", "y", "fit")

    def told_block(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for candidate, frame in left.groupby("candidate"):
            y, fit = (np.frombuffer(right[n].iloc[0], np.uint8).astype(float) for n in ("y", "fit"))
            total = sum(np.frombuffer(p, "<f8") for p in frame["part"])
            frames.append(_score_rows((candidate, key[0]), y, fit, total / shares.get(int(candidate), 1)))
        return pd.concat(frames) if frames else pd.DataFrame(columns=[c.split()[0] for c in SCORE_SCHEMA.split(", ")])

    return parts.groupBy("fold", "block").cogroup(own.groupBy("fold", "block")).applyInPandas(told_block, SCORE_SCHEMA)


def _score_rows(key: tuple, y: np.ndarray, fit: np.ndarray, score: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"candidate": int(key[0]), "fold": int(key[1]), "fit": fit > 0, "y": y, "score": score})


def _effort(job: Job) -> float:
    if isinstance(job, Chain):
        return job.rounds * 2.0 ** min(job.boost.depth, 9) * 8
    return (job.last - job.first) * 2.0 ** min(job.depth, 9) * (1 if job.spec.features else 8)


def forest_jobs(spec: Spec, bootstrap: bool, wanted: Sequence[tuple[int, int, int, int]]) -> list[Forest]:
    """Jobs of (candidate, member, depth, number of trees): runs of trees, each for the candidates that reach so far."""
    edges = sorted({0, *[n for *_, n in wanted], *range(0, max(n for *_, n in wanted), TREES_AT_ONCE)})
    jobs = []
    for first, last in zip(edges, edges[1:], strict=False):
        own = [w for w in wanted if w[3] >= last]
        members = sorted({w[1] for w in own})
        kept = replace(spec, members=tuple(spec.members[m] for m in members))
        jobs.append(Forest(kept, bootstrap, first, last, tuple((c, members.index(m), d) for c, m, d, _ in own)))
    return jobs


def fitted_trees(binned: Binned, jobs: Sequence[Job]) -> list[Tree]:
    """The trees of one model, fitted on fold 0."""
    tasks = [(0, job) for job in jobs]
    if not binned.small:
        kept: list[Tree] = []

        def keep(r: Growing) -> None:
            if isinstance(r.job, Chain):
                kept.extend(r.before)
            else:
                kept.append(member_tree(r.grown.levels, r.grown.splits, r.job.wanted[0][1], r.job.wanted[0][2]))

        _grown_in_step(binned, tasks, keep)
        return kept

    def out(rows, count, fold, job):
        trees = [t for t, _ in job.advance(rows, count)] if isinstance(job, Chain) else list(job.trees(rows))
        return [(0 if isinstance(job, Chain) else job.first, pickle.dumps(trees))]

    grown = _side_by_side(binned, tasks, out, "first int, trees binary")
    return [t for r in sorted(grown.collect(), key=lambda r: r.first) for t in pickle.load(io.BytesIO(r.trees))]


def drawn_features(strategy: str | int, width: int) -> int | None:
    if strategy == "all":
        return None
    if isinstance(strategy, int):
        return strategy
    return max(1, int(math.sqrt(width) if strategy in ("sqrt", "auto") else math.log2(max(width, 1))))
