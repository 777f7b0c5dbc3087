"""Token ids, packing, token files, shards and the language model."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import spaced
from touchline.llm import hmm, rans
from touchline.llm.packing import pack_documents
from touchline.llm.sharding import assign_shards, hilbert_index, write_by_curve
from touchline.llm.token_files import read_token_files, write_token_files

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def ids_of(path, text, end):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


@pytest.fixture(scope="module")
def tokens(rows):
    return {p: {t: ids_of(p, t, e) for _, t in rows} for p, e in ((BYTE, 0), (WORD, 2))}


def test_packing(docs, rows, tokens, empty):
    pieces = pack_documents(docs, BYTE).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, t in rows:
        own = sorted(by_doc[i], key=lambda p: p.start)
        copies = sum(1 for j, _ in rows if j == i)
        if copies == 1:
            assert [x for p in own for x in p.ids] == tokens[BYTE][t]
            assert all(p.doc_tokens == len(tokens[BYTE][t]) for p in own)
    assert sum(p.length for p in pieces) == sum(len(tokens[BYTE][t]) for _, t in rows)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and at & (at - 1) == 0  # a power of two needs no padding
    assert pack_documents(empty, BYTE).count() == 0


def test_sum_of_squares_choice():
    from touchline.llm.packing import Piece, SumOfSquares

    rng = np.random.default_rng(1)
    packer = SumOfSquares(16)
    for k in range(500):
        size = int(rng.integers(1, 16))
        best = {}
        for level in range(0, 16 - size + 1):
            if level and not packer.count[level]:
                continue
            after = packer.count.copy()
            after[level] -= level > 0
            after[level + size] += 1
            best[level] = int((after[1:16] ** 2).sum())
        least = min(best.values())
        assert packer.level_for(size) == max(l for l, v in best.items() if v == least)
        packer.place(Piece(k, 0, np.zeros(size, np.uint32), size))


def test_rans_round_trip():
    rng = np.random.default_rng(4)
    for ids in (np.empty(0, np.uint32), np.zeros(1, np.uint32), np.full(rans.BLOCK + 1, 7, np.uint32), rng.integers(0, 1 << 32, 5000, dtype=np.uint32),
                (rng.zipf(1.2, 100_000) % 50_000).astype(np.uint32)):
        coded = rans.encode(ids)
        assert (rans.decode(coded) == ids).all()
        blocks = len(coded.states)
        for k in range(blocks):  # each block by itself
            assert (rans.decode(coded, k, k + 1) == ids[k * rans.BLOCK:(k + 1) * rans.BLOCK]).all()


def test_token_files(spark, docs, rows, tokens, empty, tmp_path):
    path = f"file://{tmp_path}/tokens"
    write_token_files(docs, path, WORD, segment=2000)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    for r, (i, t) in zip(got, order, strict=True):
        ids = tokens[WORD][t]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    write_token_files(empty, path + "0", WORD)
    assert read_token_files(spark, path + "0").count() == 0


def test_damaged_files_are_found(spark, docs, tmp_path):
    path = f"file://{tmp_path}/tokens"
    write_token_files(docs.limit(5), path, WORD)
    spoiled = spark.read.parquet(path).withColumn("checksums", F.transform("checksums", lambda c: c.bitwiseXOR(F.lit(1).cast("long"))))
    spoiled.write.parquet(path + "x")
    with pytest.raises(Exception, match="checksum differs"):
        read_token_files(spark, path + "x").collect()


def test_hilbert_is_a_curve():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1)
        index = hilbert_index(cells, bits)
        assert sorted(index) == list(range(1 << (dims * bits)))
        steps = np.abs(np.diff(cells[:, np.argsort(index)], axis=1)).sum(axis=0)
        assert (steps == 1).all()


def test_shards(spark, docs, rows, empty, tmp_path):
    got = assign_shards(docs, ["lang", "key", "text"], shards=5).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
        assert r.law == "rows" and r.grown_shard is None
    assert set(shards) == set(range(5)) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    last = -1
    for k in range(5):
        assert sorted(r.slot for r in shards[k]) == list(range(len(shards[k])))
        assert min(r.curve for r in shards[k]) >= last
        last = max(r.curve for r in shards[k])
    assert assign_shards(empty, ["lang", "key", "text"]).count() == 0
    write_by_curve(docs, f"file://{tmp_path}/curve", ["lang", "n"], 3)
    back = spark.read.parquet(f"file://{tmp_path}/curve")
    assert back.count() == len(rows) and sorted(back.columns) == sorted(docs.columns)


def brute_log10(model, classes):
    alpha, total = None, 0.0
    for c in classes:
        alpha = (model.start if alpha is None else alpha @ model.move) * model.emit[c]
        total += math.log(alpha.sum())
        alpha = alpha / alpha.sum()
    return total


def test_forward_and_training_counts():
    rng = np.random.default_rng(6)
    model = hmm.Model(*(x / x.sum(axis=0 if k == 2 else -1, keepdims=True) for k, x in enumerate((rng.random(3), rng.random((3, 3)), rng.random((6, 3))))))
    sizes = [1, 4, 1, 9, 2]
    bounds = np.append(0, np.cumsum(sizes))
    classes = rng.integers(0, 6, bounds[-1])
    got = hmm.log_likelihood(model, classes, bounds)
    want = [brute_log10(model, classes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert np.allclose(got, want)
    # expected counts by summing over all state paths
    import itertools

    seen, own = hmm.Expected.none(3, 5), hmm.Expected.none(3, 5)
    short = np.array([0, 4, 5, 7])
    seen.add(model, classes, short)
    for a, b in zip(short[:-1], short[1:], strict=True):
        paths = list(itertools.product(range(3), repeat=int(b - a)))
        p = np.array([np.prod([model.start[s[0]] * model.emit[classes[a], s[0]], *(
            model.move[s[k - 1], s[k]] * model.emit[classes[a + k], s[k]] for k in range(1, b - a))]) for s in paths])
        for s, w in zip(paths, p / p.sum(), strict=True):
            own.start[s[0]] += w
            for k, x in enumerate(s):
                own.emit[classes[a + k], x] += w
                if k:
                    own.move[s[k - 1], x] += w
    assert np.allclose(seen.start, own.start) and np.allclose(seen.move, own.move) and np.allclose(seen.emit, own.emit)


def test_training_counts_of_long_pieces(monkeypatch):
    """Scaled seldom or at each step, the counts are the same, and each token is counted once."""
    rng = np.random.default_rng(7)
    model = hmm.Model(*(x / x.sum(axis=0 if k == 2 else -1, keepdims=True) for k, x in enumerate((rng.random(3), rng.random((3, 3)), rng.random((6, 3))))))
    bounds = np.cumsum([0, 20, 3, 9, 8, 1, 17, 700, 1100])
    classes = rng.integers(0, 6, bounds[-1])
    seen, own = hmm.Expected.none(3, 5), hmm.Expected.none(3, 5)
    seen.add(model, classes, bounds)
    monkeypatch.setattr(hmm, "SCALED", 1)
    own.add(model, classes, bounds)
    assert np.allclose(seen.start, own.start) and np.allclose(seen.move, own.move) and np.allclose(seen.emit, own.emit)
    assert np.allclose(seen.emit.sum(axis=1), np.bincount(classes, minlength=6))


def test_lookup():
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    asked = np.concatenate([keys[::3], rng.integers(0, 1 << 63, 5000, dtype=np.uint64)])
    place = {int(k): n for n, k in enumerate(keys)}
    assert hmm.Lookup(keys)(asked).tolist() == [place.get(int(x), -1) for x in asked]


@pytest.mark.parametrize("known", [1 << 20, 40])
def test_scores(docs, rows, empty, known):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter()
    for i, t in rows:
        if not held[i]:
            counts.update([*spaced(t), None])
    n, v = sum(counts.values()), len(counts)
    bucket = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = hmm.score_documents(docs, bucket, states=3, classes=30, known=known, rounds=1).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, t in rows:
        w = [*spaced(t), None]
        want[(i, held[i], len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 5))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 for r in got)
    if known == 40:
        none = hmm.score_documents(docs, F.lit(True), states=2, classes=8, rounds=1).collect()
        assert {r.train_tokens for r in none} == {0} and all(abs(r.base_score) < 1e-9 for r in none)
        assert hmm.score_documents(empty, bucket, rounds=1).count() == 0


def test_scores_come_from_all_training_texts(spark, tmp_path):
    """The rounds over partitions give the model of a plain loop over all texts, and score is its probability."""
    rng = np.random.default_rng(12)
    kinds = [[f"{k}{n}" for n in range(60)] for k in "ab"]
    rows = [(i, " ".join(rng.choice(kinds[rng.integers(2)], rng.integers(1, 40)))) for i in range(2600)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.score for r in hmm.score_documents(table, F.col("doc_id") % 13 == 0, states=3, classes=50, rounds=3).collect()}
    path = f"file://{tmp_path}/counts"
    hmm.count_tokens(table.filter("doc_id % 13 <> 0"), path)
    v, _ = hmm.load_vocabulary(spark.read.parquet(path), 50, 1 << 20)

    def classes(texts):
        raw, bounds = hmm.utf8(hmm.pa.array(texts))
        hashes, cut = hmm._tokens(raw, bounds)
        return hmm.Lookup(v.hashes)(hashes), cut

    place, cut = classes([t for i, t in rows if i % 13])
    model, prior = hmm.start_model(v, 3), hmm.prior_of(v)
    for _ in range(3):
        seen = hmm.Expected.none(3, v.classes)
        seen.add(model, v.class_of(place), cut)
        model = seen.model(prior)
    for i, t in rows[:200]:
        place, _ = classes([t])
        own = v.class_of(place)
        rare = [math.log((v.counts[p] + 1) / (v.rare_tokens + v.rare_words + 1)) for p, c in zip(place, own, strict=True) if c == v.classes]
        assert math.isclose(got[i], (brute_log10(model, own) + sum(rare)) / math.log(10), rel_tol=1e-9), i


def test_model_is_a_distribution(spark, docs):
    """Over all words of the vocabulary and one unknown, the next word's probabilities sum to one."""
    texts = docs.filter("doc_id is not null").select("text")
    import tempfile

    path = f"file://{tempfile.mkdtemp(prefix='counts-')}/c"
    hmm.count_tokens(texts, path)
    v, _ = hmm.load_vocabulary(spark.read.parquet(path), 20, 1 << 20)
    emit = hmm.prior_of(v)
    own = np.where(v.cls < v.classes, emit[np.minimum(v.cls, v.classes)], emit[v.classes] * (v.counts + 1) / (v.rare_tokens + v.rare_words + 1))
    assert math.isclose(own.sum() + emit[v.classes] / (v.rare_tokens + v.rare_words + 1), 1.0)


def test_memory_of_a_batch_is_bounded():
    """What a task holds beside its batch is a small multiple of a slice, also while it packs."""
    import tracemalloc

    import pyarrow as pa

    from touchline.llm import packing, text, tokens

    column = pa.array([" ".join(f"w{(i * k) % 997}" for k in range(400)) for i in range(4000)])
    raw, bounds = text.utf8(column)
    assert bounds[-1] > 6 << 20
    tokens.encoder(BYTE)
    text._kept_powers.cache_clear()

    def scanned():
        for a, b in text.slices(bounds):
            yield len(text.scan(raw, bounds[a:b + 1], text.SPACED).hash)

    def encoded():
        for _, coded in tokens.encoded_texts(BYTE, column, 0, packing.RUN):
            yield len(coded.ids)

    for run, most in ((scanned, 30), (encoded, 30)):
        tracemalloc.start()
        for _ in run():
            pass
        peak = tracemalloc.get_traced_memory()[1] / (1 << 20)
        tracemalloc.stop()
        assert peak < most, (run.__name__, peak)


def test_likelihood_is_scaled_now_and_then(monkeypatch):
    """The same values with one logarithm for some steps, for texts that end between two scalings too."""
    rng = np.random.default_rng(3)
    emit = rng.random((50, 4)) ** 6
    model = hmm.Model(np.full(4, 0.25), rng.dirichlet(np.ones(4), 4), emit / emit.sum(axis=0))
    sizes = np.array([1, 3, 8, 9, 80, 400])
    bounds = np.append(0, np.cumsum(sizes))
    classes = rng.integers(0, 50, bounds[-1])
    want = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        alpha, total = model.start * model.emit[classes[a]], 0.0
        for c in classes[a + 1:b]:
            total += math.log(alpha.sum())
            alpha = (alpha / alpha.sum()) @ model.move * model.emit[c]
        want.append(total + math.log(alpha.sum()))
    calls, log = [], np.log
    monkeypatch.setattr(np, "log", lambda x: calls.append(1) or log(x))
    got = hmm.log_likelihood(model, classes, bounds)
    assert np.allclose(got, want, rtol=1e-12) and len(calls) <= 400 // hmm.SCALED + len(sizes) + 1


def test_cuts_at_signs_after_letters():
    """Signs are chunks of their own after accented letters too, and the ids stay those of the whole text."""
    import unicodedata

    import pyarrow as pa

    from touchline.llm import tokens as t
    from touchline.llm.text import utf8

    texts = ["café, allé!! d'été's über... ñ|ñ", "a×! b÷, à×.", "é", "!é", unicodedata.normalize("NFD", "é, ñ! ü≠"), "ÿ≠ Ã!  , ß's É'T"]
    raw, bounds = utf8(pa.array(texts))
    at = np.append(t.cuts(raw, bounds), bounds[-1])
    chunks = [raw[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert chunks[:7] == ["café", ",", " allé", "!!", " d", "'été", "'s"]
    assert chunks[chunks.index("a×!"):][:3] == ["a×!", " b÷,", " à×."]  # these two are signs themselves
    for path, end in ((BYTE, 0), (WORD, 2)):
        (_, coded), = t.encoded_texts(path, pa.array(texts), end)
        for k, text in enumerate(texts):
            assert coded.ids[coded.first[k]:coded.first[k + 1]].tolist() == ids_of(path, text, end)


def test_known_chunks_are_not_learned_again():
    """What a worker remembers is looked up only; older chunks move up, and no more are held than allowed."""
    from touchline.llm.tokens import Encoder

    class Counted(dict):
        added = 0

        def update(self, pairs):
            pairs = list(pairs)
            self.added += len(pairs)
            super().update(pairs)

    e = Encoder(BYTE, remembered=8)
    e.known = Counted()
    first = [" aé", " b", " c", " d", " e"]
    want = e._learn(first)
    assert e.known.added == 5 and e._learn(first) == want and e.known.added == 5
    fresh, asked = e._fresh, []
    e._fresh = lambda chunks: asked.extend(chunks) or fresh(chunks)
    for chunks in ([" f", " g", " h", " i"], first, [f" {k}k" for k in range(20)], [" i", " b"]):
        assert e._learn(chunks) == fresh(chunks)
        assert len(e.known) <= 8 and len(e.older) <= 8
    assert not set(first) & set(asked[:24])


def test_texts_are_scored_side_by_side(monkeypatch):
    """One walk for the texts of several slices and batches, not one for each; the rows are the same."""
    import pyarrow as pa

    from touchline.llm import text

    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(60)]
    texts = [None, "", "w1 unknown w2 unknown", *(" ".join(rng.choice(words, n)) for n in (1, 3, 500, 20, 2000, 7))]
    batches = [pa.RecordBatch.from_arrays([pa.array([1, None, *range(2, n)][:n]), pa.array([True, False] * n)[:n], pa.array(part, pa.string())],
                                          ["doc_id", "held_out", "text"]) for part in (texts[:4], texts[4:]) for n in [len(part)]]
    hashes, counts = np.unique(hmm._tokens(*text.utf8(pa.array([" ".join(words)] * 3)))[0], return_counts=True)
    cls = np.where(np.arange(len(hashes)) < 40, np.arange(len(hashes)), 40)
    v = hmm.Vocabulary(int(counts.sum()), len(hashes), hashes, counts, cls, 40, int(counts[40:].sum()), len(hashes) - 40)
    m = hmm.start_model(v, 3)
    monkeypatch.setattr(text.slices, "__defaults__", (1000,))
    calls, walk = [], hmm.log_likelihood
    monkeypatch.setattr(hmm, "log_likelihood", lambda *a: calls.append(len(a[2]) - 1) or walk(*a))
    got = pa.Table.from_batches(hmm._scored(batches, v, m, 5)).to_pylist()
    assert calls == [len(texts)] and [r["row"] for r in got] == list(range(5, 5 + len(texts)))
    monkeypatch.setattr(hmm, "SIDE", 1)
    one = pa.Table.from_batches(hmm._scored(batches, v, m, 5)).to_pylist()
    assert len(calls) > 3
    for r, o, t in zip(got, one, texts, strict=True):
        assert math.isclose(r.pop("own"), o.pop("own"), rel_tol=1e-12) and r == o and r["n_tokens"] == len(spaced(t)) + 1
    assert [x["n"] for x in got[2]["rare"]] == [2] and sum(len(r["rare"]) for r in got) == 1


def test_training_pieces_are_walked_in_equal_parts(monkeypatch):
    """A little more than RUN tokens are one walk, and more are equal ones: a short rest takes as many steps as a full part."""
    rng = np.random.default_rng(8)
    emit = rng.random((31, 3))
    model = hmm.Model(np.full(3, 1 / 3), rng.dirichlet(np.ones(3), 3), emit / emit.sum(axis=0))
    sizes = np.full(30, 40)
    classes, bounds = rng.integers(0, 31, 1200), np.append(0, np.cumsum(sizes))
    monkeypatch.setattr(hmm, "PIECE", 40)
    walked, walk = [], hmm.Expected._walk
    monkeypatch.setattr(hmm.Expected, "_walk", lambda self, m, s: walked.append(int(s.active.sum())) or walk(self, m, s))
    results = []
    for run, most in ((5000, 1), (1150, 1), (500, 2), (280, 4)):
        monkeypatch.setattr(hmm, "RUN", run)
        walked.clear()
        seen = hmm.Expected.none(3, 30)
        seen.add(model, classes, bounds)
        assert sum(walked) == 1200 and len(walked) <= most and max(walked) <= 1.5 * run + 40
        results.append(seen)
    for r in results:
        assert np.allclose(r.emit, results[0].emit) and np.allclose(r.move, results[0].move) and np.isclose(r.emit.sum(), 1200)


def test_counts_travel_in_blocks():
    """Blocks hold the rows with counts only, and add up to the sum over tasks."""
    rng = np.random.default_rng(9)
    tasks = [rng.random((hmm.BLOCK * 2 + 5, 3)) * (rng.random((hmm.BLOCK * 2 + 5, 1)) < share) for share in (0.5, 0.01, 0.0)]
    blocks = [list(hmm._blocks(rows)) for rows in tasks]
    assert blocks[2] == [] and sum(len(at) // 4 for b in blocks for _, at, _ in b) == sum(int(rows.any(axis=1).sum()) for rows in tasks)
    added = hmm._added([x for b in blocks for x in b], {}, 3)
    assert np.allclose(np.concatenate([added[k] for k in range(3)])[:hmm.BLOCK * 2 + 5], sum(tasks))
    assert hmm._batch([]).num_rows == 0


def test_lists_of_a_segment_stay_in_arrow():
    """A row of the files keeps its lists as arrays, null ids included, and decodes to the ids it was made of."""
    import pyarrow as pa

    from touchline.llm import token_files as f

    ids = np.random.default_rng(2).integers(0, 900, 5000, dtype=np.uint32)
    c = rans.encode(ids)
    row = (3, 0, 0, len(ids), [None, 7], [4000, 1000], c.bits, c.symbols, c.freqs, c.offsets, c.states.astype("<u8").tobytes(),
           f._block_sums(ids), c.words.astype("<u4").tobytes())
    batch = pa.RecordBatch.from_arrays([pa.array([v, v], t.type) for v, t in zip(row, f._ARROW, strict=True)], schema=f._ARROW)
    got = f._values(batch, 1)
    assert all(isinstance(got[t.name], pa.Array) == pa.types.is_list(t.type) for t in f._ARROW)
    assert got["doc_ids"].to_pylist() == [None, 7] and (rans.decode(f._segment(got)) == ids).all()
