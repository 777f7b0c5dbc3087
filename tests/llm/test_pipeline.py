"""The pipeline's stages against brute force on the smallest table."""

import duckdb
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import low, plain, spaced

SF = "/root/testdata/sf0.001"


def test_every_stage(spark, tmp_path):
    rows = dict(duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    extra = [(10_001, None), (10_002, "12 34 !!"), (10_003, rows[0].upper()), (10_004, rows[1] + " tail")]
    items = [plain(t) for _, t in duckdb.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()]
    columns = spark.read.parquet(f"{SF}/documents.parquet")
    added = spark.createDataFrame([(i, t, None, "x", 0) for i, t in extra], columns.schema)
    docs = columns.unionByName(added)
    rows |= dict(extra)

    def words(t, n):
        w = spaced(t)
        return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())

    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept = {r.doc_id for r in docs.collect()}
        if name == "language_id":
            want = {i for i, t in before.items() if any(c.isalpha() for c in t or "")}
        elif name == "exact_dedup":
            best = {}
            for i, t in before.items():
                best[low(t)] = max(i, best.get(low(t), i))
            want = set(best.values())
        elif name == "near_dedup":
            sets = {i: words(t, 5) for i, t in before.items()}
            label = {i: i for i in sets}
            ids = sorted(sets)
            links = [(x, y) for x in ids for y in ids if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
            for _ in range(20):
                for x, y in links:
                    label[x] = label[y] = min(label[x], label[y])
            want = {i for i in ids if label[i] == i}
        else:
            def hit(t):
                own = " " + " ".join(plain(t)) + " "
                return any(f" {' '.join(w[a:a + min(10, len(w))])} " in own for w in items if w for a in range(max(1, len(w) - 9)))

            want = {i for i, t in before.items() if not hit(t)}
        assert kept == want, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    assert {r.doc_id: r.n for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == sizes
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").isEmpty()


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 11)}


def test_stages_bound_what_a_worker_holds(spark, docs):
    import tracemalloc

    from touchline.llm import language

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key, None)
    try:
        for stage in (corpus_pipeline.known_language, corpus_pipeline.without_near_copies, corpus_pipeline.packed):
            spark.conf.set(key, str(64 << 20))
            stage(spark, docs, "")
            assert int(spark.conf.get(key)) <= 2 << 20
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)
    classifier = language.Classifier([("en", language.grams(["some words of it"]).code.tolist())], 400)
    texts = ["Some words of a text, and some more of them. " * 200] * 200
    language._letters()
    tracemalloc.start()
    got = [name for _, run in language._runs(texts) for name in classifier.predict(run)[0]]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == ["en"] * len(texts) and peak < 40e6, peak
