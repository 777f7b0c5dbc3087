"""Decontamination, languages and licences against brute force."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import plain
from touchline.llm.decontaminate import contamination_report, drop_contaminated, drop_spans, find_contamination
from touchline.llm.language import identify, learn_profiles
from touchline.llm.licenses import TEMPLATES, bigrams_of, scan_licenses


def brute_hits(text, items, size=10):
    words, hit, owners = plain(text), set(), set()
    for item, t in items:
        w = plain(t)
        n = min(size, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at:at + n] == w[a:a + n]:
                    hit.update(range(at, at + n))
                    if item is not None:
                        owners.add(str(item))
    return len(words), len(hit), sorted(owners)


@pytest.fixture(scope="module")
def benchmark(spark, rows):
    long_ = max((t for _, t in rows if t and len(t) < 2000), key=len)
    words = long_.split()
    items = [(1, " ".join(words[10:35])), (2, " ".join(words[30:38])), (10, "One"), (3, None), (4, " !! "), (None, " ".join(words[50:62])),
             (2, " ".join(words[30:38])), (7, " ".join(words[5:16]).upper())]
    return items, spark.createDataFrame(items, "item_id long, text string")


def test_contamination(docs, rows, benchmark, empty):
    items, table = benchmark
    want = []
    for i, t in rows:
        n, hit, owners = brute_hits(t, items) if t is None or len(t) < 60_000 else (len(plain(t)), None, None)
        if hit is not None:
            want.append((i, n, hit, len(owners), hashlib.sha256(",".join(owners).encode()).hexdigest(), hit > 0))
    long_ids = {i for i, t in rows if t is not None and len(t) >= 60_000}
    got = [tuple(r) for r in contamination_report(docs, table).collect() if r.doc_id not in long_ids]
    assert Counter(got) == Counter(want) and any(w[5] for w in want)
    dropped = {w[0] for w in want if w[5]}
    kept = drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()}.isdisjoint(dropped - {None})
    assert kept.count() == docs.count() - sum(w[5] for w in want)
    assert drop_contaminated(empty, table).count() == 0
    assert drop_contaminated(docs, table.limit(0)).count() == docs.count()


def test_contamination_in_several_sets(docs, benchmark):
    _, table = benchmark
    one = find_contamination(docs, table).select("doc_id", "found").collect()
    many = find_contamination(docs, table, block=5).select("doc_id", "found").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_spans_are_cut(docs, benchmark):
    _, table = benchmark
    cut = drop_spans(docs, table)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    before = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    found = {r.doc_id: r.found.spans for r in find_contamination(docs, table).collect() if r.doc_id is not None}
    for r in cut.collect():
        if r.doc_id is not None:
            gone = {k for a, b in found[r.doc_id] for k in range(a, b)}
            assert plain(r.text) == [w for k, w in enumerate(plain(before[r.doc_id])) if k not in gone]
            assert gone or r.text == before[r.doc_id]


def test_profiles_are_counts(spark):
    from touchline.llm.language import grams

    found = grams(["Ab a", "", "b!"])
    assert sorted(found.text.tolist()) == [0] * 11 + [2] * 4
    one = [ord(c) for c in "abab"]
    assert sorted(found.code[found.code < 1 << 21].tolist()) == sorted(one)
    table = spark.createDataFrame([("Ab a", "x"), (None, "x"), ("bb", None), ("c", "y")], "text string, lang string")
    profiles = dict(learn_profiles(table))
    assert set(profiles) == {"x", "y"} and profiles["x"][0] == ord("a")


def test_language(spark, docs, rows, empty):
    taught = [("le chat et la souris sont dans la maison", "fr"), ("der hund und die katze sind in dem haus", "de"),
              ("the cat and the dog are in the house", "en")]
    profiles = learn_profiles(spark.createDataFrame(taught, "text string, lang string"))
    own = spark.createDataFrame([(1, "The dog and the cat"), (2, "die katze und der hund"), (3, "la souris et le chat"), (4, "123 --"), (5, None), (6, "")],
                                "doc_id long, text string")
    got = {r.doc_id: r for r in identify(own, profiles).collect()}
    assert [got[k].lang_pred for k in range(1, 7)] == ["en", "de", "fr", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[4].score == 0
    out = identify(docs, profiles, lang_name="key", score_name="n")
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == len(rows)
    for r in out.select("text", "key").collect():
        assert (r.key == "und") == (not any(c.isalpha() for c in r.text or "")), r
    assert {r.lang_pred for r in identify(docs, []).collect()} == {"und"}
    assert learn_profiles(empty) == [] and identify(empty, profiles).count() == 0


def test_held_out_accuracy(spark):
    from touchline.llm.queries import QUERIES, table

    sf = "/root/testdata/sf0.001"
    got = QUERIES["op5_language_id"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.95


def test_licenses(spark, docs, rows, empty):
    mit = next(t for name, t in TEMPLATES if name == "MIT" and len(t) > 300)
    broken = mit.replace(", ", ",\n", 6)
    own = [(1, "Some text.\nReleased under the MIT License.\nmore"), (2, f"intro\n\n{broken}\n\nend"), (3, "Licensed under the Apache Licence"),
           (4, None), (5, ""), (6, "LICENSED UNDER CC-BY-NC 4.0!\nLicensed under the Apache License, Version 2.0"), (7, "license " * 300)]
    templates = [(name, set(bigrams_of(t))) for name, t in TEMPLATES]

    def brute(text):
        if text is None:
            return 0, 0, None, None, ""
        units = text.split("\n") + [p for p in re.split(r"\n[ \t\r]*\n", text) if "\n" in p]
        matched, hits = 0, []
        for u in units:
            g = set(bigrams_of(u))
            own_hits = [(-2.0 * len(g & t) / (len(g) + len(t)), name) for name, t in templates if g and 2.0 * len(g & t) / (len(g) + len(t)) >= 0.8]
            matched += bool(own_hits)
            hits += own_hits
        best = min(hits, default=(None, None))
        return len(units), matched, best[1], None if best[0] is None else -best[0], ",".join(sorted({n for _, n in hits}))

    table = spark.createDataFrame(own, "doc_id long, text string")
    assert Counter(map(tuple, scan_licenses(table).collect())) == Counter((i, *brute(t)) for i, t in own)
    assert {r.doc_id: r.license for r in scan_licenses(table).collect()}[2] == "MIT"
    assert scan_licenses(docs).count() == len(rows) and scan_licenses(empty).count() == 0


def test_licenses_inside_their_unit(spark):
    """Notices in comments, behind a copyright line, in prose, and after a word as comment leader."""
    def text(name, k):
        return [t for n, t in TEMPLATES if n == name and len(t) > 100][k]

    def lines(t, size=9):
        words = t.split(" ")
        return [" ".join(words[k:k + size]) for k in range(0, len(words), size)]

    def block(*paragraphs):
        return "/*\n * Copyright (c) 2020 Jane Doe\n" + " *\n".join(" * " + "\n * ".join(lines(p)) + "\n" for p in paragraphs) + " */\nint main(void);"

    gpl2 = text("GPL-3.0", 0).replace("version 3", "version 2")
    own = [
        (1, block(text("MIT", 0), text("MIT", 1)), "MIT"), (2, block(text("GPL-3.0", 0), text("GPL-3.0", 1)), "GPL-3.0"),
        (3, "\n".join("# " + x for x in lines(text("GPL-3.0", 0)) + ["", "import os"] + lines(text("GPL-3.0", 1))), "GPL-3.0"),
        (4, block(text("BSD-2-Clause", 0)), "BSD-2-Clause"), (5, "Copyright 2020 Jane Doe. Released under the MIT License.", "MIT"),
        (6, "Here we say a few words about our code, which was released under the MIT License. and then we go on for quite a while yet", "MIT"),
        (7, "\n".join("dnl " + x for x in lines(text("ISC", 0), 3)), "ISC"), (8, block(gpl2), "GPL-2.0"),
        (9, "a permission was granted under the law, the software is free and the license says so", None), (10, "under the\nlicense mit", None),
        (11, "The above copyright notice and this permission notice shall be included in all copies of the software. Thanks!", "MIT"),
    ]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame([r[:2] for r in own], "doc_id long, text string")).collect()}
    assert {i: got[i].license for i, _, _ in own} == {i: name for i, _, name in own}
    assert got[5].dice == got[6].dice == got[1].dice == got[7].dice == 1 and got[9].licenses == "" and got[9].dice is None


def test_best_passage(spark):
    """The best run of all, by brute force."""
    import random

    rng = random.Random(4)
    chosen = [t for t in TEMPLATES if 8 <= len(bigrams_of(t[1])) <= 30][:6]
    texts = []
    for _ in range(60):
        words = re.findall("[a-z0-9]+", rng.choice(chosen)[1].lower())
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = rng.choice([["other"], ["of", "the"], []])
        texts.append(" ".join(rng.choices(["some", "of", "the", "work"], k=rng.randint(0, 12)) + words + rng.choices(["is", "a", "license"], k=5)))

    def best(text):
        words, top = re.findall("[a-z0-9]+", text), {}
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        for name, t in chosen:
            want = set(bigrams_of(t))
            score = max(2 * len(want & set(pairs[a:b])) / (len(want) + len(set(pairs[a:b]))) for a in range(len(pairs)) for b in range(a + 1, len(pairs) + 1))
            if score >= 0.8:
                top[name] = max(score, top.get(name, 0))
        return max(top.values(), default=None), ",".join(sorted(top))

    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in scan_licenses(table, chosen, paragraphs=[]).collect():
        assert (r.dice, r.licenses) == (pytest.approx(best(texts[r.doc_id])[0]), best(texts[r.doc_id])[1]), texts[r.doc_id]
