"""Exact duplicates, near duplicates, components and similar lines against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import low, spaced
from touchline.llm.components import components
from touchline.llm.exact_dedup import drop_duplicates, duplicate_groups
from touchline.llm.line_dedup import banded_distance, drop_repeated_lines, line_report
from touchline.llm.minhash import near_duplicates


def same(got, want):
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_exact_groups(docs, rows, empty):
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    want = []
    for i, t in rows:
        ids = groups[low(t)]
        want.append((i, max((x for x in ids if x is not None), default=None), len(ids)))
    got = duplicate_groups(docs, [F.col("doc_id")])
    same(got.select("doc_id", "keep_id", "group_size").collect(), want)
    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(low(r.text) for r in kept.collect()) == sorted(groups)  # one of each, repeated rows too
    assert drop_duplicates(empty).count() == 0


def test_exact_groups_differ_late(spark):
    """Texts that are equal over many digits."""
    texts = ["a" * 5000 + x for x in ("", "b", "b", "c")] + ["a" * 5000]
    got = duplicate_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), [F.col("doc_id")])
    same(got.select("doc_id", "keep_id", "kept").collect(), [(0, 4, False), (4, 4, True), (1, 2, False), (2, 2, True), (3, 3, True)])


def brute_components(rows, size, percent=80):
    sets, order, sizes = {}, [], []
    for i, t in rows:
        w = spaced(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
        order.append(i)
        sizes.append(len(sets[i]))
    label = {i: i for i in sets}
    ids = [i for i in sets if sets[i] and i is not None]
    changed = True
    links = [(x, y) for x in ids for y in ids if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])]
    while changed:
        changed = False
        for x, y in links:
            least = min(label[x], label[y])
            changed |= label[x] != least or label[y] != least
            label[x] = label[y] = least
    return [(i, n, label[i], i is None or label[i] == i) for i, n in zip(order, sizes, strict=True)]


def test_near_duplicates(docs, rows, empty):
    for size in (2, 5):
        same(near_duplicates(docs, words=size).collect(), brute_components(rows, size))
    assert near_duplicates(empty).count() == 0


def test_near_duplicates_in_large_groups(spark):
    """One group of copies, one of near copies beyond a block, and a word that all share."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    rows, base = [], rng.choices(words, k=80)
    for k in range(330):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(80)] = f"edit{k}"
        rows.append((k, " ".join(text)))
    rows += [(1000 + k, "the same text over and over") for k in range(200)]
    rows += [(2000 + k, "common words first " + " ".join(rng.choices(words, k=12))) for k in range(200)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words=2)
    same(got.collect(), brute_components(rows, 2))


def test_near_duplicates_that_link_with_few(spark, monkeypatch):
    """Copies with edits that others have too, far from most of their group: few pairs are verified, and no link is lost."""
    from touchline.llm import minhash

    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(400):
        text = list(base)
        for at in rng.sample(range(150), rng.randint(0, 4) if k % 3 else rng.randint(10, 16)):
            text[at] = f"other{at}"
        rows.append((k, " ".join(text)))
    rows += [(1000 + k, f"{t} {t.split()[0]}{k}") for k, t in rows[:60]]  # a link of each
    pairs, links = [], minhash._links

    def counted(found, *rest):
        pairs.append(found.count())
        return links(found, *rest)

    monkeypatch.setattr(minhash, "_links", counted)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words=2).collect()
    want = brute_components(rows, 2)
    same(got, want)
    assert len({label for _, _, label, _ in want}) > 50
    assert pairs[-1] < len(rows)  # those across components


def test_parity_sketches():
    from touchline.llm.minhash import parity_sketch

    rng = random.Random(9)
    for size in (0, 1, 100, 3000):
        x, y = ({rng.getrandbits(12) << 52 | 5 * rng.getrandbits(12) for _ in range(size)} for _ in "xy")
        a, b = (parity_sketch(np.array(sorted(v), np.uint64)) for v in (x, y))
        assert len(a) == 16 and sum(int(v).bit_count() for v in (a ^ b).view(np.uint64)) <= len(x ^ y)


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(60)] + [(5, 5)]
    label = {}
    for x, y in edges:
        if x != y:
            label.setdefault(x, x), label.setdefault(y, y)
    for _ in range(200):
        for x, y in edges:
            if x != y:
                label[x] = label[y] = min(label[x], label[y])
    links = spark.createDataFrame([(y, x) if k % 2 else (x, y) for k, (x, y) in enumerate(edges)], "a long, b long")
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert got == label
    assert components(links.limit(0), "a", "b").count() == 0


def test_banded_distance(spark):
    rng = random.Random(9)
    pairs = [("", ""), ("", "a"), ("é", "e"), ("abc", "abcdef")]
    for _ in range(400):
        a = rng.choices("abé", k=rng.randint(0, 24))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at, kind = rng.randint(0, len(b)), rng.random()
            if kind < 0.4 or at == len(b):
                b.insert(at, rng.choice("abé"))
            elif kind < 0.7:
                b.pop(at)
            else:
                b[at] = rng.choice("abé")
        pairs.append(("".join(a), "".join(b)))
    table = spark.createDataFrame(pairs, "x string, y string")
    for limit in (1, 2, 3):
        own = banded_distance(F.col("x"), F.col("y"), limit)
        for r in table.select("x", "y", own.alias("d"), F.levenshtein("x", "y").alias("true")).collect():
            assert (r.d == r.true) if r.true <= limit else (r.d > limit), r


def test_lines(spark, docs, rows, empty):
    line = "This is a line of some length, number one."
    extra = [(1, f"{line}\nshort\n{line}"), (2, f"short\n{line.replace('one', 'ond')}\nother text altogether here"), (3, f"{line}x\n\n{line}yz"),
             (4, "zhort\nshort"), (5, None), (6, "")]
    table = spark.createDataFrame(extra, "doc_id long, text string")
    first, links = {}, Counter()
    for i, t in extra:
        for pos, one in enumerate((t or "").split("\n")):
            if one:
                first.setdefault(one, (i, pos))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    kept = {}
    for a in first:
        near = [b for b in first if a != b and min(len(a), len(b)) >= 16 and distance(a, b) <= 2]
        links[first[a][0]] += len(near)
        kept[a] = all(first[a] < first[b] for b in near)
    want, texts = [], []
    for i, t in extra:
        lines = [(pos, one) for pos, one in enumerate((t or "").split("\n")) if one]
        stay = [one for pos, one in lines if first[one] == (i, pos) and kept[one]]
        want.append((i, len(lines), links[i], len(lines) - len(stay)))
        texts.append((i, "\n".join(stay)))
    same(line_report(table).collect(), want)
    same(drop_repeated_lines(table).collect(), texts)
    report = line_report(docs)
    assert report.columns == ["doc_id", "n_lines", "n_links", "n_dropped"]
    assert report.count() == len({i for i, _ in rows})
    assert line_report(empty).count() == 0


def test_text_digest(docs, rows):
    from touchline.llm.exact_dedup import normalised

    got = docs.select("doc_id", F.sha2(normalised(F.col("text")).cast("binary"), 256)).collect()
    same(got, [(i, hashlib.sha256(low(t).encode()).hexdigest()) for i, t in rows])


def test_rows_beyond_the_broadcast_are_joined(spark, monkeypatch):
    """The other way to the texts of candidates gives the same."""
    from touchline.llm import line_dedup, minhash

    rows = [(1, "one two three four five six seven eight nine ten eleven"), (2, "one two three four five six seven eight nine ten twelve"),
            (3, "something else\nA line that is long enough to count."), (4, "A line that is long enough to count!\nyet another"), (5, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = near_duplicates(table, words=2).collect(), line_report(table).collect()
    monkeypatch.setattr(minhash, "BROADCAST", 0)
    monkeypatch.setattr(line_dedup, "BROADCAST", 0)
    same(near_duplicates(table, words=2).collect(), want[0])
    same(line_report(table).collect(), want[1])
    assert {r.component_id for r in want[0] if r.doc_id < 3} == {1} and sum(r.n_dropped for r in want[1]) == 1


def test_lines_of_every_length(spark):
    """With no least length, links are those of brute force, down to one character."""
    rng = random.Random(11)
    lines = ["Page 12 of 30", "Page 13 of 30", "Stteen Erachtz.", "Steen Erachtz.", "a", "é", "abc", "xyz"]
    lines += ["".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(150)]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    first = {line: k for k, line in reversed(list(enumerate(lines)))}
    pairs = spark.createDataFrame([(a, b) for a in first for b in first if a < b], "a string, b string")
    links, late = Counter(), set()
    for r in pairs.filter(F.levenshtein("a", "b") <= 2).collect():
        x, y = sorted((first[r.a], first[r.b]))
        links.update((x, y))
        late.add(y)
    want = [(k, 1, links[k] if first[line] == k else 0, int(first[line] != k or k in late)) for k, line in enumerate(lines)]
    same(line_report(table, shortest=1).collect(), want)
    assert links[0] >= 1 and links[2] >= 1


def test_pairs_of_long_lists_are_made_once(spark):
    """Two that meet in several long lists make one row, in a short list they make theirs."""
    from touchline.llm.minhash import BLOCK, _meetings

    ids, values = range(BLOCK + 6), range(5)
    mixed = spark.createDataFrame(
        [(v, BLOCK + 6, i, 30, i, 0) for v in values for i in ids] + [(9, 3, i, 30, i, 1) for i in (1, 2, 3)],
        "value long, members long, id long, n long, component long, main long")
    same_sets = spark.createDataFrame([(i, [0] * 8) for i in ids], "id long, parity array<long>")
    got = Counter((r.a, r.b) for r in _meetings(mixed, same_sets, 80).collect())
    assert set(got) == {(a, b) for a in ids for b in ids if a < b}
    assert {p for p, k in got.items() if k > 1} == {(1, 2), (1, 3), (2, 3)}


def edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return row[-1]


def test_crowds_of_lines(spark, monkeypatch):
    """Lines of a large group of edited copies: each link is found, and most pairs that share a segment only are not verified."""
    from touchline.llm import line_dedup

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(24)]
    lines = {"a" * 20, "a" * 21, "a" * 23, "short one", "é" * 18, "é" * 17 + "ab"}
    for _ in range(70):
        own = list(words)
        for _ in range(3):
            own[rng.randrange(8, 24)] = "".join(rng.choices("abcdefghij", k=6))
        line = " ".join(own)
        at = rng.randrange(len(line))
        lines |= {line, line[:at] + rng.choice(["", "x", "xy"]) + line[at + 1:]}
    lines = sorted(lines)
    long_ = [x for x in lines if len(x) >= 16]
    want = sum(edits(x, y) <= 2 for x in long_ for y in long_ if abs(len(x) - len(y)) <= 2 and x != y)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    paths, path = [], line_dedup.scratch_path
    monkeypatch.setattr(line_dedup, "scratch_path", lambda s, name: paths.append((name, path(s, name))) or paths[-1][1])
    candidates = []
    for crowd in (10_000, 8, 0):
        monkeypatch.setattr(line_dedup, "CROWD", crowd)
        assert sum(r.n_links for r in line_report(docs).collect()) == want, crowd
        candidates.append(spark.read.parquet([p for n, p in paths if n == "candidates"][-1]).count())
    assert want / 2 <= candidates[2] <= candidates[1] < candidates[0] / 2


def test_lines_that_share_a_segment_make_few_rows(spark, monkeypatch):
    """A segment of 30 lines that share nothing else makes a row for each of them, and no candidates."""
    from touchline.llm import line_dedup

    rng = random.Random(6)
    lines = ["the same words in every line of these" + "".join(rng.choices("abcdefghij", k=74)) for _ in range(30)]
    lines += [lines[0] + "x", lines[1][:60] + lines[1][61:]]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    paths, path = [], line_dedup.scratch_path
    monkeypatch.setattr(line_dedup, "scratch_path", lambda s, name: paths.append((name, path(s, name))) or paths[-1][1])
    assert {r.doc_id: r.n_links for r in line_report(docs).collect()} == {k: int(k in (0, 1)) + int(k > 29) for k in range(32)}
    made = {name: spark.read.parquet(p).count() for name, p in paths}
    assert made["met"] <= 4 * len(lines) and made["candidates"] <= 2 * len(lines), made
