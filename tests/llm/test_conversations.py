"""Repaired conversations against a search through all edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from touchline.llm.conversations import EDITS, START, TAIL, block_options, cheapest, damage, forward, repair_report, repaired_turns, row_options

SCHEMA = "conv_id long, turn long, role string, text string, conv string, has int, digest string, block int, edit string, mark int"


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(c, t, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def brute_repair(rows):
    """The cheapest edits, then the least audit: every edit and up to two inserted turns before each row, kept per last role with whole audits."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
    states = {"": (0, "", ())}

    def add(states, key, value):
        if key not in states or value < states[key]:
            states[key] = value

    def follow(key):
        return {"": "su", "s": "u", "u": "a", "a": "u", "xu": "a", "xa": "u"}[key]

    def insert(states):
        for _ in range(2):
            for key, (cost, audit, lines) in list(states.items()):
                name = "assistant" if follow(key)[-1] == "a" else "user"
                add(states, "x" + name[0], (cost + 5, audit + "I", (*lines, name + ":")))
        return states

    for (_, _, role, text), fault in zip(rows, faults):
        before, states = insert(dict(states)), {}
        for key, (cost, audit, lines) in before.items():
            add(states, key, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if role[:1] and role[0] in follow(key):
                add(states, "s" if role[0] == "s" else "x" + role[0], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            name = "assistant" if follow(key)[-1] == "a" else "user"
            add(states, "x" + name[0], (cost + extra + 1, audit + "R", (*lines, f"{name}:{text}")))
    ends = [v for k, v in insert(dict(states)).items() if k in ("", "a", "xa")]
    cost, audit, lines = min(ends)
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_report(rows, names):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in names}
    for c, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        out[c] = brute_repair(own)
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(11)
    rows = []
    for c in [*range(60), None]:
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"])
            text = rng.choice(["Yes.", "No?", "and then", "  ", "", None, "Fine! \n", "same.", f"text {rng.random():.3f}.", "ends\x0b.\t", "日本。", "."])
            rows.append((c, rng.choice([t, t, t, t + rng.randint(0, 4), None, 1]), role, text))
    rows += rows[5:9]
    long = [(1000, t, ["user", "assistant"][t % 2] if rng.random() < 0.8 else "system", rng.choice(["a.", "b", f"{t}."])) for t in range(300)]
    return rows + long + [(1001, 3, "user", None), (-5, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "d", 2, "e", 3) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("block", [50_000, 3])
def test_report(spark, talks, block):
    from pyspark.sql import functions as F

    df = frame(spark, talks)
    got = repair_report(damage(df), df.select(F.col("conv_id").alias("conv")), rows_per_block=block)
    want = brute_report(brute_damage(talks), {r[0] for r in talks})
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_turns(spark, talks):
    df = damage(frame(spark, talks))
    report = {r.conv_id: r for r in repair_report(df).collect()}
    rows = defaultdict(list)
    for r in repaired_turns(df, rows_per_block=7).collect():
        rows[r.conv].append(r)
    assert None in rows
    for conv, own in rows.items():
        own.sort(key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r.role[:1] for r in own))
        text = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == report[conv].repaired_sha256
        assert [r.edit for r in own] == [e for e in report[conv].audit if e != "D"]


def test_empty(spark):
    df = frame(spark, [])
    assert repair_report(damage(df)).count() == 0 and repaired_turns(damage(df)).count() == 0


def test_blocks_compose():
    """A block as one item leads to the same costs and orders as its rows."""
    rng = random.Random(2)
    for _ in range(60):
        items = [row_options(rng.choice("sua?"), rng.random() < 0.3, rng.random() < 0.2) for _ in range(rng.randint(1, 12))]
        cut = rng.randint(1, len(items))
        whole = forward(items, 0, len(items), START)
        parts = [block_options(items[:cut])] + ([block_options(items[cut:])] if cut < len(items) else [])
        assert forward(parts, 0, len(parts), START) == whole
        audit = "".join(EDITS[o] for _, o in cheapest(items, START, None))
        end = cheapest(items, START, None)[-1][0]
        cost = min(x[0] + TAIL[s] * 5 for s, x in enumerate(whole) if x is not None)
        assert whole[end][0] + TAIL[end] * 5 == cost and audit
