"""A small table with every awkward case, and the words of a text as the contracts define them."""

import random
import re

import pytest

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SCHEMA = ("doc_id long, text string, lang string, source string, id long, size long, rest binary, n long, a long, b long, "
          "value long, key string, best string, row string, part long, hash long, component long, spans string, digit string")


def low(text):
    return (text or "").translate(str.maketrans(UPPER, UPPER.lower()))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def awkward_texts():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefgéßñ", k=rng.randint(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    base, other = prose(120), prose(90)
    near = base.split()
    near[60] = "changed"
    far = base.split()
    far[::4] = prose(30).split()
    texts = [
        None, "", "   \n\t ", "One", "one", "ONE", "one two", "One  two", "123 456", "!!! ???", "Äpfel ÄPFEL äpfel",
        base, base, base.upper().replace("É", "é").replace("Ñ", "ñ"), base + " ", " ".join(near), " ".join(far), other,
        other + " tail", other.replace(" ", "\n", 5), prose(30_000), "x" * 50_000, "a\x00b c\x1fd \x0be", "日本 語。 テスト", "  a  b  ",
        "a\n\nb\r\nc", "<|endoftext|> it's 'tis we'll", "﻿mark   nbsp em", "😀 😀😀 a😀",
    ]
    texts += [prose(rng.randint(1, 60)) for _ in range(40)]
    return texts


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): ids in no order, one repeated row, one without id."""
    texts = awkward_texts()
    ids = list(range(100, 100 + len(texts)))
    random.Random(3).shuffle(ids)
    out = list(zip(ids, texts, strict=True))
    return [*out, out[11], (None, "no id here at all"), (None, texts[11])]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns whose names the operators use inside."""
    rest = ("src", 1, 2, None, 3, 4, 5, 6, "k", "b", "r", 7, 8, 9, "s", "d")
    return spark.createDataFrame([(i, t, "xx" if k % 3 else None, *rest) for k, (i, t) in enumerate(rows)], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
