"""Small corpora with copies, junk and odd rows."""

from __future__ import annotations

import random

import pytest

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


@pytest.fixture
def words():
    """A generator of invented words."""

    def make(seed: int, n: int, vocabulary: int = 400) -> list[str]:
        rng = random.Random(seed)
        known = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(vocabulary)]
        return rng.choices(known, k=n)

    return make


@pytest.fixture
def corpus(words):
    """(doc_id, text) with exact copies, near copies, short, blank, null and long texts."""
    rng = random.Random(3)
    texts = [" ".join(words(k, rng.randint(30, 120))) for k in range(40)]
    for k in range(0, 20, 2):
        own = texts[k].split()
        for _ in range(rng.randint(1, 12)):
            copy = list(own)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(SYLLABLES) * 2
            texts.append(rng.choice([" ", "\n", " \t"]).join(copy).replace("the", "THE"))
    texts += ["", None, "  \n", "one", "One", "one two three", " ".join(words(99, 5000)), "é ü 漢字 😀 ok"]
    rows = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows
