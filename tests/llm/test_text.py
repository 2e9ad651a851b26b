import random
import re

import numpy as np
import pyarrow as pa

from txnspark.llm import text as T

LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def reference_sets(text, width):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOW))
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + width]) for k in range(len(found) - width + 1)}


def test_shingles_stand_for_word_sequences():
    rng = random.Random(1)
    texts = [None, "", " ", "a", "A b", "a b c d", "ab c d", "a bc d", "d c b a"] + [
        "".join(rng.choices("aBc é漢😀\t\n\x0b ", k=rng.randint(0, 80))) for _ in range(300)
    ]
    for piece in (64, T.PIECE):
        sets = {}
        raw, at = T.utf8(pa.array(texts))
        for first, last in T.pieces(at, piece):
            low = T.LOWER[raw[at[first] : at[last]]]
            values, bounds = T.shingles(T.words(low, at[first : last + 1] - at[first]), 4)
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]), first):
                sets[k] = frozenset(np.unique(values[a:b]).tolist())
        told = {}
        for k, t in enumerate(texts):
            own = reference_sets(t, 4)
            assert len(sets[k]) == len(own)
            assert told.setdefault(sets[k], own) == own  # equal hashes, equal sequences
        assert len(set(sets.values())) == len({frozenset(reference_sets(t, 4)) for t in texts})


def test_slices_of_a_column_and_large_strings():
    column = pa.array(["x y", None, "p q r", "s"], pa.large_string())
    got = [len(s) for _, sets in T.shingle_sets(column.slice(1, 3), 2) for s in sets]
    assert got == [0, 2, 1]
    assert list(T.shingle_sets(pa.array([], pa.string()), 2)) == []
