import itertools
import math
import random

import numpy as np
import pytest

from cinderpost.llm import common, hamming

SPACE = " \t\n\x0b\x0c\r"


def shingle_set(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    ws = "".join(" " if c in SPACE else c for c in text).split(" ")
    ws = [w for w in ws if w]
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) > 4 else ({tuple(ws)} if ws else set())


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * len(sets[i] | sets[j]):
            label[top(i)] = top(j)
    smallest = {}
    for i, r in enumerate(rows):
        ids = [x for x in (smallest.get(top(i)), r[0]) if x is not None]
        smallest[top(i)] = min(ids, default=None)
    return [(r[0], len(sets[i]), smallest[top(i)], r[0] == smallest[top(i)]) for i, r in enumerate(rows)]


def found(docs, **settings):
    out = hamming.deduplicated(docs, **settings)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted([tuple(r) for r in out.collect()], key=str)


def collection(seed, n=90, edits=(0, 0, 1, 1, 2, 3)):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(k)] for k in (60, 120, 9, 200)]
    rows = []
    for i in range(n):
        ws = list(rng.choice(base))
        for _ in range(rng.choice(edits)):
            ws[rng.randrange(len(ws))] = word()
        rows.append((i, " ".join(ws).upper() if i % 7 == 0 else "\t".join(ws)))
    return rows


ODD = [
    (200, "two words"), (201, "Two  words\n"), (202, ""), (203, None), (204, " \t"), (205, "two words more"),
    (206, "two words"), (206, "two words"), (None, "two words"), (None, "alone"), (207, "ÀB c"), (208, "àb c"),
]


@pytest.mark.parametrize("block", [hamming.BLOCK, 700])
def test_equals_brute_force(make_docs, block):
    rows = collection(1) + ODD
    assert found(make_docs(rows), loss=1e-7, block=block) == sorted(brute(rows), key=str)


def test_chains_that_the_smallest_member_does_not_link(make_docs, monkeypatch):
    # Copies of a base that is linked to all of them, while they are hardly linked to each other.
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for i in range(60):
        ws = list(base)
        for at in rng.sample(range(40), 3):
            ws[5 * at] = f"x{i}-{at}"
        rows.append((i, " ".join(ws)))
    monkeypatch.setattr(hamming, "PER_CENTRE", 7)
    assert found(make_docs(rows), loss=1e-7, block=3000) == sorted(brute(rows), key=str)


def test_joins_beyond_the_broadcast_limit(make_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    rows = collection(2, 40) + ODD
    assert found(make_docs(rows), loss=1e-7) == sorted(brute(rows), key=str)


def test_long_and_empty(make_docs):
    long = " ".join(f"w{i % 9001}" for i in range(60_000))
    rows = [(3, long), (1, long + " end"), (2, "x"), (4, "y " * 30_000)]
    assert found(make_docs(rows)) == sorted(brute(rows), key=str)
    assert found(make_docs(rows).limit(0)) == []


def test_masked_chunks_meet_within_the_distance():
    chunks = hamming.plan()
    differ, n = 0.15, hamming.VALUES
    beyond = sum(math.comb(n, k) * differ**k * (1 - differ) ** (n - k) for k in range(chunks.distance + 1, n + 1))
    assert beyond <= hamming.LOSS
    masked = hamming._masked(chunks).func
    rng = np.random.default_rng(1)
    import pandas as pd

    for errors in range(chunks.distance + 1):
        a = rng.integers(0, 1 << 16, n, dtype=np.uint16)
        b = a.copy()
        b[rng.choice(n, errors, replace=False)] ^= np.uint16(9)
        x, y = masked(pd.Series([a.tobytes(), b.tobytes()]))
        met = np.flatnonzero(x == y)
        assert len(met)
        frames = [pd.DataFrame({"sig": [s.tobytes()], "label": [i]}) for i, s in enumerate((a, b))]
        counted = [p for p in range(n) if hamming._eligible(*frames, p, chunks)[0, 0]]
        assert counted == [met[0]]
    with pytest.raises(ValueError):
        hamming.plan(20)
