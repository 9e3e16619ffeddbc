import random
import re
from collections import Counter

import numpy as np
import pytest

from cinderpost.llm import collocations, common

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, ids string, _t int, word string, score int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", "y", "z", 0, "w", 1) for i, (t, g) in enumerate(rows)], SCHEMA)


def brute(rows, longest=3, least=10, absorbed=50, top=2000):
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^ \t]+", piece)
            lang = "und" if lang is None else lang
            sizes[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    counts[lang, tuple(ws[i : i + k])] += 1
    phrases = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, ws), a in phrases.items():
        around = [
            b for (g, long), b in phrases.items()
            if g == lang and len(long) > len(ws) and any(long[i : i + len(ws)] == ws for i in range(len(long)))
        ]
        if any(100 * b >= absorbed * a for b in around):
            continue
        cuts = []
        for k in range(1, len(ws)):
            left, right = counts[lang, ws[:k]], counts[lang, ws[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(ws), a, left, right, sizes[lang], score))
    ranked = []
    for lang in sizes:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def found(spark, rows, **settings):
    out = collocations.collocations(docs(spark, rows).repartition(3), **settings)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert all(kind == "bigint" for name, kind in out.dtypes if name not in ("lang", "phrase"))
    return sorted(tuple(r) for r in out.collect())


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "the", "of", "zz"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    fixed = ["New  York\tCity", "the of the of", "à la carte", "once upon a time"]
    rows = []
    for i in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.1 else rng.choices(vocabulary, weights)[0] for _ in range(80)]
        text = "".join(w + rng.choice([" ", " ", " ", " ", ", ", ".\n", "\r\n", "\t"]) for w in words)
        rows.append((text, rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", "fr"), (" \t.;", "fr"), ("one", None), rows[0], rows[0]]


def test_equals_brute_force(spark):
    rows = corpus()
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, top=5) == brute(rows, top=5)
    assert found(spark, rows, longest=4, least=4, absorbed=30) == brute(rows, longest=4, least=4, absorbed=30)
    assert found(spark, rows, longest=2) == brute(rows, longest=2)


def test_many_shards_hot_words_and_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(collocations, "SHARD_WORDS", 300)
    rows = corpus(2) + [("the of " * 300, "en"), ("x " * 500, "de")]
    assert found(spark, rows) == brute(rows)


def test_empty_and_one_long_text(spark):
    assert found(spark, []) == [] == found(spark, [(None, None), ("", "en")])
    rows = [(" ".join(f"w{i % 97}" for i in range(30_000)), "en")]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("small", [1, 8, 100_000])
@pytest.mark.parametrize("routed", [2, 3])
def test_equal_partitions_are_counts(monkeypatch, small, routed):
    monkeypatch.setattr(collocations, "SMALL", small)
    rng = np.random.default_rng(small)
    ids = rng.integers(1, 9, (3, 900)) * rng.integers(1, 4, (3, 900))
    ids[2, rng.random(900) < 0.2] = 0
    weights = rng.integers(1, 4, 900)
    counts = Counter()
    for column, w in zip(ids.T.tolist(), weights.tolist()):
        counts[tuple(column[:2])] += w
        if column[2]:
            counts[tuple(column)] += w
    got = Counter()
    for own, sums in collocations.phrase_counts(ids.astype(np.int64), weights, 12, routed):
        for phrase, n in zip(own.T.tolist(), sums.tolist()):
            assert tuple(phrase) not in got
            got[tuple(phrase)] = n
    assert got == {p: n for p, n in counts.items() if n >= 12 or len(p) < routed}


def test_suffixes_end_with_their_piece():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([[1, 2, 3, None, 4, None], [5, 6, None], None, [], [1, 2, None]])], ["ids"])
    blocks = list(collocations._suffix_blocks(3, 2, np.array([], np.int64))(iter([batch])))
    seen = Counter()
    for b in blocks:
        for data in b.column(1).to_pylist():
            for *ids, w in np.frombuffer(data, np.int64).reshape(4, -1).T.tolist():
                seen[tuple(ids)] += w
    assert seen == {(1, 2, 3): 1, (2, 3, 0): 1, (5, 6, 0): 1, (1, 2, 0): 1}
