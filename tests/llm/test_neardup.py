import random
import re

import numpy as np
import pytest

from cinderpost.llm import common, neardup


def shingle_set(text):
    ws = re.findall(r"\w+", (text or "").lower())
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) > 4 else ({tuple(ws)} if ws else set())


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    label, links = list(range(len(rows))), [0] * len(rows)
    edges = []
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                edges.append((i, j))
                links[i] += 1
                links[j] += 1
    for _ in rows:
        for i, j in edges:
            label[i] = label[j] = min(label[i], label[j])
    smallest = {}
    for i, r in enumerate(rows):
        smallest[label[i]] = min(smallest.get(label[i], r[0]), r[0])
    return [(r[0], smallest[label[i]], links[i]) for i, r in enumerate(rows)]


def collection(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(n)] for n in (60, 80, 6, 120)]
    rows = []
    for i in range(90):
        ws = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            ws[rng.randrange(len(ws))] = word()
        rows.append((i, " ".join(ws).upper() if i % 7 == 0 else ", ".join(ws)))
    rows += [(100 + i, " ".join(word() for _ in range(40))) for i in range(10)]
    rows += [(200, "two words"), (201, "Two words!"), (202, ""), (203, None), (204, "..."), (205, "two words more")]
    return rows


@pytest.mark.parametrize("block", [neardup.BLOCK_SHINGLES, 300])
def test_equals_brute_force(make_docs, block):
    rows = collection()
    out = neardup.near_duplicates(make_docs(rows), recall=0.999999, block=block).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in out) == sorted(brute(rows))


def test_empty_blocks_count_no_link_twice(make_docs):
    rng = random.Random(6)
    rows = []
    for i in range(24):
        words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words, "more"]))]
    out = neardup.near_duplicates(make_docs(rows), block=200).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in out) == sorted(brute(rows))


def test_bands_reach_the_recall():
    bands, rows = neardup.bands_and_rows(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= neardup.MAX_HASHES
    with pytest.raises(ValueError):
        neardup.bands_and_rows(0.1, 0.999999, 4)


def test_one_of_each_class_stays(make_docs):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (3, text + " x"), (3, text + " x"), (9, "other words here"), (None, None), (None, None), (7, "")]
    docs = make_docs(rows)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"] or 0), r["text"] or "") for r in kept.collect()) == [
        (0, ""), (0, ""), (3, text + " x"), (7, ""), (9, "other words here"),
    ]
    assert neardup.one_of_each(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    nodes = [f"{i:03d}" for i in range(40)]
    edges = spark.createDataFrame(list(zip(nodes[1:], nodes)), "src string, dst string")
    out = neardup.components(edges, spark.createDataFrame([(n,) for n in [*nodes, "z"]], "node string"))
    assert {r["node"]: r["label"] for r in out.collect()} == {**dict.fromkeys(nodes, "000"), "z": "z"}


def test_similarity_of_many_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    matrix = neardup._similar(sets[:12], sets[12:], 0.5)
    for i in range(12):
        for j in range(18):
            a, b = set(sets[i].tolist()), set(sets[12 + j].tolist())
            assert matrix[i, j] == (len(a & b) >= 0.5 * len(a | b))


def test_joins_beyond_the_broadcast_limit_and_a_long_text(make_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = collection(2)[:50] + [(300, long), (301, long + " more"), (302, None)]
    out = neardup.near_duplicates(make_docs(rows), recall=0.999999).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in out) == sorted(brute(rows))
