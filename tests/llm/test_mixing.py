import re

import pytest

from cinderpost.llm import common, mixing


def brute_targets(sizes, weights, amount, epochs):
    clamped = set()
    while True:
        free = [s for s in sizes if s not in clamped]
        rest = amount - sum(epochs * sizes[s] for s in clamped)
        level = rest / sum(weights[s] for s in free) if free else 0
        over = {s for s in free if weights[s] * level >= epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in clamped else weights[s] * level for s in sizes}
        clamped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def collection():
    rows, n = [], 0
    for source, count, length in (("b", 900, 9), ("a", 30, 11), ("C", 4, 400), (None, 200, 5), ("é", 60, 3), ("z", 5, 0)):
        for i in range(count):
            rows.append((n, " ".join(["w"] * (length + i % 3 if length else 0)), source))
            n += 1
    return rows


def test_targets_and_taken_words(make_docs):
    rows = collection()
    out = mixing.mix(make_docs(rows)).collect()
    order = ["C", "a", "b", "z", "é", None]
    sizes = {s: sum(words(t) for _, t, x in rows if x == s) for s in order}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    expected = brute_targets(sizes, weights, 1.5 * sum(sizes.values()), 2.0)
    taken = dict.fromkeys(order, 0)
    for r in out:
        assert (r["size"], r["source_size"]) == (words(r["text"]), sizes[r["source"]])
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
    for s in order:
        largest = max(words(t) for _, t, x in rows if x == s)
        assert abs(taken[s] - expected[s]) <= largest / 2 + 1e-6
    assert len(out) == len(rows)


def test_rows_agree_between_runs_and_keep_columns(make_docs):
    docs = make_docs(collection())
    first, second = mixing.mix(docs), mixing.mix(docs.repartition(7))
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
    assert [c for c in first.columns if c not in ("size", "source_size", "target", "taken")] == [
        c for c in docs.columns if c not in ("size", "taken")
    ]


def test_odd_input(make_docs):
    rows = [(None, None, None), (None, "a b", None), (1, "", "s"), (1, "x y z", "s"), (1, "x y z", "s")]
    out = mixing.mix(make_docs(rows)).collect()
    assert len(out) == 5 and all(r["taken"] <= 2 * r["size"] for r in out)
    same = [r["taken"] for r in out if r["size"] == 3]
    assert same[0] == same[1]
    assert mixing.mix(make_docs(rows).limit(0)).count() == 0
    assert [r["taken"] for r in mixing.mix(make_docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_quota_is_met_across_histogram_levels(spark):
    rows = spark.range(20000).selectExpr(
        "'g' AS _g", "shiftright(abs(xxhash64(id)), 3) AS _h", "1L AS _size"
    )
    quotas = spark.createDataFrame([("g", 7321.0)], "_g string, _quota double")
    cut = mixing.hash_cuts(rows, quotas).first()["cut"]
    assert rows.filter(f"_h <= {cut}").count() in (7320, 7321)


def test_joins_beyond_the_broadcast_limit_and_a_long_text(make_docs, monkeypatch):
    rows = [(i, "w " * (i % 50), f"s{i % 3}") for i in range(120)] + [(500, "long " * 60_000, "s0"), (501, None, None)]
    taken = lambda: sorted((r["doc_id"], r["taken"]) for r in mixing.mix(make_docs(rows)).select("doc_id", "taken").collect())
    small = taken()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert taken() == small
