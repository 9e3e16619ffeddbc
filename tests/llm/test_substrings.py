import hashlib
import random

import numpy as np
import pytest

from cinderpost.llm import common, substrings


def brute(texts, length):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for n, b in enumerate(data):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i : i + length], []).append((n, i))
    gone = [set() for _ in data]
    for places in seen.values():
        if len(places) > 1:
            for n, i in places:
                gone[n].update(range(i, i + length))
    out = []
    for b, g in zip(data, gone):
        spans = sum(1 for i in g if i - 1 not in g)
        out.append((len(b), len(g), spans, bytes(c for i, c in enumerate(b) if i not in g)))
    return out


def run(make_docs, texts, **settings):
    out = substrings.remove_repeats(make_docs(list(enumerate(texts))), **settings).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out}
    assert len(out) == len(texts)
    return [got[i] for i in range(len(texts))]


def collection(seed):
    rng = random.Random(seed)
    fresh = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [fresh(n) for n in (30, 45, 80, 200)]
    texts = []
    for _ in range(60):
        parts = [fresh(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            lo = rng.randint(0, len(p) // 2)
            parts += [p[lo : lo + rng.randint(10, 100)], fresh(rng.randint(0, 20))]
        texts.append("".join(parts))
    texts += ["ab " * 40, "ab " * 60, "x" * 100, "x" * 35, None, "", texts[0], texts[0], "z" * 39, "short"]
    return texts


@pytest.mark.parametrize("shard", [substrings.SHARD_BYTES, 200])
def test_equals_brute_force(make_docs, shard):
    texts = collection(3)
    assert run(make_docs, texts, length=40, gram=16, shard=shard) == brute(texts, 40)


def test_long_texts_are_cut_by_starts(make_docs, monkeypatch):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdef") for _ in range(3000))
    texts = [long[:2500], "q" * 50 + long[700:1900] + "r", long[2400:]]
    expected = brute(texts, 200)
    assert run(make_docs, texts) == expected
    frame = [{"ta": 1, "tb": 1, "body": t.encode()} for t in texts]
    monkeypatch.setattr(substrings, "CHUNK_STARTS", 333)
    import pandas as pd

    starts = sum(n for _, places in substrings._chunks(pd.DataFrame(frame), 200) for _, n, *_ in places)
    assert starts == sum(len(t) - 199 for t in texts)


def test_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(2)
    data = np.concatenate([rng.integers(97, 99, 300), np.tile([97, 98, 99], 100), rng.integers(97, 99, 200)]).astype(np.uint8)
    raw = data.tobytes()
    order, kept = substrings.suffix_ranks(data, 200, 128)
    assert sorted(order.tolist()) == list(range(len(raw)))
    heads = [raw[i : i + 200] for i in order]
    assert heads == sorted(heads)
    shared = substrings.common_prefixes(data, order, kept, 128, 200)
    for p in range(1, len(raw)):
        a, b = raw[order[p - 1] :], raw[order[p] :]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert (shared[p] >= 200) == (n >= 200)


def test_ties_beyond_the_order_share_nothing_unchecked():
    rng = np.random.default_rng(4)
    base = rng.integers(97, 123, 328).astype(np.uint8)
    late, early, edited = base.copy(), base.copy(), base.copy()
    early[300], late[300] = ord("a"), ord("z")
    edited[190] = ord("A")
    raw = np.concatenate([late, early, edited])
    order, kept = substrings.suffix_ranks(raw, 200, 128)
    shared = substrings.common_prefixes(raw, order, kept, 128, 200)
    for p in range(1, len(raw)):
        a, b = raw[order[p - 1] :].tobytes(), raw[order[p] :].tobytes()
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert (shared[p] >= 200) == (n >= 200), (order[p - 1], order[p])


@pytest.mark.parametrize("shard", [substrings.SHARD_BYTES, 200])
def test_a_hot_passage_reaches_its_shard_once(spark, make_docs, monkeypatch, shard):
    rng = random.Random(9)
    fresh = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    passage = fresh(150)
    texts = [fresh(30) + passage + fresh(30) for _ in range(200)]
    searched = []
    distinct = substrings.distinct_pieces

    def counted(rows):
        out = distinct(rows)
        searched.append((rows.count(), out.count(), rows.select("body").distinct().count(), out.filter("many").count()))
        return out

    monkeypatch.setattr(substrings, "distinct_pieces", counted)
    assert run(make_docs, texts, length=40, gram=16, shard=shard) == brute(texts, 40)
    [(rows, pieces, bodies, many)] = searched
    assert pieces == bodies and many > 0 and rows - pieces > 150


def test_texts_are_not_shuffled_by_later_joins(spark, make_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    moved, staged = [], substrings.stage

    def shuffles(df):
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return [x for x in plan.split("\n\n") if ") Exchange" in x and "body#" in x and "da#" not in x]

    def seen(df, name, *more):
        moved.extend(shuffles(df))
        return staged(df, name, *more)

    monkeypatch.setattr(substrings, "stage", seen)
    try:
        texts = collection(3)
        out = substrings.remove_repeats(make_docs(list(enumerate(texts))), length=40, gram=16)
        assert not moved and not shuffles(out)
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, 40)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_whole_table(spark, tables):
    from cinderpost.llm.queries import Q

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    expected = dict(zip(texts, brute(list(texts.values()), 200)))
    rows = Q["op7_suffix_dedup"](spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, gone, spans, kept = expected[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, spans, hashlib.sha256(kept).hexdigest())
