import math
import random
import re
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from cinderpost.llm import quality

LABELS = "doc_id long, quality int, toxic int, text string, score double"


def prose(rng, n=60):
    words = ["the", "house", "stood", "near", "a", "river", "and", "people", "walked", "there", "often"]
    return " ".join(rng.choice(words) + (".\n" if rng.random() < 0.1 else "") for _ in range(n))


def junk(rng, n=60):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(rng.choice(["BUY", "NOW", "CHEAP"]) + "!!" for _ in range(n))
    if kind == 1:
        return " ".join(w for w in rng.sample(["spam", "egg", "ham", "jam"], 4) for _ in range(n // 4))
    return " | ".join(rng.choice(["home", "about", "login"]) for _ in range(n))


def collection():
    rng = random.Random(2)
    rows = [(i, prose(rng) if i % 5 else junk(rng)) for i in range(600)]
    marks = [(i, int(i % 5 > 0), 0, "x", 1.0) for i in range(600) if i % 2 == 0 or i % 5 == 0]
    return rows, marks


def test_held_out_accuracy_and_folds(spark, make_docs):
    rows, marks = collection()
    out = quality.scored(make_docs(rows), spark.createDataFrame(marks, LABELS)).collect()
    assert len(out) == 600
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    asked = [r for r in out if r["held_out"]]
    right = sum(r["predicted"] == int(r["doc_id"] % 5 > 0) for r in asked)
    assert right >= 0.97 * len(asked)


def test_held_out_labels_change_nothing(spark, make_docs):
    rows, marks = collection()
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, *r) for i, q, *r in marks]
    get = lambda m: sorted((r["doc_id"], r["score"]) for r in quality.scored(make_docs(rows), spark.createDataFrame(m, LABELS)).collect())
    assert get(marks) == get(turned)


def test_risk_is_minimised_as_in_a_dense_computation(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (300, 2)), rng.normal(1, 1, (100, 2))])
    flags = np.zeros(400, bool)
    flags[300:400:2] = True
    frame = spark.createDataFrame([(bool(f), float(a), float(b)) for f, (a, b) in zip(flags, x)], "__positive boolean, a double, b double")
    model = quality.fit(frame.repartition(5), ["a", "b"], 0.25)
    design = np.hstack([np.ones((400, 1)), (x - x.mean(0)) / x.std(0)])

    def risk(w):
        g = design @ w
        loss = lambda v: np.logaddexp(0, -v)
        rest = loss(-g).mean() - 0.25 * loss(-g[flags]).mean()
        return 0.25 * loss(g[flags]).mean() + max(0, rest) + quality.RIDGE * (w**2).sum()

    best = risk(model.weights)
    for _ in range(200):
        assert risk(model.weights + rng.normal(0, 0.05, 3)) > best - 1e-5


def risk_of(design, flags, prior):
    def risk(w):
        g = design @ w
        loss = lambda v: np.logaddexp(0, -v)
        rest = loss(-g).mean() - prior * loss(-g[flags]).mean()
        return prior * loss(g[flags]).mean() + max(0, rest) + quality.RIDGE * (w**2).sum(), rest

    return risk


@pytest.mark.parametrize("prior", [0.25, 0.5])
def test_the_least_risk_where_the_clamp_binds(spark, prior):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(-4, 0.5, (150, 2)), rng.normal(4, 0.5, (50, 2))])
    flags = np.arange(200) >= 150
    frame = spark.createDataFrame([(bool(f), float(a), float(b)) for f, (a, b) in zip(flags, x)], "__positive boolean, a double, b double")
    model = quality.fit(frame.repartition(3), ["a", "b"], prior)
    risk = risk_of(np.hstack([np.ones((200, 1)), (x - x.mean(0)) / x.std(0)]), flags, prior)
    best, rest = risk(model.weights)
    assert rest < 2 * quality.WIDTHS[-1] * 10  # at the kink, or below it
    # The risk is convex, so no other weights have less, near or far.
    for scale in (1e-3, 1e-2, 0.1, 1, 5):
        for _ in range(400):
            assert risk(model.weights + rng.normal(0, scale, 3))[0] > best - 2 * quality.WIDTHS[-1]


def test_a_search_that_does_not_settle_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(quality, "ROUNDS", 1)
    frame = spark.createDataFrame([(i % 2 == 0, float(i % 2 == 0) + i / 40) for i in range(40)], "__positive boolean, a double")
    with pytest.raises(RuntimeError):
        quality.fit(frame, ["a"], 0.4)


@pytest.mark.parametrize("share", [0.2, 0.6, 0.9])
def test_class_prior_from_positives_and_all_text(spark, share):
    rng = np.random.default_rng(5)
    n = 6000
    good = rng.random(n) < share
    x = rng.normal(0, 1, n) + np.where(good, 3.0, -1.0)
    flags = good & (rng.random(n) < 0.4)
    frame = spark.createDataFrame([(bool(f), float(a)) for f, a in zip(flags, x)], "__positive boolean, a double")
    model = quality.fit(frame.repartition(3), ["a"])
    assert abs(model.prior - share) < 0.06
    score = 1 / (1 + np.exp(-(model.weights[0] + model.weights[1] * (x - model.mean[0]) / model.scale[0])))
    assert ((score >= 0.5) == good).mean() > 0.95


def brute_features(text):
    text = text or ""
    n, ws = len(text), re.findall(r"[^ \t\n\x0b\f\r]+", text)
    count = lambda pattern, s=text: len(regex.findall(pattern, s))
    share = lambda a, b: a / max(b, 1)
    letters, upper, digits = count(r"\p{L}"), count(r"\p{Lu}"), count(r"\p{N}")
    signs = count(r"[^\p{L}\p{N}\p{M} \t\n\x0b\f\r.,;:'()\-]")
    bars = text.count("|")
    stops = count(r"[.!?](?:[ \t\n\x0b\f\r]|\Z)")
    ends = count(r"[^\p{L}\p{N} \t\n\x0b\f\r.,;:'()\-](?:[ \t\n\x0b\f\r]|\Z)")
    same = sum(a == b for a, b in zip(ws, ws[1:]))
    many, kinds = len(ws), len(set(ws))
    return [
        share(upper, letters) ** 0.5, share(upper, letters), share(digits, n) ** 0.5, share(signs, n) ** 0.5,
        min(share(signs, n) * 10, 1), share(bars, n) ** 0.5, min(share(bars, n) * 20, 1), share(same, many) ** 0.5,
        min(share(same, many) * 3, 1), share(ends, many) ** 0.5, min(share(ends, many) * 2, 1),
        share(math.log1p(kinds), math.log1p(many)) if math.log1p(many) >= 1 else math.log1p(kinds),
        share(kinds, many), min(share(letters, many) / 10, 2), min(share(stops, many) ** 0.5, 1), math.log1p(many) / 10,
    ]


def test_scores_by_plain_arithmetic(spark, make_docs):
    rows, marks = collection()
    odd = ["", None, "A", "é É 12 ½ | || !! ok? yes!", "a  a\ta b", "(x) - y; z: 'q'", "№ § €"]
    rows = rows[:200] + [(1000 + i, t) for i, t in enumerate(odd)]
    docs, labels = make_docs(rows), spark.createDataFrame(marks, LABELS)
    model, features = quality.train(docs, labels)
    found = {r["doc_id"]: [r[f"__f{i}"] for i in range(16)] for r in features.collect()}
    scores = {r["doc_id"]: r["score"] for r in quality.scored(docs, labels).collect()}
    for i, text in rows:
        plain = np.array(brute_features(text))
        assert np.allclose(found[i], plain, atol=1e-12), (text, found[i], plain)
        g = model.weights[0] + model.weights[1:] @ ((plain - model.mean) / model.scale)
        assert abs(scores[i] - 1 / (1 + math.exp(-max(min(g, 500), -500)))) < 1e-5


def test_odd_input(spark, make_docs):
    docs = make_docs([(1, None), (1, ""), (None, "a b"), (2, "x y " * 30000), (2, "x y " * 30000)])
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in quality.scored(docs, none).collect()} == {0.5}
    some = spark.createDataFrame([(2, 1, 0, "x", 0.0), (2, None, 0, "x", 0.0), (None, 1, 0, "x", 0.0), (9, 0, 0, "x", 0.0)], LABELS)
    rows = quality.scored(docs, some).collect()
    assert len(rows) == 5 and len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    kept = quality.accepted(docs, some)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)
    assert quality.scored(docs.limit(0), some).count() == 0


def test_accuracy_on_the_given_table(spark, tables):
    folder = tables.replace("sf0.001", "sf0.01")
    from cinderpost.llm.queries import Q

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    both = Q["op2_quality"](spark, folder).join(labels, "doc_id").filter("held_out")
    row = both.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("a")).first()
    assert row["a"] >= 0.97
