import random
import re

from cinderpost.llm import common, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(text, items):
    ws, hit, named = words(text), set(), set()
    for item, item_text in items:
        ts = words(item_text)
        n = min(10, len(ts))
        windows = {tuple(ts[p : p + n]) for p in range(len(ts) - n + 1)} if n else set()
        for p in range(len(ws) - n + 1):
            if n and tuple(ws[p : p + n]) in windows:
                hit |= set(range(p, p + n))
                named.add(str(item))
    return len(ws), len(hit), len(named), bool(hit)


def run(spark, make_docs, texts, items):
    bench = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, window string, n_hit string")
    docs = make_docs(list(enumerate(texts)))
    out = decontaminate.find_contamination(docs, bench).collect()
    for r in out:
        expected = brute(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == expected, texts[r["doc_id"]]
    assert len(out) == len(texts)
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, t in enumerate(texts) if not brute(t, items)[1]]


def test_equals_brute_force(spark, make_docs):
    rng = random.Random(3)
    vocab = ["a", "B", "c1", "Été", "d", "e"]
    sentence = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, sentence(rng.choice([3, 4, 7, 10, 11, 14, 25]))) for i in range(8)]
    items += [(8, None), (9, "..."), (9, ""), (10, items[0][1]), (3, items[3][1])]
    worded = [t for _, t in items if t]
    texts = [sentence(30) for _ in range(15)]
    texts += [f"{sentence(5)}, {rng.choice(worded)[:60]}! {sentence(9)}" for _ in range(25)]
    run(spark, make_docs, [*texts, None, "", "a"], items)


def test_long_windows_only(spark, make_docs):
    base = [f"w{i}" for i in range(30)]
    items = [(1, " ".join(base)), (2, " ".join(base[:10])), (3, " ".join(["the"] * 12))]
    texts = [
        " ".join(base[5:15]).upper(), " ".join(base[5:14]), "x " + " - ".join(base[:10]) + " y " + " ".join(base[12:30]),
        " ".join(["the"] * 40), " ".join(["the"] * 9), " ".join(base[:9] + ["z"] + base[10:19]),
    ]
    run(spark, make_docs, texts, items)


def test_no_items(spark, make_docs):
    run(spark, make_docs, ["a b c", None], [(1, None), (2, "")])


def test_beyond_the_broadcast_limit(spark, make_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    base = [f"w{i}" for i in range(12)]
    run(spark, make_docs, [" ".join(base)] * 5 + ["a b", None], [(1, " ".join(base))])
    run(spark, make_docs, [" ".join(base[:9]), "a w3 w4 b"] * 5, [(1, " ".join(base)), (2, "w3 w4")])


def test_long_text(spark, make_docs):
    base = [f"w{i}" for i in range(12)]
    long = " ".join(f"x{i % 997}" for i in range(60_000))
    run(spark, make_docs, [f"{long} {' '.join(base)} {long}", "the " * 20_000], [(1, " ".join(base)), (2, "the " * 11)])


def test_no_text_is_shuffled_with_its_places(spark, make_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    seen = []
    written = decontaminate.stage

    def watched(df, name):
        if name == "marked":
            seen.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(decontaminate, "stage", watched)
    base = [f"w{i}" for i in range(12)]
    bench = spark.createDataFrame([(1, " ".join(base))], "item_id long, text string")
    decontaminate.find_contamination(make_docs([(1, " ".join(base)), (2, "x")]), bench)
    below = seen[0].split("Exchange")[1].split("\n")[1]
    assert "_print" in below and "text" not in below and "_words" not in below and "_h" not in below.replace("_hash", "")
