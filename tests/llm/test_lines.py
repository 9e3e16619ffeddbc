import random
import re

from cinderpost.llm import common, lines
from cinderpost.operators import lookup


def brute(texts, min_words):
    """texts: (doc_id, text) in order; the text that stays, by doc_id."""
    docs = {}
    for doc, text in texts:
        if text is not None:
            docs[doc] = text.split("\n")
    filled = {
        d: [(p, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for p, x in enumerate(ls) if re.search(r"[^\x20\x09-\x0D]", x)]
        for d, ls in docs.items()
    }
    seen, gone = {}, {d: set() for d in docs}
    for d in sorted(filled):
        for i in range(len(filled[d])):
            for j in range(i, len(filled[d])):
                seen.setdefault(tuple(x for _, x, _ in filled[d][i : j + 1]), (d, i))
    for d, ls in filled.items():
        for i in range(len(ls)):
            for j in range(i, len(ls)):
                enough = sum(w for *_, w in ls[i : j + 1]) >= min_words
                if enough and seen[tuple(x for _, x, _ in ls[i : j + 1])] < (d, i):
                    gone[d] |= {p for p, *_ in ls[i : j + 1]}
        for (a, *_), (b, *_) in zip(ls, ls[1:]):
            if {a, b} <= gone[d]:
                gone[d] |= set(range(a, b))
    return {
        d: ("\n".join(x for p, x in enumerate(ls) if p not in gone[d]), len(ls), len(gone[d]))
        for d, ls in docs.items()
    }


def test_equals_brute_force(make_docs):
    rng = random.Random(5)
    pool = ["a b c", "d e", "f", "", "g h i j k l m n o p q", "r s t u", "  ", "v w x y z 1 2 3 4 5"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for i in range(40)]
    rows += [(i, "\n".join([rng.choice(pool), f"own {i}"] * 3)) for i in range(40, 60)]
    for least in (1, 3, 4, 10):
        out = lines.without_repeats(make_docs(rows), least).collect()
        expected = brute(rows, least)
        assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in out} == expected


def test_odd_input(make_docs):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(3, long), (1, long + "\nshort"), (1, long + "\nshort"), (None, None), (4, ""), (5, "\n\n"), (None, "x " + long)]
    docs = make_docs(rows)
    out = lines.without_repeats(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed", "n_runs"]
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["n_lines"], r["n_removed"], r["n_runs"]) for r in out.collect())
    assert got == [
        (0, "", 0, 0, 0),
        (0, "x " + long, 1, 0, 0),
        (1, long + "\nshort", 2, 0, 0),
        (1, long + "\nshort", 2, 0, 0),
        (3, "", 1, 1, 1),
        (4, "", 1, 0, 0),
        (5, "\n\n", 3, 0, 0),
    ]
    assert lines.without_repeats(docs.limit(0)).count() == 0


def test_short_lines_that_come_again_are_copies(make_docs):
    rows = [(i, f"start number {i}\nall rights are reserved\nyes no\nend {i}") for i in range(4)]
    plain = {r["doc_id"]: r["text"] for r in lines.without_repeats(make_docs(rows)).collect()}
    # "yes no" goes with the line before it; the first copy stays.
    assert plain[0] == rows[0][1] and all(plain[i] == f"start number {i}\nend {i}" for i in range(1, 4))
    alone = [(i, f"start number {i}\nyes no\nend {i}") for i in range(4)]
    assert {r["text"] for r in lines.without_repeats(make_docs(alone)).collect()} == {t for _, t in alone}
    all_gone = {r["doc_id"]: r["text"] for r in lines.without_repeats(make_docs(alone), 1).collect()}
    assert all_gone[0] == alone[0][1] and all_gone[3] == "start number 3\nend 3"


def test_joins_beyond_the_broadcast_limit(make_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    rng = random.Random(6)
    pool = ["a b c", "d e", "f", "", "g h i j", "r s t u"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for i in range(30)]
    out = lines.without_repeats(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in out} == brute(rows, 3)


def test_one_very_long_line(make_docs):
    long = "w " * 200_000
    rows = [(1, long), (2, long + "\nx y"), (3, "\n".join(["x y"] * 3000))]
    out = lines.without_repeats(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in out} == {1: (1, 0), 2: (2, 1), 3: (3000, 2999)}


def test_a_text_is_hashed_once_not_for_every_line(make_docs):
    docs = make_docs([(1, "a b c\nd e")])
    plan = lines._lines(docs, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "text#" not in plan[: plan.index("Generate")]


def test_long_runs_go_whole(make_docs):
    """Runs far longer than the words that count, lines of one word, beside lines of their own."""
    run = [f"line{i}" for i in range(300)]
    rows = [(d, "\n".join([f"own {d}", *run[d:], f"end {d}"])) for d in range(4)]
    out = lines.without_repeats(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"], r["n_runs"]) for r in out} == {
        0: (rows[0][1], 0, 0),
        **{d: (f"own {d}\nend {d}", 300 - d, 1) for d in range(1, 4)},
    }
