import hashlib
import random
import re

from cinderpost.llm import common, secrets
from cinderpost.operators import lookup

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    spans.sort()
    joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
    counts = [sum(k == kind for *_, k in spans) for kind in ("assign", "access", "hex")]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest(), joined)


HEX = "0123456789abcdef" * 2
KEY = "sk-Ab9Cd8Ef7Gh6Ij5Kl4"
TEXTS = [
    None,
    "",
    "nothing here",
    f"😀 password = '{HEX}' end",
    "password: token: abcdefghijkl",
    "PassWord=token=abcdefghij and api_key:abc",
    "token=short api-key=abcdefghijk apikey\"= 'abcdefgh",
    "xAKIA" + "B" * 11 + " AKIA" + "C1" * 6 + " AKIAAKIA12",
    HEX + "g" + HEX + "0" + HEX,
    f"é secret={KEY} then {KEY}",
    ("password=abcdefgh%d " * 300) % tuple(range(300)),
    "secret=ſecret token=aaaaaaaaK",
]


def test_spans_equal_a_plain_scan(spark, make_docs):
    docs = make_docs([(i, t, f"s{i % 4}") for i, t in enumerate(TEXTS)])
    for row in secrets.scan(docs).collect():
        expected = brute(TEXTS[row["doc_id"]])
        got = (row["n_assign"], row["n_access"], row["n_hex"], row["base_sha256"])
        assert got == expected[:4], row["doc_id"]
        base = [s for s in row["spans"].split(",") if s and not s.startswith("keyed")]
        assert ",".join(base) == expected[4]


def test_ownership_separates_examples_from_live_values(make_docs):
    rows = [(i, f"use {KEY}0example now", f"s{i % 3}") for i in range(6)]
    rows += [(10, f"mine {KEY}1live", "s1"), (11, f"mine {KEY}1live", "s1"), (12, "sk-" + "a" * 20, "s2")]
    out = {r["doc_id"]: r for r in secrets.scan(make_docs(rows)).collect()}
    assert all(out[i]["spans"] == "" and out[i]["n_example"] == 1 for i in range(6))
    start = len("mine ")
    assert out[10]["spans"] == f"keyed:{start}:{start + len(KEY) + 5}" == out[11]["spans"]
    assert (out[10]["n_live"], out[12]["n_live"], out[12]["spans"]) == (1, 0, "")


def private_key(seed, size=200):
    draw = random.Random(seed)
    return ["".join(draw.choice("ABCabc0123+/xyz") for _ in range(64)) for _ in range(size // 64)] + ["Zz9+q" + "=="]


def test_private_keys_are_told_apart_by_their_bodies(make_docs):
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    bodies = [private_key(i) for i in range(5)]
    keys = ["\n".join([begin, *b, end]) for b in bodies[:3]]
    rows = [(i, f"my key\n{k}\nthe end", f"s{i}") for i, k in enumerate(keys)]
    # One key of three owners in three notations, one without an END line, a long one, headers only.
    rows += [(10, "\r\n".join([begin, *bodies[3], end]), "s0"), (11, "\\n".join([begin, *bodies[3], end]), "s1")]
    rows += [(12, "x " + " ".join([begin, *bodies[3], end]), "s2"), (13, "\n".join([begin, *bodies[4], "Some words"]), "s0")]
    long = "\n".join(["-----BEGIN PRIVATE KEY-----", *private_key(9, 300_000), "-----END PRIVATE KEY-----"])
    rows += [(14, long, "s1"), *[(20 + i, f"{begin} is how such a file starts", f"s{i}") for i in range(3)]]
    rows += [(30, f"{begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A\n\n" + "\n".join([*bodies[1][:2], end]), "s1")]
    out = {r["doc_id"]: r for r in secrets.scan(make_docs(rows)).collect()}
    for i, k in enumerate(keys):
        assert (out[i]["spans"], out[i]["n_live"], out[i]["n_example"]) == (f"keyed:7:{7 + len(k)}", 1, 0)
    for i in (10, 11, 12, 20, 21, 22):
        assert (out[i]["spans"], out[i]["n_live"], out[i]["n_example"]) == ("", 0, 1), i
    assert out[13]["spans"] == f"keyed:0:{len(rows[6][1]) - len('Some words') - 1}"
    assert out[14]["spans"] == f"keyed:0:{len(long)}"
    assert out[30]["spans"] == f"keyed:0:{len(rows[-1][1])}"


def test_many_documents_of_few_owners_make_an_example(make_docs):
    rows = [(i, f"use {KEY}0spread now", f"s{i % 2}") for i in range(secrets.EXAMPLE_DOCS)]
    rows += [(100 + i, f"use {KEY}1rare now", "s0") for i in range(secrets.EXAMPLE_DOCS - 1)]
    rows += [(100, f"use {KEY}1rare now", "s0")] * 20
    out = secrets.scan(make_docs(rows)).collect()
    end, n = 4 + len(KEY), secrets.EXAMPLE_DOCS
    for r in out:
        got = (r["spans"], r["n_live"], r["n_example"], r["frequencies"])
        if r["doc_id"] < 100:
            assert got == ("", 0, 1, f"keyed:4:{end + 7}:{n}:2")
        else:
            assert got == (f"keyed:4:{end + 5}", 1, 0, f"keyed:4:{end + 5}:{n - 1}:1")


def test_repeated_null_and_empty_input(make_docs):
    rows = [(1, f"token={HEX}"), (1, f"token={HEX}"), (None, f"token={HEX}", None), (None, None, None)]
    out = secrets.scan(make_docs(rows)).collect()
    assert sorted(r["n_assign"] for r in out) == [0, 1, 1, 1]
    assert secrets.scan(make_docs(rows).limit(0)).count() == 0


def test_whole_table(spark, tables):
    from cinderpost.llm.queries import Q

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = Q["op8_secret_scan"](spark, tables).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert (row["n_assign"], row["n_access"], row["n_hex"], row["base_sha256"]) == brute(texts[row["doc_id"]])[:4]


def test_hyphenated_prose_is_no_credential(make_docs):
    texts = [
        "a risk-based-decision-making approach", "task-oriented-dialogue-systems", "sk-learn-like-interfaces-are-common",
        "desk-1234567890abcdefghij", f"key {KEY}", f"x-{KEY}", f"({KEY})",
    ]
    out = {r["doc_id"]: r for r in secrets.scan(make_docs([(i, t, f"s{i}") for i, t in enumerate(texts[:5])])).collect()}
    assert [out[i]["spans"] for i in range(5)] == ["", "", "", "", f"keyed:4:{4 + len(KEY)}"]
    assert [out[i]["n_live"] for i in range(5)] == [0, 0, 0, 0, 1]
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(make_docs([(i, t, f"s{i}") for i, t in enumerate(texts[5:])])).collect()}
    assert out == {0: "", 1: f"keyed:1:{1 + len(KEY)}"}


def test_many_matches_in_one_text(make_docs):
    text = " ".join(f"token=abcdefgh{i}" if i % 3 else "token=ab" for i in range(4000))
    row = secrets.scan(make_docs([(1, text, "s")])).first()
    assert (row["n_assign"], row["n_access"], row["n_hex"], row["base_sha256"]) == brute(text)[:4]


def test_joins_beyond_the_broadcast_limit(make_docs, monkeypatch):
    docs = make_docs([(i, t, f"s{i % 4}") for i, t in enumerate(TEXTS)])
    small = sorted(map(str, secrets.scan(docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    assert sorted(map(str, secrets.scan(docs).collect())) == small
