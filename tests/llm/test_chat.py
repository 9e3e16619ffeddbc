from cinderpost.llm import chat

SCHEMA = "pair_id long, chosen boolean, turn long, role string, text string, prompt string, usable string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def show(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_common_prefix_and_masks(spark):
    rows = [
        (1, True, 0, "user", "hi"), (1, False, 0, "user", "hi"),
        (1, True, 2, "assistant", "yes 😀"), (1, False, 1, "assistant", "no"),
        (1, True, 3, "user", "bye"), (1, True, 3, "user", "bye"),
    ]
    row = chat.format_preferences(turns(spark, rows)).first()
    assert row["n_common"] == 1 and row["prompt"] == show("user", "hi") and row["usable"]
    assert row["chosen"] == show("assistant", "yes 😀") + show("user", "bye")
    assert row["rejected"] == show("assistant", "no")
    assert row["chosen_mask"] == f"-{12 + 9 + 1}+{5 + 11}-{12 + 4 + 1 + 3 + 11}"
    lengths = [int(n) for n in row["rejected_mask"].replace("-", "+").split("+") if n]
    assert sum(lengths) == len(row["rejected"])


def test_equal_missing_and_null_sides(spark):
    rows = [
        (1, True, 0, "user", "a"), (1, False, 5, "user", "a"),
        (2, True, 0, "user", "a"),
        (3, True, None, None, None), (3, False, 0, "user", ""),
        (None, True, 0, "user", "lost"), (4, None, 0, "user", "lost"),
        (5, True, 0, "user", "a"), (5, False, 0, "user", "a"), (5, False, 1, "assistant", "b"),
    ]
    out = {r["pair_id"]: r for r in chat.format_preferences(turns(spark, rows)).collect()}
    assert sorted(out) == [1, 2, 3, 5]
    assert (out[1]["n_common"], out[1]["chosen"], out[1]["usable"]) == (1, "", False)
    assert (out[2]["n_common"], out[2]["rejected"], out[2]["usable"]) == (0, "", False)
    assert (out[3]["prompt"], out[3]["chosen"], out[3]["usable"]) == ("", show("", ""), True)
    assert (out[5]["n_common"], out[5]["rejected"], out[5]["usable"]) == (1, show("assistant", "b"), False)
    assert chat.format_preferences(turns(spark, rows).limit(0)).count() == 0


def test_neighbours_are_pairs(spark):
    rows = spark.createDataFrame([(4, 0, "user", "a"), (5, 0, "user", "b"), (-1, 0, "user", "c"), (2**60 + 2, 0, "user", "d"), (2**60 + 3, 0, "user", "e")], "conv_id long, turn long, role string, text string")
    got = sorted((r["pair_id"], r["chosen"]) for r in chat.neighbour_pairs(rows).collect())
    assert got == [(-1, False), (2, False), (2, True), (2**59 + 1, False), (2**59 + 1, True)]
