"""Preference formatting: one prompt, two completions with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _render(turns: Column) -> Column:
    """Turns as one string."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE)),
        ),
        "",
    )


def _mask(turns: Column, trained: str) -> Column:
    """Lengths in code points, in order: a trained stretch is ``+n``, one without loss ``-n``.

    Of a trained role's turn the text and the closing sign carry loss, the opening does not.
    """
    head = F.lit(len(OPEN) + len(MIDDLE))

    def stretch(t):
        opening = head + F.length(t["role"])
        body = F.length(t["text"]) + F.lit(len(CLOSE))
        return F.when(
            t["role"] == trained,
            F.concat(F.lit("-"), opening.cast("string"), F.lit("+"), body.cast("string")),
        ).otherwise(F.concat(F.lit("-"), (opening + body).cast("string")))

    return F.array_join(F.transform(turns, stretch), "")


def _side(chosen: bool) -> Column:
    """Turns of one side in order, as roles and texts; repeated rows count once."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    kept = F.collect_list(F.when(F.col("chosen") == F.lit(chosen), turn))
    return F.transform(
        F.array_sort(F.array_distinct(kept)),
        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")),
    )


def format_preferences(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per pair: the longest common turn prefix as prompt, and what follows per side.

    ``turns`` has pair_id, chosen (boolean), turn, role, text; other columns are ignored. The
    prefix compares roles and texts turn by turn. It is rendered once, as ``prompt``; the rest
    of each side is its completion, with a mask of stretch lengths (see ``_mask``).

    Null roles and texts are empty strings; turns of equal number follow by role, then text;
    identical rows count once; null turn numbers come last. Rows without a pair or side are no
    turns. A pair with one side missing, or with two equal sides, stays with usable = false.
    A pair's turns meet in one row, as they do in the result; nothing larger is ever gathered.
    """
    pairs = (
        turns.filter(F.col("pair_id").isNotNull() & F.col("chosen").isNotNull())
        .groupBy("pair_id")
        .agg(_side(True).alias("_c"), _side(False).alias("_r"))
    )
    same = F.zip_with(
        "_c",
        "_r",
        lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)),
    )
    differs = F.array_position(F.col("_same"), False).cast("int")
    common = F.when(differs > 0, differs - 1).otherwise(F.size("_same"))
    rest = lambda side: F.slice(side, F.col("n_common") + 1, F.greatest(F.size(side), F.lit(1)))
    return (
        pairs.withColumn("_same", same)
        .withColumn("n_common", common)
        .withColumns({"_prompt": F.slice("_c", 1, F.col("n_common")), "_c": rest("_c"), "_r": rest("_r")})
        .select(
            "pair_id",
            "n_common",
            _render(F.col("_prompt")).alias("prompt"),
            _render(F.col("_c")).alias("chosen"),
            _render(F.col("_r")).alias("rejected"),
            _mask(F.col("_c"), trained).alias("chosen_mask"),
            _mask(F.col("_r"), trained).alias("rejected_mask"),
            ((F.size("_c") > 0) & (F.size("_r") > 0)).alias("usable"),
        )
    )


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Turns as pairs: conversations 2k (chosen) and 2k+1 (rejected) are pair k."""
    conv = F.col("conv_id")
    return conversations.select(
        F.shiftright(conv.cast("long"), 1).alias("pair_id"),
        (F.pmod(conv, F.lit(2)) == 0).alias("chosen"),
        "turn",
        "role",
        "text",
    )
