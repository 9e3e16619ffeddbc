"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinderpost.llm.common import joined
from cinderpost.operators.ranking import dense_index
from cinderpost.session import discard, stage

WORD = r"[^\x20\x09-\x0D]+"
LEVEL_BITS = 10
HASH_BITS = 60
BIG_SHARE = 256


def size_of(text: str = "text") -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, doc_id: str = "doc_id", text: str = "text") -> Column:
    """Sixty seeded bits per document, the same in every run."""
    parts = [F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.md5(text), F.lit(""))]
    digest = F.md5(F.concat_ws("|", F.lit(seed), *parts))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_key(source: str = "source") -> Column:
    """Source as a string that is never null and differs for null and every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def cycled_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Weights by the rank of the source in code point order, null last, repeating."""
    order = F.struct(F.col("source").isNull().alias("last"), F.col("source").alias("name"))
    ranked = dense_index(sources.withColumn("_order", order), "_order", "_rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.col("_rank") % len(weights)).cast("int")
    return ranked.withColumn("weight", F.get(cycle, place)).drop("_order", "_rank")


def water_fill(sources: DataFrame, amount: float, max_epochs: float) -> DataFrame:
    """Add ``target``: shares of ``amount`` by ``weight``, none above ``max_epochs`` sizes.

    A source whose share is above its cap is clamped and the excess is dealt to the others by
    weight, until no share is above. Each round is one aggregation over the sources; the
    clamped set only grows, so the rounds end. If every source is clamped, all get their cap.
    """
    cap, level, seen = F.col("source_size") * float(max_epochs), 0.0, -1
    while True:
        full = cap <= F.col("weight") * level
        row = sources.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["n"] == seen or row["open"] == 0:
            return sources.withColumn("target", F.when(full, cap).otherwise(F.col("weight") * level))
        seen, level = row["n"], (amount - row["used"]) / row["open"]


def _cut(rows: DataFrame) -> DataFrame:
    """Per group the largest hash whose rows still fit ``_quota`` to within half of them.

    ``rows`` has _g, _h, _size, _quota and _before (what smaller hashes hold).
    """
    order = Window.partitionBy("_g").orderBy("_h")
    sums = rows.groupBy("_g", "_h", "_quota", "_before").agg(F.sum("_size").alias("_s"))
    upto = F.col("_before") + F.sum("_s").over(order)
    fits = upto - F.col("_s") / 2 <= F.col("_quota")
    return (
        sums.withColumn("_fits", fits)
        .groupBy("_g")
        .agg(
            F.coalesce(
                F.max(F.when(F.col("_fits"), F.col("_h"))), F.min("_h") - F.lit(1)
            ).alias("cut"),
            F.coalesce(F.sum(F.when(F.col("_fits"), F.col("_s"))), F.lit(0)).alias("held"),
        )
    )


def hash_cuts(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """Per group the hash up to which its rows, in hash order, make up a quota.

    No group is ever sorted as a whole. A histogram of 2^10 ranges finds the range that the
    quota falls into, a second one splits that range again, and only the rows of the last
    range, a millionth of the group, are ordered one by one.
    """
    found, state = [], quotas.withColumn("_lo", F.lit(0).cast("long")).withColumn(
        "_before", F.lit(0).cast("long")
    )
    shift, inside = HASH_BITS, rows
    for _ in range(2):
        shift -= LEVEL_BITS
        inside = joined(inside.select("_g", "_h", "_size"), state, "_g", "inner").filter(
            (F.col("_h") >= F.col("_lo"))
            & (F.shiftright(F.col("_h") - F.col("_lo"), shift) < 1 << LEVEL_BITS)
        )
        ranges = inside.groupBy(
            "_g", "_quota", "_before", F.shiftright("_h", shift).alias("_b")
        ).agg(F.sum("_size").alias("_s"))
        order = Window.partitionBy("_g").orderBy("_b")
        upto = F.col("_before") + F.sum("_s").over(order)
        state = stage(
            ranges.withColumn("_upto", upto)
            .filter(F.col("_upto") > F.col("_quota"))
            .groupBy("_g", "_quota")
            .agg(F.min_by(F.struct("_b", (F.col("_upto") - F.col("_s")).alias("p")), "_b").alias("_r"))
            .select(
                "_g",
                "_quota",
                F.shiftleft("_r._b", shift).alias("_lo"),
                F.col("_r.p").alias("_before"),
            ),
            "mix-range",
        )
        found.append(state)
    last = joined(rows.select("_g", "_h", "_size"), state, "_g", "inner").filter(
        (F.col("_h") >= F.col("_lo")) & (F.shiftright(F.col("_h") - F.col("_lo"), shift) < 1)
    )
    cuts = stage(_cut(last).select("_g", "cut"), "mix-cut")
    discard(*found)
    return cuts


@dataclass
class Mix:
    """What a mix decides: one row per source, and how a document follows from it."""

    sources: DataFrame
    seed: str

    def apply(self, docs: DataFrame, size: Column | None = None, h: Column | None = None) -> DataFrame:
        """Add size, source_size, target and taken (words, repeats counted) to documents."""
        names = ["size", "source_size", "target", "taken"]
        keep = [c for c in docs.columns if c not in names]
        rows = docs.select(
            *keep,
            source_key().alias("__source"),
            (size_of() if size is None else size).alias("size"),
            (draw(self.seed) if h is None else h).alias("__draw"),
        )
        side = self.sources.withColumnsRenamed(
            {"_g": "__source", "_whole": "__whole", "_cut_big": "__cut_big", "_cut_small": "__cut_small"}
        )
        both = joined(rows, side, "__source", "left")
        chosen = F.col("__draw") <= F.when(
            F.col("size") * BIG_SHARE > F.col("source_size"), F.col("__cut_big")
        ).otherwise(F.col("__cut_small"))
        times = F.coalesce(F.col("__whole") + F.when(chosen, 1).otherwise(0), F.lit(0))
        return both.select(
            *keep, "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken")
        )


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    budget: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix-1",
) -> tuple[Mix, DataFrame]:
    """Decide how often each document of a mix is repeated; also the sized documents.

    The mix holds ``budget`` times all words. Targets come from ``water_fill``. A source with
    target/size = 1.4 gives every document once and a seeded sample that holds 0.4 of its
    words once more: documents in hash order until the quota is met, first the few that hold
    over 1/256 of their source, then the others for what is left, so that a source misses its
    target by half of one small document unless it has no small ones.

    Null sources are one source; null and empty texts have size 0 and take nothing; rows with
    the same id and text are taken alike; columns named like the result's are replaced;
    names that begin with two underscores are reserved.
    """
    sized = stage(
        docs.select(
            "doc_id", "source", source_key().alias("_g"), size_of().alias("_size"), draw(seed).alias("_h")
        ),
        "mix-sized",
    )
    sums = sized.groupBy("_g").agg(F.first("source").alias("source"), F.sum("_size").alias("source_size"))
    sources = stage(cycled_weights(sums, weights), "mix-sources")
    amount = budget * (sources.agg(F.sum("source_size")).first()[0] or 0)
    times = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    shares = stage(
        water_fill(sources, amount, max_epochs)
        .withColumn("_whole", F.floor(times).cast("long"))
        .withColumn("_part", F.col("target") - F.col("_whole") * F.col("source_size")),
        "mix-targets",
    )
    rows = joined(sized.select("_g", "_h", "_size"), shares.select("_g", "source_size", "_part"), "_g", "inner")
    big = F.col("_size") * BIG_SHARE > F.col("source_size")
    large = rows.filter(big)
    mass = large.groupBy("_g").agg((F.sum("_size") / F.first("source_size") * F.first("_part")).alias("_quota"))
    ordered = large.select("_g", "_h", "_size").join(mass, "_g").withColumn("_before", F.lit(0).cast("long"))
    cut_big = stage(_cut(ordered), "mix-cut-big")
    quotas = stage(
        shares.join(cut_big, "_g", "left").select(
            "_g", (F.col("_part") - F.coalesce("held", F.lit(0))).alias("_quota")
        ),
        "mix-quota",
    )
    cut_small = hash_cuts(rows.filter(~big), quotas)
    everything = F.lit((1 << HASH_BITS) - 1)
    decided = stage(
        shares.join(cut_big.select("_g", F.col("cut").alias("_cut_big")), "_g", "left")
        .join(cut_small.withColumnRenamed("cut", "_cut_small"), "_g", "left")
        .select("_g", "source_size", "target", "_whole", "_cut_big", F.coalesce("_cut_small", everything).alias("_cut_small")),
        "mix-decided",
    )
    discard(sources, shares, cut_big, quotas, cut_small)
    return Mix(decided, seed), sized


def mix(docs: DataFrame, **settings) -> DataFrame:
    """Documents, texts included, with size, source_size, target and taken."""
    decided, sized = plan_mix(docs, **settings)
    discard(sized)
    return decided.apply(docs)
