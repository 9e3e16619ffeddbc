"""Secret scans: candidate spans, and how widely each candidate is copied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderpost.llm.common import joined
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.session import stage

# kind, pattern, group that holds the value, shortest value
KINDS = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs shorter than this fail anyway, and a run never overlaps another one.
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
# What stands between the lines of a key, in source code and JSON too, and a key from its header
# to its END line or the end of its base64 lines. Possessive groups need no stack in Java.
_GAP, _END = r"""[\s\\"',]""", r"-----END\x20(?:[A-Z]+\x20)?PRIVATE\x20KEY-----"
PRIVATE_KEY = (
    r"-----BEGIN\x20(?:[A-Z]+\x20)?PRIVATE\x20KEY-----"
    r"(?:(?:\\[nr]|\s)++(?:Proc-Type|DEK-Info):\x20[A-Za-z0-9,-]++)*+"
    rf"(?:(?:{_GAP}*+[A-Za-z0-9+/=]{{16,}}+)++(?:{_GAP}++[A-Za-z0-9+/]++={{1,2}}+)?+)?+"
    rf"(?:{_GAP}*+[A-Za-z0-9+/=]*+{_GAP}*+{_END})?+"
)
# Found by form as well, but reported only if the corpus shows them to be one owner's.
KEYED = (
    "keyed",
    # Not inside a word, and with a digit: hyphenated prose has neither.
    r"(?<![A-Za-z0-9_.-])(?=[A-Za-z_.-]*[0-9])(?:gh[pousr]_|glpat-|sk-|xox[abprs]-|AIza|eyJ)[A-Za-z0-9_.-]{16,}"
    rf"|{PRIVATE_KEY}",
    0,
    16,
)
EXAMPLE_OWNERS = 3
EXAMPLE_DOCS = 10
LEAST_SIGNS = 6
# Matches that are placed together.
CHUNK = 64


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Matches in order: gap (signs before it), size, value; leftmost and not overlapping.

    The text between the matches gives their places: both lists in turn make up the text.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.slice(F.split(text, pattern, -1), 1, F.greatest(F.size(whole), F.lit(1)))
    sizes = F.zip_with(gaps, whole, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size")))
    parts = F.zip_with(
        sizes, values, lambda p, v: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), v.alias("value"))
    )
    return F.when(F.size(whole) > 0, parts).otherwise(F.array().cast("array<struct<gap:int,size:int,value:string>>"))


def _placed(parts: str, rank: int, least: int) -> Column:
    """Spans (start, rank, end, value) of a column of matches; too short values are dropped here.

    Only now, since a failing match uses up its text as well. Places are added up within chunks
    and then over chunks, so a text of many matches doesn't copy a list for each of them.
    """
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0)), F.lit(CHUNK)),
        lambda at: F.slice(F.col(parts), at + 1, F.lit(CHUNK)),
    )
    moved = lambda n, p: n + p["gap"] + p["size"]
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    starts = F.aggregate(
        chunks,
        zero,
        lambda acc, c: F.struct(
            F.aggregate(c, acc["at"], moved).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
        ),
        lambda acc: acc["out"],
    )
    kind = "array<struct<start:int,rank:int,end:int,value:string>>"

    def step(acc, p):
        begin = acc["at"] + p["gap"]
        end = begin + p["size"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), p["value"].alias("value"))
        out = F.when(F.length(p["value"]) >= least, F.concat(acc["out"], F.array(span)))
        return F.struct(end.alias("at"), out.otherwise(acc["out"]).alias("out"))

    return F.flatten(
        F.zip_with(
            chunks,
            starts,
            lambda c, at: F.aggregate(
                c, F.struct(at.alias("at"), F.array().cast(kind).alias("out")), step, lambda acc: acc["out"]
            ),
        )
    )


def _bare(value: Column) -> Column:
    """The value; a private key without what stands between its lines."""
    lines = F.regexp_replace(value, rf"\\[nr]|{_GAP}", "")
    return F.when(value.startswith("-----"), lines).otherwise(value)


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in (*KINDS, KEYED)])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _frequencies(spans: Column) -> Column:
    """kind:start:end:documents:owners in the order of ``_listed``, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in (*KINDS, KEYED)])
    numbers = ("start", "end", "docs", "owners")
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["rank"]), *[s[n].cast("string") for n in numbers]),
        ),
        ",",
    )


def scan(
    docs: DataFrame,
    owner: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
    example_docs: int = EXAMPLE_DOCS,
) -> DataFrame:
    """One row per document: counts by kind, base_sha256, spans, n_live, n_example, frequencies.

    Every candidate value is counted over the whole corpus: in how many documents
    (repositories) it stands and how many distinct owners have it. A value of
    ``example_owners`` owners or more, or in ``example_docs`` documents or more whoever owns them,
    is a copied example. Both are numbers of copies found, not shares: a credential of one owner
    gains neither as a corpus grows, unless it is copied. They are meant for corpora of ten
    thousand documents or more; a smaller one shows few of the copies there are. Any other value
    is live-looking if it has at least six different signs. Base spans always stay; spans found
    by a known key form (``keyed``) are added only if live-looking. n_live and n_example count all candidates,
    and frequencies lists them all as kind:start:end:documents:owners.
    A private key is its header and its whole body, whatever its line breaks are.

    Counting goes by (value, owner, document) first and by (value, owner) next, so a value that
    stands in a third of all documents is summed in parts. Texts are read once and not shuffled.

    Null texts are empty; null owners are one owner; documents without an id count as one
    document per owner; equal rows give equal rows. Positions are code points, end exclusive.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = (*KINDS, KEYED)
    lists = [_placed(f"_m{i}", i, least) for i, (_, _, _, least) in enumerate(kinds)]
    scanned = stage(
        docs.select(
            "doc_id",
            F.coalesce(F.concat(F.lit("="), F.col(owner).cast("string")), F.lit("null")).alias("_owner"),
            *[_matches(text, p, g).alias(f"_m{i}") for i, (_, p, g, _) in enumerate(kinds)],
        ).select(
            "doc_id",
            "_owner",
            F.monotonically_increasing_id().alias("_row"),
            F.concat(*lists[:-1]).alias("_base"),
            lists[-1].alias("_keyed"),
        ),
        "secrets",
    )
    some = scanned.filter((F.size("_base") > 0) | (F.size("_keyed") > 0))
    found = stage(
        some.select(
            "_row", "_owner", "doc_id", F.explode_outer(F.concat("_base", "_keyed")).alias("_span")
        ).select(
            "_row", "_owner", "doc_id", _bare(F.col("_span.value")).alias("_bare"), "_span"
        ).select(
            "_row", "_owner", "doc_id", F.sha2("_bare", 256).alias("_value"),
            F.size(F.array_distinct(F.split("_bare", ""))).alias("_signs"), "_span",
        ),
        "candidates",
    )
    spread = (
        found.groupBy("_value", "_owner", "doc_id", "_signs")
        .agg(F.lit(1).alias("_one"))
        .groupBy("_value", "_owner", "_signs")
        .agg(F.count("*").alias("_docs"))
        .groupBy("_value", "_signs")
        .agg(F.count("*").alias("_owners"), F.sum("_docs").alias("_docs"))
    )
    example = (F.col("_owners") >= example_owners) | (F.col("_docs") >= example_docs)
    classes = stage(
        spread.select(
            "_value",
            "_docs",
            "_owners",
            example.alias("_example"),
            (~example & (F.col("_signs") >= LEAST_SIGNS)).alias("_live"),
        ),
        "ownership",
    )
    added = F.col("_live") & (F.col("_span.rank") == len(KINDS))
    counted = F.struct(
        "_span.start", "_span.rank", "_span.end", F.col("_docs").alias("docs"), F.col("_owners").alias("owners")
    )
    judged = (
        keyed_lookup(found, classes, "_value")
        .groupBy("_row")
        .agg(
            F.count_if("_live").alias("n_live"),
            F.count_if("_example").alias("n_example"),
            F.collect_list(F.when(added, F.col("_span"))).alias("_added"),
            F.collect_list(counted).alias("_counted"),
        )
    )
    count = lambda i: F.size(F.filter("_base", lambda s: s["rank"] == i)).cast("long")
    spans = F.when(F.size("_added") > 0, F.concat("_base", "_added")).otherwise(F.col("_base"))
    return joined(scanned, stage(judged, "judged"), "_row").select(
        "doc_id",
        *[count(i).alias(f"n_{k[0]}") for i, k in enumerate(KINDS)],
        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
        F.coalesce(_frequencies(F.col("_counted")), F.lit("")).alias("frequencies"),
    )
