"""Suffix-array dedup: every byte covered by a long string that also starts elsewhere."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderpost.llm.common import joined
from cinderpost.operators.lookup import keyed_lookup
from cinderpost.session import bucketed_table, discard, ship_package, stage

LENGTH = 200
GRAM = 72
# Bytes of text that one suffix array or one winnowing pass holds at once.
SHARD_BYTES = 1 << 20
CHUNK_STARTS = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class _Rolling:
    """Hashes of all substrings of one length, by differences of one cumulative sum."""

    def __init__(self, base: int) -> None:
        self.base, self.up, self.down = base, np.empty(0, np.uint64), np.empty(0, np.uint64)

    def __call__(self, data: np.ndarray, length: int) -> np.ndarray:
        n = len(data)
        if n < length:
            return np.empty(0, np.uint64)
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, max(n, 1 << 16))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        out = (sums[length:] - sums[:-length]) * self.down[: n - length + 1]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
        return out


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row, with two running minima per block."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def route(data: np.ndarray, roll: _Rolling, length: int, gram: int):
    """Per start of a ``length``-byte string the hash of its smallest k-gram, and its place.

    Equal strings have the same hash at the same place inside, so the hash tells where a string
    and its copies meet. ``data`` has less than 2^21 bytes; of equal hashes the last one counts.
    """
    hashes = roll(data, gram)
    mask = np.uint64((1 << 21) - 1)
    keys = (hashes & ~mask) | (mask - np.arange(len(hashes), dtype=np.uint64))
    at = (mask - (_sliding_min(keys, length - gram + 1) & mask)).astype(np.int64)
    return hashes[at].view(np.int64), at


def _chunks(texts: pd.DataFrame, length: int) -> Iterator[tuple[np.ndarray, list[tuple]]]:
    """Texts put together to arrays of about CHUNK_STARTS bytes; longer ones are cut by starts.

    Yields the bytes and (begin in the bytes, starts, ta, tb, offset in the text).
    """
    parts, places, size = [], [], 0
    for r in texts.itertuples(index=False):
        for offset in range(0, max(0, len(r.body) - length + 1), CHUNK_STARTS):
            piece = np.frombuffer(r.body, np.uint8)[offset : offset + CHUNK_STARTS + length - 1]
            if size and size + len(piece) > CHUNK_STARTS:
                yield np.concatenate(parts), places
                parts, places, size = [], [], 0
            places.append((size, len(piece) - length + 1, r.ta, r.tb, offset))
            parts.append(piece)
            size += len(piece)
    if parts:
        yield np.concatenate(parts), places


def _pieces(length: int, gram: int):
    """Maximal stretches of starts with one routing hash: ta, tb, lo, hi, hash, several."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll = _Rolling(_BASE)
        for batch in batches:
            for data, places in _chunks(batch, length):
                hashes, at = route(data, roll, length, gram)
                begin, starts, ta, tb, offset = (np.array(c, np.int64) for c in zip(*places))
                own = np.repeat(np.arange(len(begin)), starts)
                place = np.arange(len(own)) - np.repeat(np.cumsum(starts) - starts, starts) + begin[own]
                value = hashes[place]
                edge = np.flatnonzero((own[1:] != own[:-1]) | (value[1:] != value[:-1])) + 1
                lo = np.concatenate([[0], edge])
                hi = np.concatenate([edge - 1, [len(own) - 1]])
                who = own[lo]
                shift = offset[who] - begin[who]
                yield pd.DataFrame(
                    {
                        "ta": ta[who],
                        "tb": tb[who],
                        "lo": place[lo] + shift,
                        "hi": place[hi] + shift,
                        "hash": value[lo],
                        "several": at[place[lo]] != at[place[hi]],
                    }
                )

    return find


def _cut_out(length: int):
    """Texts with their candidate stretches to rows that carry the bytes and a digest of them."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                for p in r.pieces:
                    body = bytes(r.body[p["lo"] : p["hi"] + length])
                    digest = hashlib.blake2b(body, digest_size=16).digest()
                    da, db = (int.from_bytes(d, "big", signed=True) for d in (digest[:8], digest[8:]))
                    out.append((p["hash"], da % p["parts"], p["parts"] > 1, r.ta, r.tb, p["lo"], da, db, body))
            yield pd.DataFrame(out, columns=["hash", "salt", "split", "ta", "tb", "lo", "da", "db", "body"])

    return cut


def suffix_ranks(data: np.ndarray, upto: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order by the first ``upto`` bytes or more, and the ranks by the first ``keep``.

    Larsson and Sadakane's refinement: sort by eight bytes, then double the length by the ranks
    of the suffixes that many bytes on. A rank is the first place of its group, and groups of
    one are left alone.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(n, np.uint64)
    for j in range(8):
        words = (words << np.uint64(8)) | padded[j : j + n]
    order = np.argsort(words, kind="stable")
    rank = np.empty(n, np.int64)

    def number(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))
        rank[order[slots]] = slots[first]
        alone = fresh & np.concatenate([fresh[1:], [True]])
        return slots[~alone]

    slots = number(np.arange(n), words[order])
    h, kept = 8, None
    while h < upto:
        if h >= keep and kept is None:
            kept = rank.copy()
        if len(slots):
            at = order[slots]
            after = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
            keys = rank[at] * np.int64(n + 2) + after
            inside = np.argsort(keys, kind="stable")
            order[slots] = at[inside]
            slots = number(slots, keys[inside])
        h *= 2
    return order, rank.copy() if kept is None else kept


def common_prefixes(data: np.ndarray, order: np.ndarray, kept: np.ndarray, keep: int, upto: int) -> np.ndarray:
    """Per place in suffix order the bytes shared with the suffix before, up to ``upto``.

    Kasai's walk through the text: the next suffix shares at least one byte less, if the suffix
    before it is the next one too. Suffixes that agree in all bytes of the order are tied, so
    that need not hold; elsewhere all bytes from ``keep`` on are compared. It is done for many
    stretches of the text at once, and only where ``keep`` bytes are known to be shared; elsewhere
    the result is 0.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    worth = (before >= 0) & (kept == kept[before])
    places = np.flatnonzero(worth)
    shared = np.zeros(n, np.int64)
    if not len(places):
        return shared
    lane = np.concatenate([[True], np.diff(places) != 1])
    lane[::256] = True
    begin = np.flatnonzero(lane)
    size = np.diff(np.concatenate([begin, [len(places)]]))
    longest_first = np.argsort(-size, kind="stable")
    begin, size = places[begin][longest_first], size[longest_first]
    have = np.full(len(begin), keep, np.int64)
    padded = np.concatenate([data, np.zeros(upto + 1, np.uint8)])
    for step in range(size[0] if len(size) else 0):
        live = int(np.searchsorted(-size, -step, side="left"))
        i = begin[:live] + step
        j = before[i]
        got = np.full(live, keep, np.int64)
        if step:
            got = np.where(j == before[i - 1] + 1, np.maximum(have[:live] - 1, keep), got)
        open_ = np.arange(live)
        while len(open_):
            a, b = i[open_] + got[open_], j[open_] + got[open_]
            same = (got[open_] < upto) & (a < n) & (b < n) & (padded[a] == padded[b])
            open_ = open_[same]
            got[open_] += 1
        have[:live] = got
        shared[i] = got
    out = np.zeros(n, np.int64)
    out[:] = shared[order]
    return out


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end (inclusive) of the runs of true values."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1


def distinct_pieces(cut: DataFrame) -> DataFrame:
    """One row per piece of equal bytes: hash, salt, split, da, db, body, many (at two places).

    Equal pieces are put together before the shuffle too, so what a passage of many documents
    costs a task grows with the tasks before it and not with the documents.
    """
    return cut.groupBy("hash", "salt", "split", "da", "db").agg(
        F.first("body").alias("body"), (F.count("*") > 1).alias("many")
    )


def repeated_starts(pieces: dict[bytes, tuple], length: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For distinct pieces with (da, db, many): which starts are repeated, and their groups.

    Returns a flag per start for every piece, the starts' group numbers, and the bytes' places
    of the starts in the pieces put together.
    """
    bodies = list(pieces)
    sizes = np.array([len(b) for b in bodies])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    order, kept = suffix_ranks(data, length, 128 if length > 128 else 8)
    shared = common_prefixes(data, order, kept, 128 if length > 128 else 8, length)
    group = np.empty(len(data), np.int64)
    group[order] = np.cumsum(shared < length)
    begin = np.cumsum(sizes) - sizes
    starts = np.concatenate([np.arange(b, b + s - length + 1) for b, s in zip(begin, sizes)])
    copies = np.repeat([1 + pieces[b][2] for b in bodies], sizes - length + 1)
    _, own = np.unique(group[starts], return_inverse=True)
    many = np.bincount(own, weights=copies) > 1
    flags = np.split(many[own], np.cumsum(sizes - length + 1)[:-1])
    return flags, own, starts


def _searched(length: int):
    """Distinct pieces, sorted by shard, to stretches of starts that are repeated.

    Stretches have da, db, lo, hi, counted from the begin of the piece. A shard that is only part of its hash also gives rows with
    fa, fb, a digest of the string from lo: for every start that is not yet known to be
    repeated, and for one start of every group that is.
    """

    def gathered(found: list[tuple], prints: list[tuple]) -> pd.DataFrame:
        """One table of (da, db, lo, hi) and, for some, (fa, fb), each entry for many starts."""
        rows, n = found + [p[:4] for p in prints], sum(len(r[2]) for r in found)
        sizes = [len(r[2]) for r in rows]
        out = {
            "da": np.repeat(np.array([r[0] for r in rows], np.int64), sizes),
            "db": np.repeat(np.array([r[1] for r in rows], np.int64), sizes),
            "lo": np.concatenate([r[2] for r in rows]),
            "hi": np.concatenate([r[3] for r in rows]),
        }
        known = np.arange(len(out["da"])) >= n
        for i, name in enumerate(("fa", "fb")):
            values = np.concatenate([np.zeros(n, np.int64), *[p[4 + i] for p in prints]])
            out[name] = pd.arrays.IntegerArray(values, ~known)
        return pd.DataFrame(out)

    def solve(pieces: dict[bytes, tuple], split: bool) -> Iterator[pd.DataFrame]:
        if not pieces:
            return
        flags, own, starts = repeated_starts(pieces, length)
        found, prints = [], []
        for flag, (da, db, _) in zip(flags, pieces.values()):
            lo, hi = _stretches(flag)
            if len(lo):
                found.append((da, db, lo, hi))
        if split:
            firsts = np.zeros(len(starts), bool)
            firsts[np.unique(own, return_index=True)[1]] = True
            base = 0
            for flag, (body, (da, db, _)) in zip(flags, pieces.items()):
                wanted = np.flatnonzero(firsts[base : base + len(flag)] | ~flag)
                marks = b"".join(hashlib.blake2b(body[w : w + length], digest_size=16).digest() for w in wanted.tolist())
                fa, fb = np.frombuffer(marks, np.int64).reshape(-1, 2).T
                prints.append((da, db, wanted, wanted, fa, fb))
                base += len(flag)
        if found or prints:
            yield gathered(found, prints)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: dict[bytes, tuple] = {}
        size, at, split = 0, None, False
        for batch in batches:
            for r in batch.itertuples(index=False):
                shard = (r.hash, r.salt)
                # A shard ends with its hash; several small hashes share one array.
                if shard != at and (split or r.split or size >= SHARD_BYTES):
                    yield from solve(pieces, split)
                    pieces, size = {}, 0
                at, split = shard, r.split
                body = bytes(r.body)
                pieces[body] = (r.da, r.db, r.many)
                size += len(body)
        yield from solve(pieces, split)

    return search


def _text_id() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("ta"), F.hash(F.length(text), text).cast("long").alias("tb")]


def _result(length: int):
    kind = T.StructType(
        [
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    @F.pandas_udf(kind)
    def cut(body: pd.Series, los: pd.Series, his: pd.Series) -> pd.DataFrame:
        out = []
        for b, lo, hi in zip(body, los, his):
            order = np.argsort(lo, kind="stable")
            lo, hi = np.asarray(lo)[order], np.asarray(hi)[order] + length
            reach = np.maximum.accumulate(hi)
            fresh = np.concatenate([[True], lo[1:] > reach[:-1]])
            begin = lo[fresh]
            end = reach[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(lo) - 1]])]
            gaps = zip(np.concatenate([[0], end]), np.concatenate([begin, [len(b)]]))
            out.append((int((end - begin).sum()), len(begin), b"".join(b[i:j] for i, j in gaps)))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept"])

    return cut


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) of every document.

    A byte goes if it is covered by a string of ``length`` bytes that also starts at another
    place, in the same document or another one; strings are judged on the input.

    1. Equal texts are one text; if it has the length and occurs twice, all of it goes.
    2. Winnowing: every string is routed by the hash of its smallest ``gram``-byte substring, in
       one pass over the text. Copies of a string have the same hash, so only strings whose hash
       occurs twice can be repeated, and all copies meet in the shard of their hash.
    3. Shards hold the distinct bytes of these strings, counted once or more than once, and build a suffix array by Larsson and Sadakane's
       refinement, with Kasai's common prefixes: neighbours that share ``length`` bytes are
       copies. A shard holds about ``shard`` bytes.
    4. A hash with more than that is dealt into several shards by a digest of the bytes. What
       they find is merged over all shards by digests (128 bits) of the strings.
    5. What was found in a piece goes back to all its places by the digest (128 bits) of its bytes.

    Null and empty texts have no bytes. Texts are UTF-8. Rows count as they come, equal ones as
    copies; extra columns are ignored.
    """
    ship_package(docs.sparkSession)
    own = docs.select("doc_id", *_text_id(), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    ids = F.struct("ta", "tb").alias("_text")
    n = F.octet_length("body").cast("long").alias("n_bytes")
    # Texts are shuffled once, one of each after copies met on the map side, and lie by their id
    # from then on: neither the pieces to cut out nor the spans to remove make them move again.
    single = bucketed_table(
        own.filter(F.octet_length("body") >= length)
        .groupBy("ta", "tb")
        .agg(F.first("body").alias("body"), F.count("*").alias("copies"), F.min("doc_id").alias("doc_id")),
        "texts",
        "ta",
        "tb",
    )
    copied = stage(single.filter("copies > 1").select(ids, F.lit(True).alias("_copied")), "copied-texts")
    pieces = stage(
        single.select("ta", "tb", "body").mapInPandas(_pieces(length, gram), "ta long, tb long, lo long, hi long, hash long, several boolean"),
        "pieces",
    )
    size = F.col("hi") - F.col("lo") + length
    hashes = stage(
        pieces.groupBy("hash")
        .agg(F.count("*").alias("n"), F.sum(size).alias("size"), F.max("several").alias("several"))
        .filter("n > 1 OR several")
        .select("hash", F.ceil(F.col("size") / shard).cast("int").alias("parts")),
        "repeated-hashes",
    )
    entry = F.struct("lo", "hi", "hash", "parts")
    wanted = stage(
        joined(pieces.select("ta", "tb", "lo", "hi", "hash"), hashes, "hash", "inner")
        .groupBy("ta", "tb")
        .agg(F.collect_set(entry).alias("pieces")),
        "wanted-pieces",
    )
    discard(pieces, hashes)
    bodies = joined(single, wanted, ["ta", "tb"], "inner").select("ta", "tb", "body", "pieces")
    kind = "hash long, salt int, split boolean, ta long, tb long, lo long, da long, db long, body binary"
    rows = stage(bodies.mapInPandas(_cut_out(length), kind), "cut-pieces")
    found = stage(
        distinct_pieces(rows)
        .repartition("hash", "salt")
        .sortWithinPartitions("hash", "salt")
        .mapInPandas(_searched(length), "da long, db long, lo long, hi long, fa long, fb long"),
        "repeats",
    )
    prints = found.filter("fa IS NOT NULL").distinct()
    shared = prints.groupBy("fa", "fb").agg(F.count("*").alias("n")).filter("n > 1").select("fa", "fb")
    merged = prints.join(shared, ["fa", "fb"]).select("da", "db", "lo", "hi")
    piece = F.struct("da", "db").alias("_piece")
    repeats = stage(
        found.filter("fa IS NULL")
        .select("da", "db", "lo", "hi")
        .union(merged)
        .groupBy("da", "db")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("_s"))
        .select(piece, F.transform("_s", lambda s: s["lo"]).alias("_lo"), F.transform("_s", lambda s: s["hi"]).alias("_hi")),
        "repeats-of-pieces",
    )
    shifted = lambda c: F.transform(c, lambda x: x + F.col("lo")).alias(c)
    spans = stage(
        keyed_lookup(rows.select(piece, "ta", "tb", "lo"), repeats, "_piece", "inner")
        .groupBy("ta", "tb")
        .agg(F.collect_list(F.struct(shifted("_lo"), shifted("_hi"))).alias("_s"))
        .select(
            "ta",
            "tb",
            F.flatten(F.transform("_s", lambda s: s["_lo"])).alias("_lo"),
            F.flatten(F.transform("_s", lambda s: s["_hi"])).alias("_hi"),
        ),
        "spans",
    )
    discard(rows, repeats)
    discard(found, wanted)
    whole = F.struct(F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"))
    none = F.struct(F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("body").alias("kept"))
    short = own.filter(F.octet_length("body") < length).select("doc_id", n, none.alias("_r"))
    # Copies go whole, so their texts are not needed.
    copies = own.filter(F.octet_length("body") >= length).select("doc_id", n, ids)
    gone = joined(copies, copied, "_text", "inner").select("doc_id", "n_bytes", whole.alias("_r"))
    once = single.filter("copies = 1")
    some = joined(once, spans, ["ta", "tb"], "inner").select("doc_id", n, _result(length)("body", "_lo", "_hi").alias("_r"))
    rest = joined(once, spans.select("ta", "tb"), ["ta", "tb"], "left_anti").select("doc_id", n, none.alias("_r"))
    return short.unionByName(gone).unionByName(some).unionByName(rest).select("doc_id", "n_bytes", "_r.*")
