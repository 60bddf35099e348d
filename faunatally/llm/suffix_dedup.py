"""Removal of long repeated substrings by blockwise suffix sorting with a difference cover.

A byte is removed when a string of ``length`` bytes that covers it starts anywhere else as well. A difference cover modulo v
holds, for any two positions, an offset below v at which both fall on cover positions. So if two places agree on ``length`` bytes,
their suffixes at some pair of cover positions agree on the remaining ``length - v + 1`` bytes or more. That gives the steps:

1. rank the cover samples: suffixes at cover positions are compared on their first ``length - v + 1`` bytes, and a sample is
   tied if another one has the same rank;
2. a start can only be repeated if one of the cover samples in its next v positions is tied; the others need no sorting;
3. sort what is left one suffix bucket at a time, a bucket being a range of the suffixes' hashes small enough for the
   disks, and keep the starts that no other start ties with.

Strings are compared by 64-bit polynomial hashes. Texts with equal bytes are one text with several copies: all of it goes if it
has ``length`` bytes.

NULL texts are empty. Rows without a doc_id take part. Repeated rows repeat each other. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunatally.llm.stored import stored
from faunatally.llm.wordhash import mix
from faunatally.llm.workers import giving_back

LENGTH = 400
PIECE_BYTES = 1 << 20
BUCKET_ENTRIES = 1_000_000
PASS_BYTES = 512 * 1024 * 1024
ENTRY_BYTES = 20
#: Entries that a task sorts at once, about 64 bytes each while it does.
SLICE_ENTRIES = 250_000
_STEP = 0xD1342543DE82EF95
_COEFFICIENTS = np.random.default_rng(20260102).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """(v, cover): 6 r + 4 residues modulo v = 24 r^2 + 36 r + 13 whose differences give every residue."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate([[0], np.cumsum(steps)])


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The sparsest cover whose samples keep a sixth of the length or more to compare."""
    r = 0
    while difference_cover(r + 1)[0] <= length - length // 6 + 1:
        r += 1
    return difference_cover(r) if length >= 16 else (1, np.zeros(1, np.int64))


def window_hashes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each of the ascending starts; in pieces, so a long text needs no more memory."""
    up, down = _powers(PIECE_BYTES + length + 1)
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(data), PIECE_BYTES):
        low, high = np.searchsorted(starts, (at, at + PIECE_BYTES))
        if low == high:
            continue
        piece = data[at : at + PIECE_BYTES + length]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_COEFFICIENTS[piece] * up[: len(piece)], out=sums[1:])
        here = starts[low:high] - at
        out[low:high] = mix((sums[here + length] - sums[here]) * down[here])
    return out


_known_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _known_powers:
        both = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _known_powers.clear()
        _known_powers[n] = tuple(both)
    return _known_powers[n]


def cover_starts(size: int, v: int, cover: np.ndarray, key_bytes: int) -> np.ndarray:
    """Cover positions of a text of ``size`` bytes with ``key_bytes`` bytes from there."""
    places = size - key_bytes + 1
    if places <= 0:
        return np.zeros(0, np.int64)
    starts = (np.arange(-(-places // v))[:, None] * v + cover[None, :]).ravel()
    return starts[starts < places]


def candidate_starts(tied: np.ndarray, size: int, length: int, v: int) -> np.ndarray:
    """Starts (first, end, first, end, ...) with a tied cover sample (ascending) in the next v positions."""
    first = np.maximum(tied.astype(np.int64) - v + 1, 0)
    end = np.minimum(tied.astype(np.int64) + 1, size - length + 1)
    first, end = first[end > first], end[end > first]
    if not len(first):
        return first
    new = np.ones(len(first), dtype=bool)
    new[1:] = first[1:] > end[:-1]
    last = np.append(new[1:], True)
    return np.column_stack([first[new], end[last]]).ravel()


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _name(data: bytes) -> int:
    """63 bits of a digest; texts with equal bytes are one."""
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little") >> 1


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, name, n_bytes, whole_sha256) of every row."""

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(_name(d), len(d), sha256(d).hexdigest()) for d in map(_bytes, batch["text"])]
            out = pd.DataFrame(rows, columns=["name", "n_bytes", "whole_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return docs.mapInPandas(giving_back(measured), "doc_id long, name long, n_bytes long, whole_sha256 string")


def _ordered(keys: np.ndarray, names: np.ndarray, starts: np.ndarray, known: np.ndarray):
    """Distinct entries in order of key, the first of each key, and whether the key is tied."""
    order = np.lexsort((starts, names, keys))
    keys, names, starts, known = keys[order], names[order], starts[order], known[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1]) | (starts[1:] != starts[:-1])
    group = np.cumsum(new) - 1
    known = np.bincount(group, known, minlength=int(new.sum())).astype(bool) if len(keys) else known
    keys, names, starts = keys[new], names[new], starts[new]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    run = np.cumsum(first) - 1
    tied = np.bincount(run) > 1 if len(keys) else np.zeros(0, bool)
    if len(keys):
        tied |= np.bincount(run, known).astype(bool)
    return keys, names, starts, first, tied[run] if len(keys) else tied


PACKED = "tied boolean, bucket long, keys binary, names binary, starts binary"


def _packed(keys, names, starts, tied, buckets: int, chosen) -> list[tuple]:
    """Rows of packed entries, one for each bucket."""
    keys, names, starts = keys[chosen], names[chosen], starts[chosen]
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return [
        (tied, int(bucket[p[0]]), keys[p].tobytes(), names[p].tobytes(), starts[p].tobytes())
        for p in (np.split(order, cuts) if len(order) else ())
    ]


def _unpacked(packed: pd.DataFrame):
    """Entries of one bucket; those packed as tied stay so."""
    parts = [
        np.frombuffer(b"".join(packed[c]), kind) for c, kind in (("keys", np.uint64), ("names", np.int64), ("starts", np.int32))
    ]
    known = np.repeat(packed["tied"].to_numpy(dtype=bool), packed["keys"].map(len).to_numpy() // 8)
    return _ordered(*parts, known.astype(np.float64))


def _by_name(names: np.ndarray, starts: np.ndarray, column: str) -> pd.DataFrame:
    """One row for each name, with its starts."""
    order = np.lexsort((starts, names))
    names, starts = names[order], starts[order]
    cuts = np.flatnonzero(np.diff(names)) + 1
    heads = names[np.concatenate([[0], cuts])] if len(names) else names
    lists = pd.Series(np.split(starts, cuts) if len(names) else [], dtype=object)
    return pd.DataFrame({"name": heads, column: lists})


def _slices(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of texts with about ``SLICE_ENTRIES`` entries at most, or one larger text."""
    at, total = 0, 0
    for k, size in enumerate(sizes):
        if k > at and total + size > SLICE_ENTRIES:
            yield slice(at, k)
            at, total = k, 0
        total += size
    if at < len(sizes):
        yield slice(at, len(sizes))


def _entries(made: list[tuple[np.ndarray, int, np.ndarray]]):
    """Entries of a batch, from (keys, name, starts) of each text. Ties within the batch are known now."""
    lengths = [len(k) for k, _, _ in made]
    return _ordered(
        np.concatenate([k for k, _, _ in made]),
        np.repeat(np.array([n for _, n, _ in made], np.int64), lengths),
        np.concatenate([s for _, _, s in made]).astype(np.int32),
        np.zeros(sum(lengths)),
    )


def _tied_samples(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """(name, tied): the cover positions of each text whose sample is tied. A text may have several rows."""
    v, cover = cover_for(length)
    key_bytes = length - v + 1
    schema = "name long, tied array<int>"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _slices(np.array([len(_bytes(t)) for t in batch["text"]]) * len(cover) // v):
                made = []
                for data in map(_bytes, batch["text"].iloc[part]):
                    if len(data) >= length:
                        starts = cover_starts(len(data), v, cover, key_bytes)
                        made.append((window_hashes(np.frombuffer(data, np.uint8), starts, key_bytes), _name(data), starts))
                if not made:
                    continue
                keys, names, starts, first, tied = _entries(made)
                # of entries tied within the batch one per key goes to the key's bucket; all pass through, by text
                rows = _packed(keys, names, starts, False, buckets, ~tied)
                rows += _packed(keys, names, starts, True, buckets, tied & first)
                own = names.view(np.uint64) << np.uint64(32)
                passed = _packed(own, names, starts, True, buckets, tied)
                rows += [(None, bucket, k, n, s) for _, bucket, k, n, s in passed]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in PACKED.split(", ")])

    def match(key: tuple, packed: pd.DataFrame) -> pd.DataFrame:
        if key[0]:
            names = np.frombuffer(b"".join(packed["names"]), np.int64)
            starts = np.frombuffer(b"".join(packed["starts"]), np.int32)
        else:
            _, names, starts, _, tied = _unpacked(packed)
            names, starts = names[tied], starts[tied]
        return _by_name(names, starts, "tied")

    packed = docs.select("text").mapInPandas(giving_back(pack), PACKED)
    return packed.groupBy(F.col("tied").isNull().alias("passed"), "bucket").applyInPandas(match, schema)


def _candidates(docs: DataFrame, tied: DataFrame, length: int) -> DataFrame:
    """(name, text, n_bytes, starts): texts with starts that may be repeated, once each."""
    v, _ = cover_for(length)

    def narrowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text, found in zip(batch["name"], batch["text"], batch["tied"]):
                size = len(_bytes(text))
                starts = candidate_starts(np.unique(found), size, length, v)
                if len(starts):
                    rows.append((name, text, size, starts))
            yield pd.DataFrame(rows, columns=["name", "text", "n_bytes", "starts"])

    lists = tied.groupBy("name").agg(F.flatten(F.collect_list("tied")).alias("tied"))
    met = docs.join(lists, "name").select("name", "text", "tied")
    return met.mapInPandas(giving_back(narrowed), "name long, text string, n_bytes long, starts array<int>").dropDuplicates(["name"])


def _unrepeated(candidates: DataFrame, length: int, passes: int, number: int, buckets: int, parts: int) -> DataFrame:
    """(part, names, starts): candidate starts of one pass that no other start ties with, packed by bucket and part of the texts.

    A bucket has starts of nearly all texts, so a row for each text would make as many rows as texts times buckets.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chosen in _slices(np.array([int(np.sum(r[1::2] - r[::2])) for r in batch["starts"]])):
                made = []
                part = batch.iloc[chosen]
                for name, text, ranges in zip(part["name"], part["text"], part["starts"]):
                    starts = np.concatenate([np.arange(a, b) for a, b in zip(ranges[::2], ranges[1::2])])
                    keys = window_hashes(np.frombuffer(_bytes(text), np.uint8), starts, length)
                    mine = keys % np.uint64(passes) == number
                    made.append((keys[mine], name, starts[mine]))
                if not made:
                    continue
                keys, names, starts, first, tied = _entries(made)
                rows = _packed(keys, names, starts, False, buckets, ~tied)
                rows += _packed(keys, names, starts, True, buckets, tied & first)
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in PACKED.split(", ")])

    def match(packed: pd.DataFrame) -> pd.DataFrame:
        _, names, starts, _, tied = _unpacked(packed)
        names, starts = names[~tied], starts[~tied]
        part = names % parts
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        rows = [(int(part[p[0]]), names[p].tobytes(), starts[p].tobytes()) for p in (np.split(order, cuts) if len(order) else ())]
        return pd.DataFrame(rows, columns=["part", "names", "starts"])

    packed = candidates.select("name", "text", "starts").mapInPandas(giving_back(pack), PACKED)
    return packed.groupBy("bucket").applyInPandas(match, "part long, names binary, starts binary")


def _gathered(packed: DataFrame) -> DataFrame:
    """(name, alone): one row for each text that has starts in ``packed``."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        names = np.frombuffer(b"".join(rows["names"]), np.int64)
        return _by_name(names, np.frombuffer(b"".join(rows["starts"]), np.int32), "alone")

    return packed.groupBy("part").applyInPandas(gather, "name long, alone array<int>")


def removed_spans(starts: np.ndarray, single: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal byte spans covered by the candidate starts other than the single ones."""
    spans: list[list[int]] = []
    single = np.sort(single)
    for first, end in zip(starts[::2], starts[1::2]):
        inside = single[np.searchsorted(single, first) : np.searchsorted(single, end)]
        edges = np.concatenate([[first - 1], inside, [end]])
        for a, b in zip(edges[:-1] + 1, edges[1:]):
            if b > a:
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = int(b) - 1 + length
                else:
                    spans.append([int(a), int(b) - 1 + length])
    return [tuple(s) for s in spans]


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    ``spans`` holds the removed byte spans as first, end, first, end, ...; ``kept_sha256`` is of the bytes that stay.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = stored(_texts(texts))
    v, cover = cover_for(length)
    size = made.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(256, size * len(cover) // v // BUCKET_ENTRIES)
    tied = stored(_tied_samples(texts, length, buckets))

    @F.pandas_udf("long")
    def name_of(part: pd.Series) -> pd.Series:
        return part.map(lambda t: _name(_bytes(t))).astype("int64")

    candidates = stored(_candidates(texts.withColumn("name", name_of("text")), tied, length))
    pairs = F.aggregate("starts", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("s")), lambda x, y: F.struct(
        (x["n"] + x["s"] * y).alias("n"), (-x["s"]).alias("s")))["n"]
    number = candidates.agg(F.sum(pairs)).first()[0] or 0
    passes = max(1, -(-number * ENTRY_BYTES // pass_bytes))
    buckets = max(32, -(-max(64, number // BUCKET_ENTRIES) // passes))
    parts = max(256, number // BUCKET_ENTRIES)
    single = [stored(_unrepeated(candidates, length, passes, k, buckets, parts)) for k in range(passes)]
    alone = single[0]
    for more in single[1:]:
        alone = alone.union(more)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text, starts, lone in zip(batch["name"], batch["text"], batch["starts"], batch["alone"]):
                spans = removed_spans(np.asarray(starts), np.asarray(lone if lone is not None else [], np.int64), length)
                data, digest, at = _bytes(text), sha256(), 0
                for first, end in spans:
                    digest.update(data[at:first])
                    at = end
                digest.update(data[at:])
                flat = [x for span in spans for x in span]
                rows.append((name, sum(b - a for a, b in spans), len(spans), digest.hexdigest(), flat))
            yield pd.DataFrame(rows, columns=["name", "removed", "runs", "kept", "cut_spans"])

    done = stored(
        candidates.join(_gathered(alone), "name", "left").select("name", "text", "starts", "alone")
        .mapInPandas(giving_back(cut), "name long, removed long, runs long, kept string, cut_spans array<int>")
    )
    copies = made.groupBy("name").agg((F.count(F.lit(1)) > 1).alias("copied"))
    whole = F.col("copied") & (F.col("n_bytes") >= length)
    return (
        made.join(copies, "name").join(done, "name", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
            F.when(whole, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole_sha256")).alias("kept_sha256"),
            F.when(whole, F.array(F.lit(0), F.col("n_bytes").cast("int")))
            .otherwise(F.coalesce("cut_spans", F.array().cast("array<int>"))).alias("spans"),
        )
    )
