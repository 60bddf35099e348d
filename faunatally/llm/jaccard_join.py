"""Exact join of near-duplicate texts on the Jaccard similarity of their word shingles, and its components.

Filters come from several global token orders. A pair at similarity ``t`` shares at least ``l`` tokens among the first
``n - ceil(t n) + l`` tokens of either set under *any* order of all tokens, so each order gives a necessary condition and
the conditions may be intersected:

1. by ascending hash, for every text: tokens of the prefix that no other text has in its prefix are of no use, and a text
   keeps its place only with enough of the others;
2. by descending hash, for texts that share such tokens with another component;
3. by number of components that hold the token, rarest first, for the texts still in play: common passages come last
   and give no candidates;
4. by descending and by rotated hash, for each candidate pair, before the two sets are intersected.

Texts with equal sets are one class. Classes that share prefix tokens are first linked, in a few rounds, to one leader per
token and size band, which finds almost all components without pairing the members of a group; the third order then pairs only
texts of different components. Every candidate is verified on the whole sets, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faunatally.llm.components import components
from faunatally.llm.wordhash import BETWEEN_SPACES, shingle_set, word_hashes
from faunatally.llm.stored import stored
from faunatally.llm.workers import giving_back

SHINGLE_WORDS = 5
PERCENT = 80
BROADCAST_IDS = 1_000_000
LEADERS = 8
ROUNDS = 4
_ROTATIONS = (1 << 62, 1 << 63, 3 << 62)


def _most(n: Column | str, percent: int) -> Column:
    """ceil(t n): the least overlap a set of n tokens needs."""
    n = F.col(n) if isinstance(n, str) else n
    return ((n * percent + 99) / 100).cast("long")


def _extra(n):
    """The l of a set of n tokens; never smaller for a larger set."""
    return 1 + n // 20


def _prefix(n: int, percent: int) -> int:
    return n - (n * percent + 99) // 100 + _extra(n)


def _hashed(batch: pd.DataFrame, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(node, tokens) of each text. A node is named by 63 bits of its set's digest, 0 for the empty set. Tokens ascend."""
    for at in range(0, len(batch), 256):
        for hashes in word_hashes(batch["text"].iloc[at : at + 256], BETWEEN_SPACES):
            # signed as Spark's longs are, in one order everywhere
            tokens = (shingle_set(hashes, words) ^ np.uint64(1 << 63)).view(np.int64)
            digest = blake2b(tokens.tobytes(), digest_size=8).digest()
            yield (int.from_bytes(digest, "little") >> 1 | 1) if len(tokens) else 0, tokens


def _sizes(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, node) of every row."""

    @giving_back
    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [(len(tokens), node) for node, tokens in _hashed(batch, words)]
            out = pd.DataFrame(made, columns=["n", "node"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return docs.mapInPandas(sized, "doc_id long, n long, node long")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, n, tokens) of every row, with the whole set."""

    @giving_back
    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [(node, len(tokens), tokens) for node, tokens in _hashed(batch, words)]
            yield pd.DataFrame(made, columns=["node", "n", "tokens"])

    return docs.mapInPandas(whole, "node long, n long, tokens array<long>")


def _runs(tokens: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (token, node) in order, the first place of each token, and which rows share their token."""
    order = np.lexsort((nodes, tokens))
    tokens, nodes = tokens[order], nodes[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
    tokens, nodes = tokens[new], nodes[new]
    first = np.ones(len(tokens), dtype=bool)
    first[1:] = tokens[1:] != tokens[:-1]
    alone = first.copy()
    alone[:-1] &= first[1:]
    return tokens, nodes, first, ~alone


def _shared_tokens(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """(token, node) of the prefix tokens that two or more nodes have. A pair may occur on two rows.

    Tokens travel packed, a batch's tokens of one bucket in one row. A token that several nodes of a batch have is known to be
    shared: its rows pass through, spread by node, and only its least node goes to the token's bucket. So a bucket gets
    a token once per batch at most, however many texts have it, and holds about 500,000 tokens.
    """

    @giving_back
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [(node, t[: _prefix(len(t), percent)].copy()) for node, t in _hashed(batch, words) if node]
            if not made:
                continue
            lengths = [len(tokens) for _, tokens in made]
            tokens, nodes, first, shared = _runs(
                np.concatenate([tokens for _, tokens in made]), np.repeat([node for node, _ in made], lengths)
            )
            rows = []
            for known, chosen in ((False, first), (True, shared)):
                t, x = tokens[chosen], nodes[chosen]
                bucket = ((x if known else t).view(np.uint64) >> np.uint64(7)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                for part in np.split(order, cuts) if len(order) else ():
                    rows.append((known, int(bucket[part[0]]), t[part].tobytes(), x[part].tobytes()))
            yield pd.DataFrame(rows, columns=["known", "bucket", "tokens", "nodes"])

    def match(key: tuple, packed: pd.DataFrame) -> pd.DataFrame:
        tokens = np.frombuffer(b"".join(packed["tokens"]), np.int64)
        nodes = np.frombuffer(b"".join(packed["nodes"]), np.int64)
        if not key[0]:
            tokens, nodes, _, shared = _runs(tokens, nodes)
            tokens, nodes = tokens[shared], nodes[shared]
        return pd.DataFrame({"token": tokens, "node": nodes})

    packed = docs.mapInPandas(pack, "known boolean, bucket long, tokens binary, nodes binary")
    return packed.groupBy("known", "bucket").applyInPandas(match, "token long, node long")


def _from(tokens: np.ndarray, start: np.int64, length: int) -> np.ndarray:
    """The first tokens in the order that begins at ``start`` and wraps around."""
    at = int(np.searchsorted(tokens, start))
    return np.take(tokens, np.arange(at, at + length), mode="wrap")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Prefix conditions under further orders, then the exact test."""
    n, m = len(a), len(b)
    if 100 * min(n, m) < percent * max(n, m):
        return False
    p, q = n - (n * percent + 99) // 100 + 1, m - (m * percent + 99) // 100 + 1
    orders = [(a[n - p :], b[m - q :])]
    for pivot in _ROTATIONS:
        start = np.int64(pivot - (1 << 63))
        orders.append((_from(a, start, p), _from(b, start, q)))
    if not all(np.isin(x, y, assume_unique=True).any() for x, y in orders):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (n + m - both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar. Only the side with one row per pair is large; its hot ends can be split."""

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_similar(x, y, percent) for x, y in zip(a, b)], dtype="bool")

    first = sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a"))
    second = sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b"))
    met = pairs.join(first, "a").join(second, "b")
    return met.where(similar("of_a", "of_b")).select("a", "b").distinct()


def _leaders(shared: DataFrame, number: int) -> DataFrame:
    """For every token and size band edges from one leader to the nodes of other components.

    A leader is a node whose prefix is widely shared: in a group of edited copies the least edited one, which most of the
    others are similar to. The choice is loosened by hash, more in each of ``LEADERS`` classes of tokens and in each round,
    so a node meets several of a group. Only pairs that enough tokens lead to are taken. This finds components early;
    what is left out here is found by the later orders.
    """
    kind = F.pmod("token", F.lit(LEADERS))
    chance = F.pmod(F.xxhash64("node", kind, F.lit(number)), F.lit(1 << 20)) / (1 << 20)
    place = -F.col("weight") * (1 - chance * F.least(F.lit(1.0), (kind + 2 * number) / (2 * LEADERS)))
    first = F.min(F.struct(place.alias("place"), "node", "component")).alias("first")
    ends = shared.groupBy("token", "band").agg(first)
    met = shared.join(ends, ["token", "band"]).where("component != first.component")
    counted = met.groupBy(F.col("first.node").alias("a"), F.col("node").alias("b")).agg(
        F.count(F.lit(1)).alias("tokens"), F.first("n").alias("n")
    )
    strong = counted.where(F.col("tokens") * (8 * LEADERS) >= F.col("n"))
    return strong.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _weighed(shared: DataFrame) -> DataFrame:
    """``shared`` with the weight of its nodes: how widely the tokens of a node's prefix are held, for its size."""
    held = shared.groupBy("token").agg(F.log(F.count(F.lit(1))).alias("held"))
    weights = shared.join(held, "token").groupBy("node").agg((F.sum("held") / F.first("n")).alias("weight"))
    return shared.join(weights, "node")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with their node's component, the node itself where it has no links."""
    if labels is None:
        return rows.withColumn("component", F.col("node"))
    met = rows.join(labels.select("node", F.col("component").alias("known")), "node", "left")
    return met.withColumn("component", F.coalesce("known", "node")).drop("known")


def _in_play(rows: DataFrame, needed: Column) -> DataFrame:
    """Rows of tokens that several components hold, of nodes that have enough such tokens."""
    rows = rows.select("token", "node", "n", "component")
    ends = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    met = rows.join(ends.where("low < high").select("token"), "token")
    enough = met.groupBy("node", "n").agg(F.countDistinct("token").alias("tokens")).where(F.col("tokens") >= needed)
    return met.join(enough.select("node", "n"), ["node", "n"])


def jaccard_components(docs: DataFrame, *, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Texts without words have an empty set and are linked with nothing. Rows without a doc_id take part; their component
    is NULL unless it holds an id. Rows that share a doc_id keep their own texts and components. Other columns are not
    read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = stored(_sizes(texts, words))
    classes = made.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"))
    total = made.agg(F.sum("n")).first()[0] or 0
    buckets = max(256, total * (100 - percent + 5) // 100 // 500_000)
    found = stored(_shared_tokens(texts, words, percent, buckets))
    # the smallest partner a set can have decides how many shared prefix tokens it needs
    needed = 1 + F.floor(_most("n", percent) / 20)
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / percent)))
    tokens_of = found.groupBy("node").agg(F.countDistinct("token").alias("t"))
    enough = stored(tokens_of.join(classes, "node").where(F.col("t") >= needed).select("node", "least", "n"))
    shared = stored(found.join(enough.select("node", "n", band.alias("band")), "node").distinct())
    shared = stored(_weighed(shared))

    # whole sets of the texts in play
    ids = enough.select(F.col("least").alias("id"))
    if enough.count() <= BROADCAST_IDS:  # else both sides are shuffled
        ids = F.broadcast(ids)
    kept = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = stored(_sets(kept, words).where("n > 0"))

    labels = None
    for number in range(ROUNDS):
        links = stored(_verified(_leaders(_labelled(shared, labels), number), sets, percent))
        if links.isEmpty():
            break
        known = [] if labels is None else [labels.select(F.col("node").alias("a"), F.col("component").alias("b"))]
        labels = components(reduce(DataFrame.union, known, links), "a", "b")

    # texts that may still be similar to one of another component
    open_ = stored(_in_play(_labelled(shared.select("token", "node", "n"), labels), needed))
    open_nodes = open_.select("node", "component").distinct()
    known_sets = sets.join(open_nodes, "node")
    last = F.least(F.col("n") - _most("n", percent) + 1 + F.floor(F.col("n") / 10), F.col("n")).cast("int")
    ends = known_sets.select("node", "n", "component", F.explode(F.slice("tokens", -last, last)).alias("token"))
    needed = 1 + F.floor(_most("n", percent) / 10)
    open_nodes = _in_play(ends, needed).select("node").distinct()
    tokens = known_sets.join(open_nodes, "node").select("node", "n", "component", F.explode("tokens").alias("token"))
    tokens = stored(_in_play(stored(tokens), _most("n", percent)))
    counts = tokens.groupBy("token").agg(F.countDistinct("component").alias("held"))
    # of n tokens all but the ones counted here are held by one component only and come first in this order
    ranked = tokens.join(counts, "token").groupBy("node", "n", "component").agg(
        F.sort_array(F.collect_set(F.struct("held", "token"))).alias("ordered")
    )
    length = F.col("n") - _most("n", percent) + 1 - (F.col("n") - F.size("ordered"))
    prefix = stored(
        ranked.where(length > 0)
        .select("node", "n", "component", F.size("ordered").alias("listed"), F.posexplode(F.slice("ordered", 1, length.cast("int"))))
        # tokens from this one on, in the order of all n
        .select("node", "n", "component", (F.col("listed") - F.col("pos")).alias("left"), F.col("col.token").alias("token"))
    )
    other = prefix.select("token", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "component", "left")))
    pairs = (
        prefix.join(other, "token")
        .where("node < node_b and component != component_b")
        .where(F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent)
        # the first common token of a similar pair leaves room for the overlap it needs
        .where(F.least("left", "left_b") * (100 + percent) >= (F.col("n") + F.col("n_b")) * percent)
        .select(F.col("node").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )
    more = stored(_verified(pairs, sets, percent))
    if labels is not None:
        more = more.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
    labels = components(more, "a", "b")

    classed = stored(_labelled(classes.select("node", "least"), labels))
    least = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classed.join(least, "component").select("node", "component_id")
    return made.join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are the first of their component. Of rows with one doc_id all stay or go."""
    found = jaccard_components(docs, **settings).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
