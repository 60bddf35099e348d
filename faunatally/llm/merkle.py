"""Merkle manifest of a dataset: one hash tree per group of rows, one over the groups, and a proof for every row.

A row's leaf is the hash of its fields, each written with its length. In a tree every eight consecutive nodes of a level
become the hash of their hex digests, until one node remains; a lone leaf is its own root. The trees of the groups give
subroots, and a tree over these gives the root.

Proofs come from pointer jumping. A node starts with a segment, the hashes of its run's other nodes, and a pointer to its
parent. Each round joins the nodes to themselves: a node takes over its ancestor's pointer, twice as far from it, and appends
the ancestor's segment. After as many rounds as the logarithm of the depth every leaf's segment reaches its subroot. Only
nodes that a later round asks for are carried, so a round costs the leaves and an eighth of them.

Defined cases: a NULL field is written ``-``; NULL groups are a group of their own, first in order; rows of a group go by the
given order with NULL first, equal ids by leaf, and rows equal in every field are interchangeable. Further columns of any
name are not read. An empty table has no nodes and no proofs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faunatally.llm.stored import stored
from faunatally.operators.keyed_join import null_safe_join
from faunatally.operators.numbering import number_sorted

BITS = 3
RUN = 1 << BITS
HEX = 64
#: Ancestors are broadcast up to this size. Beyond, a join by shuffle has no hot key: a node has 8^distance rows below it.
BROADCAST_BYTES = 4 << 20


def field(value: Column) -> Column:
    """A field as hash input: its UTF-8 byte count, a colon and the value; ``-`` for NULL. Numbers are decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Hex digest of a row's fields, in the given order."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def _above(n: Column, level: int) -> Column:
    """Number of nodes of a level over n leaves."""
    return F.shiftright(n + (RUN**level - 1), BITS * level)


def depth(leaves: int) -> int:
    """Levels between a leaf and the root of its tree."""
    found = 0
    while leaves > 1:
        leaves = -(-leaves // RUN)
        found += 1
    return found


def _runs(nodes: DataFrame, group: str) -> DataFrame:
    """Nodes of one level brought together by run, in order. A run has eight nodes at most."""
    each = F.struct("pos", *[c for c in nodes.columns if c not in (group, "n", "pos")])
    return (
        nodes.groupBy(group, "n", F.shiftright("pos", BITS).alias("up"))
        .agg(F.array_sort(F.collect_list(each)).alias("run"))
        .withColumn("joined", F.concat(*[F.coalesce(F.get("run", F.lit(k))["hash"], F.lit(b"")) for k in range(RUN)]))
    )


def _parents(runs: DataFrame, group: str) -> DataFrame:
    raw = F.unhex(F.sha2(_hex(F.col("joined")), 256))
    return runs.select(group, F.col("up").alias("pos"), raw.alias("hash"), _above(F.col("n"), 1).alias("n"))


def _children(runs: DataFrame, group: str) -> DataFrame:
    """Each node with its first segment: the others of its run, left to right."""
    each = runs.select(group, "n", "joined", F.posexplode("run").alias("slot", "node")).select(group, "n", "joined", "slot", "node.*")
    before = F.substring("joined", F.lit(1), F.col("slot") * 32)
    after = F.substring("joined", F.col("slot") * 32 + 33, F.octet_length("joined"))
    return each.withColumn("segment", F.concat(before, after)).drop("joined", "slot")


def _fits(rows: int, spread: int) -> bool:
    """Are so many nodes, with segments over ``spread`` levels, small enough to broadcast?"""
    return rows * (spread * (RUN - 1) * 32 + 100) <= BROADCAST_BYTES


def tree(leaves: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """(proofs, roots) of the trees over ``leaves``: columns ``group``, ``pos`` (place from 0), ``hash`` (raw) and others.

    Proofs have every leaf with its columns, ``n``, the leaves of its tree, and ``segment``, the raw hashes of the
    siblings from its own level up to the root's children. Roots have ``group`` and ``hash``.
    """
    sizes = leaves.groupBy(group).agg((F.max("pos") + 1).alias("n"))
    placed = stored(null_safe_join(leaves, sizes, [group]))
    total = placed.select(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).first()
    height = depth(total["n"] or 1)
    level, levels, roots = placed, [], []
    for _ in range(height):
        roots.append(level.where("n = 1").select(group, "hash"))
        runs = _runs(level.where("n > 1"), group)
        levels.append(stored(_children(runs, group).drop(*([] if not levels else ["hash"]))))
        level = stored(_parents(runs, group))
    roots.append(level.where("n = 1").select(group, "hash"))
    single = placed.where("n = 1").withColumn("segment", F.lit(b""))
    if not levels:
        return single, reduce(DataFrame.unionAll, roots)
    # pointer jumping: ``levels[k]`` holds segments over ``span`` levels for the levels that are still asked for
    span, rows = 1, total["rows"]
    while span < height:
        for k in range(0, height - span, 2 * span):
            levels[k] = _jump(levels[k], levels[k + span], span, group, _fits(rows // RUN ** (k + span) + 1, span))
            if k or 2 * span < height:
                levels[k] = stored(levels[k])
        span *= 2
    return levels[0].unionByName(single), reduce(DataFrame.unionAll, roots)


def _jump(nodes: DataFrame, ancestors: DataFrame, span: int, group: str, small: bool) -> DataFrame:
    """Append the segment of the ancestor ``span`` levels up. Nodes whose root is nearer than that stay as they are."""
    up = ancestors.select(group, F.col("pos").alias("up"), F.col("segment").alias("__further"))
    up = F.broadcast(up) if small else up
    met = null_safe_join(nodes.withColumn("up", F.shiftright("pos", BITS * span)), up, [group, "up"])
    return met.withColumn("segment", F.concat("segment", F.coalesce("__further", F.lit(b"")))).drop("up", "__further")


def fold(leaf: Column, proof: Column, pos: Column, n: Column) -> Column:
    """The root recomputed from a leaf (hex), the siblings of its proof (hex), its place and its tree's number of leaves."""

    def step(state: Column, level: Column) -> Column:
        place = F.call_function("shiftright", pos, level * BITS)
        width = F.call_function("shiftright", n + F.pow(F.lit(float(RUN)), level).cast("long") - 1, level * BITS)
        slot = place.bitwiseAND(RUN - 1)
        others = (F.least(F.lit(RUN).cast("long"), width - (place - slot)) - 1).cast("int")
        at = state["at"]
        before = F.substring(proof, at, (slot * HEX).cast("int"))
        after = F.substring(proof, (at + slot * HEX).cast("int"), ((others - slot) * HEX).cast("int"))
        return F.struct(F.sha2(F.concat(before, state["hash"], after), 256).alias("hash"), (at + others * HEX).alias("at"))

    # eight to the power of the height is the first to reach n
    height = F.when(n <= 1, 0).otherwise(F.ceil(F.log2(n.cast("double")) / BITS)).cast("int")
    levels = F.when(height > 0, F.sequence(F.lit(0), height - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(levels, F.struct(leaf.alias("hash"), F.lit(1).alias("at")), step)["hash"]


def manifest(rows: DataFrame, group: str, order: str, carry: Sequence[str] = ()) -> DataFrame:
    """Every leaf with its proof. ``rows`` has ``group``, ``order``, ``leaf`` (hex) and the columns to ``carry``.

    Adds ``subroot``, ``root`` and ``proof`` (hex: siblings level by level, through the subroot, to the root), and
    for ``refold``: ``pos``, ``n`` (place and leaves in the group's tree), ``group_pos``, ``groups``, ``group_proof``.
    """
    named = rows.select(group, order, F.unhex("leaf").alias("hash"), *carry)
    numbered = number_sorted(named, [order, "hash"], "pos", per=[group])
    proofs, subroots = tree(numbered, group)
    # one row per group from here on
    tops = number_sorted(stored(subroots), [group], "pos").withColumn("__all", F.lit(0))
    top_proofs, root = tree(tops, "__all")
    top = null_safe_join(top_proofs, root.select("__all", F.col("hash").alias("__root")), ["__all"]).select(
        group,
        F.col("hash").alias("__subroot"),
        F.col("pos").alias("group_pos"),
        F.col("n").alias("groups"),
        F.col("segment").alias("__top"),
        "__root",
    )
    met = null_safe_join(proofs, stored(top), [group])
    return met.select(
        group,
        order,
        _hex(F.col("hash")).alias("leaf"),
        *carry,
        "pos",
        "n",
        "group_pos",
        "groups",
        _hex(F.col("__top")).alias("group_proof"),
        _hex(F.concat("segment", "__top")).alias("proof"),
        _hex(F.col("__subroot")).alias("subroot"),
        _hex(F.col("__root")).alias("root"),
    )


def refold(leaf: Column) -> Column:
    """The dataset's root recomputed from a leaf (hex) and the proof beside it in a manifest."""
    return fold(fold(leaf, F.col("proof"), F.col("pos"), F.col("n")), F.col("group_proof"), F.col("group_pos"), F.col("groups"))
