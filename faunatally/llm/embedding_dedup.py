"""Near-duplicate vectors by sorted projection passes.

In each pass vectors are ordered by a key of concatenated random hyperplane bits, compared with a bounded window of
neighbours in that order, and the verified pairs of all passes are united into components. Vectors with equal values are one
class from the start. A window only has to connect a component, not to meet all its pairs: links are then counted within each
component. Vectors within half the threshold's angle of the component's mean direction are all linked with one
another, by the triangle inequality, so they are counted without being compared; the others are compared with the whole component,
block by block.

Vectors that are NULL, zero, or hold NULL or non-finite components link with nothing. Only vectors of one length are compared.
Rows without a vec_id take part; NULL is then no candidate for a component's smallest id. Repeated rows are vectors of their
own. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faunatally.llm.components import components
from faunatally.llm.stored import stored

COSINE = 0.9
PASSES = 16
KEY_BITS = 48
WINDOW = 64
BLOCK = 512


def _unit(values) -> np.ndarray | None:
    if values is None:
        return None
    try:
        vector = np.asarray(values, dtype=np.float64)
    except (TypeError, ValueError):
        return None
    if not len(vector) or not np.isfinite(vector).all():
        return None
    vector = vector / (np.abs(vector).max() or 1.0)
    length = np.linalg.norm(vector)
    return vector / length if length > 0 else None


def _planes(dims: int, number: int) -> np.ndarray:
    return np.random.default_rng([dims, number]).standard_normal((dims, KEY_BITS))


def _named(rows: DataFrame) -> DataFrame:
    """(vec_id, node, unit): node names the vector's value, NULL for those that link with nothing."""

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = [_unit(v) for v in batch["embedding"]]
            nodes = [
                None if u is None else int.from_bytes(blake2b(u.tobytes(), digest_size=8).digest(), "little") >> 1
                for u in units
            ]
            out = pd.DataFrame({"node": pd.array(nodes, dtype="Int64"), "unit": units})
            out.insert(0, "vec_id", batch["vec_id"].to_numpy())
            yield out

    return rows.mapInPandas(named, "vec_id long, node long, unit array<double>")


class _Forest:
    """Union-find over the nodes of one pass in one task; says whether a link joins two trees."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        while (above := parent.get(node, node)) != node:
            parent[node] = parent.get(above, above)
            node = above
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _edges(classes: DataFrame, cosine: float, passes: int, window: int) -> DataFrame:
    """Verified pairs (a, b) of all passes, a spanning forest for each part of a pass."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = np.left_shift(np.int64(1), np.arange(KEY_BITS, dtype=np.int64))[::-1]
        for batch in batches:
            dims = batch["unit"].map(len)
            for size, part in batch.groupby(dims):
                matrix = np.stack(part["unit"].to_numpy())
                for number in range(passes):
                    key = (matrix @ _planes(size, number) > 0) @ weights
                    # few rows at a time, as every vector is repeated for each pass
                    for at in range(0, len(part), 1024):
                        some = slice(at, at + 1024)
                        yield pd.DataFrame(
                            {"dims": size, "pass": number, "key": key[some], "node": part["node"].to_numpy()[some], "unit": list(part["unit"].to_numpy()[some])}
                        )

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, forest, nodes, matrix = None, _Forest(), np.zeros(0, np.int64), None
        for batch in batches:
            found = []
            for (size, number), rows in batch.groupby(["dims", "pass"], sort=False):
                if (size, number) != part:
                    part, forest, nodes, matrix = (size, number), _Forest(), np.zeros(0, np.int64), np.zeros((0, size))
                held = len(nodes)
                nodes = np.concatenate([nodes, rows["node"].to_numpy()])
                matrix = np.concatenate([matrix, np.stack(rows["unit"].to_numpy())])
                for at in range(0, len(nodes), window):
                    # rows at .. at + window against themselves and the window after them
                    here, there = matrix[at : at + window], matrix[at : at + 2 * window]
                    if at + len(there) <= held:
                        continue
                    i, j = np.nonzero(here @ there.T >= cosine)
                    near = (j > i) & (j - i <= window) & (at + j >= held)
                    for a, b in zip(nodes[at + i[near]].tolist(), nodes[at + j[near]].tolist()):
                        if a != b and forest.join(a, b):
                            found.append((a, b))
                nodes, matrix = nodes[-window:], matrix[-window:]
            yield pd.DataFrame(found, columns=["a", "b"])

    rows = classes.select("node", "unit").mapInPandas(
        keyed, "dims int, pass int, key long, node long, unit array<double>"
    )
    order = ["dims", "pass", "key", "node"]
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ranged.mapInPandas(compared, "a long, b long")


def _links_within(members: DataFrame, cosine: float) -> DataFrame:
    """(node, links): vectors of other classes linked to each class. ``members``: component, node, copies, unit."""
    half = math.acos(cosine) / 2 - 1e-6

    @F.pandas_udf("boolean")
    def central(unit: pd.Series, mean: pd.Series) -> pd.Series:
        def near(u, m) -> bool:
            size = np.linalg.norm(m)
            return bool(size > 0 and np.dot(u, m) / size >= math.cos(half))

        return pd.Series([near(u, m) for u, m in zip(unit, mean)], dtype="bool")

    sums = members.select("component", F.posexplode("unit")).groupBy("component", "pos").agg(F.sum("col").alias("sum"))
    means = sums.groupBy("component").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "sum"))), lambda x: x["sum"]).alias("mean")
    )
    judged = stored(members.join(means, "component").withColumn("core", central("unit", "mean")).drop("mean"))
    totals = judged.groupBy("component").agg(F.sum(F.when(F.col("core"), F.col("copies"))).alias("core_copies"))
    certain = judged.where("core").join(totals, "component").select(
        "node", (F.col("core_copies") - F.col("copies")).alias("links")
    )

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        """Blocks of about ``BLOCK`` members of a component."""
        sizes = rows.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        dealt = rows.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        return dealt.groupBy("component", "block").agg(
            F.collect_list(F.struct("node", "copies", "core", "unit")).alias(name)
        ).drop("block")

    @F.pandas_udf("array<struct<node: bigint, links: bigint>>")
    def met(outer: pd.Series, every: pd.Series) -> pd.Series:
        def count(xs, ys) -> list[dict]:
            a, b = np.stack([x["unit"] for x in xs]), np.stack([y["unit"] for y in ys])
            names, others = np.array([x["node"] for x in xs]), np.array([y["node"] for y in ys])
            linked = (a @ b.T >= cosine) & (names[:, None] != others[None, :])
            mine = linked @ np.array([y["copies"] for y in ys])
            theirs = linked.T @ np.array([x["copies"] for x in xs])
            out = [{"node": int(n), "links": int(c)} for n, c in zip(names, mine) if c]
            return out + [{"node": int(n), "links": int(c)} for n, c, y in zip(others, theirs, ys) if c and y["core"]]

        return pd.Series([count(x, y) for x, y in zip(outer, every)])

    # only components with members off the centre are compared
    loose = judged.where(~F.col("core"))
    around = judged.join(loose.select("component").distinct(), "component")
    pairs = blocks(loose, "outer").join(blocks(around, "every"), "component")
    counted = pairs.select(F.explode(met("outer", "every")).alias("m")).select("m.node", "m.links")
    return certain.union(counted).groupBy("node").agg(F.sum("links").alias("links"))


def linked_vectors(
    rows: DataFrame, *, cosine: float = COSINE, passes: int = PASSES, window: int = WINDOW
) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    named = stored(_named(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")))
    classes = (
        named.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit"))
    )
    classes = stored(classes)
    labels = components(stored(_edges(classes, cosine, passes, window)), "a", "b")
    members = stored(classes.join(labels, "node"))
    links = _links_within(members.select("component", "node", "copies", "unit"), cosine)
    least = members.groupBy("component").agg(F.min("least").alias("least_id"))
    found = (
        classes.select("node", "copies", "least")
        .join(members.select("node", "component"), "node", "left")
        .join(least, "component", "left")
        .join(links, "node", "left")
        .select(
            "node",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least_id", "least").alias("component_id"),
        )
    )
    out = named.drop("unit").join(found, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
