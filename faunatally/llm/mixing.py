"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

A mixture is a schedule of slots of equal length in words. Slot ``k`` goes to the source in whose share of the
cumulative weights the golden-ratio point ``frac((k + 1/2) / phi)`` falls, so every stretch of the schedule holds each
source close to its weight. A source's documents are shuffled by hash and cut into blocks of the slot length; its
``r``-th slot takes its ``r``-th block, starting again after the last. Words are counted, not drawn: the
same input gives the same mixture.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faunatally.llm.stored import stored

WEIGHTS = (5.0, 2.0, 1.0)
PERCENT = 150
REPEATS = 2
SLOTS = 1 << 18
BUCKET_DIGITS = 3
_GOLDEN = 0.6180339887498949


def size_in_words(text: Column | str) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    percent: int = PERCENT,
    repeats: int = REPEATS,
) -> DataFrame:
    """(source, weight, source_size, target) of a table (source, size).

    Sources in code-point order, NULL last, take the weights in turn. Together they get ``percent`` of all words, each at most
    ``repeats`` times its own; what a full source leaves is shared by weight among the others. That is one level
    at which ``min(cap, level * weight)`` adds up, found by taking sources in the order in which they fill up. The table
    has a row per source, a list that a mixture's author writes weights for.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    order = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    listed = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
    )
    wanted = F.sum("source_size").over(Window.partitionBy()) * F.lit(percent) / F.lit(100.0)
    shared = (
        listed.withColumn("left", wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(after))
        .withColumn("full", F.col("level") >= F.col("fills_at"))
    )
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy())
    target = F.when(F.col("full") | level.isNull(), F.col("cap")).otherwise(level * F.col("weight"))
    return shared.select("source", "place", "weight", "source_size", target.alias("target"))


def slot_words(targets: DataFrame, slots: int) -> Column:
    """Words in a slot: the whole mixture fills at most ``slots`` of them."""
    return F.greatest(F.ceil(targets.agg(F.sum("target")).scalar() / slots), F.lit(1))


def schedule(targets: DataFrame, *, slots: int = SLOTS) -> DataFrame:
    """(slot, place, turn): the source of each slot by its place in ``targets``, and the slot's rank in its source."""
    running = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    ends = targets.withColumn("end", F.try_divide(F.sum("target").over(running), F.sum("target").over(Window.partitionBy())))
    # one row: the ends of all sources, as many as the author's list has
    bounds = ends.agg(F.sort_array(F.collect_list("end")).alias("ends"))
    point = (F.col("id") + 0.5) * F.lit(_GOLDEN)
    points = targets.sparkSession.range(slots).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("point"))
    used = F.col("slot") * slot_words(targets, slots) < targets.agg(F.sum("target")).scalar()
    placed = points.where(used).withColumn("ends", bounds.scalar()).select(
        "slot", F.least(F.size(F.filter("ends", lambda e: e <= F.col("point"))), F.size("ends") - 1).alias("place")
    )
    return placed.withColumn("turn", F.row_number().over(Window.partitionBy("place").orderBy("slot")) - 1)


def _group(source: Column | str) -> Column:
    """A source as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _placed(docs: DataFrame, targets: DataFrame, at: str) -> DataFrame:
    """``docs`` with a struct ``at``: size, place, source_size, target, and first, the words before the row in its source.

    A source's order is that of an MD5 key of id and text, summed in two levels: the source is cut into buckets by the
    first digits of the key, so that no task holds a whole source.
    """
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.coalesce("text", F.lit(""))))
    size = size_in_words("text").alias("size")
    rows = docs.withColumn(at, F.struct(_group("source").alias("group"), key.alias("key"), size))
    bucket = F.substring(f"{at}.key", 1, BUCKET_DIGITS)
    rows = rows.withColumn(at, F.col(at).withField("bucket", bucket))
    group = [F.col(f"{at}.group"), F.col(f"{at}.bucket")]
    narrow = docs.select(_group("source").alias("g"), F.substring(key, 1, BUCKET_DIGITS).alias("b"), size)
    across = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        narrow.groupBy("g", "b").agg(F.sum("size").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(across), F.lit(0)))
        .join(targets.withColumn("g", _group("source")), "g")
        .select(
            F.struct(F.struct("g", "b").alias("of"), "before", "place", "source_size", "target").alias(f"{at}_bucket")
        )
    )
    earlier = Window.partitionBy(*group).orderBy(f"{at}.key", f"{at}.size").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(f"{at}.size").over(earlier), F.lit(0))
    summed = rows.withColumn(at, F.col(at).withField("inner", inner))
    of = F.col(f"{at}_bucket.of")
    met = summed.join(buckets, (group[0] == of["g"]) & (group[1] == of["b"]))
    fields = F.struct(
        f"{at}.size",
        f"{at}_bucket.place",
        f"{at}_bucket.source_size",
        f"{at}_bucket.target",
        (F.col(f"{at}.inner") + F.col(f"{at}_bucket.before")).alias("first"),
    )
    return met.withColumn(at, fields).drop(f"{at}_bucket")


def _free(df: DataFrame, *names: str) -> list[str]:
    """Column names that the table does not have, whatever the case."""
    taken = " ".join(df.columns).lower()
    end = ""
    while any(f"{n}{end}" in taken for n in names):
        end += "_"
    return [n + end for n in names]


def mixture(docs: DataFrame, *, slots: int = SLOTS, repeats: int = REPEATS, **shares) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text, source, ...) in the mixture, as ``docs`` with a struct ``mixed``.

    ``mixed`` holds size, place, source_size, target, first (words before the document in its source), block, words (of the
    document in that block), leading (it begins in that block) and slots (those that take the block, at most ``repeats``). A document has one row for each block
    it reaches into, with no slots where the schedule leaves the block out. Documents without words have one row
    without a block. NULL is a source like any other. A table without rows gives none. A name ``mixed`` in use gets
    underscores.
    """
    (at,) = _free(docs, "mixed")
    sizes = stored(docs.groupBy("source").agg(F.sum(size_in_words("text")).alias("size")))
    targets = stored(source_targets(sizes, repeats=repeats, **shares))
    length = slot_words(targets, slots)
    placed = _placed(docs, targets, at)
    end = F.col(f"{at}.first") + F.col(f"{at}.size")
    reach = F.when(
        F.col(f"{at}.size") > 0,
        F.sequence(F.floor(F.col(f"{at}.first") / length), F.floor((end - 1) / length)),
    )
    block = F.col(f"{at}_block")
    words = F.least(end, (block + 1) * length) - F.greatest(F.col(f"{at}.first"), block * length)
    pieces = placed.withColumn(f"{at}_block", F.explode_outer(reach)).withColumn(
        at,
        F.col(at)
        .withField("block", block)
        .withField("leading", block * length <= F.col(f"{at}.first"))
        .withField("words", F.coalesce(words, F.lit(0))),
    )
    blocks = F.ceil(F.col("source_size") / length)
    taken = (
        schedule(targets, slots=slots).join(targets.select("place", "source_size"), "place")
        .where(F.col("turn") < blocks * repeats)
        .groupBy("place", (F.col("turn") % blocks).alias("block"))
        .agg(F.sort_array(F.collect_list("slot")).alias("slots"))
        .select(F.struct("place", "block", "slots").alias(f"{at}_taken"))
    )
    of = F.col(f"{at}_taken")
    met = pieces.join(taken, (F.col(f"{at}.place") == of["place"]) & (block == of["block"]), "left")
    slots_ = F.coalesce(of["slots"], F.array().cast("array<bigint>"))
    return met.withColumn(at, F.col(at).withField("slots", slots_)).drop(f"{at}_block", f"{at}_taken")


def taken_words(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, size, source_size, target of its source, taken (words in the mixture, with repeats)."""
    mixed = mixture(docs.select("doc_id", "source", "text"), **settings).select("doc_id", "mixed.*")
    words = F.col("words") * F.size("slots")
    key = ["doc_id", "size", "source_size", "target"]
    # place and first tell documents with words apart, even repeated rows
    some = mixed.where("size > 0").groupBy("place", "first", *key).agg(F.sum(words).alias("taken"))
    none = mixed.where("size = 0").select(*key, F.lit(0).cast("long").alias("taken"))
    return some.select(*key, "taken").union(none)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """Whole documents as often as the mixture takes them: once for each slot of the block that holds their first word."""
    (at,) = _free(docs, "mixed")
    mixed = mixture(docs, **settings).where(F.col(f"{at}.leading"))
    return mixed.withColumn(at, F.explode(f"{at}.slots")).select(*docs.columns)
