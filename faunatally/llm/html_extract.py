"""Main text of web pages: markup rules out what it names, a host's suffix array finds the boilerplate that it does not.

Each page gives a stream of words (``page_parse``), the blocks that its markup does not rule out. Template text in that
stream, a notice or menu without a telling name, is what a host repeats on its pages:

1. The ``LEAST`` words from every word on are a window. Windows are counted per host over all its pages, equal streams as
   one page, so that copies of a page don't pass for a template, and are frequent if enough of the host's pages share them.
   Pages are dealt to packs of about ``PACK_BYTES`` bytes. A host that one pack holds is counted there. A window that a share of
   a larger host's pages has is had by that share of them in one of its packs at least: what reaches the share within a
   pack is a candidate, and only candidates are counted in all packs of their host. No window is left out by this.
2. Frequent windows at consecutive words are a run, all of it boilerplate. What may go on after its last window are words that
   fewer pages share. So the suffixes at the last windows are the host's sparse suffix array: range partitioned and sorted by
   host and words. The longest prefix that a suffix shares with two other pages is the longest it shares with those beside it,
   so neighbours in the order are compared; suffixes beside the edge of a partition are compared again with those across
   it. A suffix that starts earlier in the run reaches no further, as what it shares holds what the last one shares.
3. Words that runs and such prefixes cover are boilerplate. They are removed, unique runs stay, blocks left empty go.

An article that its markup marks is far likelier to repeat as a copy than as template, so ``ARTICLE_SHARE`` of the host's
pages must repeat a run before it is taken from one; elsewhere ``SHARE`` and at least ``LEAST_PAGES`` pages. A page that
would lose all its text is nothing but a copy and keeps it. Words are compared by hashes of 32 bits, eight at least in a row.

Defined cases: a NULL or empty page, or one without text, has the text ``''``; a NULL URL, or one without a host, belongs to
the host ``''``; repeated rows count as one page and give one row each; pages of any length are read whole; columns other
than page_id, url and html are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunatally.llm.page_parse import ARTICLE, Block, blocks
from faunatally.llm.stored import stored
from faunatally.operators.keyed_join import keyed_join

LEAST = 8
DEPTH = 64
LEAST_PAGES = 3
SHARE = 0.2
ARTICLE_PAGES = 8
ARTICLE_SHARE = 0.9
#: Bytes of the pages that one task compares at a time.
PACK_BYTES = 1 << 22
#: Pages at each edge of a partition whose suffixes are compared across it.
EDGE = 4
#: Lists of runs by page are broadcast up to this size.
BROADCAST_BYTES = 32 << 20
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url.strip()) if url else None
    return found[1].lower() if found else ""


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


class Page:
    """A page's blocks, their words as one stream, and the places where template text likely begins."""

    def __init__(self, url: str | None, html: str | None):
        self.blocks: list[Block] = blocks(html)
        self.words: list[str] = []
        starts: set[int] = set()
        for block in self.blocks:
            first = len(self.words)
            starts.update(first + e for e in block.edges if e < len(block.words))
            starts.update(range(first, first + len(block.words), DEPTH))
            self.words.extend(block.words)
        self.starts = sorted(s for s in starts if s + LEAST <= len(self.words))
        self.article = bool(self.blocks) and self.blocks[0].zone == ARTICLE
        self.host = _signed(xxhash.xxh64_intdigest(host_of(url)))
        self.content = _signed(xxhash.xxh64_intdigest("\0".join(self.words), seed=self.article))

    def window(self, start: int) -> int:
        """Hash of a suffix's host and first words."""
        return _signed(xxhash.xxh64_intdigest("\0".join(self.words[start : start + LEAST]), seed=self.host & 0xFFFFFFFF))

    def hashes(self, start: int = 0, end: int | None = None) -> list[int]:
        return [xxhash.xxh32_intdigest(w) - (1 << 31) for w in self.words[start:end]]

    def suffix(self, start: int) -> list[int]:
        return self.hashes(start, start + DEPTH)

    def text(self, covered: list[tuple[int, int]] = ()) -> str:
        """The blocks' words without the covered ones, whole if nothing would be left."""
        gone = np.zeros(len(self.words) + 1, dtype=np.int64)
        for start, length in covered:
            gone[start] += 1
            gone[min(start + length, len(self.words))] -= 1
        keep = (np.cumsum(gone)[:-1] == 0).tolist() if len(covered) else None
        if keep is None or not any(keep):
            return "\n\n".join(" ".join(b.words) for b in self.blocks)
        out, at = [], 0
        for block in self.blocks:
            left = [w for w, k in zip(block.words, keep[at : at + len(block.words)]) if k]
            at += len(block.words)
            if left:
                out.append(" ".join(left))
        return "\n\n".join(out)


def _identified(pages: DataFrame) -> DataFrame:
    """Rows with the same URL and HTML share an identity of 96 bits, made without reading the page as a page."""
    return pages.select("*", F.xxhash64("url", "html").alias("page"), F.hash("html", "url").alias("check"))


def _starts(pages: DataFrame) -> DataFrame:
    """(page, check, host, content, article, window, start) of each suffix, and a row with NULL window for the page itself."""
    schema = "page long, check int, host long, content long, article boolean, window long, start int"

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, check, url, html in zip(batch["page"], batch["check"], batch["url"], batch["html"]):
                page = Page(url, html)
                if page.words:
                    one = (name, check, page.host, page.content, page.article)
                    rows.append((*one, None, None))
                    rows += [(*one, page.window(s), s) for s in page.starts]
            if rows:
                made_of = pd.DataFrame(rows, columns=["page", "check", "host", "content", "article", "window", "start"])
                yield made_of.astype({"window": "Int64", "start": "Int32"})

    return pages.mapInPandas(made, schema)


def _frequent[C: (Column, np.ndarray)](n: C, pages: C, in_article: C, elsewhere: C) -> tuple[C, C]:
    """Is a window that ``n`` of the host's pages have template text in articles, and is it elsewhere?"""
    in_all = in_article & (n >= ARTICLE_PAGES) & (n >= ARTICLE_SHARE * pages)
    return in_all, elsewhere & (n >= LEAST_PAGES) & (n >= SHARE * pages)


def frequent_windows(starts: DataFrame) -> DataFrame:
    """(host, window, article): beginnings that enough of the host's pages share to be template there.

    Rows are made distinct and counted in two steps, so a host or a window with most of the rows is counted by many tasks.
    """
    seen = starts.select("host", "window", "article", "content").distinct()
    kinds = seen.groupBy("host", "window", "article").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(
        kinds.groupBy("host", "window").agg(
            F.sum("n").alias("n"),
            F.bool_or("article").alias("in_article"),
            F.bool_or(~F.col("article")).alias("elsewhere"),
        )
    )
    hosts = counts.where(F.col("window").isNull()).select("host", F.col("n").alias("pages"))
    shared = counts.where(F.col("window").isNotNull() & (F.col("n") >= LEAST_PAGES))
    met = keyed_join(shared, hosts, ["host"], "inner", spread_by=["window"])
    oks = _frequent(*map(F.col, ("n", "pages", "in_article", "elsewhere")))
    kinds = [F.struct(F.lit(a).alias("article"), ok.alias("ok")) for a, ok in zip((True, False), oks)]
    return met.select("host", "window", F.inline(F.array(*kinds))).where("ok").drop("ok")


def _with_lists(pages: DataFrame, rows: DataFrame, values: list[str], how: str) -> DataFrame:
    """Pages with a column ``found``, the list of their rows in a table by (page, check): no longer than the page."""
    keys = ["page", "check"]
    lists = stored(rows.groupBy(*keys).agg(F.collect_list(F.struct(*values)).alias("found")))
    size = lists.agg(F.sum(F.size("found") * 16 + 40)).first()[0] or 0
    small = size <= BROADCAST_BYTES
    # only where the lists are too large to broadcast are the pages' keys counted, for hot ones to be split
    return keyed_join(pages, lists, keys, how, small=small, spread_by=["page_id"])


def _suffixes(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """(host, words, content, page, check, start) of the given suffixes."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, check, url, html, found in zip(*(batch[c] for c in ("page", "check", "url", "html", "found"))):
                page = Page(url, html)
                rows += [(page.host, page.suffix(f["start"]), page.content, name, check, f["start"]) for f in found]
            if rows:
                yield pd.DataFrame(rows, columns=["host", "words", "content", "page", "check", "start"])

    chosen = _with_lists(pages, starts, ["start"], "inner").select("page", "check", "url", "html", "found")
    return chosen.mapInPandas(made, "host long, words array<int>, content long, page long, check int, start int")


def shared_lengths(rows: list[tuple[int, int, list[int]]]) -> list[int]:
    """For each suffix (host, content, words) of a sorted list: the longest prefix it shares with two other pages, 0 if none
    is as long as ``LEAST``."""
    beside = [0] * (len(rows) + 1)
    for k in range(1, len(rows)):
        (host, _, a), (other, _, b) = rows[k - 1], rows[k]
        if host == other:
            same = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            beside[k] = same
    out = []
    for k, (_, content, words) in enumerate(rows):
        # walk to the nearer neighbour in length until two other pages are met
        up, down, met, length = k, k + 1, {content}, len(words)
        while len(met) < LEAST_PAGES and length >= LEAST:
            if beside[up] >= beside[down]:
                length = min(length, beside[up])
                up -= 1
                if length >= LEAST:
                    met.add(rows[up][1])
            else:
                length = min(length, beside[down])
                if length >= LEAST:
                    met.add(rows[down][1])
                down += 1
        out.append(length if length >= LEAST else 0)
    return out


def covered_runs(pages: DataFrame) -> DataFrame | None:
    """(page, check, start, length): what the suffixes at the pages' own ``starts`` share; None if there is nothing.

    Only those places are looked at, by far fewer than there are words. ``template_runs`` looks at all of them.
    """
    starts = stored(_starts(pages))
    frequent = stored(frequent_windows(starts))
    if frequent.isEmpty():
        return None
    chosen = keyed_join(starts, frequent, ["host", "window", "article"], "left_semi", spread_by=["page"])
    # rows that are equal but for their page_id have the same suffixes, once is enough
    array = stored(_suffixes(pages, chosen.select("page", "check", "start").distinct()).distinct())
    return shared_prefixes(array, ["page", "check", "start"]).where(F.col("length") >= LEAST)


def shared_prefixes(array: DataFrame, names: list[str]) -> DataFrame:
    """(names, length): of each suffix (host, words, content and its names) the longest prefix that two other pages share, 0 if none
    is as long as ``LEAST``."""
    order = list(dict.fromkeys(["host", "words", "content", *names]))
    laid = array.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    laid = laid.withColumn("at", F.monotonically_increasing_id())
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in laid.schema.fields)
    measured = stored(laid.mapInPandas(_within_partitions, f"{kinds}, length int, edge boolean"))
    # a few rows of each partition's two ends: as many as there are tasks, not as there are pages
    ends = measured.where("edge").drop("length", "edge").coalesce(1).sortWithinPartitions("at")
    across = ends.mapInPandas(_across_partitions, f"{kinds}, length int")
    return measured.drop("edge").unionAll(across).groupBy(*names).agg(F.max("length").alias("length"))


_STREAM = "host long, content long, article boolean, words array<int>"
_PACK = "of long, part long, host array<long>, content array<long>, article array<boolean>, n_words array<int>, words array<int>"
_COUNTS = "host long, window long, n long, in_article boolean, elsewhere boolean"
_ENDS = "host long, words array<int>, content long, first int, start int"
_FOUND = f"{_ENDS}, window long, n long, often boolean, elsewhere boolean"


@F.pandas_udf(T.LongType())
def _host_hash(url: pd.Series) -> pd.Series:
    return url.map(lambda u: _signed(xxhash.xxh64_intdigest(host_of(u)))).astype("int64")


def _streams(pages: DataFrame) -> DataFrame:
    """(host, content, article, words) of each page with words, copies within a task once; words are hashes."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            rows = []
            for url, html in zip(batch["url"], batch["html"]):
                page = Page(url, html)
                same = (page.host, page.content)
                if page.words and same not in seen:
                    seen.add(same)
                    rows.append((*same, page.article, page.hashes()))
            if rows:
                yield pd.DataFrame(rows, columns=["host", "content", "article", "words"])

    return pages.select("url", "html").mapInPandas(made, _STREAM)


def _contents(pages: DataFrame) -> DataFrame:
    """(page, check, host, content): what each page's stream is known by."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made_of = [Page(url, html) for url, html in zip(batch["url"], batch["html"])]
            keys = {"host": [p.host for p in made_of], "content": [p.content for p in made_of]}
            yield batch[["page", "check"]].assign(**keys)

    return pages.select("page", "check", "url", "html").mapInPandas(made, "page long, check int, host long, content long").distinct()


def _large_hosts(pages: DataFrame) -> tuple[DataFrame, int]:
    """(host, parts) of hosts too large for a pack, and the number of packs for all the others."""
    same = pages.select(_host_hash("url").alias("host"), F.xxhash64("html").alias("same"), F.octet_length("html").alias("n_bytes"))
    once = same.groupBy("host", "same").agg(F.max("n_bytes").cast("long").alias("n_bytes"))
    sizes = stored(once.groupBy("host").agg(F.sum("n_bytes").alias("n_bytes")))
    total = sizes.agg(F.sum("n_bytes")).first()[0] or 0
    parts = F.ceil(F.col("n_bytes") / PACK_BYTES).alias("parts")
    # fewer than one for each PACK_BYTES bytes there are, so they may be broadcast
    return sizes.where(F.col("n_bytes") > PACK_BYTES).select("host", parts), math.ceil(total / PACK_BYTES) or 1


def _in_packs(pages: DataFrame, large: DataFrame, packs: int) -> GroupedData:
    """Streams by packs: hosts up to ``PACK_BYTES`` whole, several in a pack; larger ones in parts by their pages."""
    whole = F.col("parts").isNull()
    part = F.when(whole, F.pmod("host", F.lit(packs))).otherwise(F.pmod("content", "parts"))
    laid = _streams(pages).join(F.broadcast(large), "host", "left")
    of = F.when(~whole, F.col("host")).alias("of")
    return laid.select(of, part.alias("part"), "host", "content", "article", "words").groupBy("of", "part")


def _packed(rows: pd.DataFrame) -> dict[str, object]:
    rows = rows.drop_duplicates(["host", "content"])
    one = {c: rows[c].iat[0] for c in ("of", "part")} | {c: rows[c].to_numpy() for c in ("host", "content", "article")}
    return one | {"n_words": rows["words"].map(len).to_numpy(), "words": np.concatenate(rows["words"].to_numpy())}


class Pack:
    """The pages of a pack, and the windows at all their words."""

    def __init__(self, pages: Mapping[str, object]):
        self.host, self.content, self.article = (np.asarray(pages[c]) for c in ("host", "content", "article"))
        self.words = np.asarray(pages["words"], dtype=np.int32)
        lengths = np.asarray(pages["n_words"], dtype=np.int64)
        self.end = np.cumsum(lengths)
        self.begin = self.end - lengths
        page, at = np.repeat(np.arange(len(lengths)), lengths), np.arange(len(self.words))
        full = at + LEAST <= self.end[page]
        self.page, self.at = page[full], at[full]
        self.window = _windows(self.words, self.at) + self.host[self.page] * np.int64(-7046029254386353131)

    def counts(self) -> pd.DataFrame:
        """(host, window, n, in_article, elsewhere): how many pages have a window, and of which kind."""
        order = np.lexsort((self.page, self.window))
        window, page = self.window[order], self.page[order]
        once = np.ones(len(window), dtype=bool)
        once[1:] = (window[1:] != window[:-1]) | (page[1:] != page[:-1])
        window, page = window[once], page[once]
        first = np.flatnonzero(np.append(True, window[1:] != window[:-1])) if len(window) else np.zeros(0, dtype=np.int64)
        n = np.diff(np.append(first, len(window)))
        inside = np.add.reduceat(self.article[page].astype(np.int64), first) if len(first) else n
        made = {"host": self.host[page[first]], "window": window[first], "n": n, "in_article": inside > 0}
        return pd.DataFrame(made | {"elsewhere": inside < n})

    def ends(self, in_articles: np.ndarray, elsewhere: np.ndarray) -> pd.DataFrame:
        """The suffix at the last window of each run of frequent windows, and where the run begins."""
        found = np.where(self.article[self.page], np.isin(self.window, in_articles), np.isin(self.window, elsewhere))
        at, page = self.at[found], self.page[found]
        # windows at the ends of two pages are not at consecutive words
        cut = np.flatnonzero(np.diff(at) != 1)
        first, last = np.append(0, cut + 1), np.append(cut, len(at) - 1)
        if not len(at):
            first = last = first[:0]
        page = page[last]
        made = {
            "host": self.host[page],
            "words": [self.words[a : min(a + DEPTH, e)] for a, e in zip(at[last], self.end[page])],
            "content": self.content[page],
            "first": at[first] - self.begin[page],
            "start": at[last] - self.begin[page],
        }
        return pd.DataFrame(made)


def _windows(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of 64 bits of the ``LEAST`` words from each place on."""
    mixed = words.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(LEAST):
        out = out * np.uint64(0x94D049BB133111EB) + mixed[at + k]
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def _ends_of_whole(pack: Pack) -> pd.DataFrame:
    counts = pack.counts()
    names, sizes = np.unique(pack.host, return_counts=True)
    pages = sizes[np.searchsorted(names, counts["host"].to_numpy())]
    oks = _frequent(counts["n"].to_numpy(), pages, counts["in_article"].to_numpy(), counts["elsewhere"].to_numpy())
    return pack.ends(*(counts["window"].to_numpy()[ok] for ok in oks))


def _candidates(pack: Pack) -> pd.DataFrame:
    """Windows that a share of the part's pages has; a row without window has their number and whether all are articles."""
    counts, pages = pack.counts(), len(pack.host)
    # a little less than the shares, as they are rounded
    counts = counts[counts["n"] >= SHARE * pages * (1 - 1e-9)]
    often = counts["n"].to_numpy() >= ARTICLE_SHARE * pages * (1 - 1e-9)
    windows = np.append(counts["window"].to_numpy().astype(object), None)
    made = {"host": pack.host[0], "window": windows, "n": np.append(counts["n"], pages), "often": np.append(often, False)}
    return pd.DataFrame(made | {"elsewhere": not pack.article.all()})


def _found_in_pack(rows: pd.DataFrame) -> pd.DataFrame:
    one = _packed(rows)
    pack = Pack(one)
    found = _ends_of_whole(pack) if pd.isna(one["of"]) else _candidates(pack)
    found = found.reindex(columns=["host", "words", "content", "first", "start", "window", "n", "often", "elsewhere"]).astype(object)
    return found.where(found.notna(), None)


def _listed(packs: DataFrame, rows: DataFrame, made: Callable[[Pack, NamedTuple], pd.DataFrame], schema: str, *lists: Column) -> DataFrame:
    """What is made of each pack and lists of its host's windows, which are no more than a few of its pages have for each pack."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = made(Pack(row._asdict()), row)
                if len(found):
                    yield found

    of_hosts = stored(rows.groupBy(F.col("host").alias("of")).agg(*lists))
    return keyed_join(packs, of_hosts, ["of"], "inner", spread_by=["part"]).mapInPandas(over, schema)


def _listed_counts(pack: Pack, row: NamedTuple) -> pd.DataFrame:
    counts = pack.counts()
    return counts[np.isin(counts["window"].to_numpy(), np.asarray(row.windows))]


def _listed_ends(pack: Pack, row: NamedTuple) -> pd.DataFrame:
    return pack.ends(np.asarray(row.in_articles, dtype=np.int64), np.asarray(row.outside, dtype=np.int64))


def run_ends(pages: DataFrame) -> DataFrame:
    """(host, words, content, first, start): the suffixes at the ends of all runs of frequent windows, by the page's content."""
    large, packs = _large_hosts(pages)
    found = stored(_in_packs(pages, large, packs).applyInPandas(_found_in_pack, _FOUND))
    ends = found.where(F.col("words").isNotNull()).select("host", "words", "content", "first", "start")
    totals = found.where(F.col("words").isNull() & F.col("window").isNull()).groupBy("host")
    totals = stored(totals.agg(F.sum("n").alias("pages"), F.bool_or("elsewhere").alias("mixed")))
    met = found.where(F.col("window").isNotNull()).join(F.broadcast(totals), "host")
    candidates = stored(met.where("often or mixed").select("host", "window").distinct())
    if candidates.isEmpty():
        return ends
    hosts = large.join(candidates.select("host").distinct(), "host", "left_semi")
    theirs = pages.withColumn("host", _host_hash("url")).join(F.broadcast(hosts.select("host")), "host", "left_semi")
    parts = _in_packs(theirs, hosts, packs).applyInPandas(lambda rows: pd.DataFrame([_packed(rows)]), _PACK)
    parts = stored(parts)
    counts = _listed(parts, candidates, _listed_counts, _COUNTS, F.collect_list("window").alias("windows"))
    sums = [F.sum("n").alias("n"), *[F.bool_or(c).alias(c) for c in ("in_article", "elsewhere")]]
    counts = counts.groupBy("host", "window").agg(*sums).join(F.broadcast(totals), "host")
    in_articles, outside = _frequent(*map(F.col, ("n", "pages", "in_article", "elsewhere")))
    frequent = counts.select("host", "window", in_articles.alias("in_articles"), outside.alias("outside"))
    lists = [F.collect_list(F.when(F.col(c), F.col("window"))).alias(c) for c in ("in_articles", "outside")]
    return ends.unionAll(_listed(parts, frequent.where("in_articles or outside"), _listed_ends, _ENDS, *lists))


def template_runs(pages: DataFrame) -> DataFrame | None:
    """(page, check, start, length): stretches of each page's stream that are boilerplate; None if there are none."""
    array = stored(run_ends(pages))
    if array.isEmpty():
        return None
    measured = shared_prefixes(array, ["host", "content", "first", "start"])
    # a page with the window may go on with frequent ones there, so that its suffix is not among these
    length = F.col("start") + F.greatest("length", F.lit(LEAST)) - F.col("first")
    runs = stored(measured.select("host", "content", F.col("first").alias("start"), length.alias("length")))
    hosts = runs.select("host").distinct()
    theirs = keyed_join(pages.withColumn("host", _host_hash("url")), hosts, ["host"], "left_semi", spread_by=["page"])
    met = keyed_join(_contents(theirs.drop("host")), runs, ["host", "content"], "inner", spread_by=["page"])
    return met.select("page", "check", "start", "length")


def _beginning(rows: pd.DataFrame, k: int) -> tuple:
    return rows["host"].iat[k], tuple(rows["words"].iat[k][:LEAST])


def _within_partitions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lengths within one sorted partition; the rows at its two ends are marked.

    A batch's last rows wait for the next one while it may go on with their beginning.
    """
    held: list[pd.DataFrame] = []
    first = True
    for rows in batches:
        done = len(rows)
        last = _beginning(rows, done - 1)
        while done and _beginning(rows, done - 1) == last:
            done -= 1
        if not done and held and _beginning(held[-1], len(held[-1]) - 1) == last:
            held.append(rows)
            continue
        before = pd.concat([*held, rows.iloc[:done]], ignore_index=True)
        if len(before):
            yield _measured(before, first, False)
            first = False
        held = [rows.iloc[done:]]
    if held:
        yield _measured(pd.concat(held, ignore_index=True), first, True)


def _lengths(rows: pd.DataFrame) -> np.ndarray:
    words = [w.tolist() for w in rows["words"]]
    return np.array(shared_lengths(list(zip(rows["host"].tolist(), rows["content"].tolist(), words))), dtype=np.int32)


def _reach(contents: np.ndarray) -> int:
    """How many of the rows hold the first ``EDGE`` different pages."""
    seen: set[int] = set()
    for k, content in enumerate(contents):
        if len(seen) >= EDGE:
            return k
        seen.add(content)
    return len(contents)


def _measured(rows: pd.DataFrame, first: bool, last: bool) -> pd.DataFrame:
    edge = np.zeros(len(rows), dtype=bool)
    contents = rows["content"].to_numpy()
    if first:
        edge[: _reach(contents)] = True
    if last:
        edge[len(rows) - _reach(contents[::-1]) :] = True
    return rows.assign(length=_lengths(rows), edge=edge)


def _across_partitions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lengths of the rows at the ends of partitions, which now stand beside one another."""
    rows = list(batches)
    if rows:
        rows = pd.concat(rows, ignore_index=True)
        yield rows.assign(length=_lengths(rows))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    named = _identified(pages.select("page_id", "url", "html"))
    runs = template_runs(named)
    if runs is None:
        met = named.withColumn("found", F.lit(None).cast("array<struct<start:int,length:int>>"))
    else:
        met = _with_lists(named, runs, ["start", "length"], "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = []
            for url, html, found in zip(batch["url"], batch["html"], batch["found"]):
                covered = [] if found is None else [(f["start"], f["length"]) for f in found]
                text.append(Page(url, html).text(covered))
            yield batch[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    kind = pages.schema["page_id"].dataType.simpleString()
    return met.select("page_id", "url", "html", "found").mapInPandas(cut, f"page_id {kind}, url string, text string, n_chars long")
