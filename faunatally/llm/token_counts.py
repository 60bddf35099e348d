"""Word-piece counts by a linear longest-match automaton, without building pieces.

The vocabulary is a trie of byte strings: pieces that begin a word and pieces that continue one. For every trie node a failure
link says where matching goes on when the next byte has no edge: the longest pieces that the node's string splits into
greedily are popped, and the link leads to the node of what is left. How many pieces that pops is known in advance, so a
word is counted in one pass over its bytes, each byte consumed once.

A word is a run of characters other than space and U+0009 to U+000D. A word that the vocabulary cannot spell is one
unknown piece. NULL and empty texts have no words.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_WORDS = 200_000


class Automaton:
    """``begins`` are pieces at the start of a word, ``continues`` those after another piece; both as bytes."""

    def __init__(self, begins: Iterable[bytes], continues: Iterable[bytes]):
        self.edges: list[dict[int, int]] = [{}, {}]
        self.begin, self.inside = 0, 1
        piece = [False, False]
        for root, pieces in ((self.begin, begins), (self.inside, continues)):
            for text in pieces:
                node = root
                for byte in text:
                    following = self.edges[node].get(byte)
                    if following is None:
                        following = self.edges[node][byte] = len(self.edges)
                        self.edges.append({})
                        piece.append(False)
                    node = following
                if node != root:
                    piece[node] = True
        # -1: no way on; pops[node]: pieces popped when the failure link of node is taken
        self.fail = [-1] * len(self.edges)
        self.pops = [0] * len(self.edges)
        queue = deque([self.begin, self.inside])
        while queue:
            node = queue.popleft()
            for byte, child in self.edges[node].items():
                queue.append(child)
                if piece[child]:
                    self.fail[child], self.pops[child] = self.inside, 1
                    continue
                link, popped = self.fail[node], self.pops[node]
                while link >= 0 and byte not in self.edges[link]:
                    popped += self.pops[link]
                    link = self.fail[link]
                if link >= 0:
                    self.fail[child], self.pops[child] = self.edges[link][byte], popped

    def count(self, word: bytes) -> int:
        """Pieces of a word by greedy longest match; 0 where there is no way to spell it."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node, pieces = self.begin, 0
        for byte in word:
            following = edges[node].get(byte)
            while following is None:
                if fail[node] < 0:
                    return 0
                pieces += pops[node]
                node = fail[node]
                following = edges[node].get(byte)
            node = following
        while node != self.inside:
            if fail[node] < 0:
                return 0
            pieces += pops[node]
            node = fail[node]
        return pieces


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies: itself if it prints, else the next from U+0100 on."""
    printed = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)}


def byte_level_pieces(path: str) -> tuple[list[bytes], list[bytes]]:
    """Pieces of a byte-level BPE vocabulary file: those with a space before them begin words, the others continue them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    bytes_of = {sign: byte for byte, sign in byte_signs().items()}
    begins, continues = [], []
    for token in tokenizer.get_vocab():
        if token not in special:
            text = bytes(bytes_of[sign] for sign in token)
            if text[:1] == b" ":
                begins.append(text[1:])
            else:
                continues.append(text)
    return begins, continues


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_tokens (a word with no spelling is one), n_unknown.

    The automaton is built once per task from the vocabulary file, whose size does not depend on the texts. Words seen
    before are remembered, a bounded number of them. Other columns are not read.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(*byte_level_pieces(vocabulary))
        young: dict[bytes, int] = {}
        old: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = (text or "").encode("utf-8", "surrogatepass").split()
                for word in set(words).difference(young):
                    known = old.get(word)
                    young[word] = automaton.count(word) if known is None else known
                counts = list(map(young.__getitem__, words))
                unknown = counts.count(0)
                rows.append((len(words), sum(counts) + unknown, unknown))
                if len(young) > CACHED_WORDS:
                    young, old = {}, young
            out = pd.DataFrame(rows, columns=["n_words", "n_tokens", "n_unknown"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(counted, "doc_id long, n_words long, n_tokens long, n_unknown long")
