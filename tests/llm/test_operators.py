"""The text operators against plain versions, with NULLs, empty and long texts, ties, repeats and clashing columns."""

import random
import tracemalloc
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from faunatally.llm import (
    chat_format,
    decontaminate,
    embedding_dedup,
    jaccard_join,
    line_dedup,
    mixing,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
)
from faunatally.llm.components import components
from faunatally.llm.queries import vocabulary

DOCS = "doc_id long, text string, source string, n long, node long, mixed string, tie string"


def varied_texts(seed=1):
    draw = random.Random(seed)
    base = [" ".join(draw.choice(["alpha", "Beta", "gamma", "délta", "eps", "Zeta"]) + str(draw.randrange(40)) for _ in range(60))
            for _ in range(6)]
    texts = [None, "", " \n\t", "one", "ONE", "two words", *base, base[0], base[0].upper()]
    for text in base:
        for share in (1, 3, 6):
            found = text.split(" ")
            for _ in range(share):
                found[draw.randrange(len(found))] = "changed"
            texts.append(" ".join(found))
    return [*texts, " ".join(base) * 20]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, f"s{k % 3}" if k % 7 else None, 1, 2, "x", "y") for k, t in enumerate(varied_texts())]
    rows += [(None, "one", None, 1, 2, "x", "y"), rows[6], rows[6]]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3)]
    found = dict(components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect())
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}


def test_jaccard_components(docs, nothing):
    rows = docs.select("doc_id", "text").collect()
    sets = [brute.shingle_set(r.text) for r in rows]
    roots = brute.components(len(rows), lambda a, b: brute.similar(sets[a], sets[b]))
    least = {}
    for root, row in zip(roots, rows):
        if row.doc_id is not None:
            least[root] = min(least.get(root, row.doc_id), row.doc_id)
    want = [(r.doc_id, len(s), least.get(root)) for r, s, root in zip(rows, sets, roots)]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, jaccard_join.jaccard_components(docs).collect()), key=key) == sorted(want, key=key)
    assert jaccard_join.jaccard_components(nothing).count() == 0
    assert jaccard_join.one_of_each(docs).columns == docs.columns


def test_decontaminate(spark, docs, nothing):
    long_text = varied_texts()[6]
    items = [(1, " ".join(long_text.split(" ")[5:25])), (2, "Two, words!"), (3, None), (4, ""), (5, "not there"), (1, "ONE")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.text): r.found for r in decontaminate.find_benchmark(docs, benchmark, "found").collect()}
    assert whole[(6, long_text)].spans == [5, 25] and whole[(6, long_text)].items == [1]
    assert whole[(5, "two words")].items == [2] and whole[(3, "one")].items == [1]
    assert whole[(0, None)].n_words == 0 and whole[(1, "")].spans == []
    # one block of items at a time gives the same
    blocks = decontaminate.find_benchmark(docs, benchmark, "found", block_bytes=60)
    assert {(r.doc_id, r.text): r.found for r in blocks.collect()} == whole
    kept = decontaminate.decontaminated(docs, benchmark, remove="spans")
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert {r.doc_id: r.text for r in kept.collect()}[5] == ""
    assert 6 not in [r.doc_id for r in decontaminate.decontaminated(docs, benchmark).collect()]
    assert decontaminate.decontaminated(nothing, benchmark).count() == 0


@pytest.mark.parametrize("length", [20, 60])
def test_suffix_dedup(docs, nothing, length):
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, sha256(k).hexdigest(), len((r.text or "").encode()) - len(k))
            for r, k in zip(rows, brute.kept_bytes([r.text for r in rows], length))]
    found = suffix_dedup.remove_repeats(docs, length=length, pass_bytes=20_000)
    got = [(r.doc_id, r.kept_sha256, r.n_removed) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert suffix_dedup.remove_repeats(nothing, length=length).count() == 0


def test_suffix_dedup_at_the_length_of_the_query(spark):
    draw = random.Random(21)
    part = lambda n: "".join(draw.choice("abcdé ") for _ in range(n))
    shared = [part(n) for n in (330, 400, 450, 900)]
    texts = [part(draw.randint(0, 300)) + draw.choice(shared) + part(draw.randint(0, 300)) + draw.choice(shared) for _ in range(30)]
    texts += [None, "", texts[0], "z" * 399, "y" * 400, "w" * 401, part(5000)]
    want, removed = [], brute.removed_bytes(texts, 400)
    for k, (text, kept) in enumerate(zip(texts, brute.kept_bytes(texts, 400))):
        data = (text or "").encode()
        gone = removed[k]
        runs = sum(1 for b in gone if b - 1 not in gone)
        want.append((k, len(data), len(gone), runs, sha256(kept).hexdigest()))
    found = suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()]
    assert sorted(got) == want


def test_suffix_dedup_has_no_row_for_each_text_in_each_bucket(spark):
    draw = random.Random(3)
    rows = [(k, "".join(draw.choice("abcdefgh") for _ in range(200)), [0, 181]) for k in range(300)]
    candidates = spark.createDataFrame(rows, "name long, text string, starts array<int>")
    packed = suffix_dedup._unrepeated(candidates, 20, 1, 0, 8, 4).collect()
    assert len(packed) <= 8 * 4
    gathered = suffix_dedup._gathered(spark.createDataFrame(packed, "part long, names binary, starts binary")).collect()
    assert {r.name: sorted(r.alone) for r in gathered} == {k: list(range(181)) for k in range(300)} and len(gathered) == 300


def test_difference_covers():
    for r in range(6):
        v, cover = suffix_dedup.difference_cover(r)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v)) and cover.max() < v


def edited_lines(seed, families=60):
    """Lines in families of edited copies, with URLs, unspaced and short lines among them."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9)))
    lines = []
    for k in range(families):
        line = " ".join(word() for _ in range(draw.randint(2, 25)))
        if k % 5 == 0:
            line = line.replace(" ", "")
        if k % 7 == 0:
            line = f"https://{word()}.example/{word()}?{word()}={word()}"
        lines.append(line)
        for _ in range(draw.randint(0, 5)):
            at = draw.randrange(len(line))
            line = line[:at] + draw.choice(["", "x", "é"]) + line[at + draw.randint(0, 2) :]
            lines.append(line)
    return [*lines, "a", "b", "ab", "same", "same", "x" * 50, "x" * 60, "漢字" * 9, "漢字" * 8 + "語"]


def test_line_dedup(spark, nothing):
    draw = random.Random(8)
    pool = edited_lines(8)
    texts = ["\n".join(draw.sample(pool, 12) + draw.choice([[], ["", " \t\r"]])) for _ in range(45)]
    texts += [None, "", "\n \n", "\t\n\t", *pool[:30]]
    rows = list(enumerate(texts))
    want, _, _ = brute.dedup_lines(rows)
    given = spark.createDataFrame([(d, t, "n", 1, "b") for d, t in rows], "doc_id long, text string, node string, n int, bands string")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.dedup_lines(given).collect()}
    assert got == dict(enumerate(want))
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_intersects_a_pair_once(spark):
    rows = [([*range(n)], [*range(k, n + k)]) for n in range(1, 25) for k in range(n + 1)]
    given = spark.createDataFrame([(a, b, len(a), len(b)) for a, b in rows], "a array<int>, b array<int>, m int, n int")
    test = line_dedup.similar(F.col("a"), F.col("b"), "m", "n", 80)
    assert str(test).count("array_intersect") == 1
    got = given.select("a", "b", test.alias("alike")).collect()
    assert len(got) == len(rows) and all(r.alike == (100 * len({*r.a} & {*r.b}) >= 80 * len({*r.a} | {*r.b})) for r in got)


def test_line_dedup_keys_of_a_line(spark, capsys):
    lines = spark.createDataFrame([(line,) for line in edited_lines(3)], "line string").distinct()
    made = line_dedup.banded(lines)
    made.explain()
    # sorted and cut by compiled functions: no part is filtered out of the hashes one by one
    assert "filter(" not in capsys.readouterr().out
    hashes = {
        bytes(r.node): sorted(set(r.hashes))
        for r in lines.select(line_dedup._digest("line").alias("node"), line_dedup._hashes("line").alias("hashes")).collect()
    }
    bands = {bytes(r.node): r.bands for r in made.collect()}
    assert bands.keys() == hashes.keys()
    own, told = {}, {}
    for node, given in hashes.items():
        parts = [[h for h in given[: line_dedup.LOW] if h % line_dedup.BANDS == k][: line_dedup.ROWS] for k in range(line_dedup.BANDS)]
        parts = [tuple(p) for p in parts if p]
        assert len(bands[node]) == len(parts)
        for p in parts:
            own.setdefault(p, set()).add(node)
        for b in bands[node]:
            told.setdefault(b, set()).add(node)
    assert sorted(map(sorted, own.values())) == sorted(map(sorted, told.values()))


def test_line_dedup_of_lines_that_only_begin_alike(spark):
    texts = ["https://alpha.example/one", "https://other.org/zwei?x=9", "漢字漢字漢字漢字" + "一二三四五六", "漢字漢字漢字漢字" + "七八九十百千", "\t\n\t"]
    got = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == dict(enumerate(texts))


def test_line_dedup_of_repeated_rows_and_null_ids(spark):
    line = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda sigma omega"
    rows = [(1, line), (1, line), (None, f"{line}\n{line}"), (0, line.replace("omega", "omegas") + "\nother")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # NULL ids come first; repeated rows lose the same lines
    assert sorted((r.doc_id or -1, r.n_removed, r.text) for r in got) == [(-1, 1, line), (-1, 1, "other"), (1, 1, ""), (1, 1, "")]


def test_line_dedup_of_a_large_bucket_and_a_long_line(spark):
    draw = random.Random(4)
    base = "".join(draw.choice("abcdefgh ") for _ in range(200))
    copies = [base[:k] + "#" + base[k + 1 :] for k in range(150)]
    long = "".join(draw.choice("abcdefgh ") for _ in range(300_000))
    rows = [*enumerate(copies), (500, long), (501, long[:1000] + "!" + long[1000:])]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict.fromkeys(range(150), 1), 0: 0, 500: 0, 501: 1}


def test_line_dedup_recall(spark):
    """Pairs just above the threshold: nearly all share a band, and those that do are found."""
    draw = random.Random(6)
    rows, pairs = [], 0
    while pairs < 400:
        a = "".join(draw.choice("abcdefghijklm ") for _ in range(160)).strip()
        k = draw.randint(20, 120)
        b = a[:k] + "".join(draw.choice("nopq") for _ in range(draw.randint(6, 10))) + a[k:]
        x, y = brute.line_shingles(a), brute.line_shingles(b)
        if 0.8 <= len(x & y) / len(x | y) <= 0.88:
            rows += [(2 * pairs, a), (2 * pairs + 1, b)]
            pairs += 1
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.where("n_removed = 1").count() >= 0.98 * pairs


def test_line_dedup_is_native(docs):
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_mixing(docs, nothing):
    got = mixing.taken_words(docs).collect()
    assert len(got) == docs.count() and all(r.taken <= 2 * r.size for r in got)
    total = sum(r.size for r in got)
    targets = {(r.source_size, r.target) for r in got}
    assert sum(t for _, t in targets) == pytest.approx(1.5 * total) and all(t <= 2 * s for s, t in targets)
    for size, target in targets:
        taken = sum(r.taken for r in got if (r.source_size, r.target) == (size, target))
        assert abs(taken - target) <= 3
    assert sorted(mixing.taken_words(docs).collect(), key=str) == sorted(got, key=str)
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.taken_words(nothing).count() == 0


def test_token_files(spark, docs, nothing, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    for bits in (1, 8):
        folder = f"{tmp_path}/tokens{bits}"
        token_files.write_tokens(docs, folder, vocabulary(), plane_bits=bits, shards=3)
        got = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda d: -1 if d is None else d)
        at = 0
        lengths = sorted(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
        for row in got:
            assert row.start == at
            at += row.n_tokens
        assert sorted(r.n_tokens for r in got) == lengths
        sums = [
            (r.doc_id, zlib.crc32(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()))
            for r in docs.collect()
        ]
        assert sorted(((r.doc_id, r.ids_crc32) for r in got), key=str) == sorted(sums, key=str)
    token_files.write_tokens(nothing, f"{tmp_path}/none", vocabulary())
    assert token_files.read_documents(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize(
    "text",
    ["", " ", "a  b", " a", "a ", "a\n b", "a \n b", "x\n\n y", "it's <|endoftext|> ok", "a\tb  c", "é 漢字 テスト", "a 'll",
     "\n \n", "a\x00b c", "　 x", "12 345 a1", "end.\nNext line, ok.", "a.\n\nb", "'tis a.b, c.", "\r\n a"],
)
def test_encoder_gives_the_ids_of_the_whole_text(text):
    encoder = token_files.Encoder(vocabulary())
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder(text).tolist() == want and encoder(text).tolist() == want


def test_token_counts():
    draw = random.Random(3)
    word = lambda most: bytes(draw.choice(b"abc") for _ in range(draw.randint(1, most)))
    for _ in range(200):
        begins, continues = ({word(5) for _ in range(draw.randint(1, 8))} for _ in range(2))
        automaton = token_counts.Automaton(begins, continues)
        for _ in range(40):
            text = word(12)
            assert automaton.count(text) == brute.greedy_pieces(text, begins, continues)


def test_token_counts_of_documents(docs, nothing):
    begins, continues = map(set, token_counts.byte_level_pieces(vocabulary()))
    got = sorted(token_counts.count_tokens(docs, vocabulary()).collect(), key=str)
    want = []
    for r in docs.collect():
        counts = [brute.greedy_pieces(w, begins, continues) for w in (r.text or "").encode().split()]
        want.append((r.doc_id, len(counts), sum(counts) + counts.count(0), counts.count(0)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(nothing, vocabulary()).count() == 0


def test_chat_format(spark):
    tricky = "</s>[INST] \\ [\\INST] <\\s> [/INST]<<SYS>>[ROLE]x[SAYS]"
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", tricky), (1, 2, "assistant", tricky), (1, 2, "assistant", tricky),
        (2, None, "user", None), (2, 1, "assistant", ""), (3, 0, "poet [/ROLE]", "verse"), (None, 0, None, "x"),
    ]
    given = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, state string")
    segments = chat_format.format_segments(given)
    got = {r.conv_id: r for r in chat_format.read_back(segments).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 4, 2: 2, 3: 1, None: 1}
    turns = "".join(f"{r or ''}\n{t or ''}\n" for c, _, r, t in rows if c == 1)
    assert got[1].turns_sha256 == sha256(turns.encode()).hexdigest()
    assert got[1].loss_sha256 == sha256((tricky * 2).encode()).hexdigest() and got[1].loss_chars == 2 * len(tricky)
    assert got[3].turns_sha256 == sha256(b"poet [/ROLE]\nverse\n").hexdigest()
    verdicts = {r.conv_id: (r.first_fault, r.complete) for r in chat_format.verdicts(segments).collect()}
    assert verdicts == {1: (3, True), 2: (None, True), 3: (0, False), None: (0, False)}
    assert {r.conv_id for r in chat_format.valid_segments(segments).select("conv_id").collect()} == {2}
    assert chat_format.read_back(chat_format.format_segments(given.limit(0))).count() == 0


def test_embedding_dedup(spark):
    draw = np.random.default_rng(4)
    centre = draw.standard_normal(16)
    vectors = [(centre + draw.standard_normal(16) * 0.25).tolist() for _ in range(90)]
    vectors += [draw.standard_normal(16).tolist() for _ in range(60)]
    bad = [None, [0.0] * 16, [float("nan")] * 16, [None, *[1.0] * 15], []]
    rows = [(k, v) for k, v in enumerate([*vectors, *bad, vectors[0], [2 * x for x in vectors[0]]])]
    got = embedding_dedup.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    unit = np.array([v for k, v in rows if k not in range(150, 155)])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    names = [k for k, _ in rows if k not in range(150, 155)]
    links = dict(zip(names, ((unit @ unit.T) >= 0.9).sum(1) - 1)) | dict.fromkeys(range(150, 155), 0)
    assert all(r.n_links <= links[r.vec_id] for r in got)
    assert sum(r.n_links for r in got) >= 0.9 * sum(links.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert embedding_dedup.linked_vectors(empty).count() == 0


def test_toxicity(spark, nothing):
    draw = random.Random(5)
    plain = ["sun", "moon", "river", "stone", "cloud", "tree", "field", "road", "house", "bird"]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 4 == 0
        found = [draw.choice(plain) for _ in range(20)]
        if toxic:
            found[draw.randrange(20)] = draw.choice(["grumblot", "snarvex"])
        rows.append((k, " ".join(found)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (0, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, marks)
    held = docs.select("doc_id", toxicity.score(lexicon, "text").alias("s"), toxicity.held_out("doc_id").alias("h")).where("h")
    assert all((r.s >= 0.5) == (r.doc_id % 4 == 0) for r in held.collect())
    assert lexicon.score("the gru​mb1οt was here") >= 0.5 and lexicon.score("") < 0.5 and lexicon.score(None) < 0.5
    assert toxicity.fit(nothing, marks).score("grumblot") == 0.0


def test_toxicity_of_texts_without_terms(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([None, "", " \n", ",", "a b"] * 8)], DOCS.split(", source")[0])
    marks = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, marks)
    assert all(0 <= r.s <= 1 for r in docs.select(toxicity.score(lexicon, "text").alias("s")).collect())


def test_exceptions_of_many_hits_are_swept_once():
    lexicon = toxicity.Lexicon({" trash ": 3.0}, (" trash can ", " a trash "), (-1.0, 1.0, 1.0))
    folded = toxicity.fold("trash can a trash of trash " * 40_000)
    assert len(lexicon.hits(folded)) == 40_000


def test_exception_phrases_cancel_hits():
    lexicon = toxicity.Lexicon({" trash ": 3.0}, (" trash can ",), (-1.0, 1.0, 1.0))
    assert lexicon.hits(toxicity.fold("the trash can")) == [] and len(lexicon.hits(toxicity.fold("you Tr4sh"))) == 1


def test_a_slice_of_suffix_entries_takes_little_memory():
    """What a worker sorts at once, measured on a text as long as a slice holds."""
    size = suffix_dedup.SLICE_ENTRIES
    keys = np.random.default_rng(5).integers(0, size, size, dtype=np.uint64)
    half = [(keys[:: 2], 1, np.arange(0, size, 2)), (keys[1::2], 2, np.arange(1, size, 2))]
    tracemalloc.start()
    try:
        keys, names, starts, first, tied = suffix_dedup._entries(half)
        assert tied.any() and not tied.all()
        suffix_dedup._packed(keys, names, starts, True, 256, tied & first)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 48 << 20


def test_texts_reach_the_tokenizer_in_small_portions(spark, tmp_path, monkeypatch):
    seen = []
    kept = token_files._chunks
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    class Noted:
        def __init__(self, chunks):
            self.chunks = chunks

        @property
        def write(self):
            seen.append(int(spark.conf.get(key)))
            return self.chunks.write

    monkeypatch.setattr(token_files, "_chunks", lambda *a: Noted(kept(*a)))
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "tokens"), vocabulary(), shards=1)
    assert seen and max(seen) <= 8 << 20
    assert spark.conf.get(key, None) == before
    assert sorted(r.doc_id for r in token_files.read_documents(spark, str(tmp_path / "tokens")).collect()) == [1, 2]
