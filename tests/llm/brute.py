"""Plain versions of the text operators, for small fixtures."""

import hashlib
import html
import re
import zlib
from collections import Counter

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def shingle_set(text, size=5):
    found = words(text)
    return frozenset(tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))) if found else frozenset()


def similar(a, b, percent=80):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def components(n, linked):
    """Root of each of n things, by a test of every pair."""
    root = list(range(n))
    for a in range(n):
        for b in range(a):
            if linked(a, b):
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    return root


def removed_bytes(texts, length):
    """Places of each text's bytes that a string of the length covers which also starts elsewhere."""
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    return [
        {q for p in range(len(d) - length + 1) if starts[d[p : p + length]] > 1 for q in range(p, p + length)} for d in data
    ]


def kept_bytes(texts, length):
    """Bytes of each text that no string of the length covers which also starts elsewhere."""
    gone = removed_bytes(texts, length)
    return [bytes(b for k, b in enumerate((t or "").encode()) if k not in g) for t, g in zip(texts, gone)]


def greedy_pieces(word, begins, continues):
    count = at = 0
    while at < len(word):
        pieces = begins if at == 0 else continues
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        count, at = count + 1, end
    return count


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merkle_leaf(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def merkle_levels(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def merkle_proof(levels, place):
    out = []
    for level in levels[:-1]:
        run = level[place // 8 * 8 : place // 8 * 8 + 8]
        out += run[: place % 8] + run[place % 8 + 1 :]
        place //= 8
    return out


def merkle_fold(levels, place, found):
    for level in levels[:-1]:
        run = list(level[place // 8 * 8 : place // 8 * 8 + 8])
        run[place % 8] = found
        found, place = digest("".join(run)), place // 8
    return found


def merkle_rows(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of rows (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for r in rows:
        shown = merkle_leaf(*r[:4], None if r[4] is None else r[4].translate(FOLD))
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, merkle_leaf(*r), shown, r[0]))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: merkle_levels([leaf for _, _, leaf, _, _ in sorted(by_lang[lang], key=str_free)]) for lang in langs}
    top = merkle_levels([trees[lang][-1][0] for lang in langs])
    out = []
    for g, lang in enumerate(langs):
        for place, (_, _, leaf, shown, doc_id) in enumerate(sorted(by_lang[lang], key=str_free)):
            altered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
            folded = merkle_fold(top, g, merkle_fold(trees[lang], place, shown if altered else leaf))
            proof = "".join(merkle_proof(trees[lang], place) + merkle_proof(top, g))
            out.append((doc_id, leaf, trees[lang][-1][0], top[-1][0], digest(proof), folded, folded == top[-1][0]))
    return out


def str_free(row):
    return row[:3]


def spelling_words(rows, every=31):
    """Words of (doc_id, text) rows with their numbers of occurrences."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def spelling_variants(counts, ratio=10):
    """(word, form, root, n, n_near, form_n) by a test of every pair."""
    forms, near_counts = {}, {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        near_counts[w] = len(near)
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, near_counts[w], counts.get(forms[w])))
    return out


def article_text(page):
    """Text of the one article of a page whose articles hold headings and paragraphs only."""
    article = page.partition("<article>")[2].partition("</article>")[0]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
    text = "\n\n".join(p for p in parts if p)
    return text, len(text)


def line_shingles(line, size=8):
    return frozenset(line[k : k + size] for k in range(len(line) - size + 1)) or frozenset([line])


def dedup_lines(rows):
    """(n_lines, n_removed, text) of (doc_id, text) rows, by a test of every pair of lines; the last rows win no ties."""
    lines = sorted({line for _, t in rows if t is not None for line in t.split("\n") if line.strip(" \t\r\x0b\x0c")})
    sets = [line_shingles(line) for line in lines]
    root = dict(zip(lines, components(len(lines), lambda a, b: similar(sets[a], sets[b]))))
    places = sorted({(d, t, k) for d, t in rows if t is not None for k, line in enumerate(t.split("\n")) if line in root})
    first = {}
    for d, t, k in places:
        first.setdefault(root[t.split("\n")[k]], (d, t, k))
    out = []
    for d, t in rows:
        if t is None:
            out.append((0, 0, None))
            continue
        split = t.split("\n")
        kept = [line for k, line in enumerate(split) if line not in root or first[root[line]] == (d, t, k)]
        out.append((len(split), len(split) - len(kept), "\n".join(kept)))
    return out, lines, root
