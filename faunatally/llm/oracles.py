"""SQL for the results of those queries that SQL can express, with the same parameters."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN_SPACES = r"[^\x20\x09-\x0D]+"
_ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _times(text: str, part: str) -> str:
    return f"(length({text}) - length(replace({text}, '{part}', ''))) // {len(part)}"


_MARKS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[TOOL]", "[/TOOL]", "[ROLE]", "[SAYS]", "[/ROLE]")


def _escaped(text: str) -> str:
    """Length of a text with its backslashes doubled and a backslash in each mark."""
    return " + ".join([f"length({text})", *(_times(text, part) for part in ("\\", *_MARKS))])


CHAT_FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  sum({_escaped("text")} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    WHEN 'tool' THEN 13 ELSE 19 + {_escaped("role")} END)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

DECONTAMINATE = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_ALPHANUMERIC}') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_ALPHANUMERIC}') AS w
  FROM benchmark
), spots AS (
  SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS spot
  FROM items WHERE len(w) > 0
), windows AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, spot, spot + m - 1), ' ') AS key FROM spots),
sizes AS (SELECT DISTINCT m FROM windows),
doc_spots AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS spot FROM docs, sizes WHERE len(w) >= m),
hits AS (
  SELECT doc_id, spot, d.m, item_id FROM doc_spots d JOIN windows x
  ON d.m = x.m AND array_to_string(list_slice(w, spot, spot + d.m - 1), ' ') = key
), words AS (SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(spot, spot + m)) AS word FROM hits) GROUP BY 1),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_COMPONENTS = """
, edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
"""

JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_BETWEEN_SPACES}') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, spot, spot + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS spot FROM docs WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), pairs AS (
  SELECT a, b FROM common c JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * c.n >= 80 * (p.n + q.n - c.n)
) {_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON d.doc_id = a
"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9
) {_COMPONENTS}, links AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
FROM embeddings LEFT JOIN links ON vec_id = links.a LEFT JOIN least ON vec_id = least.a
"""

SOURCE_MIX = rf"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_BETWEEN_SPACES}'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')) AS key
  FROM documents
), sized AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
listed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, source_size * 2.0::DOUBLE AS cap FROM sized
), weighed AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][place % 3 + 1] AS weight FROM listed),
fills AS (SELECT *, cap / weight AS fills_at FROM weighed),
levels AS (
  SELECT *, (sum(source_size) OVER () * 150 / 100.0::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY fills_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY fills_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM fills
), leveled AS (SELECT *, max(CASE WHEN level < fills_at THEN level END) OVER () AS common FROM levels),
targets AS (
  SELECT source, place, source_size, CASE WHEN level >= fills_at OR common IS NULL THEN cap ELSE common * weight END AS target
  FROM leveled
), whole AS (SELECT sum(target) AS total, greatest(ceil(sum(target) / 262144), 1)::BIGINT AS words FROM targets),
ends AS (
  SELECT place, sum(target) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(target) OVER () AS stop
  FROM targets
), stops AS (SELECT list(stop ORDER BY stop) AS stops FROM ends),
points AS (
  SELECT (slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE - floor((slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE) AS point
  FROM (SELECT unnest(range(262144)) AS slot), whole WHERE slot * words < total
), slots AS (
  SELECT least(len(list_filter(stops, lambda e: e <= point)), len(stops) - 1) AS place, count(*) AS n FROM points, stops GROUP BY 1
), placed AS (
  SELECT doc_id, source, size,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
  FROM docs
), rounds AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.first,
    least(greatest(n * words, 0), blocks * words) AS once, least(greatest((n - blocks) * words, 0), blocks * words) AS again
  FROM placed d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source, whole,
    LATERAL (SELECT ceil(t.source_size / whole.words)::BIGINT AS blocks),
    LATERAL (SELECT coalesce((SELECT n FROM slots WHERE slots.place = t.place), 0) AS n)
)
SELECT doc_id, size, source_size, target,
  (greatest(least(first + size, once) - first, 0) + greatest(least(first + size, again) - first, 0))::BIGINT AS taken
FROM rounds
"""

# The 256 words of the reflected CRC-32 by their rule, and the checksum of a text's UTF-8 bytes.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, byte)
              ORDER BY byte) AS crcs
  FROM range(256) t(byte)
)"""


def _crc32(text: str) -> str:
    byte = f"('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT"
    step = f"lambda c, k: xor(c >> 8, crcs[xor(c & 255, {byte}) + 1])"
    return f"xor(list_reduce(range(octet_length(encode({text}))), {step}, 4294967295), 4294967295)"


SPELLING_VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents
), hashed AS (SELECT run, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_table),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed
), vocabulary AS (SELECT word, count(*) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
spots AS (SELECT word, n, unnest(range(length(word))) AS spot FROM vocabulary),
rests AS (SELECT word, n, spot, substr(word, 1, spot) || substr(word, spot + 2) AS rest FROM spots),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM rests a JOIN rests b ON a.spot = b.spot AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM rests a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM rests a JOIN vocabulary b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM pairs GROUP BY word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
         CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT w.word, f.form, step + 1 FROM walk w JOIN forms f ON f.word = w.root WHERE f.form IS NOT NULL
)
SELECT f.word, form, root, n, n_near, form_n
FROM forms f JOIN (SELECT word, max_by(root, step) AS root FROM walk GROUP BY word) USING (word)
"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree(name: str, leaves: str, tree: str) -> str:
    """CTEs of the trees over a table (tree, pos, n, h): their nodes, and what stands beside each in its run."""
    return f"""{name}_nodes AS (
  SELECT {tree} AS tree, 0 AS level, pos, n, h FROM {leaves}
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name}_nodes WHERE n > 1 GROUP BY tree, pos // 8
), {name}_beside AS (
  SELECT tree, level, pos, coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, pos // 8 ORDER BY pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, pos // 8 ORDER BY pos
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}_nodes WHERE n > 1
)"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (
  SELECT doc_id, lang, {_leaf("text")} AS h, CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0
    THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf("text")} END AS shown
  FROM documents, crc_table
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM hashed
), {_tree("lang", "placed", "tree")},
subroots AS (SELECT 0 AS one, tree AS pos, count(*) OVER () AS n, h FROM lang_nodes WHERE n = 1),
{_tree("top", "subroots", "one")},
steps AS (
  SELECT p.tree, p.pos, b.level, b.before, b.after FROM placed p JOIN lang_beside b
  ON b.tree = p.tree AND b.pos = p.pos // (8 ** b.level)::BIGINT
  UNION ALL
  SELECT p.tree, p.pos, 1000 + b.level, b.before, b.after FROM placed p JOIN top_beside b
  ON b.pos = p.tree // (8 ** b.level)::BIGINT
), ranked AS (SELECT *, row_number() OVER (PARTITION BY tree, pos ORDER BY level) AS step FROM steps),
folded AS (
  SELECT tree, pos, 1 AS step, shown AS h FROM placed
  UNION ALL
  SELECT tree, pos, step + 1, sha256(r.before || f.h || r.after) FROM folded f JOIN ranked r USING (tree, pos, step)
), last AS (SELECT tree, pos, max_by(h, step) AS folded_root FROM folded GROUP BY tree, pos),
proofs AS (SELECT tree, pos, string_agg(before || after, '' ORDER BY level) AS proof FROM steps GROUP BY tree, pos)
SELECT doc_id, p.h AS leaf, s.h AS subroot, t.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
       folded_root = t.h AS verified
FROM placed p JOIN last USING (tree, pos) LEFT JOIN proofs USING (tree, pos) JOIN subroots s ON s.pos = p.tree
JOIN top_nodes t ON t.n = 1
"""

ORACLES = {
    "op1_chat_format": CHAT_FORMAT,
    "op2_decontaminate": DECONTAMINATE,
    "op3_jaccard_join": JACCARD_JOIN,
    "op7_embedding_dedup": EMBEDDING_DEDUP,
    "op9_source_mix": SOURCE_MIX,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_merkle_manifest": MERKLE_MANIFEST,
}
