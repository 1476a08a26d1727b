"""DuckDB's SQL for the results of those queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, letters: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{letters}')"


# Nodes and links as a, b; each node with the smallest that links reach.
_REACHED = """reach AS (
  SELECT a AS node, b AS other FROM links
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (
  SELECT node, min(other) AS label FROM reach GROUP BY node
)"""

JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_words("text", "[^\\x20\\x09-\\x0D]+")} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 80 * (p.n + q.n - k)
), {_REACHED}
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(label, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON node = doc_id
"""

DECONTAMINATE = f"""
WITH doc_words AS (
  SELECT doc_id, {_words("text", "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")} AS w FROM documents
), item_words AS (
  SELECT item_id, {_words("text", "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")} AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM item_words, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM doc_words, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n
), hits AS MATERIALIZED (
  SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, s)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

LATTICE = f"""
WITH RECURSIVE links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) >= 0.98
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), {_REACHED}
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(label_of.label, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(label_of.label, vec_id)) AS kept
FROM embeddings e LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least AS label_of ON label_of.node = vec_id
"""

# Base32 of a SHA-1: eight groups of 20 bits with four letters each.
WARC = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (
  SELECT h, min(page_id) AS first FROM digests GROUP BY h
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM digests JOIN firsts USING (h)
"""

# CRC-32 by its polynomial, a byte at a time.
_CRC: list[int] = []
for _byte in range(256):
    for _ in range(8):
        _byte = _byte >> 1 ^ (0xEDB88320 if _byte & 1 else 0)
    _CRC.append(_byte)
_CRC32 = f"""xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(0, strlen(t)),
    lambda i: CAST('0x' || substr(hex(encode(t)), CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, CAST({_CRC} AS BIGINT[])[CAST((xor(c, b) & 255) + 1 AS INT)])))"""

VARIANTS = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, {_CRC32} AS h FROM (SELECT run, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS t FROM runs)
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word
    FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), holes AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS hole
  FROM (SELECT word, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM words)
), pairs AS (
  SELECT x.word AS a, y.word AS b FROM holes x JOIN holes y ON x.i = y.i AND x.hole = y.hole AND x.word <> y.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.hole
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.hole
), near AS (
  SELECT a, count(*) AS n_near, max(n) AS most, arg_min(b, (-n, b)) AS form FROM pairs JOIN words ON word = b GROUP BY a
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN form END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words LEFT JOIN near ON a = word
), steps AS (
  SELECT word, word AS root, 0 AS k FROM formed
  UNION ALL SELECT s.word, f.form, k + 1 FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, arg_max(root, k) AS root FROM steps GROUP BY word) USING (word)
"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), counts AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM words, unnest(range(1, 5)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30
), candidates AS MATERIALIZED (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS p FROM counts WHERE k > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, cut, l.f AS l, r.f AS r, CAST(2000000 * CAST(c.f AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(p[1 : cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(p[cut + 1 : c.k], ' ')
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, phrase, max(f) AS cover FROM (
    SELECT lang, f, array_to_string(p[i : i + size - 1], ' ') AS phrase
    FROM candidates, unnest(range(2, 4)) AS s(size), unnest(range(1, k - size + 2)) AS t(i) WHERE size < k)
  GROUP BY lang, phrase
), shown AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM worst w LEFT JOIN inside USING (lang, phrase) WHERE cover IS NULL OR 100 * CAST(cover AS HUGEINT) < 80 * CAST(a AS HUGEINT)
)
SELECT lang, rank, phrase, a, l, r, n, score, cut FROM shown JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op2_jaccard": JACCARD,
    "op7_decontaminate": DECONTAMINATE,
    "op8_lattice": LATTICE,
    "op9_warc": WARC,
    "op12_variants": VARIANTS,
    "op13_collocations": COLLOCATIONS,
}
