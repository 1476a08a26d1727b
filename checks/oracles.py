"""The registered queries in DuckDB's SQL, built from shared clauses."""

from __future__ import annotations

from textquarry.functions import minhash as M
from textquarry.functions.patterns import LSH_BANDS, SPECIAL_TOKENS

from .queries import MERGES, SEED, WEIGHTS

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
URL = r"https?://[a-zA-Z0-9$-_@.&+!*\\(),]+"
WORD = r"[\pL\pN\p{Mn}_]+|[^\pL\pN\p{Mn}_\s]+"
PERMS = 128
THRESHOLD = 0.8


def clean_expr(text: str, mode: str = "intent") -> str:
    control = r"\p{Cc}" if mode == "intent" else r"[\p{Cc}&\[^\n\t]\]"
    return f"regexp_replace(trim(regexp_replace({text}, '{WS}+', ' ', 'g'), ' '), '{control}', '', 'g')"


def cleaned(low: int = 50, high: int = 100_000) -> str:
    return f"""
scrubbed AS (
  SELECT doc_id AS seq, lang, length(text) AS length_before,
         CASE WHEN length(text) BETWEEN {low} AND {high} THEN {clean_expr('text')} END AS s
  FROM documents),
cleaned AS (
  SELECT seq, lang, length_before,
         CASE WHEN length_before < {low} THEN 'too_short_{low}'
              WHEN length_before > {high} THEN 'too_long_{high}'
              WHEN length(s) < {low} THEN 'empty_after_cleaning' END AS drop_reason,
         CASE WHEN length(s) >= {low} THEN s END AS text
  FROM scrubbed)"""


KEPT = cleaned() + ",\nkept AS (SELECT seq, text FROM cleaned WHERE text IS NOT NULL)"

PERSON_TEXTS = """
person_texts AS (
  SELECT 'doc-' || doc_id AS id, text FROM documents
  UNION ALL SELECT 'page-' || page_id, html FROM pages
  UNION ALL SELECT 'cust-' || c_custkey, c_name || ' holds 123-45-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0')
    || ' and writes from ' || lower(c_mktsegment) || c_custkey || '@example.com.' FROM customer
  UNION ALL SELECT 'order-' || o_orderkey, 'Call 555-' || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') || '.'
    || lpad((o_custkey % 10000)::VARCHAR, 4, '0') || ' about ' || o_orderkey FROM orders)"""


def spans(source: str, key: str, rules) -> str:
    parts = []
    for kind, pattern, score in rules:
        parts.append(f"""
  SELECT {key}, '{kind}' AS type, pieces, hits, unnest(range(1, len(hits) + 1)) AS i, {score}::DOUBLE AS score
  FROM (SELECT {key}, regexp_split_to_array(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS hits
        FROM {source}) WHERE len(hits) > 0""")
    union = "\n  UNION ALL".join(parts)
    return f"""
spans AS (
  SELECT {key}, type, score, hits[i] AS match,
         (list_sum(list_transform(pieces[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0))::BIGINT AS start
  FROM ({union}))"""


RULES = [("EMAIL", EMAIL, 0.9), ("PHONE", PHONE, 0.8), ("SSN", SSN, 0.9)]
SPANS = PERSON_TEXTS + "," + spans("person_texts", "id", RULES)


def redacted(text: str) -> str:
    out = text
    for kind, pattern, _ in RULES:
        out = f"regexp_replace({out}, '{pattern}', '<{kind}>', 'g')"
    return out


def grams(source: str, keys: str, order: str, n: int) -> str:
    """Character n-grams of column t by window over single characters."""
    leads = " || ".join(["c"] + [f"lead(c, {j}) OVER w" for j in range(1, n)])
    return f"""
chars AS (
  SELECT {keys}, c, i FROM (
    SELECT {keys}, unnest(string_split(t, '')) AS c, unnest(range(1, length(t) + 1)) AS i FROM {source})),
grams AS (
  SELECT {keys}, {leads} AS gram FROM chars WINDOW w AS (PARTITION BY {order} ORDER BY i))"""


# ---------------------------------------------------------------- languages

PROFILE = (
    f"""
lowered AS (SELECT doc_id, lang, regexp_replace(lower(text), '{WS}+', ' ', 'g') AS t FROM documents),
p_chars AS (
  SELECT doc_id, lang, unnest(string_split(t, '')) AS c, unnest(range(1, length(t) + 1)) AS i FROM lowered),
p_runs AS (
  SELECT lang, c AS g1, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2
  FROM p_chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
p_grams AS (
  SELECT lang, unnest([g1, g1 || c1, g1 || c1 || c2]) AS gram FROM p_runs),
gram_counts AS (SELECT lang, gram, count(*) AS n FROM p_grams WHERE gram IS NOT NULL GROUP BY lang, gram),
kinds AS (SELECT length(gram) AS size, count(DISTINCT gram) AS k FROM gram_counts GROUP BY 1),
mass AS (
  SELECT l.lang, k.size, coalesce(sum(n), 0) + any_value(k.k) AS mass
  FROM (SELECT DISTINCT lang FROM gram_counts) l CROSS JOIN kinds k
  LEFT JOIN gram_counts c ON c.lang = l.lang AND length(c.gram) = k.size GROUP BY l.lang, k.size),
all_grams AS (SELECT DISTINCT gram FROM gram_counts),
profile AS MATERIALIZED (
  SELECT g.gram, m.lang, round(ln((coalesce(c.n, 0) + 1) / m.mass::DOUBLE) * 1000000)::BIGINT AS micro
  FROM all_grams g JOIN mass m ON m.size = length(g.gram) LEFT JOIN gram_counts c ON c.gram = g.gram AND c.lang = m.lang)"""
)


def detection(source: str, min_chars: int = 3) -> str:
    """language and language_score of the texts in source (seq, text)."""
    return f"""
d_chars AS (
  SELECT seq, unnest(string_split(t, '')) AS c, unnest(range(1, length(t) + 1)) AS i
  FROM (SELECT seq, regexp_replace(lower(text), '{WS}+', ' ', 'g') AS t FROM {source} WHERE text IS NOT NULL)
  WHERE length(trim(t, ' ')) >= {min_chars}),
d_runs AS (
  SELECT seq, c AS g1, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2
  FROM d_chars WINDOW w AS (PARTITION BY seq ORDER BY i)),
d_grams AS (
  SELECT seq, gram, count(*) AS n
  FROM (SELECT seq, unnest([g1, g1 || c1, g1 || c1 || c2]) AS gram FROM d_runs) WHERE gram IS NOT NULL GROUP BY seq, gram),
d_scores AS (
  SELECT seq, lang, sum(n * micro) AS score FROM d_grams JOIN profile USING (gram) GROUP BY seq, lang),
d_best AS (SELECT seq, max(score) AS top FROM d_scores GROUP BY seq),
detected AS (
  SELECT seq, min(CASE WHEN score = top THEN lang END) AS language,
         round(1.0 / sum(exp((score - top) / 1000000.0)), 6) AS language_score
  FROM d_scores JOIN d_best USING (seq) GROUP BY seq)"""


LANG = cleaned() + "," + PROFILE + "," + detection("cleaned") + """,
outcome AS (
  SELECT c.seq, c.length_before, d.language, d.language_score,
         CASE WHEN c.drop_reason IS NOT NULL THEN c.drop_reason
              WHEN coalesce(d.language, '') <> 'en' THEN 'language_filtered_' || coalesce(d.language, 'None') END AS drop_reason,
         c.text AS clean_text
  FROM cleaned c LEFT JOIN detected d USING (seq)),
allowed AS (
  SELECT *, drop_reason IS NOT NULL AS dropped, CASE WHEN drop_reason IS NULL THEN clean_text END AS text FROM outcome)"""

# --------------------------------------------------------------- signatures


def shingle_sets(source: str) -> str:
    return f"""
s_chars AS (
  SELECT seq, unnest(string_split(t, '')) AS c, unnest(range(1, length(t) + 1)) AS i
  FROM (SELECT seq, regexp_replace(lower(text), '{WS}+', ' ', 'g') AS t FROM {source})),
shingles AS (
  SELECT DISTINCT seq, c || lead(c, 1) OVER w || lead(c, 2) OVER w || lead(c, 3) OVER w || lead(c, 4) OVER w AS gram,
         unicode(c) AS c0, unicode(lead(c, 1) OVER w) AS c1, unicode(lead(c, 2) OVER w) AS c2,
         unicode(lead(c, 3) OVER w) AS c3, unicode(lead(c, 4) OVER w) AS c4
  FROM s_chars WINDOW w AS (PARTITION BY seq ORDER BY i))"""


def affine_signatures(source: str) -> str:
    a, b = M.affine_coefficients(PERMS)
    table = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(zip(a, b)))
    h = "c0::BIGINT"
    for j in range(1, 5):
        h = f"(({h}) * {M.RADIX} + c{j}) % {M.PRIME}"
    return (
        shingle_sets(source)
        + f""",
perms(perm, a, b) AS (VALUES {table}),
poly AS (SELECT DISTINCT seq, {h} AS h0 FROM shingles WHERE gram IS NOT NULL),
mixed AS (SELECT seq, (xor(h0, h0 >> 15) * {M.MIXER}) % {M.PRIME} AS h1 FROM poly),
hashes AS (SELECT seq, xor(h1, h1 >> 13) AS h FROM mixed),
signature AS MATERIALIZED (
  SELECT seq, perm::BIGINT AS perm, min((h * a + b) % {M.PRIME}) AS value
  FROM hashes CROSS JOIN perms GROUP BY seq, perm)"""
    )


def sha1_signatures(source: str) -> str:
    return (
        shingle_sets(source)
        + f""",
kinds5 AS (SELECT DISTINCT gram FROM shingles WHERE gram IS NOT NULL),
digests AS (
  SELECT gram, p AS perm, sha1(gram || '_' || p) AS d
  FROM kinds5, (SELECT unnest(range(0, {PERMS})) AS p)),
signature AS MATERIALIZED (
  SELECT seq, perm::BIGINT AS perm, min(d) AS value
  FROM shingles JOIN digests USING (gram) GROUP BY seq, perm)"""
    )


ROWS = PERMS // LSH_BANDS
BANDS = f""",
sigs AS MATERIALIZED (SELECT seq, list(value ORDER BY perm) AS sig FROM signature GROUP BY seq),
bands AS MATERIALIZED (
  SELECT seq, band, sig[band * {ROWS} + 1 : band * {ROWS} + {ROWS}] AS key
  FROM sigs, (SELECT unnest(range(0, {LSH_BANDS})) AS band))"""

PAIRS = f""",
candidates AS (
  SELECT DISTINCT l.seq AS a, r.seq AS b FROM bands l JOIN bands r ON l.band = r.band AND l.key = r.key AND l.seq < r.seq),
verified AS (
  SELECT a, b FROM candidates JOIN sigs l ON l.seq = a JOIN sigs r ON r.seq = b
  WHERE len(list_filter(list_zip(l.sig, r.sig), lambda z: z[1] = z[2])) / {PERMS}.0 >= {THRESHOLD}),
earlier AS (SELECT b, list(a) AS earlier, row_number() OVER (ORDER BY b) AS rn FROM verified GROUP BY b),
walk(rn, gone) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT e.rn, CASE WHEN len(list_filter(e.earlier, lambda x: NOT list_contains(w.gone, x))) > 0
                    THEN list_append(w.gone, e.b) ELSE w.gone END
  FROM walk w JOIN earlier e ON e.rn = w.rn + 1),
later AS (SELECT unnest(gone) AS seq FROM walk WHERE rn = (SELECT max(rn) FROM walk))"""


def greedy(signatures: str, source: str) -> str:
    return f"""WITH RECURSIVE {KEPT},{signatures}{BANDS}{PAIRS}
SELECT seq, seq IN (SELECT seq FROM later) AS is_duplicate FROM {source}"""


def exact_flags(source: str) -> str:
    return f"SELECT seq, row_number() OVER (PARTITION BY sha256(text) ORDER BY seq) > 1 AS is_duplicate FROM {source}"


# --------------------------------------------------------------- whole runs

LANG_PII = LANG + "," + spans("allowed", "seq", RULES) + f""",
hits AS (SELECT seq, count(*) AS pii_count FROM spans GROUP BY seq),
redacted AS (
  SELECT a.seq, a.length_before, a.language, a.language_score, a.drop_reason, {redacted('a.text')} AS text,
         CASE WHEN a.text IS NOT NULL THEN coalesce(h.pii_count, 0) END AS pii_count
  FROM allowed a LEFT JOIN hits h USING (seq)),
live AS (SELECT seq, text FROM redacted WHERE text IS NOT NULL)"""


def run(flags: str) -> str:
    return f""",
flags AS ({flags}),
processed AS (
  SELECT r.seq, r.text, r.length_before, coalesce(r.drop_reason, CASE WHEN f.is_duplicate THEN 'duplicate' END) AS drop_reason,
         r.language, r.language_score, f.is_duplicate, r.pii_count > 0 AS has_pii, r.pii_count > 0 AS pii_redacted,
         r.pii_count::BIGINT AS pii_count, length(r.text)::BIGINT AS length
  FROM redacted r LEFT JOIN flags f USING (seq)),
final AS (SELECT *, drop_reason IS NOT NULL AS dropped FROM processed)"""


EXACT_RUN = "WITH " + LANG_PII + run(exact_flags("live"))
NEAR_RUN = (
    "WITH RECURSIVE "
    + LANG_PII
    + ","
    + affine_signatures("live")
    + BANDS
    + PAIRS
    + run("SELECT seq, seq IN (SELECT seq FROM later) AS is_duplicate FROM live")
)
ROWS_OUT = """
SELECT seq, text, dropped, drop_reason, language, is_duplicate, has_pii, pii_redacted,
       coalesce(pii_count, 0) AS pii_count, coalesce(length, 0) AS length FROM final"""

SUMMARY = """
SELECT count(*) AS total_samples, count(*) AS total_processed,
       count(*) FILTER (NOT dropped AND length > 0) AS cleaned_text_count,
       count(*) FILTER (dropped) AS total_dropped,
       sum(length_before)::BIGINT AS chars_before,
       coalesce(sum(length) FILTER (NOT dropped), 0)::BIGINT AS chars_after FROM final"""

DUPLICATES = """
SELECT count(*) AS total_samples, count(*) FILTER (is_duplicate) AS duplicate_count,
       count(*) - count(*) FILTER (is_duplicate) AS unique_count,
       count(*) FILTER (is_duplicate) / count(*)::DOUBLE AS duplicate_rate
FROM final WHERE language IS NOT NULL"""

REPORT = f""",
summary AS ({SUMMARY}),
dups AS ({DUPLICATES}),
texts AS (SELECT length AS v FROM final WHERE NOT dropped),
final_hits AS (
  SELECT type, count(*) AS hits FROM spans JOIN final USING (seq) WHERE NOT dropped GROUP BY type),
langs AS (
  SELECT language, count(*) AS n, avg(language_score) AS mean, quantile_cont(language_score, 0.5) AS med
  FROM final WHERE language IS NOT NULL AND language_score <> 0 GROUP BY language),
metrics(metric, value) AS (
  SELECT 'total_samples', total_samples::DOUBLE FROM summary
  UNION ALL SELECT 'total_processed', total_processed FROM summary
  UNION ALL SELECT 'total_dropped', total_dropped FROM summary
  UNION ALL SELECT 'chars_before', chars_before FROM summary
  UNION ALL SELECT 'chars_after', chars_after FROM summary
  UNION ALL SELECT 'duplicate_count', duplicate_count FROM dups
  UNION ALL SELECT 'unique_count', unique_count FROM dups
  UNION ALL SELECT 'duplicate_rate', duplicate_rate FROM dups
  UNION ALL SELECT 'total_pii_hits', coalesce(sum(hits), 0) FROM final_hits
  UNION ALL SELECT 'cleaned_text_count', count(*) FROM texts
  UNION ALL SELECT 'cleaned_text_min', min(v) FROM texts
  UNION ALL SELECT 'cleaned_text_max', max(v) FROM texts
  UNION ALL SELECT 'cleaned_text_mean', avg(v) FROM texts
  UNION ALL SELECT 'cleaned_text_median', quantile_disc(v, 0.5 ORDER BY v DESC) FROM texts
  UNION ALL SELECT 'cleaned_text_std', stddev_pop(v) FROM texts
  UNION ALL SELECT 'cleaned_text_p25', quantile_cont(v, 0.25) FROM texts
  UNION ALL SELECT 'cleaned_text_p75', quantile_cont(v, 0.75) FROM texts
  UNION ALL SELECT 'cleaned_text_p90', quantile_cont(v, 0.9) FROM texts
  UNION ALL SELECT 'cleaned_text_p95', quantile_cont(v, 0.95) FROM texts
  UNION ALL SELECT 'cleaned_text_p99', quantile_cont(v, 0.99) FROM texts
  UNION ALL SELECT 'drop_reasons.' || drop_reason, count(*) FROM final WHERE dropped GROUP BY drop_reason
  UNION ALL SELECT language || '_count', n FROM langs
  UNION ALL SELECT language || '_mean_score', mean FROM langs
  UNION ALL SELECT language || '_median_score', med FROM langs
  UNION ALL SELECT 'pii_type_counts.' || type, hits FROM final_hits
  UNION ALL SELECT type || '_hit_rate', hits / (SELECT sum(hits) FROM final_hits) FROM final_hits)
SELECT metric, round(value, 6) AS value FROM metrics"""

# ----------------------------------------------------------------- mixtures

TOTAL_WEIGHT = sum(WEIGHTS.values())
WEIGHT_CASE = "CASE dataset " + " ".join(f"WHEN '{k}' THEN {v / TOTAL_WEIGHT!r}::DOUBLE" for k, v in WEIGHTS.items()) + " ELSE 0.0::DOUBLE END"
SIZES = f"""
docs AS (SELECT doc_id AS seq, lang AS dataset, text FROM documents),
sizes AS (
  SELECT dataset, {WEIGHT_CASE} AS weight, count(*) AS available, floor(count(*) * {WEIGHT_CASE})::BIGINT AS samples
  FROM docs GROUP BY dataset)"""
SAMPLE = SIZES + f""",
drawn AS (
  SELECT d.*, s.samples, row_number() OVER (PARTITION BY dataset ORDER BY md5('{SEED}:' || dataset || ':' || seq), seq) AS place
  FROM docs d JOIN sizes s USING (dataset)),
chosen AS (SELECT dataset, seq, text FROM drawn WHERE place <= samples)"""

# -------------------------------------------------------------------- words

WORDS = f"words AS (SELECT doc_id AS seq, text, regexp_extract_all(strip_accents(lower(text)), '{WORD}') AS w FROM documents)"
FIRST_ID = len(SPECIAL_TOKENS)
SPELLED = f"""
letters AS (SELECT DISTINCT unnest(string_split(array_to_string(w, ''), '')) AS c FROM words),
alphabet AS (SELECT c AS token, {FIRST_ID - 1} + row_number() OVER (ORDER BY unicode(c)) AS id FROM letters WHERE c <> ''),
spelled AS (
  SELECT seq, list(id ORDER BY i) AS ids, list(token ORDER BY i) AS tokens FROM (
    SELECT seq, unnest(string_split(array_to_string(w, ''), '')) AS token, unnest(range(1, length(array_to_string(w, '')) + 1)) AS i
    FROM words) JOIN alphabet USING (token) GROUP BY seq)"""
ALPHABET = WORDS + "," + SPELLED
RETAINED = f""",
words AS (
  SELECT seq, text, regexp_extract_all(strip_accents(lower(text)), '{WORD}') AS w FROM final WHERE NOT dropped),
""" + SPELLED
def merge_steps(kind: str, words: str, text: str) -> str:
    """Clauses for the first ``MERGES`` merges over the words of a relation (seq, w, an array), each one step.

    Symbols of a word are ids between commas.  ``v`` ends as the vocabulary (id, token), ``s`` as the
    words with their symbols.
    """
    piece = "c" if kind == "bpe" else "CASE WHEN i > 1 THEN '##' || c ELSE c END"
    order = "unicode(token)" if kind == "bpe" else "starts_with(token, '##') AND length(token) > 1, unicode(CASE WHEN length(token) > 1 THEN token[3:] ELSE token END)"
    # Every character that occurs has a symbol that starts a word.
    extra = "" if kind == "bpe" else " UNION SELECT c FROM letters"
    out = f"""
{text}
w0 AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM {words}) GROUP BY word),
letters AS (SELECT word, unnest(string_split(word, '')) AS c, unnest(range(1, length(word) + 1)) AS i FROM w0),
pieces AS (SELECT word, {piece} AS token, i FROM letters),
v0 AS MATERIALIZED (
  SELECT token, {FIRST_ID - 1} + row_number() OVER (ORDER BY {order}) AS id
  FROM (SELECT token FROM pieces{extra}) GROUP BY token),
s0 AS MATERIALIZED (
  SELECT word, any_value(n) AS n, ',' || string_agg(id, ',,' ORDER BY i) || ',' AS s
  FROM pieces JOIN v0 USING (token) JOIN w0 USING (word) GROUP BY word)"""
    right = "r.token" if kind == "bpe" else "CASE WHEN starts_with(r.token, '##') AND length(r.token) > 2 THEN r.token[3:] ELSE r.token END"
    for k in range(1, MERGES + 1):
        out += f""",
p{k} AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT n, unnest(list_zip(ids[1 : len(ids) - 1], ids[2 : len(ids)])) AS z
    FROM (SELECT n, string_split(s[2 : length(s) - 1], ',,') AS ids FROM s{k - 1}) WHERE len(ids) > 1),
    (SELECT 1), LATERAL (SELECT z[1]::BIGINT AS a, z[2]::BIGINT AS b)
  GROUP BY a, b ORDER BY sum(n) DESC, a, b LIMIT 1),
v{k} AS MATERIALIZED (
  SELECT token, id FROM v{k - 1}
  UNION ALL SELECT l.token || {right}, (SELECT max(id) + 1 FROM v{k - 1}) FROM p{k} JOIN v{k - 1} l ON l.id = a JOIN v{k - 1} r ON r.id = b),
s{k} AS MATERIALIZED (
  SELECT word, n, replace(s, ',' || a || ',,' || b || ',', ',' || (SELECT max(id) FROM v{k}) || ',') AS s FROM s{k - 1}, p{k})"""
    return out


SPECIALS = ", ".join(f"({i}, '{t}')" for i, t in enumerate(SPECIAL_TOKENS))


def first_vocabulary(kind: str) -> str:
    return f"""WITH {merge_steps(kind, "words", WORDS + ",")}
SELECT id, token FROM v{MERGES} UNION ALL SELECT * FROM (VALUES {SPECIALS})"""


FIRST_ENCODED = f"""WITH {merge_steps("bpe", "words", WORDS + ",")},
cells AS (SELECT seq, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
coded_words AS (
  SELECT seq, string_agg(replace(s[2 : length(s) - 1], ',,', ' '), ' ' ORDER BY place) AS token_ids
  FROM cells JOIN s{MERGES} USING (word) GROUP BY seq),
encoded AS (
  SELECT seq, coalesce(token_ids, '') AS token_ids,
         CASE WHEN token_ids IS NULL THEN 0 ELSE len(string_split(token_ids, ' ')) END AS token_length
  FROM words LEFT JOIN coded_words USING (seq))"""


ORACLES = {
    "a1_jsonl_extract": """
SELECT doc_id AS seq, CASE WHEN lang IN ('en', 'fr') THEN text END AS text, lang NOT IN ('en', 'fr') AS malformed
FROM documents WHERE lang <> 'de'""",
    "a4_load_files": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seq, text FROM documents",
    "a7_ledger_antijoin": """
WITH named AS (SELECT page_id, url, string_split(url, '/')[-1] AS name FROM pages)
SELECT page_id, url, name FROM named WHERE name NOT IN (SELECT name FROM named WHERE url LIKE 'https:%')""",
    "a8_head_sample": "SELECT doc_id AS seq, text FROM documents ORDER BY doc_id LIMIT 100",
    "a10_nonempty": f"WITH {cleaned()} SELECT seq, text FROM cleaned WHERE text <> ''",
    "c5_control_intent": None,
    "c5_control_parity": None,
    "c7_clean_text": f"WITH {cleaned(high=5000)} SELECT seq, text, drop_reason IS NOT NULL AS dropped, drop_reason FROM cleaned",
    "c8_drop_counts": f"""WITH {cleaned(high=5000)}
SELECT drop_reason, count(*) AS records FROM cleaned WHERE drop_reason IS NOT NULL GROUP BY drop_reason""",
    "c9_normalize_ws": f"""
SELECT doc_id AS seq, regexp_replace(regexp_replace(regexp_replace(text, ' +', ' ', 'g'), '\\n\\n+', chr(10) || chr(10), 'g'),
       '^{WS}+|{WS}+$', '', 'g') AS text FROM documents""",
    "c10_remove_urls": f"SELECT page_id, regexp_replace(url || ' ' || html || ' ' || url, '{URL}', '', 'g') AS text FROM pages",
    "c11_remove_emails": f"WITH {PERSON_TEXTS} SELECT id, regexp_replace(text, '{EMAIL}', '', 'g') AS text FROM person_texts",
    "c12_cleaning_totals": f"""WITH {cleaned(high=5000)}
SELECT count(*) AS total_processed, count(*) FILTER (drop_reason IS NOT NULL) AS total_dropped,
       sum(length_before)::BIGINT AS chars_before, sum(length(text))::BIGINT AS chars_after FROM cleaned""",
    "c13_valid_rows": f"WITH {cleaned(high=5000)} SELECT seq, length_before FROM cleaned WHERE drop_reason IS NULL",
    "c14_project_ids": f"{FIRST_ENCODED} SELECT token_ids FROM encoded",
    "c15_size_report": f"""{FIRST_ENCODED},
coded AS (
  SELECT seq, text, CASE WHEN token_ids = '' THEN [] ELSE string_split(token_ids, ' ')::INTEGER[] END AS token_ids
  FROM encoded JOIN words USING (seq)),
sizes AS (
  SELECT sum(strlen(to_json({{'seq': seq, 'text': text, 'token_ids': token_ids}})::VARCHAR) + 1)::BIGINT AS input_bytes,
         sum(strlen(to_json({{'token_ids': token_ids}})::VARCHAR) + 1)::BIGINT AS output_bytes FROM coded)
SELECT input_bytes, output_bytes, round(input_bytes / 1048576.0::DOUBLE, 6) AS input_mb, round(output_bytes / 1048576.0::DOUBLE, 6) AS output_mb,
       round(100.0::DOUBLE * (input_bytes - output_bytes) / input_bytes, 6) AS reduction_pct FROM sizes""",
    "l1_detect": f"WITH {LANG} SELECT seq, language, language_score FROM outcome",
    "l2_detect_simple": f"""WITH {PROFILE}, docs AS (SELECT doc_id AS seq, text FROM documents), {detection('docs')}
SELECT seq, language FROM docs LEFT JOIN detected USING (seq)""",
    "l3_filter_by_language": f"""WITH {PROFILE}, docs AS (SELECT doc_id AS seq, text FROM documents), {detection('docs')}
SELECT seq, coalesce(language IN ('en', 'es'), false) AS is_allowed, language FROM docs LEFT JOIN detected USING (seq)""",
    "l4_allow_list": f"WITH {LANG} SELECT seq, text, dropped, drop_reason FROM allowed",
    "l6_language_counts": f"WITH {LANG} SELECT language, count(*) AS records FROM outcome GROUP BY language",
    "l7_profile_counts": f"WITH {PROFILE} SELECT lang, gram, n FROM gram_counts",
    "l7_profile": f"WITH {PROFILE} SELECT gram, lang, micro FROM profile",
    "d1_content_hash": "SELECT doc_id AS seq, sha256(text) AS hash FROM documents",
    "d2_exact_dedup": f"WITH {KEPT} {exact_flags('kept')}",
    "d3_shingle_counts": f"""WITH docs AS (SELECT doc_id AS seq, text FROM documents), {shingle_sets('docs')}
SELECT seq, count(DISTINCT gram) AS shingles FROM shingles GROUP BY seq""",
    "d4_signature_affine": f"WITH {KEPT},{affine_signatures('kept')} SELECT seq, perm, value FROM signature",
    "d4_signature_sha1": f"WITH {KEPT},{sha1_signatures('kept')} SELECT seq, perm, value AS digest FROM signature",
    "d5_bucket_sizes": f"""WITH {KEPT},{affine_signatures('kept')}{BANDS}
SELECT band, n, count(*) AS buckets FROM (SELECT band, key, count(*) AS n FROM bands GROUP BY band, key HAVING count(*) > 1)
GROUP BY band, n""",
    "d6_candidates": f"""WITH {KEPT},{affine_signatures('kept')}{BANDS}
SELECT seq, bool_or(seq > first) AS has_candidate
FROM (SELECT seq, min(seq) OVER (PARTITION BY band, key) AS first FROM bands) GROUP BY seq""",
    "d7_leader_similarity": f"""WITH {KEPT},{affine_signatures('kept')}{BANDS},
led AS (SELECT DISTINCT min(seq) OVER (PARTITION BY band, key) AS a, seq AS b FROM bands)
SELECT a, b, len(list_filter(list_zip(l.sig, r.sig), lambda z: z[1] = z[2])) / {PERMS}::DOUBLE AS similarity
FROM led JOIN sigs l ON l.seq = a JOIN sigs r ON r.seq = b WHERE a < b""",
    "d8_greedy_keep_first": greedy(affine_signatures("kept"), "kept"),
    "d8_greedy_sha1": greedy(sha1_signatures("kept"), "kept"),
    "d11_filter_duplicates": f"WITH {KEPT}, flags AS ({exact_flags('kept')}) SELECT seq, text FROM kept JOIN flags USING (seq) WHERE NOT is_duplicate",
    "d12_dedup_totals": f"""WITH {KEPT}, flags AS ({exact_flags('kept')})
SELECT count(*) AS total_checked, count(*) FILTER (is_duplicate) AS duplicates_found,
       count(*) FILTER (NOT is_duplicate) AS unique_items FROM flags""",
    "d13_dedup_job": f"""WITH {cleaned()}, kept AS (SELECT seq, text FROM cleaned WHERE text IS NOT NULL),
flags AS ({exact_flags('kept')}),
o AS (SELECT drop_reason, is_duplicate FROM cleaned LEFT JOIN flags USING (seq))
SELECT count(*) AS total, count(*) FILTER (NOT is_duplicate) AS "unique", count(*) FILTER (is_duplicate) AS duplicates,
       count(*) FILTER (drop_reason LIKE 'too_short%') AS too_short, count(*) FILTER (drop_reason LIKE 'too_long%') AS too_long,
       count(*) FILTER (drop_reason LIKE 'empty%') AS empty,
       100.0::DOUBLE * count(*) FILTER (is_duplicate) / count(*) AS duplicate_rate FROM o""",
    "d14_inline_marking": f"""WITH {KEPT}, flags AS ({exact_flags('kept')})
SELECT seq, drop_reason IS NOT NULL AS dropped, is_duplicate, coalesce(length({redacted('text')}), 0)::BIGINT AS length
FROM cleaned LEFT JOIN flags USING (seq)""",
    "p1_email": f"WITH {PERSON_TEXTS} SELECT id, unnest(regexp_extract_all(text, '{EMAIL}')) AS match FROM person_texts",
    "p2_phone": f"WITH {PERSON_TEXTS} SELECT id, unnest(regexp_extract_all(text, '{PHONE}')) AS match FROM person_texts",
    "p3_ssn": f"WITH {PERSON_TEXTS} SELECT id, unnest(regexp_extract_all(text, '{SSN}')) AS match FROM person_texts",
    "p4_spans": f"""WITH {SPANS} SELECT id, type, start, start + length(match) AS "end", score, match FROM spans""",
    "p7_redact": f"WITH {PERSON_TEXTS} SELECT id, {redacted('text')} AS text FROM person_texts",
    "p9_has_pii": f"""WITH {PERSON_TEXTS}
SELECT id, regexp_matches(text, '{EMAIL}') OR regexp_matches(text, '{PHONE}') OR regexp_matches(text, '{SSN}') AS has_pii FROM person_texts""",
    "p10_score_threshold": f"WITH {SPANS} SELECT type, count(*) AS hits FROM spans WHERE score >= 0.85 GROUP BY type",
    "p11_type_counts": f"WITH {SPANS} SELECT type, count(*) AS hits FROM spans GROUP BY type",
    "p11_detection_totals": f"WITH {SPANS} SELECT (SELECT count(*) FROM person_texts) AS total_checked, count(*) AS total_pii_found FROM spans",
    "p12_annotation": f"""WITH {SPANS}, hits AS (SELECT id, count(*) AS n FROM spans GROUP BY id)
SELECT id, coalesce(n, 0) > 0 AS has_pii, coalesce(n, 0) > 0 AS pii_redacted, coalesce(n, 0) AS pii_count,
       length({redacted('text')})::BIGINT AS length FROM person_texts LEFT JOIN hits USING (id)""",
    "p14_rule_table": f"""WITH {PERSON_TEXTS},{spans('person_texts', 'id', [*RULES, ('NUMBER', r'\b\d{5,}\b', 0.6)])}
SELECT id, type, start, start + length(match) AS "end", score, match FROM spans""",
    "t1_normalize": "SELECT doc_id AS seq, strip_accents(lower(text)) AS text FROM documents",
    "t2_pretokenize": f"WITH {WORDS} SELECT seq, array_to_string(w, ' ') AS words FROM words",
    "t3_word_counts": f"WITH {WORDS} SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM words) GROUP BY word",
    "t4_alphabet": f"WITH {ALPHABET} SELECT id, token FROM alphabet UNION ALL SELECT * FROM (VALUES {SPECIALS})",
    "t4_pair_counts": f"""WITH {ALPHABET},
cells AS (
  SELECT k, i, id FROM (
    SELECT k, unnest(string_split(word, '')) AS token, unnest(range(1, length(word) + 1)) AS i
    FROM (SELECT word, row_number() OVER () AS k FROM (SELECT unnest(w) AS word FROM words))) JOIN alphabet USING (token)),
pairs AS (SELECT id AS "left", lead(id) OVER (PARTITION BY k ORDER BY i) AS "right" FROM cells)
SELECT "left", "right", count(*) AS n FROM pairs WHERE "right" IS NOT NULL GROUP BY ALL""",
    "t7_encode_characters": f"WITH {ALPHABET} SELECT seq, array_to_string(ids, ' ') AS token_ids, len(ids) AS token_length FROM spelled",
    "t9_decode_characters": f"WITH {ALPHABET} SELECT seq, array_to_string(tokens, ' ') AS decoded FROM spelled",
    "t10_token_totals": f"""{FIRST_ENCODED}
SELECT count(*) AS total_sequences, sum(token_length)::BIGINT AS total_tokens, round(sum(token_length) / count(*)::DOUBLE, 6) AS avg_sequence_length
FROM encoded""",
    "e2_shards": """
WITH placed AS (SELECT doc_id, n_chars, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS shard FROM documents)
SELECT shard, count(*) AS records, min(doc_id) AS first, max(doc_id) AS last, sum(n_chars)::BIGINT AS chars FROM placed GROUP BY shard""",
    "e4_sample_sizes": f"WITH {SIZES} SELECT dataset, round(weight, 9) AS weight, available, samples FROM sizes",
    "e6_mixture_sample": f"WITH {SAMPLE} SELECT dataset, seq, text FROM chosen",
    "e7_mixture_order": f"""WITH {SAMPLE}
SELECT dataset, seq, row_number() OVER (ORDER BY md5('{SEED + 1}:' || dataset || ':' || seq), seq) - 1 AS index FROM chosen""",
    "e8_mixture_metadata": f"""WITH {SIZES}
SELECT string_agg(dataset, ',' ORDER BY dataset) AS datasets,
       string_agg(dataset || '=' || samples, ',' ORDER BY dataset) AS samples_per_dataset, sum(samples)::BIGINT AS total_samples FROM sizes""",
    "i1_length_stats": """
SELECT 'text' AS name, count(*) AS count, min(n_chars) AS min, max(n_chars) AS max, round(avg(n_chars), 6) AS mean,
       round(median(n_chars), 6) AS median, round(stddev_pop(n_chars), 6) AS std,
       round(quantile_cont(n_chars, 0.25), 6) AS p25, round(quantile_cont(n_chars, 0.75), 6) AS p75,
       round(quantile_cont(n_chars, 0.9), 6) AS p90, round(quantile_cont(n_chars, 0.95), 6) AS p95,
       round(quantile_cont(n_chars, 0.99), 6) AS p99 FROM documents""",
    "i2_histogram": """
WITH s AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi, avg(n_chars) AS mean, median(n_chars) AS median FROM documents),
b AS (SELECT unnest(range(0, 50)) AS bin),
f AS (SELECT least((n_chars - lo) * 50 // (hi - lo), 49) AS bin, count(*) AS n FROM documents, s GROUP BY 1)
SELECT 'text' AS name, bin, round(lo + bin * (hi - lo)::DOUBLE / 50, 6) AS bin_low, round(lo + (bin + 1) * (hi - lo)::DOUBLE / 50, 6) AS bin_high,
       coalesce(n, 0) AS n, round(mean, 6) AS mean, round(median, 6) AS median FROM s, b LEFT JOIN f USING (bin)""",
    "i3_drop_reasons": f"WITH {LANG} SELECT drop_reason, count(*) AS records FROM allowed WHERE dropped GROUP BY drop_reason",
    "i4_language_stats": f"""WITH {LANG}
SELECT language, count(*) AS records, round(avg(language_score), 6) AS mean_score, round(quantile_cont(language_score, 0.5), 6) AS median_score
FROM outcome WHERE language IS NOT NULL AND language_score <> 0 GROUP BY language""",
    "i5_language_box": """
WITH o AS (SELECT o_orderpriority AS language, round(o_totalprice / 1000000, 4) AS s FROM orders WHERE round(o_totalprice / 1000000, 4) <> 0),
q AS (SELECT language, quantile_cont(s, 0.25) AS q1, quantile_cont(s, 0.5) AS med, quantile_cont(s, 0.75) AS q3 FROM o GROUP BY language),
j AS (SELECT o.language, s, q1, med, q3, s BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside FROM o JOIN q USING (language))
SELECT language, round(q1, 6) AS q1, round(med, 6) AS med, round(q3, 6) AS q3,
       round(least(min(s) FILTER (inside), q1), 6) AS whisker_low, round(greatest(max(s) FILTER (inside), q3), 6) AS whisker_high,
       count(*) FILTER (NOT inside) AS outliers FROM j GROUP BY language, q1, med, q3""",
    "i11_ranked_languages": """
SELECT o_orderpriority AS language, count(*) AS records, round(avg(round(o_totalprice / 1000000, 4)), 6) AS mean_score,
       round(quantile_cont(round(o_totalprice / 1000000, 4), 0.5), 6) AS median_score
FROM orders WHERE round(o_totalprice / 1000000, 4) <> 0 GROUP BY 1 ORDER BY records DESC, language""",
    "i6_duplicate_stats": f"{EXACT_RUN} SELECT total_samples, duplicate_count, unique_count, round(duplicate_rate, 9) AS duplicate_rate FROM ({DUPLICATES})",
    "i7_pii_hits": f"""WITH {SPANS}
SELECT type, count(*) AS hits, (SELECT count(*) FROM spans) AS total_hits, round(count(*) / (SELECT count(*) FROM spans)::DOUBLE, 9) AS hit_rate
FROM spans GROUP BY type""",
    "i8_summary": f"{EXACT_RUN} {SUMMARY}",
    "i9_upper_median": "SELECT 'text' AS name, quantile_disc(n_chars, 0.5 ORDER BY n_chars DESC) AS upper_median FROM documents",
    "i12_headline": f"""{EXACT_RUN}
SELECT count(*)::DOUBLE AS total_samples, count(*) FILTER (NOT dropped)::DOUBLE AS cleaned_text_count, count(*) FILTER (dropped)::DOUBLE AS total_dropped,
       0.0::DOUBLE AS total_sequences, 0.0::DOUBLE AS total_tokens, 0.0::DOUBLE AS avg_sequence_length FROM final""",
    "r1_process_exact": EXACT_RUN + ROWS_OUT,
    "r2_full_run": NEAR_RUN + ROWS_OUT,
    "r2_report": NEAR_RUN + REPORT,
    "r3_stream_chunks": EXACT_RUN + ROWS_OUT,
}

ORACLES |= {
    "l5_confidence": f"""WITH {LANG}, strict AS (
  SELECT seq, CASE WHEN drop_reason IS NOT NULL THEN drop_reason
              WHEN coalesce(language_score, 0) < 0.999999 THEN 'language_filtered_' || coalesce(language, 'None') END AS drop_reason
  FROM outcome)
SELECT seq, drop_reason IS NOT NULL AS dropped, drop_reason FROM strict""",
    "i11_ranked_pii": f"""WITH {SPANS}
SELECT type, count(*) AS hits, round(count(*) / (SELECT count(*) FROM spans)::DOUBLE, 9) AS hit_rate FROM spans GROUP BY type""",
    "a1_read_jsonl": ORACLES["a4_load_files"],
    "a2_read_json": "SELECT text FROM benchmark",
    "a3_read_txt": "SELECT text FROM benchmark",
    "a11_dedup_job_files": ORACLES["d13_dedup_job"],
    "e1_jsonl_read_back": f"WITH {KEPT} SELECT seq, text FROM kept",
    "e3_shards_read_back": f"SELECT lpad(shard::VARCHAR, 5, '0') AS shard, records, first, last, chars FROM ({ORACLES['e2_shards']})",
    "e10_mixture_read_back": ORACLES["e6_mixture_sample"],
    "r2_files_to_files": f"{NEAR_RUN} SELECT text, language, coalesce(pii_count, 0)::BIGINT AS pii_count, length::BIGINT AS length FROM final WHERE NOT dropped",
    "r4_clean_job": f"WITH {cleaned()} SELECT text, drop_reason IS NOT NULL AS dropped, drop_reason FROM cleaned",
}



I5_DETECTED = f"WITH {LANG}, o AS (SELECT seq, language, language_score AS s FROM outcome WHERE language IS NOT NULL AND language_score <> 0)," + """
q AS (SELECT language, quantile_cont(s, 0.25) AS q1, quantile_cont(s, 0.5) AS med, quantile_cont(s, 0.75) AS q3 FROM o GROUP BY language),
j AS (SELECT seq, o.language, s, q1, med, q3, s BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside FROM o JOIN q USING (language))"""
_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_BOX = ORACLES["i5_language_box"]

ORACLES |= {
    "a6_list_files": "SELECT name FROM (VALUES " + ", ".join(f"('{n}.parquet')" for n in _NAMES) + ") AS t(name)",
    "a8_head_tenth": "SELECT doc_id AS seq, text FROM documents ORDER BY doc_id LIMIT (SELECT count(*) // 10 FROM documents)",
    "l6_detection_totals": f"WITH {LANG} SELECT count(language) AS total_detected, count(*) FILTER (language IS NULL) AS detection_failures FROM outcome",
    "l8_words": f"""WITH {PROFILE}, {WORDS},
kinds_of_words AS (SELECT DISTINCT unnest(w) AS text FROM words), spoken AS (SELECT text AS seq, text FROM kinds_of_words), {detection('spoken', 1)}
SELECT text AS word, language, language_score FROM spoken LEFT JOIN detected USING (seq)""",
    "d15_index_two_runs": ORACLES["d8_greedy_keep_first"],
    "t4_bpe_first_merges": first_vocabulary("bpe"),
    "t5_wordpiece_first_merges": first_vocabulary("wordpiece"),
    "t6_saved_vocabulary": first_vocabulary("bpe"),
    "t7_encode_first_merges": f"{FIRST_ENCODED} SELECT seq, token_ids, token_length FROM encoded",
    "t9_round_trip": f"WITH {WORDS} SELECT seq, array_to_string(w, '') AS spelled FROM words",
    "r5_tokenize_job": f"""WITH {ALPHABET}
SELECT count(*) AS total_sequences, sum(len(ids))::BIGINT AS total_tokens, round(sum(len(ids)) / count(*)::DOUBLE, 6) AS avg_sequence_length
FROM (SELECT seq, coalesce(ids, []) AS ids FROM words LEFT JOIN spelled USING (seq) WHERE text <> '')""",
    "e5_proportional": f"""WITH {SIZES},
shares AS (
  SELECT dataset, weight, available, (SELECT count(*) // 3 FROM documents) * weight AS share FROM sizes),
placed AS (
  SELECT *, floor(share)::BIGINT AS base, row_number() OVER (ORDER BY floor(share) - share, dataset) AS place,
         round(sum(share) OVER ())::BIGINT - sum(floor(share)::BIGINT) OVER () AS remaining FROM shares)
SELECT dataset, round(weight, 9) AS weight, available, least(available, base + CASE WHEN place <= remaining THEN 1 ELSE 0 END)::BIGINT AS samples FROM placed""",
    "e8_mixture_weights": f"WITH {SIZES} SELECT dataset, round(weight, 9) AS weight FROM sizes",
    "e10_report_read_back": ORACLES["r2_report"],
    "i5_language_outliers": _BOX[: _BOX.index("SELECT language, round(q1")].replace(
        "SELECT o_orderpriority AS language,", "SELECT o_orderkey, o_orderpriority AS language,"
    ).replace("SELECT o.language, s,", "SELECT o_orderkey, o.language, s,")
    + "SELECT o_orderkey, language, s AS language_score FROM j WHERE NOT inside",
    "i5_detected_box": I5_DETECTED + _BOX[_BOX.index("\nSELECT language, round(q1") :],
    "i5_detected_outliers": I5_DETECTED + " SELECT seq, language, s AS language_score FROM j WHERE NOT inside",
    "i5_word_outliers": f"""WITH {PROFILE}, {WORDS},
kinds_of_words AS (SELECT DISTINCT unnest(w) AS text FROM words), spoken AS (SELECT text AS seq, text FROM kinds_of_words), {detection('spoken', 1)},
o AS (SELECT seq, language, language_score AS s FROM detected WHERE language_score <> 0),
""" + I5_DETECTED[I5_DETECTED.index("\nq AS") + 1 :] + " SELECT seq AS word, language, s AS language_score FROM j WHERE NOT inside",
    "i11_detected_languages": f"""WITH {LANG}
SELECT language, count(*) AS records, round(avg(language_score), 6) AS mean_score, round(quantile_cont(language_score, 0.5), 6) AS median_score
FROM outcome WHERE language IS NOT NULL AND language_score <> 0 GROUP BY language""",
    "i12_headline_tokens": f"""{NEAR_RUN}{RETAINED},
figures AS (SELECT count(*) AS sequences, sum(len(coalesce(ids, [])))::BIGINT AS tokens FROM words LEFT JOIN spelled USING (seq))
SELECT count(*)::DOUBLE AS total_samples, count(*) FILTER (NOT dropped)::DOUBLE AS cleaned_text_count, count(*) FILTER (dropped)::DOUBLE AS total_dropped,
       any_value(sequences)::DOUBLE AS total_sequences, any_value(tokens)::DOUBLE AS total_tokens,
       round(any_value(tokens / sequences::DOUBLE), 6) AS avg_sequence_length FROM final, figures""",
    "r2_files_with_tokens": f"""{NEAR_RUN}{RETAINED}
SELECT text, coalesce(array_to_string(ids, ' '), '') AS token_ids, len(coalesce(ids, []))::BIGINT AS token_length FROM words LEFT JOIN spelled USING (seq)""",
    "r3_chunked_resume": NEAR_RUN + ROWS_OUT,
    "r3_indexed_runs": NEAR_RUN + ROWS_OUT,
}


def near_flags(sql: str) -> str:
    """The same with flags by signatures in place of those of exact copies."""
    flags = f"flags AS ({exact_flags('kept')})"
    near = f"{affine_signatures('kept')}{BANDS}{PAIRS},\nflags AS (SELECT seq, seq IN (SELECT seq FROM later) AS is_duplicate FROM kept)"
    return sql.replace("WITH ", "WITH RECURSIVE ", 1).replace(flags, near, 1)


ORACLES |= {f"{name}_near": near_flags(ORACLES[name]) for name in ("a11_dedup_job_files", "d11_filter_duplicates", "d13_dedup_job", "d14_inline_marking")}
ORACLES |= {
    f"{name}_near": ORACLES[name].replace(EXACT_RUN, NEAR_RUN, 1) for name in ("i6_duplicate_stats", "i8_summary", "i12_headline", "r3_stream_chunks")
}

# The characters added to every document, in the order the query adds them.
_ODD = "chr(1) || ' a[] ' || chr(2) || '] &] ^] b' || chr(127) || ' ' || chr(133) || ' c' || chr(3) || 'd'"
for _mode in ("intent", "parity"):
    ORACLES[f"c5_control_{_mode}"] = (
        f"SELECT doc_id AS seq, {clean_expr(f'(text || {_ODD})', _mode)} AS text FROM documents"
    )
