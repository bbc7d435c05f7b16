"""The same results as plain SQL over the same tables, for checking."""

from __future__ import annotations

from docsim.functions.similarity import (
    MEANING_NEGATIVE, MEANING_POSITIVE, NO_LABEL, STATUS_LOW, STATUS_NO_TEXT, STATUS_PLAGIARISM,
    STATUS_SUSPICIOUS, UNSHARED_IDF_SQUARED,
)
from docsim.functions.text import ENGLISH_MARKERS, SPANISH_MARKERS, STOPWORDS
from docsim.operators.evaluation import DONE
from docsim.plans.catalogue import LIMITED_ROWS, LOOKUP_ID, WINDOW_LAST_START, WINDOW_ROWS, WINDOW_SEED
from docsim.plans.inputs import FIRST_DATASET_ID
from docsim.sources.ingest import window_start

WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
K2 = f"{UNSHARED_IDF_SQUARED!r}e0"
FIRST = FIRST_DATASET_ID
SCORE_COLUMNS = "similarity_score, similarity_percentage, cosine_distance, distance_percentage, status"


def norm(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(strip_accents(lower(coalesce({x}, ''))), "
        f"'http[^{WS}]+|www[^{WS}]+', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
    )


def tokens(x: str) -> str:
    stop = ", ".join(f"'{word}'" for word in STOPWORDS)
    return f"list_filter(string_split({norm(x)}, ' '), lambda w: length(w) > 2 AND w NOT IN ({stop}))"


def prepared(x: str) -> str:
    return f"coalesce(array_to_string({tokens(x)}, ' '), '')"


def language(x: str) -> str:
    def hits(words: list[str]) -> str:
        return " + ".join(f"contains(' ' || lower({x}) || ' ', ' {w} ')::INT" for w in words)

    es, en = hits(SPANISH_MARKERS), hits(ENGLISH_MARKERS)
    return (
        f"CASE WHEN ({es}) > ({en}) THEN 'spanish' WHEN ({en}) > ({es}) THEN 'english' "
        "ELSE 'unknown' END"
    )


def even(x: str, digits: int) -> str:
    """Round half to even on the exact binary value."""
    s = f"1e{digits}"
    product, high = f"({x} * {s})", f"({x} * 134217729e0 - ({x} * 134217729e0 - {x}))"
    error = f"(({high} * {s} - {product}) + ({x} - {high}) * {s})"
    whole = f"floor({product})"
    excess = f"((({product} - {whole}) - 0.5e0) + {error})"
    return (
        f"(({whole} + CASE WHEN {excess} > 0 OR ({excess} = 0 AND {whole} % 2 = 1) "
        f"THEN 1e0 ELSE 0e0 END) / {s})"
    )


def words(x: str) -> str:
    """Number of words of a prepared text."""
    return f"(CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, ' ')) END)"


LABELLED = """
labelled AS (
  SELECT d.doc_id AS pair_id, d.doc_id AS row_idx, d.text AS text_a,
    CASE WHEN d.doc_id % 40 = 3 THEN '   '
         WHEN d.doc_id % 2 = 0 THEN array_to_string(list_filter(string_split(d.text, ' '), lambda x, i: i % 5 <> 0), ' ')
         ELSE n.text END AS text_b,
    CASE WHEN d.doc_id % 20 = 7 THEN CAST(NULL AS INT) WHEN d.doc_id % 50 = 9 THEN 2
         WHEN d.doc_id % 2 = 0 THEN 1 ELSE 0 END AS label
  FROM documents d JOIN documents n ON n.doc_id = d.doc_id + 1)"""

PREPARED = f"""{LABELLED},
prep AS (SELECT pair_id AS pid, *, {prepared('text_a')} AS pa, {prepared('text_b')} AS pb FROM labelled),
usable AS (SELECT * FROM prep WHERE label IN (0, 1) AND {words('pa')} >= 2 AND {words('pb')} >= 2)"""


def scores(source: str) -> str:
    """CTE ``scored(pid, score, ...)`` for a CTE with ``pid, pa, pb``."""
    return f"""
ta AS (SELECT pid, term, count(*) AS tf FROM (SELECT pid, unnest(string_split(pa, ' ')) AS term FROM {source} WHERE pa <> '') GROUP BY ALL),
tb AS (SELECT pid, term, count(*) AS tf FROM (SELECT pid, unnest(string_split(pb, ' ')) AS term FROM {source} WHERE pb <> '') GROUP BY ALL),
sa AS (SELECT pid, sum(tf * tf)::DOUBLE AS total, count(*) AS terms, sum(tf)::BIGINT AS len FROM ta GROUP BY pid),
sb AS (SELECT pid, sum(tf * tf)::DOUBLE AS total, count(*) AS terms, sum(tf)::BIGINT AS len FROM tb GROUP BY pid),
sh AS (SELECT ta.pid, sum(ta.tf * tb.tf)::DOUBLE AS dot, sum(ta.tf * ta.tf)::DOUBLE AS a2, sum(tb.tf * tb.tf)::DOUBLE AS b2, count(*) AS common
       FROM ta JOIN tb ON ta.pid = tb.pid AND ta.term = tb.term GROUP BY ta.pid),
scored0 AS (SELECT p.pid, sa.pid IS NOT NULL AND sb.pid IS NOT NULL AS has_text,
    CASE WHEN sh.dot > 0 THEN least(1e0, sh.dot / (sqrt(sh.a2 + {K2} * (sa.total - sh.a2)) * sqrt(sh.b2 + {K2} * (sb.total - sh.b2)))) ELSE 0e0 END AS score,
    coalesce(sh.common, 0) AS common, coalesce(sa.terms, 0) AS terms_a, coalesce(sb.terms, 0) AS terms_b,
    coalesce(sa.len, 0) AS len_a, coalesce(sb.len, 0) AS len_b
  FROM {source} p LEFT JOIN sa ON sa.pid = p.pid LEFT JOIN sb ON sb.pid = p.pid LEFT JOIN sh ON sh.pid = p.pid),
scored AS (SELECT *, {outputs('score', 'has_text')} FROM (SELECT *, 1e0 - score AS dist, score * 100 AS score100, (1e0 - score) * 100 AS dist100 FROM scored0))"""


def outputs(score: str, has_text: str = "TRUE") -> str:
    return f"""{even(score, 4)} AS similarity_score, {even(score + '100', 2)} AS similarity_percentage,
    {even('dist', 4)} AS cosine_distance, {even('dist100', 2)} AS distance_percentage,
    CASE WHEN NOT {has_text} THEN '{STATUS_NO_TEXT}' WHEN {score} >= 0.7e0 THEN '{STATUS_PLAGIARISM}'
         WHEN {score} >= 0.4e0 THEN '{STATUS_SUSPICIOUS}' ELSE '{STATUS_LOW}' END AS status"""


TEXT_PAIRS = f"""
docs AS (SELECT doc_id AS id, {prepared('text')} AS p FROM documents),
sorted AS (SELECT id, array_to_string(list_sort(string_split(p, ' ')), ' ') AS w FROM docs WHERE p <> ''),
texts AS (SELECT min(id) AS text_id, count(*) AS copies, w FROM sorted GROUP BY w),
members AS (SELECT s.id, t.text_id FROM sorted s JOIN texts t ON s.w = t.w),
posts AS (SELECT text_id, term, count(*) AS tf FROM (SELECT text_id, unnest(string_split(w, ' ')) AS term FROM texts) GROUP BY ALL),
tot AS (SELECT text_id, sum(tf * tf)::DOUBLE AS total FROM posts GROUP BY 1),
met AS (SELECT a.text_id AS x, b.text_id AS y, sum(a.tf * b.tf)::DOUBLE AS dot, sum(a.tf * a.tf)::DOUBLE AS a2, sum(b.tf * b.tf)::DOUBLE AS b2
        FROM posts a JOIN posts b ON a.term = b.term AND a.text_id < b.text_id GROUP BY ALL),
textpairs AS (SELECT x, y, least(1e0, dot / (sqrt(a2 + {K2} * (p.total - a2)) * sqrt(b2 + {K2} * (q.total - b2)))) AS score
        FROM met JOIN tot p ON p.text_id = x JOIN tot q ON q.text_id = y)"""


def compared(min_score: float) -> str:
    return f"""WITH {TEXT_PAIRS},
found AS (SELECT x, y, score, p.copies AS cx, q.copies AS cy FROM textpairs
            JOIN texts p ON p.text_id = x JOIN texts q ON q.text_id = y WHERE score >= {min_score}e0
          UNION ALL
          SELECT m.text_id, m.id, 1e0, t.copies, 1 FROM members m JOIN texts t ON t.text_id = m.text_id WHERE m.id <> m.text_id),
sided AS (SELECT greatest(x, y) AS a, least(x, y) AS b, score, CASE WHEN x > y THEN cx ELSE cy END AS copies_a,
            CASE WHEN x > y THEN cy ELSE cx END AS copies_b, score * 100 AS score100, 1e0 - score AS dist, (1e0 - score) * 100 AS dist100 FROM found)
SELECT a AS doc_a_id, 'doc_' || a || '.pdf' AS doc_a_name, b AS doc_b_id, 'doc_' || b || '.pdf' AS doc_b_name,
  {outputs('score')}, 'upload' AS source_a, 'upload' AS source_b, CAST(NULL AS INT) AS expected_label_a,
  CAST(NULL AS INT) AS expected_label_b, CAST(NULL AS VARCHAR) AS pair_group_a, CAST(NULL AS VARCHAR) AS pair_group_b,
  copies_a, copies_b FROM sided"""


SUMMARY = f"""WITH {TEXT_PAIRS},
bands AS (SELECT CASE WHEN score >= 0.7e0 THEN 'p' ELSE 's' END AS band, p.copies::HUGEINT * q.copies AS n
            FROM textpairs JOIN texts p ON p.text_id = x JOIN texts q ON q.text_id = y WHERE score >= 0.4e0
          UNION ALL SELECT 'p', copies::HUGEINT * (copies - 1) // 2 FROM texts WHERE copies > 1),
n AS (SELECT (SELECT count(*) FROM documents)::HUGEINT AS docs, (SELECT sum(copies) FROM texts)::HUGEINT AS textual,
        coalesce((SELECT sum(n) FROM bands WHERE band = 'p'), 0)::HUGEINT AS p, coalesce((SELECT sum(n) FROM bands WHERE band = 's'), 0)::HUGEINT AS s)
SELECT docs::VARCHAR AS total_documents, (docs * (docs - 1) // 2)::VARCHAR AS total_comparisons, p::VARCHAR AS plagiarism,
  s::VARCHAR AS suspicious, (textual * (textual - 1) // 2 - p - s)::VARCHAR AS low,
  (docs * (docs - 1) // 2 - textual * (textual - 1) // 2)::VARCHAR AS without_text FROM n"""


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def clean(x: str) -> str:
    for mark in (
        rf"label[{WS}]*[:=][{WS}]*[01]",
        rf"sentence[{WS}]*1[{WS}]*[:=]",
        rf"sentence[{WS}]*2[{WS}]*[:=]",
        rf"text1[{WS}]*[:=]",
        rf"text2[{WS}]*[:=]",
    ):
        x = f"regexp_replace({x}, '(?is){mark}', ' ', 'g')"
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def label_found(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({x}, '(?is)label[{WS}]*[:=][{WS}]*([01])', 1), '') AS INT)"


def integer(x: str) -> str:
    return f"CASE WHEN regexp_matches({strip(x)}, '^[+-]?[0-9]+$') THEN TRY_CAST({strip(x)} AS INT) END"


def parsed(source: str, key: str) -> str:
    """CTE ``cells(key, text_a, text_b, label)`` from a CTE with ``key, cell``."""
    pairs = (
        ("sentence1", "sentence2"),
        (f"sentence[{WS}]*1", f"sentence[{WS}]*2"),
        ("text1", "text2"),
        ("original", "suspicious"),
    )
    patterns = [
        f"(?is){a}[{WS}]*[:=][{WS}]*(.*?)[{WS}]*{b}[{WS}]*[:=][{WS}]*(.*?)(?:[{WS}]*label[{WS}]*[:=][{WS}]*[01])?$"
        for a, b in pairs
    ]

    def side(k: int) -> str:
        keyed = " ".join(
            f"WHEN regexp_matches(c, '{p}') THEN {clean(f'''regexp_extract(c, '{p}', {k})''')}" for p in patterns
        )
        half = "words[1:len(words) // 2]" if k == 1 else "words[len(words) // 2 + 1:]"
        return (
            f"CASE WHEN len(parts) >= 2 THEN parts[{k}] {keyed} WHEN len(lines) >= 2 THEN lines[{k}] "
            f"WHEN len(words) >= 12 THEN array_to_string({half}, ' ') ELSE '' END"
        )

    breaks = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
    return f"""
stripped AS (SELECT {key}, {strip("coalesce(cell, '')")} AS c FROM {source}),
split AS (SELECT {key}, c,
    list_filter(list_transform(string_split(c, chr(9)), lambda p: {strip('p')}), lambda p: p <> '') AS parts,
    list_filter(list_transform(string_split_regex(c, '{breaks}'), lambda p: {clean('p')}), lambda p: p <> '') AS lines,
    string_split_regex(c, '[{WS}]+') AS words FROM stripped),
cells AS (SELECT {key}, {side(1)} AS text_a, {side(2)} AS text_b,
    CASE WHEN len(parts) >= 3 THEN {integer('parts[3]')} WHEN len(parts) = 2 THEN NULL ELSE {label_found('c')} END AS label FROM split)"""


RAW = f"""{LABELLED},
flat AS (SELECT *, replace(text_a, chr(10), ' ') AS fa, replace(text_b, chr(10), ' ') AS fb, coalesce(label::VARCHAR, 'x') AS lab, pair_id % 7 AS layout FROM labelled),
raw AS (SELECT row_idx, layout, text_a, text_b, lab,
  CASE layout WHEN 0 THEN text_a || chr(9) || chr(9) || text_b || chr(9) || ' ' || lab
    WHEN 2 THEN 'Sentence 1: ' || text_a || chr(10) || 'SENTENCE 2 = ' || text_b || ' label: ' || lab
    WHEN 3 THEN fa || chr(13) || chr(10) || ' ' || chr(10) || fb || chr(10) || 'label = 1'
    WHEN 4 THEN fa WHEN 6 THEN 'text1=' || fa || ' text2:' || fb END AS cell FROM flat)"""

EXTRACTED = f"""{RAW}, {parsed('raw', 'row_idx')},
extracted AS (SELECT r.row_idx, r.cell,
  CASE WHEN layout IN (1, 5) THEN r.text_a ELSE c.text_a END AS text_a,
  CASE WHEN layout IN (1, 5) THEN r.text_b ELSE c.text_b END AS text_b,
  CASE WHEN layout IN (1, 5) THEN {integer('lab')} WHEN layout = 4 THEN coalesce(c.label, {integer('lab')}) ELSE c.label END AS label
  FROM raw r JOIN cells c USING (row_idx))"""
# a named row whose second text is empty would be parsed; blank ones count as present
PARSE_PAIRS = f"WITH {EXTRACTED} SELECT row_idx, text_a, text_b, label FROM extracted"

METRICS = f"""{PREPARED}, {scores('usable')},
judged AS (SELECT u.row_idx, u.text_a, u.text_b, u.label, s.similarity_score, s.similarity_percentage, s.status FROM usable u JOIN scored s ON s.pid = u.pid),
cm AS (SELECT count(*) FILTER (label = 0 AND similarity_score < 0.45e0) AS tn, count(*) FILTER (label = 0 AND similarity_score >= 0.45e0) AS fp,
  count(*) FILTER (label = 1 AND similarity_score < 0.45e0) AS fn, count(*) FILTER (label = 1 AND similarity_score >= 0.45e0) AS tp FROM judged)"""


def ratio(top: str, bottom: str) -> str:
    return f"(CASE WHEN ({bottom}) > 0 THEN ({top})::DOUBLE / ({bottom})::DOUBLE ELSE 0e0 END)"


MEASURED = f"""
m AS (SELECT *, tn + fp + fn + tp AS n, {ratio('tn + tp', 'tn + fp + fn + tp')} AS acc, {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0,
  {ratio('2 * tn', '2 * tn + fn + fp')} AS f0, tn + fp AS s0, {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1,
  {ratio('2 * tp', '2 * tp + fp + fn')} AS f1, fn + tp AS s1 FROM cm)"""

SWEEP = f"""{PREPARED}, {scores('usable')},
cm AS (SELECT i, i / 100e0 AS threshold, i::DOUBLE AS threshold_percentage,
  count(*) FILTER (label = 0 AND similarity_score < i / 100e0) AS tn, count(*) FILTER (label = 0 AND similarity_score >= i / 100e0) AS fp,
  count(*) FILTER (label = 1 AND similarity_score < i / 100e0) AS fn, count(*) FILTER (label = 1 AND similarity_score >= i / 100e0) AS tp
  FROM usable u JOIN scored s ON s.pid = u.pid, range(10, 60) t(i) GROUP BY i),
{MEASURED},
sweep0 AS (SELECT threshold, threshold_percentage, acc * 100 AS a, {even('p1', 4)} * 100 AS p, {even('r1', 4)} * 100 AS r, {even('f1', 4)} * 100 AS f, {even('f0', 4)} * 100 AS g FROM m),
sweep AS (SELECT threshold, threshold_percentage, {even('a', 2)} AS accuracy_percentage, {even('p', 2)} AS plagio_precision,
  {even('r', 2)} AS plagio_recall, {even('f', 2)} AS plagio_f1, {even('g', 2)} AS no_plagio_f1 FROM sweep0)"""


def loaded(source: str, first: int = 0) -> str:
    """CTE ``loaded``: two documents per accepted pair of a CTE like ``prep``."""

    def side(letter: str, offset: int) -> str:
        raw, done = f"text_{letter.lower()}", f"p{letter.lower()}"
        return f"""SELECT {first} + row_idx * 2 + {offset} AS id, 'dataset_' || num || '_{letter}.txt' AS filename, {raw} AS raw_text,
          {done} AS processed_text, {language(raw)} AS language, 'dataset' AS source_type, label AS expected_label, 'dataset_pair_' || num AS pair_group, row_idx FROM accepted"""

    number = "row_idx + 1"
    return f"""
accepted AS (SELECT *, CASE WHEN {number} < 1000 THEN lpad(({number})::VARCHAR, 3, '0') ELSE ({number})::VARCHAR END AS num
  FROM {source} WHERE {words('pa')} >= 2 AND {words('pb')} >= 2),
loaded AS ({side('A', 0)} UNION ALL {side('B', 1)})"""


def padded(x: str) -> str:
    return f"(CASE WHEN ({x}) < 1000 THEN lpad(({x})::VARCHAR, 3, '0') ELSE ({x})::VARCHAR END)"


CORPUS = f"""{PREPARED}, {loaded('prep', FIRST)},
corpus AS (
  SELECT doc_id AS id, 'doc_' || doc_id || '.pdf' AS filename, text AS raw_text, {prepared('text')} AS processed_text,
    {language('text')} AS language, 'upload' AS source_type, CAST(NULL AS INT) AS expected_label, CAST(NULL AS VARCHAR) AS pair_group,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id), '%Y-%m-%dT%H:%M:%S') AS uploaded_at FROM documents
  UNION ALL
  SELECT id, filename, raw_text, processed_text, language, source_type, expected_label,
    CASE WHEN row_idx % 50 = 11 AND id % 2 = 1 THEN '' WHEN row_idx % 50 = 12 THEN 'dataset_pair_' || {padded('row_idx + 2')} ELSE pair_group END,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(id - {FIRST}), '%Y-%m-%dT%H:%M:%S') FROM loaded)"""


def grouped(source: str) -> str:
    """The two newest documents per group of a CTE like ``corpus``, compared."""
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY pair_group ORDER BY uploaded_at DESC, id DESC) AS rn FROM {source} WHERE source_type = 'dataset' AND pair_group <> ''),
twos AS (SELECT a.id AS pid, a.pair_group, a.id AS doc_a_id, a.filename AS doc_a_name, b.id AS doc_b_id, b.filename AS doc_b_name,
  a.expected_label, a.processed_text AS pa, b.processed_text AS pb FROM ranked a JOIN ranked b ON a.pair_group = b.pair_group AND a.rn = 1 AND b.rn = 2),
{scores('twos').strip()}
SELECT pair_group, doc_a_id, doc_a_name, doc_b_id, doc_b_name, {SCORE_COLUMNS}, expected_label,
  {meaning('expected_label')} AS expected_meaning,
  CASE WHEN expected_label IS NOT NULL THEN (similarity_score >= 0.7e0)::INT = expected_label END AS prediction_matches_dataset
FROM twos JOIN scored USING (pid)"""


def meaning(label: str) -> str:
    return f"CASE {label} WHEN 1 THEN '{MEANING_POSITIVE}' WHEN 0 THEN '{MEANING_NEGATIVE}' ELSE '{NO_LABEL}' END"


UPLOADS = f"""
uploads AS (SELECT doc_id AS id, CASE WHEN doc_id % 10 = 4 THEN 'notes ' || doc_id || '.txt' WHEN doc_id % 10 = 5 THEN 'My File ' || doc_id || '.PDF'
    ELSE 'doc_' || doc_id || '.pdf' END AS filename, text AS raw_text FROM documents)"""

INGEST_DOCUMENTS = f"""WITH {UPLOADS}
SELECT id, replace(filename, ' ', '_') AS filename, raw_text, {prepared('raw_text')} AS processed_text,
  {language('raw_text')} AS language, 'upload' AS source_type, CAST(NULL AS INT) AS expected_label, CAST(NULL AS VARCHAR) AS pair_group
FROM uploads WHERE lower(filename) LIKE '%.pdf' AND len({tokens('raw_text')}) >= 10"""

UNWANTED = "unwanted AS (SELECT unnest([doc_id, -doc_id - 1]) AS id FROM labels WHERE toxic = 1)"

GRAMS = "list_concat({w}, list_transform({w}[1:-2], lambda x, i: x || ' ' || {w}[i + 1]))"

VOCABULARY = f"""{PREPARED},
sides AS (SELECT pid, pa AS p FROM usable UNION ALL SELECT pid, pb FROM usable),
numbered AS (SELECT row_number() OVER () AS did, string_split(p, ' ') AS w FROM sides),
gramlists AS (SELECT did, {GRAMS.format(w='w')} AS g FROM numbered),
counts AS (SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM (SELECT did, term, count(*) AS tf FROM (SELECT did, unnest(g) AS term FROM gramlists) GROUP BY ALL) GROUP BY term),
top AS (SELECT * FROM counts ORDER BY total DESC, term LIMIT 10000),
vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, total, df, ln((1 + (SELECT count(*) FROM sides))::DOUBLE / (1 + df)) + 1 AS idf FROM top)"""


def weights(side: str, source: str = "usable") -> str:
    return f"""
g{side} AS (SELECT pid, unnest({GRAMS.format(w='w')}) AS term FROM (SELECT pid, string_split(p{side}, ' ') AS w FROM {source})),
k{side} AS (SELECT pid, idx, term, count(*) * any_value(idf) AS w FROM g{side} JOIN vocab USING (term) GROUP BY pid, idx, term),
w{side} AS (SELECT pid, idx, term, w / sqrt(sum(w * w) OVER (PARTITION BY pid)) AS weight FROM k{side})"""


def first_rows(sql: str, limit: int) -> str:
    """The same SQL over the first labelled rows."""
    joined = "n.doc_id = d.doc_id + 1"
    return sql.replace(f"{joined})", f"{joined} WHERE d.doc_id < {limit})")


JOINED = """
both_sides AS (SELECT coalesce(wa.pid, wb.pid) AS pid, coalesce(wa.idx, wb.idx) AS idx, coalesce(wa.weight, 0e0) AS a, coalesce(wb.weight, 0e0) AS b
  FROM wa FULL JOIN wb ON wa.pid = wb.pid AND wa.idx = wb.idx)"""

NUMBERS = f"""CASE WHEN terms_a > 0 AND terms_b > 0 THEN {ratio('common', 'terms_a + terms_b - common')} ELSE 0e0 END AS jaccard,
  {ratio('common', 'least(terms_a, terms_b)')} AS containment, {ratio('least(len_a, len_b)', 'greatest(len_a, len_b)')} AS length_ratio"""

PREDICTED = f"""WITH {VOCABULARY},
given AS (SELECT * FROM prep WHERE trim(text_a) <> '' AND trim(text_b) <> ''),
{weights('a', 'given')}, {weights('b', 'given')}, {JOINED}, {scores('given')},
linear AS (SELECT pid, sum(abs(a - b) * ((idx * 37 % 101 - 50) / 100e0) + a * b * ((idx * 53 % 97 - 48) / 100e0)) AS s, sum(a * b) AS cosine
  FROM both_sides GROUP BY pid),
numbers AS (SELECT pid, {NUMBERS} FROM scored),
decided AS (SELECT g.*, 0.1e0 + coalesce(s, 0e0) + 1.5e0 * coalesce(cosine, 0e0) - 0.5e0 * jaccard + 0.75e0 * containment - 0.25e0 * length_ratio AS z
  FROM given g JOIN numbers n ON n.pid = g.pid LEFT JOIN linear l ON l.pid = g.pid),
sure AS (SELECT *, CASE WHEN z > 0 THEN 1e0 / (1e0 + exp(-z)) ELSE 1e0 - 1e0 / (1e0 + exp(-z)) END AS c FROM decided),
sure100 AS (SELECT *, c * 100 AS c100 FROM sure)
SELECT pair_id, 'TF-IDF + Logistic Regression con características de comparación' AS model, (z > 0)::INT AS prediction,
  CASE WHEN z > 0 THEN 'Plagio / similar' ELSE 'No plagio / no similar' END AS prediction_text, {even('c', 4)} AS confidence,
  {even('c100', 2)} AS confidence_percentage, pa AS processed_text_a, pb AS processed_text_b FROM sure100"""

# over single documents, without collapsing copies
PARTNERS = f"""WITH docs AS (SELECT doc_id AS id, {prepared('text')} AS p FROM documents),
tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(string_split(p, ' ')) AS term FROM docs WHERE p <> '') GROUP BY ALL),
tot AS (SELECT id, sum(tf * tf)::DOUBLE AS total FROM tf GROUP BY 1),
met AS (SELECT a.id AS x, b.id AS y, sum(a.tf * b.tf)::DOUBLE AS dot, sum(a.tf * a.tf)::DOUBLE AS a2, sum(b.tf * b.tf)::DOUBLE AS b2
  FROM tf a JOIN tf b ON a.term = b.term AND a.id <> b.id WHERE a.id % 100 = 0 GROUP BY ALL),
found AS (SELECT x, y, least(1e0, dot / (sqrt(a2 + {K2} * (p.total - a2)) * sqrt(b2 + {K2} * (q.total - b2)))) AS score
  FROM met JOIN tot p ON p.id = x JOIN tot q ON q.id = y)
SELECT x AS doc_id, y AS partner_id, round(score, 6) AS raw_score FROM found WHERE score >= 0.4e0"""

# classes over all pairs of texts, by following links
NEAR_COPIES = f"""WITH RECURSIVE {TEXT_PAIRS},
links AS (SELECT x, y, score >= 0.7e0 AS plagiarism FROM textpairs WHERE score >= 0.4e0),
ways AS (SELECT x AS a, y AS b, plagiarism FROM links UNION ALL SELECT y, x, plagiarism FROM links),
reached AS (SELECT text_id AS a, text_id AS b FROM texts UNION SELECT reached.a, ways.b FROM reached JOIN ways ON reached.b = ways.a AND plagiarism),
classed AS (SELECT a AS text_id, min(b) AS class_id FROM reached GROUP BY a),
matched AS (SELECT a AS text_id, coalesce(sum(copies) FILTER (plagiarism), 0) AS np, coalesce(sum(copies) FILTER (NOT plagiarism), 0) AS ns
  FROM ways JOIN texts ON b = text_id GROUP BY a)"""


def _oracles() -> dict[str, str]:
    start = window_start(WINDOW_SEED, WINDOW_LAST_START)
    window = f"""{PREPARED},
    win AS (SELECT * REPLACE (row_idx - {start} AS row_idx) FROM prep WHERE row_idx >= {start} AND row_idx < {start + WINDOW_ROWS}),
    {loaded('win', FIRST)}, refreshed AS (SELECT *, id AS uploaded_at FROM loaded)"""
    classes = ", ".join(
        f"{even(f'{short}{k}', 4)} AS {name}_{long}"
        for k, name in ((0, "no_plagio"), (1, "plagio"))
        for short, long in (("p", "precision"), ("r", "recall"), ("f", "f1_score"))
    )

    def report(name: str, p: str, r: str, f: str, support: str) -> str:
        return (
            f"SELECT '{name}' AS name, round({p}, 9) AS precision, round({r}, 9) AS recall, "
            f"round({f}, 9) AS f1_score, {support} AS support FROM m"
        )

    def weighted(x: str) -> str:
        return ratio(f"{x}0 * s0 + {x}1 * s1", "s0 + s1")

    steps = f"""WITH {CORPUS}, {UNWANTED},
    found AS (SELECT count(*) AS n FROM unwanted WHERE id IN (SELECT id FROM corpus)),
    c AS (SELECT count(*) AS total, count(*) FILTER (source_type = 'dataset') AS ds FROM corpus)
    SELECT 'saved' AS step, total AS total_documents, ds AS dataset_documents, 0::BIGINT AS removed FROM c
    UNION ALL SELECT 'deleted', total - n, ds, n FROM c, found
    UNION ALL SELECT 'dataset cleared', total - n - ds, 0, ds FROM c, found
    UNION ALL SELECT 'cleared', 0, 0, total - n - ds FROM c, found"""
    columns = "id, filename, raw_text, processed_text, language, source_type, expected_label, pair_group"
    split = f"""{PREPARED},
            r AS (SELECT pair_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(pair_id || '|42'), pair_id) AS rn, count(*) OVER (PARTITION BY label) AS n FROM usable),
            s AS (SELECT pair_id, label, rn <= floor(n * 0.2e0 + 0.5e0) AS is_test FROM r)"""
    return {
        "pairs_by_score": f"WITH {TEXT_PAIRS} SELECT floor(round(score, 9) * 100)::INT AS percent, count(*) AS pairs FROM textpairs WHERE score >= 0.02e0 GROUP BY 1",
        "partners": PARTNERS,
        "near_copy_members": f"""{NEAR_COPIES}
            SELECT m.id AS doc_id, class_id, t.text_id, copies, CAST(coalesce(np, 0) + copies - 1 AS BIGINT) AS n_plagiarism,
              CAST(coalesce(ns, 0) AS BIGINT) AS n_suspicious
            FROM members m JOIN texts t ON t.text_id = m.text_id JOIN classed c ON c.text_id = t.text_id LEFT JOIN matched w ON w.text_id = t.text_id""",
        "near_copy_classes": f"""{NEAR_COPIES},
            inner_links AS (SELECT p.class_id, plagiarism, t.copies * u.copies AS pairs FROM links
              JOIN classed p ON p.text_id = x JOIN classed q ON q.text_id = y AND q.class_id = p.class_id JOIN texts t ON t.text_id = x JOIN texts u ON u.text_id = y),
            banded AS (SELECT class_id, sum(pairs) FILTER (plagiarism) AS pp, sum(pairs) FILTER (NOT plagiarism) AS sp FROM inner_links GROUP BY 1),
            sized AS (SELECT class_id, CAST(sum(copies) AS BIGINT) AS documents, count(*) AS texts, sum(copies * (copies - 1) // 2) AS within
              FROM classed JOIN texts USING (text_id) GROUP BY 1)
            SELECT class_id, documents, texts, (within + coalesce(pp, 0))::VARCHAR AS plagiarism_pairs, coalesce(sp, 0)::VARCHAR AS suspicious_pairs
            FROM sized LEFT JOIN banded USING (class_id) WHERE documents > 1""",
        "stream_rejects": f"""WITH {UPLOADS},
            sent AS (SELECT * FROM uploads
              UNION ALL SELECT id, 'again ' || id || '.pdf', raw_text FROM uploads WHERE id % 7 IN (0, 4)
              UNION ALL SELECT id, 'x.txt', raw_text FROM uploads WHERE id % 9 = 0
              UNION ALL SELECT NULL, filename, raw_text FROM uploads WHERE id % 11 = 0),
            judged AS (SELECT id, CASE WHEN id IS NULL THEN 'no id' WHEN lower(filename) NOT LIKE '%.pdf' THEN 'name'
              WHEN len({tokens('raw_text')}) < 10 THEN 'content' END AS reason FROM sent),
            good AS (SELECT count(*) AS n, count(DISTINCT id) AS ids FROM judged WHERE reason IS NULL)
            SELECT reason, count(*) AS rows FROM judged WHERE reason IS NOT NULL GROUP BY 1
            UNION ALL SELECT 'duplicate', n - ids FROM good UNION ALL SELECT 'accepted', ids FROM good
            UNION ALL SELECT 'read', count(*) FROM sent""",
        "documents_head": "SELECT doc_id, row_idx FROM (SELECT doc_id, row_number() OVER () - 1 AS row_idx FROM documents) WHERE row_idx < 50",
        "documents_window": f"""SELECT doc_id, row_idx - {start} AS row_idx FROM (SELECT doc_id, row_number() OVER () - 1 AS row_idx FROM documents)
            WHERE row_idx >= {start} AND row_idx < {start + WINDOW_ROWS}""",
        "pair_number_features": f"""WITH {VOCABULARY}, {weights('a')}, {weights('b')}, {JOINED}, {scores('usable')},
            linear AS (SELECT pid, sum(a * b) AS cosine, count(*) FILTER (a * b <> 0) AS n_shared FROM both_sides GROUP BY pid),
            numbers AS (SELECT pid, {NUMBERS} FROM scored)
            SELECT pid AS pair_id, round(coalesce(cosine, 0e0), 6) AS cosine, round(jaccard, 6) AS jaccard, round(containment, 6) AS containment,
              round(length_ratio, 6) AS length_ratio, coalesce(n_shared, 0)::INT AS n_shared FROM numbers LEFT JOIN linear USING (pid)""",
        "predict_pairs": PREDICTED,
        "train_metrics": f"""WITH {split} SELECT 'labelled_pairs' AS dataset_name, count(*) AS total_examples, count(*) FILTER (NOT is_test) AS train_examples,
            count(*) FILTER (is_test) AS test_examples, 'TF-IDF + Logistic Regression con características de comparación' AS model,
            count(*) FILTER (is_test AND label = 0) AS no_plagio_support, count(*) FILTER (is_test AND label = 1) AS plagio_support,
            count(*) FILTER (is_test) AS tested, true AS metrics_follow_counts, true AS classes_told_apart FROM s""",
        "evaluate_threshold_head": first_rows(f"""WITH {METRICS} SELECT {LIMITED_ROWS} AS limit_requested, tn + fp + fn + tp AS evaluated_count,
            (SELECT count(*) FROM labelled) - (tn + fp + fn + tp) AS skipped_rows, tn AS true_negative, fp AS false_positive,
            fn AS false_negative, tp AS true_positive FROM cm""", LIMITED_ROWS),
        "sweep_thresholds_head": first_rows(f"WITH {SWEEP} SELECT * FROM sweep", LIMITED_ROWS),
        "normalize_text": f"SELECT doc_id, {norm('text')} AS normalized FROM documents",
        "token_filter": f"SELECT doc_id, {words(norm('text'))} AS n_tokens, len({tokens('text')}) AS n_content FROM documents",
        "prepare_text": f"SELECT *, {words('prepared')} AS words FROM (SELECT conv_id, turn, {prepared('text')} AS prepared FROM conversations)",
        "detect_language": f"SELECT doc_id, {language('text')} AS language FROM documents",
        "valid_documents": f"SELECT doc_id, len({tokens('text')}) >= 10 AS valid FROM documents",
        "assemble_documents": f"SELECT conv_id, {strip('''string_agg(text, chr(10) ORDER BY turn)''')} AS raw_text FROM conversations GROUP BY conv_id",
        "term_frequency": f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({tokens('text')}) AS term FROM documents) GROUP BY ALL",
        "document_frequency": f"""SELECT term, df, round(ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1, 6) AS idf
            FROM (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({tokens('text')}) AS term FROM documents) GROUP BY term)""",
        "vocabulary": f"WITH {VOCABULARY} SELECT term, idx, total, df, round(idf, 6) AS idf FROM vocab",
        "tfidf_weights": f"WITH {VOCABULARY}, {weights('a')} SELECT pid AS pair_id, idx, term, round(weight, 6) AS weight FROM wa",
        "pair_term_features": f"""WITH {VOCABULARY}, {weights('a')}, {weights('b')}
            SELECT coalesce(wa.pid, wb.pid) AS pair_id, coalesce(wa.idx, wb.idx) AS idx, round(abs(coalesce(wa.weight, 0e0) - coalesce(wb.weight, 0e0)), 6) AS difference,
              round(coalesce(wa.weight, 0e0) * coalesce(wb.weight, 0e0), 6) AS product FROM wa FULL JOIN wb ON wa.pid = wb.pid AND wa.idx = wb.idx""",
        "compare_documents": compared(0.4),
        "compare_documents_plagiarism": compared(0.7),
        "comparison_summary": SUMMARY,
        "dataset_pairs": f"WITH {CORPUS}, {grouped('corpus')}",
        "compare_texts": f"""WITH {PREPARED}, {scores('prep')}
            SELECT pair_id, length(text_a) AS text_a_length, length(text_b) AS text_b_length, {SCORE_COLUMNS} FROM prep JOIN scored USING (pid)""",
        "pair_measures": f"""WITH {PREPARED}, {scores('prep')}
            SELECT pid AS pair_id, CASE WHEN terms_a > 0 AND terms_b > 0 THEN {ratio('common', 'terms_a + terms_b - common')} ELSE 0e0 END AS jaccard,
              {ratio('common', 'least(terms_a, terms_b)')} AS containment, {ratio('least(len_a, len_b)', 'greatest(len_a, len_b)')} AS length_ratio FROM scored""",
        "status_bands": f"WITH {PREPARED}, {scores('prep')} SELECT status, count(*) AS pairs FROM scored GROUP BY status",
        "label_texts": f"""WITH {PREPARED}, {scores('prep')}
            SELECT pair_id, {meaning('label')} AS meaning, CASE label WHEN 1 THEN 'Plagio' WHEN 0 THEN 'No plagio' ELSE '{NO_LABEL}' END AS display,
              CASE WHEN label IS NOT NULL THEN (similarity_score >= 0.7e0)::INT = label END AS matches FROM prep JOIN scored USING (pid)""",
        "parse_pairs": PARSE_PAIRS,
        "parse_document_cells": f"WITH src AS (SELECT doc_id, text AS cell FROM documents), {parsed('src', 'doc_id')} SELECT doc_id, text_a, text_b, label FROM cells",
        "clean_marks": f"WITH {RAW} SELECT row_idx, {clean('cell')} AS cleaned, {label_found('cell')} AS label_found FROM raw WHERE cell IS NOT NULL",
        "evaluate_threshold": f"""WITH {METRICS}, {MEASURED}, h AS (SELECT *, acc * 100 AS acc100 FROM m)
            SELECT '{DONE}' AS message, n AS evaluated_count, (SELECT count(*) FROM labelled) - n AS skipped_rows, 0.45e0 AS threshold, {even('acc', 4)} AS accuracy,
              {even('acc100', 2)} AS accuracy_percentage, {classes}, s0 AS no_plagio_support, s1 AS plagio_support,
              tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive FROM h""",
        "classification_report": f"WITH {METRICS}, {MEASURED} "
        + " UNION ALL ".join(
            [
                report("No plagio", "p0", "r0", "f0", "s0"),
                report("Plagio", "p1", "r1", "f1", "s1"),
                report("accuracy", "acc", "acc", "acc", "n"),
                report("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
                report("weighted avg", weighted("p"), weighted("r"), weighted("f"), "n"),
            ]
        ),
        "evaluation_examples": f"""WITH {METRICS} SELECT row_idx + 1 AS row, text_a, text_b, label AS expected_label,
            (similarity_score >= 0.45e0)::INT AS predicted_label, similarity_percentage, status FROM judged ORDER BY row_idx LIMIT 10""",
        "sweep_thresholds": f"WITH {SWEEP} SELECT * FROM sweep",
        "best_thresholds": f"""WITH {SWEEP} (SELECT 'accuracy' AS criterion, * FROM sweep ORDER BY accuracy_percentage DESC, threshold LIMIT 1)
            UNION ALL (SELECT 'plagio_f1' AS criterion, * FROM sweep ORDER BY plagio_f1 DESC, threshold LIMIT 1)""",
        "top_thresholds": f"WITH {SWEEP} SELECT * FROM sweep ORDER BY accuracy_percentage DESC, threshold LIMIT 10",
        "ingest_pairs": f"WITH {PREPARED}, {loaded('prep')} SELECT {columns} FROM loaded",
        "ingest_summary": first_rows(f"""WITH {PREPARED}, {loaded('prep')} SELECT '' AS dataset_name, 50 AS requested_pairs, 0 AS start_index,
            (SELECT count(*) FROM loaded) AS saved_documents, (SELECT count(*) FROM prep) - (SELECT count(*) FROM accepted) AS skipped_rows""", 50),
        "ingest_preview": f"""WITH {EXTRACTED} SELECT row_idx + 1 AS row, 'text,sentence1,sentence2,premise,target,label,labels' AS available_columns,
            substring(coalesce(cell, ''), 1, 250) AS text_preview, substring(text_a, 1, 100) AS sentence1_preview, substring(text_b, 1, 100) AS sentence2_preview, label
            FROM extracted WHERE row_idx < 3""",
        "ingest_documents": INGEST_DOCUMENTS,
        "stream_ingest_documents": INGEST_DOCUMENTS,
        "corpus_newest_first": f"""WITH {CORPUS} SELECT id, filename, processed_text, language, source_type, expected_label, pair_group, uploaded_at,
            length(raw_text) AS raw_length FROM corpus ORDER BY uploaded_at DESC, id DESC""",
        "corpus_counts": f"WITH {CORPUS} SELECT count(*) AS total_documents, count(*) FILTER (source_type = 'dataset') AS dataset_documents FROM corpus",
        "corpus_lookup": f"WITH {CORPUS} SELECT * FROM corpus WHERE id = {LOOKUP_ID}",
        "corpus_delete": f"WITH {CORPUS}, {UNWANTED} SELECT id, filename, source_type FROM corpus WHERE id NOT IN (SELECT id FROM unwanted)",
        "deletion_report": f"WITH {CORPUS}, {UNWANTED} SELECT DISTINCT id, id IN (SELECT id FROM corpus) AS existed FROM unwanted",
        "corpus_clear_dataset": f"WITH {CORPUS} SELECT id, filename, source_type FROM corpus WHERE source_type <> 'dataset'",
        "corpus_table": steps,
        "dataset_head": f"WITH {LABELLED} SELECT row_idx, text_a, text_b, label FROM labelled WHERE row_idx < 50",
        "dataset_window": f"WITH {LABELLED} SELECT row_idx - {start} AS row_idx, pair_id, label FROM labelled WHERE row_idx >= {start} AND row_idx < {start + WINDOW_ROWS}",
        "row_index": "SELECT doc_id, row_number() OVER () - 1 AS row_idx FROM documents",
        "demo_flow": f"WITH {window}, {grouped('refreshed')}",
        "stratified_split_pairs": f"WITH {split} SELECT pair_id, label, is_test FROM s",
    }


ORACLES = _oracles()
