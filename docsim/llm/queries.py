"""The package's registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsim.llm import (
    decontaminate, jaccard_join, licences, mixing, page_text, periodic_runs, pii, quality_rules, repeated_spans, simhash,
    spelling, token_shards, toxicity,
)

#: Shares of tokens for the domains that ``labels`` tell apart.
TARGETS = {"good": 0.7, "poor": 0.25, "toxic": 0.05}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def domain_labels(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``domain`` of labelled rows; rows without a full label have none."""
    domain = F.when(F.col("toxic") == 1, "toxic").when((F.col("toxic") == 0) & (F.col("quality") == 1), "good")
    return labels.select("doc_id", domain.when((F.col("toxic") == 0) & (F.col("quality") == 0), "poor").alias("domain"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and copies of all documents for the target shares."""
    return mixing.mixed_rates(table(spark, sf_dir, "documents"), domain_labels(table(spark, sf_dir, "labels")), TARGETS)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failed rules and verdict of all documents."""
    return quality_rules.verdicts(quality_rules.ledger(table(spark, sf_dir, "documents")))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of the written shards."""
    return token_shards.materialise(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents."""
    documents = table(spark, sf_dir, "documents")
    return toxicity.scores(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of all documents without words that an earlier document holds."""
    return repeated_spans.substring_dedup(table(spark, sf_dir, "documents"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return licences.licence_scan(table(spark, sf_dir, "documents"))


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return page_text.page_texts(pages, page_text.train(pages))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages, with the items."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their form and root; one word of a document in 97 lacks a letter."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), misspell=True)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents; the tail of one document in ten repeats."""
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), cycles=True)


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of all documents."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline``, one after another."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_simhash, op3_quality, op4_pii, op5_token_shards, op6_toxicity, op7_substring, op8_licences,
        op9_page_text, op10_decontaminate, op11_spelling, op12_runs, op13_jaccard, pipeline,
    )
}

_WORDS = """
texts AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM texts)
"""



def _crc32(codes: str) -> str:
    """CRC-32 of a list of byte values, folded bit by bit."""
    bits = f"flatten(list_transform({codes}, lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))"
    step = "CASE WHEN xor(c, e) & 1 = 1 THEN xor(xor(c, e) >> 1, 3988292384) ELSE xor(c, e) >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, e: {step}), 4294967295::BIGINT)"


ORACLES: dict[str, str] = {
    "op3_quality": f"""
WITH {_WORDS},
windows AS (
  SELECT r, i, array_to_string(words[i:i + 4], ' ') AS five
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM worded WHERE len(words) > 5)
),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, five) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY r
),
measured AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    coalesce(n, 0) AS n_repeat_words
  FROM worded LEFT JOIN covered USING (r)
),
judged AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines FROM measured
),
ruled AS (
  SELECT *, n_words < 10 AS f0, 100 * n_repeat_words > 20 * n_words AS f1, 10 * n_symbols > n_words AS f2,
    n_lines > 3 AND 10 * n_dup_lines > 3 * n_lines AS f3,
    n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) AS f4
  FROM judged
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, f0 OR f1 AS base_failed,
  NOT (f0 OR f1 OR f2 OR f3 OR f4) AS kept,
  CAST(f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT AS INTEGER) AS failed
FROM ruled
""",
    "op7_substring": f"""
WITH {_WORDS},
windows AS (
  SELECT r, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS w
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM worded WHERE len(words) >= 50)
),
late AS (SELECT r, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY w) < doc_id),
gone AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM late) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN words
    ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
FROM worded LEFT JOIN gone USING (r)
""",
    "op11_spelling": f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\u00C0-\u00FF]+')) AS run
  FROM documents
),
found AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
coded AS (
  SELECT *, flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)) AS codes
  FROM found
),
hashed AS (SELECT *, {_crc32("codes")} AS h FROM coded),
counted AS (
  SELECT CASE WHEN doc_id IS NOT NULL AND h % 97 = 0
    THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, times
  FROM hashed
),
vocabulary AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM counted WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM vocabulary)
),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n
  FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word
),
counts AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
best AS (
  SELECT word, near AS form, near_n AS form_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1 AND near_n >= 2 * n
),
ways AS (
  SELECT word, form AS tip FROM best
  UNION ALL
  SELECT ways.word, best.form FROM ways JOIN best ON ways.tip = best.word
),
roots AS (SELECT word, tip AS root FROM ways WHERE tip NOT IN (SELECT word FROM best))
SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
FROM vocabulary LEFT JOIN counts USING (word) LEFT JOIN best USING (word) LEFT JOIN roots USING (word)
""",
    "op12_runs": f"""
WITH {_WORDS},
hashed AS (
  SELECT r, doc_id, words, len(words) AS n,
    {_crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT)")} AS h
  FROM worded
),
started AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed),
cycled AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS q FROM started),
listed AS (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(n),
    lambda i: words[1 + CASE WHEN i >= a THEN a + (i - a) % q ELSE i END]) END AS words
  FROM cycled
),
windows AS (
  SELECT r, n, i, array_to_string(words[i + 1:i + 5], ' ') AS five
  FROM (SELECT r, n, words, unnest(range(n - 4)) AS i FROM listed)
),
same AS (
  SELECT a.r, a.i, b.i - a.i AS p, a.i - row_number() OVER (PARTITION BY a.r, b.i - a.i ORDER BY a.i) AS stretch
  FROM windows a JOIN windows b ON a.r = b.r AND a.five = b.five AND a.i < b.i AND 4 * (b.i - a.i) <= a.n
),
stretches AS (SELECT r, p, min(i) AS start, p + count(*) + 4 AS length FROM same GROUP BY r, p, stretch),
runs AS (
  SELECT r, start, length, min(p) AS period FROM stretches WHERE length >= greatest(6, 4 * p) GROUP BY r, start, length
),
best AS (
  SELECT r, start, length, period FROM runs
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1
),
digests AS (
  SELECT r, count(*) AS n_runs, sha256(string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period)) AS d
  FROM runs GROUP BY r
),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT r, sha256(string_agg(word, ' ' ORDER BY i)) AS k
  FROM (SELECT r, unnest(words) AS word, unnest(range(n)) AS i FROM listed) ANTI JOIN dropped USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
  CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  coalesce(d, sha256('')) AS runs_sha256, coalesce(k, sha256('')) AS collapsed_sha256
FROM listed LEFT JOIN digests USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
""",
    "op13_jaccard": """
WITH RECURSIVE lowered AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT r, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM lowered WHERE len(words) > 0)
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT r AS a, r AS b FROM lowered
  UNION
  SELECT reached.a, sides.b FROM reached JOIN sides ON reached.b = sides.a
),
least AS (SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN lowered ON lowered.r = reached.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM lowered LEFT JOIN sizes USING (r) LEFT JOIN least USING (r)
""",
}
