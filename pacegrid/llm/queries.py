"""Registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.llm import bpe, collocations, jaccard, license_scan, line_chunks, merkle, mixing, quality_rules
from pacegrid.llm import recompression, repair, token_files, toxicity, url_filter
from pacegrid.llm.common import table, vocabulary
from pacegrid.session import work_folder

#: Hosts whose pages make up the list of URLs to block.
LISTED_HOSTS = "casino|bets|pills"


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality_rules.judge(documents, table(spark, folder, "labels"))
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "rule")


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    keyed = documents.withColumn("_text", F.xxhash64("text"))
    found, mix = mixing.rated(keyed, table(spark, folder, "labels"), ["doc_id", "_text"])
    domains = [F.get("posterior", F.lit(d)).alias(f"p_{n}") for d, n in enumerate(mix.classifier.domains)]
    taken = mixing.copies(F.col("rate"), F.col("doc_id"), F.col("_text"))
    return found.select("doc_id", "n_tokens", *domains, "rate", taken.alias("copies"))


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return url_filter.url_filter(pages, listed)


def op4_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return license_scan.report(license_scan.license_scan(documents))


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.jaccard_join(documents).select("doc_id", "class_id", "n_links", "copy_id")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.judge(documents, table(spark, folder, "labels").select("doc_id", "toxic"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = work_folder(spark, "tokens")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    manifest = token_files.write_token_files(documents, files, vocabulary("byte_bpe_50k.json"))
    found = token_files.read_by_key(documents, manifest, files)
    return found.select("doc_id", "start", "n_tokens", token_files.crc32_of("ids").alias("ids_crc32"))


def op8_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.compare_with_next(table(spark, folder, "documents").select("doc_id", "text"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return line_chunks.dedup_runs(documents)


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(documents, ranks))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversation rows with planted faults: by the hash of conversation and turn a row goes,
    loses its text or its sentence ends, comes twice, or is said to be the user's."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    roll = F.crc32(key) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    text = F.when(roll == 1, "").when(roll == 2, F.translate(text, ".!?", "")).otherwise(text)
    times = F.when(roll == 0, 0).when(roll == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(roll == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    summary, turns = repair.repair(damaged(conversations))
    found = summary.join(repair.digests(turns).withColumnRenamed("conv_id", "_id"), F.expr("conv_id <=> _id")).drop("_id")
    every = conversations.select(F.col("conv_id").alias("_id")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # Of a conversation whose rows are all gone, nothing is left to repair.
    return every.join(found, F.expr("_id <=> conv_id"), "left").select(
        F.col("_id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents").select("lang", "text"))


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    kept = recompression.dedup_substrings(documents)
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_mixing,
        op3_url_filters,
        op4_license_scans,
        op5_ngram_jaccard,
        op6_toxicity,
        op7_token_files,
        op8_document_fingerprints,
        op9_line_dedup,
        op10_byte_bpe,
        op11_conversation_repair,
        op12_phrase_collocations,
        op13_substring_dedup,
    )
}

#: Op 3 in SQL: the list is joined on canonical URLs, without a filter before it. Op 13 in SQL:
#: all windows of 50 words, without symbols. Op 12 in SQL: all phrases as texts.
ORACLE: dict[str, str] = {
    "op3_url_filters": r"""
WITH parts AS (
  SELECT page_id, coalesce(strpos(url, '://'), 0) > 0 AS has_scheme,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, has_scheme,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1) AS query
  FROM parts
), keyed AS (
  SELECT page_id, host, path, has_scheme,
         regexp_replace(host, '^www[.]|:(80|443)$', '', 'g') || regexp_replace(path, '/+$', '') AS place,
         array_to_string(list_sort(list_filter(string_split(query, '&'),
             lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS parameters
  FROM split
), named AS (
  SELECT page_id, host, path,
         CASE WHEN has_scheme THEN place || CASE WHEN parameters = '' THEN '' ELSE '?' || parameters END END AS url_key
  FROM keyed
), listed AS (
  SELECT DISTINCT url_key FROM named WHERE regexp_matches(host, 'casino|bets|pills') AND url_key IS NOT NULL
), rules AS (
  SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) AS r(what, site, start)
), ruled AS (
  SELECT n.page_id, n.host, n.path, n.url_key, l.url_key IS NOT NULL AS listed,
         (SELECT max_by(site || start, length(site || start)) FROM rules
          WHERE (n.host = site OR ends_with(n.host, '.' || site)) AND starts_with(n.path, start)) AS rule
  FROM named n LEFT JOIN listed l ON n.url_key = l.url_key
)
SELECT page_id, host, path, rule, listed,
       CASE rule WHEN 'net/' THEN 'block' WHEN 'example.net/en/' THEN 'allow'
                 WHEN 'example.com/de/' THEN 'block' WHEN 'org/fr/' THEN 'allow'
                 ELSE CASE WHEN listed THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled
""",
    "op12_phrase_collocations": r"""
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words FROM pieces
), starts AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split
), phrases AS (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE i + size - 1 <= len(words)
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f, string_split(phrase, ' ') AS words FROM phrases WHERE size > 1 AND f >= 30
), cuts AS (
  SELECT lang, phrase, f AS a, unnest(range(1, size)) AS k, words FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
  FROM cuts c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.k + 1:], ' ')
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
), inside AS (
  SELECT lang, f, array_to_string(words[i:i + n - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - n + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS n FROM candidates WHERE size > 2))
), swallowed AS (
  SELECT lang, phrase, max(f) AS most FROM inside GROUP BY ALL
), kept AS (
  SELECT w.lang, w.phrase, w.a, w.l, w.r, w.score
  FROM lowest w LEFT JOIN swallowed s ON s.lang = w.lang AND s.phrase = w.phrase
  WHERE w.place = 1 AND (s.most IS NULL OR 100 * s.most < 80 * w.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op13_substring_dedup": r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D ]+'), lambda w: w <> '') AS words
  FROM documents
), windows AS (
  SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM split WHERE len(words) >= 50
), keyed AS (
  SELECT r, doc_id, i, array_to_string(words[i:i + 49], ' ') AS passage FROM windows
), firsts AS (
  SELECT passage, min(doc_id) AS first_id FROM keyed GROUP BY passage
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS place
  FROM keyed JOIN firsts USING (passage) WHERE first_id < doc_id OR (doc_id IS NULL AND first_id IS NOT NULL)
), removed AS (
  SELECT r, count(*) AS n_removed FROM gone GROUP BY r
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS text
  FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split)
       ANTI JOIN gone USING (r, place)
  GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
""",
}
