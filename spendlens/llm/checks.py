"""Registered queries of the training-data operators, and oracle SQL where SQL can say it.

Each query applies its operator with production parameters to whole tables and
derives the digest columns its contract asks for.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import (
    bpe, language, licenses, lines, preferences, quality, search, simhash, token_counts, toxicity, trie, warc, winnow,
)
from spendlens.llm.common import held_out, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sha256(column):
    return F.sha2(F.col(column) if isinstance(column, str) else column, 256)


def byte_bpe_model() -> bytes:
    return bpe.serialised_model(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


@query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = byte_bpe_model()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, model, public_tokenizers.PATTERN)
    return bpe.decode(ids, model).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.concat_ws(" ", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        sha256("decoded").alias("decoded_sha256"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NOTICE_ROWS = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licenses.known_texts())
LICENSE_SQL = f"""
WITH notices(license, text) AS (VALUES {_NOTICE_ROWS}
), texts AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS name, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 't', license, text FROM notices
), listed AS (
  SELECT kind, name, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS words FROM texts
), shingles AS (
  SELECT kind, name, place, array_to_string(words[place + 1 : place + 5], ' ') AS shingle
  FROM (SELECT *, unnest(range(0, len(words) - 4)) AS place FROM listed WHERE len(words) >= 5)
), templates AS (
  SELECT DISTINCT name AS license, shingle,
    CAST(pow(2, ceil(log2(n))) AS BIGINT) AS size_class, n
  FROM (SELECT *, count(DISTINCT shingle) OVER (PARTITION BY name) AS n
        FROM shingles WHERE kind = 't')
), met AS (
  SELECT s.name, t.license, t.shingle, t.n, t.size_class,
    unnest(range(greatest(0, place // size_class - 2), place // size_class + 1)) AS nth
  FROM shingles s JOIN templates t ON s.shingle = t.shingle WHERE s.kind = 'd'
), held AS (
  SELECT name, license, n, size_class * nth AS start, count(DISTINCT shingle) AS held
  FROM met GROUP BY ALL
), short AS (
  SELECT DISTINCT name AS license, words AS template FROM listed WHERE kind = 't' AND len(words) BETWEEN 1 AND 4
), short_met AS (
  SELECT d.name, s.license, greatest(0, place - 2) AS start
  FROM (SELECT name, words, unnest(range(0, len(words))) AS place FROM listed WHERE kind = 'd') d
  JOIN short s ON d.words[place + 1] = s.template[1]
    AND d.words[place + 1 : place + len(s.template)] = s.template
), hits AS (
  SELECT name, license, held / n AS share, start FROM held WHERE held * 100 >= 80 * n
  UNION ALL SELECT name, license, 1.0, start FROM short_met
)
SELECT CAST(name AS BIGINT) AS doc_id, license, max(share) AS containment, min(start) AS first_word
FROM hits GROUP BY name, license
"""


@query("op2_license_scan", LICENSE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.find_licenses(docs, licenses.notices(spark))


WARC_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), sized AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
    max(page_id) OVER (PARTITION BY sha1(payload)) AS original FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
FROM sized
"""


@query("op3_warc", WARC_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_BLANKS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '"
_ASCII_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(split_lines) AS line, generate_subscripts(split_lines, 1) AS line_no
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split_lines FROM documents)
), keyed AS (
  SELECT *, trim(translate(line, {_ASCII_LOWER}), {_BLANKS}) AS line_key FROM lines
), owners AS (
  SELECT line_key, min(doc_id) AS owner FROM keyed WHERE length(line_key) >= 10
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone
  FROM keyed k LEFT JOIN owners o ON k.line_key = o.line_key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), ''))
    AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op4_line_dedup", LINE_DEDUP_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", sha256("text").alias("kept_sha256"))


PREFERENCE_SQL = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)
), wholes AS (
  SELECT conv_id, list([role, text] ORDER BY n) AS whole, list([role, text] ORDER BY n)[1] AS opening
  FROM turns GROUP BY conv_id
), different AS (
  SELECT opening, whole, min(conv_id) AS first, max(conv_id) AS last FROM wholes GROUP BY opening, whole
), per_opening AS (
  SELECT opening, arg_min(whole, first) AS head, min(first) AS first, max(first) AS other,
    CASE WHEN arg_max(whole, last) <> arg_min(whole, first) THEN max(last) ELSE max(first) END AS last
  FROM different GROUP BY opening
), partners AS (
  SELECT w.conv_id, CASE WHEN p.first = p.other THEN NULL WHEN w.whole = p.head THEN p.last ELSE p.first END
    AS partner_id
  FROM wholes w JOIN per_opening p ON w.opening = p.opening
), replies AS (
  SELECT conv_id, n, lag(text) OVER (PARTITION BY conv_id ORDER BY n) AS before,
    n = max(n) OVER (PARTITION BY conv_id) AS is_last FROM turns WHERE role = 'assistant'
), stale AS (
  SELECT t.conv_id, t.n, t.role,
    CASE WHEN r.is_last THEN coalesce(r.before, '') ELSE t.text END AS text
  FROM turns t LEFT JOIN replies r ON t.conv_id = r.conv_id AND t.n = r.n
), sides AS (
  SELECT conv_id, 'chosen' AS side, n, role, text FROM turns
  UNION ALL SELECT p.conv_id, 'rejected', t.n, t.role, t.text
    FROM partners p JOIN turns t ON p.partner_id = t.conv_id
  UNION ALL SELECT p.conv_id, 'rejected', s.n, s.role, s.text
    FROM partners p JOIN stale s ON p.conv_id = s.conv_id WHERE p.partner_id IS NULL
), places AS (
  SELECT conv_id, n,
    count(*) = 2 AND count(DISTINCT role) = 1 AND count(DISTINCT text) = 1 AS equal
  FROM sides GROUP BY conv_id, n
), prefixes AS (
  SELECT conv_id, CAST(coalesce(min(n) FILTER (WHERE NOT equal) - 1, max(n)) AS BIGINT) AS n_prompt_turns
  FROM places GROUP BY conv_id
), parts AS (
  SELECT s.*, n <= n_prompt_turns AS in_prompt, n_prompt_turns,
    '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered
  FROM sides s JOIN prefixes p ON s.conv_id = p.conv_id
), formatted AS (
  SELECT conv_id, any_value(n_prompt_turns) AS n_prompt_turns,
    coalesce(string_agg(rendered, '' ORDER BY n) FILTER (WHERE in_prompt AND side = 'chosen'), '') AS prompt,
    coalesce(string_agg(rendered, '' ORDER BY n) FILTER (WHERE NOT in_prompt AND side = 'chosen'), '') AS c,
    coalesce(string_agg(rendered, '' ORDER BY n) FILTER (WHERE NOT in_prompt AND side = 'rejected'), '') AS r,
    CAST(coalesce(sum(length(text) + 11) FILTER (
      WHERE NOT in_prompt AND side = 'chosen' AND role = 'assistant'), 0) AS BIGINT) AS chosen_loss_chars,
    CAST(coalesce(sum(length(text) + 11) FILTER (
      WHERE NOT in_prompt AND side = 'rejected' AND role = 'assistant'), 0) AS BIGINT) AS rejected_loss_chars
  FROM parts GROUP BY conv_id
)
SELECT f.conv_id, partner_id, n_prompt_turns, sha256(prompt) AS prompt_sha256,
  sha256(c) AS chosen_sha256, sha256(r) AS rejected_sha256, chosen_loss_chars, rejected_loss_chars,
  chosen_loss_chars > 0 AND rejected_loss_chars > 0 AND c <> r AS usable
FROM formatted f JOIN partners p ON f.conv_id = p.conv_id
"""


@query("op5_preference_format", PREFERENCE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preferences.paired_by_opening(table(spark, sf_dir, "conversations"))

    def loss_chars(spans: str):
        zero = F.lit(0).cast("bigint")
        return F.aggregate(spans, zero, lambda total, s: total + s["end"] - s["start"])

    return preferences.format_pairs(pairs).select(
        "conv_id", "partner_id", "n_prompt_turns",
        sha256("prompt").alias("prompt_sha256"),
        sha256("chosen_completion").alias("chosen_sha256"),
        sha256("rejected_completion").alias("rejected_sha256"),
        loss_chars("chosen_spans").alias("chosen_loss_chars"),
        loss_chars("rejected_spans").alias("rejected_loss_chars"),
        "usable",
    )


WINNOW_SQL = f"""
WITH doc_lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII_LOWER}),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), item_lists AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII_LOWER}),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS w,
    array_to_string(words[start : start + least(len(words), 10) - 1], ' ') AS span
  FROM (SELECT *, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS start
        FROM item_lists WHERE len(words) > 0)
), lengths AS (SELECT DISTINCT w FROM item_windows
), doc_windows AS (
  SELECT doc_id, w, start, array_to_string(words[start : start + w - 1], ' ') AS span
  FROM (SELECT doc_id, words, w, unnest(range(1, len(words) - w + 2)) AS start
        FROM doc_lists, lengths WHERE len(words) >= w)
), hits AS (
  SELECT d.doc_id, d.start, d.w, i.item_id
  FROM doc_windows d JOIN item_windows i ON d.w = i.w AND d.span = i.span
), words_hit AS (
  SELECT doc_id, count(DISTINCT word_no) AS n_hit
  FROM (SELECT doc_id, unnest(range(start, start + w)) AS word_no
        FROM (SELECT DISTINCT doc_id, start, w FROM hits)) GROUP BY doc_id
), items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_lists d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""


@query("op6_decontamination", WINNOW_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


QUALITY_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), listed AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda line: trim(line, {_BLANKS}) <> '') AS lines
  FROM texts
), starts AS (
  SELECT doc_id, start, array_to_string(words[start : start + 7], ' ') AS span
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS start
        FROM listed WHERE len(words) > 8)
), again AS (
  SELECT s.doc_id, s.start FROM starts s JOIN (
    SELECT doc_id, span FROM starts GROUP BY doc_id, span HAVING count(*) > 1
  ) r ON s.doc_id = r.doc_id AND s.span = r.span
), repeats AS (
  SELECT doc_id, count(DISTINCT word_no) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(start, start + 8)) AS word_no FROM again) GROUP BY doc_id
), measured AS (
  SELECT l.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(words, lambda w: lower(w) IN ({", ".join(f"'{w}'" for w in quality.STOP_WORDS)})))
      AS n_stop
  FROM listed l LEFT JOIN repeats r ON l.doc_id = r.doc_id
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words
    AND 10 * n_symbols <= n_words AND 50 * n_stop >= n_words AND 2 * n_dup_lines <= n_lines AS kept
FROM judged
"""


@query("op7_quality_rules", QUALITY_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, model)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op9_simhash_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_toxicity(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs)
    return language.with_language(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


SEARCH_SQL = f"""
WITH doc_terms AS (
  SELECT row_no, doc_id, unnest(regexp_extract_all(translate(text, {_ASCII_LOWER}),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row_no, doc_id, text FROM documents)
), item_terms AS (
  SELECT item_id, term, CAST(count(*) AS BIGINT) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, {_ASCII_LOWER}),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), sizes AS (
  SELECT row_no, count(*) AS n FROM doc_terms GROUP BY row_no
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), postings AS (
  SELECT row_no, doc_id, term, count(*) AS tf FROM doc_terms
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM postings, total GROUP BY term
), impacts AS (
  SELECT p.row_no, p.doc_id, p.term,
    w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))) AS part
  FROM postings p JOIN weights USING (term) JOIN sizes USING (row_no), total
), scores AS (
  SELECT item_id, row_no, doc_id, CAST(sum(times * part) AS BIGINT) AS score
  FROM item_terms JOIN impacts USING (term) GROUP BY ALL HAVING score > 0
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
  doc_id, score
FROM scores QUALIFY rank <= 20
"""


@query("op12_ranked_search", SEARCH_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The unsigned crc32 of a decimal id, byte by byte and bit by bit; -1 stands for a shift.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(CAST(conv_id AS VARCHAR), ''),
  lambda c: list_concat([CAST(ascii(c) AS BIGINT)], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
    WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""

TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role || chr(0) || text) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), heads AS (
  SELECT c.conv_id, pos AS depth, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND pos <= h
), sizes AS (
  SELECT conv_id, count(*) AS n_head FROM heads GROUP BY conv_id
), rebuilt AS (
  FROM heads UNION ALL
  SELECT c.conv_id, coalesce(n_head, 0) + pos - h, role, text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos > h LEFT JOIN sizes s ON s.conv_id = c.conv_id
), prefixes AS (
  SELECT conv_id, 0 AS depth, [] AS path, 0 AS bytes FROM convs UNION ALL
  SELECT conv_id, depth, list([role, text]) OVER (PARTITION BY conv_id ORDER BY depth),
    octet_length(encode(text)) FROM rebuilt
), placed AS (
  SELECT conv_id, depth, bytes, min(conv_id) OVER (PARTITION BY depth, path) AS owner,
    max(depth) OVER (PARTITION BY conv_id) AS length FROM prefixes
), nodes AS (
  SELECT owner, depth, count(*) AS n_convs, any_value(bytes) AS bytes, max(length) = depth AS is_leaf,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = length), ''))
      AS ends_sha256
  FROM placed GROUP BY owner, depth
), tree AS (
  SELECT n.*, p.owner AS parent FROM nodes n
  LEFT JOIN placed p ON p.conv_id = n.owner AND p.depth = n.depth - 1
), children AS (
  SELECT parent AS owner, depth - 1 AS depth, count(*) AS n FROM tree WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT p.owner, p.depth, count(*) FILTER (WHERE is_leaf) AS n_leaves, sum((n_convs - 1) * n.bytes) AS saved
  FROM nodes n JOIN placed p ON p.conv_id = n.owner AND p.depth <= n.depth GROUP BY p.owner, p.depth
)
SELECT t.owner AS conv_id, CAST(t.depth AS BIGINT) AS depth, parent AS parent_conv_id, n_convs,
  coalesce(c.n, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM tree t JOIN below b ON t.owner = b.owner AND t.depth = b.depth
LEFT JOIN children c ON t.owner = c.owner AND t.depth = c.depth
"""


@query("op13_prefix_trie", TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
