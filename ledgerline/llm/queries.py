"""Named queries of the operators in this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, brown, htmltext, language, lines, mixing, neighbours, quality, rans, repair, simhash, toxicity
from .common import documents, new_path


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).drop("fp")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip_digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeated_lines(documents(spark, sf_dir)).select("doc_id", "n_removed", "text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(documents(spark, sf_dir))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(documents(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_cascade(documents(spark, sf_dir)).drop("rules_run")


def op9_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "rans")
    rans.write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), path)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return rans.read_tokens(spark, path).select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op11_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scored(documents(spark, sf_dir))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(documents(spark, sf_dir, "conversations"))


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_neighbours": op2_neighbours,
    "op3_toxicity": op3_toxicity,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_html_text": op7_html_text,
    "op8_quality": op8_quality,
    "op9_rans": op9_rans,
    "op10_language": op10_language,
    "op11_brown": op11_brown,
    "op12_repair": op12_repair,
    "op13_audit": op13_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op6_mixing": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (SELECT *, CAST(place % 3 + 1 AS BIGINT) AS weight, 3 * source_size AS most FROM s),
-- rounds: what is left is shared by weight among the sources that are open; those above their most stop there
fill AS (
  SELECT 0 AS round, place, weight, most, FALSE AS stopped, (SELECT sum(source_size) FROM w) AS total FROM w
  UNION ALL
  SELECT round + 1, place, weight, most,
         stopped OR CAST(most AS DOUBLE) / weight <= (total - sum(CASE WHEN stopped THEN most ELSE 0 END) OVER ())
                    / CAST(sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER () AS DOUBLE), total
  FROM fill WHERE round < 40),
t AS (
  SELECT place, CASE WHEN stopped THEN CAST(most AS DOUBLE) ELSE
         CAST(total - sum(CASE WHEN stopped THEN most ELSE 0 END) OVER () AS DOUBLE)
         / CAST(sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER () AS DOUBLE) * weight END AS target
  FROM fill WHERE round = 40),
q AS (SELECT w.source, w.place, w.source_size, t.target, CAST(round(t.target) AS BIGINT) AS quota FROM w JOIN t USING (place)),
n AS (
  SELECT words, b, (words + b // 2) // b AS slots
  FROM (SELECT words, greatest(1, least(1024, words // 65536)) AS b FROM (SELECT CAST(coalesce(sum(quota), 0) AS BIGINT) AS words FROM q))),
spans AS (SELECT place, sum(quota) OVER (ORDER BY place) - quota AS lo, sum(quota) OVER (ORDER BY place) AS hi FROM q WHERE quota > 0),
points AS (
  SELECT k AS slot, CAST(floor((((k + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE) % 1.0::DOUBLE) * words) AS BIGINT) AS point
  FROM n, (SELECT unnest(range((SELECT slots FROM n))) AS k)),
slots AS (
  SELECT place, slot, row_number() OVER (PARTITION BY place ORDER BY slot) - 1 AS rank FROM points JOIN spans ON point >= lo AND point < hi),
given AS (SELECT q.*, least(c.blocks * b, 3 * source_size) AS given, b FROM q JOIN (SELECT place, count(*) AS blocks FROM slots GROUP BY place) c USING (place), n),
turns AS (
  SELECT d.*, g.place, g.given, g.b, e.epoch,
         e.epoch * g.source_size + coalesce(sum(size) OVER (PARTITION BY g.place, e.epoch ORDER BY md5(e.epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), size, r
                                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN given g ON d.source IS NOT DISTINCT FROM g.source, (VALUES (0), (1), (2)) e(epoch)),
begun AS (
  SELECT r, greatest(0, least(size, given - start)) AS words, slot FROM turns t LEFT JOIN slots s ON t.size > 0 AND t.start < t.given AND s.place = t.place AND s.rank = t.start // t.b),
taken AS (SELECT r, CAST(sum(words) AS BIGINT) AS taken, min(slot) AS first_slot FROM begun GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN taken USING (r)""",
    "op8_quality": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT a.doc_id, unnest(range(i, i + 5)) AS p FROM windows w JOIN again a ON w.doc_id = a.doc_id AND w.win = a.win)
  GROUP BY doc_id),
base AS (
  SELECT d.doc_id, t, w, lines, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words)
       AND NOT (10 * (length(t) - length(replace(t, '!', ''))) > 3 * n_words)
       AND word_chars BETWEEN 2 * n_words AND 20 * n_words
       AND NOT (2 * n_dup_lines > len(lines))
       AND NOT (len(lines) > 2 AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{2022}]'))) > 9 * len(lines))
       AND NOT (len(lines) > 2 AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '([.][.][.]|\x{2026})[\x20\x09-\x0D]*$'))) > 3 * len(lines))
       AND NOT (10 * coalesce(list_max(map_values(list_histogram(w))), 0) > 3 * n_words)
       AND NOT (10 * len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) < 5 * n_words) AS kept
FROM judged""",
    "op12_repair": r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN (a & 1) = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) x(i)),
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ord(x)::BIGINT)),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM c WHERE kind <> 0),
o AS (
  SELECT *, left(role, 1) AS ini, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM o),
-- what is cheapest up to a turn for each state: cost, letters, rows; of equal costs the least letters
s AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]} AS s0, {'c': 1000000000000::BIGINT, 'a': '', 'o': []::VARCHAR[]} AS s1,
         {'c': 3::BIGINT, 'a': 'I', 'o': ['user:']} AS s2, {'c': 6::BIGINT, 'a': 'II', 'o': ['user:', 'assistant:']} AS s3
  FROM (SELECT DISTINCT conv_id FROM d)
  UNION ALL
  SELECT conv_id, i, n0, n1, m2, list_sort([n3, {'c': m2.c + 3, 'a': m2.a || 'I', 'o': list_append(m2.o, 'assistant:')}])[1] FROM (
    SELECT conv_id, i, n0, n1, n3, list_sort([n2, {'c': n0.c + 3, 'a': n0.a || 'I', 'o': list_append(n0.o, 'user:')},
           {'c': n1.c + 3, 'a': n1.a || 'I', 'o': list_append(n1.o, 'user:')}, {'c': n3.c + 3, 'a': n3.a || 'I', 'o': list_append(n3.o, 'user:')}])[1] AS m2 FROM (
      SELECT conv_id, i, {'c': s0.c + 4, 'a': s0.a || 'D', 'o': s0.o} AS n0,
             list_sort([{'c': s1.c + 4, 'a': s1.a || 'D', 'o': s1.o}, {'c': s0.c + cut + only_s, 'a': s0.a || 'K', 'o': list_append(s0.o, role || ':' || text)}])[1] AS n1,
             list_sort([{'c': s2.c + 4, 'a': s2.a || 'D', 'o': s2.o},
                        {'c': s0.c + cut + only_u, 'a': s0.a || 'K', 'o': list_append(s0.o, role || ':' || text)}, {'c': s0.c + cut + 3, 'a': s0.a || 'R', 'o': list_append(s0.o, 'user:' || text)},
                        {'c': s1.c + cut + only_u, 'a': s1.a || 'K', 'o': list_append(s1.o, role || ':' || text)}, {'c': s1.c + cut + 3, 'a': s1.a || 'R', 'o': list_append(s1.o, 'user:' || text)},
                        {'c': s3.c + cut + only_u, 'a': s3.a || 'K', 'o': list_append(s3.o, role || ':' || text)}, {'c': s3.c + cut + 3, 'a': s3.a || 'R', 'o': list_append(s3.o, 'user:' || text)}])[1] AS n2,
             list_sort([{'c': s3.c + 4, 'a': s3.a || 'D', 'o': s3.o},
                        {'c': s2.c + cut + only_a, 'a': s2.a || 'K', 'o': list_append(s2.o, role || ':' || text)}, {'c': s2.c + cut + 3, 'a': s2.a || 'R', 'o': list_append(s2.o, 'assistant:' || text)}])[1] AS n3
      FROM (
        SELECT s.conv_id, f.i, s0, s1, s2, s3, role, text,
               CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000000 WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut,
               CASE WHEN ini = 's' THEN 0 ELSE 1000000000000 END AS only_s, CASE WHEN ini = 'u' THEN 0 ELSE 1000000000000 END AS only_u,
               CASE WHEN ini = 'a' THEN 0 ELSE 1000000000000 END AS only_a
        FROM s JOIN f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1)))),
totals AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prior IS NOT NULL AND prior || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
best AS (
  SELECT totals.*, list_sort([s0, s3])[1] AS b FROM totals JOIN s ON s.conv_id IS NOT DISTINCT FROM totals.conv_id AND s.i = totals.n)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(array_to_string(b.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN best ON a.conv_id IS NOT DISTINCT FROM best.conv_id""",
    "op13_audit": r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, FALSE)) AS good, bool_or(coalesce(toxic = 1, FALSE)) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
counts AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS x, left(filter_order, step - 1) AS before FROM orders, range(1, 6) r(step)),
told AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails = x AS alone, contains(fails, x) AS hit,
         length(before) > 0 AND length(translate(fails, before, '')) < length(fails) AS gone
  FROM counts, steps),
audit AS (
  SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND hit), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM audit""",
}
