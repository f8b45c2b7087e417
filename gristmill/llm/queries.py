"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gristmill.llm import (
    alignment, decontaminate, exact_dedup, language, line_dedup, mixing, pii, repeats, repetition, resample, secrets, simhash,
    toxicity)
from gristmill.llm.common import held_out, table

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(table(spark, sf_dir, "documents"))


OP1 = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(lines[p + 1:p + 3], chr(10)) AS w
  FROM split, unnest(range(0, len(lines) - 2)) t(p)
  WHERE array_to_string(lines[p + 1:p + 3], '') <> ''),
later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k FROM windows)
  WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p + s AS line FROM later, unnest([0, 1, 2]) t(s)),
runs AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (fresh) AS n_spans FROM (
    SELECT doc_id, line - lag(line, 1, -9) OVER (PARTITION BY doc_id ORDER BY line) > 1 AS fresh FROM gone)
  GROUP BY doc_id),
rest AS (
  SELECT doc_id, string_agg(lines[l + 1], chr(10) ORDER BY l) AS kept
  FROM split, unnest(range(0, len(lines))) t(l)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = split.doc_id AND g.line = l)
  GROUP BY doc_id)
SELECT doc_id, len(lines) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN runs USING (doc_id) LEFT JOIN rest USING (doc_id)"""


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.decide(table(spark, sf_dir, "documents"), keep="last")
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP2 = f"""
WITH lowered AS (SELECT doc_id, {LOWERED} AS low FROM documents),
sized AS (
  SELECT low, max(doc_id) AS keep_id, count(*) AS group_size FROM lowered GROUP BY low)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(low) AS text_sha256
FROM lowered JOIN sized USING (low)"""

def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


# A source is capped while the level at which it would be the next open one lies above it.
OP3 = r"""
WITH sized AS (
  SELECT doc_id, source, md5('0:' || doc_id::VARCHAR || ':' || md5(coalesce(text, ''))) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
steps AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources WINDOW before AS (
    ORDER BY 2.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (
  SELECT level FROM steps WHERE level * weight <= 2.0::DOUBLE * source_size
  ORDER BY 2.0::DOUBLE * source_size / weight, source LIMIT 1),
aims AS (
  SELECT source, source_size,
    CASE WHEN final.level * weight > 2.0::DOUBLE * source_size THEN 2.0::DOUBLE * source_size
      ELSE final.level * weight END AS target
  FROM sources, final),
ordered AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized),
cut AS (
  SELECT o.*, a.source_size, a.target, floor(a.target)::BIGINT AS budget,
    CASE WHEN a.source_size > 0 THEN floor(a.target)::BIGINT // a.source_size ELSE 0 END AS epochs
  FROM ordered o JOIN aims a ON o.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)))::BIGINT AS taken
FROM cut"""

def _span_digest(spans: str, kinds: list[str] | None = None):
    chosen = F.filter(spans, lambda s: s["kind"].isin(kinds)) if kinds else F.col(spans)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _span_count(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = list(secrets.KINDS[:3])
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *[_span_count("spans", k) for k in base],
        F.sha2(_span_digest("spans", base), 256).alias("base_sha256"), _span_digest("spans").alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.CUTOFF).cast("int").alias("predicted"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = list(pii.BASE)
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *[_span_count("spans", k) for k in base],
        F.sha2(_span_digest("spans", base), 256).alias("base_sha256"), _span_digest("spans").alias("spans"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


WORDS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP7 = f"""
WITH d AS (SELECT doc_id, {WORDS.format(text=LOWERED)} AS words FROM documents),
b AS (SELECT item_id, {WORDS.format(text=LOWERED)} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(words[i + 1:i + 10], ' ') AS w
  FROM b, unnest(range(0, greatest(len(words) - 9, 1))) t(i) WHERE len(words) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, p, n, array_to_string(words[p + 1:p + n], ' ') AS w
  FROM d, lengths, unnest(range(0, len(words) - n + 1)) t(p)),
found AS (SELECT doc_id, p, n, item_id FROM places JOIN windows USING (n, w)),
covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM (SELECT DISTINCT doc_id, p, n FROM found), unnest(range(0, n)) t(k)
  GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


# SQL has no crc32: its table of 256 remainders, then one step per byte of each distinct word.
OP11 = f"""
WITH remainders AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i], list_transform(range(8), lambda k: 0::BIGINT)),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS r),
d AS (
  SELECT row_number() OVER () AS row, doc_id, {WORDS.format(text=LOWERED)} AS words FROM documents),
dw AS (SELECT row, unnest(words) AS word FROM d),
bw AS (SELECT unnest({WORDS.format(text=LOWERED)}) AS word FROM benchmark),
hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT word FROM dw UNION SELECT word FROM bw), remainders),
source AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM source) + 10000)
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM target) + 10000))))::BIGINT AS gain
  FROM source FULL JOIN target USING (bucket)),
summed AS (
  SELECT row, sum(gain)::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row),
scored AS (
  SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN summed USING (row)),
ranks AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS draw
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= draw THEN rank END AS rank
FROM scored LEFT JOIN ranks USING (row)"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered", "longest")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_source_mix": op3_source_mix,
    "op4_secret_scan": op4_secret_scan,
    "op5_toxicity": op5_toxicity,
    "op6_personal_data": op6_personal_data,
    "op7_decontaminate": op7_decontaminate,
    "op8_language": op8_language,
    "op9_repeated_bytes": op9_repeated_bytes,
    "op10_simhash_groups": op10_simhash_groups,
    "op11_importance_resample": op11_importance_resample,
    "op12_quality_rules": op12_quality_rules,
    "op13_token_alignment": op13_token_alignment,
}
SQL = {
    "op1_line_dedup": OP1,
    "op2_exact_dedup": OP2,
    "op3_source_mix": OP3,
    "op7_decontaminate": OP7,
    "op11_importance_resample": OP11,
}
