"""Sources and sinks: what is written comes back whole."""

import uuid

from pyspark.sql import Window, functions as F

from gristmill.catalog import cleaning, explaining, inputs, quality, sampling as sampled, scanning, scoring
from gristmill.catalog.modelling import SCORER
from gristmill.operators import attribution, classifier, clean, metrics, sampling, scan
from gristmill.plans import workflow
from gristmill.plans.lineage import shared_dir
from gristmill.sources import reviews as source, sinks
from gristmill.sources.stages import check_stage, manifests, read_stage, write_previews, write_stage


def _folder(spark):
    return f"{shared_dir(spark)}/gristmill-stage-{uuid.uuid4().hex}"


def load_formats(spark, sf):
    """The review table, with its columns in another order and one more, in four formats."""
    base = _folder(spark)
    wide = inputs.reviews(spark, sf).select("positive", F.lit("x").alias("hotel"), "id", "negative")
    loaded = None
    for fmt, options in (("parquet", {}), ("orc", {}), ("json", {}),
                         ("csv", {"header": True, "multiLine": True, "escape": '"', "nullValue": "\\N"})):
        wide.write.format(fmt).options(**options).save(f"{base}/{fmt}")
        one = source.load_reviews(spark, f"{base}/{fmt}", fmt, "id", "negative", "positive", **options)
        facts = one.agg(
            F.lit(fmt).alias("format"), F.count("*").alias("rows"), F.count("negative").alias("negatives"),
            F.count("positive").alias("positives"), F.sum(F.length("negative")).alias("negative_chars"),
            F.sum(F.length("positive")).alias("positive_chars"))
        loaded = facts if loaded is None else loaded.unionByName(facts)
    return loaded


def load_without_id(spark, sf):
    """Reviews without an id column, loaded, cleaned and counted."""
    path = f"{_folder(spark)}/reviews"
    inputs.reviews(spark, sf).select("negative", "positive").write.parquet(path)
    loaded = source.load_reviews(spark, path, negative_col="negative", positive_col="positive")
    cleaned = clean.clean_reviews(loaded)

    def facts(df, part, chars):
        return df.agg(F.lit(part).alias("part"), F.count("*").alias("rows"), F.count_distinct("id").alias("ids"),
                      F.count_if(F.col("id").isNull() | (F.col("id") < 0)).alias("bad_ids"), F.sum(chars).alias("chars"))

    both = F.coalesce(F.length("negative"), F.lit(0)) + F.coalesce(F.length("positive"), F.lit(0))
    return facts(loaded, "loaded", both) \
        .unionByName(facts(cleaned.filter("label = 0"), "negative", F.length("text"))) \
        .unionByName(facts(cleaned.filter("label = 1"), "positive", F.length("text")))


def content_ids(spark, sf):
    """The id of every review without an id column, where one more review fills a third of the table."""
    path = f"{_folder(spark)}/reviews"
    rows = inputs.reviews(spark, sf).select("id", "negative", "positive")
    same = rows.filter("id % 2 = 0").select("id", F.lit("No Negative").alias("negative"), F.lit(None).cast("string").alias("positive"))
    rows.unionByName(same).repartition(16, "id").select("negative", "positive").write.parquet(path)
    loaded = source.load_reviews(spark, path, negative_col="negative", positive_col="positive")
    return loaded.select("id", F.md5(F.concat_ws("|", F.coalesce("negative", F.lit("-")), F.coalesce("positive", F.lit("-")))).alias("digest"))


def inference(spark, sf):
    """All documents scored by a whole run's saved model, against its own test scores and by its threshold."""
    base = f"{shared_dir(spark)}/gristmill-run-{uuid.uuid4().hex}"
    corpus = inputs.corpus(spark, sf, per_token=True)
    write_stage(corpus, base, "quality_fixed")
    settings = workflow.Settings(reg_params=(0.1,))
    workflow.run_split(spark, base, settings)
    workflow.run_tune(spark, base, settings)
    workflow.run_evaluate(spark, base, settings)
    found = workflow.run_inference(spark, base, inputs.texts(spark, sf))
    before = read_stage(spark, base, "scored").select("id", F.col("p_pos").alias("before"))
    fine = (F.col("pred") == (F.col("p_pos") >= 0.5).cast("int")) & F.col("p_pos").between(0.0, 1.0) \
        & (F.col("label_name") == F.when(F.col("p_pos") >= 0.5, "positive").otherwise("negative"))
    return found.join(before, "id", "left").select(
        "id", "text", fine.alias("fine"), F.col("before").isNotNull().alias("tested"),
        F.coalesce(F.col("before") == F.col("p_pos"), F.lit(True)).alias("same"))


def quality_log_text(spark, sf):
    """The issue log written as text files and read back: every line with its number over all files."""
    base = _folder(spark)
    result = quality._pass(spark, sf)
    sinks.write_issue_log(result.log, result.steps, f"{base}/log")
    files = spark.read.text(f"{base}/log", wholetext=True).select(F.input_file_name().alias("file"), F.split("value", "\n").alias("lines"))
    # Every line ends with a break. One row per file.
    ended = files.withColumn("lines", F.slice("lines", F.lit(1), F.size("lines") - 1))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = ended.withColumn("ahead", F.coalesce(F.sum(F.size("lines")).over(ahead), F.lit(0)))
    return placed.select("ahead", F.posexplode("lines").alias("pos", "value")).select(
        (F.col("ahead") + F.col("pos")).cast("long").alias("line"), "value")


def previews(spark, sf):
    base = _folder(spark)
    write_previews(inputs.reviews(spark, sf), base)
    parts = [read_stage(spark, base, f"{p}_preview").select(
        "id", F.lit(p).alias("part"), F.coalesce("text", F.lit("<none>")).alias("text")) for p in ("neg", "pos")]
    return parts[0].unionByName(parts[1])


def stored_splits(spark, sf):
    """Only the test partition is read back."""
    marked = sampling.split_corpus(inputs.corpus(spark, sf))
    return write_stage(marked, _folder(spark), "splits", ("split",)).filter("split = 'test'").select("id", "label")


def stored_tokens(spark, sf):
    tokens = classifier.tokenize(inputs.texts(spark, sf)).select("id", "tokens")
    back = write_stage(tokens, _folder(spark), "tokenized")
    return back.select("id", F.size("tokens").alias("tokens"), F.md5(F.array_join("tokens", " ")).alias("digest"))


def stage_manifest(spark, sf):
    """What the manifests say of a run's first stages: rows and columns of each."""
    base = _folder(spark)
    workflow.run_load(inputs.reviews(spark, sf), base)
    corpus = workflow.run_clean(spark, base)
    write_stage(corpus.select("id", "text", "label"), base, "quality_fixed")
    workflow.run_split(spark, base)
    stages = ("raw_preview", "neg_preview", "pos_preview", "clean", "quality_fixed", "splits")
    for stage in stages:
        check_stage(spark, base, stage)
    return manifests(spark, base, stages).drop("write_id")


def metrics_json(spark, sf):
    path = f"{_folder(spark)}/metrics"
    sinks.write_metrics(metrics.evaluate(inputs.scored(spark, sf)), path)
    back = spark.read.schema("Precision double, Recall double, F1 double, AUROC double, MCC double").json(path)
    return back.select(*[F.round(c, 6).alias(c) for c in back.columns])


def attribution_export(spark, sf):
    path = f"{_folder(spark)}/explain"
    weights = spark.createDataFrame(list(inputs.WORD_WEIGHTS.items()), "token string, weight double")
    corpus = inputs.corpus(spark, sf)
    sinks.write_attributions(attribution.explain_samples(corpus, weights, inputs.INTERCEPT), corpus, path)
    tokens = spark.read.schema("pos int, token string, attr double, sample long").options(**sinks.TSV) \
        .csv(f"{path}/tokens")
    samples = spark.read.schema(
        "sample long, true_label int, pred_label int, pred_proba string, text string"
    ).options(**sinks.TSV).csv(f"{path}/samples")
    return tokens.join(samples.drop("text"), "sample").select(
        F.col("sample").alias("id"), "true_label", "pred_label", "pred_proba", "pos", "token",
        F.round("attr", 6).alias("attr"))


def findings_export(spark, sf):
    path = f"{_folder(spark)}/findings"
    sinks.write_findings(scan.scan(inputs.corpus(spark, sf, per_token=True), SCORER, scanning.MIN_ROWS), path)
    back = spark.read.parquet(path)
    return back.select("scan", "subject", "measure", "rows", F.round("value", 6).alias("value"),
                       F.round("reference", 6).alias("reference"))


QUERIES = {
    "load_formats": load_formats,
    "load_without_id": load_without_id,
    "content_ids": content_ids,
    "inference": inference,
    "previews": previews,
    "stored_splits": stored_splits,
    "stored_tokens": stored_tokens,
    "stage_manifest": stage_manifest,
    "metrics_json": metrics_json,
    "quality_log_text": quality_log_text,
    "attribution_export": attribution_export,
    "findings_export": findings_export,
}

_STRIP = "CAST(sum(length(trim({0}, " + cleaning.SPACES + "))) AS BIGINT)"

SQL = {
    "load_formats": f"""WITH {inputs.REVIEWS}
SELECT format, count(*) AS rows, count(negative) AS negatives, count(positive) AS positives,
  {_STRIP.format('negative')} AS negative_chars, {_STRIP.format('positive')} AS positive_chars
FROM reviews, (VALUES ('parquet'), ('orc'), ('json'), ('csv')) f(format) GROUP BY format""",
    "load_without_id": f"""WITH {inputs.REVIEWS},
cleaned AS ({cleaning.SQL['clean_reviews']})
SELECT 'loaded' AS part, count(*) AS rows, count(*) AS ids, CAST(0 AS BIGINT) AS bad_ids,
  CAST(sum(coalesce(length(trim(negative, {cleaning.SPACES})), 0) + coalesce(length(trim(positive, {cleaning.SPACES})), 0)) AS BIGINT)
    AS chars FROM reviews
UNION ALL SELECT 'negative', count(*), count(*), 0, CAST(sum(length(text)) AS BIGINT) FROM cleaned WHERE label = 0
UNION ALL SELECT 'positive', count(*), count(*), 0, CAST(sum(length(text)) AS BIGINT) FROM cleaned WHERE label = 1""",
    "content_ids": f"""WITH {inputs.REVIEWS},
rows AS (SELECT trim(negative, {cleaning.SPACES}) AS negative, trim(positive, {cleaning.SPACES}) AS positive FROM reviews
  UNION ALL SELECT 'No Negative', NULL FROM reviews WHERE id % 2 = 0)
SELECT row_number() OVER (ORDER BY md5(coalesce(negative, chr(30)) || chr(31) || coalesce(positive, chr(30)))) - 1 AS id,
  md5(coalesce(negative, '-') || '|' || coalesce(positive, '-')) AS digest FROM rows""",
    "inference": f"""SELECT d.doc_id AS id, d.text, true AS fine, s.id IS NOT NULL AS tested, true AS same
FROM documents d LEFT JOIN (SELECT * FROM ({sampled.SQL['split_corpus']}) WHERE split = 'test') s ON s.id = d.doc_id""",
    "previews": f"""WITH {inputs.REVIEWS}
SELECT id, 'neg' AS part, coalesce(negative, '<none>') AS text FROM reviews
UNION ALL SELECT id, 'pos', coalesce(positive, '<none>') FROM reviews""",
    "stored_splits": f"SELECT id, label FROM ({sampled.SQL['split_corpus']}) WHERE split = 'test'",
    "stored_tokens": f"""SELECT id, CAST(len(tokens) AS INTEGER) AS tokens, md5(array_to_string(tokens, ' ')) AS digest
FROM (SELECT doc_id AS id, {inputs.TOKEN_LIST} AS tokens FROM documents)""",
    "stage_manifest": f"""WITH {inputs.REVIEWS},
cleaned AS ({cleaning.SQL['clean_reviews']})
SELECT part || '_preview' AS stage, count(*) AS rows, columns
FROM reviews, (VALUES ('raw', 'id,negative,positive'), ('neg', 'id,text'), ('pos', 'id,text')) p(part, columns) GROUP BY part, columns
UNION ALL SELECT stage, count(*), columns FROM cleaned,
  (VALUES ('clean', 'id,text,label'), ('quality_fixed', 'id,text,label'), ('splits', 'id,text,label,split')) c(stage, columns)
GROUP BY stage, columns""",
    "quality_log_text": f"""WITH {quality._ROUND},
logged AS (
  SELECT 'near_duplicate' AS kind, 1 AS step, id, near_duplicate_score AS score, 0 AS given, 0 AS predicted
  FROM near_issues WHERE is_near_duplicate_issue
  UNION ALL SELECT 'outlier', 3, id, outlier_score, 0, 0 FROM flagged_out WHERE is_outlier_issue
  UNION ALL SELECT * FROM (SELECT 'label', 2, id, label_score, given_label, predicted_label
    FROM labelled WHERE is_label_issue ORDER BY label_score, id LIMIT 10)),
counts AS ({quality.SQL['quality_steps']}),
blocks AS (
  SELECT g.step, 1 AS part, score, g.id, CASE WHEN kind = 'label'
    THEN 'y_true ' || given || ', y_pred ' || predicted || ', text: ' || text
    ELSE concat_ws(chr(10), '', '### ' || kind || ' (score ' || printf('%.4f', score) || ')',
      'label: ' || CASE WHEN label = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END || ' (' || label || ')', 'text: ' || text) END AS body
  FROM logged g JOIN start s ON g.id = s.id
  UNION ALL
  SELECT CASE step WHEN 'near duplicates' THEN 1 WHEN 'labels' THEN 2 ELSE 3 END, 0, 0.0, 0,
    CASE WHEN step = 'near duplicates' THEN '## Iteration 1' || chr(10) ELSE '' END || chr(10)
      || printf('%s: %d rows -> %d rows, %d relabelled', step, rows_in, rows_out, relabelled)
  FROM counts),
lines AS (SELECT string_split(string_agg(body, chr(10) ORDER BY step, part, score, id), chr(10)) AS all_lines FROM blocks)
SELECT CAST(i AS BIGINT) AS line, all_lines[i + 1] AS value FROM lines, unnest(range(0, len(all_lines))) t(i)""",
    "metrics_json": scoring.SQL["evaluate_scored"],
    "attribution_export": explaining.SQL["attribution_samples"],
    "findings_export": scanning.SQL["scan_findings"],
}
