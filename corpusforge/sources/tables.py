"""Readers for the driver tables and the derived working tables every operator test uses.

Derived tables are pure functions of the given tables (no synthetic input), written so
that the SQL twins in :mod:`corpusforge.plans.sqlspec` compute identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions.hashing import unit

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# ---------------------------------------------------------------------------------------
# Fixed noise literals appended to documents (selected by doc_id % 16) so that every
# cleaning rule has something to act on.  Variants 8-15 leave the text unchanged.
NOISE_PREFIXES = [
    "", "", "", "Thanks for reading\n", "#hiring now ", "", "#hiringx ", "\u3000 ",
    "", "", "", "", "", "", "", "",
]
NOISE_SUFFIXES = [
    "",
    " Don\u2019t stop \U0001F680 now.",
    " It's a \u00e2\u20ac\u2122test\u00e2\u20ac\u0153 ok\u00e2\u20ac",
    "",
    " \u2600\ufe0f\u2705",
    " a\u00a0\u200b b\u2028c`d\u00b4e\u001cf",
    " \U0001F9E0 \U0001FA70 `quoted`",
    " \u00c3\u00a9t\u00e9 \ufb01 \u2122",
    "", "", "", "", "", "", "", "",
]
# Label names of the ``labels`` table used as multi-label targets.
LABELS = ["quality", "toxic"]
# ---------------------------------------------------------------------------------------


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``, spread over the cores where it has fewer files than there are cores: for
    queries with much work a row."""
    from corpusforge.operators.dedup import spread
    return spread(load(spark, sf_dir, "documents"), "doc_id")


def noisy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the fixed noise added: ``(doc_id, text, lang, source)``."""
    docs = documents(spark, sf_dir)
    k = (F.col("doc_id") % len(NOISE_PREFIXES) + 1).cast("int")
    pre = F.element_at(F.array(*[F.lit(x) for x in NOISE_PREFIXES]), k)
    suf = F.element_at(F.array(*[F.lit(x) for x in NOISE_SUFFIXES]), k)
    return docs.select("doc_id", F.concat(pre, F.col("text"), suf).alias("text"), "lang", "source")


def label_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form truth ``(row_id, label, y)`` from the ``labels`` table."""
    lab = load(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").alias("row_id"),
                      F.explode(F.array(*[F.struct(F.lit(n).alias("label"), F.col(n).cast("int").alias("y"))
                                          for n in LABELS])).alias("t")).select("row_id", "t.label", "t.y")


def label_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived model probability ``p = round(0.6*u(doc,label) + 0.4*y, 6)``: ``(row_id, label, y, p)``."""
    t = label_truth(spark, sf_dir)
    return t.withColumn("p", F.bround(F.lit(0.6) * unit(F.col("row_id"), F.col("label"))
                                      + F.lit(0.4) * F.col("y"), 6))


# Derived judge answers -----------------------------------------------------------------
JUDGES = 3          # judges per row (judge_no 0..2)
SAMPLES = 3         # samples per judge (sample_no 0..2)
SAMPLE_KEYS = LABELS + ["overall"]


def _grid(df: DataFrame) -> DataFrame:
    return (df.withColumn("judge_no", F.explode(F.sequence(F.lit(0), F.lit(JUDGES - 1))))
            .withColumn("sample_no", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES - 1)))))


def judge_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric judge samples ``(row_id, judge_no, sample_no, label, prob)``.

    ``prob = round(p + 0.3*(u - 0.5), 6)`` around the derived probability (``overall`` uses
    ``u(row,'overall')`` as its base); about 10% of the values are NULL = key absent.
    """
    probs = label_probs(spark, sf_dir).select("row_id", "label", "p")
    overall = probs.select("row_id").distinct().select(
        "row_id", F.lit("overall").alias("label"), F.bround(unit(F.col("row_id"), F.lit("overall")), 6).alias("p"))
    g = _grid(probs.unionByName(overall))
    u_miss = unit(F.col("row_id"), F.col("label"), F.col("judge_no"), F.col("sample_no"), F.lit("miss"))
    u_val = unit(F.col("row_id"), F.col("label"), F.col("judge_no"), F.col("sample_no"))
    prob = F.when(u_miss < 0.1, F.lit(None).cast("double")).otherwise(
        F.bround(F.col("p") + F.lit(0.3) * (u_val - F.lit(0.5)), 6))
    return g.select("row_id", F.col("judge_no").cast("int"), F.col("sample_no").cast("int"), "label",
                    prob.alias("prob"))


def judge_sample_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-numeric sample fields per ``(row_id, judge_no, sample_no)``:
    ``reasons`` (3 words of the document from position sample_no+1), ``rationale`` (empty
    for about half the samples), ``count`` (integer 0..24) and ``flag`` (prob of quality >= .5).
    """
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    rows = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id")).join(docs, "row_id")
    g = _grid(rows)
    key = [F.col("row_id"), F.col("judge_no"), F.col("sample_no")]
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), 0)
    rationale = F.when(unit(*key, F.lit("r")) < 0.5, F.lit("")).otherwise(
        F.concat(F.lit("r"), F.col("sample_no").cast("string"), F.lit("-"),
                 F.substring(F.md5(F.concat_ws(":", *[k.cast("string") for k in key])), 1, 6)))
    return g.select(
        "row_id", F.col("judge_no").cast("int"), F.col("sample_no").cast("int"),
        F.slice(tokens, F.col("sample_no") + 1, 3).alias("reasons"),
        rationale.alias("rationale"),
        F.floor(unit(*key, F.lit("c")) * 25).cast("bigint").alias("count"),
        (unit(*key, F.lit("f")) >= 0.5).alias("flag"))


def given_labels(spark: SparkSession, sf_dir: str, flip_rate: float = 0.05) -> DataFrame:
    """Independent given labels ``(row_id, label, y)``: the truth with ~5% of labels flipped
    (by the portable hash), i.e. known label errors for triage to find."""
    t = label_truth(spark, sf_dir)
    flip = unit(F.col("row_id"), F.col("label"), F.lit("flip")) < flip_rate
    return t.select("row_id", "label", F.when(flip, 1 - F.col("y")).otherwise(F.col("y")).alias("y"))


def judgment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, label, p)``: the label probabilities plus an ``overall`` score per judged row."""
    probs = label_probs(spark, sf_dir).select("row_id", "label", "p")
    overall = probs.select("row_id").distinct().select(
        "row_id", F.lit("overall").alias("label"), F.bround(unit(F.col("row_id"), F.lit("overall")), 6).alias("p"))
    return overall.unionByName(probs)


def recorded_comparisons(spark: SparkSession, sf_dir: str):
    """The ``labels`` table as the answers of a comparison: ``pairs -> (label, id_a, id_b, preferred,
    confidence_raw, reason)``.  Of a pair the row with the higher label is preferred ("overall" goes by
    quality), with confidence 1; equal ones tie, with the confidence "unsure"."""
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")

    def side(x: str) -> DataFrame:
        return labels.select(F.col("doc_id").alias(f"id_{x}"), F.struct("quality", "toxic").alias(x))

    def answers(pairs: DataFrame) -> DataFrame:
        own = lambda x: F.when(F.col("label") == "toxic", F.col(f"{x}.toxic")).otherwise(F.col(f"{x}.quality"))
        both = pairs.join(side("a"), "id_a").join(side("b"), "id_b")
        return both.select("label", "id_a", "id_b",
                           F.when(own("a") > own("b"), "A").when(own("a") < own("b"), "B").otherwise("tie").alias("preferred"),
                           F.when(own("a") == own("b"), "unsure").otherwise("1.0").alias("confidence_raw"),
                           F.concat(F.lit("labelled "), own("a").cast("string"), F.lit(" and "), own("b").cast("string")).alias("reason"))
    return answers
