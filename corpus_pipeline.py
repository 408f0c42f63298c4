"""A training corpus from raw documents: each stage is one operator over all that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bpe, mixing, pii, quality_rules, simhash
from pagemill.llm.queries import DOMAIN, PII_KEY, WEIGHTS, vocabulary
from pagemill.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: When sources are mixed: the weight of rates near one, since clean documents count more than exact shares, and how often a
#: document is taken at most.
NEAR, HIGHEST = 0.05, 2.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the weighed rules keep."""
    return quality_rules.judge(docs).filter("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, null last, then the smallest digest of the row."""
    # Two hashes of a whole row tell rows apart that share an id, or have none; rows with equal ones are equal throughout.
    digest = {"a": F.xxhash64(*COLUMNS), "b": F.xxhash64(F.lit("b"), *COLUMNS)}
    marked = docs.select(*COLUMNS, *[c.alias(n) for n, c in digest.items()])
    found = simhash.near_duplicates(marked, shingle=3, max_bits=2, keep=["a", "b"])
    first = found.groupBy("near").agg(F.min(F.struct(F.col("id").isNull(), "id", "a", "b")).alias("first"))
    kept = materialize(first.select("first.a", "first.b"), "kept")
    # The kept rows grow with the documents: the same join at every size, never a broadcast.
    out = marked.join(kept.hint("merge"), ["a", "b"], "left_semi")
    repeated = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").join(kept, ["a", "b"], "left_semi")
    repeated = materialize(repeated.select("a", "b"), "repeated")
    if repeated.isEmpty():
        return out.select(COLUMNS)
    single = out.join(repeated, ["a", "b"], "left_anti").select(COLUMNS)
    return single.union(out.join(repeated, ["a", "b"], "left_semi").dropDuplicates(["a", "b"]).select(COLUMNS))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced; n_chars is that of the new text."""
    new = pii.pseudonymise(docs, PII_KEY, count_col=None)
    return new.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled to the target shares of clean, low and toxic tokens, as far as clean ones stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.sample(mixing.mix(docs, labels, F.expr(DOMAIN), WEIGHTS, near=NEAR, highest=HIGHEST), COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    coded = bpe.Bpe(spark, vocabulary()).transcode(docs, keep=COLUMNS)
    same = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))
    return coded.select(*COLUMNS, "ids", F.size("ids").cast("bigint").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", near_duplicates),
    ("pii", pseudonyms),
    ("mixing", mix),
    ("bpe", tokens),
]

#: Fingerprints, pseudonyms and token ids have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
