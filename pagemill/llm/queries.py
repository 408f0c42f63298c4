"""The registered queries of the operators of this subpackage, each over its whole table.

The operators return texts, ids, spans and rates; the queries derive from them the columns
that the contracts name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bpe, chat, fim, html_blocks, importance, kneser_ney, mixing, pii, quality_model, quality_rules, simhash, topk
from pagemill.llm.edit_counts import TokenCounts
from pagemill.session import materialize
from pagemill.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", heavy=True)


def vocabulary() -> str:
    """The tokenizer file of the queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ids_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


@query
def op1_bpe(spark, sf_dir):
    """Token ids of every document and the text decoded from them, as digests."""
    coded = bpe.Bpe(spark, vocabulary()).transcode(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_html(spark, sf_dir):
    """Main text of every page."""
    text = html_blocks.main_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )


@query
def op3_chat(spark, sf_dir):
    """Maximal conversations, rendered."""
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


@query
def op4_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select(
        F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


@query
def op5_quality_rules(spark, sf_dir):
    """Word statistics, base rule and the weighed verdict of all rules for every document."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


#: The pseudonyms of the queries; in production a secret.
PII_KEY = "public-test-key"


@query
def op6_pii(spark, sf_dir):
    """Every document with personal data replaced by pseudonyms."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(documents, PII_KEY)


#: The domains of the mix: what a label row says, and the wanted shares of the tokens.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'low' WHEN quality = 1 THEN 'clean' END"
WEIGHTS = {"clean": 0.975, "low": 0.005, "toxic": 0.02}


@query
def op7_mixing(spark, sf_dir):
    """Posteriors, rate and copies of every document for the target mix, and what the mix misses."""
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    mixed = mixing.mix(documents, labels, F.expr(DOMAIN), WEIGHTS, keep=["doc_id"])
    return mixed.select("doc_id", "n_tokens", *[f"p_{d}" for d in WEIGHTS], "rate", "copies", *[f"missed_{d}" for d in WEIGHTS])


@query
def op8_token_counts(spark, sf_dir):
    """Tokens of every document before and after three edits: a word in the middle, a cut near
    the start, an ending."""
    size = F.coalesce(F.length("text"), F.lit(0))
    edits = F.array(
        F.struct((size / 2).cast("int").alias("place"), F.lit(0).alias("length"), F.concat(F.lit(" "), F.col("source")).alias("new")),
        F.struct((size / 8).cast("int").alias("place"), F.lit(24).alias("length"), F.lit("").alias("new")),
        F.struct((size + 64).alias("place"), F.lit(0).alias("length"), F.concat(F.lit("\n"), F.col("lang"), F.lit(".")).alias("new")),
    )
    of = TokenCounts(spark, vocabulary())
    counted = table(spark, sf_dir, "documents").select("doc_id", of.after_edits(F.col("text"), edits).alias("c"))
    return counted.select(
        "doc_id", F.col("c.n_before").alias("n_tokens"), F.col("c.n_after").alias("n_tokens_edited"),
        F.col("c.encoded").alias("n_chars_encoded"), F.sha2("c.text", 256).alias("text_sha256"),
    )


@query
def op9_quality_model(spark, sf_dir):
    """Quality score of every document by a model of the labels that are not held out."""
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    rows = documents.select("doc_id", held_out.alias("held_out"), quality_model.statistics(F.col("text")).alias("x"))
    rows = materialize(rows, "statistics")
    known = labels.select("doc_id", F.col("quality").alias("y")).distinct()
    model = quality_model.fit(rows.filter(~F.col("held_out")).join(known, "doc_id"))
    return quality_model.score(rows, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op10_top_k(spark, sf_dir):
    """The ten best inner products of every hundredth vector."""

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * 1024
        # From 2 ** 53 on a double is whole already, and may be too large for a long.
        return F.when(F.abs(scaled) < float(1 << 53), F.floor(scaled).cast("double")).otherwise(scaled)

    vectors = table(spark, sf_dir, "embeddings").withColumn("embedding", F.transform("embedding", whole))
    return topk.top_k(vectors, F.col("id") % 100 == 0, k=10)


@query
def op11_fim(spark, sf_dir):
    """Fill-in-the-middle form of every document, and the digests of its output and of the text restored from it."""
    of = fim.FillInMiddle(("<P>", "<S>", "<M>"), rate=100, spm=50, seed=7)
    folded = table(spark, sf_dir, "documents").select("doc_id", of.apply(F.col("doc_id"), F.col("text")).alias("f"))
    names = ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    return folded.select("doc_id", *[f"f.{name}" for name in names])


@query
def op12_importance(spark, sf_dir):
    """Weight of every document towards the benchmark, and a quarter of the documents drawn by it."""
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    drawn = importance.resample(documents, benchmark, percent=25, least_words=20, seed=7)
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@query
def op13_lm(spark, sf_dir):
    """Log probability of every document by a model of those that are not held out."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    return kneser_ney.score(rows, kneser_ney.fit(rows.filter(~F.col("held_out"))))
