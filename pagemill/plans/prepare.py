"""From stored page records to training files, and from those to training text, in one call."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.prompts import chat_text
from pagemill.functions.text import TOKEN_LIMIT
from pagemill.operators.curate import cap_tokens, curated_entries, training_pairs
from pagemill.operators.report import FEW_ENTRIES
from pagemill.operators.split import SPLIT_SEED, VAL_RATIO, sample_pair, train_val_split
from pagemill.session import materialize
from pagemill.sources.jsonl import SOURCE_ORDER, read_jsonl, read_pairs, write_split
from pagemill.sources.published import publish


def prepare_data(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    val_ratio: float = VAL_RATIO,
    seed: int = SPLIT_SEED,
    glob: str | None = "*.jsonl",
    as_version: bool = False,
) -> dict[str, int | bool | dict | None]:
    """Read JSONL records, keep the first long record of every URL, form pairs, split and
    write them in seeded order. Returns the run's totals and a sample pair, None if there is none.

    With `as_version` both parts go below a new folder of `output_path`, which `published` names once both
    are whole; a run that dies leaves the parts of the run before in force.

    The records are read and deduplicated once, into a table. The write reads all of it, the
    cut and the totals one column.
    """
    records = read_jsonl(spark, input_path, glob=glob)
    files = len(records.inputFiles())
    pairs = materialize(training_pairs(curated_entries(records, order=SOURCE_ORDER), "url"), "pairs")
    labelled = train_val_split(pairs, "url", val_ratio, seed)

    def write(folder: str) -> None:
        write_split(labelled, folder, key="url", seed=seed, mode="overwrite" if as_version else "errorifexists")

    if as_version:
        publish(spark, output_path, write)
    else:
        write(output_path)
    sizes = {row["split"]: row["count"] for row in labelled.groupBy("split").count().collect()}
    train, val = sizes.get("train", 0), sizes.get("val", 0)
    entries = train + val
    sample = sample_pair(labelled, "url", seed).select("prompt", "completion").first()
    return {
        "files": files,
        "entries": entries,
        "train": train,
        "val": val,
        "few_entries": entries < FEW_ENTRIES,
        "sample": sample and sample.asDict(),
    }


def training_text(
    spark: SparkSession,
    train_path: str,
    val_path: str | None = None,
    limit: int = TOKEN_LIMIT,
    tokenizer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(split, text, n_tokens): training pairs, and validation pairs if their path is given
    and exists, as chat text cut to `limit` tokens."""
    parts = [read_pairs(spark, train_path).withColumn("split", F.lit("train"))]
    if val_path:
        parts.append(read_pairs(spark, val_path, optional=True).withColumn("split", F.lit("val")))
    pairs = reduce(DataFrame.unionByName, parts)
    chat = pairs.select("split", chat_text(F.col("prompt"), F.col("completion")).alias("text"))
    return cap_tokens(chat, "text", limit, tokenizer)
