"""JSON Lines in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.text import strip
from pagemill.operators.split import SPLIT_SEED, key_text, order_hash
from pagemill.schemas import PAGE, PAIR
from pagemill.sources.paths import exists, hidden_files, is_file, make_folder

SOURCE_ORDER = ("file_name", "block_start", "line_id")
REJECTED = "_rejected"


def with_place(rows: DataFrame, *columns: str) -> DataFrame:
    """`columns` of a file source beside the file and block each row comes from."""
    return rows.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        *columns,
    )


def number_rows(placed: DataFrame) -> DataFrame:
    """Complete `SOURCE_ORDER`. The id must be taken before any shuffle. It grows within a
    block but not from file to file, so it comes last in the order."""
    return placed.withColumn("line_id", F.monotonically_increasing_id())


def not_blank(lines: DataFrame) -> DataFrame:
    return lines.filter(strip(F.col("value")) != "")


def _wrapped(value: Column) -> Column:
    """The line inside an object of its own, which parses only if the line is JSON throughout."""
    return F.concat(F.lit('{"r":['), value, F.lit('],"end":1}'))


def _only_record(schema: T.StructType, mode: str) -> tuple[Column, Column]:
    """(record, whether the line holds one object and nothing after it). Spark's parser by
    itself stops after the first object of a line and ignores the rest."""
    target = T.StructType([T.StructField("r", T.ArrayType(schema)), T.StructField("end", T.IntegerType())])
    parsed = F.from_json(_wrapped(F.col("value")), target, {"mode": mode})
    record = F.get(parsed["r"], F.lit(0))
    single = (F.size(parsed["r"]) == 1) & record.isNotNull() & (parsed["end"] == 1)
    return record, F.coalesce(single, F.lit(False))


def _strict(schema: T.StructType) -> Column:
    record, single = _only_record(schema, "FAILFAST")
    message = F.concat(F.lit("not one JSON object: "), F.substring("value", 1, 200))
    return F.when(single, record).otherwise(F.raise_error(message).cast(schema))


def parse_lines(
    lines: DataFrame, schema: T.StructType = PAGE, mode: str = "FAILFAST"
) -> DataFrame:
    """The fields of `schema` beside the source order. FAILFAST stops the job at the first
    line that is not one JSON object; PERMISSIVE puts such a line into the `_rejected` column."""
    if mode != "PERMISSIVE":
        return lines.select(*SOURCE_ORDER, _strict(schema).alias("r")).select(*SOURCE_ORDER, "r.*")
    target = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    options = {"mode": mode, "columnNameOfCorruptRecord": REJECTED}
    record = F.from_json(F.col("value"), target, options)
    _, single = _only_record(schema, mode)
    rows = lines.select(*SOURCE_ORDER, record.alias("r"), F.when(~single, F.col("value")).alias("_whole"))
    return rows.select(*SOURCE_ORDER, "r.*", "_whole").withColumn(
        REJECTED, F.coalesce(REJECTED, "_whole")
    ).drop("_whole")


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType = PAGE,
    mode: str = "FAILFAST",
    glob: str | None = "*.jsonl",
) -> DataFrame:
    """Records of one file, whatever its name, or of the files in a directory that match
    `glob`. A directory without such files gives no rows. Spark passes over names that begin
    with a dot or an underscore; such a file that matches is an error, not a silent gap."""
    reader = spark.read
    if glob and not is_file(spark, path):
        if hidden := hidden_files(spark, path, glob):
            raise ValueError(f"Spark does not read files named like {hidden[0]}; rename them")
        reader = reader.option("pathGlobFilter", glob)
    lines = number_rows(with_place(reader.text(path), "value"))
    return parse_lines(not_blank(lines), schema, mode)


def split_rejects(permissive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected lines with their place) of a PERMISSIVE read."""
    bad = F.col(REJECTED).isNotNull()
    good = permissive.filter(~bad).drop(REJECTED)
    return good, permissive.filter(bad).select(*SOURCE_ORDER, F.col(REJECTED).alias("line"))


def read_pairs(spark: SparkSession, path: str, optional: bool = False) -> DataFrame:
    """Training pairs. An optional path that does not exist gives an empty table."""
    if optional and not exists(spark, path):
        return spark.createDataFrame([], PAIR)
    return not_blank(spark.read.text(path)).select(_strict(PAIR).alias("pair")).select("pair.*")


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line, null fields kept, non-ASCII text unescaped."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_split(
    df: DataFrame, path: str, mode: str = "errorifexists", key: str | None = None, seed: int = SPLIT_SEED
) -> None:
    """Training and validation parts in one pass, as `split=train` and `split=val`.

    With `key` the lines of each part, read by file name, follow the seeded order. A part
    without rows is a folder without lines.
    """
    if key:
        df = df.withColumns({"_hash": order_hash(F.col(key), seed), "_key": key_text(F.col(key))})
        order = ["split", "_hash", "_key"]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    (
        df.select("split", *PAIR.names)
        .write.mode(mode)
        .option("ignoreNullFields", "false")
        .partitionBy("split")
        .json(path)
    )
    for part in ("train", "val"):
        make_folder(df.sparkSession, f"{path}/split={part}")


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """(split, source order, prompt, completion) of both parts that `write_split` wrote."""
    lines = spark.read.schema("value string, split string").text(path)
    placed = not_blank(number_rows(with_place(lines, "value", "split")))
    return placed.select("split", *SOURCE_ORDER, _strict(PAIR).alias("pair")).select("split", *SOURCE_ORDER, "pair.*")
