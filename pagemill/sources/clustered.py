"""Tables stored by the hash of a key, so that rows are looked up without reading the whole."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.session import materialize
from pagemill.sources.paths import exists, read_text, remove, replace_text
from pagemill.sources.seen import matched

BUCKET_ROWS = 1 << 10
MOST_BUCKETS = 1 << 14


class Clustered:
    """A table at `path` whose rows lie in folders by the hash of `key`. A lookup reads the folders that its
    keys hash to and no others, at most one folder a key."""

    def __init__(self, spark: SparkSession, path: str, key: str = "url") -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self._read: tuple[str | None, DataFrame] | None = None

    def _about(self) -> str:
        return f"{self.path}/_about.json"

    def is_stored(self) -> bool:
        """Whether the table is there as a whole; a store that died half-way is not."""
        return exists(self.spark, self._about())

    def store(self, rows: DataFrame) -> Clustered:
        """Write the table, in place of one that is there. Large buckets are split over tasks and
        files, small ones share them."""
        buckets = min(max(rows.count() // BUCKET_ROWS, 1), MOST_BUCKETS)
        remove(self.spark, self._about())
        placed = rows.withColumn("_bucket", self._bucket(F.col(self.key), buckets))
        if buckets > 1:
            placed = placed.hint("rebalance", "_bucket")
        placed.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/rows")
        replace_text(self.spark, self._about(), json.dumps({"buckets": buckets, "schema": rows.schema.jsonValue(), "id": uuid.uuid4().hex}))
        return self

    @staticmethod
    def _bucket(key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def _state(self) -> tuple[int, T.StructType, str | None]:
        about = json.loads(read_text(self.spark, self._about()))
        return about["buckets"], T.StructType.fromJson(about["schema"]), about.get("id")

    def _rows(self, schema: T.StructType, stored: str | None) -> DataFrame:
        """The whole table. Its folders are listed by one task each, so they are listed once for what was stored, not
        for every lookup."""
        if self._read is None or stored is None or self._read[0] != stored:
            schema = T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])
            self._read = stored, self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        return self._read[1]

    def near(self, keys: DataFrame, column: str) -> DataFrame:
        """All rows of the folders that hold the keys in a column of the stored table `keys`."""
        buckets, schema, stored = self._state()
        rows = self._rows(schema, stored)
        if buckets == 1:
            return rows.select(*schema.names)
        # At most one row a folder.
        wanted = keys.select(self._bucket(F.col(column), buckets).alias("b")).distinct().collect()
        return rows.filter(F.col("_bucket").isin([row["b"] for row in wanted])).select(*schema.names)

    def beside(self, keys: DataFrame, n: int) -> DataFrame:
        """The rows joined with a stored table of `n` rows, unique on the key. A row is shuffled only if it is
        asked for, and not at all for few."""
        return matched(self.near(keys, self.key), keys, self.key, n)

    def lookup(self, keys: DataFrame, column: str | None = None) -> DataFrame:
        """The rows with one of the keys in a column of `keys`."""
        keys = materialize(keys.select(F.col(column or self.key).alias(self.key)), "looked-up")
        return self.near(keys, self.key).join(keys, self.key, "left_semi")
