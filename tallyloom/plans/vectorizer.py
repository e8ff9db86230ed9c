"""Keeping chunk embeddings in step with a source table.

One stored table, a partition per hash bucket of the id::

    <path>/store-<buckets>/bucket=B/   id, content_hash, chunk_seq, chunk, embedding, run

An item without chunks (an empty text) has one row without a chunk. A run rewrites the buckets that hold a changed item, and
only those, with Spark's dynamic partition overwrite: chunks of changed and vanished items are gone at once, and whatever is
stored is live. New files are put in place after all tasks have ended, so a run that stops before that leaves the table as it
was. The stored hashes are the only record of what is embedded: a bucket lost while files are put in place is simply pending
again. Runs on one table must not overlap each other or a read.

Rows without an id are not embedded. `buckets` should keep a bucket within a few task inputs; another number starts a new store.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.chunks import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS, split_column
from tallyloom.functions.embeddings import Provider, embed_column, hashing_provider
from tallyloom.sources.files import Folder


@dataclass(frozen=True)
class Vectorizer:
    """Definition: source columns, chunking, embedding provider, and the store's path."""

    path: str
    id_col: str
    text_col: str
    chunk_size: int = CHUNK_SIZE
    chunk_overlap: int = CHUNK_OVERLAP
    separators: tuple[str, ...] = SEPARATORS
    provider: Provider = field(default_factory=hashing_provider)
    buckets: int = 64

    @property
    def store(self) -> str:
        return f"{self.path}/store-{self.buckets}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def stored(self, spark: SparkSession, id_type: T.DataType) -> DataFrame:
        """All stored rows: id, content_hash, chunk_seq, chunk, embedding, run, bucket.

        A row without an id marks the last run that wrote the bucket, also one that has emptied it.
        """
        schema = T.StructType([
            T.StructField("id", id_type), T.StructField("content_hash", T.StringType()), T.StructField("chunk_seq", T.IntegerType()),
            T.StructField("chunk", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("run", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        if not Folder(spark, self.store).exists():
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.store)

    def _items(self, source: DataFrame) -> DataFrame:
        """(id, content_hash) of what is stored; the first chunk, or the row without one, stands for the item."""
        first = self.stored(source.sparkSession, self._id_type(source)).where("id IS NOT NULL AND (chunk_seq IS NULL OR chunk_seq = 0)")
        # texts of rows that share an id each have a first chunk
        return first.groupBy("id").agg(F.max("content_hash").alias("content_hash"))

    def _keyed(self, source: DataFrame) -> DataFrame:
        """One hash per id; rows that share an id are one item with all their texts."""
        text = F.sha2(F.coalesce(self.text_col, F.lit("")), 256)
        folded = (source.where(F.col(self.id_col).isNotNull()).groupBy(F.col(self.id_col).alias("id"))
                  .agg(F.array_join(F.sort_array(F.collect_set(text)), "").alias("t")))
        return folded.select("id", F.when(F.length("t") > 64, F.sha2("t", 256)).otherwise(F.col("t")).alias("content_hash"))

    def _id_type(self, source: DataFrame) -> T.DataType:
        return source.schema[self.id_col].dataType

    def pending(self, source: DataFrame) -> DataFrame:
        """Ids whose text is new or changed."""
        return self._keyed(source).join(self._items(source), ["id", "content_hash"], "left_anti")

    def status(self, source: DataFrame) -> DataFrame:
        """One row: stored items and items still to embed."""
        return self._items(source).agg(F.count("*").alias("stored_items")).select(
            "stored_items", self.pending(source).agg(F.count("*")).scalar().alias("pending_items"))

    def run(self, source: DataFrame) -> int:
        """Embed what is new or changed, drop what left the source. Returns the run's number, 0 if idle."""
        spark, id_type = source.sparkSession, self._id_type(source)
        number = (self.stored(spark, id_type).agg(F.max("run").alias("n")).first()["n"] or 0) + 1
        new, old = self._keyed(source), self._items(source).withColumnRenamed("content_hash", "stored_hash")
        changed = new.join(old, "id", "full").where(~F.col("content_hash").eqNullSafe(F.col("stored_hash")))
        # written once, so that the source is hashed once and all steps see the same ids; no hash: the item is gone
        listed = f"{self.path}/pending"
        changed.select("id", "content_hash", self._bucket()).write.mode("overwrite").parquet(listed)
        entries = spark.read.parquet(listed)
        touched = [r["bucket"] for r in entries.select("bucket").distinct().collect()]  # at most `buckets`
        if not touched:
            Folder(spark, listed).delete()
            return 0
        live = entries.where("content_hash IS NOT NULL").select("id", "content_hash")
        texts = source.select(F.col(self.id_col).alias("id"), F.col(self.text_col).alias("text")).join(live, "id")
        chunks = embed_column(split_column(texts, "text", self.chunk_size, self.chunk_overlap, self.separators), "chunk", "embedding", self.provider)
        blank = live.join(texts.where("text <> ''").select("id"), "id", "left_anti")
        columns = ["id", "content_hash", "chunk_seq", "chunk", "embedding", "run", "bucket"]
        fresh = chunks.unionByName(blank, allowMissingColumns=True).select(
            "id", "content_hash", "chunk_seq", "chunk", F.col("embedding").cast("array<float>").alias("embedding"),
            F.lit(number).alias("run"), self._bucket())
        same = self.stored(spark, id_type).where(F.col("bucket").isin(touched) & F.col("id").isNotNull()).join(entries.select("id"), "id", "left_anti")
        marks = spark.range(len(touched)).select(F.get(F.array(*map(F.lit, touched)), F.col("id").cast("int")).cast("int").alias("bucket"))
        marks = marks.select(F.lit(None).cast(id_type).alias("id"), F.lit(number).alias("run"), "bucket")
        rows = same.select(*columns).unionByName(fresh).unionByName(marks, allowMissingColumns=True)
        (rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(self.store))
        Folder(spark, listed).delete()
        return number

    def view(self, source: DataFrame) -> DataFrame:
        """The source's rows with `chunk_seq`, `chunk` and `embedding`, one row per chunk."""
        live = self.stored(source.sparkSession, self._id_type(source)).where("chunk_seq IS NOT NULL")
        return source.join(live.select(F.col("id").alias(self.id_col), "chunk_seq", "chunk", "embedding"), self.id_col)
