"""A stored ledger for questions that follow coins over several transactions.

Two bucketed tables::

    <name>_inputs    bucketed and sorted by (address, part): address, txid, timestamp, one row each
    <name>_outputs   bucketed and sorted by (txid, timestamp, part)

A step from addresses to the transactions they spend in, and one from transactions to their outputs, then shuffles the few
addresses or transactions asked for, never the ledger. An address or transaction with more than `part_rows` rows is spread over
several parts, so that no bucket holds a hot one whole; every row carries the number of parts of what it leads to (`tx_parts`,
`address_parts`), so a step needs no look-up.

Rows without txid or timestamp are in no transaction and are left out. Inputs without an address are left out, outputs without
one stay.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.operators.ledger import TX, follow, is_input, is_output, totals_by_receiver
from tallyloom.session import cut_lineage, shared_root
from tallyloom.sources.files import Folder

PART_ROWS = 1_000_000
KEY_HASHES = 1 << 18


def _spread(group: DataFrame, parts: str) -> DataFrame:
    """One row per part of each row's group."""
    return group.withColumn("part", F.explode(F.sequence(F.lit(0), F.col(parts) - 1))).drop(parts)


def _crowded(table: DataFrame, key: list[str], parts: str, part_rows: int) -> DataFrame:
    """Keys with more than `part_rows` rows, and their number of parts.

    Rows are first counted by a hash of the key, in few sums for each task: a crowded key is in a crowded hash, and only
    the rows of those are counted by key.
    """
    table = table.select(*key, F.pmod(F.xxhash64(*key), F.lit(KEY_HASHES)).cast("int").alias("hashed"))
    hashes = cut_lineage(table.groupBy("hashed").agg(F.count("*").alias("n")).where(F.col("n") > part_rows).select("hashed"))
    if hashes.isEmpty():
        return table.limit(0).select(*key, F.lit(1).alias(parts))
    counted = table.join(F.broadcast(hashes), "hashed", "left_semi").groupBy(*key).agg(F.ceil(F.count("*") / part_rows).cast("int").alias(parts))
    return cut_lineage(counted.where(F.col(parts) > 1))


@dataclass(frozen=True)
class LedgerStore:
    """The two tables under `path`; `name` is their prefix in the session's catalog."""

    spark: SparkSession
    path: str
    name: str

    @property
    def inputs(self) -> DataFrame:
        return self.spark.table(f"{self.name}_inputs")

    @property
    def outputs(self) -> DataFrame:
        return self.spark.table(f"{self.name}_outputs")

    @classmethod
    def build(cls, vinout: DataFrame, path: str | None = None, name: str | None = None,
              buckets: int | None = None, part_rows: int = PART_ROWS) -> "LedgerStore":
        """Write both tables; the source is read once. `buckets` defaults to the shuffle partitions."""
        spark = vinout.sparkSession
        name = name or f"ledger_{uuid.uuid4().hex}"
        path = path or f"{shared_root(spark).rstrip('/')}/{name}"
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        known = vinout.where(F.col("txid").isNotNull() & F.col("timestamp").isNotNull())
        known.select(*TX, "type", "address", "value", "coinbase", F.xxhash64(*vinout.columns).alias("row")).write.mode("overwrite").parquet(f"{path}/rows")
        rows = spark.read.parquet(f"{path}/rows")
        (rows.where(is_input() & F.col("address").isNotNull()).groupBy("address", *TX)
         .agg(F.coalesce(F.max("coinbase"), F.lit(False)).alias("coinbase")).write.mode("overwrite").parquet(f"{path}/spends"))
        spends = spark.read.parquet(f"{path}/spends")
        receipts = rows.where(is_output()).drop("type")
        # only what is spread is listed: at most one row in `part_rows`, so both lists are broadcast and the tables stay where they are
        addresses, transactions = (_crowded(table, key, parts, part_rows) for table, key, parts in (
            (spends, ["address"], "address_parts"), (receipts, TX, "tx_parts")))

        def with_parts(table: DataFrame) -> DataFrame:
            return (table.join(F.broadcast(addresses), "address", "left").join(F.broadcast(transactions), TX, "left")
                    .na.fill(1, ["address_parts", "tx_parts"]))

        def part(of: Column, parts: str) -> Column:
            return F.pmod(of, F.col(parts)).cast("int").alias("part")

        store = cls(spark, path, name)
        store._write(with_parts(spends).select("address", part(F.xxhash64(*TX), "address_parts"), *TX, "coinbase", "address_parts", "tx_parts"),
                     "inputs", ["address", "part"], buckets)
        store._write(with_parts(receipts).select(*TX, part(F.col("row"), "tx_parts"), "address", "value", "coinbase", "address_parts"),
                     "outputs", [*TX, "part"], buckets)
        for read in ("rows", "spends"):
            Folder(spark, f"{path}/{read}").delete()
        return store

    def _write(self, table: DataFrame, kind: str, keys: list[str], buckets: int) -> None:
        """One file per bucket, as each task writes one."""
        (table.repartition(buckets, *keys).write.mode("overwrite").option("path", f"{self.path}/{kind}")
         .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"{self.name}_{kind}"))

    def drop(self) -> None:
        for kind in ("inputs", "outputs"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{kind}")
        Folder(self.spark, self.path).delete()

    def paid(self, spends: DataFrame) -> DataFrame:
        """The outputs of transactions (txid, timestamp, tx_parts)."""
        # distinct by the columns of the join, which then needs no shuffle of its own
        asked = _spread(spends.select(*TX, "tx_parts"), "tx_parts").distinct()
        return self.outputs.join(asked, [*TX, "part"], "left_semi").withColumnRenamed("address_parts", "parts")

    def spent(self, addresses: DataFrame) -> DataFrame:
        """The transactions in which addresses (address, first_time, parts) were inputs, at first_time or later if it is not null."""
        asked = _spread(addresses.select("address", "first_time", "parts"), "parts")
        return self.inputs.join(asked, ["address", "part"]).where(
            F.col("first_time").isNull() | (F.col("timestamp") >= F.col("first_time"))).select(*TX, "tx_parts")

    def flow_trace_hops(self, address: str, hops: int = 3) -> DataFrame:
        """As `operators.ledger.flow_trace_hops`."""
        return follow(self.inputs.where(F.col("address") == address).select(*TX, "tx_parts"), self.paid, self.spent, address, hops)

    def miner_spending(self) -> DataFrame:
        """As `operators.patterns.miner_spending`."""
        rewarded = [table.where("coinbase AND address IS NOT NULL").select("address", "address_parts") for table in (self.inputs, self.outputs)]
        miners = rewarded[0].union(rewarded[1]).groupBy("address").agg(F.max("address_parts").alias("parts"))
        return totals_by_receiver(self.paid(self.spent(miners.withColumn("first_time", F.lit(None).cast(self.inputs.schema["timestamp"].dataType)))))
