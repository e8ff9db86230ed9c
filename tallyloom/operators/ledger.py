"""Ledger rows: look-ups, balances and tracing coins through transactions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import cut_lineage

TX = ["txid", "timestamp"]


def is_input() -> Column:
    return F.col("type") == "vin"


def is_output() -> Column:
    return F.col("type") == "vout"


def transactions_in_block(transactions: DataFrame, height: int) -> DataFrame:
    return transactions.where(F.col("block_height") == height)


def transaction(transactions: DataFrame, txid: str) -> DataFrame:
    return transactions.where(F.col("txid") == txid)


def inputs_and_outputs(vinout: DataFrame, txid: str) -> DataFrame:
    return vinout.where(F.col("txid") == txid).select("type", "address", "value")


def address_balance(vinout: DataFrame, address: str, signed: bool = False) -> DataFrame:
    """Sum and number of the address's rows.

    Values are added as stored, whatever their direction; `signed` subtracts the
    inputs. `transaction_count` counts rows.
    """
    value = F.when(is_input(), -F.col("value")).otherwise(F.col("value")) if signed else F.col("value")
    return vinout.where(F.col("address") == address).agg(
        F.sum(value).alias("total_value"), F.count("*").alias("transaction_count"))


def recent_for_address(vinout: DataFrame, address: str, k: int = 10, tie_break: list[str] | None = None) -> DataFrame:
    order = [F.col("timestamp").desc_nulls_first(), *(tie_break or ["txid", "type", "n"])]
    return vinout.where(F.col("address") == address).orderBy(*order).limit(k)


def spends_of(vinout: DataFrame, address: str) -> DataFrame:
    """Transactions in which the address was an input."""
    return vinout.where((F.col("address") == address) & is_input()).select(*TX).distinct()


def outputs_of(vinout: DataFrame, spends: DataFrame) -> DataFrame:
    """Outputs of the given transactions.

    A semi join on (txid, timestamp): one output per row however often a
    transaction is listed; Spark can split a hot transaction on the output side.
    """
    return vinout.where(is_output()).join(spends, TX, "left_semi")


def flow_trace(vinout: DataFrame, address: str) -> DataFrame:
    return outputs_of(vinout, spends_of(vinout, address)).select("address", "timestamp", "value")


def totals_by_receiver(outputs: DataFrame) -> DataFrame:
    return outputs.groupBy("address").agg(
        F.count("*").alias("transaction_count"), F.sum("value").alias("total_value"))


def flow_trace_by_address(vinout: DataFrame, address: str) -> DataFrame:
    return (totals_by_receiver(outputs_of(vinout, spends_of(vinout, address)))
            .orderBy(F.col("total_value").desc_nulls_first(), "address"))


def miner_of_block(vinout: DataFrame, blocks: DataFrame, height: int) -> DataFrame:
    """Coinbase rows of a block, at the block's own time.

    An unknown block gives no rows; a height with several times is an error.
    """
    block_time = blocks.where(F.col("height") == height).select("timestamp").scalar()
    return vinout.where((F.col("block_height") == height) & (F.col("timestamp") == block_time)
                        & F.col("coinbase")).select("address", "value")


def miner_earnings(vinout: DataFrame, address: str) -> DataFrame:
    return vinout.where((F.col("address") == address) & F.col("coinbase")).agg(
        F.sum("value").alias("total_earnings"), F.count("*").alias("coinbase_transactions"))


def flow_trace_hops(vinout: DataFrame, address: str, hops: int = 3) -> DataFrame:
    """Follow coins from an address through up to `hops` transactions.

    The rows carry no link from an input to the output it spends, so one hop means:
    an address received coins, and spent in a transaction at that time or later.
    An address is followed from the hop that first reaches it, and again whenever a
    later hop reaches it at an earlier time. Returns one row per reached address: hop, outputs
    and total_value of the hop that first reached it, and first_time, the earliest time of any hop.

    Every hop is a join on the address and a semi join on the transaction; its
    per-address result is checkpointed, so the plan does not grow with the hops.
    """
    inputs = vinout.where(is_input()).select("address", *TX)

    def paid(spends: DataFrame) -> DataFrame:
        return outputs_of(vinout, spends.select(*TX).distinct()).withColumn("parts", F.lit(1))

    def spent(frontier: DataFrame) -> DataFrame:
        return inputs.join(frontier.select("address", "first_time"), "address").where(F.col("timestamp") >= F.col("first_time"))

    return follow(inputs.where(F.col("address") == address), paid, spent, address, hops)


def follow(spends: DataFrame, paid: Callable[[DataFrame], DataFrame], spent: Callable[[DataFrame], DataFrame],
           address: str, hops: int) -> DataFrame:
    """The rounds of `flow_trace_hops`: `paid` gives the outputs of transactions, `spent` the transactions in which
    addresses (address, first_time, parts) were inputs from that time on."""
    found = None
    for hop in range(1, hops + 1):
        reached = (paid(spends).where(F.col("address") != address)
                   .groupBy("address")
                   .agg(F.min("timestamp").alias("time"), F.count("*").alias("n"), F.sum("value").alias("total"), F.max("parts").alias("into"))
                   .withColumn("at", F.lit(hop)))
        if found is None:
            found = reached.select(F.col("at").alias("hop"), "address", F.col("time").alias("first_time"), F.col("n").alias("outputs"),
                                   F.col("total").alias("total_value"), F.col("into").alias("parts"), F.lit(True).alias("moved"))
        else:
            first = F.coalesce("hop", "at")
            found = found.drop("moved").join(reached, "address", "full").select(
                first.alias("hop"), "address", F.least("first_time", "time").alias("first_time"),
                F.coalesce("outputs", "n").alias("outputs"), F.coalesce("total_value", "total").alias("total_value"),
                F.coalesce("parts", "into").alias("parts"),
                (F.col("first_time").isNull() | F.coalesce(F.col("time") < F.col("first_time"), F.lit(False))).alias("moved"))
        found = cut_lineage(found)
        frontier = found.where("moved")
        if hop == hops or frontier.isEmpty():
            break
        spends = spent(frontier)
    return found.drop("moved", "parts")
