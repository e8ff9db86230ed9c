"""Pattern questions on the ledger; every threshold is an argument.

No question pairs the inputs of a transaction with its outputs: per-transaction
counts are made first and joined back to the rows, so the work stays linear even
if one transaction holds a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.times import utc_day
from tallyloom.operators.ledger import TX, is_input, is_output, outputs_of, totals_by_receiver


def most_active_addresses(vinout: DataFrame, k: int = 20) -> DataFrame:
    """Addresses with the most rows, and how they use them.

    The distinct count is planned in two shuffles, by (address, txid) first, so a
    hot address is spread before it is counted.
    """
    return (vinout.groupBy("address").agg(
        F.count("*").alias("row_count"),
        F.countDistinct("txid").alias("transactions"),
        F.count_if(is_input()).alias("inputs"),
        F.count_if(is_output()).alias("outputs"),
        F.sum(F.when(is_input(), F.col("value"))).alias("value_spent"),
        F.sum(F.when(is_output(), F.col("value"))).alias("value_received"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"))
        .orderBy(F.desc("row_count"), "address").limit(k))


def dust_spam(vinout: DataFrame, dust: float, min_outputs: int) -> DataFrame:
    """Spenders whose transactions pay at least `min_outputs` outputs of at most `dust`."""
    per_tx = vinout.where(is_output() & (F.col("value") <= dust)).groupBy(*TX).agg(
        F.count("*").alias("n"), F.sum("value").alias("v"))
    spenders = vinout.where(is_input()).select("address", *TX).distinct()
    return (spenders.join(per_tx, TX).groupBy("address")
            .agg(F.count("*").alias("dust_transactions"), F.sum("n").alias("dust_outputs"),
                 F.sum("v").alias("dust_value"))
            .where(F.col("dust_outputs") >= min_outputs))


def highest_value_transactions(transactions: DataFrame, k: int = 20) -> DataFrame:
    return transactions.orderBy(F.col("value").desc_nulls_last(), "txid").limit(k)


def consolidations(vinout: DataFrame, min_inputs: int, max_outputs: int, min_value: float) -> DataFrame:
    """Transactions merging many inputs into few outputs of a large total."""
    return (vinout.groupBy(*TX).agg(
        F.count_if(is_input()).alias("inputs"),
        F.count_if(is_output()).alias("outputs"),
        F.sum(F.when(is_input(), F.col("value"))).alias("value_in"),
        F.sum(F.when(is_output(), F.col("value"))).alias("value_out"))
        .where((F.col("inputs") >= min_inputs) & F.col("outputs").between(1, max_outputs)
               & (F.col("value_out") >= min_value)))


# Sketches with 2^12 registers; fixed value: their relative standard error, three times over.
SKETCH_LOG_REGISTERS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LOG_REGISTERS / 2)


def exchange_like(vinout: DataFrame, min_in: int, min_out: int) -> DataFrame:
    """Addresses that both receive from and pay out in many transactions.

    `in_degree` and `out_degree` count transactions; `sender_links` and `receiver_links` add up the distinct
    counterparties of each of them. `senders` and `receivers` are the distinct counterparties over all transactions, estimated
    within `SKETCH_ERROR`: every transaction gets a sketch of its senders and one of its receivers, and an address unites the
    sketches of its transactions, on the map side first. No input is paired with an output, and a sketch stays small while it
    holds few addresses.
    """
    # the same filter on both uses below, so that Spark runs this shuffle once
    known = vinout.where(F.col("txid").isNotNull() & F.col("timestamp").isNotNull())
    parties = known.select(*TX, "type", "address").distinct()
    per_tx = parties.groupBy(*TX).agg(
        F.count_if(is_input()).alias("senders"), F.count_if(is_output()).alias("receivers"),
        F.hll_sketch_agg(F.when(is_input(), F.col("address")), F.lit(SKETCH_LOG_REGISTERS)).alias("sender_sketch"),
        F.hll_sketch_agg(F.when(is_output(), F.col("address")), F.lit(SKETCH_LOG_REGISTERS)).alias("receiver_sketch"))
    received, spent = F.when(is_output(), F.col("senders")), F.when(is_input(), F.col("receivers"))

    def united(sketch: str, kind: Column) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.when(kind, F.col(sketch)))), F.lit(0)).cast("long")

    return (parties.join(per_tx, TX).groupBy("address")
            .agg(F.count_if(is_output()).alias("in_degree"), F.count_if(is_input()).alias("out_degree"),
                 F.coalesce(F.sum(received), F.lit(0)).alias("sender_links"),
                 F.coalesce(F.sum(spent), F.lit(0)).alias("receiver_links"),
                 united("sender_sketch", is_output()).alias("senders"), united("receiver_sketch", is_input()).alias("receivers"))
            .where((F.col("in_degree") >= min_in) & (F.col("out_degree") >= min_out)))


def counterparties(vinout: DataFrame, addresses: DataFrame) -> DataFrame:
    """(address, senders, receivers): the exact distinct counterparties of a few addresses.

    The transactions of the addresses are looked up first; what is written are pairs of one of the addresses and a
    counterparty, never of two other parties.
    """
    known = vinout.where(F.col("txid").isNotNull() & F.col("timestamp").isNotNull())
    parties = known.select(*TX, "type", "address").distinct()
    asked = parties.join(addresses.select("address").distinct(), "address", "left_semi")
    others = parties.select(*TX, F.col("type").alias("side"), F.col("address").alias("party"))
    pairs = asked.join(others.where("party is not null"), TX).where(F.col("type") != F.col("side")).groupBy("address", "side", "party").agg(F.count("*").alias("n"))
    return pairs.groupBy("address").agg(F.count_if(F.col("side") == "vin").alias("senders"), F.count_if(F.col("side") == "vout").alias("receivers"))


def miner_spending(vinout: DataFrame) -> DataFrame:
    """Receivers of what the rewarded addresses spend, for all of them at once."""
    miners = vinout.where(F.col("coinbase")).select("address").distinct()
    spends = vinout.where(is_input()).join(miners, "address", "left_semi").select(*TX).distinct()
    return totals_by_receiver(outputs_of(vinout, spends))


def anomalous_transactions(transactions: DataFrame, z: float = 3.0) -> DataFrame:
    """Transactions whose log value lies at least `z` deviations from their day's mean.

    The daily statistics have one row per calendar day (UTC); adaptive execution sees
    that they are small and keeps a busy day where it is.
    """
    scored = transactions.where(F.col("value") > 0).withColumn("day", utc_day(F.col("timestamp"), transactions.schema["timestamp"].dataType))
    scored = scored.withColumn("log_value", F.ln(F.col("value").cast("double")))
    stats = scored.groupBy("day").agg(F.avg("log_value").alias("mean"), F.stddev("log_value").alias("spread"))
    score = F.round(F.try_divide(F.col("log_value") - F.col("mean"), F.col("spread")), 6)
    return (scored.join(stats, "day").withColumn("z_score", score)
            .where(F.abs("z_score") >= z).select("txid", "timestamp", "value", "z_score"))
