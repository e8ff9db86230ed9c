"""Queries over ledger rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.catalog.registry import ADDRESS, BLOCK, TXID, query
from tallyloom.functions.scalars import segment_key
from tallyloom.operators import checks, ledger, patterns
from tallyloom.plans.ledger_store import LedgerStore
from tallyloom.session import cut_lineage, scratch_path
from tallyloom.sources import views

ROWS = ("tx_vinout",)
SPENDS = f"SELECT DISTINCT txid, timestamp FROM tx_vinout WHERE address = '{ADDRESS}' AND type = 'vin'"


@query("tx_in_block", f"SELECT * FROM transactions WHERE block_height = {BLOCK}", ("transactions",))
def tx_in_block(spark: SparkSession, root: str) -> DataFrame:
    return ledger.transactions_in_block(views.transactions(spark, root), BLOCK)


@query("tx_by_id", f"SELECT * FROM transactions WHERE txid = '{TXID}'", ("transactions",))
def tx_by_id(spark: SparkSession, root: str) -> DataFrame:
    return ledger.transaction(views.transactions(spark, root), TXID)


@query("tx_inouts", f"SELECT type, address, value FROM tx_vinout WHERE txid = '{TXID}'", ROWS)
def tx_inouts(spark: SparkSession, root: str) -> DataFrame:
    return ledger.inputs_and_outputs(views.tx_vinout(spark, root), TXID)


@query("address_balance", f"""SELECT SUM(value) AS total_value, COUNT(*) AS transaction_count
FROM tx_vinout WHERE address = '{ADDRESS}'""", ROWS)
def address_balance(spark: SparkSession, root: str) -> DataFrame:
    return ledger.address_balance(views.tx_vinout(spark, root), ADDRESS)


@query("address_balance_signed", f"""SELECT SUM(CASE WHEN type = 'vin' THEN -value ELSE value END) AS total_value,
    COUNT(*) AS transaction_count FROM tx_vinout WHERE address = '{ADDRESS}'""", ROWS)
def address_balance_signed(spark: SparkSession, root: str) -> DataFrame:
    return ledger.address_balance(views.tx_vinout(spark, root), ADDRESS, signed=True)


@query("recent_for_address", f"""SELECT * FROM tx_vinout WHERE address = '{ADDRESS}'
ORDER BY timestamp DESC, txid, type, n, l_partkey, value LIMIT 10""", ROWS)
def recent_for_address(spark: SparkSession, root: str) -> DataFrame:
    return ledger.recent_for_address(views.tx_vinout(spark, root), ADDRESS,
                                     tie_break=["txid", "type", "n", "l_partkey", "value"])


@query("distinct_spends", "SELECT DISTINCT txid, timestamp FROM tx_vinout WHERE type = 'vin'", ROWS)
def distinct_spends(spark: SparkSession, root: str) -> DataFrame:
    return views.tx_vinout(spark, root).where(ledger.is_input()).select(*ledger.TX).distinct()


@query("flow_trace", f"""SELECT address, timestamp, value FROM tx_vinout
WHERE (txid, timestamp) IN ({SPENDS}) AND type = 'vout'""", ROWS)
def flow_trace(spark: SparkSession, root: str) -> DataFrame:
    return ledger.flow_trace(views.tx_vinout(spark, root), ADDRESS)


@query("miner_of_block", f"""SELECT address, value FROM tx_vinout WHERE block_height = {BLOCK}
AND timestamp = (SELECT timestamp FROM blocks WHERE height = {BLOCK}) AND coinbase""", ("tx_vinout", "blocks"))
def miner_of_block(spark: SparkSession, root: str) -> DataFrame:
    return ledger.miner_of_block(views.tx_vinout(spark, root), views.blocks(spark, root), BLOCK)


@query("miner_earnings", f"""SELECT SUM(value) AS total_earnings, COUNT(*) AS coinbase_transactions
FROM tx_vinout WHERE address = '{ADDRESS}' AND coinbase""", ROWS)
def miner_earnings(spark: SparkSession, root: str) -> DataFrame:
    return ledger.miner_earnings(views.tx_vinout(spark, root), ADDRESS)


@query("flow_trace_by_address", f"""SELECT address, COUNT(*) AS transaction_count, SUM(value) AS total_value
FROM tx_vinout WHERE (txid, timestamp) IN ({SPENDS}) AND type = 'vout' GROUP BY address""", ROWS)
def flow_trace_by_address(spark: SparkSession, root: str) -> DataFrame:
    return ledger.flow_trace_by_address(views.tx_vinout(spark, root), ADDRESS)


@query("most_active_addresses", """SELECT address, COUNT(*) AS row_count, COUNT(DISTINCT txid) AS transactions,
    COUNT(*) FILTER (type = 'vin') AS inputs, COUNT(*) FILTER (type = 'vout') AS outputs,
    SUM(value) FILTER (type = 'vin') AS value_spent, SUM(value) FILTER (type = 'vout') AS value_received,
    MIN(timestamp) AS first_time, MAX(timestamp) AS last_time
FROM tx_vinout GROUP BY address ORDER BY row_count DESC, address LIMIT 20""", ROWS)
def most_active_addresses(spark: SparkSession, root: str) -> DataFrame:
    return patterns.most_active_addresses(views.tx_vinout(spark, root))


@query("dust_spam", """WITH small AS (SELECT txid, timestamp, COUNT(*) AS n, SUM(value) AS v FROM tx_vinout
    WHERE type = 'vout' AND value <= 5000 GROUP BY 1, 2),
spenders AS (SELECT DISTINCT address, txid, timestamp FROM tx_vinout WHERE type = 'vin')
SELECT address, COUNT(*) AS dust_transactions, CAST(SUM(n) AS BIGINT) AS dust_outputs, SUM(v) AS dust_value
FROM spenders JOIN small USING (txid, timestamp) GROUP BY address HAVING SUM(n) >= 10""", ROWS)
def dust_spam(spark: SparkSession, root: str) -> DataFrame:
    return patterns.dust_spam(views.tx_vinout(spark, root), 5000, 10)


@query("highest_value_tx", "SELECT * FROM transactions ORDER BY value DESC, txid LIMIT 20", ("transactions",))
def highest_value_tx(spark: SparkSession, root: str) -> DataFrame:
    return patterns.highest_value_transactions(views.transactions(spark, root))


@query("consolidations", """SELECT txid, timestamp, COUNT(*) FILTER (type = 'vin') AS inputs,
    COUNT(*) FILTER (type = 'vout') AS outputs, SUM(value) FILTER (type = 'vin') AS value_in,
    SUM(value) FILTER (type = 'vout') AS value_out
FROM tx_vinout GROUP BY txid, timestamp HAVING COUNT(*) FILTER (type = 'vin') >= 2
    AND COUNT(*) FILTER (type = 'vout') BETWEEN 1 AND 2 AND SUM(value) FILTER (type = 'vout') >= 50000""", ROWS)
def consolidations(spark: SparkSession, root: str) -> DataFrame:
    return patterns.consolidations(views.tx_vinout(spark, root), 2, 2, 50000)


@query("exchange_like", """WITH parties AS (SELECT DISTINCT txid, timestamp, type, address FROM tx_vinout),
per_tx AS (SELECT txid, timestamp, COUNT(*) FILTER (type = 'vin') AS senders,
    COUNT(*) FILTER (type = 'vout') AS receivers FROM parties GROUP BY 1, 2)
SELECT address, COUNT(*) FILTER (type = 'vout') AS in_degree, COUNT(*) FILTER (type = 'vin') AS out_degree,
    CAST(COALESCE(SUM(senders) FILTER (type = 'vout'), 0) AS BIGINT) AS sender_links,
    CAST(COALESCE(SUM(receivers) FILTER (type = 'vin'), 0) AS BIGINT) AS receiver_links
FROM parties JOIN per_tx USING (txid, timestamp) GROUP BY address
HAVING COUNT(*) FILTER (type = 'vout') >= 100 AND COUNT(*) FILTER (type = 'vin') >= 100""", ROWS)
def exchange_like(spark: SparkSession, root: str) -> DataFrame:
    return patterns.exchange_like(views.tx_vinout(spark, root), 100, 100).drop("senders", "receivers")


# the degrees count all addresses here, so that every scale has rows
@query("exchange_counterparties", """WITH parties AS (SELECT DISTINCT txid, timestamp, type, address FROM tx_vinout),
degree AS (SELECT address FROM parties GROUP BY address
    HAVING COUNT(*) FILTER (type = 'vout') >= 1 AND COUNT(*) FILTER (type = 'vin') >= 1),
found AS (SELECT p.address, o.type AS side, COUNT(DISTINCT o.address) AS n FROM parties p JOIN parties o USING (txid, timestamp)
    WHERE p.type <> o.type GROUP BY 1, 2)
SELECT address, COALESCE(MAX(n) FILTER (side = 'vin'), 0) AS senders, COALESCE(MAX(n) FILTER (side = 'vout'), 0) AS receivers,
    true AS senders_close, true AS receivers_close FROM degree LEFT JOIN found USING (address) GROUP BY address""", ROWS)
def exchange_counterparties(spark: SparkSession, root: str) -> DataFrame:
    """Distinct senders and receivers, and whether the sketches of `exchange_like` are within their error of them."""
    # both are read several times: the rows are joined once, and the sketches made once
    path = scratch_path(spark, "parties")
    views.tx_vinout(spark, root).select("txid", "timestamp", "type", "address").write.parquet(path)
    rows = spark.read.parquet(path)
    like = cut_lineage(patterns.exchange_like(rows, 1, 1).select("address", F.col("senders").alias("s"), F.col("receivers").alias("r")))
    exact = like.join(patterns.counterparties(rows, like), "address", "left").na.fill(0, ["senders", "receivers"])

    def close(estimate: str, count: str) -> Column:
        return F.abs(F.col(estimate) - F.col(count)) <= F.greatest(F.lit(1.0), patterns.SKETCH_ERROR * F.col(count))

    return exact.select("address", "senders", "receivers", close("s", "senders").alias("senders_close"), close("r", "receivers").alias("receivers_close"))


@query("miner_spending", """WITH spends AS (SELECT DISTINCT txid, timestamp FROM tx_vinout WHERE type = 'vin'
    AND address IN (SELECT address FROM tx_vinout WHERE coinbase))
SELECT address, COUNT(*) AS transaction_count, SUM(value) AS total_value FROM tx_vinout
WHERE (txid, timestamp) IN (SELECT txid, timestamp FROM spends) AND type = 'vout' GROUP BY address""", ROWS)
def miner_spending(spark: SparkSession, root: str) -> DataFrame:
    return LedgerStore.build(views.tx_vinout(spark, root)).miner_spending()


@query("anomalous_tx", """WITH scored AS (SELECT *, ln(CAST(value AS DOUBLE)) AS lv FROM transactions WHERE value > 0),
stats AS (SELECT CAST(timestamp AS DATE) AS day, AVG(lv) AS m, STDDEV(lv) AS s FROM scored GROUP BY 1)
SELECT txid, timestamp, value, ROUND((lv - m) / s, 6) AS z_score
FROM scored JOIN stats ON CAST(timestamp AS DATE) = day WHERE s > 0 AND ABS(ROUND((lv - m) / s, 6)) >= 2""",
       ("transactions",))
def anomalous_tx(spark: SparkSession, root: str) -> DataFrame:
    return patterns.anomalous_transactions(views.transactions(spark, root), 2.0)


def _hops_sql(hops: int) -> str:
    """Earliest arrival at every address after at most so many hops, each level computed from all of the level before."""
    parts = [f"level0 AS (SELECT '{ADDRESS}' AS address, TIMESTAMP '0001-01-01' AS reached)"]
    for hop in range(1, hops + 1):
        parts.append(f"""paid{hop} AS (SELECT o.address, o.timestamp, o.value FROM tx_vinout o SEMI JOIN (
            SELECT i.txid, i.timestamp FROM tx_vinout i JOIN level{hop - 1} ON i.address = level{hop - 1}.address
            AND i.timestamp >= reached WHERE i.type = 'vin') s ON o.txid = s.txid AND o.timestamp = s.timestamp
            WHERE o.type = 'vout' AND o.address <> '{ADDRESS}')""")
        parts.append(f"""level{hop} AS (SELECT address, MIN(reached) AS reached FROM (SELECT * FROM level{hop - 1}
            UNION ALL SELECT address, timestamp FROM paid{hop}) GROUP BY address)""")
    firsts = " UNION ALL ".join(f"""SELECT {hop} AS hop, address, COUNT(*) AS outputs, SUM(value) AS total_value FROM paid{hop}
        WHERE address NOT IN (SELECT address FROM level{hop - 1}) GROUP BY address""" for hop in range(1, hops + 1))
    return f"""WITH {", ".join(parts)} SELECT hop, address, reached AS first_time, outputs, total_value
    FROM ({firsts}) JOIN level{hops} USING (address)"""


@query("flow_trace_hops", _hops_sql(3), ROWS)
def flow_trace_hops(spark: SparkSession, root: str) -> DataFrame:
    return LedgerStore.build(views.tx_vinout(spark, root)).flow_trace_hops(ADDRESS, 3)


@query("segment_keys", """SELECT right(txid, 2) AS txid_2, right(txid, 3) AS txid_3, COUNT(*) AS row_count
FROM tx_vinout GROUP BY 1, 2""", ROWS)
def segment_keys(spark: SparkSession, root: str) -> DataFrame:
    return (views.tx_vinout(spark, root)
            .groupBy(segment_key(F.col("txid"), 2).alias("txid_2"), segment_key(F.col("txid"), 3).alias("txid_3"))
            .agg(F.count("*").alias("row_count")))


@query("duplicate_keys", """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def duplicate_keys(spark: SparkSession, root: str) -> DataFrame:
    return checks.duplicate_keys(views.table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])
