"""The stored ledger against the operators on plain rows, and its plans."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ledger, patterns
from tallyloom.plans.ledger_store import LedgerStore
from tests.test_ledger import CHAIN, SCHEMA, rows_of


def _random_ledger():
    """A hot address in a third of the inputs, a transaction with very many outputs, repeated and incomplete rows."""
    rng = random.Random(5)
    names = [f"a{i}" for i in range(30)]
    txs = [(rng.randint(0, 40), f"t{i}", [(rng.choice(["hub", rng.choice(names)]), rng.randint(1, 9)) for _ in range(rng.randint(1, 3))],
            [(rng.choice(names), rng.randint(1, 9)) for _ in range(rng.randint(1, 3))], rng.random() < 0.1) for i in range(150)]
    txs.append((5, "wide", [("hub", 1)], [(rng.choice(names), 1) for _ in range(300)]))
    rows = rows_of(*txs)
    gaps = [(None, "vin", "hub", Decimal(1), "x", 0, False, 1), (rows[0][0], "vout", "q", Decimal(1), None, 0, False, 1),
            (rows[0][0], "vin", None, Decimal(1), rows[0][4], 7, None, 1), (rows[0][0], "vout", None, Decimal(2), rows[0][4], 8, True, 1)]
    return rows + rows[:20] + gaps


@pytest.mark.parametrize("part_rows", [1_000_000, 10])
def test_against_plain_rows(spark, rows, part_rows):
    for data in (CHAIN, _random_ledger(), []):
        frame = spark.createDataFrame(data, SCHEMA)
        store = LedgerStore.build(frame, buckets=4, part_rows=part_rows)
        for start in ("hub", "miner", "nobody"):
            assert rows(store.flow_trace_hops(start, 3)) == rows(ledger.flow_trace_hops(frame, start, 3))
        assert rows(store.miner_spending()) == rows(patterns.miner_spending(frame))
        if part_rows == 10 and len(data) > 100:
            assert store.inputs.where("address = 'hub'").select("part").distinct().count() > 3
            assert store.outputs.where("txid = 'wide'").select("part").distinct().count() > 10
        store.drop()


def test_the_ledger_side_is_not_shuffled(spark, capsys):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = LedgerStore.build(spark.createDataFrame(_random_ledger(), SCHEMA), buckets=4)
        asked = spark.range(50).select(F.concat(F.lit("a"), "id").alias("address"), F.lit(None).cast("timestamp_ntz").alias("first_time"), F.lit(1).alias("parts"))
        store.spent(asked).explain()
        spent = capsys.readouterr().out
        store.paid(spark.createDataFrame([("wide", None, 1)], "txid string, timestamp timestamp_ntz, tx_parts int")).explain()
        paid = capsys.readouterr().out
        for plan, kind in ((spent, "inputs"), (paid, "outputs")):
            scan = [line for line in plan.splitlines() if "FileScan" in line]
            assert len(scan) == 1 and kind in scan[0] and "Bucketed: true" in scan[0], plan
            assert "SortMergeJoin" in plan
        store.drop()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
