from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import checks, ledger, patterns

SCHEMA = "timestamp timestamp_ntz, type string, address string, value decimal(38,8), txid string, n int, coinbase boolean, block_height long"
T0 = datetime(2025, 6, 6)


def rows_of(*txs):
    """(hour, txid, inputs {address: value}, outputs [(address, value)], coinbase)"""
    out = []
    for hour, txid, inputs, outputs, *coinbase in txs:
        at, cb = T0 + timedelta(hours=hour), bool(coinbase)
        out += [(at, "vin", a, Decimal(v), txid, i, cb, hour) for i, (a, v) in enumerate(inputs)]
        out += [(at, "vout", a, Decimal(v), txid, i, cb, hour) for i, (a, v) in enumerate(outputs)]
    return out


CHAIN = rows_of(
    (0, "cb", [], [("miner", 6)], True),
    (1, "t1", [("miner", 6)], [("a", 4), ("b", 2)]),
    (2, "t2", [("a", 4)], [("c", 3), ("a", 1)]),
    (0, "early", [("c", 9)], [("never", 9)]),
    (3, "t3", [("c", 3), ("b", 2)], [("d", 5)]),
)


@pytest.fixture
def chain(spark):
    return spark.createDataFrame(CHAIN, SCHEMA)


def test_trace_matches_a_naive_loop(spark, chain):
    spent = {(t, at) for at, kind, a, _, t, *_ in CHAIN if kind == "vin" and a == "miner"}
    want = sorted((a, at, v) for at, kind, a, v, t, *_ in CHAIN if kind == "vout" and (t, at) in spent)
    assert sorted(tuple(r) for r in ledger.flow_trace(chain, "miner").collect()) == want
    assert ledger.flow_trace(chain, "nobody").count() == 0


def test_outputs_are_not_repeated_when_an_address_has_several_inputs(spark):
    data = spark.createDataFrame(rows_of((0, "t", [("x", 1), ("x", 2), ("x", 3)], [("y", 5), ("y", 1)])), SCHEMA)
    row = ledger.flow_trace_by_address(data, "x").first()
    assert (row.address, row.transaction_count, row.total_value) == ("y", 2, Decimal(6))


def test_hops_respect_time_and_visit_once(chain):
    got = {r.address: (r.hop, r.first_time.hour, r.outputs, int(r.total_value))
           for r in ledger.flow_trace_hops(chain, "miner", 5).collect()}
    assert got == {"a": (1, 1, 1, 4), "b": (1, 1, 1, 2), "c": (2, 2, 1, 3), "d": (2, 3, 1, 5)}


def test_an_earlier_time_of_a_later_hop_is_followed(spark):
    """b is reached at 100 directly and at 50 through c; what it spent at 60 counts."""
    data = spark.createDataFrame(rows_of((10, "t1", [("a", 1)], [("c", 1)]), (20, "t2", [("a", 1)], [("b", 1)]),
                                         (12, "t3", [("c", 1)], [("b", 1)]), (15, "t4", [("b", 1)], [("d", 7)])), SCHEMA)
    got = {r.address: (r.hop, r.outputs, int(r.total_value)) for r in ledger.flow_trace_hops(data, "a", 3).collect()}
    assert got == {"b": (1, 1, 1), "c": (1, 1, 1), "d": (3, 1, 7)}
    assert "d" not in {r.address for r in ledger.flow_trace_hops(data, "a", 2).collect()}


def test_balance(chain):
    assert tuple(ledger.address_balance(chain, "a").first()) == (Decimal(9), 3)
    assert ledger.address_balance(chain, "a", signed=True).first()[0] == Decimal(1)
    assert tuple(ledger.address_balance(chain, "nobody").first()) == (None, 0)


def test_miner_and_block_time(spark, chain):
    blocks = spark.createDataFrame([(0, T0), (7, T0)], "height long, timestamp timestamp_ntz")
    assert [tuple(r) for r in ledger.miner_of_block(chain, blocks, 0).collect()] == [("miner", Decimal(6))]
    assert ledger.miner_of_block(chain, blocks, 99).count() == 0
    twice = blocks.unionByName(blocks.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 HOUR")))
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        ledger.miner_of_block(chain, twice, 0).collect()
    assert tuple(ledger.miner_earnings(chain, "miner").first()) == (Decimal(6), 1)
    assert {r.address for r in patterns.miner_spending(chain).collect()} == {"a", "b"}


def test_planted_patterns(spark):
    dust = [(i, f"dust{i}", [("spammer", 1)], [(f"v{i}_{j}", "0.00001") for j in range(20)]) for i in range(5)]
    merge = [(9, "merge", [(f"small{i}", 100) for i in range(30)], [("vault", 2999)])]
    busy = [(i, f"in{i}", [(f"cust{i}", 2)], [("hub", 2)]) for i in range(12)] + [
        (12 + i, f"out{i}", [("hub", 2)], [(f"dest{i}", 2)]) for i in range(12)]
    data = spark.createDataFrame(rows_of(*dust, *merge, *busy), SCHEMA)
    spam = patterns.dust_spam(data, 0.001, 50).collect()
    assert [(r.address, r.dust_transactions, r.dust_outputs) for r in spam] == [("spammer", 5, 100)]
    assert [(r.txid, r.inputs, r.outputs) for r in patterns.consolidations(data, 10, 2, 1000).collect()] == [("merge", 30, 1)]
    hub = patterns.exchange_like(data, 10, 10).collect()
    assert [tuple(r) for r in hub] == [("hub", 12, 12, 12, 12, 12, 12)]
    assert patterns.most_active_addresses(data, 1).first().address == "hub"


def test_degrees_match_brute_force_with_one_hot_transaction(spark):
    import random
    rng = random.Random(5)
    txs = [(i % 20, f"t{i}", [(f"a{rng.randrange(12)}", 1) for _ in range(rng.randrange(4))],
            [(f"a{rng.randrange(12)}", 1) for _ in range(rng.randrange(4))]) for i in range(60)]
    txs.append((3, "hot", [(f"a{i % 12}", 1) for i in range(300)], [(f"h{i}", 1) for i in range(300)]))
    data = rows_of(*txs)
    sides = defaultdict(lambda: {"vin": set(), "vout": set()})
    for at, kind, a, _, t, *_ in data:
        sides[t, at][kind].add(a)
    want = defaultdict(lambda: [0, 0, 0, 0])
    for side in sides.values():
        for a in side["vout"]:
            want[a][0] += 1
            want[a][2] += len(side["vin"])
        for a in side["vin"]:
            want[a][1] += 1
            want[a][3] += len(side["vout"])
    got = {r.address: [r.in_degree, r.out_degree, r.sender_links, r.receiver_links]
           for r in patterns.exchange_like(spark.createDataFrame(data, SCHEMA), 0, 0).collect()}
    assert got == dict(want)


def test_anomaly(spark):
    rows = [(f"t{i}", T0 + timedelta(minutes=i), Decimal(100 + i % 5)) for i in range(50)] + [("big", T0, Decimal(10 ** 7)),
            ("zero", T0, Decimal(0)), ("alone", T0 + timedelta(days=1), Decimal(5))]
    data = spark.createDataFrame(rows, "txid string, timestamp timestamp_ntz, value decimal(18,2)")
    assert [r.txid for r in patterns.anomalous_transactions(data, 3).collect()] == ["big"]


def test_ids_are_dense_in_order(spark):
    data = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 2).alias("hot"))
    got = checks.assign_ids(data, ["hot", "k"], start=10).orderBy("id").collect()
    assert [r.id for r in got] == list(range(10, 5010))
    assert [(r.hot, r.k) for r in got] == sorted((r.hot, r.k) for r in got)
    assert checks.assign_ids(data.limit(0), ["k"]).count() == 0


def test_one_order_key_for_half_of_the_rows_is_split(spark, monkeypatch):
    data = spark.range(0, 20_000, 1, 7).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    kept = []
    monkeypatch.setattr(checks, "cut_lineage", lambda df: kept.append(df) or df.cache())
    got = checks.assign_ids(data, ["k"], name="n")
    assert sorted(r.n for r in got.collect()) == list(range(1, 20_001))
    assert got.where("k = 0").agg(F.max("n")).first()[0] == 10_000
    sizes = sorted(r["count"] for r in kept[0].groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) > 1 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_checks(spark):
    child = spark.createDataFrame([(1, "x"), (2, None), (None, "long text")], "ref int, t string")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert [r.ref for r in checks.orphan_rows(child, "ref", parent, "id").collect()] == [2]
    assert sorted(r.null_column for r in checks.null_violations(child, ["ref", "t"]).collect()) == ["ref", "t"]
    assert checks.length_violations(child, "t", 4).count() == 1
    assert [tuple(r) for r in checks.duplicate_keys(parent, ["id"]).collect()] == [(1, 2)]


def test_distinct_counterparties_by_sketch(spark):
    """A hub with many counterparties, repeated over transactions, and one transaction that holds a third of the rows."""
    rng = random.Random(2)
    txs = []
    for k in range(300):
        txs.append((f"t{k}", [f"s{rng.randint(0, 4000)}" for _ in range(10)], ["hub"]))
        txs.append((f"u{k}", ["hub"], [f"r{rng.randint(0, 700)}" for _ in range(10)] + ["hub"]))
    txs.append(("big", [f"s{k}" for k in range(2500)] + ["hub"], [f"r{k}" for k in range(2500)]))
    rows = [(tx, "2024-01-01", kind, a) for tx, ins, outs in txs for kind, side in (("vin", ins), ("vout", outs)) for a in side]
    rows += [(None, "2024-01-01", "vin", "hub"), ("t1", "2024-01-01", "vin", None)]
    vinout = spark.createDataFrame(rows, "txid string, timestamp string, type string, address string")
    senders = {a for _, ins, outs in txs if "hub" in outs for a in ins}
    receivers = {a for _, ins, outs in txs if "hub" in ins for a in outs}
    exact = patterns.counterparties(vinout, spark.createDataFrame([("hub",)], "address string")).first()
    # the input without address counts for a transaction, not as a counterparty
    assert (exact.senders, exact.receivers) == (len(senders), len(receivers))
    got = patterns.exchange_like(vinout, 100, 100).where("address = 'hub'").first()
    assert abs(got.senders - len(senders)) <= patterns.SKETCH_ERROR * len(senders)
    assert abs(got.receivers - len(receivers)) <= patterns.SKETCH_ERROR * len(receivers)
    assert got.sender_links > 1.1 * len(senders)
