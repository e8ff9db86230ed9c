from __future__ import annotations

import gzip
from decimal import Decimal

import pytest

from tallyloom.sources.readers import literal_rows, read_csv

TX = "txid string, at timestamp_ntz, value decimal(38,8), coinbase boolean, tags array<string>"


def test_csv_into_declared_schema(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text('txid,at,value,coinbase,tags\na,2025-06-06 00:00:01,0.00000001,true,"{ab,cd}"\n'
                    'b,2025-06-06 00:00:02,,false,{}\n')
    got = read_csv(spark, str(path), TX).orderBy("txid").collect()
    assert got[0].value == Decimal("0.00000001") and got[0].tags == ["ab", "cd"] and got[0].coinbase is True
    assert got[1].value is None and got[1].tags == []


def test_gzip_csv_spreads_its_rows(spark, tmp_path):
    path = tmp_path / "tx.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write("id,name\n" + "".join(f"{i},n{i}\n" for i in range(1000)))
    df = read_csv(spark, str(path), "id int, name string", partitions=4)
    assert df.count() == 1000 and df.rdd.getNumPartitions() == 4


def test_column_list_and_delimiter(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("code;id\nx;1\n")
    got = read_csv(spark, str(path), "id int, name string, code string", ["code", "id"], ";").collect()
    assert [tuple(r) for r in got] == [(1, None, "x")]


def test_bad_row_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,name\nnope,x\n")
    with pytest.raises(Exception, match="(?i)malformed|cast|parse"):
        read_csv(spark, str(path), "id int, name string").collect()


def test_literal_rows_are_cast(spark):
    df = literal_rows(spark, [("2024-01-31 00:00:00", "4", 5, None)], "time timestamp_ntz, sensor_id int, temperature double, cpu double",
                      ["time", "sensor_id", "cpu", "temperature"])
    row = df.first()
    assert (row.sensor_id, row.cpu, row.temperature) == (4, 5.0, None)
    assert df.columns == ["time", "sensor_id", "temperature", "cpu"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        literal_rows(spark, [("x",)], "id int").collect()
