import os

import duckdb
import pytest

import __spark_entry__ as entry
from lumaset import cli

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("q_")))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    theirs = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=repr)
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_cli(capsys, tmp_path):
    assert cli.main(["list"]) == 0
    assert "net1280" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["dataset", "build-full"])
    args = cli.parser().parse_args(["dataset", "verify-full", "--output", "o", "--net-config", "n", "--source-sample", "3", "--publish"])
    assert (args.source_sample, args.publish, args.workers) == (3, True, None)
    for wrong in (["--workers", "0"], ["--workers", "4"], ["--workers", "2", "--opencv-threads", "0"]):
        assert cli.main(["dataset", "verify-full", "--output", "o", "--net-config", "n", *wrong]) == 2
    assert cli.main(["dataset", "select-smoke", "--source", str(tmp_path), "--output", "x", "--seed", "1"]) == 2
