"""Files made from the tables: whole, in small batches, each text moved once."""

import os
from collections import defaultdict

import duckdb

from harkline.catalog import fixtures as fx
from harkline.session import local_path
from tests.conftest import SMALL
from tests.test_plans import plan


def test_shards_hold_the_texts_by_falling_id(spark, monkeypatch):
    monkeypatch.setattr(fx, "_made", {})
    root = local_path(fx.shard_folder(spark, SMALL))
    want = defaultdict(bytes)
    for doc_id, text in duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id DESC").fetchall():
        want[f"arkive_{doc_id // 256:06d}.bin"] += (text or "").encode()
    got = {}
    for name in os.listdir(root):
        if name.endswith(".bin"):
            with open(f"{root}/{name}", "rb") as file:
                got[name] = file.read()
    assert got == want


def test_shard_texts_move_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(fx, "_made", {})
    monkeypatch.setattr(fx, "write_joined", lambda rows, root: plans.append(plan(rows)))
    fx.shard_folder(spark, SMALL)
    assert plans[0].count("Exchange") == 1 and "Join" not in plans[0] and "collect_list" not in plans[0]


def test_joined_files(spark, folder):
    rows = [("a", b"1"), ("a", None), ("a", b"23"), ("b", None), ("c/d", b"4" * 100_000)]
    fx.write_joined(spark.createDataFrame(rows, "name string, content binary").coalesce(1), folder)
    for name, content in (("a", b"123"), ("b", b""), ("c/d", b"4" * 100_000)):
        with open(f"{folder}/{name}", "rb") as file:
            assert file.read() == content


def test_a_task_holds_few_contents(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def put(batches):
        sizes = [batch.num_rows for batch in batches]
        assert max(sizes) <= 100 and sum(sizes) == 3000
        return sum(sizes)

    fx._each_content(spark.range(0, 3000, 1, 1).selectExpr("string(id) AS name", "binary(string(id)) AS content"), put)
    assert spark.conf.get(name) == before
