"""One scan for a snapshot, and the two-level prefix sum of the vocabulary."""

import random

import pytest

import __spark_entry__ as E
from conftest import SF001
from pyspark.sql import functions as F
from trendlens.operators import export as xp
from trendlens.operators import misra_gries as mg
from trendlens.operators import operations as ops
from trendlens.operators import reservoir as rs
from trendlens.operators import synth
from trendlens.operators.summaries import snapshot_rows, summarise

SCHEMA = "keyword string, timestamp long, uid string"


def events(spark, rows, partitions):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def rows_of(df):
    return sorted(map(repr, df.select("kind", "keyword", "value", "at", "total_processed", "last_batch_count", "last_update_epoch").collect()))


def three(stream, k, n):
    return snapshot_rows(mg.misra_gries(stream, k), rs.reservoir_sample(stream, n), ops.batch_counters(stream))


@pytest.mark.parametrize("k,n,budget,partitions", [(50, 20, 100_000, 3), (5, 3, 1, 7), (1, 1, 4, 2), (2000, 400, 10, 5), (7, 50, 64, 1)])
def test_equals_the_three_operators(spark, k, n, budget, partitions):
    rnd = random.Random(k)
    hot = [("hot", 1_700_000_000_000 + i, f"h{i}") for i in range(400)]  # a third of all rows
    tail = [(f"词{rnd.randrange(300)}", 1_700_000_500_000 - i, f"t{i}") for i in range(800)]
    stream = events(spark, hot + tail, partitions)
    assert rows_of(summarise(stream, k, n, budget=budget)) == rows_of(three(stream, k, n))


def test_odd_rows(spark):
    rows = [(None, 5_000, "a"), (None, None, "b"), ("", 2_000, "c"), ("x", 9_999, "d"), ("x", 1, None), ("x" * 100_000, 3, "e")]
    stream = events(spark, rows, 3)
    assert rows_of(summarise(stream, 3, 4)) == rows_of(three(stream, 3, 4))
    got = {r["kind"]: r for r in summarise(stream, 3, 4).where("kind = 'counters'").collect()}
    assert (got["counters"]["total_processed"], got["counters"]["last_update_epoch"]) == (6, 9)


@pytest.mark.parametrize("n", [2, 4, 9])
def test_repeated_ids_are_kept(spark, n):
    stream = events(spark, [("w", 1, "same")] * 5 + [("v", 2, "other")] * 2, 3)
    sample = summarise(stream, 5, n).where("kind = 'sample'").orderBy("at").collect()
    assert [r["at"] for r in sample] == list(range(min(n, 7)))
    assert [r["keyword"] for r in sample] == [r["keyword"] for r in rs.reservoir_sample(stream, n).orderBy("sample_index").collect()]


def test_empty_stream(spark):
    none = spark.createDataFrame([], SCHEMA)
    rows = summarise(none, 5, 5)
    assert rows.where("kind <> 'counters'").count() == 0
    assert ops.snapshot_metrics(rows, 100).collect()[0].asDict() == {"top1_ratio": 0.0, "sample_diversity": 0.0, "data_freshness_seconds": -1}
    assert xp.snapshot_records(rows, 1).count() == 0
    assert ops.snapshot_alerts(rows, 100).first()["healthy"] is not None


@pytest.mark.parametrize("name", ["alerts", "operational_metrics", "export_records", "burst_alerts"])
def test_events_are_scanned_once(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "events.parquet" in line]
    assert len(scans) == 1, plan


def test_a_hot_keyword_is_one_row_a_task_in_the_shuffle(spark):
    from trendlens.operators.summaries import _summarise

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"keyword": ["hot"] * 5000, "uid": [str(i) for i in range(5000)], "priority": [f"{i:05}" for i in range(5000)], "timestamp": [1] * 5000})
    out = pa.Table.from_batches(list(_summarise(10, 100)(iter([batch] * 20)))).to_pylist()
    assert [(r["keyword"], r["n"]) for r in out if r["kind"] == "hot"] == [("hot", 100_000)]
    assert len(out) == 1 + 10 + 1


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_intervals_of_blocks_are_the_running_sum(spark, block):
    rnd = random.Random(block)
    vocab = [(i * 3 - 50, f"w{i}", rnd.choice([0, 1, 1, 5, 90])) for i in range(200)]
    rnd.shuffle(vocab)
    got, total, rows = synth.with_intervals(spark.createDataFrame(vocab, "ord long, keyword string, weight long"), block)
    want, at = [], 0
    for _, word, weight in sorted(vocab):
        if weight:
            want.append((word, at, at + weight))
            at += weight
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert (total, rows) == (at, len(want))


def test_no_window_runs_over_the_whole_vocabulary(spark):
    """The one window without partitions is over the blocks: the first entry of each."""
    got, _, _ = synth.with_intervals(synth.vocabulary(spark))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "Filter" in plan.split("Window [", 1)[1]


def test_a_vocabulary_without_weight_is_an_error(spark):
    rows = spark.range(3).select(F.col("id").cast("string").alias("uid"))
    for vocab in ([], [(1, "a", 0)]):
        with pytest.raises(ValueError, match="positive weight"):
            synth.assign_keywords(rows, spark.createDataFrame(vocab, "ord long, keyword string, weight long"))
