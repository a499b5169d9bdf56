"""Row admission and JSON parsing (the raw message cases of the keyword payload)."""

import json

from pyspark.sql import functions as F

from trendlens.config import new_work_dir
from trendlens.operators import export as xp
from trendlens.sinks.dataset import write_dataset
from trendlens.sources.dataset import load_dataset, load_latest
from trendlens.sources.keywords import parse_keywords
from trendlens.sources.snapshot import parse_counts


def test_parse_cases(spark):
    raw = [
        ('{"keyword":"a","timestamp":1}',),
        ('{"keyword":5}',),
        ('{"keyword":" "}',),
        ('{"keyword":"b","timestamp":"x"}',),
        ('{"keyword":""}',),
        ('{"keyword":null}',),
        ("bad",),
        ('[{"keyword":"z"}]',),
        (None,),
    ]
    df = spark.createDataFrame(raw, "value string")
    got = [(r["keyword"], r["timestamp"]) for r in parse_keywords(df).collect()]
    assert sorted(got, key=str) == sorted([("a", 1), ("5", None), (" ", None), ("b", None)], key=str)


def test_binary_value_is_cast(spark):
    df = spark.createDataFrame([(bytearray(b'{"keyword":"k"}'),)], "value binary")
    assert [r["keyword"] for r in parse_keywords(df).collect()] == ["k"]


def test_parse_counts_drops_bad_values(spark):
    df = spark.createDataFrame([("a", "3"), ("b", "x"), ("c", "10"), ("d", None)], "keyword string, approx_count string")
    assert [tuple(r) for r in parse_counts(df, "approx_count").collect()] == [("c", 10), ("a", 3)]


def test_jsonl_keeps_nulls_and_unicode(spark):
    hot = spark.createDataFrame([("热词", 3), ("b", 3)], "keyword string, approx_count long")
    sample = spark.createDataFrame([(0, "热词")], "sample_index int, keyword string")
    counters = spark.createDataFrame([(4, 4, 99)], "total_processed long, last_batch_count long, last_update_epoch long")
    records = xp.export_records(hot, sample, counters, 1000)
    root = new_work_dir(spark, "test-export")
    export = write_dataset(records, root, "my prefix!", 1000)
    assert export.jsonl_file == "my_prefix_19700101_001640.jsonl"
    assert export.record_count == 3
    lines = spark.read.text(export.jsonl_path).collect()
    objs = [json.loads(r["value"]) for r in lines]
    assert all("sample_index" in o and "rank" in o for o in objs)
    assert any('"热词"' in r["value"] for r in lines)  # not escaped
    hot_rows = sorted((o["rank"], o["keyword"]) for o in objs if o["record_type"] == "hot_topic")
    assert hot_rows == [(1, "b"), (2, "热词")]  # ties: keyword ascending
    back = load_dataset(spark, export.jsonl_path)
    assert back.where(F.col("record_type") == "sample").first()["approx_count"] is None
    write_dataset(xp.export_records(hot, sample, counters, 2000), root, "my prefix!", 2000)
    assert load_latest(spark, root).first()["snapshot_exported_at"] == 2000


def test_kafka_rate_options():
    from trendlens.sources.keywords import kafka_options

    assert kafka_options("h:1", "t", max_offsets_per_trigger=500, fail_on_data_loss=False) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "500",
    }
    assert "maxOffsetsPerTrigger" not in kafka_options("h:1", "t")


def test_missing_state_folder_raises(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    from trendlens.schema import EXACT_STATE
    from trendlens.streaming.state import EpochStore

    store = EpochStore(spark, str(tmp_path))
    assert store.read("state/exact_base", -1, EXACT_STATE).count() == 0
    with pytest.raises(AnalysisException):
        store.read("state/exact_base", 3, EXACT_STATE).count()


def test_latest_export_is_found_by_name(spark, tmp_path):
    import pytest

    from trendlens.sources.dataset import latest_export, load_latest

    root = str(tmp_path / "exports")
    assert latest_export(spark, root) is None
    with pytest.raises(FileNotFoundError):
        load_latest(spark, root)
    line = '{"record_type": "hot_topic", "keyword": "a", "approx_count": 1, "rank": 1}\n'
    (tmp_path / "exports" / "hot_20240102_000000.jsonl").mkdir(parents=True)  # its writer has not finished
    with pytest.raises(FileNotFoundError):
        load_latest(spark, root)
    (tmp_path / "exports" / "hot_20240101_000000.jsonl").write_text(line)  # written by somebody else
    assert latest_export(spark, root).endswith("hot_20240101_000000.jsonl")
    assert load_latest(spark, root).first()["keyword"] == "a"
    (tmp_path / "exports" / "hot_20240102_000000.jsonl" / "_SUCCESS").touch()
    assert latest_export(spark, root).endswith("hot_20240102_000000.jsonl")


def test_messages_are_parsed_once(spark):
    """Admission filters the parsed keyword; it must not parse the message again below."""
    raw = spark.createDataFrame([('{"keyword": "a", "uid": "1"}',), ('{"keyword": ""}',), ("[]",), (None,)], "value string")
    rows = parse_keywords(raw)
    assert [tuple(r) for r in rows.collect()] == [("a", None, "1")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
