"""What a replay and its folds leave on disk, and how many tasks pick the rows of a state."""

import glob
import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import words_df
from trendlens.config import FREE_SHUFFLES, freed_shuffles, new_work_dir
from trendlens.sources.snapshot import read_counters, read_epoch_log, read_hot_topics, read_samples
from trendlens.streaming import EpochFold, EpochStore
from trendlens.streaming import query as query_module
from trendlens.streaming.query import Step, replay


def shuffle_blocks(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def left_after(spark, before, wait=5):
    """Shuffle files that weren't there before; they are removed in the background."""
    until = time.time() + wait
    while (left := shuffle_blocks(spark) - before) and time.time() < until:
        time.sleep(1)
    return left


def step_of(spark, words, e, **kw):
    rows = words_df(spark, words).withColumn("uid", F.concat(F.lit(f"{e}:"), "uid"))
    return Step(rows.withColumn("timestamp", F.lit(None).cast("long")), **kw)


def watched_replay(spark, monkeypatch, steps):
    """The store, and of each step the messages on disk as its query starts."""
    root, seen, start = new_work_dir(spark, "test-replay"), [], query_module.start_stream

    def watched(events, store, checkpoint, *a, **kw):
        files = [f for f in glob.glob(f"{root}/source/**", recursive=True) if os.path.basename(f).startswith("part-")]
        seen.append((files, [line for f in files for line in (gzip.open if f.endswith(".gz") else open)(f, "rt")]))
        return start(events, store, checkpoint, *a, **kw)

    monkeypatch.setattr(query_module, "start_stream", watched)
    return root, replay(spark, steps, root, 3, 2, clock=lambda: 7, compact_every=2), seen


def test_messages_are_compressed_and_go_with_their_step(spark, monkeypatch):
    junk = spark.createDataFrame([("no json\nat all",), ("",), (None,)], "value string")
    steps = [step_of(spark, list("aaabb") * 40, 0), step_of(spark, list("ac") * 30, 1), Step(junk), step_of(spark, [], 3)]
    root, store, seen = watched_replay(spark, monkeypatch, steps)
    assert [len(lines) for _, lines in seen[:2]] == [200, 60]  # not those of the step before
    assert not [lines for _, lines in seen[2:] if any('"keyword"' in x for x in lines)]
    assert all(f.endswith(".gz") for files, _ in seen for f in files)
    assert not os.path.exists(f"{root}/source")
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == {"a": 150, "b": 80, "c": 30}
    assert {r["epoch"]: r["batch_count"] for r in read_epoch_log(store).collect()} == {0: 200, 1: 60, 2: 0, 3: 0}
    assert tuple(read_counters(store).first()) == (260, 60, 7)


def test_reset_on_a_junk_step_after_its_messages_went(spark, monkeypatch):
    junk = spark.createDataFrame([("prose",)] * 5, "value string")
    _, store, _ = watched_replay(spark, monkeypatch, [step_of(spark, list("aab"), 0), step_of(spark, list("b"), 1), Step(junk, reset=True)])
    assert read_hot_topics(store).count() == 0 and read_samples(store).count() == 0
    assert tuple(read_counters(store).first()) == (4, 1, 7)


def test_message_files_are_bounded(spark, monkeypatch):
    """A compressed file is read by one task, so a step that one task writes must not end up in one."""
    monkeypatch.setitem(query_module.MESSAGE_FILES, "maxRecordsPerFile", 100)
    step = step_of(spark, list("ab") * 200, 0)
    step.messages = step.messages.coalesce(1)
    _, store, seen = watched_replay(spark, monkeypatch, [step])
    assert len(seen[0][0]) == 4 and len(seen[0][1]) == 400
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == {"a": 200, "b": 200}


def test_a_failed_step_keeps_its_messages(spark, monkeypatch):
    root = new_work_dir(spark, "test-replay")

    def failing(self, batch, epoch_id):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(EpochFold, "__call__", failing)
    with pytest.raises(Exception):
        replay(spark, [step_of(spark, list("aab"), 0)], root, 3, 2)
    assert glob.glob(f"{root}/source/part-*")
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_a_replay_leaves_no_shuffle_files(spark, monkeypatch):
    before, freed, real = shuffle_blocks(spark), [], EpochFold.__call__

    def seen(self, batch, epoch_id):  # a query has a session of its own; without the setting, files go at some collection of garbage
        freed.extend(s.conf.get(FREE_SHUFFLES) for s in (batch.sparkSession, self.store.spark))
        real(self, batch, epoch_id)

    monkeypatch.setattr(EpochFold, "__call__", seen)
    _, store, _ = watched_replay(spark, monkeypatch, [step_of(spark, list("abcab") * 20, e) for e in range(3)])
    assert not left_after(spark, before)
    assert freed == ["true"] * 6
    assert spark.conf.get(FREE_SHUFFLES) == "false"
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == {"a": 120, "b": 120, "c": 60}


def test_freed_shuffles_restores_the_setting(spark):
    for was in ("true", "false"):
        spark.conf.set(FREE_SHUFFLES, was)
        with pytest.raises(ValueError), freed_shuffles(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
            raise ValueError
        assert spark.conf.get(FREE_SHUFFLES) == was
    spark.conf.unset(FREE_SHUFFLES)


def test_a_frame_whose_shuffles_were_freed_can_be_read_again(spark):
    before = shuffle_blocks(spark)
    with freed_shuffles(spark):
        frame = words_df(spark, list("abcab") * 10, 4).groupBy("keyword").count()
        first = sorted(map(tuple, frame.collect()))
    assert not left_after(spark, before)
    assert first == sorted(map(tuple, frame.collect())) == [("a", 20), ("b", 20), ("c", 10)]


def test_sampled_keywords_are_picked_by_many_tasks(spark, monkeypatch):
    """A batch's keywords, however many, must not all pass the one task that writes the state."""
    store = EpochStore(spark, new_work_dir(spark, "test-tasks"))
    fold = EpochFold(store, k=3, n=2, clock=lambda: 123)
    narrowed, real = [], EpochFold._narrow

    def kept(self, frame, meta):
        narrowed.append(frame)
        return real(self, frame, meta)

    monkeypatch.setattr(EpochFold, "_narrow", kept)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fold(words_df(spark, [f"w{i % 50}" for i in range(500)], 4), 0)
        assert narrowed[0].columns == ["keyword", "exact_count"]
        assert narrowed[0].rdd.getNumPartitions() <= 2  # the largest counts, and the sample's keywords
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tracked = {r["keyword"]: r["exact_count"] for r in real(fold, narrowed[0], fold.meta_before(0)[1]).collect()}
    assert len(tracked) > 3 and set(tracked.values()) == {10}


def registered(spark, monkeypatch, name, texts):
    """The rows of a registered query over documents of these texts, and the folder of its replay."""
    from trendlens.plans import streams
    from trendlens.plans.registry import QUERIES

    data, roots = new_work_dir(spark, "test-docs"), {}
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{data}/documents.parquet")

    def at(spark, name):
        return roots.setdefault(name, new_work_dir(spark, name))

    monkeypatch.setattr(streams, "new_work_dir", at)
    rows = QUERIES[name](spark, data).collect()
    return rows, next(root for name, root in roots.items() if name.startswith("replay-"))


def test_export_records_of_a_replay_whose_messages_went(spark, monkeypatch):
    rows, root = registered(spark, monkeypatch, "stream_export_records", ["a b a", "b c a", "a\nnew line", "c"])
    kinds = [r["record_type"] for r in rows]
    assert (kinds.count("hot_topic"), kinds.count("sample"), len(rows)) == (5, 9, 14)
    assert sorted(r["keyword"] for r in rows if r["record_type"] == "sample") == sorted("a b a b c a c".split() + ["a\nnew", "line"])
    assert os.path.isdir(f"{root}/store") and not os.path.exists(f"{root}/source")


def test_reset_empty_of_a_replay_whose_messages_went(spark, monkeypatch):
    rows, root = registered(spark, monkeypatch, "stream_reset_empty", ["a b a", "b c a", "a\nnew line", "c"])
    assert [tuple(r) for r in rows] == [(9, 4, 1_700_000_000, 0, 0, 0)]
    assert os.path.isdir(f"{root}/store") and not os.path.exists(f"{root}/source")
