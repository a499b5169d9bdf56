import pytest
from pyspark.sql import functions as F

from conftest import words_df
from trendlens.config import new_work_dir
from trendlens.sources.snapshot import read_counters, read_epoch_log, read_hot_topics
from trendlens.streaming import EpochFold, EpochStore, request_reset, set_control


def fold_for(spark, **kw):
    store = EpochStore(spark, new_work_dir(spark, "test-fold"))
    return store, EpochFold(store, k=3, n=2, clock=lambda: 123, **kw)


def counters(store):
    r = read_counters(store).first()
    return r["total_processed"], r["last_batch_count"], r["last_update_epoch"]


def test_replayed_epoch_counts_once(spark):
    store, fold = fold_for(spark)
    batch = words_df(spark, list("aabbbc"))
    fold(batch, 0)
    fold(batch, 0)  # redelivered epoch
    assert counters(store) == (6, 6, 123)
    fold(words_df(spark, list("aa")).withColumn("uid", F.concat(F.lit("x"), "uid")), 1)
    assert counters(store) == (8, 2, 123)
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == {"a": 4, "b": 3, "c": 1}


def test_empty_batch_keeps_snapshot(spark):
    store, fold = fold_for(spark)
    fold(words_df(spark, list("abc")), 0)
    fold(words_df(spark, []), 1)
    assert counters(store) == (3, 3, 123)
    log = {r["epoch"]: r["batch_count"] for r in read_epoch_log(store).collect()}
    assert log == {0: 3, 1: 0}


def test_reset_and_resize_via_control(spark):
    store, fold = fold_for(spark)
    fold(words_df(spark, list("aaabbc")), 0)
    set_control(store, k="1", n="bad")
    fold(words_df(spark, list("a")).withColumn("uid", F.lit("y0")), 1)
    hot = {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()}
    assert hot == {"a": 4}
    request_reset(store)
    fold(words_df(spark, list("zz")).withColumn("uid", F.concat(F.lit("z"), "uid")), 2)
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == {"z": 2}
    assert counters(store) == (2, 2, 123)
    # the same reset token is not applied twice
    fold(words_df(spark, list("z")).withColumn("uid", F.lit("q")), 3)
    assert counters(store) == (3, 1, 123)


def test_exact_compaction_matches_sum(spark):
    store, fold = fold_for(spark, compact_every=2)
    words = list("abcabcaab")
    for e in range(3):
        fold(words_df(spark, words).withColumn("uid", F.concat(F.lit(f"{e}:"), "uid")), e)
    _, meta = fold.meta_before(2)
    assert meta.exact_base_epoch == 1 and meta.exact_epochs == (2,)
    got = {r["keyword"]: r["n"] for r in fold.exact_state(meta).collect()}
    assert got == {"a": 12, "b": 9, "c": 6}


def test_exact_baseline_off(spark):
    from trendlens.sources.snapshot import read_eval_metrics, read_exact_topics

    store, fold = fold_for(spark, enable_exact=False)
    fold(words_df(spark, list("aaabbc")), 0)
    m = read_eval_metrics(store).first()
    assert (m["exact_baseline_enabled"], m["topk_recall_at_k"], m["reservoir_tvd"], m["exact_unique"]) == (0, 0.0, 1.0, 0)
    assert m["mg_unique"] == 3 and m["exact_memory_bytes"] == 0
    assert read_exact_topics(store).count() == 0
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == {"a": 3, "b": 2, "c": 1}


def test_stream_equals_batch_for_any_split(spark):
    from trendlens.operators import exact as ex
    from trendlens.operators import reservoir as rs
    from trendlens.sources.snapshot import read_samples

    words = [f"w{i % 11}" for i in range(300)]
    df = words_df(spark, words)
    store, fold = fold_for(spark)
    for e, (lo, hi) in enumerate([(0, 40), (40, 41), (41, 300)]):
        fold(df.where((F.col("uid").cast("int") >= lo) & (F.col("uid").cast("int") < hi)), e)
    _, meta = fold.meta_before(2)
    streamed = {r["keyword"]: r["n"] for r in fold.exact_state(meta).collect()}
    assert streamed == {r["keyword"]: r["exact_count"] for r in ex.exact_counts(df).collect()}
    got = [r["keyword"] for r in read_samples(store).collect()]
    want = [r["keyword"] for r in rs.reservoir_sample(df, 2).orderBy("sample_index").collect()]
    assert got == want


def test_epoch_crash_before_commit_is_redone(spark):
    """A task or driver failure after the state writes but before the log row: the
    redelivered epoch redoes the work from the previous committed state, once."""
    store, fold = fold_for(spark)
    fold(words_df(spark, list("abc")), 0)
    real_commit = store.commit
    calls = {"n": 0}

    def failing_commit(row):
        calls["n"] += 1
        raise RuntimeError("executor lost")

    store.commit = failing_commit
    batch = words_df(spark, list("aab")).withColumn("uid", F.concat(F.lit("e1:"), "uid"))
    try:
        fold(batch, 1)
    except RuntimeError:
        pass
    store.commit = real_commit
    assert calls["n"] == 1
    assert counters(store) == (3, 3, 123)  # epoch 1 is not visible
    fold(batch, 1)  # redelivery
    fold(batch, 1)  # and once more after the commit: no effect
    assert counters(store) == (6, 3, 123)
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == {"a": 3, "b": 2, "c": 1}


def test_processing_time_trigger(spark):
    """K8 with a continuous trigger: the result does not depend on how files fall into batches."""
    from trendlens.operators.synth import to_payload
    from trendlens.sources.keywords import source_keywords
    from trendlens.sources.snapshot import read_samples
    from trendlens.streaming import start_stream

    root = new_work_dir(spark, "test-trigger")
    words = [f"w{i % 7}" for i in range(200)]
    df = words_df(spark, words).withColumn("timestamp", F.lit(None).cast("long"))
    for part in range(3):
        to_payload(df.where(F.col("uid").cast("int") % 3 == part)).write.mode("append").text(f"{root}/src")
    store = EpochStore(spark, f"{root}/store")
    q = start_stream(source_keywords(spark, "text", f"{root}/src"), store, f"{root}/chk", k=3, n=2,
                     trigger={"processingTime": "1 second"}, clock=lambda: 5)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert counters(store)[0] == 200
    from trendlens.operators import reservoir as rs

    want = [r["keyword"] for r in rs.reservoir_sample(df, 2).orderBy("sample_index").collect()]
    assert [r["keyword"] for r in read_samples(store).collect()] == want


def test_plain_payloads_without_uid(spark):
    """The plain {"keyword", "timestamp"} payload (no occurrence id) streams through the fold."""
    from trendlens.operators.synth import to_payload
    from trendlens.sources.keywords import source_keywords
    from trendlens.sources.snapshot import read_samples
    from trendlens.streaming import start_stream

    root = new_work_dir(spark, "test-plain")
    df = words_df(spark, [f"w{i % 5}" for i in range(60)]).withColumn("timestamp", F.lit(7).cast("long"))
    to_payload(df, with_uid=False).write.text(f"{root}/src")
    store = EpochStore(spark, f"{root}/store")
    q = start_stream(source_keywords(spark, "text", f"{root}/src"), store, f"{root}/chk", k=3, n=4,
                     trigger={"availableNow": True}, clock=lambda: 9)
    q.awaitTermination()
    assert counters(store) == (60, 60, 9)
    samples = [r["keyword"] for r in read_samples(store).collect()]
    assert len(samples) == 4 and set(samples) <= {f"w{i}" for i in range(5)}
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == {}  # 5 keys × 12, K=3


def test_dashboard_from_snapshot(spark):
    from trendlens.operators.operations import dashboard

    store, fold = fold_for(spark)
    empty = dashboard(store, as_of=200).first()
    assert empty["data_freshness_seconds"] == -1 and empty["healthy"] == 1 and empty["top1_ratio"] == 0.0
    fold(words_df(spark, list("aaaaab")), 0)
    row = dashboard(store, as_of=200).first()
    # clock = 123, hot topics a:5 b:1 (K=3), sample of 2 slots
    assert row["data_freshness_seconds"] == 77 and row["alert_freshness"] == 1
    assert row["top1_ratio"] == round(5 / 6, 6)
    assert row["exact_memory_text"] == "18.00 B" and row["mg_memory_text"] == "18.00 B"


def test_live_rate_stream_through_the_fold(spark):
    """G4 + K8: the rate source with weighted draws and a burst, folded like the live demo."""
    from trendlens.operators.synth import BURST_WORD, rate_stream
    from trendlens.streaming import start_stream

    root = new_work_dir(spark, "test-rate")
    store = EpochStore(spark, f"{root}/store")
    q = start_stream(rate_stream(spark, 2000, burst_target=BURST_WORD), store, f"{root}/chk", k=10, n=5,
                     trigger={"once": True}, clock=lambda: 1)
    q.awaitTermination(120)
    q.stop()
    assert counters(store)[:2] == (2000, 2000)
    hot = [r["keyword"] for r in read_hot_topics(store).collect()]
    assert hot[0] == BURST_WORD  # 90 % of the traffic


def test_sample_after_a_grow_past_the_state_holds_what_was_never_dropped(spark):
    from trendlens.operators import reservoir as rs
    from trendlens.sources.snapshot import read_samples

    words = words_df(spark, [f"w{i}" for i in range(1200)])
    early, late = words.where(F.col("uid").cast("int") < 600), words.where(F.col("uid").cast("int") >= 600)
    store, fold = fold_for(spark, min_slots=5)
    fold(early, 0)
    set_control(store, n=400)
    fold(late, 1)
    ranked = [(r["priority"], r["keyword"]) for r in rs.with_priority(early).orderBy("priority").collect()]
    mark = ranked[5][0]
    everything = rs.with_priority(words).orderBy("priority").collect()
    want = [r["keyword"] for r in everything if r["priority"] < mark]
    assert [r["keyword"] for r in read_samples(store).orderBy("sample_index").collect()] == want
    set_control(store, n=3)  # shrinks the state to 5 slots: what is dropped now stays out
    fold(words_df(spark, ["x"]).withColumn("uid", F.lit("x")), 2)
    assert read_samples(store).count() == 3
    set_control(store, n=400)
    fold(words_df(spark, []), 3)
    fold(early.withColumn("uid", F.concat(F.lit("again"), "uid")), 4)
    again = rs.with_priority(early.withColumn("uid", F.concat(F.lit("again"), "uid"))).collect()
    x = rs.with_priority(words_df(spark, ["x"]).withColumn("uid", F.lit("x"))).collect()
    kept = sorted([(r["priority"], r["keyword"]) for r in everything if r["priority"] < mark] + [(r["priority"], "x") for r in x if r["priority"] < mark])
    cut = kept[5][0] if len(kept) > 5 else mark
    want = sorted([p for p in kept if p[0] < cut] + [(r["priority"], r["keyword"]) for r in again if r["priority"] < cut])
    assert [r["keyword"] for r in read_samples(store).orderBy("sample_index").collect()] == [w for _, w in want]


def test_exact_baseline_with_a_gap_is_not_published(spark):
    from trendlens.sources.snapshot import read_eval_metrics, read_exact_topics

    store, off = fold_for(spark, enable_exact=False)
    on = EpochFold(store, k=3, n=2, clock=lambda: 123)
    off(words_df(spark, list("aaabbc")), 0)
    on(words_df(spark, list("ab")).withColumn("uid", F.concat(F.lit("1:"), "uid")), 1)
    m = read_eval_metrics(store).first()
    assert (m["exact_baseline_enabled"], m["exact_unique"], m["reservoir_tvd"]) == (0, 0, 1.0)
    assert read_exact_topics(store).count() == 0
    request_reset(store)
    on(words_df(spark, list("zzy")).withColumn("uid", F.concat(F.lit("2:"), "uid")), 2)
    m = read_eval_metrics(store).first()
    assert (m["exact_baseline_enabled"], m["exact_unique"]) == (1, 2)
    assert {r["keyword"]: r["exact_count"] for r in read_exact_topics(store).collect()} == {"z": 2, "y": 1}


def test_control_value_beyond_the_log_range_is_ignored(spark):
    store, fold = fold_for(spark)
    fold(words_df(spark, list("aab")), 0)
    set_control(store, k=3_000_000_000, n=3_000_000_000)
    fold(words_df(spark, list("a")).withColumn("uid", F.lit("y")), 1)
    assert {(r["k"], r["n"]) for r in read_epoch_log(store).collect()} == {(3, 2)}


def test_mg_history_of_an_empty_store(spark):
    from trendlens.sources.snapshot import read_mg_history

    assert read_mg_history(EpochStore(spark, new_work_dir(spark, "empty")), "a").count() == 0


def test_state_folder_that_is_gone_raises(spark):
    import pytest
    from pyspark.errors import AnalysisException

    from trendlens.schema import SKETCH_STATE

    store, _ = fold_for(spark)
    with pytest.raises(AnalysisException):
        store.read("state/sketch", 7, SKETCH_STATE).count()


def brute_fold(batches, ks):
    """Merged MG rule, error bound and exact counts of batches, with K of each batch; a smaller K drops the smallest counters."""
    from collections import Counter

    state, bound, exact, k0 = Counter(), 0, Counter(), ks[0]
    for words, k in zip(batches, ks):
        ranked = sorted(state.items(), key=lambda x: (-x[1], x[0]))
        if k < k0 and len(ranked) > k:
            bound += ranked[k][1]
            state = Counter(dict(ranked[:k]))
        k0 = k
        state.update(words)
        exact.update(words)
        counts = sorted(state.values(), reverse=True)
        cut = counts[k] if len(counts) > k else 0
        bound += cut
        state = Counter({w: n - cut for w, n in state.items() if n > cut})
    return state, bound, exact


def test_bound_and_maintained_baseline_over_resizes(spark, monkeypatch):
    """Counters, error bound, exact top-K, unique count and bytes equal brute force, over resizes and bucketed runs."""
    import random

    from trendlens.sources.snapshot import read_error_bound, read_eval_metrics, read_exact_topics
    from trendlens.streaming import fold as fold_module

    monkeypatch.setattr(fold_module, "BUCKET_ROWS", 8)
    rng = random.Random(3)
    ks = [3, 3, 2, 6, 6]
    batches = [[f"w{int(rng.paretovariate(0.8)) % 40}" for _ in range(60)] for _ in ks]
    store, fold = fold_for(spark, compact_every=2)
    for e, (words, k) in enumerate(zip(batches, ks)):
        if e and k != ks[e - 1]:
            set_control(store, k=k)
        fold(words_df(spark, words).withColumn("uid", F.concat(F.lit(f"{e}:"), "uid")), e)
    state, bound, exact = brute_fold(batches, ks)
    assert {r["keyword"]: r["approx_count"] for r in read_hot_topics(store).collect()} == dict(state)
    assert read_error_bound(store).first()["mg_error_bound"] == bound
    assert all(0 <= n - state[w] <= bound for w, n in exact.items())
    top = sorted(exact.items(), key=lambda x: (-x[1], x[0]))[:6]
    assert [(r["keyword"], r["exact_count"]) for r in read_exact_topics(store).collect()] == top
    m = read_eval_metrics(store).first()
    assert (m["exact_unique"], m["exact_memory_bytes"]) == (len(exact), sum(len(w) + 8 for w in exact))
    meta = fold.meta_before(4)[1]
    assert any(r.buckets > 1 for r in meta.exact_runs)
    assert {r["keyword"]: r["n"] for r in fold.exact_state(meta).collect()} == dict(exact)
    store.expire(1)
    assert {r["keyword"]: r["n"] for r in fold.exact_state(meta).collect()} == dict(exact)
    assert store.epochs("snapshot") == [4] and store.epochs("state/sketch") == [4]
    fold(words_df(spark, ["w1"]).withColumn("uid", F.lit("last")), 5)
    assert counters(store) == (301, 1, 123)


def test_readers_open_few_files_however_old_the_stream_is(spark):
    from trendlens.streaming.fold import Meta
    from trendlens.streaming.state import LOG_HEAD

    store = EpochStore(spark, new_work_dir(spark, "test-old"))
    for e in range(50):
        store.commit(Meta(e, e, 3, 2, total_processed=e).row())
    assert store.latest_entry()["epoch"] == 49 and store.last_entry(20)["epoch"] == 20 and store.last_entry(3)["epoch"] == 3
    log = store.log()
    assert len(log.inputFiles()) <= LOG_HEAD + 1 and len(store.epochs("log")) <= 2 * LOG_HEAD + 1
    assert sorted((r["epoch"], r["batch_count"]) for r in read_epoch_log(store).collect()) == [(e, e) for e in range(50)]


def test_control_is_one_small_read(spark):
    from trendlens.streaming.control import KEEP_VERSIONS, latest_control

    store = EpochStore(spark, new_work_dir(spark, "test-control"))
    assert latest_control(store) is None
    for k in range(1, 25):
        set_control(store, k=k)
    assert latest_control(store).k == "24" and len(store.epochs("control")) <= KEEP_VERSIONS
    assert latest_control(store, after=24) is None


def test_damaged_log_is_not_taken_for_a_new_stream(spark):
    import os

    import pytest

    store, fold = fold_for(spark)
    fold(words_df(spark, list("ab")), 0)
    folder = store.epoch_path("log", 0).removeprefix("file:")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(b"not parquet")
        if name.endswith(".crc"):
            os.remove(f"{folder}/{name}")
    with pytest.raises(Exception):
        EpochFold(store, k=3, n=2)(words_df(spark, list("ab")), 1)


def test_certificate_sees_faults(spark):
    from trendlens.operators import exact as ex
    from trendlens.operators import misra_gries as mg

    exact = ex.exact_counts(words_df(spark, list("aaaaabbbcd")))
    row = lambda s: tuple(mg.mg_certificate(spark.createDataFrame(s, "keyword string, approx_count long"), exact, 2).first())
    assert row([("a", 4), ("b", 2)]) == (10, 1, 0, 0, 0, True)
    assert row([("b", 4), ("x", 1)]) == (10, 1, 1, 2, 1, True)
    assert row([("a", 5), ("b", 3), ("c", 1)]) == (10, 1, 0, 0, 0, False)


def test_a_batch_is_read_once_for_counts_and_reservoir(spark, monkeypatch):
    from trendlens.streaming import fold as fold_module

    monkeypatch.setattr(fold_module, "SMALL_PRIORITY", "8")
    store, fold = fold_for(spark, min_slots=5, compact_every=2)
    read = spark.sparkContext.accumulator(0)

    def passed(r):
        read.add(1)
        return r

    for e in range(3):
        rows = spark.sparkContext.parallelize([(f"w{i % 3}", f"{e}:{i}") for i in range(1000)], 20).map(passed)
        before = read.value
        fold(spark.createDataFrame(rows, "keyword string, uid string"), e)
        assert read.value - before < 1500  # all once, and a few to see that there are some
        assert fold.meta_before(e)[1].exact_runs[-1].rows < 1000 * (e + 1)  # rows of counts, not occurrences
    assert {r["keyword"]: r["n"] for r in fold.exact_state(fold.meta_before(2)[1]).collect()} == {"w0": 1002, "w1": 999, "w2": 999}


@pytest.mark.parametrize("small", ["", "1", "8", "g"])
def test_reservoir_is_the_same_wherever_priorities_are_split(spark, monkeypatch, small):
    """Occurrences with equal ids included, and ids that most of a batch shares; N grows and shrinks."""
    from hashlib import md5

    from trendlens.config import DEFAULT_SEED
    from trendlens.sources.snapshot import read_samples
    from trendlens.streaming import fold as fold_module

    monkeypatch.setattr(fold_module, "SMALL_PRIORITY", small)
    store, fold = fold_for(spark, min_slots=6, compact_every=2)
    state, counts, n = [], {}, 2
    for e, (size, new_n) in enumerate([(40, None), (3, None), (60, 12), (50, 4)]):
        rows = [(f"w{i % 7}", "same" if e != 1 and i % 3 else f"{e}:{i % 20}") for i in range(size)]
        if new_n:
            set_control(store, n=new_n)
            n = new_n
        fold(spark.createDataFrame(rows, "keyword string, uid string"), e)
        state += [(md5(f"{DEFAULT_SEED}:{u}".encode()).hexdigest(), False, u, w) for w, u in rows]
        kept = sorted(state, key=lambda r: r[:3])
        at = min([i for i, r in enumerate(kept) if r[1]] + [max(6, n)])
        state = [*kept[:at], *((r[0], True, *r[2:]) for r in kept[at : at + 1])]
        for w, _ in rows:
            counts[w] = counts.get(w, 0) + 1
        got = read_samples(store).count()
        assert got == min(n, at)
        slots = fold_module.slots_of(fold.sketch(fold.meta_before(e)[1])).collect()
        assert sorted((r["priority"], r["dropped"], r["uid"]) for r in slots) == sorted(r[:3] for r in state)
        assert {r["keyword"]: r["n"] for r in fold.exact_state(fold.meta_before(e)[1]).collect()} == counts
