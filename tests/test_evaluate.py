from trendlens.operators import evaluate as ev
from trendlens.operators import operations as ops


def frames(spark, mg_rows, exact_rows, sample_words, total):
    mg = spark.createDataFrame(mg_rows, "keyword string, approx_count long")
    exact = spark.createDataFrame(exact_rows, "keyword string, exact_count long")
    sample = spark.createDataFrame(list(enumerate(sample_words)), "sample_index int, keyword string")
    totals = spark.createDataFrame([(total,)], "total_processed long")
    return mg, exact, sample, totals


def test_metrics_small_case(spark):
    mg, exact, sample, totals = frames(spark, [("a", 5), ("b", 1)], [("a", 6), ("b", 3), ("c", 1)], ["a", "a", "c", "b"], 10)
    row = ev.evaluate(mg, exact, sample, totals, 2).first()
    assert row["topk_recall_at_k"] == 1.0 and row["top1_match"] == 1 and row["overlap_count"] == 2
    # p = .6 .3 .1, q = .5 .25 .25 -> TVD = (.1 + .05 + .15) / 2
    assert abs(row["reservoir_tvd"] - 0.15) < 1e-9
    assert abs(row["reservoir_similarity"] - 0.85) < 1e-9
    assert row["mg_unique"] == 2 and row["exact_unique"] == 3
    assert row["mg_memory_bytes"] == 18 and row["exact_memory_bytes"] == 27


def test_metrics_without_exact(spark):
    mg, _, sample, totals = frames(spark, [("a", 5)], [], ["a"], 5)
    row = ev.evaluate(mg, None, sample, totals, 2).first()
    assert (row["topk_recall_at_k"], row["top1_match"], row["reservoir_tvd"], row["exact_baseline_enabled"]) == (
        0.0,
        0,
        1.0,
        0,
    )


def test_operational_and_alerts(spark):
    mg, _, sample, _ = frames(spark, [("a", 90), ("b", 10)], [], ["a"] * 12, 0)
    counters = spark.createDataFrame([(5000, 100, 1000)], "total_processed long, last_batch_count long, last_update_epoch long")
    m = ops.operational_metrics(mg, sample, counters, as_of=1010)
    row = m.first()
    assert (row["top1_ratio"], row["sample_diversity"], row["data_freshness_seconds"]) == (0.9, round(1 / 12, 6), 10)
    a = ops.alerts(m, counters, sample, 2).first()
    assert (a["alert_freshness"], a["alert_concentration"], a["alert_diversity"], a["healthy"]) == (1, 1, 1, 0)


def test_category_rollup_default(spark):
    hot = spark.createDataFrame([("AI", 5), ("Agent", 2), ("zzz", 4)], "keyword string, approx_count long")
    rows = [tuple(r) for r in ops.category_rollup(hot, ops.category_dimension(spark)).collect()]
    assert rows == [("AI/模型", 7), ("其他", 4)]


def test_exact_top_smaller_than_k(spark):
    # 3 distinct keywords, K = 10: recall divides by the 3 exact keywords, not by K.
    mg, exact, sample, totals = frames(spark, [("a", 4), ("b", 1)], [("a", 4), ("b", 1), ("c", 1)], ["a", "b"], 6)
    row = ev.evaluate(mg, exact, sample, totals, 10).first()
    assert row["overlap_count"] == 2
    assert row["topk_recall_at_k"] == round(2 / 3, 6)
    assert row["top1_match"] == 1


def test_no_data_gives_defaults(spark):
    mg, exact, sample, totals = frames(spark, [], [], [], 0)
    row = ev.evaluate(mg, exact, sample, totals, 5).first()
    assert (row["topk_recall_at_k"], row["top1_match"], row["overlap_count"], row["reservoir_tvd"]) == (0.0, 0, 0, 1.0)
    assert row["reservoir_similarity"] == 0.0 and row["memory_saved_percent"] == 0.0


def test_bounded_broadcast_checks_the_size(spark):
    from trendlens.config import bounded_broadcast

    small = spark.range(5)
    big = spark.range(50)
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(bounded_broadcast(small, limit=10)).lower()
    assert "broadcast" not in plan(bounded_broadcast(big, limit=10)).lower()


def test_tvd_where_the_baseline_is_smaller_than_the_total(spark):
    """p = c / total even if the counts don't add up to the total: 0.5 * (|5/20 - 1| + 5/20)."""
    exact = spark.createDataFrame([("a", 5), ("b", 5)], "keyword string, exact_count long")
    sample = spark.createDataFrame([(0, "a")], "sample_index int, keyword string")
    totals = spark.createDataFrame([(20,)], "total_processed long")
    assert ev.reservoir_tvd(exact, sample, totals).first()["reservoir_tvd"] == 0.5
