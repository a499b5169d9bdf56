import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from conftest import words_df
from trendlens.operators import misra_gries as mg


def as_dict(df):
    return {r["keyword"]: r["approx_count"] for r in df.collect()}


# Hand vectors: the merged rule with the whole list as one batch.
@pytest.mark.parametrize(
    "k, stream, expected",
    [
        (2, "a a b c a", {"a": 2}),
        (2, "a b c c", {"c": 1}),
        (1, "a a b c", {"a": 1}),
        (3, "a b a", {"a": 2, "b": 1}),
    ],
)
def test_hand_vectors(spark, k, stream, expected):
    assert as_dict(mg.misra_gries(words_df(spark, stream.split()), k)) == expected


def check_bound(summary, words, k):
    true = Counter(words)
    n = len(words)
    assert len(summary) <= k
    for w, c in summary.items():
        assert 0 < c <= true[w], (w, c, true[w])
    for w, c in true.items():
        est = summary.get(w, 0)
        assert c - est <= n / (k + 1) + 1e-9
        if c > n / (k + 1):
            assert w in summary
    if len(true) <= k:
        assert summary == dict(true)


@pytest.mark.parametrize("seed", range(4))
def test_mergeable_bound_and_batches(spark, seed):
    rnd = random.Random(seed)
    k = rnd.choice([1, 3, 5, 10])
    vocab = [f"w{i}" for i in range(rnd.choice([4, 30, 200]))]
    weights = [rnd.paretovariate(1.2) for _ in vocab]
    words = rnd.choices(vocab, weights=weights, k=rnd.choice([50, 400, 1500]))
    check_bound(as_dict(mg.misra_gries(words_df(spark, words), k)), words, k)
    # batches folded one after another keep the same bound
    state = None
    cut = sorted(rnd.sample(range(1, len(words)), 3))
    for lo, hi in zip([0] + cut, cut + [len(words)]):
        state = mg.mg_update(state, words_df(spark, words[lo:hi]), k)
    check_bound(as_dict(state), words, k)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_sketch_bound_any_partitioning(spark, partitions):
    rnd = random.Random(partitions)
    words = rnd.choices([f"w{i}" for i in range(60)], weights=[1 / (i + 1) for i in range(60)], k=2000)
    k = 5
    check_bound(as_dict(mg.mg_sketch(words_df(spark, words, partitions), k)), words, k)


def test_verified_is_exact(spark):
    rnd = random.Random(7)
    words = rnd.choices(["a", "b", "c"] + [f"t{i}" for i in range(300)], weights=[200, 120, 60] + [1] * 300, k=3000)
    k = 10
    got = {r["keyword"]: r["exact_count"] for r in mg.mg_verified(words_df(spark, words, 5), k).collect()}
    true = Counter(words)
    assert got == {w: c for w, c in true.items() if c * (k + 1) > len(words)}


def test_skewed_key_holds_a_third(spark):
    words = ["hot"] * 1000 + [f"t{i}" for i in range(2000)]
    got = as_dict(mg.misra_gries(words_df(spark, words, 6), 4))
    check_bound(got, words, 4)
    assert "hot" in got


def test_resize_keeps_largest_counts(spark):
    state = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "keyword string, approx_count long")
    assert as_dict(mg.mg_resize(state, 2)) == {"a": 5, "b": 3}


def test_invalid_k(spark):
    with pytest.raises(ValueError):
        mg.misra_gries(words_df(spark, ["a"]), 0)


@pytest.mark.parametrize("budget", [1, 7, 100_000])
def test_sketch_bound_any_budget(spark, budget):
    rnd = random.Random(budget)
    words = rnd.choices([f"w{i}" for i in range(80)], weights=[1 / (i + 1) ** 1.1 for i in range(80)], k=3000)
    k = 6
    got = as_dict(mg.mg_sketch(words_df(spark, words, 4), k, budget=budget))
    check_bound(got, words, k)


def test_ties_at_the_cut_are_all_removed(spark):
    # counts a3 b2 c2, K=2: the cut is the 3rd largest count (2), so b and c both go.
    assert as_dict(mg.misra_gries(words_df(spark, list("aaabbcc")), 2)) == {"a": 1}
    # non-ASCII keywords are ordinary keys
    assert as_dict(mg.misra_gries(words_df(spark, ["热词", "热词", "é"]), 3)) == {"热词": 2, "é": 1}


def model_update(state, batch, k):
    """Pure-Python model of the mergeable rule, for brute-force comparison."""
    merged = Counter(state)
    merged.update(batch)
    if len(merged) <= k:
        return dict(merged)
    cut = sorted(merged.values(), reverse=True)[k]
    return {w: c - cut for w, c in merged.items() if c > cut}


@pytest.mark.parametrize("seed", range(3))
def test_chain_equals_model(spark, seed):
    rnd = random.Random(100 + seed)
    k = rnd.choice([2, 4, 8])
    state_model, state = {}, None
    for b in range(4):
        batch = rnd.choices([f"w{i}" for i in range(25)], weights=[1 / (i + 1) for i in range(25)], k=rnd.randint(0, 120))
        state_model = model_update(state_model, batch, k)
        df = words_df(spark, batch).withColumn("uid", F.concat(F.lit(f"{b}:"), "uid"))
        state = mg.mg_update(state, df, k)
    assert as_dict(state) == state_model


def test_merge_of_separate_summaries_keeps_the_bound(spark):
    rnd = random.Random(11)
    a = rnd.choices([f"w{i}" for i in range(40)], weights=[1 / (i + 1) for i in range(40)], k=800)
    b = rnd.choices([f"w{i}" for i in range(40)], weights=[1 / (40 - i) for i in range(40)], k=500)
    k = 5
    merged = mg.mg_merge([mg.misra_gries(words_df(spark, a), k), mg.misra_gries(words_df(spark, b), k)], k)
    check_bound(as_dict(merged), a + b, k)


@pytest.mark.parametrize("partitions", [1, 5])
def test_skewed_key_sketch_and_verified(spark, partitions):
    words = ["hot"] * 1500 + [f"t{i % 900}" for i in range(3000)]
    df = words_df(spark, words, partitions)
    k = 4
    check_bound(as_dict(mg.mg_sketch(df, k)), words, k)
    verified = {r["keyword"]: r["exact_count"] for r in mg.mg_verified(df, k).collect()}
    assert verified == {"hot": 1500}
