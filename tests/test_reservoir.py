import random
from collections import Counter

from pyspark.sql import functions as F

from conftest import words_df
from trendlens.operators import reservoir as rs


def sample(df):
    return [r["keyword"] for r in df.orderBy("sample_index").collect()]


def test_size_and_submultiset(spark):
    words = [f"w{i % 7}" for i in range(100)]
    got = sample(rs.reservoir_sample(words_df(spark, words), 20))
    assert len(got) == 20
    assert not Counter(got) - Counter(words)
    assert len(sample(rs.reservoir_sample(words_df(spark, words[:5]), 20))) == 5


def test_independent_of_partitioning_and_batches(spark):
    words = [f"w{i % 13}" for i in range(500)]
    one = sample(rs.reservoir_sample(words_df(spark, words, 1), 10))
    many = sample(rs.reservoir_sample(words_df(spark, words, 7), 10))
    assert one == many
    df = words_df(spark, words)
    state = None
    for b in range(4):
        state = rs.reservoir_update(state, df.where(F.col("uid").cast("int") % 4 == b), n_max=200)
    assert sample(rs.reservoir_view(state, 10)) == one


def test_inclusion_rate_is_uniform(spark):
    n_items, n = 40, 10
    hits = Counter()
    df = words_df(spark, [f"x{i}" for i in range(n_items)])
    seeds = 60
    for seed in range(seeds):
        for w in sample(rs.reservoir_sample(df, n, seed=str(seed))):
            hits[w] += 1
    expected = seeds * n / n_items  # 15 per item
    chi2 = sum((hits[f"x{i}"] - expected) ** 2 / expected for i in range(n_items))
    # 39 degrees of freedom: the 99.9 % quantile is about 72.
    assert chi2 < 72, chi2
    random.seed(0)
