"""The registered training-data queries on the small tables, against SQL or brute force."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest

from conftest import SF001
from trendlens.llm import mixing
from trendlens.llm import queries as Q
from trendlens.llm.common import table
from trendlens.plans.compare import compare_frames


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    return {r["doc_id"]: r for r in Q.QUERIES[name](spark, SF001).collect()}


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracle(spark, con, name):
    ok, why = compare_frames(Q.QUERIES[name](spark, SF001).toPandas(), con.execute(Q.ORACLES[name]).df())
    assert ok, why


def test_mix_reaches_targets(spark):
    got = mixing.mix_report(table(spark, SF001, "documents")).toPandas()
    for _, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
    assert (got.taken <= 3 * got["size"]).all()
    assert abs(got.drop_duplicates("source").target.sum() - got["size"].sum()) < 1e-3


def test_suffix_dedup(spark, docs):
    length, seen = 400, Counter()
    texts = [(i, t.encode()) for i, t in docs]
    for _, b in texts:
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    got = rows(spark, "op4_suffix_dedup")
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, at = rows(spark, "op5_token_files"), 0
    for i, t in docs:
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4")
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_sharding(spark, docs):
    got = Q.op6_rendezvous_shards(spark, SF001).toPandas()
    sizes = {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in docs}
    assert dict(zip(got.doc_id, zip(got["size"], got.text_crc32))) == sizes
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert set(got.grown_shard[got.grown_shard != got.shard]) <= {24}
    assert set(got.shard) <= set(range(24)) and (got.law == "key").all()


def test_toxicity_held_out(spark, con):
    got = Q.op7_toxicity_crf(spark, "/root/testdata/sf0.1").toPandas()
    labels = con.execute("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").df()
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    m = got[got.held_out].merge(labels, on="doc_id")
    toxic, said = m.toxic == 1, m.predicted == 1
    assert (toxic & said).sum() >= 0.85 * toxic.sum()
    assert (~toxic & said).sum() <= 0.01 * (~toxic).sum()


def test_byte_bpe(spark, docs):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, "op8_byte_bpe")
    for i, t in docs:
        ids = np.array(encoding.encode_ordinary(t), "<u4").tobytes()
        r = got[i]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_fingerprints(spark, docs):
    got = rows(spark, "op9_fingerprints")
    prints = {}
    for k, (i, t) in enumerate(docs):
        q = len(t) // 4
        edited = t[: len(t) - q] + docs[(k + 1) % len(docs)][1][:q]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(t, got[i].fingerprint) == got[i].fingerprint
    assert np.median([r.near_edited for r in got.values()]) > 0.6
    assert np.median([r.near_next for r in got.values()]) < 0.05


def brute_components(texts):
    """Shingle counts and components of {id: text}, pair by pair over an inverted index."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, index = {}, defaultdict(list)
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        for s in sets[i]:
            index[s].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j, m in Counter(j for x in s for j in index[x] if j < i).items():
            if 100 * m >= 80 * (len(s) + len(sets[j]) - m):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_ngram_jaccard(spark, docs):
    got = {i: (r.n_shingles, r.component_id) for i, r in rows(spark, "op10_ngram_jaccard").items()}
    assert got == brute_components(dict(docs))
