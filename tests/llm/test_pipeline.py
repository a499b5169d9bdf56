"""The corpus pipeline against a plain-Python version of its stages."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from conftest import SF001
from test_queries import brute_components
from trendlens.llm import toxicity


def mixed(rows, seed="mix"):
    """(doc_id, text) of {doc_id: (text, source)} with repeats, by source weights 5, 2, 1 and limit 3."""
    size = {i: len((t or "").split()) for i, (t, _) in rows.items()}
    total = defaultdict(int)
    for i, (_, s) in rows.items():
        total[s] += size[i]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), sum(total.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * total[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= 3 * total[s]
            free.discard(s)
    out = []
    for s in order:
        own = sorted((int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:15], 16), i) for i, (_, x) in rows.items() if x == s)
        base = int(target[s] // total[s]) if total[s] else 0
        budget, before = target[s] - base * total[s], 0
        for _, i in own:
            copies = base + (2 * (budget - before) > size[i])
            before += size[i]
            out += [(i, rows[i][0])] * copies if size[i] else []
    return out


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    rows = {i: (t, s) for i, t, s in duckdb.sql(f"SELECT doc_id, text, source FROM '{SF001}/documents.parquet'").fetchall()}
    rows = {i: r for i, r in rows.items() if model.document(r[0] or "") < 0.7}
    last = {}
    for i in sorted(rows):
        last["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rows[i][0] or "")] = i
    rows = {i: rows[i] for i in last.values()}
    parts = brute_components({i: t for i, (t, _) in rows.items()})
    rows = {i: r for i, r in rows.items() if parts[i][1] == i}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t in mixed(rows):
        ids = np.array(encoding.encode_ordinary(t), "<u4").tobytes()
        want[(i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] += 1
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF001).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == want


def test_entry_without_the_subpackage():
    """The guard of the entry module: without the subpackage the other queries are there."""
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "import importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'trendlens.llm' or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "del sys.modules['corpus_pipeline']; sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and 'mg_hot_topics' in e.queries()\n"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=__file__.rsplit("/tests/", 1)[0]).returncode == 0
    assert zlib.crc32(b"") == 0
