"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns, for every operator and stage."""

import base64
import hashlib
import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from trendlens.llm import bpe, chat_format, common, exact_dedup, fingerprints, mixing, ngram_join, rolling, sharding, suffix_dedup, token_io, toxicity
from trendlens.llm.queries import vocabulary
from test_queries import brute_components

#: Columns beyond doc_id, text, source have names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, size string, key string, token string, n int, row string, _toxicity int"
LONG = " ".join(f"word{k % 9973}" for k in range(20_000))
BASE = " ".join(f"w{k}" for k in range(60))
TEXTS = [
    (1, None, None), (2, "", "a"), (3, " \n\t ", "a"), (4, "One two THREE", "b"), (5, "one two three", "b"), (6, BASE, "a"), (7, BASE.upper(), None),
    (8, BASE + " w60", "b"), (9, LONG, "é"), (10, LONG, "é"), (11, "É é Ä ä", "a"), (12, "é é ä ä", "a"), (12, "é é ä ä", "a"), (None, "nobody's text", "a"), (None, None, None),
    (13, "x" * 3000, "b"), (14, "tab\there and there  two \n\n", "b"),
]
CHAT = [(1, 0, "user", "a <turn x>\n</turn>\n & &lt; <image/>"), (1, 1, "assistant", "b\\"), (1, 1, "assistant", "b\\"), (2, None, None, None), (None, 3, "assistant", "")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, s, len(t or ""), "h", "s", "k", "t", 1, "r", 0) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def normal(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_mixing(docs, none):
    got = mixing.mix_report(docs).collect()
    sizes = sorted(len((t or "").replace(" ", "x").replace(" ", "x").split()) for _, t, _ in TEXTS)
    assert sorted(r["size"] for r in got) == sizes
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert {r.source for r in got} == {None, "a", "b", "é"}
    mixed = mixing.mix(docs)
    assert mixed.schema == docs.schema and mixed.count() == sum(r.copies for r in got)
    assert mixing.mix_report(none).count() == 0 and mixing.mix(none).count() == 0


def test_mix_thresholds_nest(docs):
    half = {r.doc_id for r in mixing.mix_report(docs, share=0.3).collect() if r.taken}
    most = {r.doc_id for r in mixing.mix_report(docs, share=0.9).collect() if r.taken}
    assert half <= most


def test_exact_dedup(docs, none):
    got = exact_dedup.exact_groups(docs).collect()
    groups = {}
    for i, t, _ in TEXTS:
        groups.setdefault(normal(t), []).append(i)
    want = []
    for t, ids in groups.items():
        keep = max([i for i in ids if i is not None], default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got)) == sorted(map(key, want))
    kept = exact_dedup.dedup(docs)
    assert kept.schema == docs.schema
    assert sorted(normal(r.text) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.dedup(none).count() == 0


def test_chat_format(spark):
    rows = spark.createDataFrame([(*r, "x", 1) for r in CHAT], "conv_id long, turn long, role string, text string, body string, n int")
    rows = rows.withColumn("parts", chat_format.text_parts(rows["text"]))
    out = chat_format.format_chats(rows)
    read = out.select("conv_id", chat_format.read_turns(out["formatted"]).alias("turns"), chat_format.read_loss(out["formatted"], out["loss_spans"]).alias("loss"))
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.loss) for r in read.collect()}
    text = CHAT[0][3].replace("<image/>", "<image/>")
    assert got[1] == ([("user", text), ("assistant", "b\\"), ("assistant", "b\\")], "b\\b\\")
    assert got[2] == ([("", "")], "") and got[None] == ([("assistant", "")], "")
    assert chat_format.format_chats(rows.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = "array(named_struct('type', 'text', 'text', 'see', 'ref', NULL, 'units', 0L), named_struct('type', 'image', 'text', NULL, 'ref', 'a.png', 'units', 2L), named_struct('type', 'audio', 'text', NULL, 'ref', 'b.wav', 'units', NULL))"
    rows = spark.sql(f"SELECT 1L AS conv_id, 0L AS turn, 'assistant' AS role, {parts} AS parts UNION ALL SELECT 1L, 1L, 'user', NULL")
    r = chat_format.format_chats(rows).first()
    assert r.formatted == "<turn assistant>\nsee<image/><audio/></turn>\n<turn user>\n</turn>\n"
    assert [tuple(a) for a in r.attachments] == [(1, "image", "a.png", 512), (1, "audio", "b.wav", 0)]
    assert r.n_tokens == 513 and [tuple(s) for s in r.loss_spans] == [(17, 19)]


def test_suffix_dedup(docs, none):
    got = suffix_dedup.cut_repeats(docs).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        if r.doc_id in (9, 10, 13):  # two copies; one byte repeated over itself
            assert (r.n_removed, bytes(r.kept)) == (r.n_bytes, b"")
        else:
            assert r.n_removed == 0 and r.spans == []
    assert suffix_dedup.cut_digests(none).count() == 0


def test_suffix_family():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 500, 3000).astype(np.uint64)
    family, at = suffix_dedup.Family(), 0
    for part in np.split(keys, [7, 8, 100, 1000, 1001]):
        family.add(part, at)
        at += len(part)
    values, counts = np.unique(keys, return_counts=True)
    assert (family.matched[: len(keys)] == np.isin(keys, values[counts > 1])).all()
    sizes = [len(a) for a, _ in family.levels]
    assert sizes == sorted(sizes, reverse=True)


def test_heavy_anchor_is_split(spark, monkeypatch):
    """An anchor with many classes goes through the split path and gives the same spans."""
    rng = np.random.default_rng(3)
    shared = "".join(map(chr, rng.integers(97, 123, 700)))
    texts = ["".join(map(chr, rng.integers(97, 123, 49 + k))) + str(k) + shared + str(k) + "".join(map(chr, rng.integers(97, 123, 60))) for k in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "HEAVY_SHARE", 10**9)
    split = {r.doc_id: r.spans for r in suffix_dedup.cut_repeats(df).collect()}
    assert split == {k: [[50 + k, 750 + k]] for k in range(8)}


def test_token_files(spark, docs, none, tmp_path):
    path = str(tmp_path / "tokens")
    token_io.write_tokens(docs, vocabulary("byte_bpe_50k.json"), 2, path)
    got = sorted(token_io.read_tokens(spark.read.parquet(path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([i for i, _, _ in TEXTS], key=lambda i: (i is not None, i))
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and np.frombuffer(r.ids, "<u4")[-1] == 2 for r in got)
    assert token_io.token_digests(none, vocabulary("byte_bpe_50k.json"), 2).count() == 0


def test_token_chunks_give_the_librarys_ids():
    """Chunk by chunk and many chunks to a string, odd texts get the ids of the library's plain call."""

    from tokenizers import Tokenizer

    rng, path = random.Random(8), vocabulary("byte_bpe_50k.json")
    parts = [" ", "  ", "\n", "<|endoftext|>", "<|endoftext", "the", "ing", "é", "日本", "123", "'s", ",", ".", "\t", "\u00a0", "Ab", "_", "́"]
    texts = ["<|endoftext|> hi", "a <|endoftext|>", *("".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000))]
    codes, plain = token_io.TokenCodes(Tokenizer.from_file(path)), Tokenizer.from_file(path)
    for k in range(0, len(texts), 500):
        for text, c in zip(texts[k : k + 500], codes.codes(texts[k : k + 500])):
            assert codes.ids(c).tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert 50256 in codes.ids(codes.codes(["<|endoftext|> hi"])[0]).tolist()


def test_token_block():
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, top, n).astype(np.uint32) for top, n in ((2, 5), (70_000, 70_000), (2**32, 9), (5, 0))]
    names, back = token_io.unpack(token_io.pack([3, None, -1, 4], ids))
    assert names == [3, None, -1, 4] and all((a == b).all() for a, b in zip(ids, back))
    assert token_io.unpack(token_io.pack([], [])) == ([], [])


def test_sharding(docs, none):
    got = sharding.place(docs, [1.0, 2.0, 0.5], [1.0, 2.0, 0.5, 1.0]).collect()
    assert len(got) == len(TEXTS)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 3) for r in got)
    assert sharding.place(none, [1.0], None).count() == 0
    with pytest.raises(ValueError):
        sharding.place(docs, [], None)


def test_shard_weights_and_moves(spark):
    ids = spark.range(20_000)
    old, new = sharding.rendezvous(ids["id"], [1.0, 3.0]), sharding.rendezvous(ids["id"], [1.0, 3.0, 1.0])
    pairs = ids.select(old.alias("a"), new.alias("b")).toPandas()
    assert abs((pairs.a == 1).mean() - 0.75) < 0.02 and abs((pairs.b == 2).mean() - 0.2) < 0.02
    assert ((pairs.a == pairs.b) | (pairs.b == 2)).all()


@pytest.fixture(scope="module")
def model():
    import pandas as pd

    rng = np.random.default_rng(5)
    words = [f"word{k}" for k in range(300)]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(300)]
    bad = [" ".join(np.insert(rng.choice(words, 40).astype(object), [5, 20, 21], ["vileword", "grimword", "vileword"])) for _ in range(60)]
    return toxicity.fit(pd.DataFrame({"text": texts + bad, "toxic": [0] * 300 + [1] * 60}))


def test_toxicity(spark, docs, none, model):
    scored = toxicity.with_scores(docs, model)
    assert scored.columns == [*docs.columns, "score"]
    assert all(0 <= r.score < 0.7 for r in scored.collect())
    text = "Fine word1 VILEWORD, word2 grimword vileword"
    r = toxicity.tag(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert r.score >= 0.7 and [text[s.start : s.end] for s in r.spans] == ["VILEWORD", "grimword", "vileword"]
    labels = spark.createDataFrame([(4, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    kept = toxicity.reject(docs, labels)
    assert kept.schema == docs.schema and kept.count() == len(TEXTS)
    assert toxicity.reject(none, labels).count() == 0


def test_marginals_equal_full_chain(model):
    """Runs of tokens without features as one matrix power give the marginals of a step for each token."""
    text = "a b c vileword d e grimword f"
    step, f, ahead = np.exp(model.trans), None, []
    emit = [np.array([1.0, np.exp(model.emission(w) + model.bias)]) for w in text.split()]
    for e in emit:
        f = e if f is None else (f @ step) * e
        f = f / f.sum()
        ahead.append(f)
    b, want = np.ones(2), {}
    for k in range(len(emit) - 1, -1, -1):
        p = ahead[k] * b
        want[k] = p[1] / p.sum()
        b = step @ (emit[k] * b)
        b = b / b.sum()
    got = model.marginals(text)
    assert [i for i, _ in got] == [3, 6] and np.allclose([p for _, p in got], [want[3], want[6]])


def test_marginals_of_very_long_runs(model):
    """A run is as many steps as it has tokens, beyond any table of powers."""
    step, want = np.exp(model.trans) * np.array([1.0, np.exp(model.bias)]), np.eye(2)
    for k in range(3000):
        assert k not in (0, 1, 255, 256, 257, 1000, 2999) or np.allclose(model.run(k) / model.run(k).sum(), want / want.sum())
        want = want @ step
        want = want / want.sum()


def test_spans_where_lower_case_is_longer(spark, model):
    """U+0130 lower-cases to two characters, one of which is no word character."""
    text = "İstanbul vileword word2 grimword İ İ VILEWORD"
    assert [text[s:e] for s, e, _ in model.spans(text)] == ["vileword", "grimword", "VILEWORD"]


def test_training_sample_has_one_text_an_id(spark):
    docs = spark.createDataFrame([(k % 50, f"text {k % 60}") for k in range(400)] + [(None, "x"), (60, None), (61, "y" * 30_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(70)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.training_rows(docs, labels).collect()
    learned = [k for k in range(50) if zlib.crc32(str(k).encode()) % 3 != 1]
    assert len({r.text for r in got}) == len(got) <= len(learned) and got


def test_bpe_pieces_contract_as_the_library_does():
    """Pieces with repeated, touching and nested pairs, with ranks below their parts', and very long ones."""
    import tiktoken

    path, rng = vocabulary("byte_bpe_50k.tiktoken"), random.Random(8)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", "a", "aaaa" * 9, " \n\n x", "abab" * 5_000, "a" * 20_001, "".join(rng.choice("etaoinsr") for _ in range(3_000))]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for letters in ("ab", "ingthera", "é日a😀", "abcdefghijklmnopqrstuvwxyz") for _ in range(300)]
    coder = bpe.Bpe(path, public_tokenizers.PATTERN)
    got = [r for part in coder.encode(texts) for r in part]
    assert [np.frombuffer(r, "<u4").tolist() for r in got] == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(got) == [t.encode() for t in texts]
    assert coder.con.execute("SELECT count(*) FROM duckdb_temporary_files()").fetchone()[0] == 0


def test_bpe_contracts_alike_however_the_rounds_are_cut(monkeypatch):
    """A vocabulary in which a merged pair makes a pair of lower rank, one round a query and many."""
    tokens = [bytes([b]) for b in range(256)] + [b"bcb", b"cb", b"aaa", b"aa", b"abc", b"bc", b"bcbc", b"ab", b"ca"]
    ranks = {t: r for r, t in enumerate(tokens)}

    def one_at_a_time(piece: bytes) -> list[int]:
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while pairs := [(ranks[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]:
            _, k = min(pairs)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [ranks[x] for x in parts]

    rng = random.Random(3)
    pieces = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 40))) for _ in range(1_500)})
    want = [[ranks[p]] if p in ranks else one_at_a_time(p) for p in pieces]
    with tempfile.NamedTemporaryFile("w", suffix=".tiktoken") as f:
        f.writelines(f"{base64.b64encode(t).decode()} {r}\n" for t, r in ranks.items())
        f.flush()
        for rounds in (1, 3, 48):
            monkeypatch.setattr(bpe, "ROUNDS", rounds)
            assert bpe.Bpe(f.name, ".+")._contract(pieces) == want


def test_byte_bpe(docs, none):
    args = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(docs, *args)
    back = sorted(r.text for r in bpe.decode(coded, *args).collect())
    assert back == sorted(t or "" for _, t, _ in TEXTS)
    assert sorted(r.decoded_sha256 for r in bpe.round_trip(docs, *args).collect()) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in TEXTS)
    assert bpe.round_trip(none, *args).count() == 0


def test_large_ids_beside_null(spark):
    """Ids that a double can't hold, in one batch with a null id."""
    rows = [(2**60 + 1, "one two three"), (None, "four"), (2**53 + 1, None), (-(2**62) - 1, "five six")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    args = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = sorted(str(i) for i, _ in rows)
    coded = bpe.encode(df, *args)
    for got in (coded, bpe.decode(coded.coalesce(1), *args), bpe.round_trip(df, *args), ngram_join.ngram_components(df)):
        assert sorted(str(r.doc_id) for r in got.collect()) == ids


def test_fingerprints(docs, none):
    got = fingerprints.compare_edits(docs, 4).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _, _ in TEXTS)
    by = {r.doc_id: r for r in got}
    assert by[9].fingerprint == by[10].fingerprint and by[9].near_next == 1.0
    assert fingerprints.compare_edits(none, 4).count() == 0
    one = fingerprints.compare_edits(docs.where("doc_id = 9"), 4).collect()
    assert one[0].edited_sha256 == hashlib.sha256((LONG[: len(LONG) - len(LONG) // 4] + LONG[: len(LONG) // 4]).encode()).hexdigest()
    assert fingerprints.parsed(by[9].fingerprint) == fingerprints.chunks(LONG.encode())


def test_insertion_moves_few_chunks():
    text = LONG.encode()
    a, b = fingerprints.chunks(text), fingerprints.chunks(text[:5000] + b"something new" + text[5000:])
    assert fingerprints.containment(a, b) > 0.99


def test_ngram_join(docs, none):
    got = ngram_join.ngram_components(docs).collect()
    want = brute_components({i: t for i, t, _ in TEXTS if i is not None})
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    kept = ngram_join.keep_one(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()} | {None}
    assert ngram_join.ngram_components(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    star = spark.range(1001, 1400).selectExpr("1000L AS a", "id AS b")
    got = {r.doc_id: r.component_id for r in ngram_join.components(chain.unionByName(star)).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{k: 1000 for k in range(1000, 1400)}}


def test_near_copy_group(spark):
    """A group of near copies, a chain that only links pairwise, and documents that share one passage."""
    words = [f"w{k}" for k in range(200)]
    near = [(k, " ".join(words[:k] + ["x"] + words[k + 1 :])) for k in range(60)]
    chain = [(100 + k, " ".join(f"c{j}" for j in range(8 * k, 8 * k + 120))) for k in range(12)]
    shared = [(200 + k, " ".join([f"d{k}_{j}" for j in range(60)] + words[:60])) for k in range(40)]
    rows = near + chain + shared
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df).collect()}
    assert got == brute_components(dict(rows))


@pytest.mark.parametrize("hot", [0, 8])
def test_hot_tokens(spark, monkeypatch, hot):
    """Tokens that many documents of different components hold: edited copies at, above and below the threshold, of several lengths."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rng = np.random.default_rng(5)
    rows = []
    for base in range(3):
        words = [f"b{base}_{k}" for k in range(40 + 50 * base)]
        for k in range(70):
            own = list(words)
            for at in rng.choice(len(own), rng.integers(0, 2 + 2 * base + k % 3), replace=False):
                own[at] = f"e{rng.integers(6)}"
            cut = rng.integers(0, 1 + len(own) // 6)
            rows.append((len(rows), " ".join(own[cut:] + [f"tail{k % 9}"] * int(rng.integers(0, 9)))))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_components(dict(rows))
    assert got == want and 3 < len({c for _, c in want.values()}) < len(rows)


def test_meetings_on_shared_tokens(spark):
    """Of documents that share a few tokens, only pairs that can share enough (10 of 100 here) become candidates."""
    rows = [(t, d) for t in range(5) for d in range(80)] + [(1000 + 20 * d + j, d + k) for d in range(0, 80, 20) for k in range(2) for j in range(6)]
    post = spark.createDataFrame([(t, d, 100, d) for t, d in rows], "token long, doc_id long, n long, part long")
    pairs = ngram_join.together(ngram_join.crossing(post))
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(d, d + 1) for d in range(0, 80, 20)]


def test_unskewed_join(spark):
    left = spark.createDataFrame([("hot", k) for k in range(50)] + [("cold", 1), ("gone", 2)], "key string, v int")
    right = spark.createDataFrame([("hot", 50, "x"), ("cold", 1, "y")], "key string, c int, w string")
    for total in (52, 10**9):
        assert common.unskewed_join(left, right, ["key"], "c", total).count() == 51
        assert common.unskewed_join(left, right, ["key"], "c", total, "left").where("w IS NULL").count() == 1


def test_rolling_spans():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    sums = rolling.prefix(data)
    a = rolling.spans(sums, np.array([0, 3, 6, 0]), np.array([3, 6, 9, 2]))
    assert a[0] == a[1] and len({int(x) for x in a}) == 3


def test_string_hashes():
    words = [b"", b"a", b"b", b"ab", b"abcdefgh", b"abcdefghi", b"abcdefgh" * 40, b"abcdefgh" * 39 + b"abcdefgi", b"a\0", b"a", b"abcdefgh" * 40]
    data = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    got = rolling.string_hashes(data, end - [len(w) for w in words], end).tolist()
    assert len(set(got)) == len(set(words)) and got[1] == got[9] and got[6] == got[10]


def test_polynomial_twins_are_not_linked(spark):
    """Thue-Morse words collide in every polynomial modulo a power of two; they share nothing."""
    morse = "".join("ab"[k.bit_count() & 1] for k in range(2048))
    rows = [(1, morse), (2, morse.translate(str.maketrans("ab", "ba"))), (3, morse)]
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, docs, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, "/root/testdata/sf0.001")
    rows = out.collect()
    ids, last = [r.doc_id for r in rows], corpus_pipeline.STAGES[-1][0]
    if name in ("toxicity", last):  # no text here is toxic; every row is encoded
        assert sorted(map(str, ids)) == sorted(str(i) for i, _, _ in TEXTS)
    if name == "exact dedup":
        assert sorted(normal(r.text) for r in rows) == sorted({normal(t) for _, t, _ in TEXTS})
    if name == "n-gram Jaccard join":
        assert set(ids) == {c for _, c in brute_components({i: t for i, t, _ in TEXTS if i is not None}).values()} | {None}
    if name == "mixing":
        assert set(ids) <= {i for i, _, _ in TEXTS} and len(rows) == sum(r.copies for r in mixing.mix_report(docs).collect())
    if name != last:
        assert out.columns == docs.columns and all(r.hash == "h" for r in rows)
    assert stage(spark, none, "/root/testdata/sf0.001").count() == 0


def test_suffixes_of_many_classes_at_once():
    """Fingerprints are those of each class alone, and equal for equal (anchor, offset, string)."""
    rng = np.random.default_rng(5)
    bodies = [bytes(rng.integers(97, 99, n, np.uint8)) for n in (400, 749, 400, 1, 620)]
    bodies.append(b"zz" + bodies[1])
    left, anchor = np.array([0, 349, 10, 0, 200, 351]), np.array([7, -3, 7, 0, 2**62, -3])
    n, place, key = suffix_dedup.suffixes(bodies, left, anchor)
    assert n.tolist() == [1, 350, 1, 0, 221, 352]
    at = np.cumsum(n) - n
    for k, body in enumerate(bodies):
        m, p, own = suffix_dedup.suffixes([body], left[k : k + 1], anchor[k : k + 1])
        assert m[0] == n[k] and (p == place[at[k] : at[k] + n[k]]).all() and (own == key[at[k] : at[k] + n[k]]).all()
    assert (key[at[5] + 2 : at[5] + 352] == key[at[1] : at[1] + 350]).all()
    assert len(np.unique(key)) == len(key) - 350


def test_narrowed_rows_stay_out_of_python(spark):
    from trendlens.llm import bounded

    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (2, "d")], "id long, text string")
    got = bounded.narrowed(df, "id", spark.createDataFrame([(2,), (None,)], "id long"))
    assert sorted(got.collect(), key=str) == sorted([(2, None), (None, "c"), (2, "d")], key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "MapInArrow" not in plan


def test_a_worker_keeps_one_operators_tables():
    made = []
    first = common.kept("a", lambda: made.append(1) or object())
    assert common.kept("a", lambda: made.append(2)) is first
    common.kept("b", object)
    assert common.kept("a", lambda: made.append(3)) is None and made == [1, 3]
    for _ in ngram_join.batches_of(iter(())):
        pass
    assert not common._KEPT


def test_ngram_near_copies_of_one_text(spark, monkeypatch):
    """Near copies are linked through the most typical of them, though the smallest ids have many edits; the join then has few pairs left."""
    rng, base, asked = random.Random(5), [f"w{k}" for k in range(120)], []
    edited = lambda n: {at: f"x{rng.random()}" for at in rng.sample(range(120), n)}
    rows = [(i, " ".join(e.get(k, w) for k, w in enumerate(base))) for i in range(240) for e in [edited(6 if i < 20 else 1)]]
    linked = ngram_join.linked
    monkeypatch.setattr(ngram_join, "linked", lambda pairs, *rest: asked.append(pairs.count()) or linked(pairs, *rest))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(dict(rows))
    assert len(asked) == 2 and asked[1] < 240  # all pairs: 28,680


def test_ngram_rare_tokens_come_first():
    """Tokens of one document come before those of five, also where a coarse bucket holds several tokens."""
    rng = np.random.default_rng(5)
    once, shared = rng.integers(0, 1 << 64, 1 << 21, np.uint64), rng.integers(0, 1 << 64, 1000, np.uint64)
    parts = [once, *[shared] * 5]
    coarse = np.bincount((np.concatenate(parts) >> np.uint64(44)).astype(np.int64), minlength=1 << ngram_join.FREQUENCY_BITS)
    fine = ngram_join.fine_counts(parts[0])
    for more in parts[1:]:
        fine = ngram_join.add_nibbles(fine, ngram_join.fine_counts(more))
    assert (ngram_join.ranked(once, (coarse, fine), 0) < ngram_join.ranked(shared, (coarse, fine), 0).min()).mean() > 0.99
    often = np.full(300, shared[0])
    assert ngram_join.add_nibbles(fine, ngram_join.fine_counts(often)).max() >> 4 <= 15
    assert (ngram_join.ranked(shared[:1], (coarse + 300, ngram_join.fine_counts(often)), 0) >> np.uint64(56))[0] == np.floor(2 * np.log2(coarse[int(shared[0] >> np.uint64(44))] + 300))


def test_near_copies_that_link_with_none_meet_few(spark, monkeypatch):
    """Edited copies that are near no other share most of a large group's tokens; their short sketches keep them from meeting all of it."""
    rng, base, met = random.Random(7), [f"w{k}" for k in range(240)], []
    edited = lambda spots: {at: f"x{rng.random()}" for at in spots}
    spots = [rng.sample(range(5, 235, 6), 2) for _ in range(150)] + [rng.sample(range(5, 235, 6), 5) for _ in range(50)]
    rows = [(i, " ".join(e.get(k, w) for k, w in enumerate(base))) for i, own in enumerate(spots) for e in [edited(own)]]
    stored = ngram_join.stored
    count = lambda df, name: met.append(df.count()) if name == "ngram-candidates" else None
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: count(df, name) or stored(df, name))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(dict(rows))
    assert len(met) == 1 and met[0] < 1500  # of the 7,500 between the group and the others


def test_copies_leave_the_join_to_one(spark, monkeypatch):
    """Of equal sets, in whatever partitions, only the least id's prefix meets others; an id that has several texts keeps its own."""
    base = [f"w{k}" for k in range(100)]
    texts = [" ".join(base), " ".join(base[:60] + ["x"] + base[61:])]
    rows = [(10 * k + i, t) for k in range(20) for i, t in enumerate(texts)] + [(5, "a b c d e f"), (1, "a b c d e f"), (0, "g h i j k l")]
    posts, crossing = [], ngram_join.crossing
    monkeypatch.setattr(ngram_join, "crossing", lambda post: posts.append({r.doc_id for r in post.select("doc_id").distinct().collect()}) or crossing(post))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.ngram_components(df).collect()}
    assert {c for (_, n), c in got.items() if n == 96} == {0} and got[5, 2] == got[1, 2] == 0  # 1 has both texts
    assert posts and posts[0] <= {0, 1}
