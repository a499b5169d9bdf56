"""Spelling variants, token alignment and line dedup against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest

from conftest import SF001
from test_edge_cases import LONG, SCHEMA, TEXTS, normal
from trendlens.llm import line_dedup, queries, spelling, token_align

WORDS = re.compile("[A-Za-zÀ-ÿ]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, s, len(t or ""), "h", "s", "k", "t", 1, "r", 0) for i, t, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF001}/documents.parquet'").fetchall()


# -- spelling -------------------------------------------------------------------------


def is_near(a, b):
    """One inserted, deleted or replaced letter."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    cuts = {b[:k] + b[k + 1 :] for k in range(len(b))}
    return a in cuts if len(a) < len(b) else any(a[:k] + a[k + 1 :] == b[:k] + b[k + 1 :] for k in range(len(a)))


def brute_words(rows, min_length=6, min_count=5):
    counts = Counter()
    for i, t, *_ in rows:
        for run in WORDS.findall(normal(t)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count and len(w) >= min_length}


def brute_groups(words):
    cuts = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            cuts[w[:k] + w[k + 1 :]].add(w)
        cuts[w].add(w)
    near = {w: {x for k in range(len(w)) for x in cuts[w[:k] + w[k + 1 :]] if is_near(w, x)} | {x for x in cuts[w] if is_near(w, x)} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


def groups(got):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()}


def test_spelling_equals_brute_force(spark, documents):
    assert groups(queries.op11_spelling_variants(spark, SF001)) == brute_groups(brute_words(documents))


@pytest.mark.parametrize("letters", [3, 40, 100_000])
def test_large_blocks_are_split(spark, letters):
    """Words that differ in few places, in blocks split down to one letter, give the same near words."""
    rng = random.Random(letters)
    words = {"".join(rng.choice("abà") for _ in range(rng.choice((5, 6, 7)))): rng.randrange(5, 500) for _ in range(700)}
    got = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long"), 5, letters)
    want = {}
    for w in words:
        near = [x for x in words if is_near(w, x)]
        if near:
            best = min(near, key=lambda x: (-words[x], x))
            want[w] = (len(near), words[best], best)
    assert {r.word: (r.n_near, r.best_n, r.best) for r in got.collect()} == want


def test_roots_follow_forms_to_the_end(spark):
    chain = [(f"w{k:03}", f"w{k + 1:03}") for k in range(20)] + [("x", "w005")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {**{f"w{k:03}": "w020" for k in range(20)}, "x": "w020"}


def test_spelling_edge_cases(spark):
    rows = [*TEXTS, *[(20 + k, "Vordering vordering, Vorderinge vorderung " + "z" * 5000 + " " + "z" * 4999, "a") for k in range(6)], *[(30, "vordering " * 30, "b")] * 2]
    assert groups(spelling.spelling_groups(frame(spark, rows))) == brute_groups(brute_words(rows))
    assert spelling.spelling_groups(frame(spark, rows).limit(0)).count() == 0


# -- alignment ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute_alignment(rows, a, b):
    """Whole texts tokenised and aligned one by one."""
    alphabet = token_align.byte_alphabet()
    found, counts = [], Counter()
    for _, text, *_ in rows:
        found.append(None)
        if not text:
            continue
        body = (" " + text).encode()
        x = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, token_align.piece_bytes(b.id_to_piece(i))) for i in b.encode(text)]
        if not b"".join(t for _, t in x) == body == b"".join(t for _, t in y):
            continue
        ends = []
        for tokens in (x, y):
            at, ends_of = 0, {}
            for k, (_, t) in enumerate(tokens):
                at += len(t)
                ends_of[at] = k
            ends.append(ends_of)
        common, p, q, parts, links = sorted(ends[0].keys() & ends[1].keys()), 0, 0, [], []
        for e in common:
            u, v = ends[0][e] + 1, ends[1][e] + 1
            parts.append(",".join(str(i) for i, _ in x[p:u]) + "|" + ",".join(str(i) for i, _ in y[q:v]))
            links.append((x[u - 1][0], y[v - 1][0]))
            p, q = u, v
        found[-1] = (len(x), len(y), ";".join(parts), links)
        counts.update(links)
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = Counter()
    for (i, *_), f in zip(rows, found):
        if f is None:
            out[(i, 0, 0, 0, 0, 0, 0, "")] += 1
        else:
            n_a, n_b, text, links = f
            best = sum(counts[x] == most[x[1]] for x in links)
            out[(i, n_a, n_b, len(links), len(links), best, sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_brute_force(spark, documents, tokenizers):
    got = queries.op12_token_alignment(spark, SF001)
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == brute_alignment(documents, *tokenizers)


ODD = [
    "<|endoftext|> hi <s>there</s>", " two  spaces   three ", "\n\nline\n next \n", "tab\tand\r\nreturn", "é ﬁ ½ 日本 語", "a ▁ b", "nbsp here", "emoji 👩‍👩‍👧 end", "\x00null", "   ", "\n", "word",
    "word", "é combining", "x" * 3000, "can't won't 12345 a1b2 ...!?", "  separator", "mixed　 wide", "ends with space ", "ends with newline\n", " .\n , \n\n ;", LONG,
]


def test_alignment_edge_cases(spark, tokenizers, monkeypatch):
    paths = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")
    rows = [*TEXTS, *[(100 + k, t, "a") for k, t in enumerate(ODD)]]
    got = token_align.alignments(frame(spark, rows), *paths)
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == brute_alignment(rows, *tokenizers)
    assert token_align.alignments(frame(spark, rows).limit(0), *paths).count() == 0


def test_chunks_keep_tokens(tokenizers):
    """Chunk by chunk, random texts get the tokens of the whole text."""
    rng, both = random.Random(4), token_align.aligner(queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model"))
    assert both.cuts
    parts = [" ", "  ", "\n", "the", "ing", "é", "日", "1", "23", "'s", ",", ".", "<s>", "(", "\t", "Ab", "_", "-"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        want = brute_alignment([(0, text)], *tokenizers).popitem()[0]
        (codes,) = both.codes([text])
        if codes is None:
            assert want[1] == 0
        else:
            n_a, n_b, _ = both.sizes[codes].sum(0)
            assert (n_a, n_b, hashlib.sha256(";".join([both.groups[k] for k in codes]).encode()).hexdigest()) == (want[1], want[2], want[-1]), text


def test_link_counts(spark, documents):
    blocks = token_align.align_texts(frame(spark, documents), queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model"))
    got = queries.op12_token_alignment(spark, SF001).agg({"n_links": "sum"}).first()[0]
    assert token_align.link_counts(blocks).agg({"count": "sum"}).first()[0] == got


# -- lines ----------------------------------------------------------------------------


def brute_lines(rows, min_chars=20, min_docs=3):
    space = " \t\n\x0b\x0c\r"
    rank = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    split = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    key = lambda line: normal(line.strip(space))
    for i, lines in split:
        for line in lines:
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    keep = {k: max(ids, key=rank) for k, ids in holders.items() if len(ids) >= min_docs}
    out = Counter()
    for i, lines in split:
        left = [x for x in lines if key(x) not in keep or keep[key(x)] == i]
        out[(i, len(lines), len(lines) - len(left), "\n".join(left))] += 1
    return out


LINE = "This very line is in MANY of the documents"
LINES = [
    *TEXTS, (40, f"{LINE}\n\nown one\n\t{LINE.lower()} \r", "a"), (41, f"x\n{LINE}", "a"), (42, f"{LINE}\n{LINE}\ny", "b"), (42, f"{LINE}\nanother text of the same id", "b"), (42, f"{LINE}\n{LINE}\ny", "b"),
    (None, f"{LINE}\nnobody's", "a"), (43, "é" * 19 + "\n" + "é" * 20, "a"), (44, "é" * 20 + "\n" + "É" * 20, "a"), (45, "é" * 20 + "\n" + "é" * 19, "a"), (46, "\n".join([LONG[:4000]] * 300), "a"),
    (47, LONG[:4000], "a"), (48, LONG[:4000].upper() + "\nz", None), (49, "\n\n", "a"), (50, LINE[:19] + "\n" + LINE, "a"),
]


def test_lines_equal_brute_force(spark):
    got = line_dedup.line_report(frame(spark, LINES))
    assert Counter(tuple(r) for r in got.collect()) == brute_lines(LINES)
    assert line_dedup.line_report(frame(spark, LINES).limit(0)).count() == 0


def test_drop_lines_keeps_columns(spark):
    docs = frame(spark, LINES)
    got = line_dedup.drop_lines(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter({(i, t): n for (i, _, _, t), n in brute_lines(LINES).items()})
    assert {r.hash for r in got.collect()} == {"h"}


def test_line_thresholds(spark):
    got = line_dedup.line_report(frame(spark, LINES), 5, 2)
    assert Counter(tuple(r) for r in got.collect()) == brute_lines(LINES, 5, 2)
