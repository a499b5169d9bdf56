"""Toxicity by a linear-chain conditional random field over tokens.

Learning is bounded: at most MAX_TOXIC and MAX_CLEAN labelled texts of at most
MAX_CHARS characters, those of the least id hash. The ids are picked from narrow
rows, so that only these texts move; they are tokenised and counted on the
executors, and the driver gets the chosen features, windows of feature sets and
one row of sums a text. Their documents' labels give
weak token labels: in toxic documents a token is toxic when one of its features
(the word, its prefixes) is significantly more frequent in toxic documents.
The field has two states, emissions from those features and a transition
matrix, fitted by gradient ascent on the conditional likelihood. A logistic
model over sums of forward-backward marginals, fitted to the document labels,
gives the document score.

Scoring reads whole texts and nothing but the text. Tokens without a known
feature share one matrix, so a run of them is one matrix power: marginals are
exact without a step for each, however long the run. Spans are the tokens with marginal >= 0.5.

Defined cases: null text is empty and scores like any text without a hit; null
ids and labels are never learned from; repeated rows score equally; without
labels of both kinds every score is 0; of rows that share a doc_id one text is
learned from; very long texts are scored whole; an empty table gives an empty result;
extra columns are kept by ``with_scores`` and otherwise not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import let_go, ship, stored

MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 2500, 5000, 20_000  # the sample that the model is fitted on
MAX_FEATURES = 20_000
PREFIXES = range(3, 9)
WINDOW = 32  # tokens of a training sequence
ROUNDS = 60
REJECT = 0.7
WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded sample (text, toxic), each text once; held-out documents are never in it."""
    named = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    named = named.where(~held_out(F.col("doc_id")))
    fit_for = docs.where(F.length("text").between(1, MAX_CHARS))
    ids = fit_for.select("doc_id").join(named, "doc_id").distinct()
    parts = [ids.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    chosen = stored(parts[0].unionByName(parts[1]), "toxic-ids")  # at most MAX_TOXIC + MAX_CLEAN ids
    rows = fit_for.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t"))
    return one.groupBy("t.text").agg(F.max("toxic").alias("toxic"))


def features(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in PREFIXES if k < len(word))]


class Model:
    """Weights of the field and of the document score."""

    def __init__(self, weights: dict[str, float], trans: np.ndarray, bias: float):
        self.weights, self.trans, self.bias = weights, trans, bias
        self.score = np.zeros(0)
        a = np.exp(trans) * np.array([1.0, np.exp(bias)])  # a step to a token without features
        self.power = [np.eye(2)]
        for _ in range(255):
            self.power.append(_scaled(self.power[-1] @ a))
        self.squares = [_scaled(self.power[255] @ a)]  # of 256, 512, 1024 ... steps
        for _ in range(55):
            self.squares.append(_scaled(self.squares[-1] @ self.squares[-1]))
        self.known: dict[str, float] = {}

    def run(self, n: int) -> np.ndarray:
        """The matrix of ``n`` tokens without features, up to a factor."""
        out, n, k = self.power[n & 255], n >> 8, 0
        while n:
            if n & 1:
                out = _scaled(out @ self.squares[k])
            n, k = n >> 1, k + 1
        return out

    def emission(self, word: str) -> float:
        """The log weight of the toxic state at a word, over the bias; 0 without a known feature."""
        e = self.known.get(word)
        if e is None:
            if len(self.known) > 400_000:
                self.known = {}
            e = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(word.lower()))
        return e

    def marginals(self, text: str) -> list[tuple[int, float]]:
        """(token number, marginal of the toxic state) of every token with a known feature."""
        return self._marginals(WORD.findall(text))

    def _marginals(self, words: list[str]) -> list[tuple[int, float]]:
        hits = [(i, e) for i, e in enumerate(map(self.emission, words)) if e]
        if not hits:
            return []
        step = np.exp(self.trans)
        at = [i for i, _ in hits]
        emit = [np.array([1.0, np.exp(min(e + self.bias, 50.0))]) for _, e in hits]
        ahead, f = [], np.ones(2)
        before = -1
        for i, e in zip(at, emit):
            f = f @ self.run(i - before - 1)
            f = ((f @ step) if i else f) * e
            f /= f.sum()
            ahead.append(f)
            before = i
        back, b, after = [], np.ones(2), len(words)
        for i, e in zip(reversed(at), reversed(emit)):
            b = self.run(after - i - 1) @ b
            b /= b.sum()
            back.append(b)
            b = step @ (e * b)
            after = i
        out = []
        for i, f, b in zip(at, ahead, reversed(back)):
            p = f * b
            out.append((i, float(p[1] / p.sum())))
        return out

    def summary(self, text: str) -> np.ndarray:
        words = WORD.findall(text)
        p = np.array([m for _, m in self._marginals(words)])
        n = max(1, len(words))
        top = np.sort(p)[::-1][:3]
        return np.array([1.0, np.log1p(p.sum()), min(1.0, 20 * p.sum() / n), *np.pad(top, (0, 3 - len(top)))])

    def document(self, text: str) -> float:
        if not len(self.score):
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.summary(text) @ self.score, -40, 40))))

    def spans(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, marginal) in code points of every offending token."""
        hot = {i: p for i, p in self.marginals(text) if p >= 0.5}
        return [(m.start(), m.end(), hot[i]) for i, m in enumerate(WORD.finditer(text)) if i in hot] if hot else []


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum()


def feature_counts(texts: list[str], toxic: list[int]) -> pd.DataFrame:
    """(feature, toxic, clean): in how many texts of either kind a feature is."""
    counts = [Counter(), Counter()]
    for text, y in zip(texts, toxic):
        counts[int(y)].update({f for w in {w.lower() for w in WORD.findall(text)} for f in features(w)})
    names = list(counts[0] | counts[1])
    return pd.DataFrame({"feature": names, "toxic": [counts[1][f] for f in names], "clean": [counts[0][f] for f in names]})


def windows(texts: list[str], toxic: list[int], chosen: set[str]) -> pd.DataFrame:
    """(tokens, toxic): of every window with a chosen feature, and of a text's first, each token's features as a number in ``kinds``."""
    kind_of: dict[str, str] = {}
    rows = []
    for text, y in zip(texts, toxic):
        words = [w.lower() for w in WORD.findall(text)]
        for w in words:
            if w not in kind_of:
                kind_of[w] = " ".join(f for f in features(w) if f in chosen)
        kinds = [kind_of[w] for w in words]
        for k in range(0, len(kinds), WINDOW):
            part = kinds[k : k + WINDOW]
            if k == 0 or any(part):
                rows.append((part, int(y)))
    return pd.DataFrame(rows, columns=["tokens", "toxic"])


def significant(counts: DataFrame | pd.DataFrame, n_clean: int, n_toxic: int) -> pd.DataFrame:
    """(feature, odds) of the features that are significantly more frequent in toxic texts, at most MAX_FEATURES."""
    least = max(3, round(0.01 * n_toxic))
    odds = f"ln((toxic + 0.5D) / {n_toxic + 1}) - ln((clean + 0.5D) / {n_clean + 1})"
    if isinstance(counts, DataFrame):
        found = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= least)
        found = found.selectExpr("feature", f"{odds} AS odds", "sqrt(1 / (toxic + 0.5D) + 1 / (clean + 0.5D)) AS error")
        return found.where("odds >= 1.5 AND odds / error >= 3").orderBy(F.col("odds").desc(), "feature").limit(MAX_FEATURES).select("feature", "odds").toPandas()
    t, c = counts["toxic"] + 0.5, counts["clean"] + 0.5
    found = counts.assign(odds=np.log(t / (n_toxic + 1)) - np.log(c / (n_clean + 1)), error=np.sqrt(1 / t + 1 / c))
    found = found[(found["toxic"] >= least) & (found["odds"] >= 1.5) & (found["odds"] / found["error"] >= 3)]
    return found.sort_values(["odds", "feature"], ascending=[False, True])[["feature", "odds"]].head(MAX_FEATURES)


def _field(chosen: pd.DataFrame, parts: pd.DataFrame) -> Model:
    """The field fitted to windows (tokens, toxic)."""
    names = {f: k for k, f in enumerate(chosen["feature"])}
    odds = chosen["odds"].to_numpy(np.float64)
    parts = sorted((y, tuple(t)) for t, y in zip(parts["tokens"], parts["toxic"]))  # the order of rows decides no rounding
    kinds = {"": 0}  # a token is the set of its known features
    x = np.full((len(parts), WINDOW), -1, np.int32)
    for k, (_, tokens) in enumerate(parts):
        x[k, : len(tokens)] = [kinds.setdefault(t, len(kinds)) for t in tokens]
    sets = [[names[f] for f in fs.split(" ")] if fs else [] for fs in kinds]
    best = np.array([max((odds[f] for f in fs), default=0.0) for fs in sets])
    gold = ((best[x] >= 2.0) & (x >= 0) & (np.array([y for y, _ in parts])[:, None] == 1)).astype(np.int64)
    kind, feature = (np.array(c, np.int64) for c in zip(*[(k, f) for k, fs in enumerate(sets) for f in fs]))
    weights, trans, bias = _ascend(x, gold, kind, feature, len(kinds), len(names))
    return Model({f: float(weights[k]) for f, k in names.items()}, trans, bias)


def fit(sample: pd.DataFrame) -> Model:
    """Fit the field and the document score to a local sample (text, toxic)."""
    texts, toxic = sample["text"].tolist(), sample["toxic"].to_numpy(np.int64)
    none = Model({}, np.zeros((2, 2)), 0.0)
    if not (toxic == 1).any() or not (toxic == 0).any():
        return none
    chosen = significant(feature_counts(texts, toxic), int((toxic == 0).sum()), int((toxic == 1).sum()))
    if not len(chosen):
        return none
    model = _field(chosen, windows(texts, toxic, set(chosen["feature"])))
    model.score = _logistic(np.array([model.summary(t) for t in texts]), toxic)
    return model


def _ascend(x: np.ndarray, gold: np.ndarray, kind: np.ndarray, feature: np.ndarray, n_kinds: int, n_features: int):
    """Adam on the penalised conditional log-likelihood of the windows."""
    real = x >= 0
    size = 1 + n_features + 4
    theta, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    count = real.sum()
    seen = np.zeros(4)
    both = real[:, 1:] & real[:, :-1]
    np.add.at(seen, (2 * gold[:, :-1] + gold[:, 1:])[both], 1)
    labelled = np.bincount(x[real], weights=gold[real], minlength=n_kinds)
    for step in range(1, ROUNDS + 1):
        weights, trans, bias = theta[1 : 1 + n_features], theta[-4:].reshape(2, 2), theta[0]
        level = np.bincount(kind, weights=weights[feature], minlength=n_kinds) + bias
        e = np.ones((*x.shape, 2))
        e[..., 1] = np.exp(np.clip(level, -30, 30))[x]
        t = np.exp(trans)
        f, b = np.ones_like(e), np.ones_like(e)
        f[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for k in range(1, x.shape[1]):
            own = (f[:, k - 1] @ t) * e[:, k]
            f[:, k] = np.where(real[:, k, None], own / own.sum(1, keepdims=True), f[:, k - 1])
        for k in range(x.shape[1] - 2, -1, -1):
            own = (e[:, k + 1] * b[:, k + 1]) @ t.T
            b[:, k] = np.where(real[:, k + 1, None], own / own.sum(1, keepdims=True), 1.0)
        p = f * b
        p /= p.sum(2, keepdims=True)
        expected = np.bincount(x[real], weights=p[..., 1][real], minlength=n_kinds)
        joint = f[:, :-1, :, None] * t * (e[:, 1:] * b[:, 1:])[:, :, None, :]
        joint /= joint.sum((2, 3), keepdims=True)
        gap = labelled - expected
        grad = np.concatenate([[gap.sum()], np.bincount(feature, weights=gap[kind], minlength=n_features), seen - joint[both].sum(0).ravel()])
        grad = grad / count * 100 - 1e-3 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[1 : 1 + n_features], theta[-4:].reshape(2, 2), float(theta[0])


def _logistic(table: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small penalty."""
    w = np.zeros(table.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(table @ w, -30, 30)))
        h = (table * (p * (1 - p) + 1e-6)[:, None]).T @ table + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(h, table.T @ (y - p) - 0.05 * w)
    return w


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the bounded sample: texts are read on the executors only."""
    spark = docs.sparkSession
    ship(spark)
    sample = stored(training_rows(docs, labels), "toxic-sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = Model({}, np.zeros((2, 2)), 0.0)
    if not n.get(0) or not n.get(1):
        return none

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield feature_counts(b["text"].tolist(), b["toxic"].tolist())

    chosen = significant(sample.mapInPandas(counted, "feature string, toxic long, clean long"), n[0], n[1])
    if not len(chosen):
        return none
    known = set(chosen["feature"])  # at most MAX_FEATURES

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield windows(b["text"].tolist(), b["toxic"].tolist(), known)

    model = _field(chosen, sample.mapInPandas(cut, "tokens array<string>, toxic int").toPandas())

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"sums": [model.summary(t).tolist() for t in b["text"]], "toxic": b["toxic"]})

    rows = sorted((*r["sums"], r["toxic"]) for r in sample.mapInPandas(summed, "sums array<double>, toxic int").collect())
    table = np.array(rows)
    model.score = _logistic(table[:, :-1], table[:, -1].astype(np.int64))
    return model


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score column (0 to 1) of its text."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)  # at most MAX_FEATURES weights

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        for texts in batches:
            yield pd.Series([held.value.document(t or "") for t in texts], dtype="float64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(name, F.pandas_udf(run, "double")(F.col("text")))


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, spans): the document score and its offending tokens, start and end in code points."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t or "" for t in b["text"]]
            spans = [[{"start": s, "end": e, "marginal": p} for s, e, p in held.value.spans(t)] for t in texts]
            yield pd.DataFrame({"doc_id": b["doc_id"].values, "score": [held.value.document(t) for t in texts], "spans": spans})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, score double, spans array<struct<start: int, end: int, marginal: double>>")


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below REJECT, with their columns."""
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return with_scores(docs, train(docs, labels), name).where(F.col(name) < REJECT).drop(name)
