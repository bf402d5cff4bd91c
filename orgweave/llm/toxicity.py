"""Toxicity classifier with a counterfactual penalty on identity terms.

Features are the distinct words of a text and their leading bytes, so that inflected
forms share evidence. A logistic regression over them is fitted with an extra penalty:
every labelled text with an identity term gets counterfactual copies, in which the term is
replaced by the others of its group (and by nothing) and the features are made anew; the
squared change of the logit from the text to each copy is added to the loss. Group
mentions thus can't carry a score by themselves, whatever the labels correlate with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, table, unused, written
from .tokens import ALNUM, pieces, text_list, words

#: Neutral identity terms by group, in four languages.
IDENTITY = {
    "gender": "women men woman man girls boys frauen männer femmes hommes mujeres hombres transgender",
    "religion": "muslims christians jews hindus buddhists atheists muslim christian jewish hindu muslime christen juden musulmans chrétiens juifs musulmanes cristianos judíos",
    "origin": "immigrants refugees africans asians europeans americans mexicans turks poles black white asian latino einwanderer flüchtlinge immigrés réfugiés inmigrantes refugiados",
    "orientation": "gay lesbian bisexual queer straight heterosexual homosexual schwul lesbisch homosexuel homosexuales",
    "age_ability": "elderly disabled blind deaf old young behinderte handicapés discapacitados",
}

#: Leading bytes that are features besides whole words.
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Settings:
    """max_train: labelled rows that a fit uses at most, those with the least id hashes.
    max_features: features kept, by chi-square against the label. least: rows that a
    feature must occur in. swap: weight of the counterfactual penalty. max_swaps: different
    changes of the kept features that the penalty has at most, those of most copies. ridge:
    weight of the squared weights, a labelled row."""

    max_train: int = 6000
    max_features: int = 1024
    least: int = 5
    chi_square: float = 20.0
    swap: float = 10.0
    max_swaps: int = 50_000
    ridge: float = 2e-4
    steps: int = 600


def features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(doc, feature): hashes of words and of their leading bytes, not yet distinct."""
    b = words(texts, ALNUM)
    doc, feat = [b.doc], [b.hashes()]
    for k in PREFIXES:
        at = np.flatnonzero(b.end - b.start >= k)
        doc.append(b.doc[at])
        feat.append(b.hashes(b.start[at], b.start[at] + k) + np.uint64(k))
    return np.concatenate(doc), np.concatenate(feat)


def _features_of(texts: list) -> list[np.ndarray]:
    """Distinct features of each text."""
    out: list[np.ndarray] = []
    for _, part in pieces(texts):
        doc, feat = features(part)
        order = np.lexsort((feat, doc))
        doc, feat = doc[order], feat[order]
        first = np.concatenate(([True], (feat[1:] != feat[:-1]) | (doc[1:] != doc[:-1]))) if len(doc) else np.empty(0, bool)
        doc, feat = doc[first], feat[first]
        out += np.split(feat, np.searchsorted(doc, np.arange(1, len(part))))
    return out


@dataclass
class Model:
    feature: np.ndarray  # sorted hashes
    weight: np.ndarray
    bias: float

    def logits(self, texts: list) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for at, part in pieces(texts):
            if not len(self.feature):
                continue
            doc, feat = features(part)
            k = np.minimum(np.searchsorted(self.feature, feat), len(self.feature) - 1)
            hit = np.flatnonzero(self.feature[k] == feat)
            met = np.unique(doc[hit] * len(self.feature) + k[hit])
            out[at : at + len(part)] += np.bincount(met // len(self.feature), self.weight[met % len(self.feature)], len(part))
        return out

    def scores(self, texts: list) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def counterfactuals(text: str, identity: dict[str, str]) -> list[str]:
    """Copies of a text, each with all occurrences of one of its identity terms replaced by
    another term of the group, or by nothing."""
    out = []
    for group in identity.values():
        terms = group.split()
        whole = re.compile(rf"(?i)(?<!\w)(?:{'|'.join(map(re.escape, terms))})(?!\w)")
        for term in sorted({m.lower() for m in whole.findall(text)}):
            own = re.compile(rf"(?i)(?<!\w){re.escape(term)}(?!\w)")
            out += [own.sub(x, text) for x in (*terms, "") if x != term]
    return out


def _changes(text: str, own: np.ndarray, identity: dict[str, str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features lost, features won) of each counterfactual copy."""
    copies = counterfactuals(text, identity) if text else []
    return [(np.setdiff1d(own, x), np.setdiff1d(x, own)) for x in _features_of(copies)]


def _penalty(minus: list, plus: list, times: np.ndarray, features: int) -> np.ndarray:
    """The matrix whose quadratic form of the weights is the weighted sum of squared changes."""
    out = np.zeros((features, features))
    for i in range(0, len(times), 2000):
        d = np.zeros((len(times[i : i + 2000]), features))
        for k, (a, b) in enumerate(zip(minus[i : i + 2000], plus[i : i + 2000])):
            d[k, a] -= 1
            d[k, b] += 1
        out += d.T @ (times[i : i + 2000, None] * d)
    return out


def _fit(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent with Nesterov momentum; every row weighs the same.

    Each weight has its own step: the row sums of the loss's curvature, whose entries are
    bounded by those of |x|'|x| / 4 and of the penalty, hold it from above.
    """
    n, f = x.shape
    x = np.hstack([x, np.ones((n, 1))])
    cost = np.pad(penalty * (s.swap / n), (0, 1))
    ridge = np.append(np.full(f, s.ridge), 0.0)
    bound = x.T @ x.sum(1) / (4 * n) + ridge + np.abs(cost).sum(1)
    w, held = np.zeros(f + 1), np.zeros(f + 1)
    for k in range(s.steps):
        at = w + k / (k + 3) * (w - held)
        e = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30))) - y
        g = x.T @ e / n + ridge * at + cost @ at
        held, w = w, at - g / np.maximum(bound, 1e-9)
    return w[:f], float(w[f])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", s: Settings = Settings(), identity: dict[str, str] = IDENTITY) -> Model:
    """Fit on labelled rows whose doc_id has fold(doc_id, 5) other than 0.

    The rows are a bounded sample (Settings.max_train ids, one text each), so they are
    broadcast to meet their texts; counterfactual copies are made and features counted on
    the executors, and only the selected features of each row and copy are collected. The
    copies of a row weigh as much as one row together. Rows with a null id or label teach
    nothing, null and empty texts teach the bias. Ids with several labels take the largest,
    ids with several texts the text of the least hash, so repeated rows count once; ties in
    chi-square go to the least feature hash. Without labelled rows, or with a single class,
    no feature has weight and every score is 0.0 or the one class's rate.
    """
    few = labels.where(F.col(label).isNotNull() & (fold(F.col(doc_id), 5) != 0))
    few = few.groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("y"))
    few = few.orderBy(F.xxhash64("id"), "id").limit(s.max_train)

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 200):
                texts, rows = text_list(b.t.iloc[i : i + 200]), []
                for y, t, own in zip(b.y.iloc[i : i + 200], texts, _features_of(texts)):
                    rows.append((y, own.view(np.int64), (), 1.0))
                    copies = _changes(t, own, identity)
                    rows += [(-1, a.view(np.int64), c.view(np.int64), 1 / len(copies)) for a, c in copies]
                yield pd.DataFrame(rows, columns=["y", "f", "won", "times"])

    met = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(few), "id")
    met = met.groupBy("id").agg(F.max("y").alias("y"), F.min_by("t", F.xxhash64("t")).alias("t"))
    rows = written(met.select("y", "t").mapInPandas(found, "y int, f array<long>, won array<long>, times double"))
    own = rows.where("y >= 0")
    n, pos = own.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n or pos in (0, n):
        return Model(np.empty(0, np.uint64), np.empty(0), 30.0 if n and pos == n else -30.0)
    sums = own.select("y", F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("c"), F.sum("y").alias("a"))
    sums = sums.where(F.col("c") >= s.least)
    a, c = F.col("a").cast("double"), F.col("c").cast("double")
    expected = c * pos / n
    chi = (a - expected) ** 2 / expected + (a - expected) ** 2 / (c - expected)
    best = sums.withColumn("chi", chi).where(F.col("chi") >= s.chi_square).orderBy(F.desc("chi"), "f").limit(s.max_features)
    feature = np.sort(np.array([r.f for r in best.select("f").collect()], np.int64).view(np.uint64))
    if not len(feature):
        return Model(feature, np.empty(0), float(np.log(pos / (n - pos))))
    shared = feature

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = lambda f: np.flatnonzero(np.isin(shared, np.asarray(f, np.int64).view(np.uint64))).astype(np.int32)
        for b in batches:
            yield pd.DataFrame({"y": b.y, "at": [of(f) for f in b.f], "won": [of(f) for f in b.won], "times": b.times})

    kept = rows.mapInPandas(chosen, "y int, at array<int>, won array<int>, times double")
    got = kept.where("y >= 0").select("y", "at").toPandas()
    swaps = kept.where("y < 0 AND size(at) + size(won) > 0").groupBy("at", "won").agg(F.sum("times").alias("times"))
    swaps = swaps.orderBy(F.desc("times"), "at", "won").limit(s.max_swaps).toPandas()
    x, y = np.zeros((len(got), len(feature))), got.y.to_numpy(float)
    for i, r in enumerate(got["at"]):
        x[i, np.asarray(r, np.int64)] = 1
    order = np.lexsort([*x.T[:8], y])  # the sums don't depend on the order rows arrive in
    x, y = x[order], y[order]
    of = lambda c: [np.asarray(r, np.int64) for r in swaps[c]]
    weight, bias = _fit(x, y, _penalty(of("at"), of("won"), swaps.times.to_numpy(float), len(feature)), s)
    return Model(feature, weight, bias)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a double from 0 to 1, rounded to 12 digits; null and empty texts get the
    bias's. Whole texts are scored, however long; equal texts score alike. An empty table
    gives an empty one. A column of the input called as out is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # max_features weights at most

    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.round(shared.value.scores(text_list(s)), 12))

    return docs.withColumn(out, F.pandas_udf(rate, "double").asNondeterministic()(F.col(text)))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of docs that score below the threshold, with their columns; a score that ties
    with it is rejected. Null and empty texts stay or go alike, repeated rows too."""
    name = unused(docs, "score")
    return score(docs, train(docs, labels), out=name).where(F.col(name) < threshold).drop(name)


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
