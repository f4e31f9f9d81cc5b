"""Toxicity by a classifier chain.

The label columns form a chain. Each category has a logistic model over the
words of a text (present or not) and the probabilities of the categories before
it; the words are those whose training documents differ most from all in their
share of the category (log-likelihood ratio), at most ``max_words``. A later model is trained on probabilities that its earlier models
gave to documents they were not trained on (``folds`` parts by hash of
doc_id); a document is scored with the models of all training documents.

Training reads at most ``max_labelled`` labelled documents, chosen by hash of
doc_id over all of them (a documented bound: labels beyond it add nothing to a
model of this size). Every document is scored on its whole text.

Defined results: null and empty text have no words; labels that are null, or
whose doc_id is null or not among the documents, are not trained on; of several
labels of one doc_id the highest counts; a category with no training row, or
with only one of its classes, gets the share of its class (0 without rows) for
all documents; repeated rows are scored alike; an empty table gives an empty
table; input columns named like a result column are replaced."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

WORD = r"[^\p{L}\p{N}]+"



def words(text: Column) -> Column:
    """The distinct words of a text, in lower case."""
    return F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD, -1), ""))


@dataclass
class Linear:
    """One category's model: weights by word and by earlier category."""

    by_word: dict[str, float]
    by_category: list[float]
    intercept: float

    def probability(self, found: Column, earlier: list[Column]) -> Column:
        """``found``: the text's distinct words, at least those with a weight."""
        z = F.lit(self.intercept)
        if self.by_word:
            weight = F.create_map([F.lit(x) for pair in self.by_word.items() for x in pair])
            z = z + F.aggregate(found, F.lit(0.0), lambda a, w: a + F.coalesce(F.try_element_at(weight, w), F.lit(0.0)))
        for p, w in zip(earlier, self.by_category, strict=True):
            z = z + p * F.lit(w)
        return 1 / (1 + F.exp(-z))


@dataclass
class Constant:
    """The share of a category's class, where there is nothing to learn."""

    share: float
    by_word: dict[str, float] = field(default_factory=dict)

    def probability(self, found: Column, earlier: list[Column]) -> Column:
        return F.lit(self.share)


@dataclass
class Chain:
    """The trained chain, one model per category."""

    categories: list[str]
    models: list[Linear | Constant]

    def score(self, docs: DataFrame, text: str = "text", prefix: str = "p_") -> DataFrame:
        """``docs`` with the probability of each category. Few words have a
        weight; only those of a text's words are looked up."""
        names = [prefix + c for c in self.categories]
        weighed = sorted({w for m in self.models for w in m.by_word})
        found = F.array_intersect(words(F.col(text)), F.lit(weighed)) if weighed else F.array().cast("array<string>")
        out = docs.drop(*names).withColumn("_found", found)
        for k, (name, model) in enumerate(zip(names, self.models, strict=True)):
            out = out.withColumn(name, model.probability(F.col("_found"), [F.col(n) for n in names[:k]]))
        return out.drop("_found")


def _evidence(in_class: Column, total: Column, positives: Column, rows: Column) -> Column:
    """Log-likelihood ratio of a word's documents against the class: how far
    its share of the class is from the share of all documents."""
    def part(k, n, expected):
        return F.when(k > 0, k * F.log(k / (n * expected))).otherwise(F.lit(0.0))

    share = positives / rows
    return 2 * (part(in_class, total, share) + part(total - in_class, total, 1 - share))


def _newton(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 25, block: int = 2048) -> np.ndarray:
    """Weights and, last, the intercept of a logistic model with a quadratic
    penalty on the weights. ``x`` has a row per training document and a last
    column of ones; sums are made block by block."""
    ridge = np.full(x.shape[1], penalty * len(x))
    ridge[-1] = 0.0
    w = np.zeros(x.shape[1])
    share = y.mean()
    w[-1] = np.log(share / (1 - share))

    def parts():
        for i in range(0, len(x), block):
            yield x[i:i + block].astype(np.float64), y[i:i + block]

    def loss(w):
        total = 0.5 * (ridge * w * w).sum()
        for xs, ys in parts():
            z = xs @ w
            total += np.logaddexp(0, z).sum() - (ys * z).sum()
        return total

    now = loss(w)
    for _ in range(steps):
        slope, bend = ridge * w, np.diag(ridge + 1e-9)
        for xs, ys in parts():
            p = 1 / (1 + np.exp(-(xs @ w)))
            slope = slope + xs.T @ (p - ys)
            bend = bend + (xs.T * (p * (1 - p))) @ xs
        step, scale = np.linalg.solve(bend, slope), 1.0
        while (after := loss(w - scale * step)) > now and scale > 1e-4:
            scale /= 2
        if now - after < 1e-9 * abs(now):
            break
        w, now = w - scale * step, after
    return w


class Sample:
    """The training rows: words as numbers into ``weighed`` (row by row),
    labels by category (nan: none), folds, and earlier probabilities."""

    def __init__(self, table, weighed: list[str], categories: Sequence[str]):
        found = table["found"].combine_chunks()
        found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
        self.rows, self.weighed = len(table), weighed
        self.row = np.repeat(np.arange(self.rows), np.diff(found.offsets.to_numpy()))
        self.word = pc.index_in(found.flatten().cast(pa.string()), value_set=pa.array(weighed, pa.string())).to_numpy(zero_copy_only=False)
        self.word = self.word.astype(np.int64)
        self.fold = table["_fold"].to_numpy().astype(np.int64)
        self.label = {c: pc.fill_null(table[f"y_{c}"].cast(pa.float64()), np.nan).to_numpy() for c in categories}
        self.earlier = np.zeros((self.rows, 0))

    def matrix(self, vocabulary: list[str], at: np.ndarray) -> np.ndarray:
        """Words (0 or 1), earlier probabilities and ones of the rows ``at``."""
        column = np.full(len(self.weighed) + 1, -1)
        column[[self.weighed.index(w) for w in vocabulary]] = np.arange(len(vocabulary))
        place = np.full(self.rows, -1)
        place[at] = np.arange(len(at))
        x = np.zeros((len(at), len(vocabulary) + self.earlier.shape[1] + 1), np.float32)
        i, j = place[self.row], column[self.word]
        x[i[(i >= 0) & (j >= 0)], j[(i >= 0) & (j >= 0)]] = 1
        x[:, len(vocabulary):-1] = self.earlier[at]
        x[:, -1] = 1
        return x

    def fit(self, category: str, at: np.ndarray, vocabulary: list[str], penalty: float) -> tuple[Linear | Constant, np.ndarray]:
        """A model of the rows ``at``, and its probabilities for all rows."""
        y = self.label[category][at]
        if not len(y) or y.min() == y.max() or not vocabulary and not self.earlier.shape[1]:
            model = Constant(float(y.mean()) if len(y) else 0.0)
            return model, np.full(self.rows, model.share)
        w = _newton(self.matrix(vocabulary, at), y, penalty)
        n = len(vocabulary)
        z = np.full(self.rows, w[-1]) + self.earlier @ w[n:-1]
        weight = np.zeros(len(self.weighed) + 1)
        weight[[self.weighed.index(v) for v in vocabulary]] = w[:n]
        z += np.bincount(self.row, weight[self.word], self.rows)
        model = Linear(dict(zip(vocabulary, w[:n].tolist(), strict=True)), w[n:-1].tolist(), float(w[-1]))
        return model, 1 / (1 + np.exp(-z))


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str], doc_id: str = "doc_id", text: str = "text",
          max_labelled: int = 20_000, max_words: int = 256, min_evidence: float = 10.0, folds: int = 3,
          penalty: float = 3e-5) -> Chain:
    """The word counts are made by Spark over the training documents' whole
    texts; the driver then reads at most ``max_labelled`` rows, each with its
    share of the chosen words (at most ``max_words`` per model)."""
    chosen = (labels.groupBy(F.col(doc_id).alias("_id")).agg(*[F.max(c).cast("int").alias(f"y_{c}") for c in categories])
              .where(F.col("_id").isNotNull()).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    rows = rows.join(F.broadcast(chosen), "_id")  # at most max_labelled rows of a few numbers
    rows = rows.withColumn("_words", words(F.col("_text"))).drop("_text")
    rows = stage(rows.withColumn("_fold", F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(folds))), "toxicity-rows")

    def sums(of):
        return [F.sum(F.when((F.col("_fold") == f) & F.col(f"y_{c}").isNotNull(), F.col(f"y_{c}") if kind == "k" else F.lit(1))
                      .otherwise(0)).alias(f"{kind}_{c}_{f}") for c in categories for f in range(folds) for kind in of]

    counts = stage(rows.select("_fold", *[f"y_{c}" for c in categories], F.explode("_words").alias("w")).groupBy("w").agg(*sums("kn")),
                   "toxicity-counts")
    totals = rows.agg(*sums("kn")).first()
    vocabulary: dict[tuple, list[str]] = {}
    for c in categories:
        for but in (None, *range(folds)):
            used = [f for f in range(folds) if f != but]
            all_k, all_n = (sum(totals[f"{kind}_{c}_{f}"] or 0 for f in used) for kind in "kn")
            if all_k in (0, all_n):
                vocabulary[c, but] = []
                continue
            k, n = (sum(F.col(f"{kind}_{c}_{f}") for f in used) for kind in "kn")
            best = (counts.select("w", k.alias("k"), n.alias("n")).where("n > 1")
                    .withColumn("g", _evidence(F.col("k"), F.col("n"), F.lit(all_k), F.lit(all_n)))
                    .where(F.col("g") >= min_evidence).orderBy(F.desc("g"), "w").limit(max_words))
            vocabulary[c, but] = [r["w"] for r in best.collect()]

    weighed = sorted({w for v in vocabulary.values() for w in v})
    found = F.array_sort(F.array_intersect("_words", F.lit(weighed))) if weighed else F.array().cast("array<string>")
    table = rows.select("_id", "_fold", *[f"y_{c}" for c in categories], found.alias("found")).orderBy("_id", "found").toArrow()
    sample, models = Sample(table, weighed, categories), []
    for i, c in enumerate(categories):
        known = ~np.isnan(sample.label[c])
        models.append(sample.fit(c, np.flatnonzero(known), vocabulary[c, None], penalty)[0])
        if i + 1 < len(categories):  # what later models read: probabilities by models that have not seen the document
            out = np.zeros(sample.rows)
            for f in range(folds):
                _, p = sample.fit(c, np.flatnonzero(known & (sample.fold != f)), vocabulary[c, f], penalty)
                out[sample.fold == f] = p[sample.fold == f]
            sample.earlier = np.hstack([sample.earlier, out[:, None]])
    return Chain(list(categories), models)


def chain_of(spark, sf_dir: str, docs: DataFrame) -> Chain:
    """The chain over the label table: low or high quality first, then toxic."""
    return train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ["quality", "toxic"])


def op1_classifier_chain(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = chain_of(spark, sf_dir, docs).score(docs)
    return scored.select("doc_id", "p_quality", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


def drop_toxic(spark, docs: DataFrame, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """Pipeline stage: the documents that are not toxic."""
    scored = chain_of(spark, sf_dir, docs).score(docs)
    return scored.where(F.col("p_toxic") < threshold).select(*docs.columns)
