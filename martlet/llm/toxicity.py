"""Operator 2: toxicity by a classifier chain.

The categories are label columns in a fixed order. Each has a logistic model
over the words, word beginnings and word shapes of a text and the probabilities
of the categories before it. A feature is used when a likelihood-ratio test on
the training rows finds it related to the category.
Later models are trained with out-of-fold probabilities: the rows of a fold are
predicted by a model that has not seen them, as new texts will be.

Training takes a bounded sample of the labelled rows (``max_rows``, the smallest
hashes of ``doc_id``, so reruns agree); its folds are trained as separate Spark
tasks. Every text is then scored whole. What is broadcast is one weight per
category for each feature that passed the test, so it is bounded by the sample.
The flag's threshold is the one with the best F1 on the out-of-fold
probabilities.

Defined results: a null or empty text has no words and gets the probabilities of
an empty text; labels that are null, or whose document is missing or null, train
nothing; with several label rows of a document the largest value counts;
repeated documents give equal rows; a category without any trained row gets a
null probability and no flag; empty tables give no rows. Further columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import checkpointed, text_bytes

CACHE_WORDS = 200_000
PUNCTUATION = b".,;:!?\"'()[]{}<>|#*$%&-_/\\"


@dataclass(frozen=True)
class ChainParams:
    max_rows: int = 10_000
    folds: int = 3
    min_df: int = 5
    min_evidence: float = 10.83  # likelihood ratio of a chance of one in a thousand
    prefix: int = 5
    steps: int = 300
    rate: float = 0.1
    l2: float = 0.3


def word_features(word: bytes, prefix: int) -> tuple[int, ...]:
    """Signed hashes of a word, lower-cased and without outer punctuation, of
    its beginning where it is longer than that, and of its shape: whether it is
    all capitals, and the punctuation that ends it."""
    ending = word[len(word.rstrip(PUNCTUATION)):].decode()
    raw = word.strip(PUNCTUATION).decode("utf-8", "replace")
    plain = raw.lower()
    names = [plain, ("~U" if len(raw) > 1 and raw.isupper() else "~") + ending]
    if len(plain) > prefix:
        names.append("^" + plain[:prefix])
    return tuple(xxhash.xxh64_intdigest(x.encode()) - (1 << 63) for x in names)


def text_features(text: str | None, prefix: int) -> Counter:
    """How many distinct words of the text have each feature."""
    return Counter(f for w in set(text_bytes(text).split()) for f in word_features(w, prefix))


def strength(counts: np.ndarray) -> np.ndarray:
    """Value of a feature that so many words of a text have: 1 for one word."""
    return np.log2(1.0 + counts)


@dataclass
class Sparse:
    """Feature values row by row."""

    at: np.ndarray  # position of the feature
    row: np.ndarray
    value: np.ndarray
    n: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.at] * self.value, self.n)

    def transposed(self, values: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.at, values[self.row] * self.value, size)


def evidence(with_it: np.ndarray, positive: np.ndarray, n: int, n_positive: int) -> np.ndarray:
    """Likelihood ratio (G squared) of feature and category over ``n`` rows."""
    total = np.zeros(len(with_it))
    for seen, margin in ((with_it, positive), (n - with_it, n_positive - positive)):
        for part, share in ((margin, n_positive / n), (seen - margin, 1 - n_positive / n)):
            total += 2 * np.where(part > 0, part * np.log(np.maximum(part, 1e-12) / np.maximum(seen * share, 1e-12)), 0)
    return total


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: Sparse, dense: np.ndarray, y: np.ndarray, size: int, params: ChainParams) -> tuple[np.ndarray, np.ndarray]:
    """Logistic weights: one per word, and for ``dense`` columns plus the bias."""
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    dense = np.column_stack([dense, np.ones(len(y))])
    theta = np.zeros(size + dense.shape[1])
    theta[-1] = np.log(rate / (1 - rate))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, params.steps + 1):
        error = (sigmoid(x.times(theta[:size]) + dense @ theta[size:]) - y) / len(y)
        gradient = np.concatenate([x.transposed(error, size), dense.T @ error])
        gradient[:-1] += params.l2 / len(y) * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= params.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:size], theta[size:]


def _train_fold(rows: pd.DataFrame, params: ChainParams) -> pd.DataFrame:
    """One model of the chain: trained without its fold, which it predicts.

    Rows: ``model, doc_id, fold, y, earlier, features, counts``. The model
    numbered ``folds`` holds nothing out; its weights are returned.
    """
    model = int(rows["model"].iloc[0])
    rows = rows.sort_values("doc_id", ignore_index=True)
    lengths = rows["features"].map(len).to_numpy()
    hashes = np.concatenate([np.empty(0, np.int64), *[np.asarray(f, np.int64) for f in rows["features"]]])
    values = strength(np.concatenate([np.empty(0), *[np.asarray(c, float) for c in rows["counts"]]]))
    row_of = np.repeat(np.arange(len(rows)), lengths)
    dense = np.array(rows["earlier"].tolist(), float).reshape(len(rows), -1)
    y = rows["y"].to_numpy(float)
    train = (rows["fold"] != model).to_numpy()
    if not train.any():  # fewer rows than folds
        train = ~train
    seen = train[row_of]
    names, inverse = np.unique(hashes[seen], return_inverse=True)
    df = np.bincount(inverse, minlength=len(names)).astype(float)
    positive = np.bincount(inverse, y[row_of[seen]], len(names))
    names = names[(df >= params.min_df) & (evidence(df, positive, int(train.sum()), y[train].sum()) >= params.min_evidence)]
    known = np.isin(hashes, names)
    x_at, x_row, x_value = np.searchsorted(names, hashes[known]), row_of[known], values[known]

    def part(mask: np.ndarray) -> Sparse:
        place = np.cumsum(mask) - 1
        own = mask[x_row]
        return Sparse(x_at[own], place[x_row[own]], x_value[own], int(mask.sum()))

    weights, tail = fit(part(train), dense[train], y[train], len(names), params)
    if model == params.folds:
        return pd.DataFrame({"doc_id": [None], "y": [None], "p": [None], "features": [names], "weights": [weights], "tail": [tail]})
    held = (rows["fold"] == model).to_numpy()
    p = sigmoid(part(held).times(weights) + np.column_stack([dense[held], np.ones(held.sum())]) @ tail)
    return pd.DataFrame({"doc_id": rows["doc_id"][held], "y": y[held], "p": p, "features": None, "weights": None, "tail": None})


def best_threshold(held_out: pd.DataFrame) -> float:
    """The threshold with the best F1 on held-out probabilities."""
    rows = held_out.sort_values("p", ascending=False)
    hits = rows["y"].cumsum().to_numpy()
    f1 = 2 * hits / (np.arange(1, len(rows) + 1) + rows["y"].sum())
    if not len(rows) or not hits[-1]:
        return 0.5
    at = int(np.argmax(f1))
    p = rows["p"].to_numpy()
    return float((p[at] + (p[at + 1] if at + 1 < len(p) else 0)) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, categories: Sequence[str], params: ChainParams) -> DataFrame:
    """``doc_id, fold, <categories>, features, counts`` of the sampled texts."""
    values = labels.groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(
        *[F.max(labels[c].cast("double")).alias(c) for c in categories]
    )
    chosen = values.where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.max_rows)
    chosen = checkpointed(chosen)  # max_rows rows at most: small enough to broadcast
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").where("text is not null").groupBy("doc_id", *categories).agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(text_features(t.as_py(), params.prefix).items()) for t in batch.column("text")]
            features = pa.array([[f for f, _ in row] for row in found], pa.list_(pa.int64()))
            counts = pa.array([[n for _, n in row] for row in found], pa.list_(pa.int32()))
            kept = [batch.column(c) for c in ("doc_id", *categories)]
            yield pa.RecordBatch.from_arrays([*kept, features, counts], ["doc_id", *categories, "features", "counts"])

    schema = "doc_id long, " + ", ".join(f"`{c}` double" for c in categories) + ", features array<long>, counts array<int>"
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(params.folds)).cast("int")
    return sample.mapInArrow(run, schema).withColumn("fold", fold)


def train_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str], params: ChainParams) -> list:
    """Per category ``(features, weights, tail, threshold)``, or None where
    nothing is labelled."""
    rows = checkpointed(training_rows(docs, labels, categories, params).withColumn("earlier", F.array().cast("array<double>")))
    chain: list = []
    for category in categories:
        models = F.explode(F.array(*[F.lit(i) for i in range(params.folds + 1)]))
        out = checkpointed(
            rows.where(F.col(category).isNotNull())
            .select(models.alias("model"), "doc_id", "fold", F.col(category).alias("y"), "earlier", "features", "counts")
            .groupBy("model").applyInPandas(
                lambda pdf: _train_fold(pdf, params),
                "doc_id long, y double, p double, features array<long>, weights array<double>, tail array<double>",
            )
        )
        final = out.where("features is not null").first()
        held_out = out.where("features is null").select("y", "p").toPandas()  # max_rows at most
        chain.append(final and (
            np.array(final["features"], np.int64), np.array(final["weights"]), np.array(final["tail"]), best_threshold(held_out)
        ))
        ahead = out.where("features is null").select("doc_id", "p")
        # A row without this label has no out-of-fold value; the mean stands in.
        mean = ahead.agg(F.mean("p")).first()[0]
        rows = checkpointed(
            rows.join(ahead, "doc_id", "left")
            .withColumn("earlier", F.concat("earlier", F.array(F.coalesce("p", F.lit(mean if mean is not None else 0.5))))).drop("p")
        )
    return chain


def score(docs: DataFrame, chain: list, categories: Sequence[str], prefix: int) -> DataFrame:
    """``doc_id, p_<category>..., <category>...`` for every document."""
    vocabulary = np.unique(np.concatenate([np.empty(0, np.int64), *[m[0] for m in chain if m]]))
    table = np.zeros((len(chain), len(vocabulary)))
    for i, model in enumerate(chain):
        if model:
            table[i, np.searchsorted(vocabulary, model[0])] = model[1]
    tails = [m and (m[2], m[3]) for m in chain]
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, table, tails))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, table, tails = shared.value
        place_of = {h: i for i, h in enumerate(vocabulary.tolist())}
        cache: dict[bytes, tuple[int, ...]] = {}

        def sums_of(text: str | None) -> np.ndarray:
            found: Counter = Counter()
            for word in set(text_bytes(text).split()):
                places = cache.get(word)
                if places is None:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    places = cache[word] = tuple(place_of[f] for f in word_features(word, prefix) if f in place_of)
                if places:
                    found.update(places)
            at = np.fromiter(sorted(found), np.int64, len(found))
            return table[:, at] @ strength(np.array([found[i] for i in at.tolist()], float))

        for batch in batches:
            sums = np.array([sums_of(t.as_py()) for t in batch.column("text")]).reshape(batch.num_rows, -1)
            known: list[np.ndarray] = []
            flags: list[pa.Array] = []
            for i, model in enumerate(tails):
                if model is None:
                    known.append(np.full(batch.num_rows, np.nan))
                    flags.append(pa.array(np.zeros(batch.num_rows, bool)))
                    continue
                tail, threshold = model
                earlier = [np.nan_to_num(p, nan=0.5) for p in known]
                known.append(sigmoid(sums[:, i] + np.column_stack([*earlier, np.ones(batch.num_rows)]) @ tail))
                flags.append(pa.array(known[-1] > threshold))
            p = [pa.array(v, pa.float64(), mask=np.isnan(v)) for v in known]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *p, *flags], ["doc_id", *[f"p_{c}" for c in categories], *categories]
            )

    schema = ", ".join(["doc_id long", *[f"`p_{c}` double" for c in categories], *[f"`{c}` boolean" for c in categories]])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def toxicity(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str] = ("quality", "toxic"), params: ChainParams = ChainParams()
) -> DataFrame:
    """Trains the chain on ``labels`` and scores every document."""
    return score(docs, train_chain(docs, labels, categories, params), categories, params.prefix)
