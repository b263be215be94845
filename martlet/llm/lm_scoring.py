"""Operator 1: cross-entropy difference of two matched language models.

The target model is counted over the documents labelled good, the background
model over all documents. Both are class bigram models of the same form over one
vocabulary, which is every word of the corpus: the ``vocabulary_size`` most frequent
words are a class each, all other words share one. A token costs

    -log2 p(class | class before) - log2 p(word | class)

with ``p(c | v) = (n(v, c) + k p(c)) / (n(v) + k)`` over add-one class unigrams, and
for a word of the shared class ``p(w | c) = (n(w) + 1) / (n(c) + V)``, V being the
number of such words (1 for a word that is its class). A document's score is the
mean over its tokens of target loss minus background loss (Moore and Lewis), so
lower is closer to the target.

All counts are exact and cover every document. Class pairs are added up inside the
tasks, then by Spark; their two tables of ``(vocabulary_size + 2) ** 2`` losses are
the only broadcast. The other words' counts grow with the corpus and never leave the
tasks: every batch of documents sends its words, by hash, to the parts of the word
space (arrays of 64-bit hashes, documents and counts); a part adds up the corpus
counts of its words and returns what they cost each document, a range of hashes after the other; the batch's
sums are put together. Parts hold ``RARE_PER_PART`` tokens, so their number grows with the
corpus. The labels meet the documents in a merge join at every size.

Defined results: a null or empty text has no tokens and a null score; labels of
missing documents count nothing, and with several label rows of a document one
good one suffices; without any good document the target model is the background
model's prior (uniform); repeated rows are counted and scored as rows; null ids
are scored and count as background; empty tables give no rows. Further columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import checkpointed, stored, text_bytes

#: Distinct words a task adds up before it passes its counts on.
FLUSH_WORDS = 500_000
#: Tokens of the shared class that meet in one part of the word space.
RARE_PER_PART = 4_000_000
#: Of these, how many a task sorts at once.
RARE_AT_ONCE = 500_000


@dataclass(frozen=True)
class ModelParams:
    vocabulary_size: int = 2046
    prior: float = 50.0  # k, the weight of the unigrams in a context


def tokens(text: str | None) -> list[bytes]:
    return text_bytes(text).lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def added_up() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                counts.update(tokens(text.as_py()))
                if len(counts) >= FLUSH_WORDS:
                    yield added_up()
        yield added_up()

    rows = docs.select(docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Class numbers: words of their own class from 2 on; 0 starts a document, 1 is
    the class of all other words."""

    def __init__(self, words: list[bytes]) -> None:
        self.number = {word: i + 2 for i, word in enumerate(words)}
        self.size = len(words) + 2

    def numbers(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The document's classes with the start in front, and the hashes of its
        words of the shared class."""
        number = self.number
        words = tokens(text)
        out = np.zeros(len(words) + 1, np.int64)
        out[1:] = np.fromiter((number.get(w, 1) for w in words), np.int64, len(words))
        rare = [xxhash.xxh64_intdigest(w) for w in words if w not in number]
        return out, np.array(rare, np.uint64)


def vocabulary(docs: DataFrame, params: ModelParams) -> Vocabulary:
    """The most frequent words; ties go to the smaller word."""
    top = word_counts(docs).orderBy(F.desc("n"), "word").limit(params.vocabulary_size)
    return Vocabulary([bytes(row["word"]) for row in top.collect()])


def model_counts(docs: DataFrame, good: DataFrame, shared) -> DataFrame:
    """``rare, key, background, target``: counts of class pairs, ``v * size + w``, and
    of the target's words of the shared class, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            pairs, targets, rare = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for text, is_good in zip(batch.column("text"), batch.column("good")):
                numbers, hashes = words.numbers(text.as_py())
                pairs.append(numbers[:-1] * words.size + numbers[1:])
                if is_good.as_py():
                    targets.append(pairs[-1])
                    rare.append(hashes)
            both, counts = np.unique(np.concatenate(pairs), return_counts=True)
            own, target_counts = np.unique(np.concatenate(targets), return_counts=True)
            target = np.zeros(len(both), np.int64)
            target[np.searchsorted(both, own)] = target_counts
            yield as_rows(False, both, counts, target)
            words_of_target, n = np.unique(np.concatenate(rare), return_counts=True)
            yield as_rows(True, words_of_target.view(np.int64), np.zeros(len(n), np.int64), n)

    def as_rows(rare: bool, key: np.ndarray, background: np.ndarray, target: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.full(len(key), rare)), *(pa.array(x.astype(np.int64)) for x in (key, background, target))]
        return pa.RecordBatch.from_arrays(columns, ["rare", "key", "background", "target"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    # A merge join at every size: the labels grow with the documents.
    flagged = rows.join(good.hint("merge"), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    return flagged.mapInArrow(run, "rare boolean, key long, background long, target long").groupBy("rare", "key").agg(
        F.sum("background").alias("background"), F.sum("target").alias("target")
    )


def losses(counts: np.ndarray, prior: float) -> np.ndarray:
    """Loss in bits of every word (column) after every word (row)."""
    size = counts.shape[0]
    unigrams = counts.sum(axis=0, dtype=np.float64)
    unigrams[0] = 0
    unigram = (unigrams + 1) / (unigrams.sum() + size)
    contexts = counts.sum(axis=1, dtype=np.float64)
    out = (contexts + prior)[:, None] / (counts + prior * unigram)
    return np.log2(out, out=out).astype(np.float32)


def loss_tables(pairs: DataFrame, size: int, prior: float) -> list[tuple[np.ndarray, float]]:
    """Losses of the target and the background model, from at most ``size ** 2`` rows
    of counts, each with the tokens of the shared class."""
    rows = pairs.toArrow()
    at = rows.column("key").to_numpy()
    tables = []
    for name in ("target", "background"):
        counts = np.zeros(size * size, np.float64)
        counts[at] = rows.column(name).to_numpy()
        counts = counts.reshape(size, size)
        tables.append((losses(counts, prior), float(counts[:, 1].sum())))
    return tables


_BATCH = (
    "block long, part long, ids array<long>, n array<long>, rare array<long>, target array<double>, background array<double>,"
    " hashes binary, docs binary, counts binary"
)
_SUMS = "block long, words long, docs binary, target binary, background binary"


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)


def batches_with_words(docs: DataFrame, shared, tables, parts: int) -> DataFrame:
    """A row a batch (part -1): its documents with their class losses; and a row a
    part that its words of the shared class fall into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, losses_of = shared.value, tables.value
        for at, batch in enumerate(batches):
            block = (TaskContext.get().partitionId() << 32) + at
            n, rare, sums = [], [], ([], [])
            hashes, docs_, counts = [np.empty(0, np.uint64)], [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
            for i, text in enumerate(batch.column("text")):
                numbers, own = words.numbers(text.as_py())
                n.append(len(numbers) - 1)
                rare.append(len(own))
                for out, table in zip(sums, losses_of):
                    out.append(float(table[numbers[:-1], numbers[1:]].sum(dtype=np.float64)))
                own, k = np.unique(own, return_counts=True)
                hashes.append(own)
                docs_.append(np.full(len(own), i, np.uint32))
                counts.append(k.astype(np.uint32))
            empty = pa.array([b""], pa.binary())
            lists = [batch.column("doc_id").to_pylist(), n, rare, *sums]
            kinds = [pa.int64()] * 3 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([-1]), *(pa.array([x], pa.list_(k)) for x, k in zip(lists, kinds)), empty, empty, empty], names
            )
            h, d, k = (np.concatenate(x) for x in (hashes, docs_, counts))
            part = _part_of(h, parts)
            order = np.lexsort((h, part))
            found, starts = np.unique(part[order], return_index=True)
            for p, some in zip(found.tolist(), np.split(order, starts[1:])):
                blobs = [pa.array([x[some].tobytes()], pa.binary()) for x in (h, d, k)]
                nulls = [pa.nulls(1, pa.list_(kind)) for kind in kinds]
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([p]), *nulls, *blobs], names)

    names = [f.split()[0] for f in _BATCH.split(",")]
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, _BATCH)


def target_words(counts: DataFrame, parts: int) -> DataFrame:
    """The target's word counts as rows of the parts (block -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, k = batch.column("key").to_numpy().view(np.uint64), batch.column("target").to_numpy().astype(np.uint32)
            part = _part_of(h, parts)
            for p in np.unique(part).tolist():
                some = part == p
                blobs = [pa.array([x], pa.binary()) for x in (h[some].tobytes(), b"", k[some].tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([p]), *blobs], ["block", "part", "hashes", "docs", "counts"])

    return counts.select("key", "target").mapInArrow(run, "block long, part long, hashes binary, docs binary, counts binary")


def _cost_of_part(table: pa.Table) -> pa.Table:
    """What the words of one part save each document of each batch: the sums of
    ``k * log2(n(w) + 1)`` over its words, in both models."""
    blocks = table.column("block").to_pylist()
    own = [i for i, b in enumerate(blocks) if b >= 0]
    labelled = [i for i, b in enumerate(blocks) if b < 0]

    def arrays(name: str, kind: type, rows: list[int]) -> list[np.ndarray]:
        column = table.column(name)  # read where it lies, not copied
        return [np.frombuffer(column[i].as_buffer(), kind) for i in rows]

    hashes, docs, counts = (arrays(c, kind, own) for c, kind in (("hashes", np.uint64), ("docs", np.uint32), ("counts", np.uint32)))
    th = np.concatenate([np.empty(0, np.uint64), *arrays("hashes", np.uint64, labelled)])
    tn = np.concatenate([np.empty(0, np.uint32), *arrays("counts", np.uint32, labelled)])
    order = np.argsort(th)
    th, tn = th[order], tn[order]
    starts = np.cumsum([0, *map(len, hashes)])
    saved = [np.empty(starts[-1]) for _ in range(2)]
    # Every batch's hashes are in order: a range of them after the other is added up.
    ranges = max(1, -(-int(starts[-1]) // RARE_AT_ONCE))
    edges = np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64)
    cuts = [[0, *np.searchsorted(h, edges).tolist(), len(h)] for h in (*hashes, th)]
    n_words = 0
    for r in range(ranges):
        spans = [slice(cut[r], cut[r + 1]) for cut in cuts]
        words, place = np.unique(np.concatenate([np.empty(0, np.uint64), *(h[x] for h, x in zip(hashes, spans))]), return_inverse=True)
        k = np.concatenate([np.empty(0), *(n[x] for n, x in zip(counts, spans))])
        background = np.bincount(place, weights=k, minlength=len(words))
        target = np.zeros(len(words))
        if len(words):
            np.add.at(target, np.searchsorted(words, th[spans[-1]]), tn[spans[-1]].astype(np.float64))
        for all_, model in zip(saved, (target, background)):
            values, at = k * np.log2(model + 1)[place], 0
            for start, x in zip(starts.tolist(), spans[:-1]):
                n = x.stop - x.start
                all_[start + x.start : start + x.stop] = values[at : at + n]
                at += n
        n_words += len(words)
    out = []
    for start, i, of in zip(starts.tolist(), own, docs):
        those, row = np.unique(of, return_inverse=True)
        sums = [np.bincount(row, weights=s[start : start + len(of)]).tobytes() for s in saved]
        out.append((blocks[i], 0 if start else n_words, those.tobytes(), *sums))
    columns = list(zip(*out)) or [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["block", "words", "docs", "target", "background"])


_SCORED = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _scored(rare_logs: tuple[float, float]):
    def run(docs: pa.Table, sums: pa.Table) -> pa.Table:
        ids = pa.concat_arrays([c.values for c in docs.column("ids").chunks])
        n, rare = (docs.column(c).combine_chunks().values.to_numpy(zero_copy_only=False) for c in ("n", "rare"))
        means = []
        for name, log in zip(("target", "background"), rare_logs):
            loss = docs.column(name).combine_chunks().values.to_numpy(zero_copy_only=False) + rare * log
            for those, saved in zip(sums.column("docs").to_pylist(), sums.column(name).to_pylist()):
                loss[np.frombuffer(those, np.uint32)] -= np.frombuffer(saved, np.float64)
            means.append(loss / np.maximum(n, 1))
        none = n == 0
        values = [pa.array(x, mask=none) for x in (*means, means[0] - means[1])]
        return pa.Table.from_arrays([ids, pa.array(n), *values], [f.split()[0] for f in _SCORED.split(", ")])

    return run


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, params: ModelParams = ModelParams()) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` per document.

    ``labels``: ``doc_id, quality``; documents of quality 1 are the target.
    """
    sc = docs.sparkSession.sparkContext
    good = (
        labels.where(labels["quality"] == 1).select(labels["doc_id"].cast("long").alias("doc_id"))
        .distinct().withColumn("good", F.lit(True))
    )
    shared = sc.broadcast(vocabulary(docs, params))
    counts = checkpointed(model_counts(docs, good, shared))
    models = loss_tables(counts.where("NOT rare").select("key", "target", "background"), shared.value.size, params.prior)
    tables = sc.broadcast(tuple(table for table, _ in models))
    parts = max(1, -(-int(models[1][1]) // RARE_PER_PART))
    batches = stored(batches_with_words(docs, shared, tables, parts), "lm-batches")
    words = batches.where("part >= 0").select("block", "part", "hashes", "docs", "counts")
    sent = words.unionByName(target_words(counts.where("rare"), parts))
    sums = stored(sent.groupBy("part").applyInArrow(_cost_of_part, _SUMS), "lm-sums")
    v = sums.agg(F.sum("words")).first()[0] or 0
    logs = tuple(float(np.log2(n + v)) if v else 0.0 for _, n in models)
    lists = batches.where("part < 0").select("block", "ids", "n", "rare", "target", "background")
    return lists.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(_scored(logs), _SCORED)
