"""Quality classifier: a byte-level convolutional network in numpy.

A document is its UTF-8 bytes, cut into overlapping chunks that cover all of
it.  Learned filters of four bytes run over each chunk, a rectifier and a
max-pool over the chunk follow, and the pooled values, averaged over the chunks
and their largest over the chunks, are combined by a logistic unit.

A filter over bytes is a sum of one table row per byte, so two neighbouring
bytes are looked up together: scoring needs two gathers per position.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import aside, in_arrow, table, text_of

WIDTH = 4
FILTERS = 16
CHUNK = 512
#: Neighbouring chunks share this many bytes.
OVERLAP = 64
#: Bound of the training sample: so many labelled rows of each class, by hash
#: of the id; all chunks of their texts are learned from.
TRAIN_ROWS_PER_CLASS = 800
#: Chunks whose filter values are held at a time.
BLOCK = 128
EPOCHS = 12
THRESHOLD = 0.3
SEED = 7


@dataclass
class Model:
    """Filter weights (WIDTH, 256, FILTERS), biases, and the logistic unit over
    mean- and max-pooled filters.  ``constant`` replaces all of it where there
    was nothing to learn from."""

    weights: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    offset: float
    constant: float | None = None

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights.astype(np.float32)
        first = (w[0][:, None, :] + w[1][None, :, :]).reshape(65536, -1)
        second = (w[2][:, None, :] + w[3][None, :, :]).reshape(65536, -1)
        return first, second


def chunks_of(data: bytes) -> np.ndarray:
    """Rows of CHUNK bytes that cover ``data``; each starts CHUNK - OVERLAP
    after the one before, and the last is filled with zeros.  Empty: one row."""
    step = CHUNK - OVERLAP
    count = max(1, -(-(len(data) - OVERLAP) // step))
    padded = np.zeros((count - 1) * step + CHUNK, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


def _pairs(chunks: np.ndarray) -> np.ndarray:
    """Codes of neighbouring byte pairs, low byte of the pair second."""
    return (chunks[:, :-1].astype(np.int32) << 8) | chunks[:, 1:]


def pooled(chunks: np.ndarray, tables: tuple[np.ndarray, np.ndarray], bias: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Max-pooled, rectified filters of each chunk."""
    out = np.empty((len(chunks), FILTERS), np.float32)
    for at in range(0, len(chunks), block):
        codes = _pairs(chunks[at : at + block])
        total = tables[0].take(codes[:, : CHUNK - WIDTH + 1], axis=0)
        total += tables[1].take(codes[:, 2 : CHUNK - WIDTH + 3], axis=0)
        out[at : at + block] = total.max(axis=1)
    return np.maximum(out + bias.astype(np.float32), 0)


def combine(features: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    """Probabilities of documents whose chunks begin at ``starts``."""
    counts = np.diff(np.append(starts, len(features)))
    mean = np.add.reduceat(features.astype(np.float64), starts, axis=0) / counts[:, None]
    most = np.maximum.reduceat(features, starts, axis=0)
    z = np.concatenate([mean, most], axis=1) @ model.out + model.offset
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _largest(chunks: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where each filter is largest in each chunk, and its value there, a block of
    chunks at a time."""
    where = np.empty((len(chunks), FILTERS), np.int64)
    value = np.empty((len(chunks), FILTERS))
    for at in range(0, len(chunks), BLOCK):
        codes = _pairs(chunks[at : at + BLOCK])
        total = tables[0].take(codes[:, : CHUNK - WIDTH + 1], axis=0)
        total += tables[1].take(codes[:, 2 : CHUNK - WIDTH + 3], axis=0)
        best = total.argmax(axis=1)
        where[at : at + BLOCK] = best
        value[at : at + BLOCK] = np.take_along_axis(total, best[:, None, :], axis=1)[:, 0, :]
    return where, value


def gradients(model: Model, offset: float, chunks: np.ndarray, starts: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The loss of a batch (weighed cross-entropy and a small weight on ``out``) and
    its gradient by weights, bias, out and offset.  The gradient of a max-pool
    reaches only the position that was largest."""
    sizes = np.diff(np.append(starts, len(chunks)))
    where, value = _largest(chunks, model.tables())
    raw = value + model.bias
    features = np.maximum(raw, 0)
    mean = np.add.reduceat(features, starts, axis=0) / sizes[:, None]
    most = np.maximum.reduceat(features, starts, axis=0)
    x = np.concatenate([mean, most], axis=1)
    z = np.clip(x @ model.out + offset, -30, 30)
    p = 1 / (1 + np.exp(-z))
    share = importance / len(labels)
    loss = float((share * (np.logaddexp(0, z) - labels * z)).sum() + 0.5e-4 * (model.out**2).sum())
    error = (p - labels) * share
    back = np.repeat(error[:, None] * model.out[:FILTERS] / sizes[:, None], sizes, axis=0)
    of = np.repeat(np.arange(len(labels)), sizes)
    # neighbouring chunks may share the place that is largest, and then share its slope
    largest = (features == most[of]).astype(np.float64)
    largest /= np.add.reduceat(largest, starts, axis=0)[of]
    back += largest * (error[:, None] * model.out[FILTERS:])[of]
    back *= raw > 0
    weights = np.zeros_like(model.weights)
    filters = np.broadcast_to(np.arange(FILTERS), where.shape)
    rows = np.arange(len(chunks))[:, None]
    for k in range(WIDTH):
        np.add.at(weights[k], (chunks[rows, where + k], filters), back)
    return loss, [weights, back.sum(0), x.T @ error + 1e-4 * model.out, error.sum(keepdims=True)]


def train(documents: list[tuple[list[bytes], int]], prior: float, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Fit by Adam on (chunks, label) pairs, each class weighing as much as
    ``prior`` (share of label 1) says."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(0, 0.15, (WIDTH, 256, FILTERS))
    model = Model(weights, np.zeros(FILTERS), np.zeros(2 * FILTERS), 0.0)
    labels = np.array([y for _, y in documents], np.float64)
    if not len(labels) or labels.min() == labels.max():
        model.constant = prior
        return model
    share = labels.mean()
    importance = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    model.out[:] = rng.normal(0, 0.1, 2 * FILTERS)
    arrays = [np.stack([chunks_of(c)[0] for c in cs]) for cs, _ in documents]
    params = [model.weights, model.bias, model.out]
    offset = np.zeros(1)
    params.append(offset)
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(arrays))
        rate = 0.02 * (1 - epoch / epochs) + 0.002
        for at in range(0, len(order), 32):
            batch = order[at : at + 32]
            chunks = np.concatenate([arrays[i] for i in batch])
            sizes = np.array([len(arrays[i]) for i in batch])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            _, slopes = gradients(model, offset[0], chunks, starts, labels[batch], importance[batch])
            step += 1
            for p_, g, m, v in zip(params, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p_ -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.offset = float(offset[0])
    return model


def held_out(doc_id: Column) -> Column:
    """Whether the labels of these ids are kept from learning; null ids are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, rows_per_class: int = TRAIN_ROWS_PER_CLASS) -> tuple[list, float]:
    """Chunks and labels to learn from, and the share of label 1 among all rows
    that may be learnt from.  At most ``rows_per_class`` ids of each class are
    chosen by hash; only their texts are read out, whole, as chunks."""
    usable = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    order = F.md5(F.concat(F.lit("train:"), F.col("doc_id").cast("string")))
    chosen = None
    for quality in (0, 1):
        part = usable.where(F.col("quality") == quality).select("doc_id", "quality", order.alias("o")).orderBy("o", "doc_id").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    step = CHUNK - OVERLAP

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, q, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                count = max(1, -(-(len(data) - OVERLAP) // step))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int64()), pa.array([q], pa.int32()), pa.array([[data[a : a + CHUNK] for a in range(0, count * step, step)]], pa.list_(pa.binary()))],
                    ["doc_id", "quality", "chunks"],
                )

    ids = F.broadcast(chosen.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")))  # at most 2 * rows_per_class rows
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).join(ids, "doc_id").select("doc_id", "quality", "text")
    found = texts.transform(in_arrow(cut, "doc_id long, quality int, chunks array<binary>")).orderBy("doc_id", "chunks").limit(2 * rows_per_class).collect()
    return [([bytes(c) for c in r["chunks"]], r["quality"]) for r in found], prior


def score_quality(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",), into: str = "score", text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` and the score of column ``text`` as ``into``, a row per
    input row.

    Null texts are scored as empty.  All chunks of a text count, however many;
    they are worked off in blocks, so memory does not follow their number, and a
    very long text costs its length.  Equal texts score alike.
    """
    schema = docs.select(*columns).schema.add(into, "double")
    arrow_columns = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model.constant is None else None
        for batch in batches:
            texts = batch.column(where)
            scores = np.empty(batch.num_rows)
            held, starts, first = [], [], 0
            total = 0

            def flush(upto: int):
                nonlocal held, starts, total, first
                if starts:
                    features = np.concatenate([pooled(h, tables, model.bias) for h in held])
                    scores[first:upto] = combine(features, np.array(starts), model)
                held, starts, total, first = [], [], 0, upto

            if tables is None:
                scores[:] = model.constant
            else:
                for i, value in enumerate(texts):
                    chunks = chunks_of((value.as_py() or "").encode())
                    starts.append(total)
                    held.append(chunks)
                    total += len(chunks)
                    if total > 2000:
                        flush(i + 1)
                flush(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in range(len(arrow_columns))] + [pa.array(scores)], [*arrow_columns, into]
            )

    where = arrow_columns.index(text) if text in columns else len(arrow_columns)
    return docs.select(*columns, *([] if text in columns else [text])).transform(in_arrow(run, schema))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, columns of any names
    unchanged."""
    plain, names, back = aside(docs)
    scored = score_quality(plain, model, tuple(plain.columns), into="_dq_score", text=names["text"])
    return scored.where(F.col("_dq_score") >= threshold).select(*back)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample, prior = training_sample(docs, labels)
    return train(sample, prior)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model fitted on the labelled rows that are not held out, and its score of every row of
    ``documents``; a null doc_id is held out, null texts score as empty."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
