import zlib

import numpy as np

from docquarry.llm import quality
from tests.llm import cases


def corpus(count: int = 400):
    import random

    rng = random.Random(1)
    docs, labels = [], []
    for i in range(count):
        good = i % 3 > 0
        text = cases.prose(rng, rng.randrange(5, 200))
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split())
        docs.append((i, text))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(d, lab)
    scores = {r["doc_id"]: r["score"] for r in quality.score_quality(d, model).collect()}
    told = [(scores[i] >= quality.THRESHOLD) == bool(q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(told) > 50 and np.mean(told) > 0.95


def test_held_out_labels_teach_nothing(spark):
    docs, labels = corpus(60)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    kind = "doc_id long, quality int, toxic int"
    a = quality.training_sample(d, spark.createDataFrame(labels, kind))
    assert a == quality.training_sample(d, spark.createDataFrame(flipped, kind))


def test_network_equals_direct_convolution():
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=(4, 256, quality.FILTERS)), rng.normal(size=quality.FILTERS), rng.normal(size=2 * quality.FILTERS), 0.1)
    data = rng.integers(0, 256, 1500, dtype=np.uint8).tobytes()
    chunks = quality.chunks_of(data)
    rows = []
    for c in chunks:
        out = [sum(model.weights[k, c[p + k]] for k in range(4)) for p in range(len(c) - 3)]
        rows.append(np.maximum(np.max(out, axis=0) + model.bias, 0))
    z = np.concatenate([np.mean(rows, axis=0), np.max(rows, axis=0)]) @ model.out + model.offset
    got = quality.combine(quality.pooled(chunks, model.tables(), model.bias), np.array([0]), model)
    assert np.allclose(got, 1 / (1 + np.exp(-z)), atol=1e-4)


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(3)
    model = quality.Model(rng.normal(0, 0.4, (4, 256, quality.FILTERS)), rng.normal(0, 0.2, quality.FILTERS), rng.normal(size=2 * quality.FILTERS), 0.0)
    chunks = np.concatenate([quality.chunks_of(rng.integers(0, 256, n, dtype=np.uint8).tobytes()) for n in (300, 900, 1500)])
    starts, labels, weight = np.array([0, 1, 3]), np.array([1.0, 0.0, 1.0]), np.array([0.7, 1.3, 1.0])
    loss = lambda offset=0.2: quality.gradients(model, offset, chunks, starts, labels, weight)
    base, slopes = loss()
    step = 1e-3  # filters are summed in single precision
    for values, slope in zip((model.weights, model.bias, model.out), slopes, strict=False):
        flat, steepest = values.reshape(-1), np.argsort(-np.abs(slope.reshape(-1)))
        for k in steepest[:12]:
            was = flat[k]
            flat[k] = was + step
            above = loss()[0]
            flat[k] = was - step
            below = loss()[0]
            flat[k] = was
            # where a maximum changes hands within a step, the slope is that of one side
            sides = np.array([(above - below) / 2, above - base, base - below]) / step
            assert np.isclose(sides, slope.reshape(-1)[k], rtol=0.05, atol=2e-3).any()
    assert np.isclose((loss(0.2 + step)[0] - loss(0.2 - step)[0]) / (2 * step), slopes[3][0], rtol=1e-3)


def test_all_chunks_of_long_texts_are_learned_from(spark):
    d = spark.createDataFrame([(i, chr(97 + i) * 60_000) for i in range(5)], "doc_id long, text string")
    sample, _ = quality.training_sample(d, spark.createDataFrame([(i, i % 2, 0) for i in range(5)], "doc_id long, quality int, toxic int"))
    assert sample and all(len(chunks) == len(quality.chunks_of(b"x" * 60_000)) for chunks, _ in sample)


def test_chunks_cover_everything():
    step = quality.CHUNK - quality.OVERLAP
    for n in [0, 1, 63, 64, 65, 511, 512, 513, 960, 961, 5000]:
        data = bytes(i % 251 + 1 for i in range(n))
        chunks = quality.chunks_of(data)
        whole = chunks[0].tobytes() + b"".join(c[quality.OVERLAP :].tobytes() for c in chunks[1:])
        assert whole[:n] == data and not any(whole[n:]) and len(chunks) == max(1, -(-(n - quality.OVERLAP) // step))


def test_awkward_rows_and_missing_labels(spark):
    docs, labels = cases.frame(spark), spark.createDataFrame([(0, 1, 0), (None, 0, 0), (1, None, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    assert model.constant is not None
    assert quality.score_quality(docs, model, tuple(docs.columns), into="_dq_score").count() == docs.count()
    real, lab = corpus(60)
    model = quality.fit(spark.createDataFrame(real, "doc_id long, text string"), spark.createDataFrame(lab, "doc_id long, quality int, toxic int"))
    rows = quality.score_quality(docs, model, ("doc_id", "text")).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert quality.score_quality(cases.empty(spark), model).count() == 0
    assert quality.fit(cases.empty(spark), labels.limit(0)).constant == 0.5
