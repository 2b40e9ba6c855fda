import random
import re
from collections import defaultdict

import corpus_pipeline
from docquarry.llm import quality
from docquarry.llm.common import written
from tests.llm import cases
from tests.llm.test_mixing import WORD, reshared
from tests.llm.test_neardup import classes
from tests.llm.test_pii import brute as personal


def inputs(spark, path):
    rng = random.Random(12)
    texts, labels = [], []
    item = cases.prose(rng, 30)
    for i in range(260):
        text = cases.prose(rng, rng.randrange(20, 120))
        if i % 3 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif i % 11 == 0:
            text += " " + item
        elif i % 10 == 1:
            text += f" write to someone{i}@mail.example.org or +1 (319) 555-{1000 + i}"
        elif i % 13 == 0 and i > 20:
            text = texts[i - 13] if i % 2 else texts[i - 13] + " more"
        texts.append(text)
        labels.append((i, int(i % 3 > 0), 0))
    rows = [(i, t, "en", f"s{i % 4 % 3}", len(t)) for i, t in enumerate(texts)] + [(900, None, None, None, None), (901, "", None, None, 0)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return item


def test_stages_do_what_plain_python_does(spark, tmp_path):
    item, path = inputs(spark, str(tmp_path)), str(tmp_path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    after = [{r["doc_id"]: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, path), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        found = docs.collect()
        after.append({r["doc_id"]: r for r in found})
        assert len(after[-1]) == len(found)
    start, good, single, clean, safe = after
    shouted = {i for i in start if i < 900 and i % 3 == 0}
    assert len(set(start) - set(good) - shouted) <= 2 and len(shouted & set(good)) <= 2
    ids = sorted(good)
    groups = classes([(i, good[i]["text"]) for i in ids])
    assert set(single) == {c for c, _ in groups.values()} and len(single) < len(good)
    words = re.findall(r"[a-z]+|[0-9]+", item)
    text_of = lambda i: re.findall(r"[a-z]+|[0-9]+", (single[i]["text"] or "").lower())
    runs = {tuple(words[k : k + 13]) for k in range(len(words) - 12)}
    assert set(clean) == {i for i in single if not any(tuple(text_of(i)[k : k + 13]) in runs for k in range(len(text_of(i))))}
    assert set(clean) < set(single)
    assert set(safe) == set(clean)
    for i, r in safe.items():
        text = clean[i]["text"]
        spans = personal(text or "")
        if not spans:
            assert r == clean[i]
        else:
            assert r["n_chars"] == len(r["text"]) and not personal(r["text"]) and "[EMAIL] or [PHONE]" in r["text"]
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    copies, sizes = defaultdict(set), defaultdict(int)
    for r in mixed:
        copies[r["doc_id"]].add(r["copy"])
        assert r["text"] == safe[r["doc_id"]]["text"]
    for r in safe.values():
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    target = reshared(sizes)
    for i, r in safe.items():
        rate = target[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert len(copies[i]) in (int(rate), int(rate) + 1) and copies[i] == set(range(len(copies[i])))
    whole = sorted(map(tuple, corpus_pipeline.run(spark, path).collect()), key=repr)
    assert whole == sorted(map(tuple, mixed), key=repr)
    assert quality.THRESHOLD == 0.3


def test_stages_take_awkward_and_no_rows(spark, tmp_path):
    inputs(spark, str(tmp_path))
    for docs in (cases.frame(spark), cases.empty(spark)):
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = written(stage(spark, docs, str(tmp_path)), "test-stage")
            assert docs.columns == columns + ["mix_copy"] * (k == 4)
