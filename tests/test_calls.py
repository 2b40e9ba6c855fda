"""Calls at a pace, several at a time, and each once."""

import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from docquarry.sources import calls, extractors


def test_a_bucket_keeps_its_pace():
    now, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    pace = calls.Pace(10, burst=3, clock=lambda: now[0], sleep=sleep)
    for _ in range(23):
        pace.take()
    assert sum(slept) == pytest.approx(2.0) and len(slept) == 20
    now[0] += 60  # rest earns a burst, no more
    slept.clear()
    for _ in range(4):
        pace.take()
    assert len(slept) == 1


def test_calls_overlap_up_to_the_bound():
    running, most, lock = [0], [0], threading.Lock()

    def call():
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.05)
        with lock:
            running[0] -= 1
        return None, 200, "x"

    assert calls.ask_all([((k,), call, "m") for k in range(12)], concurrency=4) == [(None, 200, "x")] * 12
    assert 2 <= most[0] <= 4 and calls.ask_all([], 4) == []


def test_the_log_answers_for_the_service(tmp_path):
    log, asked = calls.ReplyLog(f"file://{tmp_path}/log"), Counter()

    def of(k):
        def call():
            asked[k] += 1
            if asked["fail"] and k == 3:
                raise RuntimeError("the task is lost")
            return None, 200, f"reply {k}"

        return call

    items = [((k, 0, 1, "prompt"), of(k), "m") for k in range(5)]
    asked["fail"] = 1
    with pytest.raises(RuntimeError, match="lost"):
        calls.ask_all(items, 1, log=log)
    asked["fail"] = 0
    assert [b for _, _, b in calls.ask_all(items, 3, log=log)] == [f"reply {k}" for k in range(5)]
    assert [asked[k] for k in range(5)] == [1, 1, 1, 2, 1]
    assert log.get((9, 0, 1, "prompt")) is None and log.get((0, 0, 2, "prompt")) is None


@pytest.fixture
def service():
    """Answers by the text and counts who asked for what."""
    seen, lock, most, running = Counter(), threading.Lock(), [0], [0]

    class Answers(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            text = asked["messages"][0]["content"]
            with lock:
                seen[(text, asked["metadata"]["trace_id"])] += 1
                running[0] += 1
                most[0] = max(most[0], running[0])
            time.sleep(0.02)
            with lock:
                running[0] -= 1
            content = {"choices": [{"message": {"content": {"blank": " ", "null": None}.get(text, '{"total_cents": 5}')}}]}
            bodies = {"page": "<html>proxy</html>", "bare": "{}", "none": '{"choices": []}', "flat": '{"choices": [{"message": "hello"}]}'}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(bodies.get(text, json.dumps(content)).encode())

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen, most
    server.shutdown()


def bare(text, hint):
    return text


def test_odd_replies_are_tried_again_and_empty_ones_are_not(spark, service):
    texts = ["page", "bare", "none", "flat", "blank", "null", "fine"]
    docs = spark.createDataFrame([(k, t, 0, 1) for k, t in enumerate(texts)], "doc_id long, source_text string, tier int, attempt int")
    made = extractors.ServiceExtractor(extractors.http_call(service[0], "key", 10), ["m"], bare)
    kinds = {r["source_text"]: r["error"] for r in made.extract(docs).collect()}
    assert kinds == {"page": "transient", "bare": "transient", "none": "transient", "flat": "transient", "blank": "refusal", "null": "refusal", "fine": None}
    # every call carries its document's trace
    assert set(service[1]) == {(t, str(k)) for k, t in enumerate(texts)}


def test_a_lost_task_asks_nothing_twice(spark, service, tmp_path):
    """The first attempt at a task fails behind its calls; local tasks are not tried
    again by Spark, so the action is."""
    url, seen, most = service
    docs = spark.createDataFrame([(k, f"text {k}", 0, 1) for k in range(40)], "doc_id long, source_text string, tier int, attempt int").repartition(2)
    made = extractors.ServiceExtractor(extractors.http_call(url, "key", 10), ["m"], bare, concurrency=8, log=f"file://{tmp_path}/log")
    told = made.extract(docs)
    broken = told.select(F.when(F.col("record.total_cents") == 5, F.raise_error(F.lit("executor lost"))).otherwise(F.col("doc_id").cast("string")))
    with pytest.raises(Exception, match="executor lost"):
        broken.collect()
    first = sum(seen.values())
    rows = told.collect()
    assert len(rows) == 40 and all(r["record"]["total_cents"] == 5 for r in rows) and 0 < first <= 40
    assert sum(seen.values()) == 40 and set(seen.values()) == {1} and most[0] > 2
    # the next attempt is another question
    made.extract(docs.withColumn("attempt", F.lit(2))).collect()
    assert set(seen.values()) == {2}
