import hashlib
import random
import re

from docquarry.llm import secrets
from tests.llm import cases

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def linked(text: str) -> list[tuple[int, int, int]]:
    """Every part against every other."""
    parts = base(text)
    parts += [(m.start(), 3, m.end()) for m in re.finditer(secrets.LOGIN, text)]
    parts += [
        (m.start(), 4, m.end())
        for m in re.finditer(secrets.RANDOM, text)
        if all(re.search(p, m[0]) for p in ("[0-9]", "[a-z]", "[A-Z]"))
    ]
    parts += [(m.start(), 5, m.end()) for m in re.finditer(secrets.ENDPOINT, text) if len(m[0]) >= 10]
    role = [k[4] for k in secrets.KINDS]

    def near(x, name):
        # parts before it in (start, kind) order reach it by their end, later ones by their start
        return any(
            role[y[1]] == name and ((x[0] - y[2] if (y[0], y[1]) < (x[0], x[1]) else y[0] - x[2]) <= secrets.SCOPE_CHARS)
            for y in parts
            if y is not x
        )

    kept = []
    for x in parts:
        if x[1] < 3 or (x[1] == 3 and near(x, "secret")) or (x[1] == 4 and (near(x, "id") or near(x, "endpoint"))):
            kept.append(x)
        elif x[1] == 5 and near(x, "id") and near(x, "secret"):
            kept.append(x)
    return sorted(kept)


def random_texts(count: int = 150) -> list[str]:
    rng = random.Random(5)
    bits = [
        "password=", "Token : '", "api_key\": \"", "secret", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef", "deadbeef", "aB3+/xYz9Qw2LmN0pR5t",
        "user: ", "bob.smith", "https://", "db.example.com/x", " ", "\n", "é", "💡", "plain words here ", "=", ":", "x" * 150, "client_id=abc-12", "longvalue1",
    ]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(count)]


def test_spans_equal_brute_force(spark):
    texts = random_texts()
    docs = cases.frame(spark, texts)
    got = {}
    for r in secrets.scan_secrets(docs).where("doc_id IS NOT NULL").collect():
        got.setdefault(r["doc_id"], []).append([(s["start"], s["rank"], s["end"]) for s in r["found"]])
    wanted = {}
    for r in cases.rows(texts):
        if r[0] is not None:
            wanted.setdefault(r[0], []).append(linked(r[1] or ""))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}
    assert any(s[1] > 2 for v in got.values() for spans in v for s in spans)
    assert secrets.scan_secrets(docs).count() == docs.count()


def test_weak_parts_need_their_complements(spark):
    secret, apart = "Zk8+Qm3LpX0aRt5YwB7e", " filler" * 60
    docs = spark.createDataFrame(
        [(1, f"client_id=abc {secret}"), (2, secret), (3, f"client_id=abc {apart} {secret}"), (4, f"https://h.example.com user: bob {secret}")],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: [s["rank"] for s in r["found"]] for r in secrets.scan_secrets(docs).collect()}
    assert got == {1: [3, 4], 2: [], 3: [], 4: [5, 3, 4]}


def test_contract_columns_and_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "token = abcdefgh1"), (2, None)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in secrets.op2_scan_secrets(spark, str(tmp_path)).collect()}
    assert (got[1]["n_assign"], got[1]["spans"]) == (1, "assign:0:17")
    assert got[1]["base_sha256"] == hashlib.sha256(b"assign:0:17").hexdigest()
    assert (got[2]["spans"], got[2]["base_sha256"]) == ("", hashlib.sha256(b"").hexdigest())
    assert secrets.scan_secrets(cases.empty(spark)).count() == 0


def test_planted_credentials(spark):
    """Weak parts beside what completes them are told; the same parts alone, or too
    far away, are not."""
    import random

    rng = random.Random(5)
    chars = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"
    told, total, texts = set(), 0, []
    for k in range(400):
        key = "".join(rng.choice(chars) for _ in range(26)) + "aZ7"
        login, url = f"client_id: user{k:04d}", f"https://api{k}.example.net/v1"
        access = "AKIA" + "".join(rng.choice("ABCDEFGHIJ0123456789") for _ in range(16))
        far = " plain words only" * 20
        parts = [
            [(login, True), (key, True)],
            [(access, False), (key, True), (url, True)],
            [(url, False), (far, False), (login, False)],
            [(login, False)],
            [(key, False)],
            [(key, False), (far, False), (login, False)],
        ][k % 6]
        text = "some words before "
        for part, complete in parts:
            if complete:
                told.add((k, len(text), len(text) + len(part)))
            total += part in (login, key, url)
            text += part + " and "
        texts.append((k, text))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    weak = {(r["doc_id"], s["start"], s["end"]) for r in secrets.scan_secrets(docs).collect() for s in r["found"] if s["rank"] >= len(secrets.BASE)}
    print(f"weak parts {total}, completed {len(told)}, told {len(weak)}, right {len(weak & told)}")
    assert weak == told and len(told) > 250 and total > 600
