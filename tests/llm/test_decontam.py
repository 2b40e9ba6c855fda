import random

from docquarry.llm import decontam
from tests.llm import cases


def items():
    rng = random.Random(9)
    return [
        (1, "If Anna buys 12 apples for 30 dollars and gives 12 of them to Peter, how many apples does Anna keep for herself"),
        (2, cases.prose(rng, 40)),
        (3, "five short words are here"),
        (4, "no"),
        (5, None),
        (2, None),
        (6, cases.prose(rng, 30)),
    ]


def find(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items(), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in decontam.find_leaks(docs, bench).collect()}


def test_leaks(spark):
    rng = random.Random(4)
    around, whole, other = cases.prose(rng, 60), items()[1][1], items()[6][1]
    told = items()[0][1]
    part = " ".join(other.split()[5:22])
    texts = [
        told,
        f"{around} {told.lower()} {around}",
        told.replace("12", "57").replace("30", "141").replace("Anna", "Clara").replace("Peter", "Boris"),
        told.replace("12", "57", 1).replace("12", "88").replace("Peter", "Boris"),  # equal numbers became different ones
        f"{around} {whole.upper()}",
        f"{around}\n{part}",
        " ".join(other.split()[:6]),  # too little of it
        around,
        "well, five short words are here today",
        "5 6 7 8 9 10 11 12 13 14 15 16 17 18",
        "no",
        None,
    ]
    assert find(spark, texts) == {
        (0, 1): "exact", (1, 1): "exact", (2, 1): "reparameterised", (4, 2): "exact", (5, 6): "exact", (8, 3): "exact",
    }


def test_verbatim_leaks_equal_brute_force(spark):
    """Any thirteen tokens in a row, without the templates."""
    rng = random.Random(11)
    bench = items()
    words = [decontam._TOKEN.findall((t or "").lower()) for _, t in bench]
    texts = []
    for _ in range(120):
        w = rng.choice(words)
        a, n = rng.randrange(max(1, len(w))), rng.randrange(30)
        texts.append(cases.prose(rng, 20) + " " + " ".join(w[a : a + n]) + " " + cases.prose(rng, 20))
    wanted = set()
    for d, t in enumerate(texts):
        tokens = decontam._TOKEN.findall(t.lower())
        for (i, _), w in zip(bench, words, strict=True):
            n = min(decontam.COVERED, len(w))
            if n >= decontam.SHORTEST and any(tokens[p : p + n] == w[q : q + n] for p in range(len(tokens) - n + 1) for q in range(len(w) - n + 1)):
                wanted.add((d, i))
    assert set(find(spark, texts)) == wanted and len(wanted) > 20


def test_awkward_rows(spark):
    docs = cases.frame(spark, [items()[1][1], "x " + items()[1][1]])
    bench = spark.createDataFrame([i + ("a", 1) for i in items()], "item_id long, text string, h string, pos int")
    leaks = decontam.find_leaks(docs, bench).collect()
    assert {r["doc_id"] for r in leaks} == {11, 12}
    kept = decontam.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert decontam.find_leaks(cases.empty(spark), bench).count() == 0
    assert decontam.drop_leaks(docs, bench.limit(0)).count() == docs.count()


def leaks(spark, texts, *wanted):
    """The kind by number of the text and of the item."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(list(enumerate(wanted)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in decontam.find_leaks(docs, bench).collect()}


def test_any_one_occurrence_decides(spark):
    train = "A train travels {} km in {} hours and then another {} km in {} hours how far did it go in total"
    item, variant, other = train.format(60, 2, 60, 3), train.format(80, 5, 90, 4), train.format(70, 5, 70, 6)
    cut = " and then by the way ".join(other.split(" and then "))
    texts = [f"{variant}. {item}", f"{item}. {variant}", f"{variant}. {other}", f"{other}. {variant}", f"{variant}. {cut}", variant, f"{variant}. {variant}"]
    assert leaks(spark, texts, item) == {
        (0, 0): "exact", (1, 0): "exact", (2, 0): "reparameterised", (3, 0): "reparameterised", (4, 0): "reparameterised",
    }


def test_number_heavy_items_as_they_are(spark):
    sums = ["What is 3 + 4 + 5 + 6 + 7 + 8 + 9 + 10 + 11", "Compute 12 * 7 - 30 / 5 + 18 - 4 * 9 = 48", "12 34 56 78"]
    edge = "1 2 3 4 5 6 7 and so the sum of all is even"
    texts = [*sums, f"so: {sums[0].upper()} ?", f"{sums[1]}\n{sums[2]}", edge, sums[0].replace("11", "12"), sums[1].replace("7", "8"), "12 34 56 79"]
    assert leaks(spark, texts, *sums, edge) == {(0, 0): "exact", (1, 1): "exact", (2, 2): "exact", (3, 0): "exact", (4, 1): "exact", (4, 2): "exact", (5, 3): "exact"}


def aligned(text, item):
    """The kind by brute force: the item is laid over every place of the text, and
    windows of eight tokens that agree there, as they are or but for numbers and
    names, must cover thirteen."""
    words, wanted = decontam._TOKEN.findall(text), decontam._TOKEN.findall(item)
    n, best = len(wanted), None
    for a in range(len(words) - n + 1):
        pairs = list(zip(words[a : a + n], wanted))
        same = [x.lower() == y.lower() for x, y in pairs]
        number = [x[0].isdigit() and y[0].isdigit() for x, y in pairs]
        name = [x.istitle() and y.istitle() for x, y in pairs]
        unit = [k > 0 and number[k - 1] and same[k] and pairs[k][0].lower() in decontam.UNITS for k in range(n)]
        shaped = set()
        for slots in (number, [p or q for p, q in zip(number, name)]):
            for k in range(n - 7):
                at = range(k, k + 8)
                if all(slots[i] or same[i] for i in at) and sum(not slots[i] and not unit[i] for i in at) >= 4:
                    shaped |= {(i, slots is number) for i in at}
        as_is = {i for k in range(n - 7) if all(same[k : k + 8]) for i in range(k, k + 8)}
        if len(as_is) >= min(13, n):
            return "exact"
        places = {i for i, _ in shaped}
        held = {(pairs[i][1].lower(), pairs[i][0].lower()) for i in places if number[i] or name[i] and (i, False) in shaped}
        if len(places) >= min(13, n) and len({y for y, _ in held}) == len(held):
            best = "reparameterised"
    return best


def test_reparameterised_items_equal_brute_force(spark):
    rng = random.Random(17)
    told = [
        "if Anna buys {} ripe apples for {} dollars and then gives {} of them to Peter how many does Anna keep",
        "a slow train leaves town with {} people and takes on {} more at each of {} stops how many arrive",
    ]
    items = [told[0].format(12, 30, 12), told[1].format(40, 7, 5)]
    texts = []
    for _ in range(90):
        parts = [cases.prose(rng, rng.randrange(12, 30))]
        for _ in range(rng.choice([1, 1, 2])):
            k = rng.randrange(2)
            same = rng.randrange(100, 999)
            values = rng.choice([(12, 30, 12), (40, 7, 5), (same, 88, same), (same, 88, 77), (3, 4, 5)])
            one = told[k].format(*values)
            if rng.random() < 0.4:
                other = rng.choice(["Clara", "Boris"])
                one = one.replace("Anna", other, rng.choice([1, 2, 2]))
            parts += [one, cases.prose(rng, rng.randrange(12, 30))]
        texts.append(" ".join(parts))
    wanted = {(d, i): k for d, t in enumerate(texts) for i, item in enumerate(items) if (k := aligned(t, item))}
    got = leaks(spark, texts, *items)
    assert got == wanted
    kinds = list(wanted.values())
    assert kinds.count("exact") > 10 and kinds.count("reparameterised") > 10 and len(wanted) < 2 * len(texts)
