"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles.  MinHash bands tie a text to the least
text of each of its buckets, so candidates form components without any bucket
being expanded into pairs.  A component, or each bucket of one that hangs
together by chains only, is worked on in blocks: all pairs of two blocks are
compared by their MinHash values a few at a time, a pair is dropped once the
posterior probability that its similarity reaches the threshold falls below a
tolerance, and the pairs left are verified exactly on their shingles.  A pair
counts if it shares a band, and once.  Only counts of links and a spanning
forest leave a block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import aside, in_arrow, table, text_of, written
from docquarry.llm.graph import star_components
from docquarry.llm.hashing import WordHashes, bit_filter, in_filter, mix, signed, windows

SHINGLE = 5
#: Similarity of 4/5 or more, as a fraction so that the test is exact.
TOP, BOTTOM = 4, 5
#: A pair at the threshold shares no band with probability 5e-6.
BANDS, ROWS = 40, 6
STEP = 24
TOLERANCE = 1e-9
BLOCK_DOCS = 512
BLOCK_SHINGLES = 400_000
#: Texts of one task remembered as already emitted; more are emitted again.
KEYS_KEPT = 50_000

_WORD = re.compile(r"\w+")


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles of the words in lower case; a text
    of one to four words is one shingle, one without words has none."""
    words = hashes.of(_WORD.findall(text.lower()))
    if not len(words):
        return words
    return np.unique(windows(words, min(SHINGLE, len(words))))


def _family(count: int = BANDS * ROWS) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return seeds[:count, None].astype(np.uint32), (mix(seeds[count:, None]) | np.uint64(1)).astype(np.uint32)


_XOR, _TIMES = _family()


def minhash(found: np.ndarray, block: int = 4096) -> np.ndarray:
    """BANDS * ROWS least hashes of a set, of 32 bits; verification uses all 64."""
    folded = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    least = np.full(len(_XOR), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(found), block):
        np.minimum(least, ((folded[None, at : at + block] ^ _XOR) * _TIMES).min(axis=1), out=least)
    return least


def band_hashes(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return total


def least_matches(threshold: float = TOP / BOTTOM, tolerance: float = TOLERANCE, step: int = STEP, most: int = BANDS * ROWS) -> dict[int, int]:
    """After m compared values, the least number of matches with which the
    posterior of similarity >= threshold (flat prior) is not below tolerance."""
    s = (np.arange(20_000) + 0.5) / 20_000
    needed = {}
    for m in range(step, most + 1, step):
        for k in range(m + 1):
            log = k * np.log(s) + (m - k) * np.log1p(-s)
            density = np.exp(log - log.max())
            if density[s >= threshold].sum() >= tolerance * density.sum():
                needed[m] = k
                break
    return needed


_NEEDED = least_matches()


def linked_pairs(
    left: list[np.ndarray], right: list[np.ndarray] | None, first: np.ndarray | None = None, second: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs, one of each side (or both of ``left``), whose
    similarity reaches the threshold.  ``first`` and ``second`` are the MinHash
    values of the sides, worked out here if they are not given."""
    if first is None:
        first = np.stack([minhash(x) for x in left])
    if right is None:
        second = first
    elif second is None:
        second = np.stack([minhash(x) for x in right])
    others = left if right is None else right
    a, b = np.triu_indices(len(left), 1) if right is None else (x.ravel() for x in np.indices((len(left), len(right))))
    sizes_a = np.array([len(x) for x in left])
    sizes_b = np.array([len(x) for x in others])
    low, high = np.minimum(sizes_a[a], sizes_b[b]), np.maximum(sizes_a[a], sizes_b[b])
    fits = BOTTOM * low >= TOP * high
    a, b = a[fits], b[fits]
    matches = np.zeros(len(a), np.int32)
    for m in range(0, BANDS * ROWS, STEP):
        if not len(a):
            break
        part, other = np.ascontiguousarray(first[:, m : m + STEP]), np.ascontiguousarray(second[:, m : m + STEP])
        for at in range(0, len(a), 65_536):
            matches[at : at + 65_536] += (part[a[at : at + 65_536]] == other[b[at : at + 65_536]]).sum(axis=1, dtype=np.int32)
        alive = matches >= _NEEDED[m + STEP]
        a, b, matches = a[alive], b[alive], matches[alive]
    if not len(a):
        return a, b
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    keep = np.zeros(len(a), bool)
    heads = np.flatnonzero(np.diff(a, prepend=-1))
    for h, end in zip(heads, np.append(heads[1:], len(a)), strict=True):
        own = left[a[h]]
        for at in range(h, end, 512):
            stop = min(end, at + 512)
            sets = [others[k] for k in b[at:stop]]
            values = np.concatenate(sets)
            spot = np.searchsorted(own, values)
            spot[spot == len(own)] = 0
            sizes = np.array([len(x) for x in sets])
            shared = np.add.reduceat((own[spot] == values).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            keep[at:stop] = (TOP + BOTTOM) * shared >= TOP * (sizes + len(own))
    return a[keep], b[keep]


def _roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each one's component."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _text_key(text: str) -> bytes:
    return hashlib.md5(text.encode(), usedforsecurity=False).digest()


def _band_table(docs: DataFrame) -> DataFrame:
    """``key`` (MD5 of the text) and ``bands``, a row per text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            keys, bands = [], []
            for text in batch.column(0):
                text = text.as_py()
                key = _text_key(text)
                if key in seen:
                    continue
                if len(seen) >= KEYS_KEPT:
                    seen.clear()
                seen.add(key)
                found = shingles(text, hashes)
                if len(found):
                    keys.append(key)
                    bands.append(signed(band_hashes(minhash(found))))
            if keys:
                values = pa.array(np.concatenate(bands))
                offsets = pa.array(np.arange(0, len(values) + 1, BANDS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.ListArray.from_arrays(offsets, values)], ["key", "bands"])

    return written(docs.select(text_of()).transform(in_arrow(run, "key binary, bands array<long>")).dropDuplicates(["key"]), "near-bands")


def _stars(bands: DataFrame) -> DataFrame:
    """``key``, ``bucket``, ``center`` (the least text in it) and ``size`` for each
    bucket of several texts and each text in it, the center too."""
    flat = bands.select("key", F.explode("bands").alias("bucket"))
    shared = written(
        flat.groupBy("bucket")
        .agg(F.min("key").alias("center"), F.max("key").alias("other"), F.count(F.lit(1)).alias("size"))
        .where("center <> other")
        .drop("other"),
        "near-buckets",
    )
    return written(flat.join(shared, "bucket").select("key", "bucket", "center", "size"), "near-stars")


def _units(stars: DataFrame, components: DataFrame) -> DataFrame:
    """``unit`` and ``key``: what has to be compared with each other.

    A component whose texts mostly share buckets is one unit, which compares each
    pair once.  Where a component hangs together by chains, so that its buckets
    have fewer pairs than all its texts, each bucket is a unit.  Either way the
    pairs that share a bucket are found, and no others.
    """
    weight = stars.groupBy("key").agg(F.sum("size").alias("pairs"))
    sized = weight.join(components, weight["key"] == components["node"])
    many = sized.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("pairs").alias("pairs"))
    how = written(many.select(F.col("component").alias("of"), (2 * F.col("pairs") < F.col("n") * F.col("n")).alias("chained")), "near-how")
    placed = components.join(how, components["component"] == how["of"])
    whole = placed.where("NOT chained").select(F.col("component").alias("unit"), F.col("node").alias("key"))
    chained = stars.join(placed.where("chained").select("node"), stars["key"] == F.col("node"), "left_semi")
    return whole.unionByName(chained.select(F.unhex(F.lpad(F.hex("bucket"), 16, "0")).alias("unit"), "key"))


def _shingle_table(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``key``, ``copies``, ``values`` (MinHash) and ``shingles`` of the texts in
    ``groups`` (``node``, ``copies``)."""
    head = F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long")
    packed = bit_filter(groups.select(head.alias("h")), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            keys, sets, held = [], [], 0

            def out() -> pa.RecordBatch:
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(signed(np.concatenate(sets))))
                values = [minhash(s).tobytes() for s in sets]
                return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.binary()), lists], ["key", "values", "shingles"])

            for text in batch.column(0):
                text = text.as_py()
                key = _text_key(text)
                if key in seen or not in_filter(packed, np.array([int.from_bytes(key[:8], "big")], np.uint64))[0]:
                    continue
                if len(seen) >= KEYS_KEPT:
                    seen.clear()
                seen.add(key)
                found = shingles(text, hashes)
                if len(found):
                    keys.append(key), sets.append(found)
                    held += len(found)
                if held > 1_000_000:
                    yield out()
                    keys, sets, held = [], [], 0
            if keys:
                yield out()

    found = docs.select(text_of()).transform(in_arrow(run, "key binary, values binary, shingles array<long>"))
    joined = found.join(groups.select(F.col("node").alias("key"), "copies"), "key").dropDuplicates(["key"])
    return written(joined.select("key", "copies", "values", "shingles"), "near-shingles")


def _block_links(sets: DataFrame, units: DataFrame) -> DataFrame:
    """``key``, ``links`` (documents of other texts it is similar to) and
    ``root`` (a text it hangs together with), per text and pair of blocks."""
    members = written(units.join(sets.select("key", F.size("shingles").alias("s")), "key"), "near-members")
    sized = members.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s")).where("n > 1")
    blocks = sized.select("unit", F.ceil(F.greatest(F.col("n") / BLOCK_DOCS, F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = (
        members.join(blocks, "unit")
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("unit", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "key")
        .join(sets, "key")
        .select("unit", "i", "j", "own", "key", "copies", "values", "shingles")
    )
    ordered = dealt.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")

    def solve(group: tuple, members: list[tuple]) -> Iterator[tuple[bytes, int, bytes]]:
        unit, i, j = group
        if i == j:
            kept = members
        else:
            kept = [m for m in members if m[0] == i]
            middle = len(kept)
            kept += [m for m in members if m[0] == j]
            if not 0 < middle < len(kept):
                return
        values = np.stack([np.frombuffer(m[3], np.uint32) for m in kept])
        if i == j:
            a, b = linked_pairs([m[4] for m in kept], None, values)
        else:
            a, b = linked_pairs([m[4] for m in kept[:middle]], [m[4] for m in kept[middle:]], values[:middle], values[middle:])
            b = b + middle
        if not len(a):
            return
        bands = np.stack([band_hashes(v) for v in values])
        counts = np.empty(len(a), bool)
        for at in range(0, len(a), 65_536):
            one, two = a[at : at + 65_536], b[at : at + 65_536]
            shared = bands[one] == bands[two]
            first = shared.argmax(axis=1)
            # a bucket counts the pairs whose first shared bucket it is
            wanted = shared.any(axis=1) if len(unit) > 8 else bands[one, first] == np.uint64(int.from_bytes(unit, "big"))
            counts[at : at + 65_536] = wanted & shared[np.arange(len(one)), first]
        a, b = a[counts], b[counts]
        copies = np.array([m[2] for m in kept])
        links = np.zeros(len(kept), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        root = _roots(len(kept), a, b)
        for k in np.flatnonzero(links):
            yield kept[k][1], int(links[k]), kept[root[k]][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members = None, []

        def out(rows: list) -> Iterator[pa.RecordBatch]:
            if rows:
                keys, links, roots = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(links, pa.int64()), pa.array(roots, pa.binary())], ["key", "links", "root"]
                )

        for batch in batches:
            heads = list(zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True))
            lists = batch.column(7)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            for k, (unit, i, j, own, key, copies, least) in enumerate(heads):
                group = (unit, i, j)
                if group != current:
                    if current is not None and len(members) > 1:
                        yield from out(list(solve(current, members)))
                    current, members = group, []
                members.append((own, key, copies, least, values[offsets[k] : offsets[k + 1]].copy()))
        if current is not None and len(members) > 1:
            yield from out(list(solve(current, members)))

    return written(ordered.transform(in_arrow(run, "key binary, links long, root binary")), "near-links")


def similar_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``classes`` (``key``, ``class_key``) of the texts that have a similar
    other text, and ``links`` (``key``, ``links``)."""
    counted = docs.groupBy(F.unhex(F.md5(text_of())).alias("node")).agg(F.count(F.lit(1)).alias("copies"))
    stars = _stars(_band_table(docs))
    components = written(star_components(stars.select(F.col("key").alias("node"), "center")), "near-components")
    groups = written(components.join(counted, "node").select("node", "copies"), "near-groups")
    links = _block_links(_shingle_table(docs, groups), _units(stars, components))
    classes = star_components(links.select(F.col("key").alias("node"), F.col("root").alias("center")))
    return (
        classes.select(F.col("node").alias("key"), F.col("component").alias("class_key")),
        links.groupBy("key").agg(F.sum("links").alias("links")),
    )


def _with_classes(docs: DataFrame, classes: DataFrame, columns: list[str]) -> DataFrame:
    keyed = docs.select(*columns, F.unhex(F.md5(text_of())).alias("_dq_key"))
    return keyed.join(classes.withColumnRenamed("key", "_dq_own"), F.col("_dq_key") == F.col("_dq_own"), "left").select(
        *columns, "_dq_key", F.coalesce("class_key", "_dq_key").alias("_dq_class")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` and ``n_links`` for every row.

    Documents are linked if their texts are equal or their shingle sets have a
    Jaccard similarity of 4/5 or more; classes are the connected components and
    are named by their least doc_id (null if all ids are null); ``n_links``
    counts the other rows linked to one.  Null texts count as empty; texts
    without words are linked to equal texts only.  Repeated rows and ids are
    separate documents.  Columns besides doc_id and text are not read.  Very long
    texts are worked on whole; the shingles of a text must fit a task twice.
    """
    classes, links = similar_texts(docs)
    classed = _with_classes(docs, classes, ["doc_id"])
    per_text = classed.groupBy("_dq_class", "_dq_key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    per_class = per_text.groupBy("_dq_class").agg(F.min("least").alias("class_id"))
    facts = written(
        per_text.join(per_class, "_dq_class")
        .join(links.withColumnRenamed("key", "_dq_key"), "_dq_key", "left")
        .select(F.col("_dq_key").alias("_dq_fact"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")),
        "near-facts",
    )
    keyed = docs.select("doc_id", F.unhex(F.md5(text_of())).alias("_dq_key"))
    return keyed.join(facts, F.col("_dq_key") == F.col("_dq_fact")).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of the least doc_id (null last),
    among equal ids the least MD5 of the text, among equal rows any.  Columns may
    have any names."""
    classes, _ = similar_texts(docs)
    classed = _with_classes(docs, classes, ["doc_id"])
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_dq_key").alias("k"))
    best = classed.groupBy("_dq_class", "_dq_key", "doc_id").agg(F.count(F.lit(1)).alias("rows")).groupBy("_dq_class").agg(
        F.min_by(F.struct("doc_id", "_dq_key", "rows"), rank).alias("b")
    )
    chosen = written(best.select(F.col("b.doc_id").alias("_dq_id"), F.col("b._dq_key").alias("_dq_best"), F.col("b.rows").alias("_dq_rows")), "near-chosen")
    plain, names, back = aside(docs)
    keyed = plain.select("*", F.col(names["doc_id"]).alias("_dq_doc"), F.unhex(F.md5(text_of(names["text"]))).alias("_dq_key"))
    fits = (F.col("_dq_key") == F.col("_dq_best")) & F.col("_dq_doc").eqNullSafe(F.col("_dq_id"))
    single = keyed.join(chosen.where("_dq_rows = 1"), fits, "left_semi")
    repeated = keyed.join(chosen.where("_dq_rows > 1"), fits, "left_semi").dropDuplicates(["_dq_key"])
    return single.unionByName(repeated).select(*back)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_duplicates`` of ``documents``, a row per row; nulls, empty texts and repeated rows as
    there."""
    return near_duplicates(table(spark, sf_dir, "documents"))
