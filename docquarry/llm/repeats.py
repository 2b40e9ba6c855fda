"""Removal of repeated byte strings by a distributed difference cover.

All 400-byte strings of the corpus that start in more than one place are found
the way a suffix array with a difference cover finds them, carried only as deep
as 400 bytes and asking for equality instead of order:

* Sample.  Every 400-byte string has one sampled position, the least of the
  hashed 8-grams in its first 256 places.  The choice depends on the string
  alone, so equal strings have their samples at equal offsets; that is what a
  difference cover provides, at one position in about 128.
* Name the sampled triples.  A sampled position stands for the run of strings
  that chose it.  Its triple is the block left of it, the core every one of
  those strings contains, and the block right of it; the names of core and
  triple are fingerprints.  Equal triples make all strings of both runs repeats;
  a core that is unique makes all strings of the run unique.
* Recurse on what names leave open: the runs that share a core but no triple
  are cut into parts of 32 strings, which again have a core and a name.
* Merge the remaining suffixes: strings of open parts are named one by one, and
  equal neighbours are repeats.

Fingerprints have 128 bits where they decide; those of 64 bits only select.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import in_arrow, table, text_of, written
from docquarry.llm.hashing import M1, bit_filter, in_filter, mix

LENGTH = 400
#: Places of a string in which its sample may lie, and bytes of a hashed gram.
REACH, GRAM = 256, 8
#: Strings of a part in the second round.
PART = 32
#: Bytes worked on at a time; below 2 ** 24.
PIECE = 1 << 20
_MASK = np.uint64((1 << 24) - 1)

_ROWS = "key binary, anchor int, first int, last int, core long, name binary, id long"


def sample_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts (first, last) with one sample, and the sample.

    ``data`` holds texts one after another; strings across them do not count.
    """
    n = len(data)
    count = -(-(n + REACH) // REACH) * REACH
    padded = np.zeros(count + REACH + GRAM, np.uint8)
    padded[:n] = data
    grams = np.empty(count + REACH, np.uint64)
    for k in range(GRAM):
        part = grams[k::GRAM]
        part[:] = np.frombuffer(padded.data, np.uint64, len(part), k)
    keyed = (mix(grams * M1) & ~_MASK) | np.arange(len(grams), dtype=np.uint64)
    blocks = keyed.reshape(-1, REACH)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[REACH - 1 : REACH - 1 + count])
    sample = (least & _MASK).astype(np.int64)
    long_enough = lengths >= LENGTH
    edge = np.zeros(count + 1, np.int32)
    np.add.at(edge, starts[long_enough], 1)
    np.add.at(edge, starts[long_enough] + lengths[long_enough] - LENGTH + 1, -1)
    valid = np.flatnonzero(np.cumsum(edge)[:count])
    if not len(valid):
        return (np.empty(0, np.int64),) * 3
    of = sample[valid]
    begins = np.zeros(len(valid), bool)
    begins[0] = True
    begins[1:] = (np.diff(of) != 0) | (np.diff(valid) != 1)
    begins[np.searchsorted(valid, starts[long_enough])] = True
    heads = np.flatnonzero(begins)
    tails = np.append(heads[1:], len(valid)) - 1
    return valid[heads], valid[tails], of[heads]


def _key(data: bytes) -> bytes:
    return hashlib.md5(data, usedforsecurity=False).digest()


def _id(key: bytes, *numbers: int) -> int:
    return xxhash.xxh3_64_intdigest(key + np.array(numbers, "<i8").tobytes()) - (1 << 63)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
    names = ["key", "anchor", "first", "last", "core", "name", "id"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _core_hash(view: memoryview, start: int, end: int) -> int:
    return xxhash.xxh3_64_intdigest(view[start:end]) - (1 << 63)


def _samples(docs: DataFrame) -> DataFrame:
    """The sampled triples of all texts; a row per sample."""
    core_bytes = LENGTH - REACH + 1

    def triples(texts: list[tuple[bytes, bytes, int]]) -> Iterator[tuple]:
        """``texts``: key, bytes, and where in its text this piece begins."""
        starts = np.concatenate([[0], np.cumsum([len(t) for _, t, _ in texts])[:-1]])
        lengths = np.array([len(t) for _, t, _ in texts])
        joined = b"".join(t for _, t, _ in texts)
        first, last, sample = sample_runs(np.frombuffer(joined, np.uint8), starts, lengths)
        owner = np.searchsorted(starts, first, side="right") - 1
        view = memoryview(joined)
        heads = np.empty((len(first), 3), "<i8")
        shift = np.array([s for _, _, s in texts])[owner] - starts[owner]
        heads[:, 0], heads[:, 1], heads[:, 2] = sample + shift, first + shift, last + shift
        for o, f, l, s, (anchor, p1, p2) in zip(
            owner.tolist(), first.tolist(), last.tolist(), sample.tolist(), heads.tolist(), strict=True
        ):
            key = texts[o][0]
            yield (
                key,
                anchor,
                p1,
                p2,
                _core_hash(view, s, s + core_bytes),
                xxhash.xxh3_128_digest(view[f : l + LENGTH]),
                xxhash.xxh3_64_intdigest(key, anchor + (p1 << 32)) - (1 << 63),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def out() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in triples(held):
                rows.append(row)
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

        for batch in batches:
            for text in batch.column(0):
                data = text.as_py().encode()
                if len(data) < LENGTH:
                    continue
                key = _key(data)
                if key in seen:
                    continue
                if len(seen) >= 50_000:
                    seen.clear()
                seen.add(key)
                for at in range(0, len(data) - LENGTH + 1, PIECE):
                    # a piece owns PIECE string starts, with the bytes of its last string and sample
                    held.append((key, data[at : at + PIECE + LENGTH - 1], at))
                    size += len(held[-1][1])
                    if size >= PIECE:
                        yield from out()
                        held, size = [], 0
        if held:
            yield from out()

    return docs.select(text_of()).transform(in_arrow(run, _ROWS))


def _settle(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Splits named rows into repeats (``key``, ``first``, ``last``) and rows
    that stay open.  ``id`` tells places apart, so copies of a row in a text
    that occurs many times count once.  All steps are minima and maxima per
    name, so a name that very many rows share is combined before it is sent;
    they are written, so that the joins with them are dealt anew and a name of
    very many rows can be split."""
    shared = written(rows.groupBy("core").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("core"), f"{name}-shared")
    alive = written(rows.join(shared, "core", "left_semi"), f"{name}-alive")
    named = written(alive.groupBy("name").agg(F.min("id").alias("keeper"), F.max("id").alias("hi")), f"{name}-named")
    marked = written(
        alive.join(named, "name").select("key", "anchor", "first", "last", "core", "id", "keeper", (F.col("keeper") != F.col("hi")).alias("twice")),
        f"{name}-marked",
    )
    # Rows of one name share their core, so a core is open if its keepers are several.
    unsettled = written(
        marked.groupBy("core").agg(F.min("keeper").alias("lo"), F.max("keeper").alias("hi")).where("lo <> hi").select("core"), f"{name}-unsettled"
    )
    repeats = marked.where("twice").select("key", "first", "last")
    still_open = (
        marked.where("NOT twice OR id = keeper").join(unsettled, "core", "left_semi").select("key", "anchor", "first", "last").distinct()
    )
    return repeats, written(still_open, f"{name}-open")


def _with_texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``key``, ``text`` and ``rows`` (array of structs of the other columns) of
    the distinct texts that ``rows`` names.  Texts that a filter of bounded size
    rules out are not sent anywhere.  A text and its rows, at most one in 128 of
    its bytes, are one row and must fit a task."""
    head = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")
    packed = bit_filter(rows.select(head.alias("h")).distinct(), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            keys, texts = [], []
            for text in batch.column(0):
                data = text.as_py().encode()
                key = _key(data)
                if key in seen or not in_filter(packed, np.array([int.from_bytes(key[:8], "big")], np.uint64))[0]:
                    continue
                if len(seen) >= 50_000:
                    seen.clear()
                seen.add(key)
                keys.append(key), texts.append(data)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.binary())], ["key", "data"])

    found = docs.select(text_of()).transform(in_arrow(run, "key binary, data binary")).dropDuplicates(["key"])
    others = [c for c in rows.columns if c != "key"]
    grouped = rows.groupBy("key").agg(F.collect_list(F.struct(*others)).alias("rows"))
    return found.join(grouped, "key")


def _named(texts: DataFrame, make: Callable[[bytes, memoryview, dict], Iterator[tuple]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for k in range(batch.num_rows):
                key, view = batch.column(0)[k].as_py(), memoryview(batch.column(1)[k].as_py())
                for row in batch.column(2)[k].as_py():
                    rows.extend(make(key, view, row))
                    if len(rows) >= 20_000:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)

    return texts.transform(in_arrow(run, _ROWS))


def _parts_of(key: bytes, view: memoryview, row: dict) -> Iterator[tuple]:
    """The parts of an open run, aligned with its sample."""
    anchor = row["anchor"]
    for u in range((anchor - row["last"]) // PART, (anchor - row["first"]) // PART + 1):
        high = anchor - PART * u
        first, last = max(row["first"], high - PART + 1), min(row["last"], high)
        yield (
            key,
            anchor,
            first,
            last,
            _core_hash(view, high, high - PART + 1 + LENGTH),
            xxhash.xxh3_128_digest(view[first : last + LENGTH]),
            _id(key, anchor, first, 1),
        )


def _strings_of(key: bytes, view: memoryview, row: dict) -> Iterator[tuple]:
    """The strings of an open part, one by one."""
    for p in range(row["first"], row["last"] + 1):
        yield key, row["anchor"], p, p, 0, xxhash.xxh3_128_digest(view[p : p + LENGTH]), _id(key, p, p, 2)


def repeated_starts(docs: DataFrame) -> DataFrame:
    """``key`` (MD5 of the text), ``first``, ``last``: the starts of repeated
    strings, per distinct text.  Repeats between equal texts are not among them."""
    runs, open_runs = _settle(written(_samples(docs), "rep-samples"), "rep-run")
    parts, open_parts = _settle(written(_named(_with_texts(docs, open_runs), _parts_of), "rep-parts"), "rep-part")
    singles = written(_named(_with_texts(docs, open_parts), _strings_of), "rep-strings")
    twice = written(singles.groupBy("name").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("name"), "rep-twice")
    strings = singles.join(twice, "name", "left_semi").select("key", "first", "last")
    return written(runs.unionByName(parts).unionByName(strings), "rep-starts")


def byte_spans(starts: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes (end exclusive) that the strings cover."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in starts):
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], last + LENGTH))
        else:
            spans.append((first, last + LENGTH))
    return [(a, min(b, size)) for a, b in spans]


def _changed_texts(docs: DataFrame) -> DataFrame:
    """``_key``, ``spans`` and ``kept`` of the distinct texts that lose bytes."""
    schema = "_key binary, spans array<struct<start:long,end:long>>, kept binary"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, spans, kept = [], [], []
            for k in range(batch.num_rows):
                data = batch.column(1)[k].as_py()
                found = byte_spans(batch.column(2)[k].as_py(), len(data))
                edges = [0, *(x for span in found for x in span), len(data)]
                keys.append(batch.column(0)[k].as_py())
                spans.append([{"start": a, "end": b} for a, b in found])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["_key", "spans", "kept"])

    return _with_texts(docs, repeated_starts(docs)).transform(in_arrow(cut, schema))


def remove_repeats(docs: DataFrame, of_rest: Callable[[Column], Column] = lambda data: data) -> DataFrame:
    """A row per input row: ``doc_id``, ``n_bytes``, ``spans`` (array of start
    and end of what is removed, in bytes) and ``kept`` (binary, the rest, or
    ``of_rest`` of it; a digest is worked out before anything is sent).

    Null texts count as empty; texts under LENGTH bytes lose nothing; texts that
    occur in several rows, repeated rows included, are removed whole in each.
    Strings do not cross texts.  doc_id is only carried along.
    """
    data = text_of().cast("binary")
    keyed = docs.select("doc_id", F.octet_length(data).cast("long").alias("n_bytes"), of_rest(data).alias("own"), F.unhex(F.md5(data)).alias("key"))
    # both written, so that the joins are dealt anew and a text of very many rows can be split
    copies = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(F.col("key").alias("_copied")), "rep-copies")
    changed = written(_changed_texts(docs).select("_key", "spans", of_rest(F.col("kept")).alias("kept")), "rep-changed")
    size = F.col("n_bytes")
    whole = F.col("_copied").isNotNull() & (size >= LENGTH)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("end")))
    nothing = F.array().cast("array<struct<start:long,end:long>>")
    return (
        keyed.join(changed, F.col("key") == F.col("_key"), "left")
        .join(copies, F.col("key") == F.col("_copied"), "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(whole, everything).otherwise(F.coalesce("spans", nothing)).alias("spans"),
            F.when(whole, of_rest(F.lit(b""))).otherwise(F.coalesce("kept", "own")).alias("kept"),
        )
    )


def op8_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``remove_repeats`` of ``documents``, as counts and a digest of the rest; nulls,
    ties and repeated rows as there."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return remove_repeats(table(spark, sf_dir, "documents"), lambda data: F.sha2(data, 256)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.col("kept").alias("kept_sha256")
    )
