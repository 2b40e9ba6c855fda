"""Periodic runs of words, by the runs theorem.

A run's Lyndon root is the longest Lyndon word at its place under one of two
opposite orders of the words, and that word ends at the next smaller value of
the inverse suffix array.  So each word gives two candidates; a candidate is
extended to both sides by range minima over longest common prefixes.  Texts of
a batch are worked on end to end, each closed by a symbol of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import in_arrow, table, text_of

WORD = r"[^\x20\x09-\x0D]+"
#: A run has so many words at least, and so many periods (two or more).
SHORTEST, TIMES = 24, 3
#: Words worked on at a time; a longer text is one piece of work.
CHUNK = 1 << 18


# ---- suffix arrays ------------------------------------------------------------


def inverse_suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of all suffixes by prefix doubling, and the ranks by the first 1, 2,
    4 ... symbols on the way there (without those of the last round).

    Texts must end in symbols that appear once, so that no comparison leaves a
    text.  A round sorts only what is not yet told apart, and a rank is the
    place of its group, so that finished ranks stay."""
    n = len(symbols)
    rank, levels, active, k = np.zeros(n, np.int32), [], np.arange(n), 0
    while len(active):
        key = rank[active].astype(np.int64) * n + (rank[active + k] if k else symbols)
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        if k:
            levels.append(rank)
            rank = rank.copy()
        at, old = np.arange(len(active)), rank[active]
        fresh = np.append(True, key[1:] != key[:-1])
        begun = np.append(True, old[1:] != old[:-1])
        rank[active] = old + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(begun, at, 0))
        alone = fresh & np.append(fresh[1:], True)
        active, k = active[~alone], max(1, 2 * k)
    return rank, levels


class Minima:
    """A sparse table of range minima, whose rows are made when they are asked for."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [values]

    def row(self, k: int) -> np.ndarray:
        while len(self.rows) <= k:
            last, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))
        return self.rows[k]

    def between(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least value in each lo <= k < hi; ranges must not be empty."""
        out = np.empty(len(lo), self.rows[0].dtype)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            row = self.row(int(k))
            out[here] = np.minimum(row[lo[here]], row[hi[here] - (1 << int(k))])
        return out

    def next_smaller(self, at: np.ndarray) -> np.ndarray:
        """For each position the first later one with a smaller value, or the length:
        steps of 1, 2, 4 ... while all is larger, then back down."""
        values, n = self.rows[0], len(self.rows[0])
        found, failed = at + 1, np.zeros(len(at), np.int8)
        open_, k = np.arange(len(at)), 0
        while len(open_):
            step = 1 << k
            fits = found[open_] + step <= n
            larger = np.zeros(len(open_), bool)
            if fits.any():
                larger[fits] = self.row(k)[found[open_[fits]]] > values[at[open_[fits]]]
            failed[open_[~larger]] = k
            open_, k = open_[larger], k + 1
            found[open_] += step
        for k in range(int(failed.max(initial=0)) - 1, -1, -1):
            here = np.flatnonzero(failed > k)
            here = here[found[here] + (1 << k) <= n]
            larger = self.row(k)[found[here]] > values[at[here]]
            found[here[larger]] += 1 << k
        return found


class CommonPrefixes:
    """Lengths of common prefixes of suffixes, by minima over the LCP array."""

    def __init__(self, rank: np.ndarray, levels: list[np.ndarray]) -> None:
        self.rank = rank
        order = np.empty_like(rank)
        order[rank] = np.arange(len(rank), dtype=rank.dtype)
        # of neighbours in the suffix array, by halving steps over the stored ranks
        length, a, b = np.zeros(max(0, len(rank) - 1), np.int32), order[:-1], order[1:]
        for k in range(len(levels) - 1, -1, -1):
            length[levels[k][a + length] == levels[k][b + length]] += 1 << k
        self.minima = Minima(length)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different positions."""
        a, b = self.rank[a], self.rank[b]
        return self.minima.between(np.minimum(a, b), np.maximum(a, b)) if len(a) else np.zeros(0, np.int32)


# ---- runs ---------------------------------------------------------------------


def _closed(words: np.ndarray, counts: np.ndarray, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Texts of word numbers end to end, each closed by a symbol of its own below
    all words, and where each begins."""
    texts = len(counts)
    begins = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]
    symbols = np.empty(len(words) + texts, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[begins + counts] = False
    symbols[~inside] = np.arange(texts)
    at = np.flatnonzero(inside)
    if reverse:
        row = np.repeat(np.arange(texts), counts)
        at = 2 * begins[row] + counts[row] - 1 - at
    symbols[at] = words + texts
    return symbols, begins


def find_runs(words: np.ndarray, counts: np.ndarray, shortest: int = SHORTEST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """``text``, ``start``, ``length`` and ``period`` of all runs with ``shortest`` words and
    ``times`` periods, by text, start and period.  ``words`` are numbers of words
    from 0, equal for equal words, of texts that have ``counts`` of them.

    A run of that many periods has a root at one of its places 1 to p, behind
    which the next ``times - 2`` periods lie whole; so candidates with less to
    their right are left out before anything is extended to the left."""
    none = (np.zeros(0, np.int64),) * 4
    if not len(words):
        return none
    symbols, begins = _closed(words, counts)
    texts = len(counts)
    text = np.repeat(np.arange(texts), counts)
    at = np.arange(len(words)) + text
    top = int(words.max())
    rank, levels = inverse_suffix_array(symbols)
    prefixes = CommonPrefixes(rank, levels)
    del levels
    found = []
    for opposite in (False, True):
        if opposite:
            rank, _ = inverse_suffix_array(_closed(top - words, counts)[0])
        after = Minima(rank).next_smaller(at)
        period = after - at
        need = np.maximum((times - 2) * period, np.maximum(shortest - 2 * period, 1))
        last = (begins + counts)[text]
        fits = np.flatnonzero(after + need <= last)
        for back in (0, 1):  # the first and the last word that must be equal
            offset = (need[fits] - 1) * back
            fits = fits[symbols[at[fits] + offset] == symbols[after[fits] + offset]]
        right = prefixes.of(at[fits], after[fits])
        enough = right >= need[fits]
        fits, right = fits[enough], right[enough].astype(np.int64)
        found.append(np.stack([at[fits], period[fits], after[fits] + right, text[fits]]))
    first, period, end, text = np.concatenate(found, axis=1)
    # candidates of one period that end together are of one run
    _, one = np.unique(np.stack([end, period]), axis=1, return_index=True)
    first, period, end, text = first[one], period[one], end[one], text[one]
    if not len(first):
        return none
    held, row = np.unique(text, return_inverse=True)
    some = np.repeat(np.isin(np.arange(texts), held), counts)
    mirrored, mirrored_begins = _closed(words[some], counts[held], reverse=True)
    suffixes = CommonPrefixes(*inverse_suffix_array(mirrored))
    inner = first - begins[text]
    left = np.zeros(len(first), np.int64)
    more = np.flatnonzero(inner > 0)
    before = mirrored_begins[row[more]] + counts[text[more]] - inner[more]  # the place before the root, mirrored
    left[more] = suffixes.of(before, before - period[more])
    start, length = inner - left, end - first + left
    whole = np.flatnonzero(length >= np.maximum(shortest, times * period))
    whole = whole[np.lexsort((period[whole], start[whole], text[whole]))]
    return text[whole], start[whole], length[whole], period[whole]


def kept_spans(counts: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """``text``, ``start`` and ``end`` of the words that stay: all but those that a run
    contains after its first period."""
    begins = np.concatenate([[0], np.cumsum(counts + 1)])
    change = np.zeros(begins[-1] + 1, np.int64)
    np.add.at(change, begins[text] + start + period, 1)
    np.add.at(change, begins[text] + start + length, -1)
    stays = np.cumsum(change)[:-1] == 0
    stays[begins[:-1] + counts] = False
    edges = np.flatnonzero(np.diff(np.concatenate([[0], stays.astype(np.int8), [0]])))
    of = np.searchsorted(begins, edges[::2], side="right") - 1
    return of, edges[::2] - begins[of], edges[1::2] - begins[of]


def _chunks(counts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for k, n in enumerate(counts.tolist()):
        if held and held + n > limit:
            yield first, k
            first, held = k, 0
        held += n
    if first < len(counts):
        yield first, len(counts)


def periodic_runs(worded: DataFrame, shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """Per input row ``doc_id``, ``words``, ``runs`` (start, length and period in words, by
    start, then period) and ``kept`` (spans of words outside the repetitions).

    ``worded`` has ``doc_id`` and ``words``; a null array counts as empty, a null
    word as an empty one.  Rows are worked on by themselves, repeated ones alike;
    other columns are not read.  Memory is some 300 bytes for each word of the
    longest text, or of CHUNK words, and more for long repetitions by the
    logarithm of their length."""
    if times < 2 or shortest < 1:
        raise ValueError("a run has two periods or more, and a word at least")
    long = pa.int64()
    run_kind = pa.list_(pa.struct([("start", long), ("length", long), ("period", long)]))
    span_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def listed(rows: np.ndarray, count: int, parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
        offsets = np.searchsorted(rows, np.arange(count + 1)).astype(np.int32)
        fields = list(kind.value_type)
        values = pa.StructArray.from_arrays([pa.array(p, f.type) for p, f in zip(parts, fields, strict=True)], fields=fields)
        return pa.ListArray.from_arrays(pa.array(offsets), values, type=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy().astype(np.int64)
            for a, b in _chunks(sizes, CHUNK):
                part, counts = batch.slice(a, b - a), sizes[a:b]
                # what is shorter than a run has none
                long_enough = np.flatnonzero(counts >= shortest)
                of = np.repeat(counts >= shortest, counts)
                words = part.column(1).flatten().dictionary_encode().indices.to_numpy()[of].astype(np.int64)
                row, *runs = find_runs(words, counts[long_enough], shortest, times)
                row = long_enough[row]
                held, *spans = kept_spans(counts, row, *runs)
                columns = [part.column(0), part.column(1), listed(row, b - a, runs, run_kind), listed(held, b - a, spans, span_kind)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "words", "runs", "kept"])

    words = F.transform(F.coalesce(F.col("words"), F.array().cast("array<string>")), lambda w: F.coalesce(w, F.lit(""))).alias("words")
    schema = (
        "doc_id long, words array<string>, runs array<struct<start:long,length:long,period:long>>, "
        "kept array<struct<start:int,end:int>>"
    )
    return worded.select(F.col("doc_id").cast("long"), words).transform(in_arrow(run, schema))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def collapsed_text(words: Column, kept: Column) -> Column:
    """The words in ``kept`` spans, joined by a blank."""
    slices = F.transform(kept, lambda k: F.slice(words, k["start"] + 1, k["end"] - k["start"]))
    return F.array_join(F.flatten(slices), " ")


def with_stretches(words: Column, doc_id: Column) -> Column:
    """The words of a document, where for one id in ten all from a place on go
    over to a repetition of the first p from there: place and p by the CRC-32 of
    the id.  Without id, the words as they are."""
    h = F.crc32(doc_id.cast("string"))
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p)))
    return F.when((h % 10 == 0) & (n > 0), repeated).otherwise(words)


def _longest(runs: Column) -> Column:
    """The run with the most periods, the first of several."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    more = lambda held, run: held.isNull() | (run["length"] * held["period"] > held["length"] * run["period"])
    return F.aggregate(runs, F.lit(None).cast(kind), lambda held, run: F.when(more(held, run), run).otherwise(held))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``periodic_runs`` of the words of ``documents`` with ``with_stretches``, a row per row;
    null texts have no words, and texts without runs four nulls."""
    docs = table(spark, sf_dir, "documents").select("doc_id", words_of(text_of()).alias("words"))
    found = periodic_runs(docs.select("doc_id", with_stretches(F.col("words"), F.col("doc_id")).alias("words")))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        _longest(F.col("runs")).alias("best"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2(collapsed_text(F.col("words"), F.col("kept")), 256).alias("collapsed_sha256"),
    )
    return best.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
