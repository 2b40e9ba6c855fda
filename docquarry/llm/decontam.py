"""Benchmark decontamination by template canonicalisation.

Texts become token sequences in which numbers, units and names are typed
placeholders.  Windows of eight tokens are joined by hash with those of the
benchmark.  Two templates are kept of each text: one that ignores case and
leaves names as they are, and one in which capitalised words are names.  Windows
with too few words for a template are compared as they are.  What
filled the placeholders must be consistent: within an occurrence of an item in a
document, equal benchmark values must stand for equal document values.  So an
item counts as leaked as it is, or with other parameters, but not where only the
shape agrees.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import aside, in_arrow, table, text_of, written
from docquarry.llm.hashing import M1, WORDS_KEPT, bit_filter, in_filter, mix, signed, windows

WIDTH = 8
#: Items with fewer tokens are too short to tell.
SHORTEST = 4
#: Tokens of an item that must be covered, or all it has.
COVERED = 13
#: At least so many tokens of a window (half of a shorter one) are words; others
#: count only as they are, with their numbers.
LITERALS = 4
# Unit words, which count as units after a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet mile miles meter meters metre metres mg g kg lb lbs oz ton tons gram grams "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years percent dollar dollars cent cents euro euros pound pounds mph kmh hz w kw v j kj".split()
)
#: Tokens of documents that are worked on together.
TOGETHER = 50_000
_DIGIT, _PLAIN = re.compile(r"[\d_]"), re.compile(r"\w+")
_TOKEN = re.compile(r"[^\W\d_]+|[$€£]?[0-9]+(?:[.,][0-9]+)*%?")
_WORD, _NAME, _NUMBER, _UNIT = 0, 1, 2, 3
_NUM_HASH, _UNIT_HASH, _NAME_HASH = (xxhash.xxh64_intdigest(x) for x in ("\x00number", "\x00unit", "\x00name"))


class _Tokens(dict):
    """Token to its place in three columns: hash in lower case (of the placeholder
    for numbers), class, and hash in lower case of numbers too.  Bounded."""

    def __init__(self):
        super().__init__()
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.hashes, self.kinds, self.raw = np.empty(1024, np.uint64), np.empty(1024, np.int8), np.empty(1024, np.uint64)
        self.filled, self.new_hashes, self.new_kinds, self.new_raw = 0, [], [], []

    def __missing__(self, token: str) -> int:
        lower = token.lower()
        raw = value = xxhash.xxh64_intdigest(lower)
        if lower == token:
            kind = _WORD
            if not token[-1].isalpha():
                kind, value = _NUMBER, _NUM_HASH
            elif token in UNITS:
                kind = _UNIT
        else:
            kind = _UNIT if lower in UNITS else _NAME if token[1:] == lower[1:] else _WORD
        self.new_hashes.append(value)
        self.new_kinds.append(kind)
        self.new_raw.append(raw)
        place = self[token] = len(self)
        return place

    def of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self) >= WORDS_KEPT:
            self._reset()
        places = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if self.new_hashes:
            end = self.filled + len(self.new_hashes)
            if end > len(self.hashes):
                self.hashes, self.kinds, self.raw = (np.resize(x, 2 * end) for x in (self.hashes, self.kinds, self.raw))
            self.hashes[self.filled : end] = np.array(self.new_hashes, np.uint64)
            self.kinds[self.filled : end] = self.new_kinds
            self.raw[self.filled : end] = np.array(self.new_raw, np.uint64)
            self.filled, self.new_hashes, self.new_kinds, self.new_raw = end, [], [], []
        return self.hashes[places], self.kinds[places], self.raw[places]


def tokens_of(text: str) -> list[str]:
    """Words and numbers.  Without digits the quicker expression finds the same."""
    return (_TOKEN if _DIGIT.search(text) else _PLAIN).findall(text)


def window_hashes(tokens: list[str], starts: np.ndarray, known: _Tokens, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Per template: hashes of the windows that have enough words, where they
    start, and which tokens are placeholders (None for the windows that are left
    of the first, which are hashed as they are).

    ``tokens`` are those of several texts one after another, beginning at
    ``starts``; windows do not cross texts.  Of the second template only windows
    with a name count, the others are those of the first.
    """
    literal, kind, raw = known.of(tokens)
    slot = kind == _NUMBER
    after = np.concatenate([[False], slot[:-1]])
    after[starts[starts < len(tokens)]] = False
    unit = (kind == _UNIT) & after
    literal[unit] = _UNIT_HASH
    slot |= unit
    name = kind == _NAME
    ends = np.append(starts[1:], len(tokens))
    room = np.repeat(ends, ends - starts) - np.arange(len(tokens)) >= width
    salt = np.uint64(xxhash.xxh64_intdigest(str(width)))
    least = min(LITERALS, (width + 1) // 2)
    for hashes, placeholder, named in ((literal, slot, None), (np.where(name, np.uint64(_NAME_HASH), literal), slot | name, name & ~unit)):
        found = windows(hashes, width)
        n = len(found)
        sums = np.concatenate([[0], np.cumsum(~placeholder)])
        enough = sums[width : width + n] - sums[:n] >= least
        fits = room[:n] & enough
        if named is None:
            few = np.flatnonzero(room[:n] & ~enough)
            if len(few):
                total = raw[few]
                for k in range(1, width):
                    total = total * M1 + raw[few + k]
                yield mix(total) ^ ~salt, few, None
        else:
            names = np.concatenate([[0], np.cumsum(named)])
            fits &= names[width : width + n] > names[:n]
        at = np.flatnonzero(fits)
        yield found[at] ^ salt, at, placeholder


def _slots(tokens: list[str], placeholder: np.ndarray | None, at: int, width: int) -> list[str] | None:
    """None for a window that is compared as it is."""
    return None if placeholder is None else [tokens[at + k].lower() for k in np.flatnonzero(placeholder[at : at + width])]


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``item_key`` (of the text), ``n_tokens``, ``pos``, ``width``,
    ``h`` and ``item_slots`` (null where compared as it is) for all windows of all
    items."""
    schema = "item_id long, item_key string, n_tokens int, pos int, width int, h long, item_slots array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Tokens()
        for batch in batches:
            rows = []
            for item, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tokens = tokens_of(text)
                width = min(WIDTH, len(tokens))
                if width < SHORTEST:
                    continue
                for found, at, placeholder in window_hashes(tokens, np.zeros(1, np.int64), known, width):
                    for h, p in zip(signed(found).tolist(), at.tolist(), strict=True):
                        rows.append((item, key, len(tokens), p, width, h, _slots(tokens, placeholder, p, width)))
            if rows:
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["item_id", "item_key", "n_tokens", "pos", "width", "h", "item_slots"],
                )

    text = text_of()
    return benchmark.select(F.col("item_id").cast("long"), F.md5(text), text).transform(in_arrow(run, schema))


def _doc_windows(docs: DataFrame, packed: np.ndarray, widths: list[int]) -> DataFrame:
    """``doc_id``, ``text_key``, ``h``, ``place`` in the document, ``first`` (of its
    hash in the document) and ``doc_slots`` of all windows that pass the filter.
    Documents are worked on together until they have TOGETHER tokens."""
    schema = "doc_id long, text_key string, h long, place int, first boolean, doc_slots array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Tokens()

        def hits(tokens: list[str], starts: list[int], heads: list[tuple]) -> Iterator[pa.RecordBatch]:
            begins, rows = np.array(starts), []
            for width in widths:
                for found, at, placeholder in window_hashes(tokens, begins, known, width):
                    hit = np.flatnonzero(in_filter(packed, found))
                    owner, value, place = np.searchsorted(begins, at[hit], side="right") - 1, found[hit], at[hit]
                    order = np.lexsort((place, value, owner))
                    owner, value, place = owner[order], value[order], place[order]
                    first = np.ones(len(order), bool)
                    first[1:] = (np.diff(owner) != 0) | (value[1:] != value[:-1])
                    for o, h, p, f in zip(owner.tolist(), signed(value).tolist(), place.tolist(), first.tolist(), strict=True):
                        rows.append((*heads[o], h, p - starts[o], f, _slots(tokens, placeholder, p, width)))
            if rows:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "text_key", "h", "place", "first", "doc_slots"],
                )

        for batch in batches:
            tokens, starts, heads = [], [], []
            for doc, key, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                found = tokens_of(text.as_py())
                if found:
                    starts.append(len(tokens))
                    heads.append((doc.as_py(), key.as_py()))
                    tokens += found
                if len(tokens) >= TOGETHER:
                    yield from hits(tokens, starts, heads)
                    tokens, starts, heads = [], [], []
            if tokens:
                yield from hits(tokens, starts, heads)

    text = text_of()
    return docs.select(F.col("doc_id").cast("long"), F.md5(text), text).transform(in_arrow(run, schema))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and leaked item: ``doc_id``, ``text_key`` (MD5 of the
    text), ``item_id``, ``kind`` (``exact`` or ``reparameterised``),
    ``covered`` and ``item_tokens``.

    An item is leaked if windows of one document cover COVERED of its tokens, or
    all of them if it has fewer, either with the item's own values in the slots
    (then what else agrees in shape around them does not matter) or with other
    values that are consistent over all windows of an occurrence.  Windows of
    mostly numbers count only as they are.  An occurrence
    is what lies at one offset between document and item, what follows each
    other in the document while positions in the item do not fall, or the first
    window of each hash in the document; any one decides.  Null texts count as
    empty and match nothing, as do items of under SHORTEST tokens.  Repeated
    rows of a document or of an item give one row; documents with one id but
    different texts are told apart by ``text_key``, null ids likewise.  Very long
    texts are worked on whole, some fifty bytes for each of their tokens.
    """
    items = written(_item_windows(benchmark), "decon-items")
    packed = bit_filter(items, "h")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most WIDTH of them
    hits = written(_doc_windows(docs, packed, widths), "decon-hits")
    joined = hits.join(items, "h").select(
        "doc_id", "text_key", "item_id", "item_key", "n_tokens", "pos", "width", "place", "first", F.arrays_zip("item_slots", "doc_slots").alias("slots")
    )
    group = ["doc_id", "text_key", "item_id", "item_key", "n_tokens", "width"]
    in_order = Window.partitionBy(*group).orderBy("place", "pos")
    turned = joined.withColumn("turn", (F.col("pos") < F.lag("pos").over(in_order)).cast("int"))
    ways = [F.lit(0), F.col("place") - F.col("pos"), F.coalesce(F.sum("turn").over(in_order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))]
    seen = turned.withColumn("which", F.array(*[F.struct(F.lit(k).alias("way"), w.cast("long").alias("at")) for k, w in enumerate(ways)]))
    seen = seen.withColumn("which", F.explode("which"))
    # Without slots (null) the window was compared as it is.
    same = F.col("slots").isNull() | F.forall("slots", lambda p: p["item_slots"].eqNullSafe(p["doc_slots"]))
    counts = F.col("first") | (F.col("which.way") > 0)
    matched = seen.groupBy(*group, "which").agg(
        F.array_sort(F.collect_set(F.when(F.col("slots").isNotNull(), F.col("pos")))).alias("at"),
        F.array_sort(F.collect_set(F.when(same, F.col("pos")))).alias("same_at"),
        F.array_distinct(F.flatten(F.collect_set(F.when(counts, F.col("slots"))))).alias("pairs"),
    )
    width = F.col("width")

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.when(i + 1 < F.size(at), F.least(F.get(at, i + 1) - p, width)).otherwise(width))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    enough = F.least(F.lit(COVERED), F.col("n_tokens"))
    consistent = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"]))) == F.size("pairs")
    told = matched.select("*", covered(F.col("same_at")).alias("as_is"), covered(F.col("at")).alias("in_shape"))
    as_is = F.when(F.col("as_is") >= enough, F.col("as_is"))
    return (
        told.where(as_is.isNotNull() | ((F.col("in_shape") >= enough) & consistent))
        .groupBy("doc_id", "text_key", "item_id")
        .agg(
            F.when(F.max(as_is).isNotNull(), "exact").otherwise("reparameterised").alias("kind"),
            F.coalesce(F.max(as_is), F.max("in_shape")).alias("covered"),
            F.max("n_tokens").alias("item_tokens"),
        )
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text leaks an item, columns of any names
    unchanged."""
    leaked = written(find_leaks(docs, benchmark).select(F.col("text_key").alias("_dq_leaked")).distinct(), "decon-leaked")
    plain, names, back = aside(docs)
    return plain.join(leaked, F.md5(text_of(names["text"])) == F.col("_dq_leaked"), "left_anti").select(*back)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``find_leaks`` of ``documents`` against ``benchmark``, a row per leaking document and item;
    nulls, short and repeated items as there."""
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "kind", "covered", "item_tokens")
