"""Personal data, with bootstrapped contextual extraction.

Seed entities (e-mail, IP address, card, phone) come from fixed expressions.
What stands around an entity gives its lexical patterns: the two words before
it, the one before, the one before with its separator, and the one after.  Spark
keeps the graph of patterns and instances and scores it in rounds: a pattern is
trusted if it is seen at several different known instances and a good part of all
its occurrences in the corpus are at known ones; an unknown token that looks like an
identifier (four characters or more, one of them a digit or @) becomes known if
trusted patterns make it likely enough.  Rounds end when one gains nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import aside, in_arrow, table, text_of, written
from docquarry.llm.hashing import M1, WordHashes, bit_filter, in_filter, mix, signed, windows

KINDS = ("email", "ip", "card", "phone", "context")
MIN_INSTANCES = 3
#: Part of a pattern's occurrences in the corpus that must be at known instances.
MIN_PRECISION = 0.25
#: What all trusted patterns of an instance together must reach: several weak ones
#: make up for a strong one.
MIN_CONFIDENCE = 0.4
#: Part of an instance's occurrences that a trusted pattern must stand at: what
#: mostly occurs elsewhere is a common token and would carry the rounds astray.
MIN_SHARE = 0.5
#: Rounds after which a longer chain counts as an error rather than going on.
ROUNDS = 60

# A match can start only where a digit run starts, since an earlier start in the
# run would match too; the lookbehind keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<!\S)(?=\S*[0-9@])\S{4,}")
_WORD = re.compile(r"[^\W\d_]+")
_TRIM = ".,;:!?()[]{}<>\"'"
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the seed entities, sorted."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _only_digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_only_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


#: First parts of the patterns of one word, in place of another word.
BEFORE, AFTER = "\x00before", "\x00after"
_MARK = re.compile(r"\s*([:=#]+)")
_MARKS, _LETTER = re.compile(r"[:=#]+"), re.compile(r"[^\W\d_]")


def patterns_of(text: str, spans: list[tuple[int, int]]) -> list[list[tuple[str, str]]]:
    """The patterns around each span (start, end), as pairs in lower case.  Words
    count however far they are; where there are none, nor are their patterns."""
    words = np.fromiter((x for m in _WORD.finditer(text) for x in m.span()), np.int64).reshape(-1, 2)
    starts = words[:, 0]
    out = []
    for (start, end), k, n in zip(
        spans, np.searchsorted(starts, [a for a, _ in spans]).tolist(), np.searchsorted(starts, [b for _, b in spans]).tolist(), strict=True
    ):
        told = []
        if k:
            a, b = words[k - 1].tolist()
            near = text[a : min(b, start)].lower()
            told.append((BEFORE, near))
            mark = _MARK.match(text, b, start)
            if mark:
                told.append(("\x00" + mark[1], near))
            if k > 1:
                a, b = words[k - 2].tolist()
                told.append((text[a:b].lower(), near))
        if n < len(words):
            a, b = words[n].tolist()
            told.append((AFTER, text[a:b].lower()))
        out.append(told)
    return out


def graph_edges(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[tuple[str, str]]]]:
    """(start, kind, end, instance, patterns) of seeds and of other tokens that
    look like identifiers; kind 4 for the latter."""
    spots = list(base)
    covered = sorted((a, b) for a, _, b in base)
    reach = np.maximum.accumulate([b for _, b in covered]) if covered else np.empty(0, int)
    starts = np.array([a for a, _ in covered])
    for m in _TOKEN.finditer(text):
        token = m[0]
        a = m.start() + len(token) - len(token.lstrip(_TRIM))
        b = m.end() - (len(token) - len(token.rstrip(_TRIM)))
        if b - a >= 4:
            k = int(np.searchsorted(starts, b))
            if k == 0 or reach[k - 1] <= a:
                spots.append((a, 4, b))
    if not spots:
        return []
    around = patterns_of(text, [(a, b) for a, _, b in spots])
    return [(a, kind, b, text[a:b].lower(), told) for (a, kind, b), told in zip(spots, around, strict=True) if told]


def marked_words(text: str) -> list[tuple[str, str]]:
    """Each run of separators and the word that ends before it, blanks apart.  The
    search is for the separators, which are few, and looks back from them."""
    out = []
    for m in _MARKS.finditer(text):
        end = m.start()
        while end and text[end - 1].isspace():
            end -= 1
        at = end
        while at and _LETTER.match(text, at - 1):
            at -= 1
        if at < end:
            out.append((m[0], text[at:end]))
    return out


def all_patterns(text: str, hashes: WordHashes) -> np.ndarray:
    """Hashes of all patterns that the words of a text could give to something."""
    low = text.lower()
    words = hashes.of(_WORD.findall(low))
    alone = [mix(hashes.of([part]) * M1 + words) for part in (BEFORE, AFTER)]
    marked = [windows(hashes.of(["\x00" + mark, word]), 2) for mark, word in marked_words(low)]
    return np.concatenate([windows(words, 2), *alone, *marked])


_SPANS = "array<struct<start:int,kind:int,end:int>>"
_EDGES = "array<struct<start:int,kind:int,end:int,instance:string,patterns:array<long>>>"


def _scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``_dq_row``, ``_dq_base`` and ``_dq_edges`` per document; ``docs`` has
    ``keep`` and ``_dq_text``."""
    source = docs.withColumn("_dq_row", F.monotonically_increasing_id())
    order = [*keep, "_dq_row", "_dq_text"]
    schema = source.select(*keep, "_dq_row", F.lit(None).cast(_SPANS).alias("_dq_base"), F.lit(None).cast(_EDGES).alias("_dq_edges")).schema
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    edge_type = pa.list_(
        pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.int64()))])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            spans, edges = [], []
            for text in batch.column(len(order) - 1):
                text = text.as_py()
                found, graph = [], []
                if _HINT.search(text):
                    found = base_spans(text)
                    for a, k, b, instance, around in graph_edges(text, found):
                        pairs = hashes.of([part for pair in around for part in pair])
                        patterns = signed(mix(pairs[::2] * M1 + pairs[1::2])).tolist()
                        graph.append({"start": a, "kind": k, "end": b, "instance": instance, "patterns": patterns})
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                edges.append(graph)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(spans, span_type), pa.array(edges, edge_type)], [*order[:-1], "_dq_base", "_dq_edges"]
            )

    return source.select(*order).transform(in_arrow(run, schema))


def _pattern_totals(docs: DataFrame, packed: np.ndarray) -> DataFrame:
    """``pattern``, ``total``: how often these patterns occur in the corpus, at
    whatever it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            parts = []
            for text in batch.column(0):
                found = all_patterns(text.as_py(), hashes)
                parts.append(found[in_filter(packed, found)])
            values, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.uint64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(signed(values)), pa.array(counts.astype(np.int64))], ["pattern", "n"])

    return (
        docs.select(text_of().alias("text")).transform(in_arrow(run, "pattern long, n long")).groupBy("pattern").agg(F.sum("n").alias("total"))
    )


def _bootstrap(edges: DataFrame, totals: DataFrame, occurrences: DataFrame, rounds: int) -> DataFrame:
    """The instances that become known until a round gains none, which is an error
    if ``rounds`` rounds are not enough.  ``occurrences`` has how often an
    ``instance`` ``occurs`` at all.  What is known stays known, so a round that
    leaves their number leaves all.  Counts are over (pattern, instance)
    edges, so hot patterns are aggregated before they meet."""
    graph = written(
        edges.groupBy("pattern", "instance")
        .agg(F.count(F.lit(1)).alias("n"), F.max((F.col("kind") < 4).cast("int")).alias("seed"))
        .join(totals, "pattern")
        .join(occurrences, "instance"),
        "pii-graph",
    )
    known, many = None, 0
    for _ in range(rounds):
        marked = graph if known is None else graph.join(known.withColumn("found", F.lit(1)), "instance", "left")
        is_known = F.col("seed") == 1 if known is None else (F.col("seed") == 1) | F.col("found").isNotNull()
        marked = marked.withColumn("known", is_known)
        trusted = (
            marked.where("known")
            .groupBy("pattern")
            .agg(F.count(F.lit(1)).alias("instances"), (F.sum("n") / F.max("total")).alias("precision"))
            .where((F.col("instances") >= MIN_INSTANCES) & (F.col("precision") >= MIN_PRECISION))
        )
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("precision"), F.lit(1e-9)))))
        gained = (
            graph.where("seed = 0").join(trusted.select("pattern", "precision"), "pattern")
            .groupBy("instance")
            .agg((1 - doubt).alias("confidence"), (F.max("n") / F.max("occurs")).alias("share"))
            .where((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("share") >= MIN_SHARE))
            .select("instance")
        )
        known, before = written(gained, "pii-known"), many
        many = known.count()
        if many == before:
            return known
    raise RuntimeError(f"patterns and instances did not settle in {rounds} rounds")


def find_personal(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rounds: int = ROUNDS, into: str = "found") -> DataFrame:
    """``keep`` columns and, as ``into``, all spans of a document, sorted, as
    structs of start, kind (index into KINDS) and end, in code points.

    A row per input row, repeated rows included; null and empty texts have no
    spans.  Found context spans never overlap base spans.  A very long text is
    one row of at most its own size and its spots.  Columns in ``keep`` may have
    any names.
    """
    inner = [f"_dq_kept{k}" for k in range(len(keep))]
    plain = docs.select(*[docs[c].alias(n) for c, n in zip(keep, inner, strict=True)], text_of().alias("_dq_text"))
    outer = [F.col(n).alias(c) for c, n in zip(keep, inner, strict=True)]
    scanned = written(_scan(plain, inner), "pii-scan")
    spots = scanned.select("_dq_row", F.explode("_dq_edges").alias("e")).select("_dq_row", "e.*")
    edges = spots.select("kind", "instance", F.explode("patterns").alias("pattern"))
    several = edges.select("pattern", "instance").distinct().groupBy("pattern").count().where(F.col("count") >= MIN_INSTANCES)
    patterns = written(several, "pii-patterns")
    packed = bit_filter(patterns, "pattern")
    base = F.col("_dq_base")
    if not packed.any():
        return scanned.select(*outer, base.alias(into))
    occurrences = spots.groupBy("instance").agg(F.count(F.lit(1)).alias("occurs"))
    known = _bootstrap(edges, _pattern_totals(docs, packed).join(patterns, "pattern", "left_semi"), occurrences, rounds)
    gained = written(
        spots.where("kind = 4")
        .join(known, "instance", "left_semi")
        .groupBy("_dq_row")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("_dq_gained")),
        "pii-gained",
    )
    nothing = F.array().cast(_SPANS)
    return scanned.join(gained, "_dq_row", "left").select(
        *outer, F.array_sort(F.concat(base, F.coalesce("_dq_gained", nothing))).alias(into)
    )


def redact(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets and ``n_chars``,
    if there is one, counted anew.  Overlapping spans become one, named by the
    first.  Repeated rows are changed alike, columns may have any names, and a
    very long text is one row."""
    plain, names, back = aside(docs)
    given = plain.withColumnRenamed(names["text"], "text")

    @F.pandas_udf("string")
    def replaced(text: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(text, found, strict=True):
            if t is None or not len(spans):
                out.append(t)
                continue
            parts, at = [], 0
            for s in spans:
                if s["start"] >= at:
                    parts += [t[at : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                at = max(at, s["end"])
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    found = find_personal(given, tuple(given.columns), rounds, "_dq_found")
    any_found = F.size("_dq_found") > 0
    changed = found.withColumn("text", F.when(any_found, replaced("text", "_dq_found")).otherwise(F.col("text")))
    if "n_chars" in names:
        count = F.when(any_found, F.length("text").cast("long")).otherwise(F.col(names["n_chars"]))
        changed = changed.withColumn(names["n_chars"], count)
    return changed.withColumnRenamed("text", names["text"]).select(*back)


def op9_find_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``find_personal`` of ``documents``, a row per row, with counts and a digest of the base
    kinds; no spans give the digest of nothing."""
    found = F.col("found")
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )
    of_kind = lambda k: F.size(F.filter(found, lambda s: s["kind"] == k)).cast("long")
    return find_personal(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[of_kind(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(shown(F.filter(found, lambda s: s["kind"] < 4)).cast("binary"), 256).alias("base_sha256"),
        shown(found).alias("spans"),
    )
