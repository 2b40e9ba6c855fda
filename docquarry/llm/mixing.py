"""Mixing sources to target weights, with DataFrame functions only.

Tokens are summed per source, a water level turns weights into targets that no
source's repetition cap exceeds, and each document is emitted floor(rate) times
plus once more when a hash of its id falls below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import aside, table, text_of, written

#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this on average.
MAX_RATE = 3
SEED = "mix-1"
WORD = "[^\\x20\\x09-\\x0D]+"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """Per source: ``source``, ``source_size`` and ``target``.

    ``sized`` has ``source`` and ``size``.  Sources are ordered by code point,
    null last; weights repeat along that order.  With caps c = max_rate * size
    the targets are min(c, level * weight), where the level makes them add up
    to the total: the sources are sorted by c / weight, and the level is the
    greatest (total - caps before) / (weights from here on) that its own source's
    ratio is not below.  Both windows run over one row per source, after the
    aggregation.  A source without words gets target 0; no rows, no targets.
    """
    total = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = total.withColumn("rank", F.row_number().over(ordered)).select(
        "source",
        "source_size",
        F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * max_rate).alias("cap"),
        "rank",
    )
    ratio = F.col("cap").cast("double") / F.col("weight")
    everything = Window.partitionBy()
    before = Window.orderBy(ratio, "rank").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(ratio, "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast(
        "double"
    ) / F.sum("weight").over(onward)
    levelled = weighed.withColumn("level", F.when(level <= ratio, level))
    final = F.max("level").over(everything)
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(
        F.least(F.col("cap").cast("double"), F.coalesce(final, F.lit(float("inf"))) * F.col("weight"))
    )
    return levelled.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: str = SEED,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """How often each document is taken: ``keep`` columns, ``size``,
    ``source_size``, ``target`` and ``copies``.

    A row per input row: repeated rows are separate documents that draw the
    same number.  A null text counts as empty (size 0), a null source is a
    source of its own, a null doc_id draws by its text.  Other columns of
    ``docs`` may have any names.  A very long text is counted whole, in one row.
    The targets are written and joined by a
    null-safe key; Spark sends them to all tasks if their file is below its
    limit and deals both sides by source otherwise, where a source that holds
    much of the rows can be split, since only a projection follows.
    """
    plain, names, _ = aside(docs.select(*dict.fromkeys((*keep, "doc_id", "text", "source"))))
    mixed = _mix(plain, names, weights, max_rate, seed, "text" in keep)
    kept = [F.col(names[c]).alias(c) for c in keep]
    return mixed.select(*kept, *[F.col(f"_dq_{c}").alias(c) for c in ("size", "source_size", "target", "copies")])


def _mix(docs: DataFrame, names: dict[str, str], weights: tuple[int, ...], max_rate: int, seed: str, wide: bool) -> DataFrame:
    """``docs``, whose columns have the ``names`` of ``aside``, with ``_dq_size``,
    ``_dq_source_size``, ``_dq_target``, ``_dq_copies``; without their text unless ``wide``."""
    text = text_of(names["text"])
    drawn = F.coalesce(F.col(names["doc_id"]).cast("string"), F.concat(F.lit("text:"), F.md5(text)))
    unit = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), drawn)), 1, 12), 16, 10).cast("double") / float(1 << 48)
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    sized = docs.select("*", F.col(names["source"]).alias("_dq_source"), size.alias("_dq_size"), unit.alias("_dq_unit"))
    if not wide:
        # what is left of a document without its text is small, so words are counted once
        sized = written(sized.drop(names["text"]), "mix-sized")
    # written, so that its true size decides whether documents are dealt by source at all
    counted = sized.select(F.col("_dq_source").alias("source"), F.col("_dq_size").alias("size"))
    per_source = written(source_targets(counted, weights, max_rate), "mix-targets")
    targets = per_source.select(
        F.col("source").alias("_dq_named"), F.col("source_size").alias("_dq_source_size"), F.col("target").alias("_dq_target")
    )
    joined = sized.join(targets, F.col("_dq_source").eqNullSafe(F.col("_dq_named")), "left")
    rate = F.when(
        F.col("_dq_source_size") > 0, F.least(F.col("_dq_target") / F.col("_dq_source_size"), F.lit(float(max_rate)))
    ).otherwise(0.0)
    copies = F.floor(rate) + F.when(F.col("_dq_unit") < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("_dq_copies", copies.cast("long"))


def emit_mixture(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED
) -> DataFrame:
    """The mixture itself: the columns of ``docs``, of any names, and ``copy`` (from
    0; named ``mix_copy`` if there is such a column already, and ``mix_copy_`` and so
    on if there is that too), a row per copy taken.  Documents with no copies do
    not appear."""
    taken = {c.lower() for c in docs.columns}
    name = "mix_copy" if "copy" in taken else "copy"
    while name in taken:
        name += "_"
    plain, names, back = aside(docs)
    copy = F.explode(F.sequence(F.lit(0), (F.col("_dq_copies") - 1).cast("int"))).alias(name)
    return _mix(plain, names, weights, max_rate, seed, True).where("_dq_copies > 0").select(*back, copy)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mix_sources`` of ``documents``, with the words each row adds to the mixture; nulls as
    there."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS size,
         coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS drawn
  FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS cap,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk,
         [1, 2, 3][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM total),
level AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lvl
  FROM weighed),
targets AS (
  SELECT source, source_size,
         CASE WHEN source_size = 0 THEN 0.0::DOUBLE
              ELSE least(cap::DOUBLE, (SELECT max(lvl) FROM level WHERE lvl <= ratio) * weight) END AS target
  FROM level),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size::DOUBLE, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
         (('0x' || substr(md5('mix-1:' || s.drawn), 1, 12))::BIGINT)::DOUBLE / 281474976710656.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rated
"""
