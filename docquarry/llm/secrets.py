"""Secret scans with multipart credential linking, with DataFrame functions only.

Each kind of part is cut out of the text by one split and one extraction of the
same pattern, where the text holds what the pattern needs; the lengths of the
pieces give the positions.  Base kinds are
always reported.  Weak candidates (login names, random-looking strings,
endpoints) are reported only where the parts that complete a credential lie
within the same scope.  The interval join is done as a sweep: per document the
parts are sorted by position and each looks at the nearest part of every other
role on either side, so a document with many parts costs no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import table, text_of, written

ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
LOGIN = (
    "(?:[Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy]_?[Ii][Dd]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]"
    "|[Uu][Ss][Ee][Rr](?:[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9_.@-]{3,})"
)
RANDOM = "[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = "(?:https?|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._:@/-]+"

#: kind, pattern, group measured, least length of it, role in a credential.
KINDS = (
    ("assign", ASSIGN, 1, 8, "secret"),
    ("access", ACCESS, 0, 16, "id"),
    ("hex", HEX, 0, 32, "secret"),
    ("login", LOGIN, 1, 3, "id"),
    ("random", RANDOM, 0, 20, "secret"),
    ("endpoint", ENDPOINT, 0, 10, "endpoint"),
)
#: Texts without any of these hold nothing of the kind that counts; looking for
#: them is much cheaper than the pattern.
NEEDED = {"assign": (":", "="), "access": ("AKIA",), "login": (":", "="), "endpoint": ("://",)}
BASE = ("assign", "access", "hex")
#: Parts are in one scope if at most this many characters lie between them.
SCOPE_CHARS = 200


def _parts(text: Column, rank: int) -> Column:
    """All matches of one kind, failing ones too, since their lengths count."""
    kind, pattern, group, least, _ = KINDS[rank]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    kept = F.transform(measured, lambda m: F.length(m) >= least)
    if kind == "random":
        kept = F.transform(whole, lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]"))
    pieces = F.split(text, pattern, -1)
    cut = F.arrays_zip(
        F.transform(whole, lambda m: F.length(m)).alias("span"),
        F.transform(pieces, lambda p: F.length(p)).alias("gap"),
        kept.alias("kept"),
    )
    rows = F.transform(
        F.slice(cut, 1, F.size(whole)),
        lambda c, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("nth"), c["gap"].alias("gap"), c["span"].alias("span"), c["kept"].alias("kept")
        ),
    )
    nothing = F.array().cast("array<struct<rank:int,nth:int,gap:int,span:int,kept:boolean>>")
    worth = text.rlike(pattern)
    if kind in NEEDED:
        present = [F.contains(text, F.lit(part)) for part in NEEDED[kind]]
        worth = (present[0] if len(present) == 1 else present[0] | present[1]) & worth
    elif kind == "random":
        worth = text.rlike("[0-9]") & worth
    return F.when(worth, rows).otherwise(nothing)


def find_parts(docs: DataFrame) -> DataFrame:
    """A row per part found: ``row`` (of the document), ``doc_id``, ``rank``
    (index into KINDS), ``start`` and ``end`` in code points.  A document
    without parts has one row with null ``rank``."""
    text = text_of()
    found = docs.select("doc_id", text.alias("text")).withColumn("row", F.monotonically_increasing_id())
    arrays = found.select("row", "doc_id", F.concat(*[_parts(F.col("text"), k) for k in range(len(KINDS))]).alias("parts"))
    # written, so that rows keep their numbers when tasks run again
    kept = written(arrays, "secret-parts")
    flat = kept.select("row", "doc_id", F.explode_outer("parts").alias("p")).select("row", "doc_id", "p.*").repartition("row")
    upto = Window.partitionBy("row", "rank").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("span")).over(upto)
    return flat.select(
        "row", "doc_id", "rank", "kept", (end - F.col("span")).alias("start"), end.alias("end")
    ).where("rank IS NULL OR kept OR nth = 0")


def link_parts(parts: DataFrame, scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """Adds ``near_id``, ``near_secret`` and ``near_endpoint``: whether another
    part of that role lies within ``scope_chars``."""
    role = F.element_at(F.array(*[F.lit(k[4]) for k in KINDS]), F.col("rank") + 1)
    order = Window.partitionBy("row").orderBy("start", "rank")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    ahead = order.rowsBetween(1, Window.unboundedFollowing)
    roled = parts.withColumn("role", F.when(F.col("kept"), role))
    for name in ("id", "secret", "endpoint"):
        reach = F.max(F.when(F.col("role") == name, F.col("end"))).over(past)
        onset = F.min(F.when(F.col("role") == name, F.col("start"))).over(ahead)
        near = (F.col("start") - reach <= scope_chars) | (onset - F.col("end") <= scope_chars)
        roled = roled.withColumn(f"near_{name}", F.coalesce(near, F.lit(False)))
    return roled


def scan_secrets(docs: DataFrame, scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """``doc_id`` and ``found``: all reported spans of a document, as structs of
    start, rank and end, sorted by start and kind.

    A row per input row, repeated rows and repeated or null ids included; null
    and empty texts have no spans.  A login name needs a secret in its scope, a
    random-looking string an id or an endpoint, an endpoint both an id and a
    secret.  A random-looking string that a base span covers adds nothing and
    links like any other.
    """
    linked = link_parts(find_parts(docs), scope_chars)
    kind = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("rank") + 1)
    complete = (
        kind.isin(*BASE)
        | ((kind == "login") & F.col("near_secret"))
        | ((kind == "random") & (F.col("near_id") | F.col("near_endpoint")))
        | ((kind == "endpoint") & F.col("near_id") & F.col("near_secret"))
    )
    span = F.when(F.col("kept") & complete, F.struct("start", "rank", "end"))
    return linked.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(span)).alias("found")).drop("row")


def op2_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scan_secrets`` of ``documents``, a row per row, with counts and a digest of the base kinds;
    no spans give the digest of nothing."""
    found = F.col("found")
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    is_base = lambda s: s["rank"] < len(BASE)
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ","
    )
    of_kind = lambda k: F.size(F.filter(found, lambda s: s["rank"] == k)).cast("long")
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(shown(F.filter(found, is_base)).cast("binary"), 256).alias("base_sha256"),
        shown(found).alias("spans"),
    )


def _duck(text: str) -> str:
    return text.replace("'", "''")


def _oracle() -> str:
    arrays = []
    for rank, (kind, pattern, group, least, _) in enumerate(KINDS):
        p = _duck(pattern)
        ok = f"length(g) >= {least}"
        if kind == "random":
            ok = "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')"
        arrays.append(
            f"""SELECT rid, {rank} AS rnk, i AS nth, length(pieces[i]) AS gap, length(m) AS span, ({ok}) AS kept
  FROM (SELECT rid, pieces, i, ms[i] AS m, gs[i] AS g FROM (
    SELECT rid, string_split_regex(t, '{p}') AS pieces, regexp_extract_all(t, '{p}', 0) AS ms,
           regexp_extract_all(t, '{p}', {group}) AS gs, unnest(range(1, len(regexp_extract_all(t, '{p}', 0)) + 1)) AS i
    FROM src WHERE regexp_matches(t, '{p}')))"""
        )
    roles = "[" + ", ".join(f"'{k[4]}'" for k in KINDS) + "]"
    names = "[" + ", ".join(f"'{k[0]}'" for k in KINDS) + "]"
    near = []
    for name in ("id", "secret", "endpoint"):
        near.append(
            f"""coalesce(start - max(CASE WHEN role = '{name}' THEN stop END) OVER (PARTITION BY rid ORDER BY start, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {SCOPE_CHARS}, false)
   OR coalesce(min(CASE WHEN role = '{name}' THEN start END) OVER (PARTITION BY rid ORDER BY start, rnk ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - stop <= {SCOPE_CHARS}, false) AS near_{name}"""
        )
    return f"""
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
cut AS ({' UNION ALL '.join(arrays)}),
placed AS (
  SELECT rid, rnk, kept, {roles}[rnk + 1] AS role,
         sum(gap + span) OVER (PARTITION BY rid, rnk ORDER BY nth)::BIGINT AS stop,
         (sum(gap + span) OVER (PARTITION BY rid, rnk ORDER BY nth) - span)::BIGINT AS start
  FROM cut),
linked AS (SELECT *, {', '.join(near)} FROM (SELECT * FROM placed WHERE kept)),
told AS (
  SELECT rid, rnk, start, {names}[rnk + 1] || ':' || start || ':' || stop AS s FROM linked
  WHERE rnk < 3 OR (rnk = 3 AND near_secret) OR (rnk = 4 AND (near_id OR near_endpoint)) OR (rnk = 5 AND near_id AND near_secret)),
per AS (
  SELECT rid, count(*) FILTER (rnk = 0) AS a, count(*) FILTER (rnk = 1) AS c, count(*) FILTER (rnk = 2) AS h,
         string_agg(s, ',' ORDER BY start, rnk) FILTER (rnk < 3) AS base, string_agg(s, ',' ORDER BY start, rnk) AS spans
  FROM told GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM src LEFT JOIN per USING (rid)
"""


ORACLE = _oracle()
