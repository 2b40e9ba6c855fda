"""Fill-in-the-middle, with DuckDB inside Arrow batches.

Each batch is registered as a table, and one SELECT cuts its texts into tokens,
draws cuts and form from a hash of the id, and puts the parts together again.
No row is seen by Python.  ``restored_text`` rebuilds a text from its output
with Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import in_arrow, table, text_of

TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "42"
#: Percent of texts that are transformed, and of those in the order suffix, prefix, middle.
RATE, SPM = 50, 80

#: Over a table ``batch`` of doc_id and text; braces hold parameters.
TRANSFORM = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256('{seed}:' || coalesce(doc_id::VARCHAR, 'text:' || sha256(coalesce(text, '')))) AS hex
  FROM batch),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '{token}') AS tokens,
         ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
         ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4
  FROM drawn),
formed AS (
  SELECT *, len(tokens)::BIGINT AS n,
         CASE WHEN text = '' OR contains(text, '{prefix}') OR contains(text, '{suffix}') OR contains(text, '{middle}')
                   OR h3 % 100 >= {rate} THEN 'plain'
              WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS a, greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS b
  FROM cut),
parted AS (
  SELECT doc_id, n, form, text,
         CASE WHEN form <> 'plain' THEN coalesce(array_to_string(list_slice(tokens, 1, a), ''), '') END AS head,
         CASE WHEN form <> 'plain' THEN coalesce(array_to_string(list_slice(tokens, a + 1, b), ''), '') END AS mid,
         CASE WHEN form <> 'plain' THEN coalesce(array_to_string(list_slice(tokens, b + 1, n), ''), '') END AS tail
  FROM formed)
SELECT doc_id, n, form, length(head)::BIGINT AS prefix_chars, length(mid)::BIGINT AS middle_chars,
       CASE form WHEN 'plain' THEN text
                 WHEN 'psm' THEN '{prefix}' || head || '{suffix}' || tail || '{middle}' || mid
                 ELSE '{suffix}' || tail || '{prefix}' || head || '{middle}' || mid END AS output
FROM parted
"""


def transform_sql(seed: str = SEED, rate: int = RATE, spm: int = SPM, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> str:
    prefix, suffix, middle = (m.replace("'", "''") for m in marks)
    return TRANSFORM.format(seed=seed.replace("'", "''"), token=TOKEN, rate=int(rate), spm=int(spm), prefix=prefix, suffix=suffix, middle=middle)


def fill_in_middle(
    docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)
) -> DataFrame:
    """Per input row ``doc_id``, ``n`` (tokens), ``form`` (plain, psm, spm),
    ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``.

    Null texts count as empty; empty ones, and those that hold a mark, stay
    plain.  Rows of one id draw alike, rows without id by their text; other
    columns are not read.  A text is cut whole, however long; memory is some
    30 bytes for each byte of a batch or of the longest text."""
    sql = transform_sql(seed, rate, spm, marks)
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    kinds = {"long": pa.int64(), "string": pa.string()}
    wanted = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # nothing is spilled to a folder of the machine, and a task has one core
        with duckdb.connect(config={"threads": 1, "temp_directory": "", "autoinstall_known_extensions": False}) as engine:
            for batch in batches:
                engine.register("batch", pa.Table.from_batches([batch]))
                found = engine.sql(sql).to_arrow_table()
                engine.unregister("batch")
                yield from found.cast(wanted).to_batches()

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).transform(in_arrow(run, schema))


def restored_text(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of.  Each mark is in it once."""
    prefix, suffix, middle = marks
    head, mid = F.substring_index(output, middle, 1), F.substring_index(output, middle, -1)
    first, second = (suffix, prefix), (prefix, suffix)

    def parts(order: tuple[str, str]) -> tuple[Column, Column]:
        opened, closed = order
        return F.substring(F.substring_index(head, closed, 1), len(opened) + 1, 2**31 - 1), F.substring_index(head, closed, -1)

    (tail, start), (begin, end) = parts(first), parts(second)
    return F.when(form == "spm", F.concat(start, mid, tail)).when(form == "psm", F.concat(begin, mid, end)).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fill_in_middle`` of ``documents`` with digests of the output and of the text
    rebuilt from it, a row per row; null texts as empty."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    restored = restored_text(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256")
    )


#: A second formulation for DuckDB alone: parts by positions in the text, and the
#: restored text by the lengths of the parts.
ORACLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256('42:' || coalesce(doc_id::VARCHAR, 'text:' || sha256(coalesce(text, '')))) AS hex
  FROM documents),
sized AS (
  SELECT *, list_transform(regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'), lambda x: length(x)) AS sizes,
         [('0x' || substr(hex, 8 * k + 1, 8))::BIGINT for k in range(4)] AS h
  FROM drawn),
cuts AS (
  SELECT doc_id, text, len(sizes)::BIGINT AS n, h,
         coalesce(list_sum(sizes[1:least(h[1] % (len(sizes) + 1), h[2] % (len(sizes) + 1))]), 0)::BIGINT AS a,
         coalesce(list_sum(sizes[1:greatest(h[1] % (len(sizes) + 1), h[2] % (len(sizes) + 1))]), 0)::BIGINT AS b
  FROM sized),
formed AS (
  SELECT *, CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                WHEN 'psm' THEN concat('<P>', substr(text, 1, a), '<S>', substr(text, b + 1), '<M>', substr(text, a + 1, b - a))
                ELSE concat('<S>', substr(text, b + 1), '<P>', substr(text, 1, a), '<M>', substr(text, a + 1, b - a)) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed
"""
