import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docquarry.llm import common, graph, hashing
from docquarry.sources import shared

ROWS, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def settings(spark):
    before = {k: spark.conf.get(k) for k in (ROWS, BYTES)}
    yield spark.conf
    for k, v in before.items():
        spark.conf.set(k, v)


def batches(frame):
    def run(found):
        for batch in found:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    return frame.transform(common.in_arrow(run, "n long, size long")).collect()


def test_batches_are_bounded_by_bytes(spark, settings):
    settings.set(ROWS, "10000"), settings.set(BYTES, "67108864b")
    long = spark.range(0, 120, 1, 1).select(F.repeat(F.lit("some text "), 100_000).alias("text"))
    plain = batches(long)
    assert sum(r["n"] for r in plain) == 120 and max(r["size"] for r in plain) < 70_000_000
    common.tuned(spark)
    tuned = batches(long)
    assert sum(r["n"] for r in tuned) == 120 and max(r["size"] for r in tuned) < 18_000_000
    assert max(r["n"] for r in batches(spark.range(0, 5000, 1, 1))) == 1000


def test_only_spark_s_own_limits_are_changed(spark, settings):
    settings.set(ROWS, "77"), settings.set(BYTES, "5m")
    common.tuned(spark)
    assert settings.get(ROWS) == "77" and settings.get(BYTES) == "5m"


class Session:
    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


@pytest.mark.parametrize("master, fine", [("local", True), ("local[4]", True), ("local-cluster[3,2,1000]", False), ("yarn", False), ("spark://a:7077", False)])
def test_a_cluster_needs_a_shared_folder(master, fine):
    session = Session(spark_master=master, spark_sql_warehouse_dir="file:/w")
    if fine:
        assert shared.shared_dir(session).startswith("file:/w/_scratch/")
    else:
        with pytest.raises(RuntimeError):
            shared.shared_dir(session)
    session.conf["spark.checkpoint.dir"] = "file:/shared/"
    assert shared.shared_dir(session).startswith("file:/shared/docquarry-")


def test_written_tables_lie_in_the_application_s_folder(spark):
    table = common.written(spark.range(3).withColumn("x", F.lit(None).cast("string")), "tables")
    assert table.count() == 3 and table.inputFiles()[0].startswith(shared.shared_dir(spark).replace("file://", "file:").replace("file:/", "file:///"))


def test_filters_let_everything_wanted_through(spark):
    packed = hashing.bit_filter(spark.range(1000).select((F.col("id") * 7919).alias("h")), "h")

    assert hashing.in_filter(packed, np.arange(1000, dtype=np.uint64) * np.uint64(7919)).all()
    assert not hashing.bit_filter(spark.range(0).select(F.col("id").alias("h")), "h").any()


def test_stars(spark):
    """Nodes that share centers, chains over centers, and rows with a null."""
    rows = [(5, 1), (1, 1), (6, 1), (6, 2), (2, 2), (7, 2), (7, 7), (9, 8), (8, 8), (8, 7), (30, 30), (None, 4), (4, None)]
    got = {r["node"]: r["component"] for r in graph.star_components(spark.createDataFrame(rows, "node long, center long")).collect()}
    assert got == {5: 1, 1: 1, 6: 1, 2: 1, 7: 1, 9: 1, 8: 1, 30: 30}


def test_rows_are_dealt_out_only_where_row_groups_are_few(spark, tmp_path):
    frame = spark.range(1000).selectExpr("id AS doc_id", "repeat('x', 100) AS text")
    for name, parts in (("few", 1), ("many", 8)):
        frame.repartition(parts).write.parquet(f"{tmp_path}/{name}/documents.parquet")
    few, many = (common.table(spark, f"{tmp_path}/{name}", "documents") for name in ("few", "many"))
    plan = lambda d: d._jdf.queryExecution().toString()
    assert "RoundRobinPartitioning" in plan(few) and "RoundRobinPartitioning" not in plan(many)
    assert sorted(r["doc_id"] for r in few.collect()) == sorted(r["doc_id"] for r in many.collect()) == list(range(1000))
    frame.repartition(1).write.option("parquet.block.size", "1024").option("parquet.page.size", "256").parquet(f"{tmp_path}/blocks/documents.parquet")
    frame.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert common.table(spark, f"{tmp_path}/none", "documents").count() == 0
    assert common.table(spark, f"{tmp_path}/blocks", "documents").count() == 1000
    frame.repartition(1).write.parquet(f"{tmp_path}/od d %41+/documents.parquet")
    assert common.table(spark, f"{tmp_path}/od d %41+", "documents").count() == 1000
