"""Text checks on odd pages."""

import duckdb

from docquarry.plans.queries import QUERIES, SQL


def test_densities_round_as_in_sql(spark, tmp_path):
    """Ties and near ties of the first decimal, blanks of other scripts at the ends,
    documents of null pages only."""
    texts = {1: [9, 8, 8, 8], 2: [9, 9, 9, 8], 3: [3] * 19 + [4], 4: [7] * 17 + [8] * 3, 5: [1198, 1198, 1198, 1199], 6: [300, 300], 7: [1] + [0] * 7}
    pages = [(doc, turn, "user", "1" * size) for doc, sizes in texts.items() for turn, size in enumerate(sizes)]
    pages += [(8, 0, "user", "　 12 "), (9, 0, "user", None), (9, 1, "user", None), (10, 0, "user", "12"), (10, 1, "user", None), (11, 0, "user", "\t1\n")]
    frame = spark.createDataFrame(pages, "conv_id long, turn int, role string, text string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, QUERIES["text_sanity"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == sorted(con.sql(SQL["text_sanity"]).fetchall())
    told = {doc: reason for doc, reason, _ in got}
    assert told[1] == "token_density_8.2_below_floor" and told[2] == "token_density_8.8_below_floor" and told[8] == "token_density_2.0_below_floor"
    assert (9, "no_pages", None) in got
