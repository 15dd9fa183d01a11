"""Keyed changes, deletes included."""

from pyspark.sql import functions as F

from tidemark.operators import tables


def test_upserts_and_deletes_in_one_pass(spark):
    table = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "_id string, document string")
    rows = [("a", "2", 1, False), ("a", None, 2, True), ("b", None, 1, True), ("b", "3", 2, False), ("d", "4", 1, None), ("e", None, 1, True)]
    changes = spark.createDataFrame(rows, "_id string, document string, seq long, gone boolean")
    got = tables.apply_changes(table, changes, ["_id"], F.col("seq"), F.col("gone"))
    assert {tuple(r) for r in got.collect()} == {("b", "3"), ("c", "1"), ("d", "4")}


def test_merge_statement_deletes():
    columns = ["_id", "document", "gone"]
    assert tables.merge_statement("t", "s", columns, "_id", "gone") == (
        "MERGE INTO t t USING s s ON t._id = s._id WHEN MATCHED AND s.gone THEN DELETE "
        "WHEN MATCHED THEN UPDATE SET document = s.document "
        "WHEN NOT MATCHED AND NOT s.gone THEN INSERT (_id, document) VALUES (s._id, s.document)"
    )
    assert "DELETE" not in tables.merge_statement("t", "s", columns[:2], "_id")
