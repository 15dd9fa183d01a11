"""Registered queries over text lines, documents and shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import shards, tables
from tidemark.plans import fixtures
from tidemark.sources import files


def _lines(spark, folder):
    return fixtures.table(spark, folder, "orders").selectExpr(
        """if(o_orderkey % 97 = 0, concat('no separator ', o_orderkey),
              concat('{"transaction_id":"', o_orderkey, '"}|{"note":"a|b","status":"', o_orderstatus, '"}')) AS value"""
    )


def keyed_lines(spark, folder):
    return files.keyed(files.keyed_lines(_lines(spark, folder)))


def unkeyed_lines(spark, folder):
    return files.unkeyed(files.keyed_lines(_lines(spark, folder)))


def _dump(spark, folder):
    return fixtures.table(spark, folder, "customer").selectExpr(
        """concat('{"_id":ObjectId("', lpad(hex(c_custkey), 24, '0'), '"),"parent":ObjectId("', lpad(hex(c_nationkey), 24, '0'),
                  '"),"created_at":ISODate("2024-01-', lpad(cast(c_custkey % 28 + 1 AS string), 2, '0'), 'T00:00:00Z"),"name":"',
                  c_name, '"}') AS value"""
    )


def dump_fix(spark, folder):
    return files.read_dump(_dump(spark, folder))


def dump_typed(spark, folder):
    ddl = "_id struct<`$oid`: string>, created_at struct<`$date`: timestamp>, name string"
    return files.read_dump(_dump(spark, folder), ddl).select(
        F.col("_id.`$oid`").alias("_id"), F.unix_millis("created_at.`$date`").alias("created_ms"), "name"
    )


def find_sort(spark, folder):
    return files.find(
        fixtures.table(spark, folder, "orders"),
        F.col("o_orderstatus") == "F",
        ["o_orderkey", "o_orderpriority"],
        newest_first="o_orderdate",
        unique="o_orderkey",
    )


def log_collect(spark, folder):
    lines = fixtures.table(spark, folder, "documents").select(
        F.explode(F.split("text", "\n")).alias("value"), "source", "doc_id"
    )
    labelled = files.with_labels(lines, {"job": F.col("source"), "kind": "document"})
    return labelled.select("doc_id", "value", F.col("labels")["job"].alias("job"), F.col("labels")["kind"].alias("kind"))


def shard_report(spark, folder):
    """By the plain remainder, which both engines compute alike."""
    rows = fixtures.table(spark, folder, "lineitem")
    report = shards.shard_report(rows, F.pmod(F.col("l_orderkey"), F.lit(3)).cast("int"))
    return report.select("shard", "rows", F.round("share", 6).alias("share"))


def hashed_shard_report(spark, folder):
    rows = fixtures.table(spark, folder, "lineitem")
    report = shards.shard_report(rows, shards.hashed_shard(F.col("l_orderkey"), 3))
    return report.select("shard", "rows", F.round("share", 6).alias("share"))


_LINE = """CASE WHEN o_orderkey % 97 = 0 THEN 'no separator ' || o_orderkey
    ELSE '{"transaction_id":"' || o_orderkey || '"}|{"note":"a|b","status":"' || o_orderstatus || '"}' END"""

def append_twice(spark, folder):
    """Rows added to a stored table by two writes."""
    path = session.scratch_dir(spark, "appended")
    for name, kind in (("r_regionkey", "region"), ("n_nationkey", "nation")):
        rows = fixtures.table(spark, folder, kind)
        tables.append_rows(rows.select(F.col(name).cast("bigint").alias("id"), F.lit(kind).alias("kind")), path)
    return spark.read.parquet(path)


QUERIES = {
    "append_rows": append_twice,
    "keyed_lines": keyed_lines,
    "keyed_lines_rejected": unkeyed_lines,
    "dump_fix": dump_fix,
    "dump_typed": dump_typed,
    "find_sort": find_sort,
    "log_collect": log_collect,
    "shard_report": shard_report,
    "shard_report_hashed": hashed_shard_report,
}

ORACLE = {
    "append_rows": """SELECT r_regionkey::BIGINT AS id, 'region' AS kind FROM region
        UNION ALL SELECT n_nationkey::BIGINT, 'nation' FROM nation""",
    "keyed_lines": f"""SELECT substr(line, 1, instr(line, '|') - 1) AS key, substr(line, instr(line, '|') + 1) AS value
        FROM (SELECT {_LINE} AS line FROM orders) WHERE instr(line, '|') > 0""",
    "keyed_lines_rejected": "SELECT 'no separator ' || o_orderkey AS line FROM orders WHERE o_orderkey % 97 = 0",
    "dump_fix": """SELECT '{"_id":{"$oid": "' || lpad(printf('%X', c_custkey), 24, '0') || '"},"parent":{"$oid": "' ||
        lpad(printf('%X', c_nationkey), 24, '0') || '"},"created_at":{"$date": "2024-01-' ||
        lpad(cast(c_custkey % 28 + 1 AS varchar), 2, '0') || 'T00:00:00Z"},"name":"' || c_name || '"}' AS value FROM customer""",
    "dump_typed": """SELECT lpad(printf('%X', c_custkey), 24, '0') AS _id,
        epoch_ms(timestamp '2024-01-01') + (c_custkey % 28) * 86400000 AS created_ms, c_name AS name FROM customer""",
    "find_sort": """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
        ORDER BY o_orderdate DESC NULLS LAST, o_orderkey""",
    "log_collect": """SELECT doc_id, unnest(string_split(text, chr(10))) AS value, source AS job, 'document' AS kind FROM documents""",
    "shard_report": """SELECT cast(l_orderkey % 3 AS integer) AS shard, count(*) AS rows,
        round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM lineitem GROUP BY 1""",
    "shard_report_hashed": """SELECT cast(('0x' || substr(md5(l_orderkey::varchar), 1, 8))::bigint % 3 AS integer) AS shard,
        count(*) AS rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM lineitem GROUP BY 1""",
}
