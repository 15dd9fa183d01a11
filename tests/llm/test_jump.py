import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import jump

DOCS = "doc_id long, text string, shard string, lang string"


def published(key, shards):
    held, ahead = -1, 0
    while ahead < shards:
        held = ahead
        key = (key * 2862933555777941757 + 1) & 0xFFFFFFFFFFFFFFFF
        ahead = int((held + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return held


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 300])
def test_equals_the_published_function(spark, shards):
    keys = [0, 1, 2, 7, 12345, 2**40 + 17, 2**63 - 1, -1, -(2**63), *range(100, 300)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump.jump_hash(F.col("k"), shards).alias("s"))
    assert {r.k: r.s for r in rows.collect()} == {k: published(k & 0xFFFFFFFFFFFFFFFF, shards) for k in keys}


def test_documents(spark):
    data = [(i, f"text {i}", "x", "en") for i in range(200)] + [(None, None, "x", None), (7, "ä" * 50000, "y", None)]
    data += [(1000, "same", "z", "fr")] * 300
    docs = spark.createDataFrame(data, DOCS).repartition(3)
    rows = jump.shard_documents(docs, 8).collect()
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in data)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    for r in rows:
        assert r.shard == published(r.doc_id or 0, 8)
        assert r.grown_shard in (r.shard, 8)


def test_numbers_do_not_depend_on_the_pieces(spark):
    rows = spark.range(500).select("id", (F.col("id") % 3).cast("int").alias("shard"))
    one, other = (jump.number_slots(rows, pieces_bits=b).collect() for b in (2, 9))
    assert {r.id: r.slot for r in one} == {r.id: r.slot for r in other}


def test_clashing_names_and_empty(spark):
    docs = spark.createDataFrame([(1, "a", "old", "en")], DOCS)
    assert jump.with_shards(docs, "doc_id", 4).collect()[0].shard == published(1, 4)
    assert jump.shard_documents(docs.limit(0)).count() == 0
