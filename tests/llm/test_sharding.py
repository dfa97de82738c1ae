import zlib
from collections import defaultdict

from merchlake.llm.sharding import SEED, key_shard, shard_digest, slots, write_shards


def test_every_document_has_one_slot(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = shard_digest(docs, 24).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by_shard = defaultdict(list)
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32) == (len(data) + 8, zlib.crc32(data))
        assert row.law == "key" and row.grown_shard in (row.shard, 24)
        by_shard[row.shard].append(row.slot)
    assert sorted(by_shard) == list(range(24))
    for found in by_shard.values():
        assert sorted(found) == list(range(len(found)))
    moved = sum(r.grown_shard == 24 for r in rows)
    assert 10 < moved < 90


def test_many_buckets_keep_slots_gapless_and_rows_whole(spark, work):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    written = write_shards(docs, 3, f"{work}/shards", bucket_bytes=20_000)
    rows = slots(written).collect()
    assert sorted(tuple(r.doc) for r in rows) == sorted(map(tuple, docs.collect()))
    assert len({(r.shard, r.bucket) for r in rows}) > 6
    for shard in range(3):
        own = sorted((r.slot, r.bucket, r.place) for r in rows if r.shard == shard)
        assert [s for s, _, _ in own] == list(range(len(own)))
        assert own == sorted(own, key=lambda r: r[1:])
    again = slots(write_shards(docs, 3, f"{work}/again", bucket_bytes=20_000)).collect()
    place = {r.doc.doc_id: (r.shard, r.slot) for r in rows}
    assert place == {r.doc.doc_id: (r.shard, r.slot) for r in again}
    by_slot = [i for i, _ in sorted(place.items(), key=lambda item: item[1])]
    assert by_slot != sorted(by_slot)


def test_rank_of_hashes_decides_the_shard(spark):
    ids = spark.range(500).select("id", key_shard("id", 5, SEED).alias("a"), key_shard("id", 6, SEED).alias("b"))
    rows = ids.collect()
    assert {r.a for r in rows} == set(range(5))
    assert all(r.b in (r.a, 5) for r in rows)


def test_nulls_repeats_and_clashing_columns(spark):
    schema = "doc_id long, text string, shard string, bucket int, place int, slot long"
    rows = [(1, None, "x", 1, 2, 3), (None, "two", None, None, None, None), (3, "", "y", 0, 0, 0), (3, "", "y", 0, 0, 0)]
    found = shard_digest(spark.createDataFrame(rows, schema), 2).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in found) == [
        (0, 11, zlib.crc32(b"two")), (1, 8, 0), (3, 8, 0), (3, 8, 0),
    ]
    assert len({(r.shard, r.slot) for r in found}) == 4
    assert shard_digest(spark.createDataFrame([], schema), 2).collect() == []
