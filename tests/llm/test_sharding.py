import zlib

from pyspark.sql import functions as F

from scrubline.llm import sharding


def checked(docs, shards=8):
    rows = docs.select("doc_id", "text").collect()
    found = sharding.shard(docs, shards).collect()
    want = sorted((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    loads = dict.fromkeys(range(shards), 0)
    for shard in range(shards):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    for r in found:
        loads[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None
    return found, loads


def test_loads_are_near_equal(spark):
    for folder in ("sf0.001", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
        found, loads = checked(docs)
        share = sum(loads.values()) / 8
        largest = max(r["size"] for r in found)
        assert all(abs(load - share) <= largest + 0.01 * share for load in loads.values())
        assert sorted(found) == sorted(sharding.shard(docs.repartition(3)).collect())


def test_a_group_of_copies_larger_than_a_shard_is_cut_and_others_are_not(spark):
    copies = spark.range(3000).select("id", F.lit("the same text again").alias("text"))
    others = spark.range(3000, 9000).selectExpr("id", "concat('text ', id % 2000) as text")
    docs = copies.union(others).withColumnRenamed("id", "doc_id")
    found, loads = checked(docs)
    share = sum(loads.values()) / 8
    assert all(abs(load - share) < 0.02 * share for load in loads.values())
    of_text = {}
    for r in found:
        of_text.setdefault(r.text_crc32, set()).add(r.shard)
    cut = [crc for crc, shards in of_text.items() if len(shards) > 1]
    assert cut == [zlib.crc32(b"the same text again")]


def test_write_shards(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    want = {r.doc_id: r.shard for r in sharding.shard(docs, 4).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == want
    assert back.drop("shard").exceptAll(docs).count() == 0


def plain(rows, shards):
    """Shard and slot of rows (k1, k2, size, doc_id) whose keys are unique, by cutting the sorted keys at each share."""
    total, load, out = sum(r[2] for r in rows), 0, []
    for k1, k2, size, doc_id in sorted(rows):
        out.append((min(shards - 1, int(shards * (load + size / 2) / total)), doc_id))
        load += size
    return out


def test_shards_are_runs_of_the_key_order_at_the_quantiles(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found, _ = checked(docs)
    keys = {r.doc_id: (r.k1, r.k2, r["size"], r.doc_id) for r in sharding.sized(docs).collect()}
    order = sorted(found, key=lambda r: (r.shard, r.slot))
    # Slots count on in key order, through all shards.
    assert [r.doc_id for r in order] == [k[3] for k in sorted(keys.values())]
    # Cutting between ranges instead of documents moves only rows near a boundary.
    wanted = {doc_id: shard for shard, doc_id in plain(list(keys.values()), 8)}
    moved = sum(r["size"] for r in found if wanted[r.doc_id] != r.shard)
    assert moved < 0.01 * sum(r["size"] for r in found)


def test_equal_rows_are_spread(spark):
    copies = spark.range(3000).selectExpr("cast(7 as long) as doc_id", "'one text for all' as text")
    others = spark.range(100, 6100).selectExpr("id as doc_id", "concat('text number ', id % 2500) as text")
    docs = copies.union(others)
    found, loads = checked(docs.repartition(5))
    share = sum(loads.values()) / 8
    assert all(abs(load - share) < 0.02 * share for load in loads.values())
    assert len(found) == 9000


def test_write_shards_beside_clashing_columns(spark, tmp_path):
    copies = spark.range(3000).selectExpr("cast(7 as long) as doc_id", "'one text for all' as text")
    others = spark.range(100, 3100).selectExpr("id as doc_id", "concat('text number ', id % 500) as text")
    docs = copies.union(others).withColumns({c: F.lit("x") for c in ("shard", "_id", "_crc", "n")})
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*docs.columns, "_shard"} and back.drop("_shard").exceptAll(docs).count() == 0
    sizes = {r[0]: r[1] for r in back.groupBy("_shard").agg(F.sum(F.length("text") + 1)).collect()}
    share = sum(sizes.values()) / 4
    assert all(abs(size - share) < 0.1 * share for size in sizes.values())
