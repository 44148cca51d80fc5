import random
import zlib
from collections import Counter

from llm_rows import documents, odd_texts
from pyspark.sql import functions as F

from scorelake.llm import shards
from scorelake.llm.queries import QUERIES


def test_places_are_a_permutation_and_the_way_back_is_its_inverse(spark):
    for rows in (1, 2, 3, 10, 97, 1000):
        numbers = spark.range(rows)
        placed = shards.permuted(numbers, "id", "place", rows)
        back = shards.permuted(placed, "place", "again", rows, back=True).collect()
        assert sorted(r.place for r in back) == list(range(rows))
        assert all(r.again == r.id for r in back)
    assert [r.place for r in sorted(back)] != list(range(rows))


def test_walks_stay_exact_where_much_lies_outside(spark):
    # 3 x 2 values for 5 rows, 5 x 4 for 17: some rows must walk.
    for seed in range(12):
        for rows in (5, 17):
            got = shards.permuted(spark.range(rows), "id", "place", rows, seed).select("place").collect()
            assert sorted(r.place for r in got) == list(range(rows))


def test_every_row_gets_a_slot_of_its_own(spark):
    texts = odd_texts(random.Random(1))
    rows = [(n % 7, text) for n, text in enumerate(texts * 3)] + [(None, None), (5, "same"), (5, "same"), (5, "same")]
    got = shards.shard_documents(documents(spark, rows, clashing=True)).collect()
    assert len(got) == len(rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts[s] for s in range(shards.SHARDS)) <= 1
    for shard, count in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(count))
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected


def test_same_rows_in_another_layout_go_to_the_same_places(spark):
    docs = documents(spark, [(n, f"text {n}") for n in range(300)])
    one = sorted(shards.shard_documents(docs).collect())
    two = sorted(shards.shard_documents(docs.repartition(7)).collect())
    assert one == two


def test_no_rows(spark):
    assert shards.shard_documents(documents(spark, [])).count() == 0


def test_shards_on_disk_are_in_the_order_of_slots(spark, tmp_path):
    docs = documents(spark, [(n, f"text {n}") for n in range(100)])
    shards.write_shards(shards.shard_documents(docs, shards=3), str(tmp_path / "out"))
    for shard in range(3):
        part = spark.read.parquet(str(tmp_path / "out")).filter(F.col("shard") == shard)
        assert sorted(r.slot for r in part.collect()) == list(range(part.count()))


def test_query_follows_row_numbers(spark):
    got = QUERIES["op10_feistel_shards"](spark, "/root/testdata/sf0.001")
    rows = got.orderBy("doc_id").collect()
    back = shards.row_at(got.select("doc_id", "shard", "slot"), len(rows)).orderBy("doc_id").collect()
    assert [r.row_number for r in back] == list(range(len(rows)))
    assert {r.law for r in rows} == {"rows"} and all(r.grown_shard is None for r in rows)
