import hashlib
import random
import zlib
from collections import Counter

from cases import docs, odd_docs
from pyspark.sql import functions as F

from rivulet.llm import sharding


def plain(rows, shards, seed=sharding.SEED):
    """Positions by sorting everything; ``rows`` are (doc_id, source, text)."""
    slim = []
    for i, source, text in rows:
        data = (text or "").encode()
        turn = hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        slim.append((source or "", (turn, -1 if i is None else i, zlib.crc32(data), len(data) + 8)))
    size, rank, fractions = Counter(s for s, _ in slim), Counter(), []
    for source, key in sorted(slim):
        rank[source] += 1
        fractions.append(((2 * rank[source] - 1) / (2 * size[source]), *key, source))
    out = []
    for place, (_, _, i, crc, n, _) in enumerate(sorted(fractions)):
        shard = place * shards // len(slim)
        out.append((i, n, crc, shard, place - -(-shard * len(slim) // shards)))
    return sorted(out)


def dealt(table, shards=24):
    rows = sharding.interleave(table, shards).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows)


def rows_of(table):
    return [(r.doc_id, r.source, r.text) for r in table.collect()]


def many(spark, n=500):
    rng = random.Random(3)
    rows = [(i, "same" if i % 3 else "x" * i, "en", "hot" if i % 3 == 0 else rng.choice(["a", "b", None, ""]), 1, "l", 2, "i", "n") for i in range(n)]
    return spark.createDataFrame(rows, docs(spark).schema)


def test_equals_sorting_everything(spark):
    table = many(spark)
    assert dealt(table) == plain(rows_of(table), 24)
    assert dealt(table, 7) == plain(rows_of(table), 7)


def test_shards_are_even_and_hold_the_mixture(spark):
    table = many(spark)
    rows = sharding.interleave(table).collect()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(24):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))
    for source, n in Counter(r.source for r in rows).items():
        per_shard = Counter(r.shard for r in rows if r.source == source)
        assert all(abs(per_shard[s] - n / 24) <= 2 for s in range(24))


def test_odd_rows_few_rows_and_no_rows(spark):
    table = odd_docs(spark)
    assert dealt(table) == plain(rows_of(table), 24)
    assert dealt(table.limit(3)) == plain(rows_of(table.limit(3)), 24)
    assert dealt(docs(spark)) == []


def test_written_shards_hold_whole_rows_in_slot_order(spark, tmp_path):
    table = odd_docs(spark).unionByName(many(spark, 100)).withColumn("shard", F.lit("old"))
    back = sharding.write_shards(table, str(tmp_path / "out"), 5)
    whole = [c for c in table.columns if c != "shard"]
    as_rows = lambda df: Counter(tuple(r) for r in df.select(whole).collect())
    assert as_rows(back) == as_rows(table)
    spots = [(-1 if r.doc_id is None else r.doc_id, r.shard, r.slot) for r in back.collect()]
    assert sorted(spots) == sorted((i, s, t) for i, _, _, s, t in dealt(table.drop("shard"), 5))


def test_seed_deals_anew(spark):
    table = many(spark, 60)
    first, other = sharding.interleave(table), sharding.interleave(table, seed=8)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))
