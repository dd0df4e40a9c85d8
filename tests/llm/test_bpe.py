import random

import public_tokenizers
import pytest
import tiktoken
from cases import ODD, odd_docs

from rivulet.llm import bpe
from rivulet.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    mine = bpe.Codec(PATH, public_tokenizers.PATTERN)
    return mine, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=mine.ranks, special_tokens={})


def test_equal_to_the_merges(both):
    mine, other = both
    rng = random.Random(1)
    alphabet = "aaabbb  \n\t'sé漢字🙂123,.!? \r the ing thethe<|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(4000)]
    texts += [rng.choice("a0 漢é!-=") * rng.randint(1, 400) for _ in range(300)]
    vocabulary = list(mine.ranks)
    texts += [b"".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 8))).decode("utf-8", "ignore") for _ in range(4000)]
    for text in texts + [t for t in ODD if t]:
        ids = mine.encode(text)
        assert ids.tolist() == other.encode_ordinary(text)
        assert mine.decode(ids) == text.encode()


def test_full_memos_change_nothing(both, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 8)
    mine, other = bpe.Codec(PATH, public_tokenizers.PATTERN), both[1]
    text = " ".join("word%d again" % (i % 40) for i in range(300))
    assert mine.encode(text).tolist() == other.encode_ordinary(text)


def test_round_trip_of_odd_rows(spark, both):
    encoded = bpe.encode(odd_docs(spark), PATH, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, PATH).collect()
    assert len(rows) == 10
    for row in rows:
        assert bytes(row["data"]) == (row["text"] or "").encode()
        assert row["ids"] == both[1].encode_ordinary(row["text"] or "")
    assert bpe.encode(odd_docs(spark).limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_digests(spark, both):
    import hashlib
    import struct

    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op7_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = both[1].encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_round_trip_in_one_pass_keeps_columns_and_ends_the_codec(spark):
    table = odd_docs(spark)
    rows = bpe.round_trip(table, PATH, public_tokenizers.PATTERN).collect()
    other = {(r["doc_id"], r["text"]): r["ids"] for r in bpe.encode(table, PATH, public_tokenizers.PATTERN).collect()}
    assert len(rows) == table.count()
    for row in rows:
        assert row["ids"] == other[row["doc_id"], row["text"]] and row["n_tokens"] == len(row["ids"]) and row["round_trip"]
        assert row["lang"] is None or row["lang"] == "en"
    assert bpe.round_trip(table.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    part = table.select("text").limit(2).toArrow().to_batches()
    list(bpe.tidy(lambda parts: (bpe.codec(PATH, public_tokenizers.PATTERN).encode_batch(p.column(0)) for p in parts), bpe.codec)(part))
    assert bpe.codec.cache_info().currsize == 0
