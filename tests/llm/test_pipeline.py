"""Each stage of the pipeline against a plain version, on its own input."""

import public_tokenizers
import pytest
import tiktoken
from cases import near_groups, odd_docs
from test_linedup import plain

import corpus_pipeline
from rivulet.llm import bpe, langid
from rivulet.llm import decontaminate as dc
from rivulet.llm.jaccard import word_hashes

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """The input of each stage and the final result, as written tables, with some documents planted."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = docs.orderBy("doc_id").first()["text"]
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first()["text"].split(" ")
    leak = "A few own words come before it. " + " ".join(item[:6] + ["changed"] + item[7:]) + " And some come after it."
    planted = [
        (10_001, "12 34 -- 56\n", "en", "x", None), (10_002, None, None, None, None), (10_003, first, "en", "x", 1),
        (10_004, leak, "en", "x", 5), (10_004, leak, "en", "x", 5), (10_005, "", "en", "x", 0),
    ]
    table = docs.union(spark.createDataFrame(planted, docs.schema))
    tables = [table]
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF_DIR).write.parquet(f"{folder}/{at}")
        tables.append(spark.read.parquet(f"{folder}/{at}"))
    return tables


def texts(table):
    return {r["doc_id"]: r["text"] for r in table.collect()}


def test_columns_stay_up_to_the_last_stage(inputs):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(table.columns == COLUMNS for table in inputs[:-1])
    assert set(COLUMNS) < set(inputs[-1].columns)


def test_language_id_keeps_clean_documents(spark, inputs):
    before, after = texts(inputs[0]), texts(inputs[1])
    model = langid.train(inputs[0].where(~langid.held_out()))
    sure = {i for i, t in before.items() if (p := model.predict(t))[0] != "und" and p[1] >= corpus_pipeline.LEAST_SCORE}
    assert set(after) == sure and all(after[i] == before[i] for i in after)
    assert not {10_001, 10_002, 10_005} & set(after) and len(after) >= 0.99 * (len(before) - 3)


def test_lines(inputs):
    before, after = texts(inputs[1]), texts(inputs[2])
    expected = {i: kept for i, (_, dropped, kept) in plain(before).items() if not dropped or kept.split()}
    assert after == expected
    assert all(r["n_chars"] == len(r["text"]) for r in inputs[2].collect())


def test_near_duplicates(inputs):
    before, after = texts(inputs[2]), texts(inputs[3])
    groups = near_groups(before, 5, 80)
    assert after == {i: t for i, t in before.items() if groups[i][1] == i}


def test_decontamination(spark, inputs):
    before, after = texts(inputs[3]), texts(inputs[4])
    items = [word_hashes(r["text"]).tolist() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaks = {
        i for i, t in before.items()
        if any(dc.edit_passage(item, word_hashes(t).tolist())[0] <= int(dc.RATE * len(item)) for item in items)
    }
    assert 10_004 in leaks and set(after) == set(before) - leaks


def test_tokens(inputs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.decoder(path).ranks
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = inputs[5].collect()
    assert texts(inputs[5]) == texts(inputs[4])
    for row in rows:
        assert row["ids"] == other.encode_ordinary(row["text"]) and row["n_tokens"] == len(row["ids"]) and row["round_trip"]


def test_stages_take_odd_and_empty_tables(spark):
    odd = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF_DIR).count() <= 10
        assert stage(spark, odd.limit(0), SF_DIR).count() == 0
