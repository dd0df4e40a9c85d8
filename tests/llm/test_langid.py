import zlib

import numpy as np
from cases import docs, odd_docs

from rivulet.llm import langid
from rivulet.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op3_sparse_langid"](spark, SF_DIR).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_weights_are_sparse_and_training_repeats(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("lang IN ('de', 'es')")
    one, two = langid.train(table), langid.train(table)
    assert one.languages == ["de", "es"] and (one.weights == 0).mean() > 0.5
    assert np.array_equal(one.weights, two.weights) and one.temperature == two.temperature
    assert 1 / 8 <= one.temperature <= 8


def test_label_and_source_are_no_inputs(spark):
    model = langid.Model(["aa", "bb"], np.ones(1 << 16), np.zeros((1 << 16, 2), dtype=np.float32), np.array([0.0, 1.0]), 1.0)
    rows = langid.predict(odd_docs(spark), model, language="leaks").collect()
    assert len(rows) == 10
    for row in rows:
        has_letter = any(c.isalpha() for c in row["text"] or "")
        assert row["leaks"] == ("bb" if has_letter else "und") and (row["score"] > 0.5) == has_letter
    assert langid.predict(odd_docs(spark).limit(0), model).count() == 0


def test_without_labels_or_rows(spark):
    table = docs(spark, "some text", "more text", langs=[None, None])
    model = langid.train(table)
    assert model.languages == [] and model.predict("text") == ("und", 0.0)
    assert langid.train(table.limit(0)).languages == []
    single = langid.train(docs(spark, "some text", None, "1 2", langs=["xx", "yy", None]))
    assert single.languages == ["xx"] and single.predict("any") == ("xx", 1.0)


def test_buckets_of_whole_texts():
    assert len(langid.buckets(None)) == len(langid.buckets("12 .\n")) == 0
    once, longer = set(langid.buckets("Aé").tolist()), set(langid.buckets("aé " * 50_000 + "zß").tolist())
    assert once < longer
    assert langid.buckets("A!!B").tolist() == langid.buckets("a b").tolist()


def test_copies_neither_hide_nor_crowd_out_a_language(spark):
    english = ["the %d cats sat on the mat with words" % i for i in range(40)]
    german = ["der %d Hund läuft über das grüne Feld und bellt" % i for i in range(10)]
    table = docs(spark, *german * 30, *english, langs=["de"] * 300 + ["en"] * 40)
    sample = langid._sample(table, "text", "lang", 20).collect()
    assert sum(r["_label"] == "de" for r in sample) == 10 and 5 <= sum(r["_label"] == "en" for r in sample) <= 39
    model = langid.train(table, per_language=20)
    assert model.predict("der Hund läuft über das Feld")[0] == "de"
    assert model.predict("the cats sat on the mat")[0] == "en"
