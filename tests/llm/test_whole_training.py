"""The classifiers of op1 and op10 learn from all that is labelled."""

import pytest
from cases import docs
from pyspark.sql import functions as F

from rivulet.llm import pii, secrets


class _Fitted(Exception):
    pass


class _Recorder:
    def __init__(self, **options):
        self.options = options

    def fit(self, df):
        raise _Fitted(*df.agg(F.sum(self.options["weightCol"]), F.count(F.lit(1)), F.max(self.options["weightCol"])).first())


def test_trees_learn_from_every_labelled_candidate(spark, monkeypatch):
    texts = [f"write to a{i}@b.org or 10.0.0.{i} or 999.0.0.{i}" for i in range(60)]
    found = pii.candidates(docs(spark, *texts), pii.GENERATORS, "doc_id", "text")
    monkeypatch.setattr(pii, "GBTClassifier", _Recorder)
    order = F.pmod(F.xxhash64("_id", "_hash", "_kind", "_start"), F.lit(4))
    labelled = found.where(pii.labels().isNotNull() & (order != 0)).withColumn("_l", pii.labels())
    n = {r["_l"]: r["count"] for r in labelled.groupBy("_l").count().collect()}
    with pytest.raises(_Fitted) as whole:
        pii.judged(found)
    assert whole.value.args[0] == sum(n.values())
    with pytest.raises(_Fitted) as weighed:  # a class weighs 10, and all of it takes part
        pii.judged(found, weight=10)
    assert weighed.value.args[1] == whole.value.args[1] and weighed.value.args[0] < whole.value.args[0] / 2


def test_the_forest_learns_from_every_labelled_finding(spark, monkeypatch):
    texts = [(i, f"password = 'aX{i}k9Lm{i * 7}Qz{i * 13}t' and then seen 4f{i:03d}e8a9b7c6d5e4f3a2b1 in text") for i in range(60)]
    rows = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    monkeypatch.setattr(secrets, "RandomForestClassifier", _Recorder)
    with pytest.raises(_Fitted) as whole:
        secrets.find_secrets(rows)
    with pytest.raises(_Fitted) as weighed:
        secrets.find_secrets(rows, weight=10)
    assert weighed.value.args[1] == whole.value.args[1] > 60 and whole.value.args[2] == 1.0 > weighed.value.args[2]
