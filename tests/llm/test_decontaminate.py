import random

import pytest
from cases import ODD, docs, edited, odd_docs, prose

from rivulet.llm import decontaminate as dc
from rivulet.llm.jaccard import word_hashes


def plain_passage(item, words):
    """Smallest edit distance of ``item`` to any passage of ``words``, by the full table."""
    above = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(words, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (a != b)))
        above = row
    return min(above)


def test_passage_search_is_exact():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 30))]
        words = [rng.randrange(6) for _ in range(rng.randint(0, 60))]
        edits, start, end = dc.edit_passage(item, words)
        assert edits == plain_passage(item, words)
        passage = words[start:end]
        row = list(range(len(passage) + 1))
        for i, a in enumerate(item, 1):
            new = [i]
            for j, b in enumerate(passage, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
            row = new
        assert row[-1] == edits


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, leaks string")


def test_planted_passages(spark):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.randint(6, 70)), "x") for i in range(30)]
    texts, truth = [], []
    for k in range(240):
        number, item, _ = rng.choice(items)
        allowed = int(dc.RATE * len(item.split()))
        copy = edited(rng, item, rng.randint(0, allowed)).upper() if k % 4 else ""
        text = prose(rng, 80) + "\n" + copy + " " + prose(rng, 90)
        texts.append(text)
        words = word_hashes(text).tolist()
        truth.append({
            (i, plain_passage(word_hashes(x).tolist(), words))
            for i, x, _ in items
            if plain_passage(word_hashes(x).tolist(), words) <= int(dc.RATE * len(x.split()))
        })
    for blocks in (5_000, 7):
        rows = dc.mark_leaks(docs(spark, *texts), items_table(spark, items), block_items=blocks).collect()
        got = {r["doc_id"]: {(leak["item_id"], leak["edits"]) for leak in r["leaks"]} for r in rows}
        found = sum(len(got[d] & truth[d]) for d in got)
        planted = sum(map(len, truth))
        assert planted > 150 and found >= 0.99 * planted
        assert all({i for i, _ in got[d]} <= {i for i, _ in truth[d]} for d in got)  # nothing clean is touched


@pytest.mark.parametrize("size", [6, 10, 15, 40])
def test_recall_of_the_samples(size):
    """At the largest number of edits, windows agree with their item in a sample in nearly all cases."""
    rng = random.Random(size)
    hit = tried = 0
    for _ in range(150):
        item = prose(rng, size)
        index = dc.Index([(1, item)], dc.RATE)
        text = prose(rng, 30) + " " + edited(rng, item, index.edits[0]) + " " + prose(rng, 30)
        if plain_passage(index.words[0].tolist(), word_hashes(text).tolist()) <= index.edits[0]:
            tried += 1
            hit += bool(index.find(text))
    assert hit >= 0.98 * tried


def test_odd_rows(spark):
    long = " ".join(ODD[-1].split()[20:40])
    items = items_table(spark, [(1, long, "x"), (2, None, None), (3, "", "x"), (4, "too short", "x"), (None, long, "x")])
    rows = dc.mark_leaks(odd_docs(spark), items).collect()
    assert len(rows) == 10 and all(r["_id"] in (7, None) for r in rows)
    assert {r["doc_id"]: sorted((leak["item_id"] or 0, leak["edits"]) for leak in r["leaks"]) for r in rows if r["leaks"]} == {
        6: [(0, 0), (1, 0)], 7: [(0, 0), (1, 0)]
    }
    assert dc.mark_leaks(odd_docs(spark).limit(0), items).count() == 0
    assert all(not r["leaks"] for r in dc.mark_leaks(odd_docs(spark), items.limit(0)).collect())


def test_repeating_items_and_texts():
    index = dc.Index([(1, "a " * 40), (2, "a b " * 20)], dc.RATE)
    assert [(i, e) for i, e, *_ in index.find("a " * 3000)] == [(1, 0)]
    assert index.find("c " * 3000) == []
