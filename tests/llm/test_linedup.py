import hashlib
from collections import defaultdict

from cases import ODD, docs, odd_docs

from rivulet.llm import linedup

BLANKS = "\t\n\x0b\x0c\r "


def plain(texts: dict) -> dict:
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = defaultdict(set)
    for i, text in texts.items():
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = {}
    for i, text in texts.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def result(df):
    return {r["doc_id"]: (int(r["n_lines"]), r["n_dropped"], r["text"]) for r in df.collect()}


def test_lines_equal_brute_force(spark):
    texts = [
        "A shared line here\nown line number one\nshort", "a SHARED line here  \nshort\nA shared line here",
        "own\n\tA shared line here\x0b\nÉtrange ligne à part", "étrange ligne à part\nÉtrange ligne à part\nlast",
        "twice in one document\ntwice in one document", *ODD,
    ]
    assert result(linedup.dedup_lines(docs(spark, *texts))) == plain(dict(enumerate(texts)))


def test_a_line_that_spans_many_slices(spark):
    texts = ["The very common line of all\nand one of its own %d" % i for i in range(400)]
    assert result(linedup.dedup_lines(docs(spark, *texts))) == plain(dict(enumerate(texts)))


def test_bitmaps_are_sparse_words(spark):
    lines = ["line %03d of the long text" % i for i in range(200)]
    table = docs(spark, lines[0] + "\n" + lines[130], "\n".join(lines))
    (row,) = linedup.dropped_lines(table).collect()
    assert row["doc_id"] == 1 and row["n_dropped"] == 2 and row["dropped"] == {0: 1, 2: 1 << 2}


def test_odd_rows(spark):
    got = linedup.dedup_lines(odd_docs(spark)).collect()
    assert len(got) == 10 and {r["_id"] for r in got} == {7, None}
    (blank,) = [r for r in got if r["doc_id"] is None]
    assert (blank["text"], blank["n_dropped"]) == ("a row without an id", 0)
    assert [r["n_dropped"] for r in got if r["doc_id"] == 7] == [2000]
    assert {hashlib.md5(r["text"].encode()).hexdigest() for r in got if r["doc_id"] == 5} == {
        hashlib.md5(ODD[5].encode()).hexdigest()
    }
    assert linedup.dedup_lines(odd_docs(spark).limit(0)).count() == 0
