import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from rivulet.functions import text as fn
from rivulet.operators import words
from rivulet.operators.anagrams import anagram_groups, anagram_lines
from rivulet.operators.words import (
    generation_word_counts, generation_word_totals, popular_lines, popular_words, tag_filter, tweet_words,
)
from rivulet.runtime import literal_table
from rivulet.sources.tweets import tweet_filter


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id INT, text STRING")


def test_letter_key_keeps_case_and_code_points(spark):
    row = texts(spark, "bAa").select(fn.letter_key("text").alias("k")).first()
    assert row.k == "Aab"


def test_anagram_example(spark):
    words = "abroad early natured unrated layer aboard untread leary relay relay lonely".split()
    df = spark.createDataFrame([(w,) for w in words], "word STRING")
    lines = anagram_lines(anagram_groups(df)).orderBy("place").collect()
    assert [r.line for r in lines] == ["early layer leary relay", "natured unrated untread", "aboard abroad"]


def test_tweet_words_rules(spark):
    df = texts(
        spark,
        "Hello, World! #Tag http://x.y 42 b-2",
        "kept before @stop lost",
        "@all lost",
        "mail a@b stays",
        "  gap\tand\nline ",
        "Ünï the END",
    )
    rows = tweet_words(df, ["the"]).groupBy("id").agg(F.collect_list("word").alias("w")).collect()
    assert {r.id: r.w for r in rows} == {
        0: ["hello", "world", "tag", "b-2"],
        1: ["kept", "before"],
        3: ["mail", "ab", "stays"],
        4: ["gap", "and", "line"],
        5: ["n", "end"],
    }


def test_stop_words_as_list_or_table_agree(spark):
    df = texts(spark, "a b c a", "b b")
    by_list = tweet_words(df, ["a"]).collect()
    by_table = tweet_words(df, literal_table(spark, "word", ["a", "a"], "string")).collect()
    assert sorted(by_list) == sorted(by_table) and len(by_list) == 4


def test_equal_words_of_equal_rows_come_once(spark):
    rows = [(1, "Storm, storm! the http://x.y 42 b-2"), (2, "storm"), (1, "STORM kept @stop lost"), (None, " gap\tand\nÜnï"), (1, None), (None, "gap"), (1, "a\x1fb ab\x0bc")]
    df = spark.createDataFrame(rows, "k INT, text STRING").coalesce(1)
    df = df.select("k", F.struct("k", F.lit("x").alias("x")).alias("s"), "text")
    plain = tweet_words(df, ["the"]).groupBy("k", "s", "word").count()
    counted = tweet_words(df, ["the"], times="n")
    assert sorted(map(tuple, counted.select("k", "s", "word", "n").collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert {(r.k, r.word): r.n for r in counted.collect()}[1, "storm"] == 3
    unlike = tweet_words(df.select(F.array("k").alias("k"), "text"), ["the"], times="n")
    assert unlike.agg(F.sum("n")).first()[0] == tweet_words(df, ["the"]).count()


def test_a_text_longer_than_a_piece_is_whole():
    texts = pa.array(["a b a", "c" * 50 + " a", None, "b"] * 3)
    keys = pa.array([1, 2, 1, 1] * 3)
    before, words.CUT_BYTES = words.CUT_BYTES, 20
    try:
        parts = words._word_times.func(texts, keys).to_pylist()
    finally:
        words.CUT_BYTES = before
    total = Counter()
    for key, part in zip(keys.to_pylist(), parts, strict=True):
        for w in part:
            total[key, w["word"]] += w["times"]
    assert total == {(1, "a"): 6, (1, "b"): 6, (2, "c" * 50): 3, (2, "a"): 3}


def test_keyword_filter(spark):
    df = spark.createDataFrame(
        [("Real goals, Madrid wins", "en"), ("real estate", "en"), ("USA!", "en"), ("usable", "en"), ("usa", "fr")],
        "text STRING, lang STRING",
    )
    got = [r.text for r in tweet_filter(df, ["real madrid", "USA"]).collect()]
    assert got == ["Real goals, Madrid wins", "USA!"]
    assert tweet_filter(df, []).count() == 4
    assert tweet_filter(df, ["Real-Madrid!", "?"]).count() == 1


def test_tag_filter_gives_one_row_and_the_tick(spark):
    tweets = spark.createDataFrame([(1, 10, "a #POOL #pool"), (2, 10, "none"), (3, 20, "#pool")],
                                   "event_id INT, generation_s BIGINT, text STRING")
    pairs = spark.createDataFrame([(10, 7, ["#pool", "#hbd", "#pool"])],
                                  "generation_s BIGINT, tick_s BIGINT, tags ARRAY<STRING>")
    assert [(r.event_id, r.generation_s) for r in tag_filter(tweets, pairs).collect()] == [(1, 7)]


def test_popular_words_half_and_single_word(spark):
    rows = [(1, w, c) for w, c in [("a", 3), ("b", 3), ("c", 1), ("d", 9), ("e", 1)]] + [(2, "only", 1)]
    counts = spark.createDataFrame(rows, "generation_s BIGINT, word STRING, cnt BIGINT")
    top = popular_words(counts)
    assert sorted((r.generation_s, r.place, r.word) for r in top.collect()) == [
        (1, 1, "d"), (1, 2, "a"), (2, 1, "only"),
    ]
    assert sorted(r.line for r in popular_lines(top).collect()) == ["1 d a", "2 only"]


def test_totals_sum_or_count_flushes(spark):
    words = spark.createDataFrame([(1, "a", f) for f in (0, 0, 1)], "generation_s BIGINT, word STRING, flush INT")
    partial = generation_word_counts(words, "flush")
    assert generation_word_totals(partial).first().cnt == 3
    assert generation_word_totals(partial, count_flushes=True).first().cnt == 2


def test_words_told_by_their_bytes_or_as_strings():
    rows = ["", "  ", "!! 42", "a\x1fb ab\x0bc", "abcdefgh abcdefghi ABCDEFGHI abcdefg\x00h", "Ünï\u00a0x é\xff -", " httq 1234567890a a-", "tail  "]
    distinct, number, sizes = words._numbered_words(pa.array(["q", *rows])[1:])
    want = [[w for t in row.split() if (w := re.sub("[^a-z0-9-]", "", t.lower()))] for row in (r.replace("\u00a0", "").replace("\x1f", "") for r in rows)]
    assert sizes.tolist() == [len(w) for w in want]
    assert [distinct[n].as_py() for n in number] == [w for ws in want for w in ws]
    assert len(set(w for ws in want for w in ws)) == len(set(number.tolist()))
