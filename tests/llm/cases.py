"""Small tables with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaks string, _id long, ids string, n_lines string"


def docs(spark, *texts, langs=None):
    """Documents with ids from 0, and columns whose names the operators use themselves."""
    langs = langs or ["en"] * len(texts)
    rows = [
        (i, text, lang, "src0", None if text is None else len(text), "x", 7, "y", "z")
        for i, (text, lang) in enumerate(zip(texts, langs, strict=True))
    ]
    return spark.createDataFrame(rows, DOCS)


LONG = "The quick brown fox no. %d jumps over the lazy dog near line %d of this rather long text.\n"
ODD = [
    None,
    "",
    " \t\n",
    "one",
    "one",
    "Ünïcödé — 漢字 🙂 text",
    "".join(LONG % (i, i) for i in range(2000)),
    "".join(LONG % (i, i) for i in range(2000)),
]


def odd_docs(spark):
    """Nulls in every column, blank and very long texts, ties, and the last two rows the same."""
    table = docs(spark, *ODD)
    blank = spark.createDataFrame([(None, "a row without an id", None, None, None, None, None, None, None)], DOCS)
    twice = table.where("doc_id = 5")
    return table.union(blank).union(twice)


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_groups(texts: dict, width: int, percent: int) -> dict:
    """Per id the size of its set and the smallest id that links reach, by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    low = {i: i for i in sets}
    changed = True
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            least = min(low[a], low[b])
            if (low[a], low[b]) != (least, least):
                low[a] = low[b] = least
                changed = True
    return {i: (len(sets[i]), low[i]) for i in sets}


def prose(random, words=120):
    """Invented prose; repeated calls give unrelated texts."""
    pieces = ["ka", "lo", "mi", "ter", "ans", "ou", "re", "vin", "sta", "elt", "or", "ba"]
    return " ".join("".join(random.choice(pieces) for _ in range(random.randint(1, 4))) for _ in range(words))


def edited(random, text, edits):
    """``text`` with so many words replaced, left out or put in."""
    words = text.split(" ")
    for _ in range(edits):
        at = random.randrange(len(words))
        words[at : at + random.choice([0, 1, 1])] = random.choice([[], ["zzz%d" % random.randrange(999)]])
    return " ".join(words)
