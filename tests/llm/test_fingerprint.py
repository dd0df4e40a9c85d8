import hashlib
import random

import numpy as np
from cases import ODD, docs, odd_docs, prose

from rivulet.llm import fingerprint as fp


def expected(texts: list) -> dict:
    out = {}
    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = (fp.vector(fp.units(t)) for t in (text, edited, after))
        out[i] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.to_text(own), fp.to_text(other),
            fp.likeness(own, other), fp.likeness(own, following),
        )
    return out


def test_multisets_add_up():
    a, b, c = "one sentence.", "another one!", "a third"
    whole = fp.vector([a, b, c, a])
    assert np.array_equal(whole, fp.vector([c, a, a, b]))
    assert np.array_equal(fp.combine(fp.vector([a, b]), [c, a]), whole)
    assert np.array_equal(fp.combine(whole, deleted=[a, c]), fp.vector([a, b]))
    assert not np.array_equal(whole, fp.vector([a, b, c]))
    assert np.array_equal(fp.from_text(fp.to_text(whole)), whole)
    assert fp.units("One. Two.\n\n  Three \n") == ["One.", "Two.", "Three"]


def test_likeness_follows_what_is_common():
    lines = ["line number %d" % i for i in range(100)]
    whole = fp.vector(lines)
    shares = [fp.likeness(whole, fp.vector(lines[:k] + ["other %d" % i for i in range(100 - k)])) for k in (0, 50, 90)]
    assert shares[0] < 0.2 and 0.35 < shares[1] < 0.65 and 0.8 < shares[2] < 1
    assert fp.likeness(fp.vector([]), fp.vector([])) == 1.0 and fp.likeness(fp.vector([]), whole) == 0.0


def plain_likeness(left: list, right: list) -> float:
    """The cosine of integer sums that never wrap."""
    sums = []
    for members in (left, right):
        total = np.zeros(fp.LANES, dtype=np.int64)
        for member in members:
            total += np.frombuffer(hashlib.shake_128(member.encode()).digest(fp.LANES), dtype=np.int8)
        sums.append(total.astype(np.float64))
    return float(sums[0] @ sums[1] / np.sqrt((sums[0] @ sums[0]) * (sums[1] @ sums[1])))


def test_repeated_lines_do_not_wrap(spark):
    texts = ["the same line\n" * 1000 + "".join("own line %d of %d\n" % (i, k) for i in range(20)) for k in range(2)]
    rows = {r["doc_id"]: r for r in fp.compare_edits(docs(spark, *texts)).collect()}
    for own, after in ((0, 1), (1, 0)):
        half = len(texts[own]) // 2
        edited = texts[own][: len(texts[own]) - half] + texts[after][:half]
        parts = [fp.units(t) for t in (texts[own], edited, texts[after])]
        assert abs(rows[own]["near_edited"] - plain_likeness(parts[0], parts[1])) < 1e-9
        assert abs(rows[own]["near_next"] - plain_likeness(parts[0], parts[2])) < 1e-9
        assert rows[own]["near_edited"] > 0.99 and rows[own]["near_next"] > 0.99


def test_edits_equal_the_plain_version(spark):
    texts = ["Text %d begins here. It goes on.\nAnd on %d." % (i, i // 3) * (1 + i % 4) for i in range(150)] + ODD
    rows = fp.compare_edits(docs(spark, *texts)).collect()
    assert len(rows) == len(texts)
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected(texts)


def test_small_and_odd_tables(spark):
    (one,) = fp.compare_edits(docs(spark, "Alone. Here.")).collect()
    assert tuple(one)[1:] == expected(["Alone. Here."])[0]
    rows = fp.compare_edits(odd_docs(spark)).collect()
    assert len(rows) == 10 and len({r["fingerprint"] for r in rows if r["doc_id"] in (6, 7)}) == 1
    assert {r["n_chars"] for r in rows if r["doc_id"] is None} == {19}
    assert fp.compare_edits(odd_docs(spark).limit(0)).count() == 0
    marked = fp.fingerprints(odd_docs(spark), name="ids").collect()
    assert len(marked) == 10 and all(r["n_lines"] in ("z", None) for r in marked)


def test_half_kept_texts_stay_alike_without_sentences(spark):
    rng = random.Random(2)
    texts = [prose(rng, 60) for _ in range(30)] + ["x%d" % i * 400 for i in range(5)] + [prose(rng, 12) for _ in range(30)]
    rows = {r["doc_id"]: r for r in fp.compare_edits(docs(spark, *texts)).collect()}
    assert all(rows[i]["near_edited"] > 0.2 for i in range(34)), [rows[i]["near_edited"] for i in range(35)]
    assert sum(rows[i]["near_edited"] > 0.1 for i in range(35, 65)) >= 24
    assert all(rows[i]["near_next"] < 0.3 for i in range(64) if i not in range(30, 35))


def test_units_of_long_sentences_follow_the_words():
    words = prose(random.Random(3), 200)
    whole = fp.units(words)
    assert len(whole) > 20 and " ".join(whole) == words
    edited = fp.units(words[: len(words) // 2] + " zzz")
    assert len(set(whole) & set(edited)) >= len(edited) - 2
    assert fp.units("a" * 100) == ["a" * 32] * 3 + ["a" * 4]
