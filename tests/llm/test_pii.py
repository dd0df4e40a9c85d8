import hashlib
import random
import re

from cases import docs, odd_docs

from rivulet.llm import pii

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base(text):
    out = []
    for place, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            right = {
                "email": lambda v, d: True,
                "ip": lambda v, d: all(int(x) <= 255 for x in v.split(".")),
                "card": lambda v, d: 14 <= len(d) <= 19 and luhn(d),
                "phone": lambda v, d: 10 <= len(d) <= 15,
            }[kind]
            if right(m[0], digits):
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}", kind))
    return sorted(out)


def check(table):
    rows = pii.span_digests(table).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    for row in rows:
        found = base(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(x[2] for x in found).encode()).hexdigest(), texts[row["doc_id"]][:200]
        assert [row[f"n_{k}"] for k in KINDS] == [sum(x[3] == k for x in found) for k in KINDS]
        spans = row["spans"].split(",") if row["spans"] else []
        assert {x[2] for x in found} <= set(spans) and len(spans) == len(found) + row["n_added"]
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
    return rows


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(4)
    parts = ["a@b.c", "x", "@", ".", "..", "1.2.3.4", "999.1.1.1", "+1 ", "(555) ", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "0", "12", "-", " ", "+", "é", "🙂", "_", "%", "q.r@s-t.u.v", "256.0.0.1", "007.08.9.10", "+49 30 1234567", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(600)]
    texts += ["9" * 4_000, "1.2" * 2_000, "a" * 6_000 + "@x.y", "1 2-3" * 900, "+1" + "(" * 3_000, "a.b@c" * 900]
    check(docs(spark, *texts))


def test_looser_kinds_are_judged(spark):
    rng = random.Random(5)

    def phone(plus):
        return f"{plus}1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"

    texts = [f"call me at {phone('+')} or mail me.{i}@mail.example.com today" for i in range(120)]
    texts += [f"in {1900 + i} there were {i} of {i * 7} units, page {i}-{i + 1}, 10 000 in all" for i in range(120)]
    texts += ["write to some.one (at) example (dot) com please", "version 10.20.3000.4 of 12-13-14"]
    rows = {r["doc_id"]: r for r in check(docs(spark, *texts))}
    assert sum(r["n_added"] for i, r in rows.items() if 120 <= i < 240) == 0  # clean texts are left alone


def iban(rng, land, size, letters=0):
    body = "".join(rng.choice("ABCDEFGHIJK") for _ in range(letters)) + "".join(str(rng.randrange(10)) for _ in range(size - 4 - letters))
    check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
    return f"{land}{check:02d}{body}"


def test_looser_kinds_are_added_whole(spark):
    rng = random.Random(6)
    lands = [("DE", 22, 0), ("GB", 22, 4), ("FR", 27, 0), ("NL", 18, 4), ("NO", 15, 0), ("AT", 20, 0)]
    planted = []
    for i in range(180):
        plain = iban(rng, *lands[i % 6])
        planted.append(("account", plain if i % 2 else " ".join(plain[k : k + 4] for k in range(0, len(plain), 4))))
    planted += [("number", f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}") for _ in range(90)]
    planted += [("written", f"some.one{i} (at) example (dot) com") for i in range(90)]
    says = {"account": "pay to ", "number": "tel. ", "written": "write to "}
    texts = [f"{says[kind]}{value} OK then" for kind, value in planted]
    wrong = [iban(rng, "DE", 22) for _ in range(60)]
    clean = [f"item {v[:2]}{(int(v[2:4]) + 1) % 100:02d}{v[4:]} on 2020-{1 + i % 9:02d}-11 and 12-13-{i + 10}" for i, v in enumerate(wrong)]
    texts += clean + [f"mail a{i}@b.cd or 10.0.{i}.1 or 300.1.2.{i} or +49 30 12345{i:03d}" for i in range(100)]
    rows = {r["doc_id"]: r for r in check(docs(spark, *texts))}
    missed = {kind: 0 for kind in says}
    for i, (kind, value) in enumerate(planted):
        at = len(says[kind])
        # an account number whose digits make a card touches a base span
        missed[kind] += f"{kind}:{at}:{at + len(value)}" not in rows[i]["spans"].split(",") and not rows[i]["n_card"]
    assert missed == {"account": 0, "number": 0, "written": 0}
    assert sum(rows[len(planted) + i]["n_added"] for i in range(len(clean))) == 0


def test_trees_judge_what_nothing_is_certain_of(spark):
    """Trees learn from numbers after a word for calling and from dates, and add numbers that stand alone."""
    rng = random.Random(8)

    def number():
        return f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"

    texts = [f"tel. {number()} thanks" for _ in range(200)]
    texts += [f"it was 20{10 + i % 10}-{1 + i % 12:02d}-{10 + i % 18} then" for i in range(200)]
    alone = [f"ask at {number()} thanks" for _ in range(60)]
    ratios = [f"scores {10 + i}-{11 + i}-{30 + i} here" for i in range(60)]
    rows = {r["doc_id"]: r for r in check(docs(spark, *texts, *alone, *ratios))}
    added = sum(rows[400 + i]["spans"] == f"number:7:{7 + 14}" for i in range(60))
    assert added >= 55, added
    assert sum(rows[460 + i]["n_added"] for i in range(60)) == 0
    table = pii.judged(pii.candidates(docs(spark, *texts, *alone), pii.GENERATORS, "doc_id", "text"))
    assert table.where("_kind = 'number' AND _id >= 400 AND _label IS NULL AND _chosen").count() >= 55
    assert not set(pii.features()) & {"luhn", "iban", "octets", "digits", "says_call", "says_price"}


def test_written_addresses_and_numbers_are_proposed_whole(spark):
    cases = {
        "some.one (at) mail (dot) example (dot) com": "written", "a [at] b [dot] cd": "written", "x" * 50 + "(at)example(dot)org": "written",
        "a.b(AT)c.de (dot) fg": "written", "0171 5551234": "number", "(030) 1234567": "number", "0171/5551234": "number",
    }
    found = pii.candidates(docs(spark, *(f"so {t} ok" for t in cases)), pii.GENERATORS, "doc_id", "text").collect()
    for i, (value, kind) in enumerate(cases.items()):
        assert (kind, value) in {(r["_kind"], r["_value"]) for r in found if r["_id"] == i}


def plain_resolution(spans):
    """Kinds in order; a span stays unless it overlaps one that stays."""
    kept = [s for s in spans if s[0] in pii.BASE]
    for kind in pii.LOOSE:
        kept += [s for s in spans if s[0] == kind and not any(s[1] < o[2] and o[1] < s[2] for o in kept)]
    return sorted(kept)


SPANS = "_id long, _hash long, _kind string, _start int, _end int, _value string, _base boolean"


def test_overlaps_are_resolved_as_comparing_all_pairs_does(spark):
    rng = random.Random(9)
    truth, rows = {}, []
    for doc in range(60):
        spans = []
        for kind in (*pii.BASE, *pii.LOOSE):  # those of one kind lie apart
            at = 0
            for _ in range(rng.randint(0, 8)):
                at += rng.randint(0, 9)
                end = at + rng.randint(1, 12)
                spans.append((kind, at, end))
                at = end
        truth[doc] = plain_resolution(spans)
        rows += [(doc, 0, k, a, b, "x", k in pii.BASE) for k, a, b in spans]
    got = pii.without_overlaps(spark.createDataFrame(rows, SPANS)).collect()
    for doc, want in truth.items():
        assert sorted((r["_kind"], r["_start"], r["_end"]) for r in got if r["_id"] == doc) == want


def test_very_many_spans_in_one_text(spark):
    n = 100_000
    rows = spark.range(n).selectExpr(
        "1L AS _id", "0L AS _hash", "IF(id % 2 = 0, 'account', 'number') AS _kind", "CAST(5 * id AS int) AS _start",
        "CAST(5 * id + 6 AS int) AS _end", "'x' AS _value", "false AS _base",
    )
    assert pii.without_overlaps(rows).count() == n // 2  # a chain: every number touches an account
    text = "".join(f"write a{i} (at) b (dot) cd or\n" for i in range(20_000))
    (row,) = pii.span_digests(docs(spark, text)).collect()
    assert row["n_added"] == 20_000


def test_redaction(spark):
    (row,) = pii.redact(docs(spark, "mail é a.b@c.de, ip 10.0.0.1."), name="ids").collect()
    assert row["ids"] == "mail é [email], ip [ip]." and row["leaks"] == "x"


def test_odd_rows(spark):
    assert len(check(odd_docs(spark))) == 10
    assert pii.span_digests(odd_docs(spark).limit(0)).count() == 0
    assert len(pii.redact(odd_docs(spark)).collect()) == 10
