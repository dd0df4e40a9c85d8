import hashlib

from cases import docs, odd_docs

from rivulet.llm import secrets


def key(i):
    return hashlib.sha1(str(i).encode()).hexdigest()


def corpus():
    texts = [f'Some words here. token = "{key(i)}" and more words follow.' for i in range(150)]
    texts += [f"see /usr/share/example/path-number-{i:05d}/index and document-with-a-long-name-{i}" for i in range(150)]
    texts += [f"the id was {4000_0000_0000_0000 + i * 7919} in that list" for i in range(50)]
    return texts


def test_the_forest_removes_false_positives(spark):
    rows = {r["doc_id"]: r for r in secrets.secret_report(docs(spark, *corpus()), path="source").collect()}
    assert len(rows) == 350
    assert sum(rows[i]["n_secrets"] > 0 for i in range(150)) >= 148
    assert sum(rows[i]["n_secrets"] for i in range(150, 350)) == 0
    assert all(rows[i]["n_candidates"] > 0 for i in range(350))
    text = corpus()[3]
    at = text.index(key(3))
    assert f"token:{at}:{at + 40}" in rows[3]["findings"].split(",")


def test_given_labels_replace_the_weak_ones(spark):
    table = docs(spark, *corpus())
    found = secrets.find_secrets(table)
    labels = found.selectExpr("_id", "_start", "_end", "CAST(_id >= 300 AS INT) AS _label")
    rows = secrets.find_secrets(table, labels=labels).where("_kind = 'token'").collect()
    assert sum(r["_secret"] for r in rows if r["_id"] >= 300) >= 45 and sum(r["_secret"] for r in rows if r["_id"] < 300) == 0


def test_without_both_classes(spark):
    rows = secrets.secret_report(docs(spark, 'password: "hunter2hunter2"', "nothing")).collect()
    assert {r["doc_id"]: r["n_secrets"] for r in rows} == {0: 1, 1: 0}


def test_assignments_are_proposed_whole(spark):
    long = ".".join("part-%d!" % i for i in range(60))
    cases = [
        ("password: hunter2!x", "password: hunter2!x"), ("password = 'Tr0ub4dor&3xyz' # x", "password = 'Tr0ub4dor&3xyz'"),
        ("token:   abcdefghijklmnopqrstuvwx", "token:   abcdefghijklmnopqrstuvwx"),
        ('api_key="correct horse battery 1"', 'api_key="correct horse battery 1"'),
        (f'x secret = "{long}" y', f'secret = "{long}"'), (f"pwd={long}", f"pwd={long}"),
        ("A=1\nDB_PASSWORD=Tr0ub4dor&3\nB=2", "PASSWORD=Tr0ub4dor&3"), ('{"token" : "a b\\" c1"}', 'token" : "a b\\" c1"'),
        ('secret = my_token = "abc def 12"', 'token = "abc def 12"'), ('password="open token="abcdef12"', 'token="abcdef12"'),
        ("pwd\t=\t\tx1", "pwd\t=\t\tx1"), ("secret = ''", None),
    ]
    found = secrets.find_secrets(docs(spark, *[text for text, _ in cases])).where("_kind = 'assigned'").collect()
    for i, (text, value) in enumerate(cases):
        values = [r["_value"] for r in found if r["_id"] == i]
        assert (value in values) if value else not values, (text, values)
        assert all(text[r["_start"] : r["_end"]] == r["_value"] for r in found if r["_id"] == i)
    letters = docs(spark, "the token abcdefghijklmnopqrstuvwx here", "words abcdefghijklmnopqrstuvwx here")
    rows = secrets.find_secrets(letters).where("_kind = 'token'").collect()
    assert [(r["_id"], r["_start"], r["_end"]) for r in rows] == [(0, 10, 34)]


def test_unquoted_assignments_are_kept_and_prose_is_not(spark):
    texts = corpus() + [f"line\nDB_PASSWORD={key(i)[:20]}&{i}\nother" for i in range(100)]
    texts += [f"the password: {word} as they say" for word in ("words", "and", "example", "another", "testing") * 20]
    rows = {r["doc_id"]: r for r in secrets.secret_report(docs(spark, *texts), path="source").collect()}
    assert sum("assigned:" in rows[i]["findings"] for i in range(350, 450)) >= 95
    assert sum(rows[i]["n_secrets"] for i in range(450, 550)) == 0


PEM = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\n\nabcdefghijklmnop\nQRSTUV+/wxyzabcd\n-----END RSA PRIVATE KEY-----"


def test_key_blocks_and_urls_are_proposed_whole(spark):
    xox = "xoxb-" + "1a2B3c4D-" * 12
    cases = {
        PEM: ("block", PEM), PEM + "\n" + PEM: ("block", PEM), "-----BEGIN PRIVATE KEY-----\nabc": ("block", "-----BEGIN PRIVATE KEY-----"),
        "psql postgres://app:s3cr3tPw@db.example.com:5432/x": ("url", "postgres://app:s3cr3tPw@"),
        "https://:t0ken9@host/a": ("url", "https://:t0ken9@"), "see http://host:80/a@b": None, f"use {xox} now": ("key_id", xox),
    }
    found = secrets.find_secrets(docs(spark, *cases)).collect()
    for i, (text, want) in enumerate(cases.items()):
        mine = [r for r in found if r["_id"] == i]
        assert all(text[r["_start"] : r["_end"]] == r["_value"] for r in mine)
        values = {(r["_kind"], r["_value"]) for r in mine}
        assert (want in values) if want else not any(k == "url" for k, _ in values), (text, values)
    assert sum(r["_id"] == 1 and r["_kind"] == "block" for r in found) == 2
    assert {r["_value"]: r["_secret"] for r in found if r["_kind"] == "url"} == {
        "postgres://app:s3cr3tPw@": True, "https://:t0ken9@": True
    }
    marked = docs(spark, "db://u:${PW}@h", "db://u:pa55w0rdX@h", "db://u:password@h", "db://u:plainwords@h")
    found = secrets.weak_labels(secrets.candidates(marked, secrets.GENERATORS, "doc_id", "text")).where("_kind = 'url'")
    assert {r["_id"]: r["_label"] for r in found.collect()} == {0: 0.0, 1: 1.0, 2: 0.0, 3: None}


def test_odd_rows(spark):
    assert len(secrets.secret_report(odd_docs(spark)).collect()) == 10
    assert secrets.secret_report(odd_docs(spark).limit(0)).count() == 0
    assert secrets.secret_report(docs(spark, "-----BEGIN PRIVATE KEY-----" * 5_000, "-" * 50_000 + "://" * 20_000, "a" * 99_999 + "://")).count() == 3
    long = docs(spark, "A1" * 50_000, "=" * 50_000 + "1", "key_" * 20_000)
    assert secrets.secret_report(long).count() == 3
    assert secrets.secret_report(docs(spark, "secret=" * 20_000, "pwd=" + "x" * 200_000, 'pwd="' + "\\\\" * 100_000 + '"')).count() == 3
