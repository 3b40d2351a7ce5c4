import random
import re

from spanfold.llm import automaton, secret_scan
from spanfold.llm.secret_scan import RULES


def test_automaton_equals_regular_expressions():
    compiled = automaton.compile_rules(tuple(r.pattern for r in RULES))
    scanner = automaton.Scanner(compiled)
    chance = random.Random(1)
    parts = (
        "password = : ' \" abc123 AKIA ABCDEF0123456789 ghp_ eyJ . 0123456789abcdef01234567 token api_key "
        "apikey Secret https:// user: pw@ bearer é x / sk_live_ PRIVATE"
    ).split() + [" ", "a" * 10, "-----BEGIN ", "PRIVATE KEY-----"]
    for _ in range(1_000):
        text = "".join(chance.choice(parts) for _ in range(chance.randint(0, 30))).encode()
        plain = sorted(
            (n, m.start(), m.end()) for n, r in enumerate(RULES) for m in re.finditer(r.pattern.encode(), text)
        )
        assert sorted(scanner.spans(text)) == plain


def test_minimal():
    one = automaton.determine([automaton.parse("(ab|cb)d{2,3}")], anywhere=False)
    other = automaton.determine([automaton.parse("[ac]bddd?")], anywhere=False)
    # nothing read, a letter, b, d, dd, ddd, no way on
    assert one.step.shape[0] == other.step.shape[0] == 7


def test_spans_and_marks(spark):
    text = 'é password: "hunter2hunter2" and ' + "0123456789abcdef" * 2 + " token=ab ghp_" + "A1" * 20
    docs = spark.createDataFrame([(1, text)], ["doc_id", "text"])
    (row,) = secret_scan.find(docs).collect()
    assert [(s.kind, text[s.start : s.end]) for s in row.spans] == [
        ("assign", 'password: "hunter2hunter2'),
        ("hex", "0123456789abcdef" * 2),
        ("github", "ghp_" + "A1" * 20),
    ]
    (row,) = secret_scan.redact(docs).collect()
    assert row.text == 'é [SECRET]" and [SECRET] token=ab [SECRET]'


def test_dropped_matches_are_used_up(spark):
    docs = spark.createDataFrame([(1, "secret=token:abcdefg AKIA123 " + "a" * 23)], ["doc_id", "text"])
    assert secret_scan.find(docs).first().spans == []


def test_edge_cases(edge_docs, no_docs):
    found = secret_scan.find(edge_docs)
    assert found.count() == edge_docs.count()
    assert set(found.columns) == set(edge_docs.columns)
    assert {len(r.spans) for r in found.where("text IS NULL OR text = ''").collect()} == {0}
    same = secret_scan.redact(edge_docs)
    assert same.columns == edge_docs.columns
    assert same.exceptAll(edge_docs).count() == 0 and edge_docs.exceptAll(same).count() == 0
    assert secret_scan.find(no_docs).count() == 0


def test_private_keys_go_as_a_whole(spark):
    body = ["MIIEpAIBAAKCAQEA" + "b3Blbn+/" * 6, "NhAAAAAwEAAQAAAQ" + "Q2zL9x" * 8, "c2hvcnQ="]
    header = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123ABCD", ""]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    texts = {}
    for n, gap in enumerate(["\n", "\r\n", " ", "\\n", '"\n  "']):
        texts[10 * n] = (f"é {gap.join([begin, *body, end])} after", "é [SECRET] after")
        texts[10 * n + 1] = (f"é {gap.join([begin, *body])}, after", "é [SECRET], after")
        texts[10 * n + 2] = (f"{gap.join([begin, *body[:2]])[:-5]}", "[SECRET]")
    texts[100] = ("\n".join([begin, *header, *body, end, begin, "c2hvcnQ=", end]), "[SECRET]\n[SECRET]")
    texts[101] = (f"a line {begin} opens it", "a line [SECRET] opens it")
    docs = spark.createDataFrame([(n, t) for n, (t, _) in texts.items()], ["doc_id", "text"])
    assert {r.doc_id: r.text for r in secret_scan.redact(docs).collect()} == {n: t for n, (_, t) in texts.items()}
    spans = {r.doc_id: r.spans for r in secret_scan.find(docs).collect()}
    assert all(("pem", t.index(begin)) == (spans[n][0].kind, spans[n][0].start) for n, (t, _) in texts.items())


def test_keys_equal_regular_expressions():
    patterns = tuple(r.pattern for r in RULES if r.kind == "pem")
    scanner = automaton.Scanner(automaton.compile_rules(patterns))
    chance = random.Random(2)
    parts = ["-----BEGIN ", "PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----"]
    parts += ["A1+/" * 4, "abc=", "\n", " ", "\\n", '"', "-", ".", "Proc-Type: 4,ENCRYPTED"]
    for _ in range(2_000):
        text = "".join(chance.choice(parts) for _ in range(chance.randint(0, 14))).encode()
        plain = [(0, m.start(), m.end()) for m in re.finditer(patterns[0].encode(), text)]
        assert scanner.spans(text) == plain, text
