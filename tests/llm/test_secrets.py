import random
import re

from pitchspark.llm import secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def brute(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(secrets.BASE[k].kind, s, e) for s, k, e in sorted(out)]


BITS = ["password", "token", "Secret", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA", "AB12", "0123456789abcdef", "a", "f", "é", "日", "\n", "x",
        "\0", "abcdefghijk", "ZZZZZZZZZZZZZZ", "passwd"]


def test_base_spans_equal_the_regexes():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    found = secrets.Scanner().scan([t.encode() for t in texts])
    base = {r.kind for r in secrets.BASE}
    assert [[x for x in f if x[0] in base] for f in found] == [brute(t) for t in texts]
    assert sum(map(len, found)) > 1000


def test_added_rules_and_very_long_text():
    filler = "x y " * 200_000
    texts = ["ghp_" + "z" * 36, "ghp_" + "z" * 35, "-----BEGIN RSA PRIVATE KEY-----", "eyJab.eyJcd.ef_g", filler + "AKIA" + "Q" * 16]
    kinds = [[k for k, _, _ in x] for x in secrets.Scanner().scan([t.encode() for t in texts])]
    assert kinds == [["github"], [], ["private_key"], ["jwt"], ["access"]]


def test_odd_rows_and_redaction(spark, odd_docs, no_docs):
    found = secrets.find_secrets(odd_docs)
    assert found.count() == odd_docs.count() and "score" in found.columns
    assert {r.doc_id: len(r.secrets) for r in found.collect() if r.text is None or r.text == ""} == {1: 0, 2: 0}
    assert secrets.find_secrets(no_docs).count() == 0
    df = spark.createDataFrame([("é token = abcdefghijklmn end",), (None,)], "text string")
    assert [r.text for r in secrets.redact(secrets.find_secrets(df)).collect()] == ["é [secret] end", None]
