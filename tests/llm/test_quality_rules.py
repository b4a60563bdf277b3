import random
import re

from pyspark.sql import functions as F

from pitchspark.llm import quality_rules as q


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + o for i, x in enumerate(windows) if windows.count(x) > 1 for o in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_counts_and_base_verdict():
    rnd = random.Random(4)
    for _ in range(600):
        t = "".join(rnd.choice(["a", "b", "é", " ", " ", "\n", "\t", "#", "|", "\x0b", "\x1c", "\xa0"]) for _ in range(rnd.randint(0, 80)))
        d = q.Document(t.encode())
        assert (len(d.words), d.word_chars, d.symbols, d.dup_lines, d.repeat_words) == brute(t)


def test_order_changes_no_verdict_and_prefers_rejection_per_cost(spark, odd_docs, no_docs):
    texts = [("w%d " % i * 60).encode() for i in range(30)] + [b"short"] * 30
    slow = q.QualityRule("slow", lambda d: sum(1 for _ in range(20_000)) < 0)
    order = q.order_rules(texts, [slow, *q.RULES])
    assert order[-1].rule.name == "slow" or order[-1].rejected == 0
    assert [m.rejected for m in order[:1]][0] > 0
    got = {}
    for cascade in (q.order_rules(texts, q.RULES), q.order_rules([], q.RULES[::-1])):
        rows = q.apply_cascade(odd_docs, cascade).select("doc_id", "text", F.col("stats.*")).collect()
        got[len(got)] = sorted((str(r.doc_id), r.text or "", r.rejected_by is None) for r in rows)
        assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text) for r in rows if len(r.text or "") < 1000)
    assert got[0] == got[1]
    assert q.apply_cascade(no_docs, q.fit_cascade(no_docs)).count() == 0
