import random

from pyspark.sql import functions as F

from pitchspark.llm import decontaminate as d

from .conftest import words


def shingles(w, k):
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]


def brute(index_items, text):
    """Items of which one passage of the text holds 80 % of the shingles and half of both parts'."""
    out, w = set(), text.lower().split()
    stretch = max(d.STRETCH, max(len(t.split()) for _, t in index_items))
    for item_id, t in index_items:
        iw = t.lower().split()
        k = min(d.SHINGLE, len(iw))
        cut = max(0, d.answer_begin(t.lower().encode()) - k + 1)
        s = shingles(iw, k)
        for x in range(0, len(w), stretch):
            have = set(shingles(w[x : x + 2 * stretch], k))
            hit = [g in have for g in s]
            q, a = hit[:cut], hit[cut:]
            share = sum(hit) / len(s)
            if share >= d.OVERLAP and min(sum(q) / len(q) if q else share, sum(a) / len(a) if a else share) >= d.PART_OVERLAP:
                out.add(item_id)
    return out


def cases(seed):
    rnd = random.Random(seed)
    frequent = words(rnd, 12, "ab")
    say = lambda n: [rnd.choice(frequent) if rnd.random() < 0.5 else words(rnd, 1)[0] for _ in range(n)]
    items = [(i, " ".join(say(rnd.choice([1, 3, 5, 12, 40, 90]))) + rnd.choice(["", ".", ". " + " ".join(say(6)) + "."])) for i in range(80)]
    items += [(90, " ".join(frequent[:6])), (91, items[5][1])]
    texts = []
    for _ in range(250):
        w = say(rnd.choice([5, 60, 300]))
        for _ in range(rnd.choice([0, 1, 2])):
            part = rnd.choice(items)[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                part[rnd.randrange(len(part))] = "edit"
            at = rnd.randrange(len(w))
            w[at:at] = part
        texts.append(" ".join(w).upper() if rnd.random() < 0.2 else "\n".join(w))
    return items, texts


def test_results_equal_brute_force():
    for seed in range(3):
        items, texts = cases(seed)
        index = d.ItemIndex([(i, t.encode()) for i, t in items])
        got = [{x["item_id"] for x in found} for found in index.leaks([t.encode() for t in texts])]
        assert got == [brute(items, t) for t in texts]
        assert sum(map(len, got)) > 60


def test_short_parts_and_glued_symbols_hide_no_copy():
    rnd = random.Random(4)
    items = [(1, " ".join(words(rnd, 22)) + ". Der."), (2, "Ob? " + " ".join(words(rnd, 22)) + "."), (3, " ".join(words(rnd, 7))), (4, " ".join(words(rnd, 60)) + ". " + " ".join(words(rnd, 10)) + ".")]
    index = d.ItemIndex([(i, t.encode()) for i, t in items])
    copy, found = dict(items), lambda t: {x["item_id"] for x in index.leaks([t.encode()])[0]}
    noise = lambda t: f"um### {t}### nd%%% so"
    assert found(noise(copy[1])) == {1} and found(noise(copy[2])) == {2}
    assert found(copy[1].replace("Der.", "Das.")) == {1} and found(copy[2].replace("Ob?", "Wer?")) == {2}
    assert found(noise("***" + copy[3])) == {3} and found("(" + copy[3] + ")!!") == {3}
    assert found(noise(copy[4])) == {4} and found(copy[4].split(". ")[0]) == set()  # a question without its answer is no leak


def test_capitals_of_any_script_hide_no_copy():
    item = "über die straße läuft élan ñandú ωμέγα жизнь " + " ".join(words(random.Random(6), 20)) + " çok öl"
    index = d.ItemIndex([(1, item.encode())])
    for t in (item, item.upper().replace("STRASSE", "STRAßE"), item.title()):
        assert [x["item_id"] for x in index.leaks([t.encode()])[0]] == [1]


def test_wand_retrieves_what_full_scoring_does():
    rnd = random.Random(7)
    items = [(i, " ".join(rnd.choices([f"t{int(rnd.paretovariate(0.7))}" for _ in range(60)], k=rnd.choice([4, 20])))) for i in range(400)]
    index = d.ItemIndex([(i, t.encode()) for i, t in items])
    for _ in range(150):
        terms = sorted(rnd.sample(range(len(index.terms)), min(len(index.terms), rnd.choice([3, 30, 200]))))
        for threshold in (0.3, 0.7, 1 - 1e-9):
            score = {}
            for t in terms:
                for n, x in zip(*index.post[t], strict=True):
                    score[n] = score.get(n, 0) + x
            want = {n for n, s in score.items() if s >= threshold}
            near = {n for n, s in score.items() if abs(s - threshold) < 1e-9}
            got = {n for n, _ in index.retrieve(terms, threshold)}
            assert got - near == want - near


def test_shards_and_odd_rows(spark, odd_docs, no_docs):
    items, texts = cases(9)
    bench = spark.createDataFrame([*items, (99, None), (98, ""), (97, " ")], "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in d.find_leaks(df, bench).select("doc_id", F.explode("leaks.item_id").alias("item_id")).collect()}
    index = d.ItemIndex([(i, t.encode()) for i, t in items])
    assert whole == {(i, x["item_id"]) for i, f in enumerate(index.leaks([t.encode() for t in texts])) for x in f}
    assert len(list(d.shards(bench, words=300))) > 3
    assert {i for s in d.shards(bench, words=300) for i, _ in s} == {i for i, _ in items} | {97, 98}
    assert d.find_leaks(odd_docs, bench).count() == odd_docs.count()
    assert d.find_leaks(no_docs, bench).count() == 0
    assert d.find_leaks(odd_docs, bench.limit(0), out="l").where(F.size("l") > 0).count() == 0
