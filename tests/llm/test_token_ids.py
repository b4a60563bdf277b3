import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pitchspark.llm import huffman, token_ids
from pitchspark.llm.common import shared_path, written

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 50, 700):
        counts = rng.integers(1, 1000, n) ** rng.integers(1, 3)
        lengths = huffman.code_lengths(counts, 30)
        heap = [(int(c), i, 0) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        best = int(counts[0]) if n == 1 else 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            best += a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], -len(heap), 0))
        assert (lengths * counts).sum() == best
    steep = 2 ** np.arange(40, dtype=np.int64)
    lengths = huffman.code_lengths(steep, 8).astype(float)
    assert lengths.max() == 8 and (2.0**-lengths).sum() <= 1
    assert huffman.code_lengths(np.zeros(5)).sum() == 0
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(300), 8)


def test_round_trip_with_checkpoints():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.4, 60_000), 3000)
    code = huffman.Code(huffman.code_lengths(np.bincount(ids)))
    counts = np.array([0, 1, 255, 256, 257, 0, 30_000, 5, 513])
    ids = ids[: counts.sum()]
    data, sizes, points = code.encode(ids, counts)
    assert (code.decode(data, counts, sizes, points) == ids).all()
    at = int(sizes[:6].sum())  # a document on its own, from its third checkpoint on
    mine = points[int((-(-counts[:6] // 256)).sum()) :]
    alone = code.decode(data[at : at + int(sizes[6])], np.array([256]), sizes[6:7], mine[2:3])
    assert (alone == ids[counts[:6].sum() + 512 : counts[:6].sum() + 768]).all()


def test_pieces_give_the_tokenizers_ids():
    rnd = random.Random(2)
    bits = ["a", "b", " ", "  ", "\n", "\t", "é", "日本", "1", "!", " ", "'s", "The", "\r\n", "\x1c", "<|endoftext|>", "_", "​", "\x85"]
    t = token_ids.ChunkTokenizer(PATH, limit=20_000)
    end = np.array([0], t.kind)
    for round_ in range(30):
        texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(50)]
        texts += ["", "x" * 200 + " y", " ", " a", "  a", "日本語 の テスト", " ".join(f"w{rnd.randint(0, 3000)}" for _ in range(300))]
        got = [ids[a:b].tolist() for ids, ends in t.encode([x.encode() for x in texts], end) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        assert got == [[*t.tokenizer.encode(x, add_special_tokens=False).ids, 0] for x in texts]
        assert 40 * len(t.known.one) + t.known.ids.nbytes <= 20_000
    assert len(t.known.one) > 0


def test_pieces_with_one_first_hash_are_told_apart(monkeypatch):
    """Colliding hashes cost time, never ids."""
    real = token_ids._span_hashes
    monkeypatch.setattr(token_ids, "_span_hashes", lambda *a: (lambda one, two: (one & np.uint64(7), two))(*real(*a)))
    t = token_ids.ChunkTokenizer(PATH)
    for x in ("a few words of one text and another few", "some other words"):
        ids, _ = next(t.encode([x.encode()], np.array([0], t.kind)))
        assert ids.tolist() == [*t.tokenizer.encode(x, add_special_tokens=False).ids, 0]


def test_files_are_ordered_by_number(spark):
    names = [f"file:/x/part-{n:05d}-6b2e-c{c:03d}.txt" for n, c in ((0, 0), (9, 1), (9, 0), (99_999, 0), (100_000, 999), (100_000, 1000), (100_001, 0), (1_000_000, 0))]
    order = [0, 2, 1, 3, 4, 5, 6, 7]
    files = spark.createDataFrame([(p, 10 ** i) for i, p in enumerate(names)], "path string, of_file long")
    got = {r.path: r.base for r in token_ids.file_bases(files).collect()}
    total = 0
    for i in order:
        assert got[names[i]] == total
        total += 10 ** i


def files_of(spark, df, **kw):
    ids = written(token_ids.encode_ids(df, PATH).select("doc_id", "ids"), "t-ids")
    path = shared_path(spark, "t-tokens")
    token_ids.write_tokens(ids, path, token_ids.id_kind(PATH), **kw)
    return path


def brute(rows):
    from tokenizers import Tokenizer

    t, at, out = Tokenizer.from_file(PATH), 0, []
    for d, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def test_files_hold_all_ids_in_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    path = files_of(spark, docs.repartition(7), block_ids=2000, file_blocks=3)
    got = token_ids.read_tokens(spark, path, with_ids=True).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in got) == brute(rows)
    assert spark.read.format("binaryFile").load(f"{path}/blocks").count() > 5


def test_odd_rows(spark, odd_docs, no_docs):
    got = token_ids.read_tokens(spark, files_of(spark, odd_docs, block_ids=500)).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    key = lambda r: (r[0] is not None, *((v or 0) for v in r))
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted((x[:4] for x in brute(rows)), key=key)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {1}
    empty = files_of(spark, no_docs)
    assert token_ids.read_tokens(spark, empty).count() == 0


def test_one_repeated_id_is_split_over_files(spark):
    df = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.lit("some words " * 40).alias("text"))
    path = files_of(spark, df, block_ids=1000, file_blocks=4)
    got = token_ids.read_tokens(spark, path).collect()
    n = got[0].n_tokens
    assert sorted(r.start for r in got) == [i * n for i in range(400)]
    assert spark.read.format("binaryFile").load(f"{path}/blocks").count() > 8


def test_words_and_signs_are_pieces_of_their_own():
    """Cuts inside a piece between spaces change no ids, whatever stands around them, and a word is learnt once."""
    rnd = random.Random(4)
    bits = [*"abzA09 \n\t\r'._-!\"\x7f\x0b\x1c×÷éÿſрѿҀ҂ 　…²日", "'s", "'ll", "'re", "\n\n", "  ", " the", "don't"]
    t = token_ids.ChunkTokenizer(PATH)
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(20_000)]
    got = [ids[a:b].tolist() for ids, ends in t.encode([x.encode() for x in texts], np.array([0], t.kind)) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    assert got == [[*e.ids, 0] for e in t.tokenizer.encode_batch(texts, add_special_tokens=False)]
    t = token_ids.ChunkTokenizer(PATH)
    for x in (" a word", " word.", " word,\nword", " (word) word!", " word?"):
        next(t.encode([x.encode()], np.array([0], t.kind)))
    assert len(t.known.one) == 10  # " a", " word", ".", ",", "\n", "word", " (", ")", "!", "?"


def test_counts_come_with_the_ids(spark):
    docs = spark.createDataFrame([(i, f"some words {i % 7} of text {i}" * (i % 3)) for i in range(60)], "doc_id long, text string").repartition(4)
    ids = written(token_ids.encode_ids(docs, PATH, keep=["doc_id"], counts="counts"), "t-ids")
    kind = token_ids.id_kind(PATH)
    assert ids.where(F.col("counts").isNotNull()).count() <= 4
    assert (token_ids.count_ids(ids, kind) == token_ids.count_ids(ids, kind, counts="counts")).all()


def test_documents_are_coded_once(spark):
    """Bounds come from the keys, so that no second pass codes the documents to sample them."""
    keys = spark.range(400).select(F.when(F.col("id") >= 50, F.col("id") % 120).alias("doc_id"), F.col("id").alias("tie"))
    bounds = token_ids.key_bounds(keys, 4)
    rows = sorted((r.doc_id is not None, r.doc_id or 0, r.tie) for r in keys.collect())
    assert bounds == [rows[100], rows[200], rows[300]]
    assert token_ids.key_bounds(keys.limit(0), 4) == [] and token_ids.key_bounds(keys, 1) == []
    big = token_ids.key_bounds(spark.range(100_000).select(F.col("id").alias("doc_id"), F.col("id").alias("tie")), 5)
    assert all(abs(b[1] - 20_000 * (i + 1)) < 5_000 for i, b in enumerate(big))
