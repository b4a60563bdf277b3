"""MinHash near-dedup by a multi-index Hamming join over b-bit signatures.

A document's set: its distinct shingles of ``k`` words (64-bit hashes of
lower-cased words; A-Z only); fewer words are one shingle, none an empty set
that links with nothing. Two documents link when
``100 * |A and B| >= percent * |A or B|``.

1. Classes: documents with equal sets share a class (a hash of the sorted set);
   copies are never expanded into pairs.
2. Signatures: ``SYMBOLS`` independent minima over the set, of each the low
   ``b`` = 8 bits. The distance of two signatures is the number of symbols in
   which they differ: 0.2 * 48 on average at a similarity of 0.8.
3. Multi-index join: the signature is split into ``CHUNKS`` = 12 chunks of four
   symbols. Two signatures of a distance of at most ``DISTANCE`` = 23 have, by the
   pigeonhole principle, a chunk with at most one differing symbol. Its allowed
   errors are enumerated by leaving out each of the four symbols in turn: the
   48 keys (chunk, symbol left out, other three symbols) meet every pair within
   the distance, without exception. A link of exactly 0.8 lies beyond the
   distance with probability 3.4e-6, of 0.85 with 2e-9.
4. Join: on a key, with the length filter, the distance of the whole signatures
   and a lossless bound on the difference of the sets (the shingles are dealt over
   512 cells, the parity of each is one bit, and bits that differ are shingles that
   only one set has), before any row is made. Pairs come from ``links.linked``: a
   key's members meet its leaders first and then only members of other components.
5. Confirmation: each pair that passes is compared once on the whole sorted sets.

Keys are made from the signature's words by DataFrame expressions and summed
before they are shuffled; those found once leave at the sum and at the join that
follows. Sets of at most three shingles can link with equal ones only, and have no
keys. A hot shingle, a hot source or a large group of copies makes one class or
leader rounds; nothing is gathered or capped. Ties and repeated rows fall into
classes. Rows without an id take part as documents; a component of such rows alone
has a null ``component_id`` and all its rows are kept, else they are copies of the
component's smallest id. Very long texts are one array in one task; empty tables
give empty results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, small, written
from .links import components, linked
from .ngram_join import CELL_WORDS, _class_of, _parity, _sets, overlap_links, set_table

SHINGLE, PERCENT = 2, 80
CHUNKS, CHUNK = 12, 4
SYMBOLS = CHUNKS * CHUNK
#: The largest distance that leaves some chunk with at most one error.
DISTANCE = 2 * CHUNKS - 1
_WORDS = [f"g{i}" for i in range(SYMBOLS // 8)]
_CELLS = [f"c{i}" for i in range(CELL_WORDS)]
#: One odd factor and one mask a symbol: independent orders of the 64-bit hashes.
_MASKS = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_FACTORS = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``SYMBOLS`` bytes per set (zeros for an empty one), as 64-bit words."""
    out = np.zeros((len(sets), SYMBOLS), np.uint8)
    filled = np.flatnonzero(np.fromiter(map(len, sets), np.int64, len(sets)))
    if len(filled):
        joined = np.concatenate([sets[i] for i in filled])
        begins = np.cumsum([0, *(len(sets[i]) for i in filled[:-1])])
        work = np.empty_like(joined)
        for s in range(SYMBOLS):
            np.bitwise_xor(joined, _MASKS[s], out=work)
            np.multiply(work, _FACTORS[s], out=work)
            np.bitwise_xor(work, work >> np.uint64(32), out=work)
            out[filled, s] = mix(np.minimum.reduceat(work * _FACTORS[s], begins)).astype(np.uint8)
    return out.view("<i8")


def signature_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, node (the class), the words of the signature and of the cells' parities; one row per document."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for begin, sets in _sets(batch, 1, k):
                words = np.hstack([signatures(sets), np.array([_parity(x) for x in sets], np.int64).reshape(-1, CELL_WORDS)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array([_class_of(s) for s in sets], pa.int64()),
                    *(pa.array(words[:, i], pa.int64()) for i in range(words.shape[1])),
                ], ["doc_id", "n_shingles", "node", *_WORDS, *_CELLS])

    return (df.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
            .mapInArrow(run, "doc_id long, n_shingles long, node long, " + ", ".join(f"{w} long" for w in _WORDS + _CELLS)))


def chunk_keys() -> Column:
    """The keys of a row's signature: per chunk and symbol left out, the place and the chunk's other symbols."""
    keys = []
    for c in range(CHUNKS):
        chunk = F.shiftrightunsigned(F.col(_WORDS[c // 2]), 32 * (c % 2)).bitwiseAND(F.lit((1 << 32) - 1))
        for left_out in range(CHUNK):
            place = (c * CHUNK + left_out) << 32
            keys.append(chunk.bitwiseAND(F.lit(((1 << 32) - 1) & ~(0xFF << 8 * left_out))).bitwiseOR(F.lit(place)))
    return F.array(*keys)


def index_members(nodes: DataFrame) -> DataFrame:
    """key, node, p1, p2 (the two shared keys before it), n_shingles and signature, of the keys that some other class shares."""
    rows = nodes.select("node", F.explode(chunk_keys()).alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    shared = rows.join(counts, "key").groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # at most 48
    before = F.transform("keys", lambda x, i: F.struct(x.alias("key"), F.get("keys", i - 1).alias("p1"), F.get("keys", i - 2).alias("p2")))
    return (shared.join(nodes, "node").select("node", "n_shingles", *_WORDS, *_CELLS, F.explode(before).alias("r"))
            .select("node", "r.*", "n_shingles", *_WORDS, *_CELLS))


def distance(x: str, y: str) -> Column:
    """Symbols (bytes) in which the signatures of two members differ."""
    total = F.lit(0)
    for w in _WORDS:
        d = F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))
        # A byte's lowest bit becomes the disjunction of its bits; what the shifts bring over from the next byte stays above.
        for shift in (4, 2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift))
        total = total + F.bit_count(d.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def _possible(percent: int):
    def condition(x: str, y: str) -> Column:
        a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        need = F.ceil((a + b) * percent / F.lit(100 + percent))  # least overlap of two linked sets
        differ = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in _CELLS), F.lit(0))
        return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (distance(x, y) <= DISTANCE) & (differ <= a + b - 2 * need)

    return condition


def _first(x: str, y: str) -> Column:
    """False where both have one of the two shared keys before: the pair was made there."""
    met = [F.coalesce(F.col(f"{x}.{p}") == F.col(f"{y}.{q}"), F.lit(False)) for p in ("p1", "p2") for q in ("p1", "p2")]
    return ~(met[0] | met[1] | met[2] | met[3])


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links), kept; one row per input row."""
    classes = written(signature_classes(df, doc_id, text, k), "signatures")
    # n sets of sizes a < b link at best with a / b: below that no different set can be near.
    least = next(n for n in range(1, 200) if 100 * n >= percent * (n + 1))
    members = written(index_members(classes.where(F.col("n_shingles") >= least).drop("doc_id").dropDuplicates(["node"])), "signature-keys")
    firsts = classes.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("class_id"))

    def verify(pairs: DataFrame) -> DataFrame:
        wanted = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "verify-nodes")
        ids = written(firsts.join(wanted, "node").select("class_id").distinct(), "verify-ids")
        rows = df.select(F.col(doc_id).cast("long").alias("class_id"), F.col(text).cast("string").alias("t"))
        texts = rows.join(small(ids), "class_id", "left_semi")
        if not ids.where("class_id is null").isEmpty():  # sets that only rows without an id have
            texts = texts.unionByName(rows.where("class_id is null"))
        sets = set_table(texts, "class_id", "t", k).join(small(wanted), "node", "left_semi").dropDuplicates(["node"])
        return overlap_links(pairs, written(sets, "verify-sets"), percent)

    links = written(linked(members, [], ["n_shingles", *_WORDS, *_CELLS], _possible(percent), verify, _first), "near-links")
    placed = firsts.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = written(placed.join(smallest, "component").select("node", "component_id"), "near-components")
    found = F.coalesce("component_id", "doc_id")
    # Empty sets have a node too, but no row in ``named``: each stands alone.
    return (classes.select("doc_id", "n_shingles", "node").join(named, "node", "left")
            .select("doc_id", "n_shingles", found.alias("component_id"), F.coalesce(F.col("doc_id") == found, found.isNull()).alias("kept")))
