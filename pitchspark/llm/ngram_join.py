"""Similarity self-join of documents on n-gram sets by rare-first prefix filtering.

A document's set: its distinct shingles of ``k`` words (64-bit hashes of
lower-cased words; A-Z only). Fewer words are one shingle, none an empty set
that links with nothing. Two documents link when
``100 * |A and B| >= percent * |A or B|``.

1. Classes: documents with equal sets share a class (hash of the sorted set, and
   the set's size); copies are never expanded into pairs.
2. Order of shingles, the same for all documents: those whose hash is below
   ``RANKED`` of the range come first, rare before frequent by the number of sets
   that hold them (counted over all documents; a task counts equal sets once),
   then the others by their hash. Only the first kind, and of the others what a
   short set needs for its prefix, are shuffled to be counted; those found once
   drop out at the count, for they can join nothing.
3. Prefix filter: two sets that link share one of the first
   ``n - ceil(percent * n / 100) + 1`` shingles of each. A prefix that ends
   before the frequent ones has nothing to join.
4. Join on prefix shingles with the length filter, the positional filter (what
   is left of both sets after this place must suffice) and the suffix filter: the
   shingles are dealt over 512 cells, the parity of each cell is one bit, and the
   bits in which two sets differ bound the size of their difference from below.
5. Verification: each pair that passes is compared once on the whole sorted sets.

Pairs come from ``links.linked``: a shingle's members meet its leaders first (the
one with the fewest rarer shingles, then others) and only then members of other
components, each pair on the first of its common shingles if their neighbours
in both prefixes tell.
A frequent shingle's rows are split by the adaptive skew join, its count is
summed before the shuffle, and no group is gathered in one place. Ties and
repeated rows fall into classes; sets that only rows with null ids have link with
nothing; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORDS_BYTES, Words, flat, mix, small, written
from .links import components, linked

SHINGLE, PERCENT = 4, 85
#: Share of the hash range whose shingles are counted; above the share of a set that a prefix takes.
RANKED = 0.25
CELL_WORDS = 8
_LIMIT = np.uint64(int(RANKED * 2**64))
_PARITY = [f"s{i}" for i in range(CELL_WORDS)]


def _need(n: np.ndarray | int, percent: int):
    """Least overlap with any set that links to one of size n."""
    return -(-percent * n // 100)


def _ranked(sums: np.ndarray, percent: int) -> np.ndarray:
    """The shingles that can be in the prefix: all below the limit, and as many of the others as the prefix may need."""
    below = int(np.searchsorted(sums, _LIMIT))
    prefix = len(sums) - _need(len(sums), percent) + 1 if len(sums) else 0
    return sums[: max(below, prefix)]


def _class_of(sums: np.ndarray) -> int:
    place = np.arange(1, len(sums) + 1, dtype=np.uint64)
    return int(np.bitwise_xor.reduce(mix(sums + place * np.uint64(0x9E3779B97F4A7C15)), initial=np.uint64(len(sums))).view(np.int64))


def _parity(sums: np.ndarray) -> np.ndarray:
    cell = (sums & np.uint64(64 * CELL_WORDS - 1)).astype(np.int64)
    bits = (np.bincount(cell, minlength=64 * CELL_WORDS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _sets(batch, column: int, k: int):
    """The shingle sets of a batch's texts, one chunk of texts at a time: (first row, sets)."""
    import pyarrow as pa

    texts = batch.column(column)
    data, ends = flat(texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())) if len(texts) else (None, np.zeros(1, np.int64))
    begin = 0
    while begin < len(texts):
        stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] + WORDS_BYTES, side="right")) - 1)
        yield begin, Words([data[a:b].tobytes().lower() for a, b in zip(ends[begin:stop], ends[begin + 1 : stop + 1], strict=True)]).shingle_sets(k)
        begin = stop


def shingle_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, node (the class), and what the filters need of the class; one row per document."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for begin, sets in _sets(batch, 1, k):
                parity = np.array([_parity(s) for s in sets], dtype=np.int64).reshape(-1, CELL_WORDS)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array([_class_of(s) for s in sets], pa.int64()),
                    pa.array([int(np.searchsorted(s, _LIMIT)) for s in sets], pa.int64()), *(pa.array(parity[:, i], pa.int64()) for i in range(CELL_WORDS)),
                ], ["doc_id", "n_shingles", "node", "n_below", *_PARITY])

    schema = "doc_id long, n_shingles long, node long, n_below long, " + ", ".join(f"{s} long" for s in _PARITY)
    return df.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)


def _ranked_rows(df: DataFrame, doc_id: str, text: str, k: int, percent: int) -> DataFrame:
    """key (shingle), node: the shingles that can be in a prefix, each class once per task."""

    def run(batches):
        import pyarrow as pa

        done: set[int] = set()
        for batch in batches:
            for _, sets in _sets(batch, 0, k):
                keys, nodes = [], []
                for s in sets:
                    node = _class_of(s)
                    if len(s) and node not in done:
                        done.add(node)
                        keys.append(_ranked(s, percent))
                        nodes.append(np.full(len(keys[-1]), node, dtype=np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))], ["key", "node"])

    return df.select(F.col(text).cast("string")).mapInArrow(run, "key long, node long")


def prefixes(df: DataFrame, classes: DataFrame, doc_id: str, text: str, k: int, percent: int) -> DataFrame:
    """key, node, place, n_shingles, parity: the prefix shingles of each class that some other class may share."""
    rows = _ranked_rows(df, doc_id, text, k, percent)
    # Shingles found once are most: they leave at the sum and at the join that follows it.
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = rows.join(counts, "key")
    # Keys are unsigned numbers held as signed ones: those below the limit are not negative, negative ones are the largest.
    below = F.col("key").between(0, int(_LIMIT) - 1)
    known = shared.groupBy("node").agg(
        F.sort_array(F.collect_set(F.when(below, F.struct("n", "key")))).alias("ranked"),
        F.sort_array(F.collect_set(F.when(~below, F.struct((F.col("key") < 0).alias("large"), "key")))).alias("others"))
    per_class = classes.dropDuplicates(["node"]).where("n_shingles > 0").drop("doc_id")
    size = F.col("n_shingles")
    joined = known.join(per_class, "node").withColumn("prefix", size - F.ceil(size * percent / F.lit(100)) + 1)
    # Once-only shingles below the limit stand before the shared ones; shingles above it come last, by hash.
    places = F.concat(
        F.transform("ranked", lambda x, i: F.struct(x["key"].alias("key"), (F.col("n_below") - F.size("ranked") + i).alias("place"))),
        F.transform("others", lambda x, i: F.struct(x["key"].alias("key"), (F.col("n_below") + i).alias("place"))))
    # Each place also carries the two keys before it: equal ones tell that a pair has met already.
    before = F.transform("places", lambda x, i: F.struct(x["key"].alias("key"), x["place"].cast("long").alias("place"),
                                                         F.get("places", i - 1)["key"].alias("p1"), F.get("places", i - 2)["key"].alias("p2")))
    return (joined.select("node", "n_shingles", "prefix", *_PARITY, places.alias("places"))
            .select("node", "n_shingles", "prefix", *_PARITY, F.explode(before).alias("p"))
            .select("p.key", "node", "p.place", "p.p1", "p.p2", "n_shingles", "prefix", *_PARITY)
            .where("place < prefix").drop("prefix"))


def _first(x: str, y: str) -> Column:
    """False where both have the same key one or two keys before: the pair was made there."""
    met = [F.coalesce(F.col(f"{x}.{p}") == F.col(f"{y}.{q}"), F.lit(False)) for p in ("p1", "p2") for q in ("p1", "p2")]
    return ~(met[0] | met[1] | met[2] | met[3])


def _possible(percent: int):
    def condition(x: str, y: str) -> Column:
        a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        # Least overlap of two linked sets: percent / (100 + percent) of both sizes.
        need = F.ceil((a + b) * percent / F.lit(100 + percent))
        length = (100 * F.least(a, b) >= percent * F.greatest(a, b))
        left = 1 + F.least(a - F.col(f"{x}.place") - 1, b - F.col(f"{y}.place") - 1)
        differ = sum((F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in _PARITY[1:]),
                     F.bit_count(F.col(f"{x}.{_PARITY[0]}").bitwiseXOR(F.col(f"{y}.{_PARITY[0]}"))))
        return length & (left >= need) & (differ <= a + b - 2 * need)

    return condition


def set_table(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """node, items (the sorted set as little-endian 64-bit numbers)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for _, sets in _sets(batch, 0, k):
                yield pa.RecordBatch.from_arrays([pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                                                 ["node", "items"])

    return docs.select(F.col(text).cast("string")).mapInArrow(run, "node long, items binary")


def overlap_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets (node, items) link, compared on the whole sets."""

    @F.arrow_udf("boolean")
    def links(left, right):
        import pyarrow as pa

        out = []
        (x_data, x_at), (y_data, y_at) = flat(left), flat(right)  # views of the batch, no copies
        for i in range(len(x_at) - 1):
            x, y = x_data[x_at[i] : x_at[i + 1]].view("<u8"), y_data[y_at[i] : y_at[i + 1]].view("<u8")
            small_set, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.minimum(np.searchsorted(large, small_set), max(len(large) - 1, 0))
            both = int((large[at] == small_set).sum()) if len(large) else 0
            out.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
        return pa.array(out, pa.bool_())

    left = sets.select(F.col("node").alias("a"), F.col("items").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("right"))
    return pairs.join(left, "a").join(right, "b").where(links(F.col("left"), F.col("right"))).select("a", "b")


def similar_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links), class_id (smallest doc_id with the same set)."""
    classes = written(shingle_classes(df, doc_id, text, k, percent), "classes")
    members = written(prefixes(df, classes, doc_id, text, k, percent), "prefixes")
    rank, carried = ["place", "n_shingles"], ["place", "n_shingles", *_PARITY]
    firsts = classes.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("class_id"))

    def verify(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        ids = written(firsts.join(wanted, "node").select("class_id"), "verify-ids")
        texts = df.select(F.col(doc_id).cast("long").alias("class_id"), F.col(text).alias("t")).join(small(ids), "class_id")
        sets = set_table(texts, "class_id", "t", k).dropDuplicates(["node"])
        return overlap_links(pairs, written(sets, "verify-sets"), percent)

    links = written(linked(members, rank, carried, _possible(percent), verify, _first), "links")
    of = components(links)
    # The component's smallest document, over classes.
    placed = firsts.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = written(placed.join(smallest, "component").select("node", "class_id", "component_id"), "named")
    return (classes.select("doc_id", "n_shingles", "node").join(named, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id")))
