"""Fuzzy line deduplication by MinHash over character shingles, keeping one line per component.

A line is a stretch between newlines that holds a word; A-Z are lowered and
white space becomes single spaces. Equal lines share a node (a 64-bit hash); of
each node's distinct shingles of ``SHINGLE`` characters a one-permutation MinHash
signature is made: every shingle falls in one of 60 bins, the least hash of a bin
counts, and an empty bin takes the value of a filled one that a fixed random order of
bins, its own, comes to first. So the values of a short line are nearly
independent too, although it has few shingles. Eight bits of each value stay: 60 symbols in twelve
bands of five, which are the keys. A pair of similarity 0.8 shares a key with
99 %, one of 0.85 with 99.9 % probability. On a key, a pair is made only if two
lossless bounds allow it: the numbers of distinct shingles, and the parities of 1,024
cells over which the shingles are dealt - cells that differ are shingles that only one
line has. Pairs on a key come from
``links.linked`` (leaders first, then across components), are verified once by
the exact Jaccard similarity of the whole shingle sets (at least ``percent``),
and union-find joins the links. Of each component the first line by document id,
line number and row stays, all others are dropped.

One map makes nodes and bands of all lines and writes them; keys that one node
alone has - most - leave at the aggregate that follows, and a map of bits of the others, of bounded size, keeps
them from being made into rows again. A second map finds, by such a map of their nodes, the texts of the
lines that share a key and writes them with what the bounds need; verification reads this
table alone. Once the open keys have few pairs, these are compared without further rounds. A hot line is one node, a hot key's rows can be split. Blank lines are no lines and stay.
Lines shorter than a shingle have only equal copies. Null and empty texts have
no lines; repeated rows lose the lines of all but one; null ids come first;
empty tables give empty results.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, flat, mix, number_map, on_map, powers, small, texts_of, written
from .links import components, linked

SHINGLE, PERCENT = 8, 80
BANDS, ROWS = 12, 5
#: So many pairs a line are compared in less time than another round of leaders takes (about 0.5 us a pair, 30 us a member).
FEW = 50
_BINS = BANDS * ROWS
_EMPTY = np.uint64(2**64 - 1)
#: Words of 64 cells whose parities bound a difference.
CELL_WORDS = 16
_CELLS = [f"c{i}" for i in range(CELL_WORDS)]
#: The bins from which an empty one takes its value, in the order in which they are tried.
_TRIED = np.array([np.random.default_rng(j).permutation(_BINS) for j in range(_BINS)])


def normal(line: str) -> str:
    """A line as it is compared: ASCII letters lowered, ASCII white space single."""
    return b" ".join(line.encode().lower().split()).decode()


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """Number and normal form of each line with a word."""
    return [(i, n) for i, x in enumerate((text or "").split("\n")) if (n := normal(x))]


def _running(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The running sum over the code points of all lines, the powers' inverses, and where each line begins and ends."""
    points = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32)
    power, inverse = powers(len(points) + 1)
    run = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint32(1)) * power[: len(points)], out=run[1:])
    length = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    ends = np.cumsum(length)
    return run, inverse, ends - length, ends


def whole_hashes(lines: list[str]) -> np.ndarray:
    """A 64-bit hash of each whole line."""
    return _byte_hashes([x.encode() for x in lines])


def _byte_hashes(lines: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([blake2b(x, digest_size=8).digest() for x in lines]), dtype="<u8")


def _byte_lines(text: bytes) -> list[tuple[int, bytes]]:
    """``lines_of`` a text in UTF-8, in UTF-8."""
    return [(i, b" ".join(words)) for i, x in enumerate(text.lower().split(b"\n")) if (words := x.split())]


def _has_shingle(line: bytes) -> bool:
    return len(line) >= SHINGLE and (line.isascii() or len(line.decode()) >= SHINGLE)


def _salted(line: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Shingles made different from line to line, so that one sort brings each line's equal ones together."""
    return sums ^ mix(line.astype(np.uint64) + np.uint64(1))


class Shingles:
    """Hashes of the character shingles of many lines: ``sums[first[i]:first[i + 1]]`` are those of line i, with repeats.

    They come from one running sum of a polynomial over the code points.
    """

    def __init__(self, lines: list[str], k: int = SHINGLE):
        self.lines = lines
        run, inverse, begins, ends = _running(lines)
        counts = np.maximum(ends - begins - k + 1, 0)
        self.first = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
        at = np.arange(self.first[-1]) + np.repeat(begins - self.first[:-1], counts)
        self.sums = mix((run[at + k] - run[at]) * inverse[at])

    def sets(self) -> list[np.ndarray]:
        """Sorted distinct shingles of each line; a shorter line is its own only shingle."""
        return [np.unique(self.sums[a:b]) if b > a else whole_hashes(self.lines[i : i + 1]) for i, (a, b) in
                enumerate(zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True))]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Line and shingle of the distinct shingles of all lines, as ``sets`` has them, in no order."""
        counts = np.diff(self.first)
        short = np.flatnonzero(counts == 0)
        line = np.concatenate((np.repeat(np.arange(len(counts)), counts), short))
        sums = np.concatenate((self.sums, whole_hashes([self.lines[i] for i in short.tolist()])))
        salted = _salted(line, sums)
        order = np.argsort(salted)
        salted, line = salted[order], line[order]
        keep = np.ones(len(order), dtype=bool)
        keep[1:] = (salted[1:] != salted[:-1]) | (line[1:] != line[:-1])
        return line[keep], sums[order[keep]]

    def symbols(self) -> np.ndarray:
        """The signature of each line, which must have a shingle: 60 symbols of eight bits."""
        counts = np.diff(self.first)
        n, sums = len(counts), self.sums
        signature = np.full(n * _BINS, _EMPTY)
        line = np.repeat(np.arange(n), counts)
        place = ((sums >> np.uint64(32)) * np.uint64(_BINS) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(signature, line * _BINS + place, (sums << np.uint64(32)) | (sums >> np.uint64(32)))
        signature = signature.reshape(n, _BINS)
        empty = signature == _EMPTY
        line, place = np.nonzero(empty)
        filled = signature.copy()
        for t in range(_BINS):
            if not len(line):
                break
            tried = _TRIED[place, t]
            found = ~empty[line, tried]
            filled[line[found], place[found]] = signature[line[found], tried[found]]
            line, place = line[~found], place[~found]
        return mix(filled).astype(np.uint8)

    def bands(self) -> np.ndarray:
        """BANDS keys of each line: the band's number above its five symbols."""
        symbols = self.symbols().reshape(-1, BANDS, ROWS).astype(np.uint64)
        out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) << np.uint64(8 * ROWS), symbols.shape[:2]).copy()
        for r in range(ROWS):
            out |= symbols[:, :, r] << np.uint64(8 * r)
        return out


def line_nodes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """One row per input row: doc_id, row (a number of its own, by default made here), lines (array of line_no, node) and fresh.

    ``fresh`` has the node and the ``BANDS`` keys of each line that the task had not met before, as 64-bit numbers in one binary value.
    """

    def run(batches):
        import pyarrow as pa

        done: set[int] = set()
        line = pa.struct([("line_no", pa.int32()), ("node", pa.int64())])
        for batch in batches:
            texts = texts_of(batch.column(2))
            for a, b in chunks(texts, 1 << 18):
                per_text = [_byte_lines(t) for t in texts[a:b]]
                flat = [x for lines in per_text for _, x in lines]
                nodes = _byte_hashes(flat).view(np.int64).tolist()
                new = {}
                for i, (node, x) in enumerate(zip(nodes, flat, strict=True)):
                    if node not in done and _has_shingle(x):
                        done.add(node)
                        new[i] = node
                keys = Shingles([flat[i].decode() for i in new]).bands().view(np.int64) if new else np.zeros((0, BANDS), np.int64)
                ends = np.cumsum([0, *map(len, per_text)])
                fresh_ends = np.searchsorted(np.fromiter(new, dtype=np.int64, count=len(new)), ends)
                lines = pa.StructArray.from_arrays([pa.array([n for x in per_text for n, _ in x], pa.int32()), pa.array(nodes, pa.int64())], fields=list(line))
                fresh = np.column_stack((np.fromiter(new.values(), np.int64, len(new)), keys))
                offsets = (fresh.itemsize * (1 + BANDS) * fresh_ends).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines),
                    pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(fresh)])], ["doc_id", "row", "lines", "fresh"])

    return (df.select(F.col(doc_id).cast("long"), F.col(row).cast("long") if row else F.monotonically_increasing_id(), F.col(text).cast("string"))
            .mapInArrow(run, "doc_id long, row long, lines array<struct<line_no:int,node:long>>, fresh binary"))


def line_texts(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, line (normal form) of the lines of ``t`` whose node may be among ``nodes`` (written), each once per task."""
    wanted = texts.sparkSession.sparkContext.broadcast(number_map(nodes))

    def run(batches):
        import pyarrow as pa

        done: set[int] = set()
        for batch in batches:
            values = texts_of(batch.column(0))
            for a, b in chunks(values, 1 << 18):
                lines = [x for t in values[a:b] for _, x in _byte_lines(t)]
                if not lines:
                    continue
                hashes = _byte_hashes(lines).view(np.int64)
                new = {}
                for i in np.flatnonzero(on_map(wanted.value, hashes)).tolist():
                    node = int(hashes[i])
                    if node not in done and _has_shingle(lines[i]):
                        done.add(node)
                        new[node] = lines[i].decode()
                if new:
                    yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.int64()), pa.array(list(new.values()), pa.string())], ["node", "line"])

    return texts.select("t").mapInArrow(run, "node long, line string")


def cells(line: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """The parity of each cell, of the shingle sets of ``n`` lines: a row of words for each."""
    size = 64 * CELL_WORDS
    bits = np.bincount(line * size + (sums & np.uint64(size - 1)).astype(np.int64), minlength=n * size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).reshape(n, CELL_WORDS)


def line_facts(lines: DataFrame) -> DataFrame:
    """node, line, n_shingles (distinct) and the words of the cells' parities, of lines (node, line)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks([t.encode() for t in texts], 1 << 18):
                line, sums = Shingles(texts[a:b]).distinct()
                parity = cells(line, sums, b - a)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(np.bincount(line, minlength=b - a), pa.int64()),
                    *(pa.array(parity[:, i], pa.int64()) for i in range(CELL_WORDS))], ["node", "line", "n_shingles", *_CELLS])

    schema = "node long, line string, n_shingles long, " + ", ".join(f"{c} long" for c in _CELLS)
    return lines.select("node", "line").mapInArrow(run, schema)


def _first(x: str, y: str) -> Column:
    """False where both have one of the two shared keys before: the pair was made there."""
    met = [F.coalesce(F.col(f"{x}.{p}") == F.col(f"{y}.{q}"), F.lit(False)) for p in ("p1", "p2") for q in ("p1", "p2")]
    return ~(met[0] | met[1] | met[2] | met[3])


def _possible(percent: int):
    def condition(x: str, y: str) -> Column:
        a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        need = F.ceil((a + b) * percent / F.lit(100 + percent))  # least overlap of two linked sets
        differ = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in _CELLS), F.lit(0))
        return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (differ <= a + b - 2 * need)

    return condition


def _bands_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Keys and nodes of ``fresh``, one behind the other."""
    fresh = flat(column)[0].view(np.int64).reshape(-1, 1 + BANDS)
    return fresh[:, 1:].ravel(), np.repeat(fresh[:, 0], BANDS)


def shared_keys(per_row: DataFrame) -> DataFrame:
    """key: those that more than one node has in ``fresh``.

    Keys and nodes are shuffled in blocks, a row for each partition and batch; a task holds the distinct keys of its partition.
    """
    parts = int(per_row.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def blocks(batches):
        import pyarrow as pa

        for batch in batches:
            key, node = _bands_of(batch.column(0))
            part = ((mix(key.view(np.uint64)) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
            counts = np.bincount(part, minlength=parts)
            used = np.flatnonzero(counts)
            offsets = np.concatenate(([0], 16 * np.cumsum(counts[used]))).astype(np.int64)
            data = pa.py_buffer(np.column_stack((key[order], node[order])))
            block = pa.Array.from_buffers(pa.large_binary(), len(used), [None, pa.py_buffer(offsets), data])
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), block.cast(pa.binary())], ["part", "block"])

    def merged(held: list[tuple]) -> tuple:
        key, low, high = (np.concatenate(x) for x in zip(*held, strict=True))
        if not len(key):
            return key, low, high
        order = np.argsort(key)
        key = key[order]
        first = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
        return key[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)

    def run(batches):
        import pyarrow as pa

        held, size, distinct = [(np.zeros(0, np.int64),) * 3], 0, 0
        for batch in batches:
            pairs = flat(batch.column(1))[0].view(np.int64).reshape(-1, 2)
            held.append((pairs[:, 0], pairs[:, 1], pairs[:, 1]))
            size += len(pairs)
            if size > max(1 << 20, distinct):
                held, size = [merged(held)], 0
                distinct = len(held[0][0])
        key, low, high = merged(held)
        yield pa.RecordBatch.from_arrays([pa.array(key[low < high], pa.int64())], ["key"])

    rows = per_row.select("fresh").where(F.length("fresh") > 0).mapInArrow(blocks, "part int, block binary")
    return rows.repartitionById(parts, F.col("part")).mapInArrow(run, "key long")


def bands_on_map(per_row: DataFrame, keys: DataFrame) -> DataFrame:
    """node, key of the bands of ``per_row`` whose key may be among ``keys`` (written)."""
    wanted = per_row.sparkSession.sparkContext.broadcast(number_map(keys))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            key, node = _bands_of(batch.column(0))
            met = on_map(wanted.value, key)
            yield pa.RecordBatch.from_arrays([pa.array(node[met], pa.int64()), pa.array(key[met], pa.int64())], ["node", "key"])

    return per_row.select("fresh").where(F.length("fresh") > 0).mapInArrow(run, "node long, key long")


def band_members(per_row: DataFrame) -> DataFrame:
    """key, node, p1, p2 (the two keys before it in the node's order): the bands that some other line shares."""
    # A line that several tasks met is there once for each; only keys of different lines matter.
    keys = written(shared_keys(per_row), "shared-bands")
    shared = bands_on_map(per_row, keys).join(keys, "key").groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    before = F.transform("keys", lambda x, i: F.struct(x.alias("key"), F.get("keys", i - 1).alias("p1"), F.get("keys", i - 2).alias("p2")))
    return shared.select("node", F.explode(before).alias("r")).select("node", "r.*")


def similar_lines(pairs: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose lines (node, line) have an exact Jaccard similarity of ``percent`` or more."""

    @F.arrow_udf("boolean")
    def alike(left, right):
        import pyarrow as pa

        out: list[bool] = []
        x, y = (c.to_pylist() for c in (left, right))
        for a, b in chunks([v.encode() for v in x], 1 << 18):
            (line, sums), (other, others) = Shingles(x[a:b]).distinct(), Shingles(y[a:b]).distinct()
            pair = np.concatenate((line, other))
            salted = _salted(pair, np.concatenate((sums, others)))
            order = np.argsort(salted)
            salted, pair = salted[order], pair[order]
            met = (salted[1:] == salted[:-1]) & (pair[1:] == pair[:-1])
            both = np.bincount(pair[1:][met], minlength=b - a)
            union = np.bincount(pair, minlength=b - a) - both
            out += ((both > 0) & (100 * both >= percent * union)).tolist()
        return pa.array(out, pa.bool_())

    left = lines.select(F.col("node").alias("a"), F.col("line").alias("left"))
    right = lines.select(F.col("node").alias("b"), F.col("line").alias("right"))
    return pairs.join(left, "a").join(right, "b").where(alike(F.col("left"), F.col("right"))).select("a", "b")


def duplicate_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``line_nodes``, written, and links (a, b) between nodes."""
    per_row = written(line_nodes(df, doc_id, text, row), "lines")
    keyed = written(band_members(per_row), "bands")
    nodes = written(keyed.select("node").distinct(), "band-nodes")
    # Lines are found again by their node: an id may stand for several texts, or for none.
    texts = line_texts(df.select(F.col(text).cast("string").alias("t")), nodes).join(small(nodes), "node", "left_semi")
    lines = written(line_facts(texts.groupBy("node").agg(F.min("line").alias("line"))), "band-lines")
    carried = ["n_shingles", *_CELLS]
    members = written(keyed.join(lines.select("node", *carried), "node"), "band-members")
    links = linked(members, [], ["p1", "p2", *carried], _possible(percent), lambda pairs: similar_lines(pairs, lines, percent), _first, few=FEW)
    return per_row, written(links, "line-links")


def occurrences_on_map(per_row: DataFrame, nodes: DataFrame) -> DataFrame:
    """doc_id, row, line_no, node of the lines of ``per_row`` whose node may be among ``nodes`` (written)."""
    wanted = per_row.sparkSession.sparkContext.broadcast(number_map(nodes))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            number, node = batch.column(2).flatten().flatten()
            of = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy())
            met = np.flatnonzero(on_map(wanted.value, node.to_numpy()))
            at = pa.array(of[met])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), number.take(pa.array(met)), node.take(pa.array(met))],
                                             ["doc_id", "row", "line_no", "node"])

    return per_row.select("doc_id", "row", "lines").where(F.size("lines") > 0).mapInArrow(run, "doc_id long, row long, line_no int, node long")


def dropped_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, row: str | None = None) -> DataFrame:
    """One row per input row: doc_id, row, n_lines, dropped (array of line numbers, from 0)."""
    per_row, links = duplicate_lines(df, doc_id, text, percent, row)
    linked_nodes = written(components(links), "line-components")
    roots = linked_nodes.select(F.col("component").alias("node"), "component").distinct()
    place = F.struct("doc_id", "line_no", "row")
    first = (per_row.select("doc_id", "row", F.explode("lines").alias("x")).select("doc_id", "row", "x.line_no", "x.node")
             .groupBy("node").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")))
    # Nodes of one occurrence without links have nothing to drop and leave here.
    several = written(first.join(linked_nodes.unionByName(roots), "node", "left").where("n > 1 or component is not null")
                      .select("node", F.coalesce("component", "node").alias("component"), "first"), "line-groups")
    kept = several.join(several.groupBy("component").agg(F.min("first").alias("kept")), "component").select("node", "kept")
    kept = written(kept, "line-kept")
    drop = (occurrences_on_map(per_row, kept.select("node")).join(kept, "node").where(~place.eqNullSafe(F.col("kept")))
            .groupBy("row").agg(F.sort_array(F.collect_list("line_no")).alias("dropped")))
    return (per_row.select("doc_id", "row", F.size("lines").cast("long").alias("n_lines")).join(drop, "row", "left")
            .withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>"))))


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``df`` with the dropped lines cut out of ``text``, row by row: as many rows as before, whatever their ids."""
    row = "llm_row"
    while row in df.columns:
        row += "_"
    rows = written(df.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")  # written, so both sides see the same numbers
    drop = dropped_lines(rows, doc_id, text, percent, row).select(F.col("row").alias("llm_drop_row"), F.col("dropped").alias("llm_dropped")).where(F.size("llm_dropped") > 0)
    lines = F.split(F.col(text), "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.array_contains(F.col("llm_dropped"), i.cast("int")))
    cut = F.when(F.col("llm_dropped").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return rows.join(drop, rows[row] == drop["llm_drop_row"], "left").withColumn(text, cut).select(df.columns)
