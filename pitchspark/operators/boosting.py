"""Joint weighted three-class boosting on histograms, one or many fits at a time (M1, M2, M5).

The objective is the weighted multinomial log loss of a softmax over all
classes. Each round grows one tree per class from the same probabilities.
Feature values are binned once by approximate quantiles (bin 0: missing); the
binned rows are packed into blocks of bounded size. One Spark job per
tree level sums, for all classes, the first and second derivatives of the loss by (fit, class, node,
feature, bin): each task makes its own sums; Spark adds them up by key, or the driver where
the tasks' sums together are few. The driver sees sums only, no rows, and
picks the splits: gain of the second-order expansion with L1 (soft threshold) and L2
penalties; missing values go to the better side. Leaf values follow from the same sums, so a tree
of depth d costs d jobs for any number of rows, classes and fits.

Rows are sampled per round by a hash of (key, round), columns per tree by a hash of (round, class),
so a lost task gives the same sums again. Margins of all rows are kept with the blocks and
brought forward every ``CARRY`` rounds; between, a task looks up the few newer trees: each feature's bin leaves some
leaves of a tree possible, eight trees a machine word, and the words of all features together leave one. Features are summed
several at once, by their joint bins, so a row is added few times.

``fit_many`` trains all given parameter sets and folds in the same jobs. Numbers of rounds
are prefixes of one fit: a grid over them costs the longest only.
"""

from __future__ import annotations

import json
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchspark.session import shared_path

#: Rows of a block (a row of the blocks' table), blocks a file and bytes of them a worker gets at once: bounds on what is held besides the persisted rows.
BLOCK_ROWS = 1 << 14
FILE_BLOCKS = 32
BATCH_BYTES = 8 << 20
#: Rows a task should have at least.
TASK_ROWS = 1 << 16
CARRY = 10
BINS = 64
#: Partial sums of all tasks, in cells, up to which the driver adds them itself (32 MB); beyond, Spark adds them by key.
DRIVER_CELLS = 1 << 21
#: Rows a task works on at once (their numbers stay in the processor's cache); cells of the joint bins of features summed at once; trees a lookup holds and their depth at most.
CHUNK_ROWS = 1 << 14
JOINT_CELLS = 1 << 13
LOOKUP_TREES, LOOKUP_DEPTH = 8, 3
_LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Params:
    """One parameter set; the defaults are the fixed values of the default model."""

    rounds: int = 100
    depth: int = 3
    rate: float = 0.03
    subsample: float = 0.8
    columns: float = 0.8
    alpha: float = 0.1
    lam: float = 1.5
    min_child: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2 i + 1, 2 i + 2): feature (-1: leaf), last bin to the left, side of missing values, value."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` steps; rows stay in leaves."""
        feature = np.maximum(self.feature, 0)
        # The node that follows each node and bin; leaves follow themselves.
        node, bin_ = np.arange(len(feature))[:, None], np.arange(BINS)
        left = np.where(bin_ == 0, self.missing_left[:, None], bin_ <= self.bin[:, None])
        follows = np.where(self.feature[:, None] < 0, node, 2 * node + 2 - left).ravel()
        at = np.zeros(len(bins), np.intp)
        cells, row = np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
        for _ in range(levels):
            at = follows.take(at * BINS + cells.take(row + feature.take(at)))
        return at


#: The lowest bit that is set, of each byte (0 has none).
_LOWEST = np.array([0] + [(v & -v).bit_length() - 1 for v in range(1, 256)])


class Lookup:
    """``of(tree)``, an array of one number a node, at the node of each row after ``levels`` steps; for many trees at once."""

    def __init__(self, trees: list[Tree], levels: int, of, dims: int):
        self.trees, self.levels, self.values = trees, levels, [of(t) for t in trees]
        self.words: list[list[tuple[int, np.ndarray]]] = []
        self.tables: list[np.ndarray] = []
        if not 0 < levels <= LOOKUP_DEPTH:
            return
        slots = 2**levels
        for a in range(0, len(trees), LOOKUP_TREES):
            # Of each feature and bin a byte a tree: which of its slots (the nodes after all steps, if there were no leaves above) stay possible.
            masks = np.full((dims, BINS, LOOKUP_TREES), 255, np.uint8)
            for i, t in enumerate(trees[a : a + LOOKUP_TREES]):
                for level in range(levels):
                    width = slots >> level
                    for k in range(2**level):
                        node = 2**level - 1 + k
                        if t.feature[node] < 0:
                            continue
                        half = (1 << (width // 2)) - 1
                        lower, upper = half << (k * width), half << (k * width + width // 2)
                        left = np.arange(BINS) <= t.bin[node]
                        left[0] = t.missing_left[node]
                        masks[t.feature[node], :, i] &= np.where(left, 255 ^ upper, 255 ^ lower).astype(np.uint8)
            self.words.append([(j, masks[j].reshape(-1).view(np.uint64)) for j in range(dims) if (masks[j] != 255).any()])
        for t, values in zip(trees, self.values, strict=True):
            at = np.zeros(slots, np.intp)
            for level in range(levels):
                right = np.arange(slots) >> (levels - 1 - level) & 1
                at = np.where(t.feature[at] < 0, at, 2 * at + 1 + right)
            self.tables.append(values[at][_LOWEST[:] % slots])

    def __call__(self, columns: list[np.ndarray]):
        """One array a tree, in order. ``columns``: the bins of each feature as indices."""
        n = len(columns[0])
        if not self.levels:
            yield from (np.full(n, v[0]) for v in self.values)
        elif not self.words and self.trees:
            bins = np.stack(columns, axis=1)
            yield from (v.take(t.nodes(bins, self.levels)) for t, v in zip(self.trees, self.values, strict=True))
        for a, words in enumerate(self.words):
            possible = np.full(n, ~np.uint64(0))
            for j, word in words:
                possible &= word.take(columns[j])
            each = possible.view(np.uint8).reshape(n, LOOKUP_TREES)
            for i, table in enumerate(self.tables[a * LOOKUP_TREES : (a + 1) * LOOKUP_TREES]):
                yield table.take(each[:, i])


def _value(t: Tree) -> np.ndarray:
    return t.value


class Margins:
    """Adds the values of all ``trees`` (rounds of one tree a class) to margins, classes x rows, round by round."""

    def __init__(self, trees: list[list[Tree]], p: Params, dims: int):
        self.classes = len(trees[0]) if trees else 1
        self.found = Lookup([t for r in trees for t in r], p.depth, _value, dims)

    def add(self, out: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        for i, v in enumerate(self.found(columns)):
            out[i % self.classes] += v
        return out


def _columns(bins: np.ndarray) -> list[np.ndarray]:
    """Each feature's bins as indices, of features x rows."""
    return [b.astype(np.intp) for b in bins]


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser on whole arrays."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sampled_rows(keys: np.ndarray, p: Params, round_: int) -> np.ndarray:
    """Which rows (by the hash of their key) a round takes."""
    salt = np.uint64((p.seed * 1_000_003 + round_ + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (_mix(keys ^ salt) >> np.uint64(11)).astype(np.float64) < p.subsample * 2.0**53


def sampled_columns(dims: int, p: Params, round_: int, label: int) -> np.ndarray:
    """The features that a tree may split on."""
    take = max(1, int(p.columns * dims))
    salt = np.uint64((p.seed * 7_919 + round_ * 31 + label + 1) * 0xD6E8FEB86659FD93 % 2**64)
    return np.sort(np.argsort(_mix(np.arange(dims, dtype=np.uint64) ^ salt), kind="stable")[:take])


@dataclass
class Fit:
    """A fit in progress or done: parameters, the fold it leaves out (None: none), trees[round][class]."""

    params: Params
    fold: int | None = None
    trees: list[list[Tree]] = field(default_factory=list)


@dataclass
class BoostedModel:
    """A fitted model: feature names, bin edges, classes and trees."""

    features: list[str]
    edges: list[list[float]]
    classes: int
    params: Params
    trees: list[list[Tree]]

    def binned(self, columns: list[np.ndarray]) -> np.ndarray:
        return bin_values(columns, self.edges)

    def probabilities(self, bins: np.ndarray) -> np.ndarray:
        return softmax(margins(np.zeros((len(bins), self.classes)), bins, self.trees, self.params))

    def importance(self) -> list[tuple[str, float]]:
        """Share of the features' mean gains per split, as the booster the reference uses reports them."""
        gain, splits = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in (t for r in self.trees for t in r):
            used = t.feature >= 0
            np.add.at(gain, t.feature[used], t.gain[used])
            np.add.at(splits, t.feature[used], 1)
        mean = np.divide(gain, splits, out=np.zeros_like(gain), where=splits > 0)
        return [(f, float(v)) for f, v in zip(self.features, mean / (mean.sum() or 1.0), strict=True)]

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per round and class, and the rest as JSON in a row of its own; never over an existing folder."""
        head = {"features": self.features, "edges": self.edges, "classes": self.classes, "params": asdict(self.params)}
        rows = [(-1, -1, json.dumps(head))]
        rows += [(i, c, json.dumps({k: v.tolist() for k, v in vars(t).items()})) for i, r in enumerate(self.trees) for c, t in enumerate(r)]
        spark.createDataFrame(rows, "round int, class int, body string").coalesce(1).write.mode("error").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        rows = spark.read.parquet(path).orderBy("round", "class").collect()  # one row a tree
        head = json.loads(rows[0].body)
        trees: list[list[Tree]] = []
        for r in rows[1:]:
            if r["class"] == 0:
                trees.append([])
            trees[-1].append(Tree(**{k: np.array(v) for k, v in json.loads(r.body).items()}))
        return cls(head["features"], head["edges"], head["classes"], Params(**head["params"]), trees)


def bin_values(columns: list[np.ndarray], edges: list[list[float]]) -> np.ndarray:
    """rows x features: 0 for a missing value, else one more than the number of edges below the value."""
    out = np.zeros((len(columns[0]) if columns else 0, len(columns)), np.uint8)
    for j, (v, e) in enumerate(zip(columns, edges, strict=True)):
        out[:, j] = np.where(np.isnan(v), 0, 1 + np.searchsorted(np.array(e), v, side="left"))
    return out


def softmax(m: np.ndarray) -> np.ndarray:
    """Of rows x classes."""
    return _softmax(m.T.copy()).T


def _softmax(m: np.ndarray) -> np.ndarray:
    """Of classes x rows, in place."""
    m -= m.max(axis=0)
    np.exp(m, out=m)
    m /= m.sum(axis=0)
    return m


def margins(start: np.ndarray, bins: np.ndarray, trees: list[list[Tree]], p: Params) -> np.ndarray:
    """``start`` (rows x classes) and the values of all trees for ``bins`` (rows x features)."""
    out, adds = start.T.copy(), Margins(trees, p, bins.shape[1])
    for a in range(0, len(bins), CHUNK_ROWS):
        adds.add(out[:, a : a + CHUNK_ROWS], _columns(bins[a : a + CHUNK_ROWS].T))
    return out.T


def derivatives(prob: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted loss by each class's margin, classes x rows."""
    h = 1 - prob
    h *= prob
    h *= 2
    np.maximum(h, 1e-16, out=h)
    h *= weight
    g = prob - (np.arange(len(prob))[:, None] == label)
    g *= weight
    return g, h


def _threshold(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def _score(g, h, p: Params):
    return _threshold(g, p.alpha) ** 2 / (h + p.lam)


def leaf_value(g: float, h: float, p: Params) -> float:
    return float(-p.rate * _threshold(np.float64(g), p.alpha) / (h + p.lam))


def best_split(g: np.ndarray, h: np.ndarray, allowed: np.ndarray, p: Params) -> tuple | None:
    """(gain, feature, last bin to the left, missing to the left, left g, left h) of a node's sums (features x bins)."""
    total_g, total_h = g[0].sum(), h[0].sum()
    left_g, left_h = (np.cumsum(a[:, 1:], axis=1)[:, :-1] for a in (g, h))
    best = None
    for missing in (False, True):
        lg, lh = (left + missing * a[:, :1] for left, a in ((left_g, g), (left_h, h)))
        rg, rh = total_g - lg, total_h - lh
        gain = _score(lg, lh, p) + _score(rg, rh, p) - _score(total_g, total_h, p)
        gain = np.where((lh >= p.min_child) & (rh >= p.min_child), gain, -np.inf)[allowed]
        at = int(np.argmax(gain))
        j, b = int(allowed[at // gain.shape[1]]), at % gain.shape[1]
        if gain.flat[at] > _LEAST_GAIN and (best is None or gain.flat[at] > best[0] + 1e-9 * abs(best[0])):
            best = (float(gain.flat[at]), j, b + 1, missing, float(lg[j, b]), float(lh[j, b]))
    return best


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """At most ``bins - 2`` edges per feature, from approximate quantiles; one job."""
    found = df.select(*[F.col(f).cast("double").alias(f) for f in features]).approxQuantile(features, [i / (bins - 1) for i in range(1, bins - 1)], 0.1 / bins)
    return [sorted(set(x)) for x in found]


def _blocks(df: DataFrame, features: list[str], edges: list[list[float]], label: str, weight: str | None, key: str, fold: str | None) -> DataFrame:
    """The binned rows, some 16,000 a row: bins (features x rows), label, weight, key (hash) and fold (empty without folds) as bytes."""

    def run(batches):
        import pyarrow as pa

        held, size = [], 0

        def block():
            b, y, w, k, f = (np.concatenate(x) for x in zip(*held, strict=True))
            cols = [pa.array([x.tobytes()], pa.binary()) for x in (b.T, y, w, k, f if fold else f[:0])]
            return pa.RecordBatch.from_arrays(cols, ["bins", "label", "weight", "key", "fold"])

        for batch in batches:
            d = len(features)
            columns = {i: batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(d + 4) if i != d + 2}
            part = (bin_values([columns[i] for i in range(d)], edges), columns[d].astype(np.uint8), columns[d + 1],
                    batch.column(d + 2).to_numpy(zero_copy_only=False).view(np.uint64), columns[d + 3].astype(np.int32))
            at = 0
            while at < batch.num_rows:
                end = min(batch.num_rows, at + BLOCK_ROWS - size)
                held.append([x[at:end] for x in part])
                size, at = size + end - at, end
                if size == BLOCK_ROWS:
                    yield block()
                    held, size = [], 0
        if size:
            yield block()

    rows = df.select(*[F.col(f).cast("double") for f in features], F.col(label).cast("double"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"), F.xxhash64(F.col(key).cast("string")).alias("_k"),
                     (F.coalesce(F.col(fold).cast("double"), F.lit(-1.0)) if fold else F.lit(-1.0)).alias("_f"))
    return rows.mapInArrow(run, "bins binary, label binary, weight binary, key binary, fold binary")


@dataclass
class Block:
    """A block's arrays, not copied: bins (features x rows), label, weight, key, fold (None without folds), margins (fits x classes x rows; None before the first)."""

    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    key: np.ndarray
    fold: np.ndarray | None
    margins: np.ndarray | None

    def part(self, a: int, b: int) -> Block:
        return Block(self.bins[:, a:b], self.label[a:b], self.weight[a:b], self.key[a:b], None if self.fold is None else self.fold[a:b],
                     None if self.margins is None else self.margins[:, :, a:b])

    def parts(self):
        for a in range(0, len(self.label), CHUNK_ROWS):
            yield self.part(a, a + CHUNK_ROWS)

    def margins_of(self, fit: int, classes: int, rows: np.ndarray | None = None) -> np.ndarray:
        """New margins of the rows, to be added to."""
        n = len(self.label) if rows is None else len(rows)
        if self.margins is None:
            return np.zeros((classes, n))
        return self.margins[fit].copy() if rows is None else self.margins[fit].take(rows, axis=1)


def _unpacked(batches, dims: int, fits: int, classes: int):
    """(batch, place in it, block) of each row."""
    kinds = {"bins": np.uint8, "label": np.uint8, "weight": np.float64, "key": np.uint64, "fold": np.int32, "margins": np.float64}
    for batch in batches:
        for i in range(batch.num_rows):
            cells = {c: batch.column(c)[i] for c in _STATE}
            x = {c: np.frombuffer(v.as_buffer(), kinds[c]) if v.is_valid and len(v.as_buffer()) else None for c, v in cells.items()}
            n = len(x["label"])
            yield batch, i, Block(x["bins"].reshape(dims, n), x["label"], x["weight"], x["key"], x["fold"],
                                  None if x["margins"] is None else x["margins"].reshape(fits, classes, n))


def _carried(blocks: DataFrame, fits: list[Fit], dims: int, classes: int) -> DataFrame:
    """The blocks, which have no margins, with all fits' margins after their trees so far."""
    new = [(f.params, f.trees) for f in fits]

    def run(batches):
        import pyarrow as pa

        adds = [Margins(trees, p, dims) for p, trees in new]
        for batch, i, block in _unpacked(batches, dims, len(new), classes):
            out = np.empty((len(new), classes, len(block.label)))
            begin = 0
            for part in block.parts():
                columns, end = _columns(part.bins), begin + len(part.label)
                for k, add in enumerate(adds):
                    out[k, :, begin:end] = add.add(part.margins_of(k, classes), columns)
                begin = end
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in _STATE[:-1]), pa.array([out.tobytes()], pa.binary())], _STATE)

    return blocks.mapInArrow(run, ", ".join(f"{c} binary" for c in _STATE))


_STATE = ["bins", "label", "weight", "key", "fold", "margins"]


def _joint(sizes: list[int]) -> list[list[int]]:
    """Features whose bins (``sizes`` of them) are summed jointly: as few sets as have at most ``JOINT_CELLS`` cells each, by first fit."""
    sets: list[tuple[int, list[int]]] = []
    for j in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        at = next((i for i, (n, _) in enumerate(sets) if n * sizes[j] <= JOINT_CELLS), None)
        if at is None:
            sets.append((sizes[j], [j]))
        else:
            sets[at] = (sets[at][0] * sizes[j], [*sets[at][1], j])
    return [of for _, of in sets]


def _level_sums(state: DataFrame, fits: list[Fit], growing: dict[int, list[Tree]], since: int, round_: int, level: int, dims: int, classes: int, parts: int,
                sizes: list[int]) -> dict:
    """(fit, class, node) -> sums of both derivatives, 2 x features x bins, of the nodes of one level. ``sizes``: how many bins each feature has."""
    work = [(i, fits[i].params, fits[i].fold, fits[i].trees[since:], growing[i]) for i in growing]
    n_fits, first, nodes = len(fits), 2**level - 1, 2**level
    joint = _joint(sizes)

    def place(t: Tree) -> np.ndarray:
        """Of each node its place in the level; those above are beyond."""
        at = np.arange(len(t.feature)) - first
        return np.where((at >= 0) & (at < nodes), at, nodes)

    def run(batches):
        adds = {i: Margins(trees, p, dims) for i, p, _, trees, _ in work}
        places = {i: Lookup(grown, level, place, dims) for i, _, _, _, grown in work}
        shape = [int(np.prod([sizes[j] for j in of])) for of in joint]
        held = {(i, c): [np.zeros((2, (nodes + 1) * n)) for n in shape] for i, *_ in work for c in range(classes)}
        for _, _, block in _unpacked(batches, dims, n_fits, classes):
            for part in block.parts():
                drawn: dict = {}
                for i, p, left_out, _, _ in work:
                    if (p.seed, p.subsample) not in drawn:
                        rows = np.flatnonzero(sampled_rows(part.key, p, round_))
                        columns = [b.take(rows).astype(np.intp) for b in part.bins]
                        codes = []
                        for of in joint:
                            code = columns[of[0]]
                            for j in of[1:]:
                                code = code * sizes[j] + columns[j]
                            codes.append(code)
                        drawn[p.seed, p.subsample] = rows, columns, codes, part.label.take(rows), part.weight.take(rows), None if part.fold is None else part.fold.take(rows)
                    rows, columns, codes, y, w, fold = drawn[p.seed, p.subsample]
                    # Rows of the fold left out weigh nothing.
                    w = w if left_out is None else w * (fold != left_out)
                    g, h = derivatives(_softmax(adds[i].add(part.margins_of(i, classes, rows), columns)), y, w)
                    for c, at in enumerate(places[i](columns)):
                        for n, code, sums in zip(shape, codes, held[i, c], strict=True):
                            cell = at * n + code if level else code
                            for v, s in ((g[c], sums[0]), (h[c], sums[1])):
                                s += np.bincount(cell, v, len(s))
        for (i, c), found in held.items():
            sums = np.zeros((2, nodes, dims, BINS))
            for of, x in zip(joint, found, strict=True):
                x = x.reshape(2, nodes + 1, *(sizes[j] for j in of))[:, :nodes]
                for k, j in enumerate(of):
                    sums[:, :, j, : sizes[j]] = x.sum(axis=tuple(2 + m for m in range(len(of)) if m != k))
            yield from emit(i * classes + c, sums.reshape(2, -1))

    def whole(place, sums):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([sums.tobytes()], pa.binary())], ["place", "sums"])

    def by_cell(place, sums):
        import pyarrow as pa

        used = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(place * cells + used, pa.int64()), pa.array(sums[0][used]), pa.array(sums[1][used])], ["cell", "g", "h"])

    cells = nodes * dims * BINS
    out = np.zeros((2, n_fits * classes * cells))
    if parts * len(growing) * classes * cells <= DRIVER_CELLS:
        emit, schema = whole, "place long, sums binary"
        for r in state.mapInArrow(run, schema).toArrow().to_pylist():  # one row per task, fit and class, bounded above
            out[:, r["place"] * cells : (r["place"] + 1) * cells] += np.frombuffer(r["sums"]).reshape(2, cells)
    else:
        emit, schema = by_cell, "cell long, g double, h double"
        found = state.mapInArrow(run, schema).groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        at = found["cell"].to_numpy()
        out[0, at], out[1, at] = found["g"].to_numpy(), found["h"].to_numpy()
    out = out.reshape(2, n_fits, classes, nodes, dims, BINS)
    return {(i, c, first + k): out[:, i, c, k] for i in growing for c in range(classes) for k in range(nodes)}


def _grow(trees: list[Tree], i: int, sums: dict, level: int, p: Params, round_: int, dims: int) -> None:
    """Split the nodes of one level; children get their values as leaves."""
    for c, t in enumerate(trees):
        allowed = sampled_columns(dims, p, round_, c)
        for node in range(2**level - 1, 2 ** (level + 1) - 1):
            if level and t.feature[(node - 1) // 2] < 0:
                continue
            g, h = sums[i, c, node]
            if not level:
                t.value[0] = leaf_value(g[0].sum(), h[0].sum(), p)
            split = best_split(g, h, allowed, p)
            if split:
                t.gain[node], t.feature[node], t.bin[node], t.missing_left[node], lg, lh = split
                t.value[2 * node + 1], t.value[2 * node + 2] = leaf_value(lg, lh, p), leaf_value(g[0].sum() - lg, h[0].sum() - lh, p)


def _held_out_hits(state: DataFrame, fits: list[Fit], since: int, dims: int, classes: int) -> dict[int, tuple[int, int]]:
    """fit -> (rows of its left-out fold, rows whose largest probability is their label)."""
    work = [(i, f.params, f.fold, f.trees[since:]) for i, f in enumerate(fits) if f.fold is not None]
    n_fits = len(fits)

    def run(batches):
        import pyarrow as pa

        adds = {i: Margins(trees, p, dims) for i, p, _, trees in work}
        for _, _, block in _unpacked(batches, dims, n_fits, classes):
            found = np.zeros((len(work), 2), np.int64)
            for part in block.parts():
                drawn = {left_out: np.flatnonzero(part.fold == left_out) for _, _, left_out, _ in work}
                columns = {left_out: [b.take(rows).astype(np.intp) for b in part.bins] for left_out, rows in drawn.items()}
                for k, (i, _, left_out, _) in enumerate(work):
                    rows = drawn[left_out]
                    m = adds[i].add(part.margins_of(i, classes, rows), columns[left_out])
                    found[k] += len(rows), np.count_nonzero(m.argmax(axis=0) == part.label.take(rows))
            yield pa.RecordBatch.from_arrays([pa.array([w[0] for w in work], pa.int64()), *(pa.array(x.copy()) for x in found.T)], ["fit", "n", "hits"])

    rows = state.mapInArrow(run, "fit long, n long, hits long").groupBy("fit").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()
    return {r.fit: (r.n, r.hits) for r in rows}


@dataclass
class Binned:
    """What fits read: bin edges and the blocks."""

    edges: list[list[float]]
    blocks: DataFrame


def binned(df: DataFrame, features: list[str], label: str, weight: str | None, key: str, fold: str | None = None) -> Binned:
    """The rows of ``df``, read three times, as blocks written once."""
    df = df.coalesce(max(1, -(-df.count() // TASK_ROWS)))  # a few full blocks cost less than many small tasks, each round anew
    edges = bin_edges(df, features)
    blocks = _blocks(df, features, edges, label, weight, key, fold)
    path = shared_path(df.sparkSession, "boosting-blocks")
    blocks.write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(path)  # a reader takes the rows of a file at once
    return Binned(edges, df.sparkSession.read.schema(blocks.schema).parquet(path))


@contextmanager
def _small_batches(spark: SparkSession):
    """Arrow batches of at most about ``BATCH_BYTES``; by Spark's number of rows alone all blocks of a task are one."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fit_many(df: DataFrame | Binned, features: list[str], fits: list[Fit], label: str, weight: str | None, key: str, fold: str | None = None,
             classes: int = 3, report: tuple[int, ...] = ()) -> tuple[list[list[float]], dict[int, dict[int, tuple[int, int]]]]:
    """Grow the trees of all ``fits`` in common jobs; returns the bin edges and, after each round of ``report``, the held-out hits."""
    rows = df if isinstance(df, Binned) else binned(df, features, label, weight, key, fold)
    spark = rows.blocks.sparkSession
    with _small_batches(spark):
        return rows.edges, _fit_rounds(rows, fits, len(features), classes, report, spark.sparkContext.defaultParallelism)


def _fit_rounds(rows: Binned, fits: list[Fit], dims: int, classes: int, report: tuple[int, ...], tasks: int) -> dict[int, dict[int, tuple[int, int]]]:
    """The rounds of ``fit_many``, the blocks dealt evenly to ``tasks`` tasks: each job has as many as run at once, and no more partial sums."""

    def kept(df: DataFrame) -> DataFrame:
        return df.persist(StorageLevel.MEMORY_AND_DISK)

    sizes, since, reports = [len(e) + 2 for e in rows.edges], 0, {}
    state = base = kept(rows.blocks.withColumn("margins", F.lit(None).cast("binary")).repartition(tasks))
    last = max(f.params.rounds for f in fits) - 1
    try:
        parts = min(state.count(), tasks)  # no more tasks than blocks have sums
        for round_ in range(last + 1):
            live = [i for i, f in enumerate(fits) if round_ < f.params.rounds]
            growing = {i: [Tree.empty(fits[i].params.depth) for _ in range(classes)] for i in live}
            for level in range(max(fits[i].params.depth for i in live)):
                part = {i: growing[i] for i in live if level < fits[i].params.depth and (not level or any((t.feature >= 0).any() for t in growing[i]))}
                if not part:
                    break
                sums = _level_sums(state, fits, part, since, round_, level, dims, classes, parts, sizes)
                for i in part:
                    _grow(growing[i], i, sums, level, fits[i].params, round_, dims)
            for i in live:
                fits[i].trees.append(growing[i])
            if round_ + 1 in report:
                reports[round_ + 1] = _held_out_hits(state, fits, since, dims, classes)
            if (round_ + 1) % CARRY == 0 and round_ < last:
                # Always from the blocks, over all rounds so far: plans stay short, and what a lost executor held is one pass.
                before, state = state, kept(_carried(base, fits, dims, classes))
                state.count()
                since = round_ + 1
                if before is not base:
                    before.unpersist()
    finally:
        state.unpersist()
        base.unpersist()
    return reports


def fit_boosted(df: DataFrame | Binned, features: list[str], label: str, weight: str | None, key: str, params: Params = Params(), classes: int = 3) -> BoostedModel:
    """One fit on all rows (M1)."""
    one = Fit(params)
    edges, _ = fit_many(df, features, [one], label, weight, key, classes=classes)
    return BoostedModel(features, edges, classes, params, one.trees)


def grid_accuracies(df: DataFrame | Binned, features: list[str], grid: dict[str, list], label: str, weight: str | None, key: str, fold: str = "fold",
                    folds: int = 5, classes: int = 3, base: Params = Params()) -> list[tuple[Params, float, list[float]]]:
    """(parameters, mean held-out accuracy, accuracies by fold) of every grid point (M2): all points and folds in one pass over the rounds.

    Points that differ in ``rounds`` only share their fits.
    """
    points = [{}]
    for k, values in grid.items():
        points = [{**p, k: v} for p in points for v in values]
    points = [replace(base, **p) for p in points]
    counts = sorted({p.rounds for p in points})
    longest = list(dict.fromkeys(replace(p, rounds=counts[-1]) for p in points))
    fits = [Fit(p, f) for p in longest for f in range(folds)]
    _, reports = fit_many(df, features, fits, label, weight, key, fold, classes, tuple(counts))
    out = []
    for p in points:
        begin = longest.index(replace(p, rounds=counts[-1])) * folds
        found = [reports[p.rounds][begin + f] for f in range(folds)]
        by_fold = [hits / n if n else 0.0 for n, hits in found]
        out.append((p, sum(by_fold) / folds, by_fold))
    return out


def score(model: BoostedModel, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction`` (the first largest probability) and ``p`` ARRAY<DOUBLE> (M3, M4)."""

    @F.arrow_udf("array<double>")
    def probabilities(*columns):
        import pyarrow as pa

        bins = model.binned([c.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float) for c in columns])
        p = model.probabilities(bins)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * model.classes), pa.array(p.ravel()))

    keep = [c for c in df.columns if c not in ("p", "prediction")]
    scored = df.select(*keep, probabilities(*[F.col(f).cast("double") for f in model.features]).alias("p"))
    return scored.select(*keep, (F.array_position("p", F.array_max("p")) - 1).cast("int").alias("prediction"), "p")
