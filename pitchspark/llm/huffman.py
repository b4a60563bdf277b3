"""Canonical length-limited Huffman codes on whole numpy arrays."""

from __future__ import annotations

import numpy as np

#: A decoder can begin at each of these token counts of a document.
CHECKPOINT = 256


def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for symbols with these counts (0: no code), by package-merge."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    least = int(np.ceil(np.log2(len(used))))
    limit = max(16, least + 1) if limit is None else limit
    if limit < least:
        raise ValueError(f"{len(used)} symbols need codes of {least} bits or more")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = np.asarray(counts)[order].astype(np.float64)
    packages, is_leaf = np.zeros(0), []
    for _ in range(limit):
        values = np.concatenate((leaves, packages))
        by_value = np.argsort(values, kind="stable")
        is_leaf.append(by_value < len(leaves))
        values = values[by_value]
        values = values[: len(values) // 2 * 2]
        packages = values[0::2] + values[1::2]
    take = 2 * len(used) - 2
    for flags in reversed(is_leaf):
        leaf = int(flags[:take].sum())
        lengths[order[:leaf]] += 1
        take = 2 * (take - leaf)
    return lengths


class Code:
    """The canonical code of these lengths: shorter codes first, equal lengths by symbol."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, dtype=np.int64)
        self.longest = int(self.lengths.max(initial=1))
        symbols = np.flatnonzero(self.lengths)
        symbols = symbols[np.argsort(self.lengths[symbols], kind="stable")]
        steps = np.int64(1) << (self.longest - self.lengths[symbols])
        begin = np.cumsum(steps) - steps  # in units of the longest code
        self.codes = np.zeros(len(self.lengths), dtype=np.int64)
        self.codes[symbols] = begin >> (self.longest - self.lengths[symbols])
        # Decoding table: the next ``longest`` bits give the symbol and its length.
        self.table_symbol = np.zeros(1 << self.longest, dtype=np.int32)
        self.table_length = np.ones(1 << self.longest, dtype=np.int64)
        filled = int(steps.sum())
        self.table_symbol[:filled] = np.repeat(symbols, steps)
        self.table_length[:filled] = np.repeat(self.lengths[symbols], steps)

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code documents of ``counts`` ids each, every one from a byte on.

        Returns the bytes, the byte length of each document and, document after
        document, the bit offsets of its checkpoints (from its own first bit).
        """
        length = self.lengths[ids]
        if len(ids) and not length.all():
            raise ValueError("an id has no code")
        document = np.repeat(np.arange(len(counts)), counts)
        first = np.cumsum(counts) - counts
        run = np.concatenate((np.zeros(1, np.int64), np.cumsum(length)))
        within = run[:-1] - run[first][document]
        size = (run[first + counts] - run[first] + 7) // 8
        base = np.cumsum(size) - size
        bit = base[document] * 8 + within
        word = self.codes[ids] << (32 - (bit & 7) - length)  # at most 18 + 7 bits
        total = int(size.sum())
        out = np.zeros(total + 4)
        for k in range(4):
            out += np.bincount((bit >> 3) + k, (word >> (24 - 8 * k)) & 255, minlength=total + 4)
        place = np.arange(len(ids)) - first[document]
        return out[:total].astype(np.uint8), size, within[place % CHECKPOINT == 0].astype(np.uint32)

    def decode(self, data: np.ndarray, counts: np.ndarray, sizes: np.ndarray, checkpoints: np.ndarray) -> np.ndarray:
        """The ids of all documents: a lane from each checkpoint, all lanes one symbol a step."""
        if not len(checkpoints):
            return np.zeros(0, np.int32)
        lanes = -(-counts // CHECKPOINT)
        document = np.repeat(np.arange(len(counts)), lanes)
        base = (np.cumsum(sizes) - sizes) * 8
        bit = base[document] + checkpoints.astype(np.int64)
        nth = np.arange(len(document)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        todo = np.minimum(counts[document] - nth * CHECKPOINT, CHECKPOINT)
        padded = np.concatenate((data, np.zeros(4, np.uint8))).astype(np.uint32)
        window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        order = np.argsort(-todo, kind="stable")
        bit, todo = bit[order], todo[order]
        out = np.empty((int(todo[0]), len(todo)), dtype=np.int32)
        alive = np.searchsorted(-todo, -np.arange(1, int(todo[0]) + 1), side="right")
        for step in range(int(todo[0])):
            n = alive[step]
            at = bit[:n]
            key = ((window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - self.longest)).astype(np.int64)
            out[step, :n] = self.table_symbol[key]
            bit[:n] = at + self.table_length[key]
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        lane_major = out.T[back]
        return lane_major[np.arange(len(out)) < todo[back][:, None]]
