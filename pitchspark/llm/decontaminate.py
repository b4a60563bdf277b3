"""Benchmark decontamination: passages query a BM25 index of the test items by block-max WAND.

The test items are the indexed documents: per term its postings (item, impact)
in blocks with the largest impact of each. Every passage of every training
document is a query: a passage is two neighbouring stretches of words, each as
long as the longest item or longer, so each occurrence of an item lies whole in
one passage. WAND walks the postings of the passage's terms item by item, jumps
over items whose terms' bounds cannot reach the threshold, then over blocks
whose maxima cannot. Retrieved items are verified on five-word shingles: 80 % of
the item's shingles must occur in the passage, and half of those of its question
and of its answer part. A part of fewer than ``PART_SHINGLES`` shingles reaches into
the other, so one changed word never undoes a part; of an item that has not
twice as many no part can fail when the whole does not, and the whole decides.

The threshold loses nothing: an item with 80 % of its shingles in the passage
misses no more words than shingles, so its score is at least its score with
itself less its heaviest so many terms. Impacts are divided by that bound, so
every item's threshold is 1.

Items are taken in shards of at most ``shard_words`` words, so the index sent to
the tasks is bounded; each shard is one more map over the documents. No shuffle.

Words end at white space; symbols, brackets and repeated marks glued to a word are
words of their own. An item's answer is its last sentence, of a single sentence
the second half; letters of any script are lowered. Items of fewer than five words are one shingle, items
without words and null items never match; null and empty documents have no
leaks; repeated items and rows are kept. An empty benchmark leaves nothing out.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS_BYTES, Words, chunks, texts_of

SHINGLE, OVERLAP, PART_OVERLAP = 5, 0.8, 0.5
#: One changed word undoes five shingles, half of so many.
PART_SHINGLES = 2 * SHINGLE
STRETCH = 64
BLOCK = 16
#: Terms of at most so many items are rare.
RARE = 4
SHARD_WORDS = 2_000_000
K1, B = 1.2, 0.75
LEAKS = "array<struct<item_id:bigint,score:double,overlap:double,question_overlap:double,answer_overlap:double,first_word:int>>"
_GLUED = re.compile(rb"[#$%&*+/<=>@\\^_`|~\"()\[\]{}]+|([.,;:!?'-])\1+")
_SENTENCE_END = re.compile(rb"[.!?][\"')\]]*(?=[\x20\x09-\x0D])")


def plain(text: bytes) -> bytes:
    """The text as it is compared: lower case of any script, glued symbols as words of their own."""
    lower = text.lower() if text.isascii() else text.decode("utf-8", "surrogateescape").lower().encode("utf-8", "surrogateescape")
    return _GLUED.sub(rb" \g<0> ", lower)


def answer_begin(text: bytes) -> int:
    """The number of the item's words that belong to its question, 0 if it has too few for two parts."""
    words = len(text.split())
    ends = [m.end() for m in _SENTENCE_END.finditer(text.rstrip(b" \t\n\r\x0b\x0c"))]
    question = len(text[: ends[-1]].split()) if ends else 0
    least, most = PART_SHINGLES + SHINGLE - 1, words - PART_SHINGLES
    return min(max(question if 0 < question < words else words // 2, least), most) if least <= most else 0


@dataclass
class _Item:
    item_id: int
    k: int
    question: np.ndarray
    answer: np.ndarray
    self_share: float  # threshold as a share of the item's score with itself


class ItemIndex:
    """Inverted index of one shard of items."""

    def __init__(self, items: list[tuple[int, bytes]], overlap: float = OVERLAP, part_overlap: float = PART_OVERLAP):
        self.overlap, self.part_overlap = overlap, part_overlap
        items = [(i, plain(t)) for i, t in items if t.split()]
        self.items: list[_Item] = []
        if not items:
            return
        w = Words([t for _, t in items])
        hashes, ranges = w.hashes(), list(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True))
        self.terms, at = np.unique(hashes, return_inverse=True)
        lengths = w.counts()
        self.stretch = max(STRETCH, int(lengths.max()))
        per_item = [np.unique(at[a:b], return_counts=True) for a, b in ranges]
        df = np.bincount(np.concatenate([t for t, _ in per_item]), minlength=len(self.terms))
        idf = np.log1p((len(items) - df + 0.5) / (df + 0.5))
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for n, ((item_id, text), (a, b), (terms, tf)) in enumerate(zip(items, ranges, per_item, strict=True)):
            impact = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[n] / lengths.mean()))
            k = min(SHINGLE, b - a)
            shingles = Words([text]).shingles(k)[0][: b - a - k + 1]
            cut = max(0, answer_begin(text) - k + 1)
            missing = int((1 - overlap) * len(shingles) + 1e-9)
            least = max(impact.sum() - np.sort(impact)[len(impact) - missing :].sum() if missing else impact.sum(), impact.min())
            self.items.append(_Item(item_id, k, shingles[:cut], shingles[cut:], least / impact.sum()))
            for t, x in zip(terms.tolist(), (impact / least).tolist(), strict=True):
                postings[t].append((n, x))
        self.post = [([n for n, _ in p], [x for _, x in p]) for p in postings]
        self.blocks = [[(p[min(s + BLOCK, len(p)) - 1][0], max(x for _, x in p[s : s + BLOCK])) for s in range(0, len(p), BLOCK)] for p in postings]
        self.most = np.array([max(x for _, x in p) for p in postings])
        self.need = np.full(len(self.items), 1 - 1e-9)
        for p in postings:
            if len(p) > RARE:
                np.subtract.at(self.need, [n for n, _ in p], [x for _, x in p])
        short = [p if len(p) <= RARE else [] for p in postings]
        self.rare_count = np.array([len(p) for p in short])
        self.rare_begin = np.cumsum(self.rare_count) - self.rare_count
        self.rare_item = np.array([n for p in short for n, _ in p], dtype=np.int64)
        self.rare_impact = np.array([x for p in short for _, x in p])

    def retrieve(self, terms: list[int], threshold: float = 1 - 1e-9) -> list[tuple[int, float]]:
        """All items whose score reaches the threshold, by block-max WAND over the terms' postings."""
        post, blocks, most = self.post, self.blocks, self.most
        out, end = [], len(self.items)
        cursors = [[post[t][0][0], 0, t] for t in terms]  # item, its place in the postings, term

        def seek(c, to):
            items = post[c[2]][0]
            c[1] = bisect_left(items, to, c[1])
            c[0] = items[c[1]] if c[1] < len(items) else end

        while True:
            cursors.sort()
            bound, pivot = 0.0, end
            for c in cursors:
                if c[0] == end:
                    break
                bound += most[c[2]]
                if bound >= threshold:
                    pivot = c[0]
                    break
            if pivot == end:
                return out
            n = 0
            while n < len(cursors) and cursors[n][0] <= pivot:
                n += 1
            bound, border = 0.0, cursors[n][0] if n < len(cursors) else end
            for _, place, t in cursors[:n]:
                of = blocks[t]
                j = place // BLOCK
                while j < len(of) and of[j][0] < pivot:
                    j += 1
                if j < len(of):
                    bound += of[j][1]
                    border = min(border, of[j][0] + 1)
            if bound < threshold:  # no item before the nearest end of a block or the next list's item can reach it
                for c in cursors[:n]:
                    seek(c, max(pivot + 1, border))
            elif cursors[0][0] == pivot:
                score = sum(post[t][1][place] for _, place, t in cursors[:n])
                if score >= threshold:
                    out.append((pivot, score))
                for c in cursors[:n]:
                    seek(c, pivot + 1)
            else:
                for c in cursors[:n]:
                    seek(c, pivot)

    def _windows(self, of: np.ndarray, t: np.ndarray, n: int) -> np.ndarray:
        """The passages (by their first stretch) whose rare terms may lift some item to the threshold.

        ``of``/``t``: the distinct terms of each stretch. An item's frequent
        terms give it at most ``1 - need``, so its rare ones, whose postings are
        short, must give ``need``; a term in both stretches may count twice.
        """
        rare = self.rare_count[t]
        row = np.repeat(np.arange(len(t)), rare)
        at = self.rare_begin[t][row] + np.arange(len(row)) - (np.cumsum(rare) - rare)[row]
        key, place = np.unique(of[row] * np.int64(len(self.items)) + self.rare_item[at], return_inverse=True)
        got = np.bincount(place, self.rare_impact[at], minlength=len(key))
        after = np.minimum(np.searchsorted(key, key + len(self.items)), max(len(key) - 1, 0))
        both = got + np.where(key[after] == key + len(self.items), got[after], 0) if len(key) else got
        need = self.need[key % len(self.items)]
        s = key // len(self.items)
        chosen = [s[both >= need], s[got >= need] - 1]
        if (self.need <= 0).any():  # items of frequent terms only: by the terms' largest impacts alone
            bound = np.bincount(of, self.most[t], minlength=n + 1)
            chosen.append(np.flatnonzero(bound[:-1] + bound[1:] >= 1 - 1e-9))
        return np.unique(np.concatenate(chosen))

    def leaks(self, texts: list[bytes]) -> list[list[dict]]:
        """Per text the verified items, each with its best passage."""
        found: list[dict[int, dict]] = [{} for _ in texts]
        if self.items:
            for a, b in chunks(texts, WORDS_BYTES):
                self._search([plain(t) for t in texts[a:b]], found[a:b])
        return [[best[i] for i in sorted(best)] for best in found]

    def _search(self, texts: list[bytes], found: list[dict[int, dict]]) -> None:
        w = Words(texts)
        h, n = w.hashes(), w.counts()
        if not len(h):
            return
        term = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[term] == h)
        # Stretches of each text, numbered through; an empty one after each text's last ends its passages.
        per_text = -(-n // self.stretch) + 1
        first = np.cumsum(per_text) - per_text
        text_of = np.repeat(np.arange(len(n)), n)
        stretch = first[text_of] + (np.arange(len(h)) - w.first[text_of]) // self.stretch
        pairs = np.unique(stretch[known] * np.int64(len(self.terms)) + term[known])
        of, t = pairs // len(self.terms), pairs % len(self.terms)
        total = int(per_text.sum())
        begin = np.searchsorted(of, np.arange(total + 3))
        shingles: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for s in self._windows(of, t, total).tolist():
            if not 0 <= s < total:
                continue
            i = int(np.searchsorted(first, s, side="right")) - 1
            if s == first[i] + per_text[i] - 1:
                continue  # the empty stretch
            hits = self.retrieve(np.unique(t[begin[s] : begin[s + 2]]).tolist())
            x = int(w.first[i] + (s - first[i]) * self.stretch)
            y = int(min(x + 2 * self.stretch, w.first[i + 1]))
            for number, score in hits:
                item = self.items[number]
                if item.k not in shingles:
                    shingles[item.k] = w.shingles(item.k)
                sums = shingles[item.k][0][x : max(x, y - item.k + 1)]
                q, r = (int(np.isin(part, sums).sum()) for part in (item.question, item.answer))
                share = (q + r) / (len(item.question) + len(item.answer))
                q, r = (v / len(part) if len(part) else share for v, part in ((q, item.question), (r, item.answer)))
                if share >= self.overlap and min(q, r) >= self.part_overlap:
                    row = {"item_id": item.item_id, "score": score * item.self_share, "overlap": share, "question_overlap": q,
                           "answer_overlap": r, "first_word": x - int(w.first[i])}
                    if number not in found[i] or found[i][number]["overlap"] < share:
                        found[i][number] = row


def shards(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", words: int = SHARD_WORDS) -> Iterator[list[tuple[int, bytes]]]:
    """The items in id order, in lists of at most ``words`` words (a longer item alone)."""
    out, size = [], 0
    for row in benchmark.where(F.col(text).isNotNull()).select(item_id, text).orderBy(item_id, text).toLocalIterator():
        item = (row[0], row[1].encode())
        n = len(item[1].split())
        if out and size + n > words:
            yield out
            out, size = [], 0
        out.append(item)
        size += n
    yield out


def find_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "leaks", overlap: float = OVERLAP) -> DataFrame:
    """Add ``out``: the benchmark items found in the whole text, with overlaps and the passage's first word."""
    columns = []
    for shard in shards(benchmark):
        index = ItemIndex(shard, overlap)

        @F.arrow_udf(LEAKS)
        def leaks(column, index=index):
            import pyarrow as pa

            kind = pa.list_(pa.struct([("item_id", pa.int64()), *((c, pa.float64()) for c in ("score", "overlap", "question_overlap", "answer_overlap")),
                                       ("first_word", pa.int32())]))
            return pa.array(index.leaks(texts_of(column)), kind)

        columns.append(leaks(F.col(text)))
    return df.withColumn(out, F.concat(*columns) if len(columns) > 1 else columns[0])
