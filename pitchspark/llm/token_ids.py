"""Token ids as a compact binary format: Huffman blocks with checkpoints.

``encode_ids`` turns texts into ids with a public tokenizer; ``write_tokens``
writes them in ascending id order; ``read_tokens`` reads them back.

Files: a folder with ``codebook`` (Parquet: id, length) and ``blocks``, raw
files whose names sort in document order. A block is, in little-endian order,
``TKB1``, documents (u32), checkpoints (u32), payload bytes (u64), then per
document its id (i64), null flag (u8), ids (u32), payload bytes (u32), then the
checkpoints (u32: bit offset of every 256th id from its document's first bit),
then the payload; a newline ends it. Codes are canonical Huffman codes of at most
16 bits (more only for vocabularies that need it) from the counts of all ids.
Each document's code begins at a byte, so blocks are joined without recoding,
and every checkpoint can be decoded on its own.

Jobs: tokenise and write the ids (narrow), each task with the counts of its ids; add these up, at most
one row per vocabulary entry reaches the driver; code each document where it
lies, range-partition the coded documents by id and write them. The range
partitions follow the number of ids, ties in the id are split, a file holds a
bounded number of blocks, a block at least one whole document.

Null texts are empty: the end id alone. Null ids sort first. Repeated rows are
repeated documents. An empty table gives a codebook without entries, no blocks
and no rows. A text's special-token strings are encoded as the tokenizer does.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, flat, mix, small, texts_of, written
from .huffman import CHECKPOINT, Code, code_lengths
from .rawfiles import read_files, write_records

BLOCK_IDS = 1 << 16
FILE_BLOCKS = 256
_MAGIC = b"TKB1"
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("ids", "<u4"), ("size", "<u4")])


#: Pieces longer than this many bytes are encoded each time; shorter ones are remembered.
PIECE_BYTES = 48
#: Bytes after a space that begin a new piece for sure: printable ASCII, and lead bytes of no white space.
_CUT = np.zeros(256, dtype=bool)
_CUT[0x21:0x7F] = True
_CUT[0xC3:0xE1] = _CUT[0xE4:0xF5] = True
#: Kinds of bytes for the splits of the byte-level pattern: letters, digits, other printable ASCII, white space but the space. No kind: 0.
_LETTER, _DIGIT, _SIGN, _BLANK = 1, 2, 3, 4
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = 0  # an apostrophe may take letters with it
_KIND[0x09:0x0E] = _BLANK
#: First bytes of two whose characters are letters, U+00C0 to U+017F (but two signs) and U+0400 to U+047F.
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = True
#: The character that stands for each byte in a byte-level vocabulary.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = np.arange(256, dtype="<u4")
_BYTE_CHARS[sorted(set(range(256)) - set(_SHOWN))] = np.arange(256, 512 - len(_SHOWN))


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; both bytes of a letter of two count as letters."""
    kinds = _KIND[data]
    lead = np.flatnonzero(_LEAD[data[:-1]])
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
    kinds[lead] = kinds[lead + 1] = _LETTER
    return kinds


def _splits(kinds: np.ndarray, printable: np.ndarray) -> np.ndarray:
    """Whether a split of the byte-level pattern certainly begins at each byte but the first, whatever stands around the two texts.

    That is where letters, digits and signs meet, where white space follows a printable character, and after
    a single white space between two of them.
    """
    before, after = kinds[:-1], kinds[1:]
    cut = (before != after) & (before - np.uint8(1) < 3) & (after - np.uint8(1) < 3)
    blank = printable[:-1] & (after == _BLANK)
    cut |= blank
    cut[1:] |= blank[:-1] & printable[2:]
    return cut


def _span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of byte spans, eight bytes a step; ``data`` ends with eight spare bytes."""
    one = mix(lengths.astype(np.uint64) + np.uint64(1))
    two = mix(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the eight bytes from each byte on
    rest, at, live = lengths.copy(), starts.copy(), np.arange(len(starts))
    while len(live):
        word = words[at]
        short = rest < 8
        word[short] &= (np.uint64(1) << (np.uint64(8) * rest[short].astype(np.uint64))) - np.uint64(1)
        one[live] = mix((one[live] ^ word) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(7))
        two[live] = mix((two[live] + word) * np.uint64(0xA0761D6478BD642F) ^ np.uint64(0xE7037ED1A0B428DB))
        more = rest > 8
        live, rest, at = live[more], rest[more] - 8, at[more] + 8
    return one, two


#: Bytes of text whose pieces are looked up at once.
TEXT_BYTES = 2 << 20


class Pieces:
    """Ids of pieces by the pieces' hashes, in arrays: sorted by the first hash, checked by the second.

    Holds at most about ``limit`` bytes; beyond that the half used least often leaves and all counts are halved.
    """

    def __init__(self, kind: np.dtype, limit: int):
        self.limit, self.kind = limit, kind
        self.one, self.two = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.size, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, kind)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The place of each piece, -1 where it is not known."""
        if not len(self.one):
            return np.full(len(one), -1)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return np.where((self.one[at] == one) & (self.two[at] == two), at, -1)

    def add(self, one: np.ndarray, two: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """New pieces, sorted by their first hash, with their places in ``ids``; one whose first hash is there already is not found."""
        at = np.searchsorted(self.one, one)
        if len(self.one):
            fresh = self.one[np.minimum(at, len(self.one) - 1)] != one
            at, one, two, begin, size = at[fresh], one[fresh], two[fresh], begin[fresh], size[fresh]
        new = {"one": one, "two": two, "start": begin + len(self.ids), "size": size, "used": np.zeros(len(one), np.int64)}
        self.ids = np.concatenate([self.ids, ids])
        for name, values in new.items():
            setattr(self, name, np.insert(getattr(self, name), at, values))

    def shrink(self) -> None:
        if 40 * len(self.one) + self.ids.nbytes <= self.limit:
            return
        keep = np.sort(np.argsort(-self.used, kind="stable")[: len(self.one) // 2])
        self.ids = self.ids[_gather(self.start[keep], self.size[keep])]
        self.one, self.two, self.size, self.used = self.one[keep], self.two[keep], self.size[keep], self.used[keep] // 2
        self.start = np.cumsum(self.size) - self.size


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[i] ... starts[i] + sizes[i] - 1`` of all i, one behind the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class ChunkTokenizer:
    """Ids of whole texts, remembering the ids of the pieces between spaces.

    A byte-level tokenizer splits text before it merges, and a space before a
    character that is no white space always begins a new split; so a text cut
    there encodes piece by piece to the same ids. With the library's own byte-level pattern, texts
    are also cut where letters, digits and signs meet (``_splits``). A chunk's pieces are found and hashed as arrays, its
    distinct ones looked up; new words of that pattern are one split each and go to the library's model, without
    its cache, for no word comes twice; other new pieces go through the library together, joined
    into longer strings whose ids are cut again at the tokens that begin with a
    space - only a piece's first does. ``limit`` bounds the bytes of the pieces that are kept.
    Texts with a special token's string are encoded whole. No Python object stands for a
    known piece.
    """

    JOINED = 200

    def __init__(self, path: str, limit: int = 64 << 20):
        import os

        from tokenizers import Tokenizer, models, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.begins[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("\u0120")]] = True
        self.known = Pieces(self.kind, limit)  # kept between a worker's tasks
        t = self.tokenizer
        plain = (t.normalizer is None and isinstance(t.pre_tokenizer, pre_tokenizers.ByteLevel) and t.pre_tokenizer.use_regex
                 and not t.pre_tokenizer.add_prefix_space and isinstance(t.model, models.BPE) and not t.model.dropout)
        self.words = None
        if plain:
            self.words = Tokenizer.from_file(path).model
            if hasattr(self.words, "_resize_cache"):
                self.words._resize_cache(0)

    def _alone(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in found]

    def _learn(self, new: list[bytes], word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of new pieces, and where each one's begin and how many they are; ``word`` marks those that the model takes as they are.

        Of the others, pieces that do not begin with a cut, or hold another space, have no sure cut and go alone.
        """
        size = np.zeros(len(new), np.int64)
        words, rest = np.flatnonzero(word), np.flatnonzero(~word)
        of_words: list[int] = []
        shown = _BYTE_CHARS[np.frombuffer(b"\n".join([new[i] for i in words.tolist()]), np.uint8)].tobytes().decode("utf-32-le")
        n_ids = []
        for x in shown.split(chr(_BYTE_CHARS[0x0A])) if len(words) else ():
            found = self.words.tokenize(x)
            of_words += [t.id for t in found]
            n_ids.append(len(found))
        size[words] = n_ids
        sure = np.array([len(p) > 1 and p[0] == 0x20 and bool(_CUT[p[1]]) and p.find(b" ", 1) < 0 for p in (new[i] for i in rest.tolist())], dtype=bool)
        joint, alone = rest[sure], rest[~sure]
        groups = [joint[a : a + self.JOINED] for a in range(0, len(joint), self.JOINED)]
        parts = self._alone([b"".join([new[i] for i in g.tolist()]) for g in groups])
        for group, ids in zip(groups, parts, strict=True):
            cuts = np.flatnonzero(self.begins[ids])
            if len(cuts) != len(group):
                raise ValueError("the tokenizer does not begin a token at each space")
            size[group] = np.diff(cuts, append=len(ids))
        parts += self._alone([new[i] for i in alone.tolist()])
        size[alone] = [len(x) for x in parts[len(groups) :]]
        parts.append(np.array(of_words, dtype=self.kind))
        begin, order = np.zeros(len(new), np.int64), np.concatenate([joint, alone, words])
        begin[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate(parts), begin, size

    def encode(self, texts: list[bytes], end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each chunk of ``texts``: the ids of its texts, each with ``end`` behind, and where each text's ids end."""
        for a, b in chunks(texts, TEXT_BYTES):
            yield self._encode(texts[a:b], end)

    def _encode(self, texts: list[bytes], end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = np.array([any(s in t for s in self.special) for t in texts], dtype=bool)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        text_starts = np.cumsum(lengths) - lengths
        raw = b"".join(texts)
        data = np.frombuffer(raw + bytes(8), np.uint8)
        # A piece begins at a text's first byte and at each sure cut inside a text.
        is_cut = np.zeros(len(raw) + 1, dtype=bool)
        if len(raw) > 1:
            is_cut[: len(raw) - 1] = (data[: len(raw) - 1] == 0x20) & _CUT[data[1 : len(raw)]]
            last = (text_starts + lengths - 1)[lengths > 0]
            is_cut[last] = False  # what follows it is the next text
        if self.words is not None:
            kinds = _kinds(data[: len(raw)])
            is_cut[1 : len(raw)] |= _splits(kinds, (kinds - np.uint8(1) < 3) | (data[: len(raw)] == 0x27))
        is_cut[text_starts[lengths > 0]] = True
        starts = np.flatnonzero(is_cut[: len(raw)])
        of = np.searchsorted(text_starts + lengths, starts, side="right")  # the text of each piece
        drop = whole[of] & (starts != text_starts[of])
        starts, of = starts[~drop], of[~drop]
        sizes = np.diff(np.append(starts, len(raw)))
        short = (sizes <= PIECE_BYTES) & ~whole[of]
        one, two = _span_hashes(data, starts[short], sizes[short])
        distinct, first, inverse = np.unique(one, return_index=True, return_inverse=True)
        second = two[first]
        odd = second[inverse] != two  # equal first hashes of different pieces: encoded alone below
        at = self.known.find(distinct, second)
        new = np.flatnonzero(at < 0)
        begin, size = starts[short][first][new], sizes[short][first][new]
        if len(new):
            word = np.zeros(len(new), dtype=bool)
            if self.words is not None:  # a space or none, then letters only
                letters = np.add.reduceat(kinds[_gather(begin, size)] == _LETTER, np.cumsum(size) - size, dtype=np.int64)
                word = (letters > 0) & (letters == size - (data[begin] == 0x20))
            learnt = self._learn([raw[x : x + n] for x, n in zip(begin.tolist(), size.tolist(), strict=True)], word)
            self.known.add(distinct[new], second[new], *learnt)
            at = self.known.find(distinct, second)
        places = np.flatnonzero(short)
        # Long pieces, and those whose first hash another one has.
        lone = np.concatenate([np.flatnonzero(~short), places[odd | (at < 0)[inverse]]])
        extra = self._alone([raw[starts[i] : starts[i] + sizes[i]] for i in lone.tolist()])
        blob = np.concatenate([self.known.ids, *extra]) if extra else self.known.ids
        begins, counts = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        begins[places], counts[places] = self.known.start[at][inverse], self.known.size[at][inverse]
        counts[lone] = [len(x) for x in extra]
        begins[lone] = len(self.known.ids) + np.cumsum(counts[lone]) - counts[lone]
        self.known.used[at[at >= 0]] += np.bincount(inverse, minlength=len(distinct))[at >= 0]
        # The end ids go behind each text's pieces.
        ends = np.cumsum(np.bincount(of, weights=counts, minlength=len(texts)).astype(np.int64) + len(end))
        out = np.empty(int(ends[-1]), self.kind)
        is_end = np.zeros(len(out), dtype=bool)
        for j in range(len(end)):
            is_end[ends - len(end) + j] = True
            out[ends - len(end) + j] = end[j]
        out[~is_end] = blob[_gather(begins, counts)]
        self.known.shrink()
        return out, ends


def id_kind(tokenizer: str) -> np.dtype:
    """The number type that holds this tokenizer's ids."""
    return ChunkTokenizer(tokenizer).kind


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


#: Texts whose strings and ids a task holds at once.
SLICE_ROWS = 512


def _add_counts(total: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """``total`` (how often each id occurs) with ``ids`` counted too."""
    for a in range(0, len(ids), 1 << 17):  # parts that stay in the processor's cache
        found = np.bincount(ids[a : a + (1 << 17)])
        if len(found) > len(total):
            total, found = found, total
        total[: len(found)] += found
    return total


def encode_ids(df: DataFrame, tokenizer: str, text: str = "text", end_id: int = 0, out: str = "ids", keep: list[str] | None = None,
               counts: str | None = None) -> DataFrame:
    """Add ``out``: the ids of the whole text and the end id, as little-endian unsigned 16-bit (32-bit for large vocabularies).

    ``keep``: the other columns of the result, by default all but one named like ``out``. ``counts``: a column for
    ``write_tokens``; in a task's last row how often each id occurs in all of the task's rows (64-bit), null in the others.
    """
    keep = [c for c in df.columns if c != out] if keep is None else keep
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("llm_text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(out, T.BinaryType())])
    if counts is not None:
        schema = schema.add(counts, T.BinaryType())

    def counted(batches):
        import pyarrow as pa

        total, last = np.zeros(0, np.int64), None
        for batch in batches:
            total = _add_counts(total, flat(batch.column(len(keep)))[0].view(id_type))
            if last is not None:
                yield last.append_column(counts, pa.nulls(last.num_rows, pa.binary()))
            last = batch
        if last is not None:
            yield last.append_column(counts, pa.array([None] * (last.num_rows - 1) + [total.astype("<i8").tobytes()], pa.binary()))

    def run(batches):
        import pyarrow as pa

        t = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, ChunkTokenizer(tokenizer))
        end = np.array([end_id], dtype=t.kind)
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(a, SLICE_ROWS)
                done = 0
                for ids, ends in t.encode(texts_of(part.column(len(keep))), end):
                    n = len(ends)
                    column = _binary(ids.view(np.uint8), t.kind.itemsize * np.concatenate(([0], ends)))
                    yield pa.RecordBatch.from_arrays([*(c.slice(done, n) for c in part.columns[:-1]), column], [*keep, out])
                    done += n

    if counts is None:
        return rows.mapInArrow(run, schema)
    id_type = id_kind(tokenizer)
    return rows.mapInArrow(lambda batches: counted(run(batches)), schema)


def count_ids(df: DataFrame, kind: np.dtype, ids: str = "ids", counts: str | None = None) -> np.ndarray:
    """How often each id occurs in the whole table, from the ids or else from the column of ``counts`` that ``encode_ids`` made."""

    def sums(batches):
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            if counts is None:
                total = _add_counts(total, flat(batch.column(0))[0].view(kind))
            else:
                for part in batch.column(0).to_pylist():
                    found = np.frombuffer(part, "<i8")
                    total = np.pad(total, (0, max(0, len(found) - len(total))))
                    total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    column = df.select(ids) if counts is None else df.select(counts).where(F.col(counts).isNotNull())
    rows = column.mapInArrow(sums, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(int(max(rows["id"].to_pylist(), default=-1)) + 1, np.int64)
    out[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return out


def _binary(data: np.ndarray, offsets: np.ndarray):
    import pyarrow as pa

    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


#: Keys a partition from which the range partitions' bounds are taken.
SAMPLE_KEYS = 100


def key_bounds(keys: DataFrame, parts: int) -> list[tuple]:
    """The least (has an id, id, tie) of each of ``parts`` ranges of about equally many rows but the first, of keys (doc_id, tie).

    Bounds only balance the partitions, so a hashed sample gives them. Unlike ``repartitionByRange``, whose sampling runs
    all that stands before it, this reads the keys alone.
    """
    if parts < 2:
        return []
    every = max(1, keys.count() // (parts * SAMPLE_KEYS))
    found = sorted((d is not None, d or 0, t) for d, t in keys.where(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(every)) == 0).collect())
    return [found[len(found) * i // parts] for i in range(1, parts)] if found else []


def _coded(code: Code, kind: np.dtype, bounds: list[tuple]):
    def run(batches):
        from bisect import bisect_right

        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = flat(batch.column(2))
            ids, ends = data.view(kind), offsets // kind.itemsize
            begin = 0
            while begin < batch.num_rows:  # parts that stay in the processor's cache; a longer document alone
                stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] + (1 << 16), side="right")) - 1)
                counts = np.diff(ends[begin : stop + 1])
                coded, sizes, points = code.encode(ids[ends[begin] : ends[stop]].astype(np.int64), counts)
                ids_of, ties = (batch.column(c).slice(begin, stop - begin) for c in (0, 1))
                part = [bisect_right(bounds, (d is not None, d or 0, t)) for d, t in zip(ids_of.to_pylist(), ties.to_pylist(), strict=True)]
                per = 4 * np.concatenate(([0], np.cumsum(-(-counts // CHECKPOINT))))
                yield pa.RecordBatch.from_arrays([
                    ids_of, ties, pa.array(part, pa.int32()), pa.array(counts, pa.int64()),
                    _binary(coded, np.concatenate(([0], np.cumsum(sizes)))), _binary(points.astype("<u4").view(np.uint8), per),
                ], ["doc_id", "tie", "part", "n", "code", "points"])
                begin = stop

    return run


def _block(rows: list[tuple]) -> bytes:
    docs = np.array([(d or 0, d is None, n, len(c)) for d, n, c, _ in rows], dtype=_DOC)
    payload, points = b"".join(r[2] for r in rows), b"".join(r[3] for r in rows)
    head = len(rows).to_bytes(4, "little") + (len(points) // 4).to_bytes(4, "little") + len(payload).to_bytes(8, "little")
    return _MAGIC + head + docs.tobytes() + points + payload


def _blocks(block_ids: int):
    def run(batches):
        import pyarrow as pa

        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "code", "points")), strict=True):
                rows.append(row)
                size += row[1]
                if size >= block_ids:
                    yield pa.RecordBatch.from_arrays([pa.array([_block(rows)], pa.binary())], ["block"])
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([_block(rows)], pa.binary())], ["block"])

    return run


def write_tokens(encoded: DataFrame, path: str, kind: np.dtype, doc_id: str = "doc_id", ids: str = "ids",
                 block_ids: int = BLOCK_IDS, file_blocks: int = FILE_BLOCKS, counts: str | None = None) -> None:
    """Write ``encoded`` (read twice: pass a written table, whole if with ``counts``) in ascending id order."""
    spark = encoded.sparkSession
    counts = count_ids(encoded, kind, ids, counts)
    code = Code(code_lengths(counts))
    used = np.flatnonzero(code.lengths)
    spark.createDataFrame([(int(i), int(code.lengths[i])) for i in used], "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    parts = max(1, -(-int(counts.sum()) // (block_ids * file_blocks)))
    parts = max(parts, min(64, -(-int(counts.sum()) // (4 * block_ids))))
    rows = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("tie"), ids)
    blocks = (rows.mapInArrow(_coded(code, kind, key_bounds(rows.select("doc_id", "tie"), parts)), "doc_id long, tie long, part int, n long, code binary, points binary")
              .repartitionById(parts, F.col("part")).sortWithinPartitions("doc_id", "tie")
              .mapInArrow(_blocks(block_ids), "block binary"))
    write_records(blocks, "block", f"{path}/blocks", "\n", file_blocks)


def parse_blocks(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The blocks of a file: documents, checkpoints, payload."""
    at = 0
    while at < len(content):
        if content[at : at + 4] != _MAGIC:
            raise ValueError(f"no block at byte {at}")
        n, points, size = (int.from_bytes(content[at + a : at + b], "little") for a, b in ((4, 8), (8, 12), (12, 20)))
        at += 20
        docs = np.frombuffer(content, _DOC, n, at)
        at += n * _DOC.itemsize
        marks = np.frombuffer(content, "<u4", points, at)
        at += 4 * points
        yield docs, marks, np.frombuffer(content, np.uint8, size, at)
        at += size + 1


def _joined(blocks: Iterable, limit: int = 1 << 20) -> Iterator[tuple]:
    """Blocks put together up to ``limit`` ids, so that decoding has many lanes."""
    group, size = [], 0
    for block in blocks:
        group.append(block)
        size += int(block[0]["ids"].sum())
        if size >= limit:
            yield tuple(map(np.concatenate, zip(*group, strict=True)))
            group, size = [], 0
    if group:
        yield tuple(map(np.concatenate, zip(*group, strict=True)))


def load_code(spark: SparkSession, path: str) -> Code:
    rows = spark.read.parquet(f"{path}/codebook").toArrow()
    lengths = np.zeros(max(rows["id"].to_pylist(), default=0) + 1, np.uint8)
    lengths[rows["id"].to_numpy()] = rows["length"].to_numpy()
    return Code(lengths)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids, array<int>) of every document, decoded from the files.

    ``start`` is the place in the file plus the ids of the files before it.
    """
    code = load_code(spark, path)

    def decode(batches):
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                place = 0
                for docs, points, payload in _joined(parse_blocks(content)):
                    n = docs["ids"].astype(np.int64)
                    ids = code.decode(payload, n, docs["size"].astype(np.int64), points).astype("<u4")
                    ends = np.cumsum(n)
                    crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                    columns = [pa.array([name] * len(n), pa.string()), pa.array(docs["doc_id"], pa.int64(), mask=docs["null"] > 0),
                               pa.array(place + ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                    names = ["path", "doc_id", "place", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int32))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
                    place += int(ends[-1]) if len(ends) else 0

    schema = "path string, doc_id long, place long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    documents = written(read_files(spark, f"{path}/blocks").mapInArrow(decode, schema), "tokens-read")
    files = documents.groupBy("path").agg(F.sum("n_tokens").alias("of_file"))
    return (documents.join(small(written(file_bases(files), "tokens-files")), "path")
            .select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])))


#: Consecutive parts whose files are summed together.
PART_GROUP = 1000


def file_bases(files: DataFrame) -> DataFrame:
    """path, base: the ids in all files before each one, of files (path, of_file) named by part and number within it.

    Numbers, not names, give the order, for both have more digits when they must. Sums of
    groups of parts come first, so that no task sees all files.
    """
    name = F.element_at(F.split("path", "/"), -1)
    number = lambda pattern: F.regexp_extract(name, pattern, 1).cast("long")
    placed = files.select("path", "of_file", number(r"^part-(\d+)").alias("part"), number(r"-c(\d+)\.").alias("seq"))
    placed = placed.withColumn("group", F.floor(F.col("part") / PART_GROUP))
    sums = placed.groupBy("group").agg(F.sum("of_file").alias("of_group"))
    before = sums.select("group", (F.sum("of_group").over(W.orderBy("group")) - F.col("of_group")).alias("before"))
    inside = F.sum("of_file").over(W.partitionBy("group").orderBy("part", "seq")) - F.col("of_file")
    return placed.withColumn("inside", inside).join(before, "group").select("path", (F.col("before") + F.col("inside")).alias("base"))
