"""Helpers shared by the operators: tables, written intermediates, vectorised words and hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchspark.session import ensure_checkpoint_dir, ship_package

#: ASCII white space, the separator of words ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text handled at once inside a task; a longer single text forms a chunk of its own.
CHUNK_BYTES = 1 << 20
#: The same where a chunk becomes many arrays of 64-bit numbers, whose memory a reused worker keeps.
WORDS_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; also readies the session (shared folder, package on the workers)."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of rows that a Python worker gets at once. By rows alone, Spark's 10,000 of long texts are one batch, held in the executor and in each worker.
BATCH_BYTES = 8 << 20


def ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives executor loss."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column | str) -> Column:
    """Rows that no model learns from: ``crc32(doc_id as text) mod 5 = 0``."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % 5 == 0


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of at most ``limit`` bytes in all (one longer text stands alone)."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, on whole arrays."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_P**i`` and its inverse for i < n, kept between calls for chunks of the usual size."""
    if len(_POWERS[0]) < n:
        size = max(n, (WORDS_BYTES if n <= WORDS_BYTES + 65536 else CHUNK_BYTES) + 65536)
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            full = np.full(size, base, dtype=np.uint64)
            full[0] = 1
            made = np.multiply.accumulate(full)
            if size > 4 * CHUNK_BYTES:  # one very long text: not kept
                _POWERS_LONG = made if k == 0 else (_POWERS_LONG, made)
            else:
                _POWERS[k] = made
        if size > 4 * CHUNK_BYTES:
            return _POWERS_LONG
    return _POWERS[0], _POWERS[1]


class Words:
    """The words of a chunk of texts, found in one pass over the joined bytes.

    ``starts``/``ends`` are byte offsets into ``data``; the words of text ``i``
    are ``first[i]:first[i + 1]``. Texts are joined by a space, so no word spans two.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray = SPACE):
        self.data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        blank = separators[self.data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            edge = np.concatenate((np.zeros(1, edge.dtype), edge))
        self.starts, self.ends = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths + 1)))
        self.first = np.searchsorted(self.starts, self.text_starts)
        self._sums: np.ndarray | None = None

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte span, from prefix sums of a polynomial over mixed bytes."""
        power, inverse = powers(len(self.data))
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * power[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether all k lie in one text."""
        h = self.hashes()
        total = np.zeros(len(h), np.uint64)
        for j in range(k):
            total[: len(h) - j] += h[j:] * np.uint64(pow(_P, 2 * j + 1, 1 << 64))
        left = np.repeat(self.first[1:], self.counts()) - np.arange(len(h))
        return mix(total), left >= k

    def shingle_sets(self, k: int) -> list[np.ndarray]:
        """Sorted distinct k-word shingles of each text; fewer words form one shingle, none an empty set."""
        sums, whole = self.shingles(k)
        h, out = None, []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(sums[a : b - k + 1]))
            elif b > a:
                h = self.hashes() if h is None else h
                short = np.array([b - a], np.uint64)
                for i in range(a, b):
                    short = mix(short * np.uint64(3) + h[i : i + 1])
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def texts_of(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


#: A table of at most this many narrow rows may be broadcast after it has been counted.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """A written, narrow table with the broadcast hint if its counted rows are few, else as it is (a shuffle join)."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, null as 0; JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow binary column end to end, without copies, and the offset of each value."""
    import pyarrow as pa

    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


#: A map of numbers has at most 2 to the power of this many bits (32 MB), however many numbers there are.
MAP_LOG = 28


def number_map(numbers: DataFrame) -> np.ndarray:
    """Words of bits, one set for each number of the only column of a written table: some 16 bits a number, up to ``MAP_LOG``."""
    n = numbers.count()
    log = min(MAP_LOG, max(12, (16 * n).bit_length()))

    def run(batches):
        import pyarrow as pa

        found = np.zeros(1 << (log - 6), np.uint64)
        for batch in batches:
            at = mix(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - log)
            np.bitwise_or.at(found, (at >> np.uint64(6)).astype(np.intp), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(found)
        for a in range(0, len(used), 1 << 16):
            part = used[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(found[part].view(np.int64), pa.int64())], ["word", "bits"])

    rows = numbers.coalesce(1 + (n >> 20)).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (log - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return words


def on_map(words: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether each 64-bit number may be on the map: true for all that are, and by chance for few others."""
    at = mix(numbers.view(np.uint64)) >> np.uint64(64 - (64 * len(words)).bit_length() + 1)
    return (words[(at >> np.uint64(6)).astype(np.intp)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
