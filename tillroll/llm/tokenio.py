"""Token ids in binary segments with Elias-Fano document boundaries.

Documents are dealt by ranges of ``doc_id`` and sorted inside them, encoded, closed
with an end id each, and cut into segments of about ``SEGMENT_IDS`` ids. A segment
is one row of a Parquet table written by Spark (so the writer commits whole files
and repeats lost tasks): the concatenated ids as little-endian integers of 2 or 4
bytes, and the start of every document in it as an Elias-Fano code: the low bits
packed, the high bits in unary, and the place of every ``SELECT_STEP``-th one, from
which ``select`` finds any document's offset. No 64-bit table is kept.

Encoding goes through the tokenizers library, called as it comes: added tokens that
stand in a text get their own id. Texts are cut into byte-level pre-tokens, which encoding
never crosses; the library encodes each distinct one once, and the texts' ids are
gathered from them. What a worker keeps is bounded by ``KEPT_WORDS`` pre-tokens.

Defined results: a null or empty text holds the end id alone; rows with equal
``doc_id`` follow each other in order of their text; a null ``doc_id`` comes first; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.bpe import KEPT_WORDS, Vocabulary, Words, encode_group
from tillroll.llm.common import shared_folder
from tillroll.llm.kernel import blocks, text_blocks, text_buffer

SEGMENT_IDS = 2_000_000
SELECT_STEP = 512
PIECE_BYTES = 4 << 20
END_ID = 0


class EliasFano:
    """A non-decreasing sequence of ``n`` values below ``universe``."""

    def __init__(self, n: int, universe: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.universe, self.low, self.high, self.samples = n, universe, low, high, samples
        self.width = self.low_width(n, universe)

    @staticmethod
    def low_width(n: int, universe: int) -> int:
        return max(0, (universe // n).bit_length() - 1) if n else 0

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> "EliasFano":
        n, width = len(values), cls.low_width(len(values), universe)
        low_bits = (values[:, None] >> np.arange(width)) & 1
        low = np.packbits(low_bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (values >> width) + np.arange(n)
        bits = np.zeros(n + (universe >> width) + 1, np.uint8)
        bits[ones] = 1
        samples = ones[::SELECT_STEP].astype("<u4").tobytes()
        return cls(n, universe, low, np.packbits(bits, bitorder="little").tobytes(), samples)

    def select(self, i: int) -> int:
        """The value at place ``i``: from the sampled one before it, over whole bytes."""
        at = int(np.frombuffer(self.samples, "<u4")[i // SELECT_STEP])
        left = i % SELECT_STEP
        byte = at >> 3
        current = self.high[byte] & (0xFF << (at & 7)) & 0xFF
        while left >= current.bit_count():
            left -= current.bit_count()
            byte += 1
            current = self.high[byte]
        for _ in range(left):
            current &= current - 1
        one = 8 * byte + (current & -current).bit_length() - 1
        return ((one - i) << self.width) | self._low(i)

    def _low(self, i: int) -> int:
        a = i * self.width
        chunk = int.from_bytes(self.low[a >> 3 : (a + self.width + 7) >> 3], "little")
        return (chunk >> (a & 7)) & ((1 << self.width) - 1)

    def values(self) -> np.ndarray:
        """All values at once."""
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[: self.n] - np.arange(self.n)
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.width]
        low = (low.reshape(self.n, self.width).astype(np.int64) << np.arange(self.width)).sum(axis=1) if self.width else 0
        return (high << self.width) | low


class Encoder:
    """Byte-level BPE through the tokenizers library, each distinct pre-token once.

    A group of texts is cut into pre-tokens (see :class:`tillroll.llm.bpe.Vocabulary`); the
    library encodes the ones that the worker has not seen, in one batch, and the ids
    are gathered for all places. Added tokens found in a text are cut out the same way
    and stand for their own id.
    """

    def __init__(self, definition: str, vocabulary: Vocabulary | None = None):
        self.definition, self.vocabulary = definition, vocabulary or Vocabulary(definition)
        self._tokenizer, self._words = None, Words()
        self.dtype = np.dtype("<u2" if self.vocabulary.size <= 1 << 16 else "<u4")

    def __reduce__(self):
        return Encoder, (self.definition, self.vocabulary)

    def _load(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(self.definition)

    def _ids(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens that begin at ``starts``, and the number of ids of each."""
        if self._tokenizer is None:
            self._load()
        ends = [*starts[1:].tolist(), len(data)]
        raw = data.tobytes()
        words = [raw[a:b].decode() for a, b in zip(starts.tolist(), ends)]
        found = [e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian integers; a null counts as empty."""
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        group = [(buf, offsets) for _, _, buf, offsets in text_blocks(batch, "text")]
        if not group:
            return []
        if len(self._words.hashes) > KEPT_WORDS:
            self._words = Words()
        out = []
        for ids, counts in encode_group(self.vocabulary, self._words, group, self._ids):
            ends = (self.dtype.itemsize * np.append(0, np.cumsum(counts))).tolist()
            raw = ids.astype(self.dtype).tobytes()
            out += [raw[a:b] for a, b in zip(ends, ends[1:])]
        return out


_SEGMENT = (
    "part int, seq int, ids_before bigint, doc_ids array<bigint>, n_ids bigint, id_bytes int, "
    "low binary, high binary, samples binary, ids binary"
)


def _write(encoder):
    names = [x.strip().split(" ")[0] for x in _SEGMENT.split(",")]

    def run(batches):
        from pyspark import TaskContext

        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids, docs, total = [], [], 0

        def segment():
            dtype = encoder.value.dtype
            sizes = np.array([len(x) // dtype.itemsize for x in ids], np.int64)
            ef = EliasFano.of(np.cumsum(sizes) - sizes, total)
            row = [part, seq, before, docs, total, dtype.itemsize, ef.low, ef.high, ef.samples, b"".join(ids)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(),
                     pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for i, j in blocks(text_buffer(batch.column("text"))[1], PIECE_BYTES):
                piece = batch.slice(i, j - i)
                done = encoder.value.encode(piece.column("text"))
                end = np.array([END_ID], encoder.value.dtype).tobytes()
                for d, x in zip(piece.column("doc_id").to_pylist(), done):
                    ids.append(x + end)
                    docs.append(d)
                    total += len(ids[-1]) // encoder.value.dtype.itemsize
                    if total >= SEGMENT_IDS:
                        yield segment()
                        seq, before, ids, docs, total = seq + 1, before + total, [], [], 0
        if docs:
            yield segment()

    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str | None = None, *, doc_id: str = "doc_id",
                 text: str = "text") -> str:
    """Write the ids of ``docs`` in ascending order of ``doc_id``; returns the folder."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    encoder = spark.sparkContext.broadcast(Encoder(definition))  # a fixed file: bounded
    path = path or shared_folder(spark, "token-ids")
    ordered = (
        docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"`{text}` AS text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(_write(encoder), _SEGMENT).write.parquet(path)
    return path


def _read(offset_of_part: dict[int, int]):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
                n = len(row["doc_ids"])
                ef = EliasFano(n, row["n_ids"], row["low"], row["high"], row["samples"])
                starts = np.array([ef.select(i) for i in range(n)], np.int64)
                ends = np.append(starts[1:], row["n_ids"])
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                base = offset_of_part[row["part"]] + row["ids_before"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + base), pa.array(ends - starts),
                     pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: its start in the whole id sequence, its number
    of ids (with the end id) and their checksum."""
    segments = spark.read.schema(_SEGMENT).parquet(path)
    # one row per written partition: bounded by the number of tasks, not by documents
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    offset, before = {}, 0
    for r in totals:
        offset[r["part"]] = before
        before += r["n"]
    return segments.mapInArrow(_read(offset), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
