"""Cross-entropy difference of two matched n-gram models.

The target model counts the texts marked as wanted, the background model counts
all texts. Both are interpolated bigram models over one vocabulary, every word of
the corpus. Words, contexts and bigrams are counted exactly at every input size:
no list of most frequent words, no table of fixed size.

A model is never held in one place. Rows are dealt to shards by doc_id, where they
meet their marks. A shard turns its texts into keys (of words, of contexts and of
(previous, word) pairs) and sends each key bucket one row: its distinct keys, packed,
with their counts in both models. A bucket adds up what all shards sent and answers
every shard with the corpus-wide counts of its keys, and with the bucket's share of
the number of words. The shard, read again through the same exchange, scores its
texts. A pair that stands in a third of all texts is one entry of each shard's row.
Shards and buckets grow with the corpus, so a task's memory does not.

A text's score is its background loss a word minus its target loss a word (natural
logs): above 0, the text is more like the target. With ``leave_out`` a wanted text is
scored by the target model less the text's own counts (one row's, where rows repeat), so
its loss is not that of a text learned by heart. Words are runs of other than
white space with A-Z as a-z; keys are compared by 62-bit hashes.

Defined results: a null or empty text has no words, losses and score 0; repeated
rows count as often as they stand; with no wanted row the target model is the
uniform one; words that the models' texts do not hold share one unknown word; rows
with a null doc_id are counted and scored, but never wanted; extra columns are
ignored.
"""

from __future__ import annotations

from types import SimpleNamespace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.kernel import (
    SPACE_WORDS, blocks, combine, pack_ascending_64, pack_counts, text_buffer, unpack_ascending_64, unpack_counts, words_by_text,
)
from tillroll.session import shuffle_partitions

SHARD_BYTES = 12 << 20  # of text; also what one key bucket answers for
CONTEXT_WEIGHT = 4.0  # how many sightings of a context weigh as much as the unigram
UNIGRAM_PRIOR = 0.1
WORD, CONTEXT, PAIR = 0, 1, 2  # kinds of keys, in their two lowest bits
START = np.uint64(0x5851F42D4C957F2D)  # stands for the word before the first


def _layout(*frames: DataFrame) -> tuple[int, int]:
    """(shards, key buckets) for texts of this size."""
    size = sum(f.agg(F.expr("sum(octet_length(text))").alias("b")).head()["b"] or 0 for f in frames)
    shards = max(int(size // SHARD_BYTES) + 1, shuffle_partitions(frames[0].sparkSession))
    buckets = 256
    while buckets < size // SHARD_BYTES:
        buckets *= 2
    return shards, buckets


def _shard_of(shards: int, other: str | None = None) -> Column:
    key = F.xxhash64("doc_id")
    if other:  # rows without an id meet no mark: any shard will do
        key = F.when(F.col("doc_id").isNull(), F.xxhash64(other)).otherwise(key)
    return F.pmod(key, F.lit(shards)).cast("int").alias("shard")


def _dealt(docs: DataFrame, shards: int) -> DataFrame:
    """Rows of ids and compressed texts by shard."""
    kind = docs.schema["doc_id"].dataType

    def pack(batches):
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.sort_by("shard")
            shard, cut = np.unique(batch.column("shard").to_numpy(), return_index=True)
            cut = np.append(cut, batch.num_rows)
            buf, offsets = text_buffer(batch.column("text"))
            sizes = np.diff(offsets)
            parts = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays([
                pa.array(shard, pa.int32()), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), ids),
                pa.array([sizes[a:b].astype("<i8").tobytes() for a, b in parts], pa.binary()),
                pa.array([codec.compress(buf[offsets[a] : offsets[b]].tobytes(), asbytes=True) for a, b in parts], pa.binary()),
            ], names=["shard", "doc_ids", "sizes", "texts"])

    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(kind)),
        T.StructField("sizes", T.BinaryType()), T.StructField("texts", T.BinaryType())])
    rows = docs.select(_shard_of(shards, "text"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(pack, schema).repartition("shard")


def _read(table: pa.Table) -> SimpleNamespace:
    """A shard's rows as local numbers: ``words`` (hashes), and of every word of the texts
    its number ``ids``, the number ``before`` of the one before it (0: start) and the
    number ``pair`` of the two; ``first``: where each text begins; ``keys``: of all words,
    contexts and pairs, in this order."""
    codec = pa.Codec("zstd")
    held, n = [], [np.zeros(0, np.int64)]
    for x, y in zip(table.column("texts").to_pylist(), table.column("sizes").to_pylist()):
        size = np.frombuffer(y, "<i8")
        offsets = np.concatenate([[0], np.cumsum(size)])
        buf = np.frombuffer(codec.decompress(x, int(offsets[-1]), asbytes=True) if offsets[-1] else b"", np.uint8)
        for i, j in blocks(offsets):
            h, first = words_by_text(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SPACE_WORDS, True)
            held.append(h)
            n.append(np.diff(first))
    n = np.concatenate(n)
    first = np.concatenate([[0], np.cumsum(n)])
    hashes = np.concatenate(held) if held else np.zeros(0, np.uint64)
    del held
    words, ids = np.unique(hashes, return_inverse=True)
    del hashes
    ids = ids.astype(np.int32)
    before = np.append(np.int32(0), ids[:-1] + 1).astype(np.int32) if len(ids) else ids
    before[first[:-1][n > 0]] = 0
    size = len(words) + 1
    pairs, pair = np.unique(before.astype(np.int64) * size + ids, return_inverse=True)
    pair = pair.astype(np.int32)
    contexts = np.concatenate([[START], words])
    keys = [_key(words, WORD), _key(contexts, CONTEXT), _key(combine([contexts[pairs // size], words[pairs % size]]), PAIR)]
    return SimpleNamespace(n=n, first=first, ids=ids, before=before, pair=pair, words=words, n_pairs=len(pairs), keys=np.concatenate(keys))


def _key(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (hashes & ~np.uint64(3)) | np.uint64(kind)


def _counted(own: SimpleNamespace, pick) -> np.ndarray:
    """How often each key stands at the picked words."""
    return np.concatenate([
        np.bincount(own.ids[pick], minlength=len(own.words)), np.bincount(own.before[pick], minlength=len(own.words) + 1),
        np.bincount(own.pair[pick], minlength=own.n_pairs)])


def _edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys."""
    bounds = np.arange(buckets, dtype=np.uint64) << np.uint64(64 - (buckets.bit_length() - 1))
    return np.append(np.searchsorted(keys, bounds), len(keys))


_SENT = "bucket int, shard int, keys binary, target binary, everything binary"


def _send(buckets: int, counts: bool, answer: bool):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:  # marks of rows that are not there
            return pa.table({c: pa.array([], t) for c, t in zip(
                ("bucket", "shard", "keys", "target", "everything"), (pa.int32(), pa.int32(), *(pa.binary(),) * 3))})
        own = _read(left)
        order = np.argsort(own.keys)
        keys = own.keys[order]
        at = _edges(keys, buckets)
        target = everything = np.zeros(len(keys), np.int64)
        if counts:
            marks = right.column("doc_id").combine_chunks()
            ids = pa.chunked_array([x.flatten() for x in left.column("doc_ids").chunks]).combine_chunks()
            wanted = pc.and_(pc.is_in(ids, marks), ids.is_valid()).to_numpy(zero_copy_only=False)
            target, everything = _counted(own, np.repeat(wanted, own.n))[order], _counted(own, slice(None))[order]
        parts = list(zip(at[:-1].tolist(), at[1:].tolist()))
        shard = left.column("shard")[0].as_py() if answer else -1
        # a row for every bucket: its answer also tells the bucket's share of the totals
        return pa.table({
            "bucket": pa.array(np.arange(buckets), pa.int32()), "shard": pa.array([shard] * buckets, pa.int32()),
            "keys": pa.array([pack_ascending_64(keys[a:b]) for a, b in parts], pa.binary()),
            "target": pa.array([pack_counts(target[a:b]) for a, b in parts], pa.binary()),
            "everything": pa.array([pack_counts(everything[a:b]) for a, b in parts], pa.binary()),
        })

    return send


def _added(table: pa.Table) -> SimpleNamespace:
    """What the shards sent to one bucket: distinct keys and their counts in both models."""
    sent = [unpack_ascending_64(x) for x in table.column("keys").to_pylist()]
    keys, inverse = np.unique(np.concatenate(sent), return_inverse=True)
    total = [
        np.bincount(inverse, np.concatenate([unpack_counts(x) for x in table.column(c).to_pylist()]), minlength=len(keys)).astype(np.int64)
        for c in ("target", "everything")
    ]
    return SimpleNamespace(keys=keys, inverse=inverse, sizes=[len(x) for x in sent], target=total[0], everything=total[1])


def _answer(table: pa.Table) -> pa.Table:
    """One bucket: counts of every shard's keys, and ``totals``: distinct words, words of
    the target and of all texts."""
    got = _added(table)
    word = (got.keys & np.uint64(3)) == WORD
    totals = np.array([(got.everything[word] > 0).sum(), got.target[word].sum(), got.everything[word].sum()], "<i8").tobytes()
    shard = table.column("shard").to_numpy()
    ends = np.cumsum(got.sizes)
    rows = [(k, got.inverse[end - n : end]) for k, (n, end) in enumerate(zip(got.sizes, ends.tolist())) if shard[k] >= 0]
    return pa.table({
        "shard": pa.array([shard[k] for k, _ in rows], pa.int32()),
        "bucket": table.column("bucket").take(pa.array([k for k, _ in rows], pa.int64())),
        "target": pa.array([pack_counts(got.target[at]) for _, at in rows], pa.binary()),
        "everything": pa.array([pack_counts(got.everything[at]) for _, at in rows], pa.binary()),
        "totals": pa.array([totals] * len(rows), pa.binary()),
    })


def _table_of(table: pa.Table) -> pa.Table:
    got = _added(table)
    return pa.table({
        "kind": pa.array((got.keys & np.uint64(3)).astype(np.int32)), "key": pa.array(got.keys.view(np.int64)),
        "target": pa.array(got.target), "everything": pa.array(got.everything)}).filter(pa.array(got.everything > 0))


class Vocabulary:
    """All distinct words of some texts; its length is counted when asked for."""

    def __init__(self, docs: DataFrame):
        self.docs = docs
        self._size: int | None = None

    def __len__(self) -> int:
        if self._size is None:
            self._size = counts(self.docs, self.docs.select("doc_id").limit(0)).where(f"kind = {WORD}").count()
        return self._size


class Model:
    """One model's counts, as the definition of the rows that are counted; nothing is
    held. ``sum()`` and slices (start, unknown word, then the words in key order) run a
    query and are meant for small corpora."""

    def __init__(self, docs: DataFrame, wanted: DataFrame, column: str):
        self.docs, self.wanted, self.column = docs, wanted, column

    def _words(self) -> DataFrame:
        return counts(self.docs, self.wanted).where(f"kind = {WORD}").select("key", F.col(self.column).alias("n"))

    def sum(self) -> int:
        return self._words().agg(F.sum("n").alias("n")).head()["n"] or 0

    def __getitem__(self, at: slice) -> list[int]:
        return [0, 0, *(r["n"] for r in self._words().orderBy("key").collect())][at]


class Models(NamedTuple):
    target: Model
    background: Model


def vocabulary(docs: DataFrame, text: str = "text") -> Vocabulary:
    """The words of all texts."""
    return Vocabulary(docs.select("doc_id", F.col(text).alias("text")))


def _marks(wanted: DataFrame, docs: DataFrame, shards: int) -> DataFrame:
    """The distinct ids of the target by shard, as the documents write them."""
    ids = wanted.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    return ids.select(_shard_of(shards), "doc_id")


def _sent(docs: DataFrame, texts: DataFrame, wanted: DataFrame, shards: int, buckets: int, answer: bool) -> DataFrame:
    marks = _marks(wanted, docs, shards)
    return texts.groupBy("shard").cogroup(marks.groupBy("shard")).applyInArrow(_send(buckets, True, answer), _SENT)


def counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``kind, key, target, everything``: the exact counts of both models, a row for each
    word (kind 0), context (1) and (previous, word) pair (2)."""
    docs = docs.select("doc_id", "text")
    shards, buckets = _layout(docs)
    sent = _sent(docs, _dealt(docs, shards), wanted, shards, buckets, False)
    return sent.groupBy("bucket").applyInArrow(_table_of, "kind int, key bigint, target bigint, everything bigint")


def fit(docs: DataFrame, wanted: DataFrame, vocab: Vocabulary | None = None) -> Models:
    """(target, background): the models of the wanted and of all rows of ``docs``.

    ``docs(doc_id, text)``; ``wanted(doc_id)``: the rows of the target. The vocabulary is
    that of ``docs``; nothing is counted before ``score``.
    """
    docs = docs.select("doc_id", "text")
    return Models(Model(docs, wanted, "target"), Model(docs, wanted, "everything"))


def _in_own_text(text: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For each word how often its number stands in its own text."""
    _, place, n = np.unique(text * (int(number.max(initial=0)) + 1) + number, return_inverse=True, return_counts=True)
    return n[place]


def _scored(kind: pa.DataType):
    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"doc_id": pa.array([], kind), "n_words": pa.array([], pa.int64()),
                             "target_loss": pa.array([], pa.float64()), "background_loss": pa.array([], pa.float64())})
        own = _read(left)
        order = np.argsort(own.keys)
        ids = pa.chunked_array([x.flatten() for x in left.column("doc_ids").chunks]).combine_chunks()
        marks = right.filter(pc.less(right.column("bucket"), 0)).column("doc_id").combine_chunks()
        wanted = pc.and_(pc.is_in(ids, marks), ids.is_valid()).to_numpy(zero_copy_only=False)
        right = right.filter(pc.greater_equal(right.column("bucket"), 0)).sort_by("bucket")
        totals = np.sum([np.frombuffer(x, "<i8") for x in right.column("totals").to_pylist()], axis=0)
        size = int(totals[0]) + 2  # the unknown word and the start
        n_words = len(own.words)
        owner = np.repeat(np.arange(len(own.n)), own.n)
        loss = []
        for column, total in (("target", totals[1]), ("everything", totals[2])):
            found = np.empty(len(order), np.int64)
            found[order] = np.concatenate([unpack_counts(x) for x in right.column(column).to_pylist()])
            uni = (found[:n_words] + UNIGRAM_PRIOR) / (total + UNIGRAM_PRIOR * size)
            seen, both = found[n_words : 2 * n_words + 1][own.before], found[2 * n_words + 1 :][own.pair]
            each = -np.log((both + CONTEXT_WEIGHT * uni[own.ids]) / (seen + CONTEXT_WEIGHT))
            if column == "target" and wanted.any():
                mine = np.flatnonzero(np.repeat(wanted, own.n))
                of = owner[mine]
                word, context, both = (
                    counted[at[mine]] - _in_own_text(of, at[mine])
                    for counted, at in ((found[:n_words], own.ids), (found[n_words : 2 * n_words + 1], own.before), (found[2 * n_words + 1 :], own.pair)))
                uni = (word + UNIGRAM_PRIOR) / (total - own.n[of] + UNIGRAM_PRIOR * size)
                each[mine] = -np.log((both + CONTEXT_WEIGHT * uni) / (context + CONTEXT_WEIGHT))
            loss.append(np.bincount(owner, each, minlength=len(own.n)) / np.maximum(own.n, 1))
        return pa.table({"doc_id": ids, "n_words": pa.array(own.n), "target_loss": pa.array(loss[0]), "background_loss": pa.array(loss[1])})

    return finish


def score(docs: DataFrame, models: Models, vocab: Vocabulary | None = None, *, leave_out: bool = False) -> DataFrame:
    """Per row of ``docs``: words, both losses a word, and their difference."""
    docs = docs.select("doc_id", "text")
    counted, wanted = models.background.docs, models.background.wanted
    same = docs.sameSemantics(counted)
    shards, buckets = _layout(*([docs] if same else [docs, counted]))
    texts = _dealt(docs, shards)
    if same:
        sent = _sent(docs, texts, wanted, shards, buckets, True)
    else:  # the models' texts are counted, the others only ask
        asked = texts.groupBy("shard").cogroup(_marks(docs.limit(0), docs, shards).groupBy("shard")).applyInArrow(
            _send(buckets, False, True), _SENT)
        sent = asked.union(_sent(counted, _dealt(counted, shards), wanted, shards, buckets, False))
    answers = sent.groupBy("bucket").applyInArrow(_answer, "shard int, bucket int, target binary, everything binary, totals binary").where("shard >= 0")
    kind = docs.schema["doc_id"].dataType
    answers = answers.withColumn("doc_id", F.lit(None).cast(kind))
    if same and leave_out:  # the texts of the target meet their marks again, as rows of bucket -1
        none = F.lit(None).cast("binary")
        answers = answers.unionByName(_marks(wanted, docs, shards).select(
            "shard", F.lit(-1).alias("bucket"), none.alias("target"), none.alias("everything"), none.alias("totals"), "doc_id"))
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n_words", T.LongType()), T.StructField("target_loss", T.DoubleType()),
        T.StructField("background_loss", T.DoubleType())])
    scored = texts.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_scored(_arrow(kind)), schema)
    return scored.withColumn("score", F.col("background_loss") - F.col("target_loss"))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
