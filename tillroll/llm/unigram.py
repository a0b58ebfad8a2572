"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their log scores come from a public SentencePiece model file (its
path is a parameter; nothing is trained). A file of merge ranks (a BPE model)
gives no log scores: its ranks become them by Zipf's law, ``-log(rank + 10)``.

Text is read as SentencePiece does: a space is the whitespace marker, one marker
is put in front, a character without a piece costs ``lowest score - 10`` and is
written as its byte pieces. A marker character that is really in the text is
written as bytes too, so decoding returns every text exactly. On equal scores the
path whose last piece is longer wins, from the end of the text backwards.

No piece holds a marker after another character, so the best path of a text is
made of the best paths of its chunks (a run of spaces and what follows). Each
block of texts is cut into chunks, every distinct chunk is decoded once, all of
them together in numpy: the trie is walked from every character at once, and
the Viterbi steps go by place within the chunk.

Defined results: a null text encodes like an empty one, to no ids (the marker in
front is only written before text); repeated rows are encoded one by one; an empty
table gives an empty result; extra columns pass through, but for those named like
the added ones. Memory follows the longest single text.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.kernel import ranges, span_hashes, text_blocks

MARK = "▁"
BLOCK_BYTES = 1 << 20
NORMAL, USER_DEFINED, BYTE, UNIGRAM = 1, 4, 6, 1  # fixed values of the model file format
UNKNOWN_PENALTY = 10.0
ZIPF_SHIFT = 10.0


def _fields(data: bytes):
    """(field number, value) pairs of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size


def read_model(path: str) -> tuple[list[tuple[str, float, int]], bool]:
    """(piece, score, type) rows of a model file, and whether its scores are log scores."""
    pieces, kind = [], UNIGRAM
    with open(path, "rb") as f:
        data = f.read()
    for number, value in _fields(data):
        if number == 1:
            got = dict(_fields(value))
            pieces.append((got[1].decode(), struct.unpack("<f", got[2])[0] if 2 in got else 0.0, got.get(3, NORMAL)))
        elif number == 2:
            kind = dict(_fields(value)).get(3, UNIGRAM)
    return pieces, kind == UNIGRAM


class DoubleArrayTrie:
    """Byte strings in two arrays: from state s, byte b leads to ``base[s] + b`` if
    ``check`` there is s; ``value`` holds the id of the string that ends there or -1."""

    def __init__(self, entries: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for word, number in sorted(entries.items()):
            node = 0
            for b in word:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = len(children)
                    children.append({})
                    children[node][b] = nxt
                node = nxt
            ends[node] = number
        size = 8 * len(children) + 8192
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[:257] = True  # places below a byte's range stay free of children
        place, free, end = {0: 0}, 257, 257
        queue = [0]
        for node in queue:
            kids = children[node]
            if not kids:
                continue
            letters = np.array(sorted(kids))
            while used[free]:
                free += 1
            # single children fill holes; others go to the filled end, or behind it
            if len(kids) == 1:
                at = max(1, free - int(letters[0]))
                while used[at + letters[0]]:
                    at += 1
            else:
                spots = max(1, end - 512 - int(letters[0])) + np.arange(512)
                fits = ~used[spots[:, None] + letters].any(axis=1)
                at = int(spots[np.argmax(fits)]) if fits.any() else end + 1
            end = max(end, at + int(letters[-1]))
            state = place[node]
            base[state] = at
            for b, kid in kids.items():
                slot = at + b
                used[slot], check[slot], place[kid] = True, state, slot
                value[slot] = ends.get(kid, -1)
                queue.append(kid)
        top = end + 257
        self.base, self.check, self.value = base[:top], check[:top], value[:top]


class Pieces:
    """A model's pieces, ready for encoding and decoding."""

    def __init__(self, rows: list[tuple[str, float, int]], log_scores: bool):
        normal = {i: p.replace(MARK, " ").encode() for i, (p, _, t) in enumerate(rows) if t in (NORMAL, USER_DEFINED)}
        for word in normal.values():
            if b" " in word.lstrip(b" "):
                raise ValueError(f"a piece holds a marker after another character: {word!r}")
        self.scores = np.full(len(rows), 0.0)
        for i in normal:
            s = rows[i][1]
            self.scores[i] = s if log_scores else -np.log(ZIPF_SHIFT - s)
        self.scores = np.round(self.scores * (1 << 20)) / (1 << 20)  # sums are exact, so ties are ties
        self.unknown_score = min((self.scores[i] for i in normal), default=0.0) - UNKNOWN_PENALTY
        self.trie = DoubleArrayTrie({w: i for i, w in normal.items()})
        self.byte_ids = np.full(256, -1, np.int32)
        written: list[bytes] = []
        for i, (p, _, t) in enumerate(rows):
            if t == BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
                written.append(bytes([int(p[1:-1], 16)]))
            else:
                written.append(normal.get(i, b""))
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        self.out_bytes = np.frombuffer(b"".join(written), np.uint8)
        self.out_sizes = np.array([len(w) for w in written], np.int64)
        self.out_starts = np.cumsum(self.out_sizes) - self.out_sizes

    @classmethod
    def load(cls, path: str) -> "Pieces":
        return cls(*read_model(path))

    def best_paths(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds of ids) of the chunks ``data[bounds[k]:bounds[k + 1]]``."""
        n, sizes = len(data), np.diff(bounds)
        begins_char = (data & 0xC0) != 0x80
        begins_char[bounds[:-1]] = True
        starts = np.flatnonzero(begins_char)
        char_end = np.append(starts[1:], n)
        chunk = np.repeat(np.arange(len(sizes)), sizes)
        limit = bounds[1:][chunk[starts]]
        # walk the trie from every character at once
        trie = self.trie
        live, state, depth = np.arange(len(starts)), np.zeros(len(starts), np.int64), 0
        single = np.zeros(len(starts), bool)
        edge_from, edge_to, edge_id = [], [], []
        while len(live):
            at = starts[live] + depth
            inside = at < limit[live]
            live, state, at = live[inside], state[inside], at[inside]
            nxt = trie.base[state].astype(np.int64) + data[at]
            ok = trie.check[nxt] == state
            live, state = live[ok], nxt[ok]
            depth += 1
            piece = trie.value[state]
            hit = piece >= 0
            who = live[hit]
            edge_from.append(starts[who])
            edge_to.append(starts[who] + depth)
            edge_id.append(piece[hit])
            single[who[char_end[who] == starts[who] + depth]] = True
        alone = np.flatnonzero(~single)
        edge_from.append(starts[alone])
        edge_to.append(np.minimum(char_end[alone], limit[alone]))
        edge_id.append(np.full(len(alone), -1, np.int32))
        source, target, piece = map(np.concatenate, (edge_from, edge_to, edge_id))
        score = np.where(piece >= 0, self.scores[piece], self.unknown_score)
        # Viterbi by place within the chunk; node of an end = its byte place + chunk number
        place = source - bounds[:-1][chunk[source]]
        order = np.argsort(place, kind="stable")
        source, target, piece, score, place = (x[order] for x in (source, target, piece, score, place))
        own = chunk[source]
        source_node, target_node = source + own, target + own
        best = np.full(n + len(sizes), -np.inf)
        back = np.full(n + len(sizes), -1, np.int64)
        best[bounds[:-1] + np.arange(len(sizes))] = 0.0
        cuts = np.flatnonzero(np.diff(place)) + 1
        for a, b in zip(np.concatenate([[0], cuts]), np.append(cuts, len(place))):
            value = best[source_node[a:b]] + score[a:b]
            to = target_node[a:b]
            better = np.flatnonzero(value > best[to])
            best[to[better]] = value[better]
            back[to[better]] = better + a
        # walk back from every chunk's end at once
        node = bounds[1:] + np.arange(len(sizes))
        first = bounds[:-1] + np.arange(len(sizes))
        open_ = np.flatnonzero(sizes > 0)
        taken, owner = [], []
        while len(open_):
            edge = back[node[open_]]
            taken.append(edge)
            owner.append(open_)
            node[open_] = source_node[edge]
            open_ = open_[node[open_] != first[open_]]
        if not taken:
            return np.zeros(0, np.int32), np.zeros(len(sizes) + 1, np.int64)
        taken, owner = np.concatenate(taken), np.concatenate(owner)
        order = np.lexsort((source[taken], owner))
        taken, owner = taken[order], owner[order]
        # unknown characters become their bytes
        width = np.where(piece[taken] >= 0, 1, target[taken] - source[taken])
        ids = np.repeat(piece[taken], width)
        raw = np.repeat(piece[taken] < 0, width)
        lost = piece[taken] < 0
        ids[raw] = self.byte_ids[data[ranges(source[taken][lost], width[lost])]]
        count = np.bincount(owner, weights=width, minlength=len(sizes)).astype(np.int64)
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(count)])

    def encode_block(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the texts of a block."""
        sizes = np.diff(offsets)
        shift = (sizes > 0).astype(np.int64)  # one marker in front of every text
        bounds = np.concatenate([[0], np.cumsum(sizes + shift)])
        data = np.full(bounds[-1], 0x20, np.uint8)
        data[ranges((bounds[:-1] + shift), sizes)] = buf
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        space = data == 0x20
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[bounds[:-1][sizes > 0]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(data))
        _, index, inverse = np.unique(span_hashes(data, starts, ends, False), return_index=True, return_inverse=True)
        size = (ends - starts)[index]
        ids, at = self.best_paths(data[ranges(starts[index], size)], np.concatenate([[0], np.cumsum(size)]))
        counts = np.diff(at)[inverse]
        out = ids[ranges(at[:-1][inverse], counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        return out, total[np.searchsorted(starts, bounds)]

    def decode_block(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts of id runs; the marker in front is dropped."""
        sizes = self.out_sizes[ids]
        data = self.out_bytes[ranges(self.out_starts[ids], sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        front = total[:-1][np.diff(total) > 0]
        keep = np.ones(len(data), bool)
        keep[front] = data[front] != 0x20
        return data[keep], np.concatenate([[0], np.cumsum(keep)])[total]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())],
    ).cast(pa.string())


def _encode(pieces: Pieces, text: str, own: list[str], digest: bool, spell: bool = False):
    def run(batches):
        for batch in batches:
            for i, j, buf, offsets in text_blocks(batch, text, BLOCK_BYTES):
                part = batch.slice(i, j - i)
                ids, bounds = pieces.encode_block(buf, offsets)
                columns, names = [part.column(c) for c in own], [*own, "n_ids"]
                columns.append(pa.array(np.diff(bounds)))
                if digest:
                    data, back = pieces.decode_block(ids, bounds)
                    raw, again, was = ids.astype("<u4").tobytes(), data.tobytes(), buf.tobytes()
                    pairs = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                    columns.append(pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in pairs], pa.int64()))
                    columns.append(pa.array([
                        again[a:b] == was[c:d]
                        for a, b, c, d in zip(*(x.tolist() for x in (back[:-1], back[1:], offsets[:-1], offsets[1:])))
                    ], pa.bool_()))
                    fallback = np.concatenate([[0], np.cumsum(np.isin(ids, pieces.byte_ids))])
                    columns.append(pa.array(np.diff(fallback[bounds]), pa.int64()))
                    names += ["ids_crc32", "round_trip", "n_byte_ids"]
                else:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())))
                    names.append("ids")
                    if spell:
                        columns.append(_strings(*pieces.decode_block(ids, bounds)))
                        names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _schema(df: DataFrame, own: list[str], more: str) -> T.StructType:
    return T.StructType([T.StructField(c, df.schema[c].dataType, True) for c in own] + T._parse_datatype_string(more).fields)


def encode(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``df`` plus ``ids`` (array of piece ids) and ``n_ids``."""
    own = [c for c in df.columns if c not in ("ids", "n_ids")]
    schema = _schema(df, own, "n_ids bigint, ids array<int>")
    return df.select(own).mapInArrow(_encode(Pieces.load(model_path), text, own, False), schema)


def encode_and_decode(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``df`` without ``text`` plus ``n_ids``, ``ids`` and ``decoded``, the text that the ids
    spell, in one pass."""
    own = [c for c in df.columns if c not in (text, "ids", "n_ids", "decoded")]
    schema = _schema(df, own, "n_ids bigint, ids array<int>, decoded string")
    return df.select(*own, text).mapInArrow(_encode(Pieces.load(model_path), text, own, False, True), schema)


def encode_digest(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``df`` without ``text`` plus ``n_ids``, ``ids_crc32`` (of the ids as little-endian
    unsigned 32-bit integers), ``round_trip`` (decoding gave the text back) and
    ``n_byte_ids`` (ids from byte fallback); the ids themselves stay in the task."""
    added = ("n_ids", "ids_crc32", "round_trip", "n_byte_ids")
    own = [c for c in df.columns if c != text and c not in added]
    schema = _schema(df, own, "n_ids bigint, ids_crc32 bigint, round_trip boolean, n_byte_ids bigint")
    source = df.select(*own, text)
    return source.mapInArrow(_encode(Pieces.load(model_path), text, own, True), schema)


def _decode(pieces: Pieces, own: list[str]):
    def run(batches):
        for batch in batches:
            column = batch.column("ids")
            lists = column.fill_null([]) if column.null_count else column
            size = np.diff(lists.offsets.to_numpy().astype(np.int64))
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = pieces.decode_block(ids, np.concatenate([[0], np.cumsum(size)]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in own), _strings(data, offsets)], names=[*own, "decoded"])

    return run


def decode(df: DataFrame, model_path: str) -> DataFrame:
    """``df`` plus ``decoded``: the text that ``ids`` spell."""
    own = [c for c in df.columns if c != "decoded"]
    return df.select(own).mapInArrow(_decode(Pieces.load(model_path), own), _schema(df, own, "decoded string"))
