"""Byte-level BPE encoding and decoding by an index of pair occurrences.

A task cuts its texts into pre-tokens with numpy (character classes, then the start
rules of the byte-level pattern), keeps each distinct pre-token once, and encodes the
distinct ones together: an index maps every pair of neighbouring symbols to all its
positions, active ranks are taken in ascending order, all positions of a rank are
merged at once, and the lists of the pairs that appear are extended. One sweep is
exact because a pair that holds a new symbol always ranks behind the merge that made
the symbol; ``Vocabulary`` verifies that of the tokenizer file.

Texts are taken in groups of about ``GROUP_BYTES`` bytes, classes and hashes in blocks
of 1 MB inside them, so a task's memory follows the longest single text only. Encoded
pre-tokens stay in the worker for the next groups and are dropped together when there
are more than ``KEPT_WORDS``; that changes time, never ids. Pre-tokens are told apart by 64-bit hashes
and their lengths.

Character classes come from the tokenizer file's own pre-tokenizer, so letters and
digits of newer Unicode versions fall as the tokenizers library lets them fall.
Added tokens found in a text become their one id and cut the text, as there.

Defined results: a null or empty text has no ids and decodes to the empty text;
repeated rows and null ids give a row each; texts of any length are whole; an empty
table gives no rows; other columns are ignored. Decoding ids that end inside a
character gives U+FFFD there, as the library does; an id that the file does not hold
spells nothing.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.kernel import ranges, span_hashes, text_blocks

GROUP_BYTES = 16 << 20
KEPT_WORDS = 1 << 20
LETTER, NUMBER, OTHER, SPACE = range(4)
#: fixed values: the endings that the byte-level pattern splits off after an apostrophe
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_characters() -> dict[str, int]:
    """The byte of every character that byte-level vocabularies spell bytes with:
    printable Latin-1 characters stand for themselves, the other bytes for the
    characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges, token bytes and character classes of a byte-level BPE tokenizer file."""

    def __init__(self, definition: str):
        d = json.loads(definition)
        model = d["model"]
        plain = d.get("normalizer") is None and (d.get("pre_tokenizer") or {}).get("type") == "ByteLevel" \
            and not d["pre_tokenizer"].get("add_prefix_space") and d["pre_tokenizer"].get("use_regex", True)
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or not plain or odd:
            raise ValueError("not a plain byte-level BPE tokenizer file")
        self.added = {}
        for t in d.get("added_tokens") or []:
            if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized"):
                raise ValueError(f"added token {t['content']!r} needs rules that are not built")
            self.added[t["content"].encode()] = t["id"]
        vocab = model["vocab"]
        of_char = byte_characters()
        size = max([*vocab.values(), *self.added.values()]) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(of_char[c] for c in token)
        for content, i in self.added.items():
            spelled[i] = content
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.lengths = np.array([len(x) for x in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.size = size
        self.byte_ids = np.zeros(256, np.int32)
        for c, b in of_char.items():
            self.byte_ids[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.new = np.array([vocab[a + b] for a, b in merges], np.int64)
        made = np.full(size, -1, np.int64)
        made[self.new] = np.arange(len(merges))
        rank = np.arange(len(merges))
        if len(np.unique(self.new)) != len(merges) or (made[self.left] >= rank).any() or (made[self.right] >= rank).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = self.left * size + self.right
        order = np.argsort(keys)
        self.keys, self.key_ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(order, -1)
        self.classes = self._classes(definition)
        self.special = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    @staticmethod
    def _classes(definition: str) -> np.ndarray:
        """Class of every code point, read off the pre-tokenizer of the file: it parts
        the text of all characters where the class changes, and one character of each
        part is tried between two of a known class."""
        from tokenizers import Tokenizer

        cut = Tokenizer.from_str(definition).pre_tokenizer.pre_tokenize_str

        def kind(c: str) -> int:
            for k, probe in ((LETTER, "x"), (NUMBER, "1"), (OTHER, "!")):
                if len(cut(probe + c + probe)) == 1:
                    return k
            return SPACE

        out = np.full(0x110000, OTHER, np.uint8)
        out[:128] = [kind(chr(c)) for c in range(128)]
        points = [*range(0x80, 0xD800), *range(0xE000, 0x110000)]
        every = "".join(map(chr, points))
        for _, (a, b) in cut(every):
            out[points[a : b]] = kind(every[a])
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if no merge takes it."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.key_ranks[at], -1)

    def pieces(self, buf: np.ndarray, offsets: np.ndarray):
        """Byte starts of the pre-tokens of a block, and the (start, end, id) of the
        added tokens in it. ``offsets`` are the texts' ends in the block."""
        edges, added = offsets[:-1], []
        raw = buf.tobytes()
        if self.special and self.special.search(raw):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                added += [(a + m.start(), a + m.end(), self.added[m.group()]) for m in self.special.finditer(raw[a:b])]
            edges = np.unique(np.concatenate([edges, *(np.array(x[:2], np.int64) for x in added)])) if added else edges
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(points)
        if not n:
            return np.zeros(0, np.int64), added
        place = np.flatnonzero((buf & 0xC0) != 0x80) if n < len(buf) else np.arange(n)
        kind = self.classes[points]
        edge = np.zeros(n + 4, bool)  # texts begin here; the tail counts as a text after the last
        edge[np.searchsorted(place, edges[edges < len(buf)])] = True
        edge[n:] = True
        start = edge[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # white space before something: its last character stands apart or, a plain space, joins
        after = np.flatnonzero(start[1:] & ~edge[1:n] & (kind[:-1] == SPACE)) + 1
        start[after - 1] = True
        start[after[points[after - 1] == 0x20]] = False
        # an apostrophe that begins a pre-token takes an ending with it
        quote = np.flatnonzero((points == 0x27) & start)
        if len(quote):
            padded = np.append(points, np.zeros(3, np.uint32))
            for ending in ENDINGS:
                hit = quote
                for k, c in enumerate(ending, 1):
                    hit = hit[(padded[hit + k] == ord(c)) & ~edge[hit + k]]
                start[hit + 1] = False
                stop = hit + 1 + len(ending)
                start[stop[stop < n]] = True
        cuts = place[start]
        if added:
            inside = np.zeros(len(cuts), bool)
            for a, b, _ in added:
                inside |= (cuts > a) & (cuts < b)
            cuts = cuts[~inside]
        return cuts, added

    def merge(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that begin at ``starts`` in ``data``, one word after the
        other, and the number of ids of each."""
        n = len(data)
        symbol = np.append(self.byte_ids[data], np.int32(-2))
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[np.append(starts[1:], n) - 1] = n  # the place n stands for no neighbour
        before[starts] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Enter the places where a pair begins into the lists of their pairs."""
            rank = self.ranks(symbol[at], symbol[after[at]])
            found = rank >= 0
            at, rank = at[found], rank[found]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            lo = 0
            for r, hi in zip(rank[np.append(0, cut)].tolist(), [*cut.tolist(), len(at)]):
                places = index.get(r)
                if places is None:
                    index[r] = [at[lo:hi]]
                    heapq.heappush(active, r)
                else:
                    places.append(at[lo:hi])
                lo = hi

        note(np.flatnonzero(after[:n] != n).astype(np.int32))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            a, b = self.left[r], self.right[r]
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
            if a == b and len(at) > 1:  # every other place of a run, from its left end
                head = np.ones(len(at), bool)
                head[1:] = after[at[:-1]] != at[1:]
                spot = np.arange(len(at))
                at = at[(spot - np.maximum.accumulate(np.where(head, spot, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = self.new[r]
            symbol[gone] = -1
            follow = after[gone]
            after[at] = follow
            before[follow] = at
            back = before[at]
            note(np.concatenate([back[back != n], at[follow != n]]))
        kept = np.flatnonzero(symbol[:n] >= 0)
        return symbol[kept].astype(np.uint32), np.diff(np.append(np.searchsorted(kept, starts), len(kept)))

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the tokens one after the other, and how many each id gives."""
        ids = ids.astype(np.int64)
        known = ids < self.size
        ids = np.where(known, ids, 0)
        counts = np.where(known, self.lengths[ids], 0)
        return self.spelled[ranges(self.starts[ids], counts)], counts


class Words:
    """Encoded pre-tokens by hash: hashes in order, and the ids of each."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] != hashes

    def add(self, hashes: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        first = np.cumsum(count) - count + len(self.ids)
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.ids = np.concatenate([self.ids, ids])


def encode_group(v: Vocabulary, words: Words, group: list, merge) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, number of ids of each text) of the blocks of a group: pre-tokens that
    ``words`` lacks are encoded together by ``merge`` and kept in it."""
    cut, new_hashes, new_bytes, new_sizes = [], [], [], []
    for buf, offsets in group:
        starts, added = v.pieces(buf, offsets)
        ends = np.append(starts[1:], len(buf))
        hashes = span_hashes(buf, starts, ends, False) if len(starts) else np.zeros(0, np.uint64)
        distinct, one, spot = np.unique(hashes, return_index=True, return_inverse=True)
        cut.append((distinct, spot.astype(np.int32), np.searchsorted(starts, offsets), starts, added))
        lack = words.missing(distinct)
        one = one[lack]
        new_hashes.append(distinct[lack])
        new_sizes.append(ends[one] - starts[one])
        new_bytes.append(buf[ranges(starts[one], new_sizes[-1])])
        if not added:
            cut[-1] = (*cut[-1][:3], None, added)
    hashes, sizes, data = map(np.concatenate, (new_hashes, new_sizes, new_bytes))
    hashes, one = np.unique(hashes, return_index=True)
    begin = (np.cumsum(sizes) - sizes)[one]
    sizes = sizes[one]
    if len(hashes):
        words.add(hashes, *merge(data[ranges(begin, sizes)], np.cumsum(sizes) - sizes))
    out = []
    for distinct, spot, first, starts, added in cut:
        at = np.searchsorted(words.hashes, distinct)[spot]
        begin, count = words.first[at], words.count[at]
        ids = words.ids
        if added:  # their ids, behind the words'
            where = np.searchsorted(starts, [x[0] for x in added])
            begin[where], count[where] = len(ids) + np.arange(len(added)), 1
            ids = np.concatenate([ids, np.array([x[2] for x in added], np.uint32)])
        total = np.append(0, np.cumsum(count))
        out.append((ids[ranges(begin, count)], np.diff(total[first])))
    return out


class Codec:
    """A vocabulary with the words that the worker has encoded so far, which stay behind
    when the codec travels."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self._words = vocabulary, Words()

    def __reduce__(self):
        return Codec, (self.vocabulary,)

    def encode_group(self, group: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, number of ids of each text) of the blocks of a group."""
        if len(self._words.hashes) > KEPT_WORDS:
            self._words = Words()
        return encode_group(self.vocabulary, self._words, group, self.vocabulary.merge)

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The decoded text of each row, in UTF-8."""
        spelled, sizes = self.vocabulary.spell(ids)
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))].tolist()
        raw = spelled.tobytes()
        return [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends, ends[1:])]


def _binary(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of ``counts`` items each, as binary values without a copy per row."""
    edges = np.append(0, np.cumsum(counts)) * data.itemsize
    kind, offsets = (pa.binary(), edges.astype(np.int32)) if edges[-1] < 1 << 31 else (pa.large_binary(), edges)
    return pa.Array.from_buffers(kind, len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _encode(codec, with_text: bool):
    def emit(group, doc_ids):
        for own, (ids, counts) in zip(doc_ids, codec.value.encode_group(group)):
            columns = [own, pa.array(counts, pa.int64()), _binary(ids.astype("<u4"), counts)]
            names = ["doc_id", "n_tokens", "ids"]
            if with_text:
                columns.append(pa.array(codec.value.texts(ids, counts), pa.binary()).cast(pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        group, doc_ids, held = [], [], 0
        for batch in batches:
            for i, j, buf, offsets in text_blocks(batch, "text"):
                group.append((buf, offsets))
                doc_ids.append(batch.column("doc_id").slice(i, j - i))
                held += len(buf)
                if held >= GROUP_BYTES:
                    yield from emit(group, doc_ids)
                    group, doc_ids, held = [], [], 0
        if group:
            yield from emit(group, doc_ids)

    return run


def _decode(codec):
    def run(batches):
        for batch in batches:
            for i, j, buf, offsets in text_blocks(batch, "ids"):
                counts = np.diff(offsets) // 4
                size = counts * 4  # a value of another length ends with a part of an id, which is left out
                ids = np.ascontiguousarray(buf[ranges(offsets[:-1], size)]).view("<u4")
                texts = pa.array(codec.value.texts(ids, counts), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), texts], names=["doc_id", "text"])

    return run


def _codec(docs: DataFrame, tokenizer_path: str):
    with open(tokenizer_path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(Codec(Vocabulary(f.read())))  # one fixed file: bounded


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text")


def encode(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) of every row."""
    run = _encode(_codec(docs, tokenizer_path), False)
    return _texts(docs, doc_id, text).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` of rows of ids as ``encode`` returns them; null ids: empty."""
    own = encoded.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"`{ids}` AS ids")
    return own.mapInArrow(_decode(_codec(encoded, tokenizer_path)), "doc_id bigint, text string")


def encode_and_decode(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` with the text that the ids decode to (``decoded``), in one pass."""
    run = _encode(_codec(docs, tokenizer_path), True)
    return _texts(docs, doc_id, text).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded string")
