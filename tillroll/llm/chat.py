"""Chat formatting with typed content parts.

A turn holds text or an ordered list of typed parts (text, image, audio,
document). A visitor flattens the parts: text is escaped, every other part
becomes a placeholder, and its reference with the token count it expands to is
recorded in order. The template marks turns with control strings; a control
string inside a text gets a backslash after its first character (one more if it
has some already), which undoes itself when read back.

A turn's segment depends on that turn alone, so formatting is a narrow pass over
all rows. Only reading a conversation back needs its order: rows are dealt by
conversation, sorted inside the partitions and streamed, holding one turn at a
time, so a conversation of any length fits.

Defined results: a null text or role is empty; turns with equal numbers are
ordered by their segment; repeated rows are repeated turns; a null conversation id
is a conversation of its own; an empty table gives an empty result. Extra columns
are ignored. A part of an unknown type stands as its text (escaped) and is recorded, if
it has a reference, as an attachment of that type without a placeholder and of no
tokens; a size or length that is missing, not above zero, not finite or not below
``MOST`` counts as the least one.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|turn|>", "<|says|>", "<|done|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# fixed values: control strings of this template and of common chat templates
CONTROL = (
    OPEN, MIDDLE, CLOSE, *PLACEHOLDER.values(), "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
    "<s>", "</s>", "[INST]", "[/INST]",
)
_REST = "|".join(re.escape(c[1:]) for c in CONTROL)
_ESCAPE = re.compile(rf"([<\[])(\\*)({_REST})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_REST})")

IMAGE_PATCH = 28  # pixels of a square patch that becomes one token
AUDIO_TOKENS_A_SECOND = 25
DOCUMENT_TOKENS_A_PAGE = 512
MOST = float(1 << 31)

PARTS_TYPE = (
    "array<struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"
)


def escape(text: str) -> str:
    """``text`` without any control string; undone by :func:`unescape`."""
    return _ESCAPE.sub(r"\1\\\2\3", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text) if "\\" in text else text


def _size(value) -> float:
    """A size or length as far as it is one, else 0."""
    return value if value is not None and 0 < value < MOST else 0  # NaN is not below anything


class Visitor:
    """Flattens one turn's parts into a string with placeholders."""

    def __init__(self):
        self.out: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part):
        self.out.append(escape(part.get("text") or ""))

    def visit_image(self, part):
        side = [math.ceil((_size(part.get(k)) or 1) / IMAGE_PATCH) for k in ("width", "height")]
        self._attach(part, "image", side[0] * side[1])

    def visit_audio(self, part):
        self._attach(part, "audio", max(1, math.ceil(_size(part.get("seconds")) * AUDIO_TOKENS_A_SECOND)))

    def visit_document(self, part):
        self._attach(part, "document", max(1, math.ceil(_size(part.get("pages")))) * DOCUMENT_TOKENS_A_PAGE)

    def visit_unknown(self, part):
        self.visit_text(part)
        if part.get("ref") is not None:
            self._record(part, part.get("type"), 0)

    def _record(self, part, kind, tokens):
        self.attachments.append({"position": len(self.attachments), "type": kind, "ref": part.get("ref"), "tokens": tokens})

    def _attach(self, part, kind, tokens):
        self._record(part, kind, tokens)
        self.out.append(PLACEHOLDER[kind])


def format_turn(role: str | None, content) -> tuple[str, int, int, list[dict]]:
    """(segment, start and end of the content in it, attachments) of one turn;
    ``content`` is a text or a list of parts."""
    visitor = Visitor()
    for part in content if isinstance(content, list) else [{"type": "text", "text": content}]:
        if part is not None:
            visitor.visit(part)
    head = f"{OPEN}{escape(role or '')}{MIDDLE}"
    body = "".join(visitor.out)
    return f"{head}{body}{CLOSE}", len(head), len(head) + len(body), visitor.attachments


def parse_segment(segment: str) -> tuple[str, str, int]:
    """(role, escaped content, start of the content) of a segment."""
    middle = segment.index(MIDDLE)
    if not segment.startswith(OPEN) or not segment.endswith(CLOSE):
        raise ValueError("not a turn")
    start = middle + len(MIDDLE)
    return unescape(segment[len(OPEN) : middle]), segment[start : -len(CLOSE)], start


_ATTACHMENT = pa.struct([("position", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])


def _format(learned: frozenset[str]):
    def run(batches):
        for batch in batches:
            out = [format_turn(r, c) for r, c in zip(batch.column("role").to_pylist(), batch.column("content").to_pylist())]
            loss = [[s, e] if (r or "") in learned else []
                    for r, (_, s, e, _) in zip(batch.column("role").to_pylist(), out)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array([x[0] for x in out], pa.string()),
                 pa.array(loss, pa.list_(pa.int32())), pa.array([x[3] for x in out], pa.list_(_ATTACHMENT)),
                 pa.array([sum(a["tokens"] for a in x[3]) for x in out], pa.int64())],
                names=["conv_id", "turn", "segment", "loss_span", "attachments", "expanded_tokens"],
            )

    return run


def format_conversations(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         content: str = "text", learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One formatted segment per turn; a conversation is its segments in order.

    Columns: ``conv_id, turn, segment, loss_span`` (code points of the segment under
    the loss mask: start and end, or empty), ``attachments``, ``expanded_tokens``.
    ``content`` is a string column or one of type ``PARTS_TYPE``.
    """
    source = turns.selectExpr(f"`{conv_id}` AS conv_id", f"`{turn}` AS turn", f"`{role}` AS role", f"`{content}` AS content")
    kinds = dict(source.dtypes)
    return source.mapInArrow(
        _format(frozenset(learned)),
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, segment string, loss_span array<int>, "
        "attachments array<struct<position: int, type: string, ref: string, tokens: bigint>>, expanded_tokens bigint",
    )


class _Reader:
    """The running digests of one conversation."""

    def __init__(self, key):
        self.key, self.turns, self.loss, self.chars = key, 0, 0, 0
        self.said, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, span: list[int]) -> None:
        role, body, start = parse_segment(segment)
        self.turns += 1
        self.chars += len(segment)
        self.said.update(f"{role}\n{unescape(body)}\n".encode())
        if span:
            text = unescape(segment[span[0] : span[1]])
            self.loss += len(text)
            self.masked.update(text.encode())

    def row(self):
        return self.key, self.turns, self.said.hexdigest(), self.loss, self.masked.hexdigest(), self.chars


def _read_back(key_type: pa.DataType):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        current = None
        for batch in batches:
            done = []
            for key, segment, span in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_span"))):
                if current is None or current.key != key:
                    if current is not None:
                        done.append(current.row())
                    current = _Reader(key)
                current.add(segment, span)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*done) if done else [[]] * 6, kinds)], names=names)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(current.row(), kinds)], names=names)

    return run


def read_back(segments: DataFrame) -> DataFrame:
    """Parse formatted conversations: turns and loss text as digests, per conversation."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = segments.schema["conv_id"].dataType
    ordered = segments.select("conv_id", "turn", "segment", "loss_span").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "segment")
    return ordered.drop("turn").mapInArrow(
        _read_back(to_arrow_type(kind)),
        f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )


def whole_conversations(segments: DataFrame) -> DataFrame:
    """Each conversation as one string (for conversations that fit a row)."""
    rows = segments.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "segment"))).alias("s"))
    return rows.selectExpr("conv_id", "array_join(s.segment, '') AS formatted")
