"""Property test: the column-expression validator agrees with a plain Python
model of the rules on random lines built from adversarial tokens."""

from __future__ import annotations

import math
import random
import re

import pytest

from tillroll.sources.lines import TRANSACTION_SPEC, parse_lines

# The JVM's accepted floating-point text (Double.valueOf grammar, after trim).
_DIGITS = r"(\d+)"
_EXP = r"([eE][+-]?\d+)"
_DEC = rf"((({_DIGITS}\.?({_DIGITS})?{_EXP}?)|(\.{_DIGITS}{_EXP}?))[fFdD]?)"
_HEX_DIGITS = r"([0-9a-fA-F]+)"
_HEX = rf"((0[xX]{_HEX_DIGITS}?(\.)?{_HEX_DIGITS}?[pP][+-]?\d+)[fFdD]?)"
_JVM_NUMBER = re.compile(rf"[+-]?(NaN|Infinity|{_DEC}|{_HEX})")


def jvm_to_double(text: str) -> float | None:
    if not _JVM_NUMBER.fullmatch(text):
        return None
    body = text.rstrip("fFdD") if not text.lstrip("+-").startswith(("NaN", "Infinity")) else text
    sign = -1.0 if body.startswith("-") else 1.0
    core = body.lstrip("+-")
    if core == "NaN":
        return math.nan
    if core == "Infinity":
        return sign * math.inf
    if core[:2] in ("0x", "0X"):
        mant, _, exp = core[2:].partition("p") if "p" in core else core[2:].partition("P")
        if not mant.replace(".", ""):
            return None
        return sign * float.fromhex(f"0x{mant if mant != '.' else '0'}p{exp}")
    return sign * float(core)


def jvm_trim(text: str) -> str:
    i, j = 0, len(text)
    while i < j and ord(text[i]) <= 0x20:
        i += 1
    while j > i and ord(text[j - 1]) <= 0x20:
        j -= 1
    return text[i:j]


def model(line: str):
    """(error_kind, reason, quantity, unit_price) by the rules."""
    fields = [jvm_trim(f) for f in line.split(",")]
    if len(fields) != 7:
        return ("WrongFieldCount", f"expected 7 fields but found {len(fields)}", None, None)
    numbers = {}
    for i, f in enumerate(TRANSACTION_SPEC.fields):
        v = fields[i]
        if f.kind == "text":
            if v == "":
                return ("MissingField", f"field {f.label} is empty", None, None)
        else:
            d = jvm_to_double(v)
            if d is None:
                return ("NotANumber", f"field {f.label} is not a number: '{v}'", None, None)
            if d <= 0.0:
                return ("OutOfRange", f"field {f.label} is out of range: '{v}'", None, None)
            numbers[i] = d
    q = numbers[3]
    quantity = 0 if math.isnan(q) else int(min(q, 2147483647.0))
    return (None, None, quantity, numbers[4])


NUMBER_TOKENS = [
    "1", "3", "0", "-2", "3.9", "0.5", ".5", "5.", "1e3", "1E-2", "1e", "e5", "1d", "2.5f", "7D",
    "0x1p3", "0X1.8P1", "0x", "NaN", "nan", "-NaN", "Infinity", "-Infinity", "+Infinity", "inf",
    "INF", "infinity", "+1", "1_0", "abc", "N/A", "", "1e999", "1e-999", "00012", "+.5e1",
]
TEXT_TOKENS = ["T1", "C00042", "P7", "Israel", "2024-03-11", "", "x y", "orderIdX"]
PADS = ["", " ", "\t", "\x00", "\x1f", "  \t"]


def random_lines(seed: int, count: int) -> list[str]:
    rnd = random.Random(seed)

    def padded(tokens):
        return rnd.choice(PADS) + rnd.choice(tokens) + rnd.choice(PADS)

    out = []
    for _ in range(count):
        if rnd.random() < 0.8:
            parts = [padded(TEXT_TOKENS) for _ in range(3)] + [padded(NUMBER_TOKENS), padded(NUMBER_TOKENS)]
            parts += [padded(TEXT_TOKENS), padded(TEXT_TOKENS)]
        else:
            parts = [padded(rnd.choice([TEXT_TOKENS, NUMBER_TOKENS])) for _ in range(rnd.randint(1, 9))]
        out.append(",".join(parts))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_validator_matches_model(spark, seed):
    lines = random_lines(seed, 3000)
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = parse_lines(df).collect()
    assert len(got) == len(lines)
    for text, r in zip(lines, got):
        kind, reason, quantity, price = model(text)
        assert r.line == text
        assert (r.error_kind, r.reason) == (kind, reason), repr(text)
        if kind is None:
            assert r.quantity == quantity, repr(text)
            assert (math.isnan(price) and math.isnan(r.unit_price)) or r.unit_price == price, repr(text)


def test_model_matches_documented_examples():
    assert jvm_to_double("1d") == 1.0 and jvm_to_double("0x1p3") == 8.0
    assert jvm_to_double("inf") is None and jvm_to_double("1_0") is None
    assert math.isnan(jvm_to_double("NaN")) and jvm_to_double("-Infinity") == -math.inf
