"""Small text helpers shared by the line builders."""

from __future__ import annotations


def zero_padded_sql(expr: str, width: int) -> str:
    """SQL text of ``%0<width>d`` for a non-negative integer expression:
    ``lpad`` to the width, never truncating a longer number (``lpad`` alone
    would cut ``12345`` to ``1234``)."""
    text = f"CAST({expr} AS STRING)"
    return f"(CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {width}, '0') END)"


def sql_text(text: str) -> str:
    """A SQL string literal for ``text`` (unicode escapes for quotes, backslashes
    and control characters, so any text survives the SQL parser)."""
    out = []
    for ch in text:
        if ch in "'\\" or ord(ch) < 0x20 or ord(ch) == 0x7F:
            out.append(f"\\u{ord(ch):04x}")
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def sql_literal(value, sql_type: str) -> str:
    """A typed SQL literal: ``CAST(<value> AS <type>)`` (NULL for None)."""
    if value is None:
        body = "NULL"
    elif isinstance(value, str):
        body = sql_text(value)
    elif isinstance(value, bool):
        body = "true" if value else "false"
    elif isinstance(value, float):
        body = repr(value) + "D" if value == value and value not in (float("inf"), float("-inf")) else f"double('{value}')"
    else:
        body = str(int(value))
    return f"CAST({body} AS {sql_type})"
