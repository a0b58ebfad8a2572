"""Quality rules as a bitmask ledger, in DataFrame / SQL functions only.

Every rule is evaluated once per text: its measurement becomes a column and its
failure one bit of ``fail_bits``. A policy is a named, versioned mask of rules;
applying one, or comparing many, only reads the bits. Ablations count the
distinct bit patterns once (partial aggregation: at most ``2 ** rules`` groups)
and test masks against that small table.

Defined results: a null text has no words, all counts 0 and fails ``few_words``;
an empty text likewise; repeated rows are judged one by one; an empty table gives
an empty ledger. Extra columns are kept, those whose names clash with the
ledger's own (see ``MEASURES``) are replaced by the ledger's.
Windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_ascii_letters",
    "n_echo_words",
)


@dataclass(frozen=True)
class Rule:
    """A rule: its bit, its name and the SQL condition under which a text fails."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 30 * n_words"),
    Rule(3, "short_words", "word_chars < 2 * n_words"),
    Rule(4, "long_words", "word_chars > 20 * n_words"),
    Rule(5, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(6, "upper_case", "2 * n_upper > n_ascii_letters AND n_ascii_letters > 0"),
    Rule(7, "echoed_words", "100 * n_echo_words > 30 * n_words"),
)


def mask_of(*names: str) -> int:
    """The mask of the named rules."""
    bits = {r.name: 1 << r.bit for r in RULES}
    return sum(bits[n] for n in names)


BASE_MASK = mask_of("few_words", "repeated_words")
POLICIES = {
    "base/1": BASE_MASK,
    "strict/1": sum(1 << r.bit for r in RULES),
}
DEFAULT_POLICY = "strict/1"


def _measured(df: DataFrame, text: str) -> DataFrame:
    """Add the measurement columns; each text is split into words once."""
    df = df.drop(*[c for c in df.columns if c in MEASURES])
    t = f"coalesce(`{text}`, '')"
    staged = df.selectExpr(
        "*",
        f"split(trim(BOTH ' \\t\\n\\u000b\\f\\r' FROM {t}), '[ \\\\t-\\\\r]+') AS __w",
        f"filter(split({t}, '\\n'), l -> l RLIKE '[^ \\\\t-\\\\r]') AS __l",
        f"CAST(regexp_count({t}, '[#*$%&|<>]') AS BIGINT) AS n_symbols",
        f"CAST(regexp_count({t}, '[A-Z]') AS BIGINT) AS n_upper",
        f"CAST(regexp_count({t}, '[A-Za-z]') AS BIGINT) AS n_ascii_letters",
    )
    windows = ", ".join(f"__w[i + {k}]" for k in range(WINDOW_WORDS))
    staged = staged.selectExpr(
        "*",
        "CAST(IF(__w[0] = '', 0, size(__w)) AS BIGINT) AS n_words",
        "CAST(char_length(array_join(__w, '')) AS BIGINT) AS word_chars",
        "CAST(size(__l) AS BIGINT) AS n_lines",
        "CAST(size(__l) - size(array_distinct(__l)) AS BIGINT) AS n_dup_lines",
        "CAST(size(filter(__w, (x, i) -> i > 0 AND x = __w[i - 1])) AS BIGINT) AS n_echo_words",
        f"IF(size(__w) > {WINDOW_WORDS}, transform(sequence(0, size(__w) - {WINDOW_WORDS}), i -> xxhash64({windows})), "
        "CAST(array() AS ARRAY<BIGINT>)) AS __h",
    ).drop("__w", "__l")
    # texts with a window that occurs twice: sort (hash, position), keep equal neighbours
    staged = staged.selectExpr(
        "*",
        "IF(size(array_distinct(__h)) < size(__h), "
        "sort_array(transform(__h, (h, i) -> named_struct('h', h, 'i', i))), "
        "CAST(array() AS ARRAY<STRUCT<h: BIGINT, i: INT>>)) AS __s",
    ).drop("__h")
    staged = staged.selectExpr(
        "*",
        "sort_array(transform(filter(transform(__s, (x, j) -> named_struct('i', x.i, 'd', "
        "(j > 0 AND x.h = get(__s, j - 1).h) OR coalesce(x.h = get(__s, j + 1).h, false))), "
        "y -> y.d), y -> y.i)) AS __p",
    ).drop("__s")
    return staged.selectExpr(
        "*",
        f"aggregate(__p, named_struct('n', 0L, 'e', 0L), (a, p) -> named_struct("
        f"'n', a.n + p + {WINDOW_WORDS}L - greatest(a.e, CAST(p AS BIGINT)), 'e', p + {WINDOW_WORDS}L), a -> a.n) "
        "AS n_repeat_words",
    ).drop("__p")


def quality_ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the measurements and ``fail_bits`` (one bit per failed rule)."""
    bits = " | ".join(f"IF({r.fails}, {1 << r.bit}L, 0L)" for r in RULES)
    own = [c for c in df.columns if c not in MEASURES and c != "fail_bits"]
    fields = ", ".join(f"'{m}', {m}" for m in MEASURES)
    # a one-row generator: filters on the ledger stay above it, instead of being
    # pushed down with every measurement's expression copied into them
    return _measured(df.drop("fail_bits"), text).selectExpr(
        *[f"`{c}`" for c in own], f"inline(array(named_struct({fields}, 'fail_bits', {bits})))"
    )


def apply_policy(ledger: DataFrame, policy: str = DEFAULT_POLICY, column: str = "kept") -> DataFrame:
    """Add ``column``: true where no rule of the policy failed."""
    return ledger.withColumn(column, F.expr(f"(fail_bits & {POLICIES[policy]}L) = 0"))


def ablations(ledger: DataFrame) -> DataFrame:
    """For each policy and rule: texts the policy rejects, texts only this rule
    rejects (they would return without it) and texts the rule fails at all."""
    patterns = ledger.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cases = ", ".join(
        f"named_struct('policy', '{p}', 'rule', '{r.name}', 'mask', {m}L, 'bit', {1 << r.bit}L)"
        for p, m in POLICIES.items()
        for r in RULES
        if m >> r.bit & 1
    )
    return (
        patterns.selectExpr("fail_bits", "n", f"inline(array({cases}))")
        .groupBy("policy", "rule")
        .agg(
            F.expr("sum(IF((fail_bits & mask) <> 0, n, 0L))").alias("rejected"),
            F.expr("sum(IF((fail_bits & mask) = bit, n, 0L))").alias("only_this_rule"),
            F.expr("sum(IF((fail_bits & bit) <> 0, n, 0L))").alias("failed_rule"),
        )
    )


def keep_quality(df: DataFrame, policy: str = DEFAULT_POLICY, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the policy keeps, with their own columns."""
    judged = quality_ledger(df.selectExpr(f"`{text}` AS __text", "struct(*) AS __row"), "__text")
    return apply_policy(judged, policy).where("kept").select("__row.*")
