"""Screening of questions and answers: rule tables, redaction, disclaimers.

Rules are data. Everything is a column expression of built-in functions; flags
are kept in an array column. The rules are this library's own conventions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind and pattern, in the order in which they are applied.
PII_RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"),
    ("card", r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"),
    ("phone", r"\+?[0-9]{1,3}[ -][0-9]{3}[ -][0-9]{3,4}[ -]?[0-9]{0,4}\b"),
)
FORMAT_RULES = (
    ("account", r"\b[0-9]{8,17}\b"),
    ("dosage", r"\b[0-9]+ ?(mg|ml|mcg)\b"),
    ("percent", r"\b[0-9]+([.,][0-9]+)? ?%"),
    ("hex_key", r"\b[0-9a-f]{32,}\b"),
)
BLOCKLIST = ("idiot", "clown", "worthless", "you are an idiot")
_HAS_PII = "__answer_has_pii"
NO_LETTER = r"[^\p{L}\p{N}]+"


def redact(text: Column | str, rules: Sequence[tuple[str, str]] = PII_RULES) -> Column:
    """The text with every match replaced by its kind in brackets."""
    out = F.col(text) if isinstance(text, str) else text
    for kind, pattern in rules:
        out = F.regexp_replace(out, pattern, f"[{kind}]")
    return out


def has_pii(text: Column | str, rules: Sequence[tuple[str, str]] = PII_RULES) -> Column:
    """Whether ``redact`` changes the text: it does exactly if some rule matches
    the text as it is, since the first rule to match finds it unchanged."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.lit(False)
    for _, pattern in rules:
        found = found | text.rlike(pattern)
    return found


def pii_counts(df: DataFrame, text_col: str = "text", rules: Sequence[tuple[str, str]] = PII_RULES) -> DataFrame:
    """``df`` with ``n_<kind>``, each counted in what the rules before it left,
    and ``redacted``. A null text has no matches and stays null."""
    left, counts = F.coalesce(F.col(text_col), F.lit("")), {}
    for kind, pattern in rules:
        counts[f"n_{kind}"] = F.regexp_count(left, F.lit(pattern)).cast("long")
        left = F.regexp_replace(left, pattern, f"[{kind}]")
    return df.withColumns(counts | {"redacted": redact(text_col, rules)})


def blocklist_hits(text: Column | str, phrases: Sequence[str] = BLOCKLIST) -> Column:
    """The phrases that stand in the text as whole words, in list order; case,
    marks and spacing don't count. Null gives no hits."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), NO_LETTER, " "), F.lit(" "))
    return F.array_compact(F.array(*[F.when(words.contains(f" {p} "), F.lit(p)) for p in phrases]))


def rule_hits(text: Column | str, rules: Sequence[tuple[str, str]] = FORMAT_RULES) -> Column:
    """Names of the rules whose pattern is found."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(name)) for name, p in rules]))


def with_disclaimer(
    df: DataFrame, disclaimers: Mapping[str, str], domain_col: str = "domain", text_col: str = "text"
) -> DataFrame:
    """``text`` with its domain's disclaimer put at the end, unless it is there
    already. ``disclaimers`` is a few entries of configuration, written into the
    plan; domains that it lacks need none. No column is added, so ``df`` may have
    any names. A null text stays null."""
    text = F.col(text_col)
    out = text
    for domain, disclaimer in disclaimers.items():
        needed = (F.col(domain_col) == domain) & ~text.contains(disclaimer)
        out = F.when(needed, F.concat(text, F.lit("\n"), F.lit(disclaimer))).otherwise(out)
    return df.withColumn(text_col, out)


def guardrail_chain(
    df: DataFrame,
    disclaimers: Mapping[str, str],
    question_col: str = "question",
    answer_col: str = "answer",
    domain_col: str = "domain",
) -> DataFrame:
    """Input screen, output format and disclaimer, output screen, in this order.

    Adds ``flags``, such as ``input:blocklist`` or ``output:pii``. A blocked
    question gets no answer; answers are redacted. Every rule looks at a text
    once, and only texts with a match are rewritten.
    """
    blocked = F.size(blocklist_hits(question_col)) > 0
    asked_pii = has_pii(question_col)
    screened = df.withColumns(
        {
            "flags": F.array_compact(
                F.array(F.when(blocked, F.lit("input:blocklist")), F.when(asked_pii, F.lit("input:pii")))
            ),
            answer_col: F.when(~blocked, F.col(answer_col)),
        }
    )
    formatted = with_disclaimer(screened, disclaimers, domain_col, answer_col)
    formatted = formatted.withColumn(_HAS_PII, has_pii(answer_col))
    found = F.array_compact(
        F.array(
            F.when(F.col(_HAS_PII), F.lit("output:pii")),
            F.when(F.size(blocklist_hits(answer_col)) > 0, F.lit("output:blocklist")),
            F.when(F.size(rule_hits(answer_col)) > 0, F.lit("output:format")),
        )
    )
    clean = F.when(F.col(_HAS_PII), redact(answer_col)).otherwise(F.col(answer_col))
    return formatted.withColumns({"flags": F.concat("flags", found), answer_col: clean}).drop(_HAS_PII)
