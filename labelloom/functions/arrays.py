"""Expressions over token lists and logit vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(logits: Column | str) -> Column:
    """0-based position of the largest entry; the first one wins a tie and
    NaN counts as largest, as in numpy."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def truncate(tokens: Column | str, max_length: int) -> Column:
    return F.slice(tokens, 1, max_length)


def cross_entropy(logits: Column | str, label: Column | str) -> Column:
    """Negative log-likelihood of ``label`` under softmax(``logits``), in
    double precision and shifted by the maximum so that it cannot overflow."""
    column = F.col(logits) if isinstance(logits, str) else logits
    label = F.col(label) if isinstance(label, str) else label
    values = column.cast("array<double>")
    top = F.array_max(values)
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return F.log(total) + top - F.get(values, label.cast("int"))


def pad(tokens: Column | str, length: Column, fill: Column, side: str = "right") -> Column:
    """Fill ``tokens`` up to ``length`` entries on the given side."""
    if side not in ("left", "right"):
        raise ValueError(f"padding side must be 'left' or 'right', not {side!r}")
    column = F.col(tokens) if isinstance(tokens, str) else tokens
    missing = F.greatest(length - F.size(column), F.lit(0)).cast("int")
    filler = F.array_repeat(fill, missing)
    return F.concat(filler, column) if side == "left" else F.concat(column, filler)
