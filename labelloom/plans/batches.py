"""Evaluation batches: tokenised, truncated and padded per split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.config import JobConfig
from labelloom.operators.tokens import Tokenizer, pad_batches, tokenize


def evaluation_batches(
    splits: DataFrame,
    config: JobConfig,
    pad_value: int | str = "[PAD]",
    tokenizer: Tokenizer | None = None,
    **override: int | None,
) -> DataFrame:
    """Each evaluation split of the configuration is batched on its own, in row
    order, with the configured length, batch size and padding side. The texts
    are left behind. ``max_length`` may be given in place of the configured
    one; None keeps all tokens."""
    max_length = override.get("max_length", config.max_length)
    wanted = splits.where(F.col("split").isin(list(config.eval_splits)))
    tokens = tokenize(wanted, max_length, tokenizer=tokenizer).select("row_id", "split", "input_ids", "labels")
    return pad_batches(tokens, config.eval_batch_size, pad_value, config.padding_side, group_col="split")
