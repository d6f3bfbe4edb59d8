"""Steps that make training examples: filters, samples and templates."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.functions.text import compare_key
from labelloom.operators.splitting import assign_split, validation_cutoffs
from labelloom.operators.tokens import TOKEN_PATTERN

SAMPLE_DIGITS = 4


def token_length_filter(df: DataFrame, low: int, high: int, text_col: str = "text") -> DataFrame:
    """Rows of ``low`` to ``high`` tokens, with ``n_tokens``. A null text has none."""
    count = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN_PATTERN)).cast("long")
    return df.withColumn("n_tokens", count).where(F.col("n_tokens").between(low, high))


def sample_exact(df: DataFrame, n: int, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) of unique ids, the first by the md5 of
    seed and id.

    Rows are counted by the hash's first four digits, and only the bucket in
    which the n-th row lies is ranked. That row is one cutoff, and the sample a
    comparison with it: no row is moved, whatever ``n`` is.
    """
    if n < 1:
        return df.limit(0)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    hashed = df.select(F.col(id_col).alias("id"), key.alias("h")).withColumn("bucket", F.substring("h", 1, SAMPLE_DIGITS))
    # At most 16**4 rows reach this window.
    upto = F.sum("count").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    counts = hashed.groupBy("bucket").count().withColumn("upto", upto)
    edge = counts.where((F.col("upto") >= n) & (F.col("upto") - F.col("count") < n)).first()
    if edge is None:
        return df
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("h", "id"))
    need = n - (edge["upto"] - edge["count"])
    last = hashed.where(F.col("bucket") == edge["bucket"]).withColumn("place", place).where(F.col("place") == need).first()
    return df.where((key < last["h"]) | ((key == last["h"]) & (F.col(id_col) <= F.lit(last["id"]))))


def stratified_sample(
    df: DataFrame, share: float, seed: int = 42, label_col: str = "label", id_col: str = "row_id"
) -> DataFrame:
    """A share of each class by largest remainders: the validation side of the
    exact stratified split."""
    named = df.withColumnsRenamed({label_col: "label", id_col: "row_id"})
    cutoffs = validation_cutoffs(named.select("row_id", "label"), share, seed)
    sampled = assign_split(named, cutoffs, seed).where(F.col("split") == "validation").drop("split")
    return sampled.withColumnsRenamed({"label": label_col, "row_id": id_col})


def instruction_text(instruction: Column, context: Column, response: Column) -> Column:
    """The three-part instruction template; a null or blank context leaves its
    section out, a null instruction or response is an empty one."""
    instruction, response = (F.coalesce(c, F.lit("")) for c in (instruction, response))
    has_context = F.length(F.trim(F.coalesce(context, F.lit("")))) > 0
    section = F.when(has_context, F.concat(F.lit("### Input:\n"), context, F.lit("\n\n"))).otherwise(F.lit(""))
    return F.concat(
        F.lit("### Instruction:\n"), instruction, F.lit("\n\n"), section, F.lit("### Response:\n"), response
    )


def format_instruction(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, example)`` for every user turn that the assistant
    answers next; the conversation's system text is the context."""
    system = turns.where("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("context"))
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("asked"))
    answers = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return (
        asked.join(answers, ["conv_id", "turn"])
        .join(system, "conv_id", "left")
        .select("conv_id", "turn", instruction_text(F.col("asked"), F.col("context"), F.col("answer")).alias("example"))
    )


def format_chat(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, chat)``: a conversation as one row, turns in order,
    each between start and end marks. A null text is an empty one, a null role
    ``unknown``. A conversation has to fit one row; it is never cut."""
    listed = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))

    def piece(t: Column) -> Column:
        role, text = F.coalesce(t["role"], F.lit("unknown")), F.coalesce(t["text"], F.lit(""))
        return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))

    return (
        turns.groupBy("conv_id")
        .agg(listed.alias("turns"))
        .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", piece), "").alias("chat"))
    )


def format_by_dataset(
    df: DataFrame,
    formats: Mapping[str, Callable[[Column], Column]],
    default: Callable[[Column], Column] = lambda text: text,
    dataset_col: str = "dataset",
    text_col: str = "text",
) -> DataFrame:
    """``text`` rewritten by the format of the row's dataset; datasets without
    one get ``default``."""
    out = default(F.col(text_col))
    for name, make in formats.items():
        out = F.when(F.col(dataset_col) == name, make(F.col(text_col))).otherwise(out)
    return df.withColumn(text_col, out)


def dedup_by_hash(df: DataFrame, text_col: str = "text", id_col: str = "row_id") -> DataFrame:
    """``(content_hash, row_id, copies)``: the first row of each content. Only
    hashes are shuffled, and they combine before."""
    return (
        df.select(F.sha2(compare_key(text_col), 256).alias("content_hash"), id_col)
        .groupBy("content_hash")
        .agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies"))
    )
