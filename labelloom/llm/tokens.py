"""Token counts by distinct pre-tokens.

A text is cut where no piece of the vocabulary can reach across. Every distinct
pre-token of the corpus is then encoded once, and a document's count is the sum
of its pre-tokens' counts times their frequencies; token ids of whole texts
never exist. The counts of the most frequent pre-tokens, a table of bounded
size, travel to the tasks; the others are joined by shuffle. So a pre-token
that occurs everywhere is no hot key, and the vocabulary may be of any size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import most_frequent, slices
from labelloom.storage import write_table

TOKENIZER_FILE = "piece_bpe_32k.model"
FREQUENT = 200_000
SPACE = "▁"
IRREGULAR = ("  ", " \n", "\n ", SPACE)


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    """A model whose pieces go on neither across the end of a word nor across a
    line feed, so that words can be encoded one by one."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if SPACE in piece.lstrip(SPACE) or ("\n" in piece and len(piece) > 1):
            raise ValueError(f"pieces of this vocabulary reach across words: {piece!r}")
    return model


def pretokens(text: str | None) -> tuple[list[str], list[str], int]:
    """The text cut into words that follow one space, other pre-tokens as they
    stand, and a number of line feeds.

    The text is taken with a space before it, as the tokenizer does. Spaces are
    part of the word behind them, and a line feed is always a piece of its own.
    """
    if not text:
        return [], [], 0
    lines = text.split("\n")
    if text[0] == " " or text[-1] == " " or any(x in text for x in IRREGULAR):
        found = []
        for i, line in enumerate(lines):
            marked = ("" if i else SPACE) + line.replace(" ", SPACE)
            start = 0
            for end in range(1, len(marked)):
                if marked[end] == SPACE and marked[end - 1] != SPACE:
                    found.append(marked[start:end])
                    start = end
            if marked:
                found.append(marked[start:])
        return [], found, len(lines) - 1
    spaced, others = lines[0].split(" "), []
    for line in lines[1:]:
        if line:
            words = line.split(" ")
            others.append(words[0])
            spaced += words[1:]
    return spaced, others, len(lines) - 1


def piece_counter(model) -> Callable[[list[str]], list[int]]:
    """Numbers of pieces of pre-tokens, in place within a text."""
    # A line break is a byte of its own: what stands before it can't merge with what follows.
    lead = len(model.encode("\n"))

    def count(pretokens: list[str]) -> list[int]:
        encoded = model.encode(["\n" + p for p in pretokens], num_threads=1)
        return [len(ids) - lead for ids in encoded]

    return count


def pretoken_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(pretoken, n)``: all distinct pre-tokens of the texts with their frequency."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, text_col, 20_000_000):
            spaced, seen = Counter(), Counter()
            for text in frame[text_col]:
                words, others, _ = pretokens(text)
                spaced.update(words)
                seen.update(others)
            names = [SPACE + w for w in spaced] + list(seen)
            if names:
                yield pd.DataFrame({"pretoken": names, "n": [*spaced.values(), *seen.values()]})

    texts = docs.select(text_col)
    return texts.mapInPandas(count, "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))


def count_tokens(
    docs: DataFrame,
    path: str,
    frequent: int = FREQUENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_bytes, n_tokens)`` for every row of ``docs``.

    Null and empty texts have no tokens. Ids may repeat or be null: each row
    is counted on its own. ``frequent`` bounds the table that the tasks hold;
    it changes no count.
    """

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = piece_counter(load_tokenizer(path))
        for frame in frames:
            yield frame.assign(pieces=count(frame["pretoken"].tolist()))

    vocabulary = write_table(
        pretoken_counts(docs, text_col).mapInPandas(encode, "pretoken string, n long, pieces int"),
        "pretokens",
    )
    # Bounded by ``frequent``.
    top = most_frequent(vocabulary, "n", frequent).select("pretoken", "pieces").toPandas()
    known = docs.sparkSession.sparkContext.broadcast(
        dict(zip(top["pretoken"].tolist(), top["pieces"].tolist(), strict=True))
    )

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = known.value
        after_space = {k[1:]: n for k, n in pieces.items() if k[0] == SPACE and SPACE not in k[1:]}
        line_feed = piece_counter(load_tokenizer(path))(["\n"])[0]
        for frame in slices(frames, text_col):
            sums, rare = [], []
            for text in frame[text_col]:
                words, others, feeds = pretokens(text)
                counts = list(map(after_space.get, words))
                more = list(map(pieces.get, others))
                unknown = Counter([SPACE + w for w, n in zip(words, counts, strict=True) if n is None])
                unknown.update([w for w, n in zip(others, more, strict=True) if n is None])
                sums.append(sum(filter(None, counts)) + sum(filter(None, more)) + feeds * line_feed)
                rare.append([{"pretoken": p, "n": n} for p, n in unknown.items()])
            yield pd.DataFrame({id_col: frame[id_col], "n_bytes": frame["n_bytes"], "frequent_tokens": sums, "rare": rare})

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_bytes long, frequent_tokens long, rare array<struct<pretoken:string,n:long>>"
    parts = write_table(
        docs.select(id_col, text_col, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
        .mapInPandas(split, schema)
        .withColumn("uid", F.monotonically_increasing_id()),
        "document_pretokens",
    )
    others = (
        parts.select("uid", F.inline("rare"))
        .join(vocabulary.select("pretoken", "pieces"), "pretoken")
        .groupBy("uid")
        .agg(F.sum(F.col("n") * F.col("pieces")).alias("rare_tokens"))
    )
    return parts.drop("rare").join(others, "uid", "left").select(
        id_col,
        "n_bytes",
        (F.col("frequent_tokens") + F.coalesce("rare_tokens", F.lit(0))).alias("n_tokens"),
    )
