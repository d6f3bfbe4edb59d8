"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is a place in a chain with the states bad and good. What a
line and its two neighbours look like speaks for a state, and so does the state
of the line before. Forward and backward sums give each line's probability of
being good; a document's score is their mean, weighted by the lines' lengths.
The field is fitted in numpy on a bounded sample of labelled documents, whose
lines all carry the document's label.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import bounded_sample, release_memory, text_slices, unit_hash
from labelloom.llm.words import find_words

SAMPLE_ROWS = 4_000
EPOCHS = 25
PART = 128  # documents in one pass of the chain
MAX_CELLS = 20_000  # their lines, filled up to the longest
SLICE_CHARS = 500_000

UPPER = range(0x41, 0x5B)
LOWER = range(0x61, 0x7B)
DIGITS = range(0x30, 0x3A)
PLAIN_MARKS = b".,;:'\"()?-"
N_OWN = 13
N_FEATURES = 3 * N_OWN + 4


def line_features(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(features, lengths, lines)``: a row per line of all texts, its length
    in bytes, and the number of lines of each text. Empty and null texts have
    no lines; lines are cut at line feeds and may be empty."""
    words = find_words(texts, lower=False)
    data, n = words.data, len(texts)
    sizes = np.diff(words.text_start)
    breaks = np.flatnonzero(data == 0x0A)
    owner = np.searchsorted(words.text_start, breaks, side="right") - 1
    used = sizes[owner] > 1
    starts = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else breaks
    starts, breaks, owner = starts[used], breaks[used], owner[used]
    lines = np.bincount(owner, minlength=n)
    if not len(starts):
        return np.zeros((0, N_FEATURES)), np.zeros(0), lines
    length = (breaks - starts).astype(np.float64)

    def per_line(mask: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (upto[breaks] - upto[starts]).astype(np.float64)

    kinds = np.zeros(256, dtype=np.uint8)
    kinds[list(UPPER)], kinds[list(LOWER)], kinds[list(DIGITS)] = 1, 2, 3
    kinds[list(PLAIN_MARKS)] = 4
    kinds[[i for i in range(33, 127) if kinds[i] == 0]] = 5
    kind = kinds[data]
    # Accented Latin letters are two bytes, of which the second tells the case.
    second = np.concatenate([[False], data[:-1] == 0xC3])
    kind[second & (data < 0x9F)] = 1
    kind[second & (data > 0x9F)] = 2
    upper, lower, digit, plain, odd = (per_line(kind == k) for k in range(1, 6))
    letters = np.maximum(upper + lower, 1)

    line_of_word = np.searchsorted(starts, words.start, side="right") - 1
    n_words = np.bincount(line_of_word, minlength=len(starts)).astype(np.float64)

    def repeats(back: int) -> np.ndarray:
        if len(words.hash) <= back:
            return np.zeros(len(starts))
        same = (words.hash[back:] == words.hash[:-back]) & (line_of_word[back:] == line_of_word[:-back])
        return np.bincount(line_of_word[back:][same], minlength=len(starts))

    some, chars = np.maximum(n_words, 1), np.maximum(length, 1)
    odd_end = np.bincount(
        line_of_word, weights=(kind[np.maximum(words.end - 1, 0)] == 5).astype(float), minlength=len(starts)
    )
    own = np.column_stack(
        [
            upper / letters,
            digit / chars,
            plain / chars * 5,
            np.minimum(odd / chars * 5, 2),
            repeats(1) / some,
            repeats(2) / some,
            odd_end / some,
            (upper + lower) / chars,
            np.minimum(chars / some / 10, 3),
            np.log1p(length) / 5,
            length == 0,
            n_words == 1,
            kind[np.maximum(breaks - 1, starts)] == 4,
        ]
    )
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    last = np.concatenate([owner[1:] != owner[:-1], [True]])
    before = np.vstack([np.zeros((1, N_OWN)), own[:-1]]) * ~first[:, None]
    after = np.vstack([own[1:], np.zeros((1, N_OWN))]) * ~last[:, None]
    edge = np.column_stack([first, last, first & last, np.ones(len(starts))])
    return np.hstack([own, before, after, edge]), length, lines


@dataclass
class LineField:
    """``weights`` (features, 2) and ``steps`` (2, 2), from state to state."""

    weights: np.ndarray
    steps: np.ndarray
    prior: float  # of documents without a line

    def marginals(self, scores: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For (documents, lines, 2) scores padded to equal lengths: the states'
        probabilities, the summed probabilities of steps, and the log of the
        normaliser of each document."""
        docs, length, _ = scores.shape
        forward = np.zeros_like(scores)
        backward = np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, length):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + self.steps, axis=1) + scores[:, t]
            forward[:, t] = np.where(inside[:, t, None], step, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        pairs = np.zeros((docs, 2, 2))
        for t in range(length - 2, -1, -1):
            onward = scores[:, t + 1] + backward[:, t + 1]
            joint = forward[:, t, :, None] + self.steps + onward[:, None, :]
            step = np.logaddexp.reduce(self.steps + onward[:, None, :], axis=2)
            on = inside[:, t + 1]
            backward[:, t] = np.where(on[:, None], step, 0.0)
            pairs += np.exp(joint - total[:, None, None]) * on[:, None, None]
        return np.exp(forward + backward - total[:, None, None]), pairs, total


def chains(features: np.ndarray, lines: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of like length together: their indices, the rows of their
    lines (documents, longest) and which of these are real."""
    starts = np.cumsum(lines) - lines
    order = np.argsort(lines, kind="stable")
    order = order[lines[order] > 0]
    place = 0
    while place < len(order):
        part = order[place : place + PART]
        # Fewer at once where they are long, so that memory stays bounded.
        cells = lines[part] * np.arange(1, len(part) + 1)  # filled up to the longest
        part = part[: max(1, int(np.searchsorted(cells, MAX_CELLS)))]
        place += len(part)
        steps = np.arange(lines[part[-1]])
        inside = steps[None, :] < lines[part][:, None]
        yield part, np.where(inside, starts[part][:, None] + steps, starts[part][:, None]), inside


def train(
    texts: Sequence[str | None], labels: Sequence[int], epochs: int = EPOCHS, rate: float = 0.05, seed: int = 42
) -> LineField:
    """Maximum likelihood with Adam and a small ridge; every document counts
    the same, whatever its number of lines. Without documents the field knows
    nothing and scores 0.5."""
    field = LineField(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), 0.5)
    if not len(texts):
        return field
    y = np.asarray(labels, dtype=np.int64)
    field.prior = float((y.sum() + 1) / (len(y) + 2))
    # A few texts at a time, so that the bytes' working arrays stay small.
    pieces = [line_features(texts[k : k + 100]) for k in range(0, len(texts), 100)]
    features = np.concatenate([p[0] for p in pieces])
    lines = np.concatenate([p[2] for p in pieces])
    del pieces  # as large as ``features``
    parts = list(chains(features, lines))
    rng = np.random.default_rng(seed)
    moments = [[np.zeros_like(field.weights), np.zeros_like(field.steps)] for _ in range(2)]
    step = 0
    for _ in range(epochs):
        for k in rng.permutation(len(parts)):
            part, rows, inside = parts[k]
            x = features[rows] * inside[:, :, None]
            states, pairs, _ = field.marginals(x @ field.weights, inside)
            count = lines[part].astype(float)
            wanted = np.zeros_like(states)
            wanted[np.arange(len(part)), :, y[part]] = 1
            error = (states - wanted) * (inside / count[:, None])[:, :, None]
            steps = pairs / count[:, None, None]
            steps[np.arange(len(part)), y[part], y[part]] -= (count - 1) / count
            grads = (
                np.einsum("dtf,dts->fs", x, error) / len(part) + 1e-4 * field.weights,
                steps.mean(axis=0) + 1e-4 * field.steps,
            )
            step += 1
            for i, (value, g) in enumerate(zip((field.weights, field.steps), grads, strict=True)):
                moments[0][i] = 0.9 * moments[0][i] + 0.1 * g
                moments[1][i] = 0.99 * moments[1][i] + 0.01 * g * g
                m, v = moments[0][i] / (1 - 0.9**step), moments[1][i] / (1 - 0.99**step)
                value -= rate * m / (np.sqrt(v) + 1e-8)
    return field


def score_texts(field: LineField, texts: Sequence[str | None]) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good. Texts
    of empty lines only weigh these alike; texts without lines get the prior."""
    features, length, lines = line_features(texts)
    scores = np.full(len(texts), field.prior)
    unary = features @ field.weights
    for part, rows, inside in chains(features, lines):
        states, _, _ = field.marginals(unary[rows] * inside[:, :, None], inside)
        weight = (length[rows] + 1e-6) * inside
        scores[part] = (states[:, :, 1] * weight).sum(axis=1) / weight.sum(axis=1)
    return np.clip(scores, 0.0, 1.0)


def fit_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> LineField:
    """Train on at most ``sample_rows`` rows of ``labels`` ``(id, label)``, chosen
    by a hash of the id, whatever the layout of the tables. Null ids and labels other than 0 and 1 are left out."""
    usable = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col(id_col).isNotNull()
    )
    rows = usable.count()
    # At most ``sample_rows`` narrow rows: a bounded broadcast.
    sample = bounded_sample(usable, rows, sample_rows, id_col)
    found = docs.select(id_col, text_col).join(F.broadcast(sample), id_col)
    # Where ids repeat, a label meets several texts: again the first by a hash.
    found = found.orderBy(unit_hash(id_col, text_col), id_col, text_col).limit(sample_rows).toPandas()
    found = found.sort_values([id_col, text_col])
    field = train(found[text_col].tolist(), found["y"].tolist())
    # The driver lives on, and would keep what the sample took.
    del found
    release_memory()
    return field


def score_quality(docs: DataFrame, field: LineField, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from a half on) added or
    replaced. Whole texts; a null text counts as an empty one. Only the texts go
    to Python and only the scores come back; all other columns stay as they are."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    model = pickle.dumps(field)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = pickle.loads(model)
        for texts in batches:
            scores = [score_texts(own, part) for part in text_slices(texts, SLICE_CHARS)]
            # The worker lives on, and would keep what its last batch took.
            del texts
            release_memory()
            yield pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())

    # Each text is scored once, also where rows are filtered by what comes of it.
    score = F.arrow_udf(run, "double").asNondeterministic()
    scored = docs.select(*kept, score(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
