"""Language identification by a convolutional network over bytes.

Filters of several widths slide over fixed windows of UTF-8 bytes, each keeps
its largest answer, and a softmax over these names the language. The network is
trained in numpy on a bounded sample of labelled texts and applied to every
window of every text; a text's answer is the mean of its windows' answers,
weighted by their lengths.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.llm.common import unit_hash, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
SAMPLE_ROWS = 3_000
WINDOWS_PER_TEXT = 4
EPOCHS = 12
UNKNOWN = "und"


@dataclass
class ByteNet:
    """``filters[w]`` is (w, 256, FILTERS): a byte is looked up, not multiplied."""

    labels: list[str]
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> dict[int, list[np.ndarray]]:
        """The filters with neighbouring bytes looked up as pairs."""
        tables = {}
        for width, f in self.filters.items():
            steps = [f[k][:, None, :] + f[k + 1][None, :, :] for k in range(0, width - 1, 2)]
            tables[width] = [s.reshape(-1, f.shape[2]) for s in steps] + ([f[-1]] if width % 2 else [])
        return tables

    def answers(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Logits of (n, WINDOW) bytes."""
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        pooled = []
        for width, steps in tables.items():
            places = windows.shape[1] - width + 1
            total = None
            for k, step in enumerate(steps):
                index = pairs if step.shape[0] > 256 else windows
                value = step[index[:, 2 * k : 2 * k + places]]
                total = value if total is None else np.add(total, value, out=total)
            pooled.append(total.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return hidden @ self.out + self.out_bias


def windows_of(texts: Sequence[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows side by side, the text each belongs to, and its length. The
    last window of a text is filled up with zero bytes."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // window)
    data = b"".join(t.ljust(int(c) * window, b"\0") for t, c in zip(texts, counts, strict=True))
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    lengths = np.minimum(window, sizes[owner] - (np.arange(len(owner)) - first) * window)
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, window), owner, lengths


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    texts: Sequence[str],
    labels: Sequence[str],
    epochs: int = EPOCHS,
    batch: int = 64,
    rate: float = 0.01,
    seed: int = 42,
) -> ByteNet:
    """Fit on windows drawn from anywhere in the texts, each class as often as
    the others, with Adam. Gradients flow only through the place where a filter
    answered most."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    if not names:
        return ByteNet([], {}, np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    windows, owner, lengths = windows_of([t.encode() for t in texts])
    chance = rng.random(len(owner))
    order = np.lexsort((chance, owner))
    place = np.arange(len(owner)) - np.searchsorted(owner[order], owner[order], side="left")
    chosen = order[place < WINDOWS_PER_TEXT]
    x = windows[chosen]
    y = np.array([names.index(l) for l in labels])[owner[chosen]]
    count = np.bincount(y, minlength=len(names)).astype(float)
    weight = (len(y) / np.maximum(count, 1) / len(names))[y]

    params: dict = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    width_sum = FILTERS * len(WIDTHS)
    params |= {
        "bias": np.zeros(width_sum, np.float32),
        "out": rng.normal(0, width_sum**-0.5, (width_sum, len(names))).astype(np.float32),
        "out_bias": np.zeros(len(names), np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    for _ in range(epochs):
        shuffled = rng.permutation(len(x))
        for start in range(0, len(x), batch):
            index = shuffled[start : start + batch]
            xb, n = x[index], len(index)
            pooled, peaks = [], {}
            for w in WIDTHS:
                places = WINDOW - w + 1
                total = sum(params[w][k][xb[:, k : k + places]] for k in range(w))
                peaks[w] = total.argmax(axis=1)
                pooled.append(np.take_along_axis(total, peaks[w][:, None, :], axis=1)[:, 0])
            before = np.concatenate(pooled, axis=1) + params["bias"]
            hidden = np.maximum(before, 0)
            p = softmax(hidden @ params["out"] + params["out_bias"])
            p[np.arange(n), y[index]] -= 1
            p *= (weight[index] / n)[:, None]
            back = (p @ params["out"].T) * (before > 0)
            grads = {"out": hidden.T @ p, "out_bias": p.sum(axis=0), "bias": back.sum(axis=0)}
            for i, w in enumerate(WIDTHS):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                grads[w] = np.zeros_like(params[w])
                for k in range(w):
                    byte = np.take_along_axis(xb, peaks[w] + k, axis=1)
                    np.add.at(grads[w][k], (byte, np.arange(FILTERS)[None, :]), part)
            step += 1
            for key, g in grads.items():
                first[key] = 0.9 * first[key] + 0.1 * g
                second[key] = 0.999 * second[key] + 0.001 * g * g
                m, v = first[key] / (1 - 0.9**step), second[key] / (1 - 0.999**step)
                params[key] = (params[key] - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return ByteNet(names, {w: params[w] for w in WIDTHS}, params["bias"], params["out"], params["out_bias"])


def fit_language_model(
    labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, text_col: str = "text", label_col: str = "lang"
) -> ByteNet:
    """Train on ``(text, lang)``, at most ``sample_rows`` of them, an equal share
    from each language where there are enough. Rows without text or label are
    left out. Which texts are taken follows a hash of the text."""
    usable = labelled.select(F.col(text_col).alias("t"), F.col(label_col).alias("l")).where(
        (F.length("t") > 0) & F.col("l").isNotNull()
    )
    # One row per language.
    counts = {r["l"]: r["n"] for r in usable.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return train([], [])
    each = max(1, sample_rows // len(counts))
    enough = each + 6 * each**0.5 + 20  # nearly always, so that few rows are ranked
    shares = F.create_map(*[F.lit(x) for l, n in sorted(counts.items()) for x in (l, min(1.0, enough / n))])
    chance = unit_hash("t", seed=42)
    rank = F.row_number().over(Window.partitionBy("l").orderBy("chance", "t"))
    likely = usable.withColumn("chance", chance).where(F.col("chance") < shares[F.col("l")])
    sample = likely.withColumn("rank", rank).where(F.col("rank") <= each).select("t", "l")
    rows = sample.toPandas().sort_values(["l", "t"])
    return train(rows["t"].tolist(), rows["l"].tolist())


def predict_language(docs: DataFrame, net: ByteNet, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added or replaced.

    A null text, or one without any letter, is ``und`` with score 0; so is
    every text if the network was trained on nothing. All windows of a text
    count, whatever its length.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    model = pickle.dumps(net)

    def predict(texts: pd.Series, own: ByteNet, tables) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        wanted = [i for i, t in enumerate(texts) if t and own.labels and any(map(str.isalpha, t))]
        if wanted:
            values = texts.tolist()
            windows, owner, lengths = windows_of([values[i].encode() for i in wanted])
            logits = np.concatenate(
                [own.answers(windows[k : k + 256], tables) for k in range(0, len(windows), 256)]
            ).astype(np.float64)
            sums = np.zeros((len(wanted), len(own.labels)))
            np.add.at(sums, owner, logits * lengths[:, None])
            p = softmax(sums / np.bincount(owner, weights=lengths)[:, None])
            for i, best, row in zip(wanted, p.argmax(axis=1), p, strict=True):
                names[i], scores[i] = own.labels[best], float(row[best])
        return names, scores

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: ByteNet = pickle.loads(model)
        tables = own.tables()
        for frame in slices(frames, "__text"):
            names, scores = predict(frame["__text"], own, tables)
            yield frame.drop(columns="__text").assign(lang_pred=names, score=scores)

    rows = docs.select(*kept, F.col(text_col).alias("__text"))
    fields = [f for f in rows.schema.fields if f.name != "__text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return rows.mapInPandas(run, f"{schema}, lang_pred string, score double")
