"""Secret scans: patterns, and character Markov models for what no pattern names.

Two first-order Markov models of characters are counted from labelled samples:
random strings, such as keys, and ordinary identifiers. A run of identifier
characters is a secret if the logarithm of the likelihood ratio of the two, per
character, exceeds a threshold. The counts are sums over all samples, made
where the texts are; only alphabet-sized tables reach the driver.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import slices

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of 24 or more is the run that the open pattern finds, without its shorter ones.
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
MIN_SAMPLE = 8
MIN_RUN = 20
THRESHOLD = 0.3  # nats per character
EDGE = len(SYMBOLS)  # stands before and after a string
CODES = np.full(256, EDGE, dtype=np.int64)
CODES[list(SYMBOLS.encode())] = np.arange(len(SYMBOLS))

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """``(kind, start, end)`` of the patterns' matches, in code points."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_values(text: str) -> list[str]:
    """What the base patterns hold to be secret: the labelled random strings of a text."""
    values = [m.group(2) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_RUN] if ":" in text or "=" in text else []
    values += [m.group() for m in ACCESS.finditer(text) if m.end() - m.start() >= 20] if "AKIA" in text else []
    return values + HEX.findall(text)


def random_strings(count: int = 2_000, seed: int = 42) -> list[str]:
    """Labelled random strings over the usual alphabets: hexadecimal, upper
    case with digits, letters with digits, base64 and its variant for URLs."""
    rng = random.Random(seed)
    alphabets = (SYMBOLS[52:62] + "abcdef", SYMBOLS[:26] + SYMBOLS[52:62], SYMBOLS[:62], SYMBOLS[:64], SYMBOLS[:62] + "_-")
    return ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 64))) for i in range(count)]


def pair_counts(strings: Sequence[str]) -> np.ndarray:
    """How often a symbol follows another, edges included."""
    data = np.frombuffer(("\n" + "\n".join(strings) + "\n").encode(), dtype=np.uint8)
    codes = CODES[data]
    size = EDGE + 1
    return np.bincount(codes[:-1] * size + codes[1:], minlength=size * size).reshape(size, size)


@dataclass
class MarkovRatio:
    """Log-likelihood ratio of a step from symbol to symbol, random over ordinary."""

    ratio: np.ndarray

    @classmethod
    def from_counts(cls, unlike: np.ndarray, ordinary: np.ndarray, smoothing: float = 10.0) -> MarkovRatio:
        """Steps seen seldom lean on how frequent the symbol is at all."""
        logs = []
        for counts in (unlike, ordinary):
            alone = (counts.sum(axis=0) + 1) / (counts.sum() + len(counts))
            smoothed = counts + smoothing * alone[None, :]
            logs.append(np.log(smoothed / smoothed.sum(axis=1, keepdims=True)))
        return cls(logs[0] - logs[1])

    def score(self, string: str) -> float:
        """Per step, so that strings of all lengths compare."""
        codes = CODES[np.frombuffer(string.encode(), dtype=np.uint8)]
        return float(self.ratio[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0


def fit_markov(docs: DataFrame, text_col: str = "text", with_random: bool = True) -> MarkovRatio:
    """Counts over all texts: the values the base patterns find are random
    strings, every other run of ``MIN_SAMPLE`` or more identifier characters is
    an ordinary one. ``with_random`` adds ``random_strings`` to the first."""
    size = EDGE + 1

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, size, size), dtype=np.int64)
        run = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_SAMPLE)
        for frame in slices(frames, text_col):
            secret, ordinary = [], []
            for text in frame[text_col]:
                if text:
                    values = secret_values(text)
                    secret += values
                    rest = text
                    for value in values:
                        rest = rest.replace(value, " ")
                    ordinary += run.findall(rest)
            sums[0] += pair_counts(secret)
            sums[1] += pair_counts(ordinary)
        at = np.nonzero(sums)
        yield pd.DataFrame({"label": at[0], "a": at[1], "b": at[2], "n": sums[at]})

    # Bounded by the alphabet: two tables of its size squared.
    counted = (
        docs.select(text_col)
        .mapInPandas(count, "label long, a long, b long, n long")
        .groupBy("label", "a", "b")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    sums = np.zeros((2, size, size))
    sums[counted["label"], counted["a"], counted["b"]] = counted["n"]
    if with_random:
        sums[0] += pair_counts(random_strings())
    return MarkovRatio.from_counts(sums[0], sums[1])


def all_spans(text: str, model: MarkovRatio, threshold: float = THRESHOLD) -> list[Span]:
    """The base spans and, where none of them is, the runs that look random."""
    base = base_spans(text)
    more = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN, text):
        start, end = m.span()
        if not any(s < end and start < e for _, s, e in base) and model.score(m.group()) > threshold:
            more.append(("markov", start, end))
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, model: MarkovRatio, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``secrets``: an array of ``(kind, start,
    end)`` in code points, end exclusive, by start. Whole texts; null and empty
    texts have none."""
    kept = [c for c in docs.columns if c not in (text_col, "secrets")]
    ratio = model.ratio

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = MarkovRatio(ratio)
        for frame in slices(frames, "__text"):
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in all_spans(t, own, threshold)] if t else []
                for t in frame["__text"]
            ]
            yield frame.drop(columns="__text").assign(secrets=found)

    rows = docs.select(*kept, F.col(text_col).alias("__text"))
    fields = [f for f in rows.schema.fields if f.name != "__text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["secrets array<struct<kind:string,start:long,end:long>>"])
    return rows.mapInPandas(run, schema)


def mask_secrets(text: str, spans: Sequence[Span], mask: str = "<secret>") -> str:
    """The text with each span, overlapping ones together, replaced."""
    out, place = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= place:
            out += [text[place:start], mask]
        place = max(place, end)
    return "".join(out) + text[place:]


def digest(spans: Sequence[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
