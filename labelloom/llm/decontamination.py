"""Benchmark decontamination by latent semantic retrieval.

Texts are seen through the words of the benchmark. Words that stand in a large
share of all passages say nothing and are left out; the others are weighted by
their rarity. A randomised singular value decomposition of all passages, those
of the corpus and those of the benchmark, gives a latent space, in which the
passages of every document are compared with the benchmark items by cosine.
What comes close is checked word by word: a long common subsequence, or a
shorter one that holds the item's answer, its last words. Items most of whose
words are frequent, as in a corpus full of copies of one leak, have no place in
that space: every stretch of text that holds enough of their words is checked.

The texts are read twice, for the words' frequencies and for the positions of
the words that count, and once more if there are such items; what follows runs
on these positions, in two passes. Only the texts with candidates are read
again. What reaches the driver is bounded by the
benchmark's vocabulary and the number of latent dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import release_memory, slices
from labelloom.llm.words import NOT_ALPHANUMERIC, find_words
from labelloom.operators.sizing import broadcast_rows
from labelloom.storage import small_batches, write_table

SLICE_CHARS = 750_000
PASSAGE = 64  # words, for frequencies and for the decomposition
STRIDE = 24  # windows of three strides are compared
WINDOW = 72
FREQUENT_SHARE = 0.05
MIN_COUNTING = 0.5  # share of an item's words that carry weight, for the latent space
DIMENSIONS = 192
OVERSAMPLING = 16
BENCHMARK_SHARE = 1.0  # weight of the benchmark's passages against the corpus's
MIN_COSINE = 0.5
MIN_COMMON, MIN_COMMON_WITH_ANSWER, MIN_ANSWER = 0.6, 0.45, 0.8
ANSWER_WORDS = 8
MAX_BROADCAST_IDS = 1_000_000
ITEMS_AT_ONCE = 50_000
CACHED_ROWS, CACHED_GROUPS = 1_500, 512  # rows of the latent table and groups of them summed at once
SHORT_GROUP = 8  # rows at most
WORDS_AT_ONCE = 8_192
SENT_ROWS = 64  # of a task's product in one row
NO_WORD, MANY_WORDS = -1, -2


@dataclass
class Benchmark:
    """Items as word hashes, and the vocabulary they make."""

    item_ids: list[int | None]
    items: list[np.ndarray]
    vocabulary: np.ndarray  # sorted hashes
    vectors: list[tuple[np.ndarray, np.ndarray]]  # word numbers and counts of an item

    @classmethod
    def read(cls, ids: Sequence[int], texts: Sequence[str | None]) -> Benchmark:
        words = find_words(list(texts), NOT_ALPHANUMERIC)
        ends = np.cumsum(words.counts(len(texts)))
        every = np.split(words.hash, ends[:-1]) if len(texts) else []
        kept = [(i, w) for i, w in zip(ids, every, strict=True) if len(w)]
        vocabulary = np.unique(words.hash)
        vectors = [np.unique(np.searchsorted(vocabulary, w), return_counts=True) for _, w in kept]
        return cls([i for i, _ in kept], [w for _, w in kept], vocabulary, vectors)

    def parted(self, weights: np.ndarray) -> tuple[Benchmark, Benchmark]:
        """The items most of whose words carry weight, and the others."""
        share = np.array([count[weights[word] > 0].sum() / count.sum() for word, count in self.vectors])

        def part(at: np.ndarray) -> Benchmark:
            ids, items, vectors = ([every[i] for i in at] for every in (self.item_ids, self.items, self.vectors))
            return Benchmark(ids, items, self.vocabulary, vectors)

        return part(np.flatnonzero(share >= MIN_COUNTING)), part(np.flatnonzero(share < MIN_COUNTING))


class WordNumbers:
    """Numbers of the vocabulary's words by hash; -1 for other words. A slot for
    the low bits of a hash holds the one word that can be meant, or says that
    there are more; only these are searched for."""

    def __init__(self, vocabulary: np.ndarray):
        bits = min(22, max(16, len(vocabulary).bit_length() + 6))
        self.vocabulary, self.mask = vocabulary, np.uint64((1 << bits) - 1)
        self.slots = np.full(1 << bits, NO_WORD, dtype=np.int32)
        slot, first, count = np.unique(vocabulary & self.mask, return_index=True, return_counts=True)
        self.slots[slot.astype(np.int64)] = np.where(count == 1, first, MANY_WORDS)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        numbers = self.slots[(hashes & self.mask).astype(np.int64)]
        at = np.flatnonzero(numbers != NO_WORD)
        place, own = numbers[at], hashes[at]
        many = np.flatnonzero(place == MANY_WORDS)
        if len(many):
            place[many] = np.minimum(np.searchsorted(self.vocabulary, own[many]), len(self.vocabulary) - 1)
        if len(at):
            numbers[at] = np.where(self.vocabulary[place] == own, place, NO_WORD)
        return numbers


def _distinct(values: np.ndarray) -> np.ndarray:
    """As ``np.unique``, which hashes whole numbers; sorting takes less time."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def word_frequencies(docs: DataFrame, bench: Benchmark, text_col: str) -> tuple[int, np.ndarray]:
    """The number of passages of all texts, and in how many each word stands."""
    vocabulary = bench.vocabulary

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, size = WordNumbers(vocabulary), len(vocabulary)
        met, passages = np.zeros(size, dtype=np.int64), 0
        for frame in slices(frames, text_col, SLICE_CHARS):
            words = find_words(frame[text_col].tolist(), NOT_ALPHANUMERIC)
            counts = words.counts(len(frame))
            per_text = -(-counts // PASSAGE)
            first_word, first_passage = np.cumsum(counts) - counts, np.cumsum(per_text) - per_text
            place = np.arange(len(words.hash)) - first_word[words.text]
            passage = first_passage[words.text] + place // PASSAGE
            number = numbers.find(words.hash)
            inside = number >= 0
            met += np.bincount(_distinct(passage[inside] * size + number[inside]) % size, minlength=size)
            passages += int(per_text.sum())
        found = np.flatnonzero(met)
        yield pd.DataFrame({"word": [-1, *found.tolist()], "n": [passages, *met[found].tolist()]})

    # One row per word of the benchmark.
    with small_batches(docs.sparkSession):
        rows = (
            docs.select(text_col)
            .mapInPandas(run, "word long, n long")
            .groupBy("word")
            .agg(F.sum("n").alias("n"))
            .toPandas()
        )
    met = np.zeros(len(vocabulary))
    words = rows[rows["word"] >= 0]
    met[words["word"]] = words["n"]
    return int(rows.loc[rows["word"] < 0, "n"].sum()), met


def word_weights(passages: int, met: np.ndarray) -> np.ndarray:
    """Inverse passage frequency; 0 for words in a large share of all passages."""
    weights = np.log((passages + 1) / (met + 1)) + 1
    weights[met > FREQUENT_SHARE * passages] = 0
    return weights


def counting_words(docs: DataFrame, bench: Benchmark, weights: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``(id, place, word)``: where in each text the words that count stand;
    texts without any are left out."""
    vocabulary, counts_at_all = bench.vocabulary, weights > 0
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = WordNumbers(vocabulary[counts_at_all])
        renumbered = np.flatnonzero(counts_at_all).astype(np.int32)
        for frame in slices(frames, text_col, SLICE_CHARS):
            words = find_words(frame[text_col].tolist(), NOT_ALPHANUMERIC)
            counts = words.counts(len(frame))
            first = np.cumsum(counts) - counts
            number = numbers.find(words.hash)
            at = np.flatnonzero(number >= 0)
            text = words.text[at]
            place = (at - first[text]).astype(np.int32)
            word = renumbered[number[at]]
            bounds = np.searchsorted(text, np.arange(len(frame) + 1))
            rows = [
                (doc, place[a:b], word[a:b])
                for doc, a, b in zip(frame[id_col], bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                if b > a
            ]
            yield pd.DataFrame(rows, columns=["id", "place", "word"])

    schema = f"id {id_type}, place array<int>, word array<int>"
    return docs.select(id_col, text_col).mapInPandas(run, schema)


def _cells(frame: pd.DataFrame, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words by stretch of ``unit`` words: for each word its number, for each
    stretch that has any its first word, its row and its place in the text."""
    sizes = frame["place"].str.len().to_numpy()
    row = np.repeat(np.arange(len(frame)), sizes)
    stretch = np.concatenate(frame["place"].tolist()) // unit
    word = np.concatenate(frame["word"].tolist())
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (stretch[1:] != stretch[:-1])]))
    return word, first, row[first], stretch[first]


def _runs(starts: np.ndarray, total: int, size: int) -> Iterator[tuple[int, int]]:
    """Neighbouring groups, by where they start, of about ``size`` elements
    together; a group is never cut."""
    at = 0
    while at < len(starts):
        end = int(np.searchsorted(starts, starts[at] + size, side="right")) - 1
        end = len(starts) if starts[at] + size >= total else max(at + 1, end)
        yield at, end
        at = end


def latent_table(weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A row per word, one after the other in memory, which those of a
    decomposition's factors are not."""
    return np.ascontiguousarray(weights[:, None] * basis, dtype=np.float32)


def _sums(table: np.ndarray, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of the ``table``'s ``rows`` for each group that begins at
    ``first``, some that fit a processor's cache at a time. The table must lie
    row by row: ``take`` copies any other one as a whole in every call. Most
    groups are short; their k-th rows are added together, in the order in which
    ``reduceat`` adds so few, the first row last."""
    sizes = np.diff(first, append=len(rows))
    out = np.empty((len(first), table.shape[1]), dtype=table.dtype)
    order = np.argsort(-sizes, kind="stable")
    long = int(np.searchsorted(-sizes[order], -SHORT_GROUP))
    at = np.sort(order[:long])
    if long:
        ends = np.cumsum(sizes[at])
        starts = ends - sizes[at]
        own = rows[np.arange(ends[-1]) + np.repeat(first[at] - starts, sizes[at])]
        for s, e in _runs(starts, len(own), CACHED_ROWS):
            a, b = starts[s], ends[e - 1]
            out[at[s:e]] = np.add.reduceat(table.take(own[a:b], axis=0), starts[s:e] - a, axis=0)
    for s in range(long, len(order), CACHED_GROUPS):
        group = order[s : s + CACHED_GROUPS]
        start, size = first[group], sizes[group]
        total = np.zeros((len(group), table.shape[1]), dtype=table.dtype)
        for k in range(1, int(size[0])):
            n = int(np.searchsorted(-size, -k))
            total[:n] += table.take(rows[start[:n] + k], axis=0)
        total += table.take(rows[start], axis=0)
        out[group] = total
    return out


def _product(positions: DataFrame, sketch: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``A' A S`` for the passages' matrix ``A`` and a sketch ``S`` over words."""
    weighted = latent_table(weights, sketch)
    sent = positions.sparkSession.sparkContext.broadcast(weighted)
    height, width = sketch.shape

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        total = np.zeros((height, width))
        for frame in frames:
            if not len(frame):
                continue
            words, firsts, _, _ = _cells(frame, PASSAGE)
            for s, e in _runs(firsts, len(words), WORDS_AT_ONCE):
                a, b = firsts[s], firsts[e] if e < len(firsts) else len(words)
                word, first = words[a:b], firsts[s:e] - a
                latent = _sums(own, word, first)
                # Back to words: for each, the passages that it stands in.
                each = np.repeat(np.arange(len(first)), np.diff([*first, len(word)]))
                order = np.argsort(word, kind="stable")
                sorted_words = word[order]
                starts = np.flatnonzero(np.concatenate([[True], sorted_words[1:] != sorted_words[:-1]]))
                used = sorted_words[starts]
                total[used] += weights[used, None] * _sums(latent, each[order], starts)
            release_memory()
        for block in range(0, height, SENT_ROWS):
            part = total[block : block + SENT_ROWS]
            if part.any():
                yield pd.DataFrame({"block": [block], "values": [part.ravel()]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "values": [np.sum(frame["values"].tolist(), axis=0)]})

    schema = "block long, values array<double>"
    # A row per block of words and task, then a row per block.
    parts = positions.select("place", "word").mapInPandas(run, schema).groupBy("block").applyInPandas(add, schema)
    result = np.zeros((height, width))
    with small_batches(positions.sparkSession):
        rows = parts.toPandas()
    for block, values in rows.itertuples(index=False):
        part = np.asarray(values).reshape(-1, width)
        result[block : block + len(part)] = part
    return result


def latent_basis(
    positions: DataFrame, bench: Benchmark, weights: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 42
) -> np.ndarray:
    """Right singular vectors of the passages of corpus and benchmark, from one
    pass: a random sketch ``S``, its product ``Y = A' A S``, and the
    decomposition of ``Y (S' Y)^-1 Y'``, which stands for ``A' A``."""
    size = len(weights)
    width = min(size, dimensions + OVERSAMPLING)
    sketch, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))

    corpus = _product(positions, sketch, weights)
    own = np.zeros_like(corpus)
    for word, count in bench.vectors:
        item = count * weights[word]
        own[word] += np.outer(item, item @ sketch[word])
    norm = np.linalg.norm(own)
    share = BENCHMARK_SHARE * max(1.0, np.linalg.norm(corpus) / norm if norm else 1.0)
    product = corpus + share * own
    inner = sketch.T @ product
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    kept = values > 1e-6 * values.max(initial=0)
    root = product @ (vectors[:, kept] / np.sqrt(values[kept]))
    basis, singular, _ = np.linalg.svd(root, full_matrices=False)
    return basis[:, :dimensions][:, singular[:dimensions] > 1e-6 * singular.max(initial=0)]


def candidates(
    positions: DataFrame, bench: Benchmark, weights: np.ndarray, basis: np.ndarray, min_cosine: float, id_type: str
) -> DataFrame:
    """``(id, start, item, cosine)``: windows whose cosine with an item in the
    latent space is ``min_cosine`` or more. Windows of ``WINDOW`` words begin
    every ``STRIDE`` words."""
    latent = latent_table(weights, basis)
    items = np.stack([count.astype(np.float32) @ latent[word] for word, count in bench.vectors])
    items /= np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-12)
    sent = positions.sparkSession.sparkContext.broadcast((latent, items))
    steps = WINDOW // STRIDE

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, targets = sent.value
        for frame in frames:
            if not len(frame):
                continue
            words, firsts, rows, stretches = _cells(frame, STRIDE)
            texts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))  # each text's first stretch
            found = []
            for s, e in _runs(firsts[texts], len(words), WORDS_AT_ONCE):
                low, high = texts[s], texts[e] if e < len(texts) else len(rows)
                a, b = firsts[low], firsts[high] if high < len(firsts) else len(words)
                row, stretch = rows[low:high], stretches[low:high]
                part = _sums(own, words[a:b], firsts[low:high] - a)
                # A window begins at each stretch with words and takes in the next ones of its text.
                window = part.copy()
                for k in range(1, min(steps, len(row))):
                    near = (row[k:] == row[:-k]) & (stretch[k:] - stretch[:-k] < steps)
                    np.add(window[:-k], part[k:], out=window[:-k], where=near[:, None])
                norm = np.sqrt(np.einsum("ij,ij->i", window, window))
                cosine = window @ targets.T
                i, j = np.nonzero(cosine >= (min_cosine * np.maximum(norm, 1e-6))[:, None])
                if len(i):
                    found.append((row[i], stretch[i], j, (cosine[i, j] / norm[i]).astype(np.float64)))
            if found:
                row, stretch, item, cosine = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pd.DataFrame(
                    {
                        "id": frame["id"].iloc[row].to_numpy(),
                        "start": stretch.astype(np.int64) * STRIDE,
                        "item": item,
                        "cosine": cosine,
                    }
                )
            release_memory()

    return positions.mapInPandas(run, f"id {id_type}, start long, item long, cosine double")


def word_masks(words: np.ndarray) -> dict[int, int]:
    """For each word, the bits of the places where it stands."""
    masks: dict[int, int] = {}
    for i, word in enumerate(words.tolist()):
        masks[word] = masks.get(word, 0) | (1 << i)
    return masks


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    return _common(word_masks(a), len(a), b.tolist())


def _common(masks: dict[int, int], size: int, words: list[int]) -> int:
    full = (1 << size) - 1
    row = full
    for word in words:
        hit = row & masks.get(word, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


class Item:
    """An item of the benchmark, ready to be compared with many stretches."""

    def __init__(self, words: np.ndarray):
        self.size, answer = len(words), words[-ANSWER_WORDS:]
        self.masks, self.answer, self.answer_size = word_masks(words), word_masks(answer), len(answer)

    def held(self, near: np.ndarray) -> tuple[float, float] | None:
        """The shares of the item's words and of its answer's that ``near`` holds
        in order, if they make a leak."""
        words = [w for w in near.tolist() if w in self.masks]
        if len(words) / self.size < MIN_COMMON_WITH_ANSWER:
            return None
        common = _common(self.masks, self.size, words) / self.size
        if common < MIN_COMMON_WITH_ANSWER:
            return None
        kept = _common(self.answer, self.answer_size, words) / self.answer_size
        return (common, kept) if common >= MIN_COMMON or kept >= MIN_ANSWER else None


def verified(docs: DataFrame, found: DataFrame, bench: Benchmark, id_col: str, text_col: str) -> DataFrame:
    """``(id, item_id, cosine, start, common, answer)`` of the candidates that
    pass the word-by-word check. The stretch looked at is the window with an
    item's length to either side."""
    id_type = docs.schema[id_col].dataType.simpleString()
    listed = found.groupBy("id").agg(F.collect_list(F.struct("start", "item", "cosine")).alias("found"))
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    number = found.select("id").distinct().count()
    joined = rows.join(
        broadcast_rows(listed, number, MAX_BROADCAST_IDS // 10), rows["doc"].eqNullSafe(listed["id"])
    ).select("id", "text", "found")
    words_of, ids = bench.items, bench.item_ids

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = [Item(w) for w in words_of]
        for frame in slices(frames, "text", SLICE_CHARS):
            words = find_words(frame["text"].tolist(), NOT_ALPHANUMERIC)
            ends = np.cumsum(words.counts(len(frame)))
            best: dict = {}
            for k, (doc, own) in enumerate(zip(frame["id"], np.split(words.hash, ends[:-1]), strict=True)):
                for c in frame["found"].iloc[k]:
                    item = items[c["item"]]
                    near = own[max(0, c["start"] - item.size) : c["start"] + WINDOW + item.size]
                    if shares := item.held(near):
                        row = (shares[0], c["cosine"], -c["start"], shares[1])
                        key = (k, c["item"])
                        if key not in best or row > best[key][1]:
                            best[key] = (doc, row)
            yield pd.DataFrame(
                [(doc, ids[i], r[1], -r[2], r[0], r[3]) for (_, i), (doc, r) in best.items()],
                columns=["id", "item_id", "cosine", "start", "common", "answer"],
            )

    schema = f"id {id_type}, item_id long, cosine double, start long, common double, answer double"
    return joined.mapInPandas(run, schema)


def _count_cosine(a: np.ndarray, b: np.ndarray) -> float:
    (x, n), (y, m) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return float(n[i] @ m[j] / (np.linalg.norm(n) * np.linalg.norm(m)))


def word_by_word(docs: DataFrame, bench: Benchmark, id_col: str, text_col: str) -> DataFrame:
    """As ``verified``, for all stretches of all texts and all items of ``bench``.

    A common subsequence is no longer than the number of an item's words that
    the stretch has at all, each as often as in the item at most. Stretches in
    which these are too few for a leak are passed over; this loses none.
    ``cosine`` is that of the plain word counts.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    items, ids, steps = bench.items, bench.item_ids, WINDOW // STRIDE
    vocabulary = np.unique(np.concatenate(items))
    needs = []  # of each item: its words, how often it and its answer have them
    for item in items:
        word, at = np.unique(np.searchsorted(vocabulary, item), return_inverse=True)
        answer = np.bincount(at[-ANSWER_WORDS:], minlength=len(word))
        needs.append((word.tolist(), np.bincount(at).tolist(), answer.tolist()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, ready = WordNumbers(vocabulary), [Item(w) for w in items]
        for frame in slices(frames, text_col, SLICE_CHARS):
            words = find_words(frame[text_col].tolist(), NOT_ALPHANUMERIC)
            counts = words.counts(len(frame))
            first, cells = np.cumsum(counts) - counts, -(-counts // STRIDE)
            text = np.repeat(np.arange(len(frame)), cells)
            ends = np.cumsum(cells)
            low, high, cell = (ends - cells)[text], ends[text], np.arange(len(text))
            number = numbers.find(words.hash)
            at = np.flatnonzero(number >= 0)
            at = at[np.argsort(number[at], kind="stable")]
            of_text = words.text[at]
            place = (ends - cells)[of_text] + (at - first[of_text]) // STRIDE
            bounds = np.searchsorted(number[at], np.arange(len(vocabulary) + 1))
            best: dict = {}
            for i, (item, need) in enumerate(zip(items, needs, strict=True)):
                size, answer = len(item), item[-ANSWER_WORDS:]
                reach = -(-size // STRIDE)
                begin, end = np.maximum(low, cell - reach), np.minimum(high, cell + steps + reach)
                most, most_answer = np.zeros(len(cell), dtype=np.int64), np.zeros(len(cell), dtype=np.int64)
                for word, n, n_answer in zip(*need, strict=True):
                    seen = np.zeros(len(cell) + 1, dtype=np.int64)
                    np.cumsum(np.bincount(place[bounds[word] : bounds[word + 1]], minlength=len(cell)), out=seen[1:])
                    met = seen[end] - seen[begin]
                    most += np.minimum(met, n)
                    if n_answer:
                        most_answer += np.minimum(met, n_answer)
                enough = (most / size >= MIN_COMMON) | (
                    (most / size >= MIN_COMMON_WITH_ANSWER) & (most_answer / len(answer) >= MIN_ANSWER)
                )
                for c in np.flatnonzero(enough).tolist():
                    k = int(text[c])
                    own = words.hash[first[k] : first[k] + counts[k]]
                    start = (c - int(low[c])) * STRIDE
                    if shares := ready[i].held(own[max(0, start - size) : start + WINDOW + size]):
                        row = (shares[0], _count_cosine(item, own[start : start + WINDOW]), -start, shares[1])
                        if (k, i) not in best or row > best[k, i]:
                            best[k, i] = row
            doc = frame[id_col].tolist()
            yield pd.DataFrame(
                [(doc[k], ids[i], r[1], -r[2], r[0], r[3]) for (k, i), r in best.items()],
                columns=["id", "item_id", "cosine", "start", "common", "answer"],
            )

    schema = f"id {id_type}, item_id long, cosine double, start long, common double, answer double"
    return docs.select(id_col, text_col).mapInPandas(run, schema)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    min_cosine: float = MIN_COSINE,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """``(id_col, item_id, cosine, start_word, common, answer)``: a row per
    document and benchmark item that it holds, the best of its places.

    ``common`` is the share of the item's words in the longest common
    subsequence, ``answer`` that of its last words; ``cosine`` is that of the
    latent space, or of word counts for items of frequent words. Words are runs of digits,
    letters and non-ASCII characters, A-Z lower-cased. Null and empty texts and
    items hold nothing. Items are taken in blocks of a bounded size, in the
    order of their ids, those with a null id as the last one; rows with equal or null ids are each looked at.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    types = {id_col: id_type, "item_id": "long", "cosine": "double", "start_word": "long", "common": "double", "answer": "double"}
    # A frame made of Python's rows would start workers of another kind, which stay.
    result = docs.sparkSession.range(0).select(*(F.lit(None).cast(t).alias(c) for c, t in types.items()))
    blocks = [F.col(item_col).between(low, high) for low, high in _item_bounds(benchmark, item_col)]
    for block in [*blocks, F.col(item_col).isNull()]:
        part = benchmark.where(block).select(item_col, text_col).collect()
        bench = Benchmark.read([r[0] for r in part], [r[1] for r in part])
        if not bench.items:
            continue
        passages, met = word_frequencies(docs, bench, text_col)
        weights = word_weights(passages, met)
        bench, frequent = bench.parted(weights)
        checked = []
        if bench.items:
            positions = write_table(counting_words(docs, bench, weights, id_col, text_col), "counting_words")
            basis = latent_basis(positions, bench, weights, dimensions)
            found = write_table(candidates(positions, bench, weights, basis, min_cosine, id_type), "leak_candidates")
            checked.append(verified(docs, found, bench, id_col, text_col))
        if frequent.items:
            checked.append(write_table(word_by_word(docs, frequent, id_col, text_col), "frequent_leaks"))
        for rows in checked:
            result = result.unionByName(
                rows.select(F.col("id").alias(id_col), "item_id", "cosine", F.col("start").alias("start_word"), "common", "answer")
            )
    return result


def _item_bounds(benchmark: DataFrame, item_col: str, block: int = ITEMS_AT_ONCE) -> list[tuple[int, int]]:
    """Ranges of item ids of about ``block`` items."""
    ids = benchmark.where(F.col(item_col).isNotNull())
    low, high, n = ids.agg(F.min(item_col), F.max(item_col), F.count(F.lit(1))).first()
    if not n:
        return []
    parts = -(-n // block)
    cuts = ids.approxQuantile(item_col, [k / parts for k in range(1, parts)], 0.01 / parts) if parts > 1 else []
    edges = sorted({int(low), *(int(c) for c in cuts)})
    return [(a, b - 1) for a, b in zip(edges, [*edges[1:], int(high) + 1], strict=True)]


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Rows that share an id
    with one that does go with it."""
    leaked = find_leaks(docs, benchmark, id_col, **options).select(F.col(id_col).alias("leaked")).distinct()
    leaked = write_table(leaked, "leaked_ids")
    leaked = broadcast_rows(leaked, leaked.count(), MAX_BROADCAST_IDS)
    return docs.join(leaked, docs[id_col].eqNullSafe(F.col("leaked")), "left_anti")
