"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad by a two-state chain: the score of a state at a line is
linear in the features of the line and of its two neighbours, and the score of two states in a row is
learnt too. Forward-backward gives each line its marginal probability of being good; the document's
score is the mean of these, weighted by the lines' lengths.

A line's features are about its form: length, shares of letters, capitals, digits, marks, symbols,
word length, shares of distinct words and of words equal to the one before. A document's label stands
for each of its lines when the chain is trained (label 1 is good).

Training takes a bounded sample: the ``most_documents`` labelled documents with the smallest hashes of
their ids, up to ``most_lines`` lines; it is the features that reach the driver, not the texts. Scoring
is one pass over the documents without a shuffle.

Null and empty texts are one empty line and get a score like any other. A null ``doc_id`` has no label
and is in no fold. Repeated rows are scored each by itself; several labels of one document count as the
lowest. Without labels of both kinds every score is the share of good ones, 0.5 without any. An empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.language_id import held_out
from tradewind.llm.texts import slices, utf8

MOST_DOCUMENTS, MOST_LINES = 4000, 400_000
GOOD = 0.7
STEPS, RATE, PENALTY = 200, 0.1, 1e-3

_LETTER, _CAPITAL, _DIGIT, _SPACE, _MARK, _SYMBOL = range(6)


def _kind_of(c: int) -> int:
    if c >= 128 or chr(c).islower():
        return _LETTER
    if chr(c).isupper():
        return _CAPITAL
    if chr(c).isdigit():
        return _DIGIT
    if c <= 32:
        return _SPACE
    return _MARK if chr(c) in ".,;:!?'\"()-" else _SYMBOL


_KINDS = np.array([_kind_of(c) for c in range(256)], np.uint8)
FEATURES = 11


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all lines in a row (the last is the length in bytes), and where each text's lines begin."""
    lines = [text.split(b"\n") for text in texts]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lines], dtype=np.int64)])
    flat = [line for own in lines for line in own]
    size = np.fromiter(map(len, flat), np.int64, len(flat))
    begins = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    kinds = _KINDS[np.frombuffer(b"\n".join(flat) + b"\n", np.uint8)]
    out = np.zeros((len(flat), FEATURES + 1), np.float32)
    if not len(flat):
        return out, starts
    chars = np.maximum(size, 1)
    out[:, 0] = 1
    out[:, 1] = np.log1p(size)
    for place, kind in enumerate((_LETTER, _CAPITAL, _DIGIT, _MARK, _SYMBOL), start=2):
        out[:, place] = np.add.reduceat(kinds == kind, begins, dtype=np.int64) / chars
    n_words = np.empty(len(flat))
    for i, line in enumerate(flat):
        words = line.split()
        n = n_words[i] = len(words)
        if n > 1:
            out[i, 8] = len(set(words)) / n
            out[i, 9] = sum(map(bytes.__eq__, words, words[1:])) / n
        else:
            out[i, 8] = 1
    out[:, 7] = np.log1p(size / np.maximum(n_words, 1))
    out[:, 10] = np.log1p(n_words)
    out[:, 11] = size
    return out, starts


def with_neighbours(own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and of the line after; zero outside the text."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[starts[:-1]], after[starts[1:] - 1] = 0, 0
    return np.hstack([own, before, after])


class Chain:
    """Weights of the state "good" (against "bad") and scores of two states in a row."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, moves: np.ndarray):
        self.mean, self.scale, self.weights, self.moves = mean, scale, weights, moves

    def marginals(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of "good" per line, and expected numbers of moves [from, to]."""
        lengths = np.diff(starts)
        order = np.argsort(-lengths, kind="stable")
        begin, lengths = starts[:-1][order], lengths[order]
        state = np.zeros((len(x), 2))
        state[:, 1] = x @ self.weights
        ahead, back = state.copy(), np.zeros_like(state)
        steps = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        for t in range(1, steps):
            at = begin[: active[t]] + t
            ahead[at] += np.logaddexp(ahead[at - 1, :1] + self.moves[0], ahead[at - 1, 1:] + self.moves[1])
        expected = np.zeros((2, 2))
        total = np.zeros(len(x))
        ends = starts[1:] - 1
        total[ends] = np.logaddexp(ahead[ends, 0], ahead[ends, 1])
        for t in range(steps - 1, 0, -1):
            at = begin[: active[t]] + t
            onward = state[at] + back[at]
            total[at - 1] = total[at]
            pairs = ahead[at - 1][:, :, None] + self.moves + onward[:, None, :] - total[at][:, None, None]
            expected += np.exp(pairs).sum(axis=0)
            back[at - 1] = np.logaddexp(self.moves[:, 0] + onward[:, :1], self.moves[:, 1] + onward[:, 1:])
        return np.exp(ahead[:, 1] + back[:, 1] - total), expected

    def normal(self, own: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return with_neighbours((own - self.mean) / self.scale, starts)

    def document_scores(self, texts: list[bytes]) -> np.ndarray:
        own, starts = line_features(texts)
        good, _ = self.marginals(self.normal(own[:, :FEATURES], starts), starts)
        weight = own[:, FEATURES] + 1.0  # an empty line counts a little
        first = starts[:-1]
        return np.clip(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first), 0.0, 1.0)


class Constant:
    """The score of all documents if there is nothing to tell good from bad."""

    def __init__(self, score: float):
        self.score = score

    def document_scores(self, texts: list[bytes]) -> np.ndarray:
        return np.full(len(texts), self.score)


def train(own: np.ndarray, starts: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Chain:
    """Fit a chain by the gradient of the conditional likelihood (Adam). ``labels``: 0 or 1 per document."""
    mean, scale = own.mean(axis=0), own.std(axis=0)
    mean[0], scale[0] = 0, 1
    scale[scale < 1e-6] = 1
    chain = Chain(mean, scale, np.zeros(3 * own.shape[1]), np.zeros((2, 2)))
    x = chain.normal(own, starts).astype(np.float64)
    y = np.repeat(labels, np.diff(starts)).astype(np.float64)
    same = np.diff(starts) - 1
    moved = np.diag([same[labels == 0].sum(), same[labels == 1].sum()]).astype(float)
    first = [np.zeros_like(chain.weights), np.zeros_like(chain.moves)]
    second = [np.zeros_like(chain.weights), np.zeros_like(chain.moves)]
    n = len(x)
    for step in range(1, steps + 1):
        good, expected = chain.marginals(x, starts)
        slopes = [x.T @ (y - good) / n - PENALTY * chain.weights, (moved - expected) / n - PENALTY * chain.moves]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
        changes = [
            RATE * f / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8) for f, s in zip(first, second, strict=True)
        ]
        chain.weights, chain.moves = chain.weights + changes[0], chain.moves + changes[1]
    return chain


def line_share(lengths: np.ndarray, most_lines: int) -> int:
    """The largest number of lines per text with which all texts together have at most ``most_lines``."""
    lengths, left = np.sort(lengths), most_lines
    for i, n in enumerate(lengths.tolist()):
        if n * (len(lengths) - i) > left:
            return max(1, left // (len(lengths) - i))
        left -= n
    return max(1, int(lengths[-1])) if len(lengths) else 1


def _sample_features(share: int):
    """Features of all lines, or of a run of ``share`` lines that begins where the hash of the text says."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch)
            own, starts = line_features(texts)
            parts = []
            for text, a, b in zip(texts, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if b - a > share:
                    a += xxhash.xxh64_intdigest(text) % (b - a - share + 1)
                parts.append(own[a : min(b, a + share)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array(parts, pa.binary())], names=["quality", "features"]
            )

    return run


def learn(
    docs: DataFrame, labels: DataFrame, most_documents: int = MOST_DOCUMENTS, most_lines: int = MOST_LINES
) -> Chain | Constant:
    """A chain from the labelled documents (``doc_id, quality``) of a bounded sample.

    If the sample has more than ``most_lines`` lines, its longest documents give a run of lines each.
    """
    chosen = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(most_documents)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most ``most_documents`` pairs of numbers.
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "quality")
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n")
    counts = sample.select("doc_id", n_lines).groupBy("doc_id").agg(F.coalesce(F.max("n"), F.lit(1)).alias("n")).collect()
    share = line_share(np.array([row["n"] for row in counts], np.int64), most_lines)
    sample = sample.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"))
    parts, given = [], []
    rows = sample.select("text", "quality").mapInArrow(_sample_features(share), "quality int, features binary")
    for row in rows.toLocalIterator():
        parts.append(np.frombuffer(row["features"], np.float32).reshape(-1, FEATURES + 1))
        given.append(row["quality"])
    if len(set(given)) < 2:
        return Constant(float(np.mean(given)) if given else 0.5)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return train(np.concatenate(parts)[:, :FEATURES].astype(np.float64), starts, np.array(given))


def score(docs: DataFrame, model: Chain | Constant, good: float = GOOD) -> DataFrame:
    """``doc_id, score, predicted`` of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = model.document_scores(utf8(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64()), pa.array((found >= good).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``; learnt from labels outside the held-out fold."""
    model = learn(docs, labels.filter(~held_out(F.col("doc_id"))))
    return score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
