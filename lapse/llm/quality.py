"""Document quality by histogram gradient-boosted trees over document statistics.

Statistics are array sums over each batch's words, bytes and lines. Trees are grown level by
level on binned statistics of a bounded sample of labelled rows; each tree is a complete
binary tree flattened into arrays (split statistic, threshold, leaf value), so scoring a batch is one
gather per level for all of its documents and trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.sampling import MAX_FIT_ROWS, labelled_sample
from lapse.llm.wordarrays import buffers, mix, powers, slices, split_words

TREES, DEPTH, RATE, BINS, PENALTY, MIN_ROWS = 100, 4, 0.1, 64, 1.0, 8


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(code: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: how many distinct codes, and how often its commonest code occurs."""
    order = np.lexsort([code, owner])
    code, owner = code[order], owner[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(code)))
    most = np.zeros(n)
    np.maximum.at(most, owner[at], run)
    return np.bincount(owner[at], minlength=n).astype(float), most


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics per text, from the text alone; empty and null texts give zeros."""
    data, bounds = buffers(column)
    words = split_words(column)
    n, count, size = len(column), words.counts.astype(float), np.diff(bounds).astype(float)
    per_word, per_byte = np.maximum(count, 1), np.maximum(size, 1)
    owner = words.text_of()
    length = (words.end - words.start).astype(float)
    lead, last = data[words.start] if len(words.start) else words.start, data[words.end - 1] if len(words.end) else words.end
    upper = (data >= 65) & (data <= 90)
    alpha = upper | ((data >= 97) & (data <= 122))
    digit = (data >= 48) & (data <= 57)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    wide = data >= 128
    mark = ~(alpha | digit | blank | wide)
    plain = np.isin(data, np.frombuffer(b".,;:!?'\"-()", np.uint8))
    mean = _sums(length, words.first) / per_word
    unique, common = _distinct(words.hash, owner, n)
    same = np.zeros(len(words.hash))
    if len(same) > 1:
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    pair = np.zeros(0, np.uint64) if len(owner) < 2 else mix(words.hash[:-1] * np.uint64(3) + words.hash[1:])
    inner = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) > 1 else np.zeros(0, int)
    pairs, _ = _distinct(pair[inner], owner[1:][inner] if len(owner) > 1 else owner, n)
    # lines: the words between line feeds, hashed by their sum of word codes times place
    feeds = np.flatnonzero(data == 10)
    line = np.searchsorted(feeds, words.start) + np.searchsorted(bounds[1:], words.start, side="right")
    line_at = np.flatnonzero(np.append(True, np.diff(line) != 0)) if len(line) else np.zeros(0, int)
    lines = np.bincount(owner[line_at], minlength=n).astype(float) if len(line) else np.zeros(n)
    if len(line):
        place = np.arange(len(line)) - np.repeat(line_at, np.diff(np.append(line_at, len(line))))
        weight = powers(1 << 12)[place & 4095]
        unique_lines, _ = _distinct(np.add.reduceat(words.hash * weight, line_at), owner[line_at], n)
    else:
        unique_lines = np.zeros(n)
    per_line = np.maximum(lines, 1)
    return np.column_stack([
        np.log1p(count), np.log1p(size), mean, np.sqrt(np.maximum(_sums(length ** 2, words.first) / per_word - mean ** 2, 0)),
        _sums(upper, bounds) / per_byte, _sums(digit, bounds) / per_byte, _sums(mark, bounds) / per_byte,
        _sums(mark & ~plain, bounds) / per_byte, _sums(wide, bounds) / per_byte, _sums(blank, bounds) / per_byte,
        unique / per_word, common / per_word, _sums(same, words.first) / per_word, pairs / np.maximum(count - 1, 1),
        _sums((lead >= 65) & (lead <= 90), words.first) / per_word,
        _sums(np.isin(last, np.frombuffer(b".!?", np.uint8)), words.first) / per_word,
        _sums(~((last >= 128) | ((last >= 48) & (last <= 57)) | ((last | 32) >= 97) & ((last | 32) <= 122)), words.first) / per_word,
        _sums(length <= 3, words.first) / per_word, _sums(length >= 15, words.first) / per_word,
        np.log1p(lines), count / per_line, unique_lines / per_line,
        _sums(data == 124, bounds) / per_byte, _sums(data == 33, bounds) / per_byte,
        _sums(np.isin(data, np.frombuffer(b"{}<>=/\\", np.uint8)), bounds) / per_byte,
    ])


@dataclass
class Trees:
    """``split`` and ``above`` are (trees, 2 ** depth - 1), ``leaf`` is (trees, 2 ** depth)."""

    split: np.ndarray
    above: np.ndarray
    leaf: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows, depth = np.arange(len(x)), self.leaf.shape[1].bit_length() - 1
        for split, above, leaf in zip(self.split, self.above, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, split[node]] > above[node])
            out += leaf[node - len(split)]
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boost ``trees`` trees on the logistic loss; splits are chosen from histograms of ``BINS`` bins."""
    n, features = x.shape
    inner = (1 << depth) - 1
    p = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)),
                float(np.log(p / (1 - p))))
    if n == 0 or y.min() == y.max():
        return out
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    raw = np.full(n, out.bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)  # within the level
        for level in range(depth):
            width, base = 1 << level, (1 << level) - 1
            best, split, cut = np.full(width, 1e-6), np.zeros(width, np.int64), np.full(width, BINS)
            for f in range(features):
                cell = node * BINS + binned[:, f]
                a, b, c = (np.bincount(cell, weights=v, minlength=width * BINS).reshape(width, BINS).cumsum(1) for v in (g, h, np.ones(n)))
                left = a ** 2 / (b + PENALTY)
                right = (a[:, -1:] - a) ** 2 / (b[:, -1:] - b + PENALTY)
                gain = left + right - a[:, -1:] ** 2 / (b[:, -1:] + PENALTY)
                gain[(c < MIN_ROWS) | (c[:, -1:] - c < MIN_ROWS)] = -1
                at = gain.argmax(1)
                more = gain[np.arange(width), at]
                won = more > best
                best, split, cut = np.where(won, more, best), np.where(won, f, split), np.where(won, at, cut)
            for k in range(width):
                out.split[t, base + k] = split[k]
                out.above[t, base + k] = edges[split[k]][cut[k]] if cut[k] < len(edges[split[k]]) else np.inf
            node = 2 * node + (x[np.arange(n), out.split[t, base + node]] > out.above[t, base + node])
        a, b = (np.bincount(node, weights=v, minlength=inner + 1) for v in (g, h))
        out.leaf[t] = rate * a / (b + PENALTY)
        raw += out.leaf[t][node]
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_FIT_ROWS) -> Trees:
    """Fit on at most ``max_rows`` labelled documents; only their statistics reach the driver.

    Without labelled rows, or with one class only, every score is the (smoothed) class share.
    """
    sample = labelled_sample(docs, labels, [label_col], id_col, text_col, max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(
                    statistics(part.column("text")).tolist(), pa.list_(pa.float64())), part.column("y")], ["doc_id", "x", "y"])

    rows = sample.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.col(f"y_{label_col}").alias("y")).mapInArrow(
        run, "doc_id string, x array<double>, y int").orderBy("doc_id").collect()
    if not rows:
        return fit_trees(np.zeros((0, 1)), np.zeros(0))
    return fit_trees(np.array([r["x"] for r in rows]), np.array([r["y"] == 1 for r in rows], float))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 if score >= 0.5).

    Null and empty texts are scored as texts whose statistics are all 0. Every row is scored by
    itself, so null and repeated ids are allowed. An empty table gives an empty result. Other columns are ignored.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                p = trees.score(statistics(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int")
