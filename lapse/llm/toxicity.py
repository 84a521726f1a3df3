"""Toxicity by a classifier chain over word presence.

The links of the chain are toxicity categories and, last, toxicity as labelled. Each link is
a linear (logistic) model; its inputs are the presence of informative words and the
probabilities of all earlier links. While fitting, those probabilities are out of fold, so
a later link learns from what the earlier one says about texts that it has not seen.

Fitting uses a bounded sample (``max_rows``). Word counts are Spark aggregates over it; the
driver gets the chosen vocabulary and each sampled text's words out of it. Scoring reads
every whole text once, in Arrow batches, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import staged
from lapse.llm.sampling import MAX_FIT_ROWS, labelled_sample
from lapse.llm.wordarrays import NOT_ALPHANUMERIC, Words, mix, slices, split_words

#: Words whose presence in a text labelled toxic names its category while fitting.
CATEGORY_SEEDS = {
    "insult": ["clown", "dumb", "fool", "idiot", "imbecile", "jerk", "loser", "moron", "stupid"],
    "contempt": ["disgusting", "filth", "garbage", "pathetic", "scum", "trash", "vermin", "worthless"],
}
VOCABULARY = 512
FOLDS = 5
MIN_PLACES = 3


def tokens(column: pa.Array) -> Words:
    """Lower-cased runs of letters and digits."""
    return split_words(column, lower=True, separator=NOT_ALPHANUMERIC)


def word_codes(words: list[str]) -> np.ndarray:
    return tokens(pa.array(words)).hash


@dataclass
class Chain:
    """``vocabulary`` is sorted; link i has weights for its words, then for links 0 to i - 1, then a bias."""

    names: list[str]
    vocabulary: np.ndarray
    weights: list[np.ndarray]

    def score(self, column: pa.Array) -> np.ndarray:
        """Probabilities, one row per text and one column per link. No words: the biases alone."""
        text, word = present(tokens(column), self.vocabulary)
        n, v = len(column), len(self.vocabulary)
        out = np.zeros((n, len(self.weights)))
        for i, w in enumerate(self.weights):
            logit = np.bincount(text, weights=w[word], minlength=n) + out[:, :i] @ w[v:v + i] + w[-1]
            out[:, i] = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        return out


def present(words: Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, word) index pairs: which vocabulary words occur in which text, each pair once."""
    if not len(vocabulary) or not len(words.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(vocabulary, words.hash), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[place] == words.hash)
    text = np.searchsorted(words.first, hit, side="right") - 1
    pairs = np.unique(text * len(vocabulary) + place[hit])
    return pairs // len(vocabulary), pairs % len(vocabulary)


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, steps: int = 30) -> np.ndarray:
    """Weights and bias (last) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    rate = np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4)
    w = np.zeros(x.shape[1])
    w[-1] = np.log(rate / (1 - rate))
    for _ in range(steps if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_chain(names: list[str], vocabulary: np.ndarray, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> Chain:
    """Fit the links in order; ``y`` has a column per link, ``fold`` a fold number per row."""
    weights, earlier = [], np.zeros((len(x), 0))
    for i in range(len(names)):
        inputs = np.column_stack([x, earlier])
        out_of_fold = np.zeros(len(x))
        for k in np.unique(fold):
            w = fit_linear(inputs[fold != k], y[fold != k, i])
            out_of_fold[fold == k] = 1 / (1 + np.exp(-np.clip(inputs[fold == k] @ w[:-1] + w[-1], -40, 40)))
        weights.append(fit_linear(inputs, y[:, i]))
        earlier = np.column_stack([earlier, out_of_fold])
    return Chain(names, vocabulary, weights)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = MAX_FIT_ROWS, vocabulary_size: int = VOCABULARY,
          seeds: dict[str, list[str]] = CATEGORY_SEEDS) -> Chain:
    """Fit the chain on at most ``max_rows`` labelled documents. Without labelled rows it scores 0.0001."""
    sample = staged(labelled_sample(docs, labels, [label_col], id_col, text_col, max_rows), "toxic-sample")
    seed_codes = [word_codes(v) for v in seeds.values()]

    def links(y: np.ndarray, words: Words) -> np.ndarray:
        out = np.zeros((len(y), len(seed_codes) + 1), bool)
        for i, codes in enumerate(seed_codes):
            hit = np.flatnonzero(np.isin(words.hash, codes))
            out[np.searchsorted(words.first, hit, side="right") - 1, i] = True
        out[:, :-1] &= (y == 1)[:, None]
        out[:, -1] = y == 1
        return out

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = tokens(part.column("text"))
                y = links(part.column("y").to_numpy(zero_copy_only=False), words)
                text, code = words.text_of(), words.hash
                # the words on either side, so that a copied passage counts once and not once per copy
                around = mix(np.append(np.uint64(1), code[:-1]) * np.uint64(3) + np.append(code[1:], np.uint64(1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code.view(np.int64)), pa.array(around.view(np.int64)),
                     *[pa.array(y[text, i].astype(np.int64)) for i in range(y.shape[1])]],
                    ["word", "around", *[f"y{i}" for i in range(y.shape[1])]])

    n_links = len(seed_codes) + 1
    sample = sample.withColumnRenamed(f"y_{label_col}", "y")
    seen = sample.select("text", "y").mapInArrow(words_of, "word long, around long, " + ", ".join(f"y{i} long" for i in range(n_links)))
    seen = seen.groupBy("word", "around").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(n_links)])
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y{i}").alias(f"y{i}") for i in range(n_links)])
    counts = staged(counts, "toxic-words")
    totals = counts.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.sum(f"y{n_links - 1}").alias("pos")).first()
    share = max(totals["pos"] or 0, 1) / max(totals["n"] or 0, 2)
    # words that occur in toxic texts more often than chance explains, given how many words are tried
    gain = F.col("n") * F.pow(F.col(f"y{n_links - 1}") / F.col("n") - share, 2) / (share * (1 - share) + 1e-9)
    chosen = counts.where((F.col("n") >= MIN_PLACES) & (F.col(f"y{n_links - 1}") > share * F.col("n")))
    chosen = chosen.where(gain > 2 * float(np.log(max(totals["words"], 2))) + 2)
    picked = chosen.orderBy(gain.desc(), "word").limit(vocabulary_size).select("word").collect()
    vocabulary = np.sort(np.array([r["word"] for r in picked], np.int64).view(np.uint64))

    def hits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = tokens(part.column("text"))
                y = links(part.column("y").to_numpy(zero_copy_only=False), words)
                text, word = present(words, vocabulary)
                ends = np.searchsorted(text, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([word[a:b].tolist() for a, b in zip(ends, ends[1:])], pa.list_(pa.int32())),
                     pa.array(y.tolist(), pa.list_(pa.bool_()))], ["doc_id", "words", "y"])

    fit = sample.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "y").mapInArrow(
        hits_of, "doc_id string, words array<int>, y array<boolean>")
    fit = fit.withColumn("fold", F.crc32(F.col("doc_id").cast("binary")) % FOLDS).orderBy("doc_id").collect()
    x = np.zeros((len(fit), len(vocabulary)))
    for i, r in enumerate(fit):
        x[i, r["words"]] = 1
    y = np.array([r["y"] for r in fit], float).reshape(len(fit), n_links)
    return fit_chain([*seeds, label_col], vocabulary, x, y, np.array([r["fold"] for r in fit], int))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, p_<link> for each link, toxic (the last link's p >= threshold).

    Null and empty texts get the biases' probabilities. Null and repeated ids are allowed: every row
    is scored by itself. An empty table gives an empty result. Other columns are ignored.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType.simpleString()
    names = [f"p_{n}" for n in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                p = chain.score(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(p[:, i]) for i in range(p.shape[1])], pa.array(p[:, -1] >= threshold)],
                    ["doc_id", *names, "toxic"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names) + ", toxic boolean")


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that the chain calls toxic; all columns and other rows unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(chain.score(part.column(text_col))[:, -1] < threshold))

    return docs.mapInArrow(run, docs.schema)
