"""Benchmark decontamination by latent semantic retrieval and sequence checks.

1. Benchmark items are taken in blocks of bounded size; a block's words are its vocabulary.
   Document frequencies of these words are counted over all documents, in the pass of step 2.
2. Passages (windows of ``WINDOW`` words, every ``STRIDE``) are TF-IDF vectors over the vocabulary. Their
   latent directions come from a randomised SVD of all item and all corpus passages. How often
   passages hold two words together is counted once, per pair of words; the SVD's products are taken from
   these counts, by Spark tasks that each return a partial sum.
3. For every passage of every document the items that its words hold enough of are found from each word's list of items; the
   passage is projected, and where its cosine to a passage of such an item reaches ``min_cosine`` the two are candidates.
4. A candidate is confirmed on the words: the longest common subsequence of the item and the
   text around the passage, and the same for the item's answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import partitions, staged
from lapse.llm.wordarrays import NOT_ALPHANUMERIC, Words, slices, split_words

WINDOW, STRIDE = 24, 8
#: Items (and bytes of item text) that one block holds at most.
BLOCK_ITEMS, BLOCK_BYTES = 2_048, 1 << 20
#: Entries of the (passage, item) table that passages are looked at in.
TABLE = 1 << 21
#: Words of a block that are met in all items at once: those that most items hold.
COMMON = 32
RANK, OVERSAMPLE, POWER = 96, 16, 2
#: Pairs of words that a task holds before it hands them on.
PAIRS = 1 << 21
#: Pairs of one row on their way to the task that adds them up, and words whose pairs one such task gets together.
PIECE, PART_WORDS = 512, 32
#: Corpus documents whose passages the SVD is fitted on besides the item passages where a caller asks for a ``sampled`` fit.
MAX_FIT_DOCS = 2_048
MIN_COSINE = 0.1
#: Share of an item's weight (of a window's length of it) that a candidate passage's words must hold.
MIN_OVERLAP = 0.2
#: A leak keeps this share of the item's words in order; below SURE, the answer must be there too.
MIN_LCS, SURE, MIN_ANSWER = 0.6, 0.85, 0.6


@dataclass
class Block:
    """Items of one block: ids, word codes, answers' words, and their passages in the latent space."""

    ids: list
    codes: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    basis: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def tokens(column: pa.Array) -> Words:
    return split_words(column, lower=True, separator=NOT_ALPHANUMERIC)


def answer_of(text: str) -> str:
    """What follows the last question mark, or else the last sentence."""
    head, mark, tail = text.rstrip().rpartition("?")
    if mark and tail.strip():
        return tail
    sentences = [s for s in text.replace("!", ".").split(".") if s.strip()]
    return sentences[-1] if sentences else text


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """Blocks of the items with a word; the driver holds one block at a time."""
    ids, texts, size = [], [], 0
    rows = items.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).distinct()
    for r in rows.orderBy("i", "t").toLocalIterator():
        ids.append(r["i"])
        texts.append(r["t"])
        size += len(r["t"])
        if len(ids) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield _block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield _block(ids, texts)


def _block(ids: list, texts: list[str]) -> Block:
    def codes(values: list[str]) -> list[np.ndarray]:
        words = tokens(pa.array(values, pa.string()))
        return [words.hash[a:b] for a, b in zip(words.first, words.first[1:])]

    whole, answers = codes(texts), codes([answer_of(t) for t in texts])
    used = [i for i, c in enumerate(whole) if len(c)]
    block = Block([ids[i] for i in used], [whole[i] for i in used], [answers[i] for i in used])
    if used:
        block.vocabulary = np.unique(np.concatenate(block.codes))
    return block


def lookup(vocabulary: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Place of each code in the (ascending) vocabulary, or -1; the first bits of a code lead to the words that share them."""
    bits = min(len(vocabulary).bit_length() + 4, 22)
    size = np.bincount((vocabulary >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    first = np.cumsum(size) - size
    lead = (code >> np.uint64(64 - bits)).astype(np.int64)
    at = np.minimum(first, len(vocabulary) - 1)[lead]
    out = np.where(vocabulary[at] == code, at, -1)
    several = np.flatnonzero((size > 1)[lead])
    if len(several):
        at = np.minimum(np.searchsorted(vocabulary, code[several]), len(vocabulary) - 1)
        out[several] = np.where(vocabulary[at] == code[several], at, -1)
    return out


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the passages of texts whose words begin at ``first``; the last one ends with the text."""
    count = np.diff(first)
    n = np.where(count > 0, np.maximum(np.ceil((count - WINDOW) / STRIDE), 0).astype(np.int64) + 1, 0)
    text = np.repeat(np.arange(len(count)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = first[:-1][text] + np.minimum(nth * STRIDE, np.maximum(count[text] - WINDOW, 0))
    return start, np.minimum(start + WINDOW, first[1:][text])


def _passage_matrix(place: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) of the vocabulary words of the passages, one entry per occurrence."""
    size = stop - start
    row = np.repeat(np.arange(len(start)), size)
    word = place[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)]
    known = word >= 0
    return row[known], word[known]


def _times(row: np.ndarray, word: np.ndarray, weight: np.ndarray, n: int, dense: np.ndarray) -> np.ndarray:
    """The passage matrix (n rows, weight per word) times a dense (words x columns) matrix."""
    out = np.zeros((n, dense.shape[1]), dense.dtype)
    if len(row):
        at = np.flatnonzero(np.append(True, np.diff(row) != 0))
        out[row[at]] = np.add.reduceat(dense[word] * weight[word][:, None].astype(dense.dtype), at)
    return out


def _frequencies(texts: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """(documents that hold each vocabulary word, documents), over all documents; ``texts`` or their ``_pair_counts``."""
    out = np.zeros(len(block.vocabulary) + 1, np.int64)
    for r in _counted(texts, block).where("pair < 0").collect():
        out[-1 - r["pair"]] = r["n"]
    return out[:-1], int(out[-1])


def _pairs(words: Words, place: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair, n): the pairs of vocabulary words that passages hold, ascending, and how often, summed over the passages.

    A pair is the lesser word's place times the vocabulary's size plus the other's. The passages that hold two positions are those
    that have begun at the first of them less those that have ended at the second, so positions are
    looked at in pairs once, not once for each passage.
    """
    start, stop = windows(words.first)
    known = np.flatnonzero(place >= 0)
    word = place[known]
    begun = np.cumsum(np.bincount(start, minlength=len(place) + 1), dtype=np.int32)[known]
    ended = np.cumsum(np.bincount(stop, minlength=len(place) + 1), dtype=np.int32)[known]
    high, low = word * (n_words << 8), word << 8
    found = [np.zeros(0, np.int64)]
    step = 1 << 14
    for k in range(0, len(known), step):
        for apart in range(min(WINDOW, len(known) - k)):
            to = min(k + step, len(known) - apart)
            one, other = slice(k, to), slice(k + apart, to + apart)
            both = begun[one] - ended[other]
            held = both > 0
            times = both[held]
            if not len(times):
                break
            if apart:
                times <<= (word[one] == word[other])[held]  # the word meets itself from either position
            # the lesser of both orders begins with the lesser word; a count is at most 2 * WINDOW, which 8 bits hold
            found.append(np.minimum(high[one] + low[other], high[other] + low[one])[held] | times)
    packed = np.concatenate(found)
    packed.sort()
    return _summed(packed >> 8, packed & 255)


def _summed(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of the ascending ``pair`` and their sums of ``n``."""
    new = np.flatnonzero(np.append(len(pair) > 0, pair[1:] != pair[:-1]))
    return pair[new], np.add.reduceat(n, new) if len(new) else n


class Tally:
    """Pairs and their counts; about ``spare`` entries more than twice the distinct pairs are held at most."""

    def __init__(self, spare: int) -> None:
        self.spare, self.held, self.size, self.distinct = spare, [], 0, 0

    def add(self, pair: np.ndarray, n: np.ndarray) -> None:
        self.held.append((pair, n))
        self.size += len(pair)
        if self.size >= self.spare + 2 * self.distinct:
            self.held = [self.total()]
            self.size = self.distinct = len(self.held[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair, n = (np.concatenate(c) for c in zip(*self.held))
        order = np.argsort(pair, kind="stable")
        return _summed(pair[order], n[order])


def _pair_counts(texts: DataFrame, block: Block) -> DataFrame:
    """(pair, n) of ``_pairs`` over all texts, written once; pair -1 - w has the documents that hold word w, and -1 - the vocabulary's
    size has all documents. These are whole numbers that depend on no weight: the weights and
    every product of the fit are taken from them, and the texts are read for them once.

    Tasks send their pairs in pieces of at most PIECE, by the lesser word; each range of words is added up by one task.
    """
    vocabulary, n_words = block.vocabulary, len(block.vocabulary)

    def pieces(pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        part = pair // (n_words * PART_WORDS)
        cuts = np.union1d(np.arange(0, len(pair), PIECE), np.flatnonzero(part[1:] != part[:-1]) + 1)
        both = np.stack([pair, n], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(part[cuts]), pa.array([b.tobytes() for b in np.split(both, cuts[1:])], pa.binary())], ["part", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tally = np.zeros(n_words + 1, np.int64), Tally(PAIRS)
        for batch in batches:
            for part in slices(batch, "text"):
                words = tokens(part.column("text"))
                place = lookup(vocabulary, words.hash)
                known = np.flatnonzero(place >= 0)
                pair = words.text_of()[known] * n_words + place[known]
                pair.sort()
                pair, _ = _summed(pair, pair)
                held[:-1] += np.bincount(pair % n_words, minlength=n_words)
                held[-1] += part.num_rows
                tally.add(*_pairs(words, place, n_words))
                if tally.distinct >= PAIRS:
                    yield pieces(*tally.total())
                    tally = Tally(PAIRS)
        tally.add(-1 - np.flatnonzero(held), held[held > 0])
        pair, n = tally.total()
        if len(pair):
            yield pieces(pair, n)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(PAIRS)
        for batch in batches:
            both = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int64).reshape(-1, 2)
            tally.add(both[:, 0], both[:, 1])
        pair, n = tally.total()
        for k in range(0, len(pair), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(pair[k:k + (1 << 18)]), pa.array(n[k:k + (1 << 18)])], ["pair", "n"])

    sent = texts.select("text").mapInArrow(count, "part long, counts binary").repartition(partitions(texts.sparkSession), "part")
    return staged(sent.mapInArrow(add_up, "pair long, n long"), "leak-pairs")


def _counted(texts: DataFrame, block: Block) -> DataFrame:
    """The ``_pair_counts`` of texts, or what is given if it is these already."""
    return texts if "pair" in texts.columns else _pair_counts(texts, block)


def _gram_product(texts: DataFrame, block: Block, dense: np.ndarray) -> np.ndarray:
    """(A'A) dense for the TF-IDF matrix A of the texts' and the items' passages; ``texts`` or their ``_pair_counts``.

    Each task adds up its pairs and returns one matrix in row blocks, which are summed per block;
    the matrix has one row per vocabulary word, whatever the number of texts.
    """
    idf, columns, n_words = block.idf, dense.shape[1], len(block.vocabulary)
    weighted = dense * idf[:, None]
    height = 1 << 7

    def add(out: np.ndarray, pair: np.ndarray, n: np.ndarray) -> None:
        for k in range(0, len(pair), 1 << 14):
            one, other = np.divmod(pair[k:k + (1 << 14)], n_words)
            times = n[k:k + (1 << 14), None].astype(float)
            for to, by, rows in ((one, other, slice(None)), (other, one, np.flatnonzero(one != other))):
                to, by = to[rows], by[rows]
                order = np.argsort(to, kind="stable")
                to = to[order]
                new = np.flatnonzero(np.append(len(to) > 0, to[1:] != to[:-1]))
                if len(new):
                    out[to[new]] += np.add.reduceat(weighted[by[order]] * times[rows][order], new) * idf[to[new]][:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((n_words, columns))
        for batch in batches:
            add(out, batch.column("pair").to_numpy(), batch.column("n").to_numpy())
        cuts = range(0, len(out), height)
        yield pa.RecordBatch.from_arrays([pa.array([c // height for c in cuts], pa.int64()),
                                          pa.array([out[c:c + height].tobytes() for c in cuts], pa.binary())], ["part", "sums"])

    def total(table: pa.Table) -> pa.Table:
        sums = [np.frombuffer(b) for b in table.column("sums").to_pylist()]
        return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([sum(sums[1:], sums[0]).tobytes()], pa.binary())})

    parts = _counted(texts, block).where("pair >= 0").mapInArrow(run, "part long, sums binary").groupBy("part").applyInArrow(total, "part long, sums binary")
    out = np.zeros((n_words, columns))
    for r in parts.collect():
        part = np.frombuffer(r["sums"]).reshape(-1, columns)
        out[r["part"] * height:r["part"] * height + len(part)] += part
    own = np.concatenate(block.codes)
    first = np.append(0, np.cumsum([len(c) for c in block.codes]))
    add(out, *_pairs(Words(np.zeros(0, np.uint8), own, own, first, own), lookup(block.vocabulary, own), n_words))
    return out


def latent_basis(texts: DataFrame, block: Block, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """(words x rank) right singular vectors of the passages by randomised subspace iteration."""
    n = len(block.vocabulary)
    width = min(rank + OVERSAMPLE, n)
    counts = _counted(texts, block)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, width)))[0]
    for _ in range(POWER):
        product = _gram_product(counts, block, q)
        values, turn = np.linalg.eigh(q.T @ product)
        q = np.linalg.qr(product @ turn[:, ::-1])[0]
    return q[:, :min(rank, n)].astype(np.float32)


def fit_block(texts: DataFrame, block: Block, rank: int = RANK, fit_on: DataFrame | None = None) -> Block:
    """The block with the statistics and latent space of all ``texts``; the space is fitted on ``fit_on`` alone where given."""
    counts = _pair_counts(texts, block)
    held, documents = _frequencies(counts, block)
    block.idf = np.log((documents + 2.0) / (held + 1.0))
    block.basis = latent_basis(counts if fit_on is None else fit_on, block, rank)
    own = np.concatenate(block.codes)
    first = np.append(0, np.cumsum([len(c) for c in block.codes]))
    start, stop = windows(first)
    place = lookup(block.vocabulary, own)
    row, word = _passage_matrix(place, start, stop)
    block.latent = _unit(_times(row, word, block.idf.astype(np.float32), len(start), block.basis))
    block.owner = np.searchsorted(first, start, side="right") - 1
    return block


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def lcs_length(item: dict[int, int], n: int, text: list[int]) -> int:
    """Length of the longest common subsequence; ``item`` maps a word to the bits of its places among n."""
    full = (1 << n) - 1
    v = full
    for word in text:
        u = v & item.get(word, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def place_bits(codes: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, c in enumerate(codes.tolist()):
        out[c] = out.get(c, 0) | 1 << i
    return out


def holders(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(items, first): the items that hold word w of the vocabulary are ``items[first[w]:first[w + 1]]``."""
    item = np.repeat(np.arange(len(block.codes)), [len(c) for c in block.codes])
    pair = np.unique(np.searchsorted(block.vocabulary, np.concatenate(block.codes)) * len(block.codes) + item)
    return pair % len(block.codes), np.searchsorted(pair // len(block.codes), np.arange(len(block.vocabulary) + 1))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges that begin at ``first``, one range after another."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


def candidates(words: Words, block: Block, min_cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage start, item, cosine) of passages whose words hold enough of an item and that lie near a passage of it in the latent space."""
    start, stop = windows(words.first)
    place = lookup(block.vocabulary, words.hash)
    at, item, cosine = [], [], []
    squares, items = block.idf ** 2, len(block.codes)
    held, first_held = holders(block)
    mass = np.array([squares[np.searchsorted(block.vocabulary, c)].sum() * min(1.0, WINDOW / len(c)) for c in block.codes])
    # a word's weight relative to the lightest item that holds it: what a passage's words sum up to is at least its overlap
    # with any item, so no passage that the overlap below lets through is left out, whatever stands beside the item
    lightest = np.minimum.reduceat(mass[held], first_held[:-1])
    part_of = np.append(0.0, np.cumsum(np.append(squares / lightest, 0.0)[place]))  # -1, the last, is a word outside the vocabulary
    near = np.flatnonzero(part_of[stop] - part_of[start] >= MIN_OVERLAP * (1 - 1e-6))
    own = np.searchsorted(block.owner, np.arange(items + 1))  # the passages of each item
    # the words that most items hold are counted per passage and multiplied with their weights in all items; the others' lists are read
    holding = np.diff(first_held)
    common = np.argsort(-holding, kind="stable")[:COMMON]
    nth_common = np.full(len(holding), -1)
    nth_common[common] = np.arange(len(common))
    shared = np.zeros((len(common), items))
    shared[np.repeat(np.arange(len(common)), holding[common]), held[_ranges(first_held[common], holding[common])]] = np.repeat(squares[common], holding[common])
    height = max(1, TABLE // max(items, COMMON))
    for k in range(0, len(near), height):
        part = near[k:k + height]
        row, word = _passage_matrix(place, start[part], stop[part])
        nth = nth_common[word]
        counts = np.bincount((row * len(common) + nth)[nth >= 0], minlength=len(part) * len(common)).reshape(len(part), len(common))
        row, word = row[nth < 0], word[nth < 0]
        size = holding[word]
        overlap = np.bincount(np.repeat(row * items, size) + held[_ranges(first_held[word], size)], np.repeat(squares[word], size), len(part) * items)
        overlap = overlap.reshape(-1, items) + counts.astype(float) @ shared
        i, n = np.nonzero(overlap >= MIN_OVERLAP * (1 - 1e-9) * mass)
        if not len(i):
            continue
        few, of = np.unique(i, return_inverse=True)
        row, word = _passage_matrix(place, start[part[few]], stop[part[few]])
        x = _unit(_times(row, word, block.idf.astype(np.float32), len(few), block.basis))
        size = own[n + 1] - own[n]
        passage = _ranges(own[n], size)
        for m in range(0, len(passage), 1 << 16):
            cut = slice(m, m + (1 << 16))
            p, q = np.repeat(of, size)[cut], passage[cut]
            score = np.einsum("ij,ij->i", x[p], block.latent[q])
            ok = score >= min_cosine
            at.append(start[part[few[p[ok]]]])
            item.append(block.owner[q[ok]])
            cosine.append(score[ok])
    return (np.concatenate(at), np.concatenate(item), np.concatenate(cosine)) if at else (np.zeros(0, int),) * 3


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", min_cosine: float = MIN_COSINE, min_lcs: float = MIN_LCS,
               sampled: bool = False) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, lcs (share of the item's words), answer, cosine, word.

    ``word`` is the place of the first candidate passage. Texts are compared as lower-cased runs of
    letters and digits. Documents and items without such words match nothing. Null and repeated ids
    are allowed: rows that repeat an id and a text give one row. An empty table on either side gives an empty result.
    The latent space is fitted on all documents; ``sampled`` fits it on MAX_FIT_DOCS of them, for a quick look.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType.simpleString()
    item_kind = items.select(F.col(item_col).alias("i")).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, nth long, lcs double, answer double, cosine double, word long"
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spark = docs.sparkSession
    out = spark.createDataFrame([], f"doc_id {kind}, item_id {item_kind}, lcs double, answer double, cosine double, word long")
    for block in _fitted_blocks(texts, items, item_col, item_text_col, sampled):
        names = spark.createDataFrame([(n, i) for n, i in enumerate(block.ids)], f"nth long, item_id {item_kind}")
        leaks = texts.mapInArrow(_searcher(block, min_cosine, min_lcs), schema).dropDuplicates()
        out = out.unionByName(leaks.join(F.broadcast(names), "nth").drop("nth").select(out.columns))
    return out


def _fitted_blocks(texts: DataFrame, items: DataFrame, item_col: str, item_text_col: str, sampled: bool = False) -> Iterator[Block]:
    """The blocks of the items, each with its vocabulary's statistics and latent space over ``texts`` (doc_id, text)."""
    sample = None
    for block in item_blocks(items, item_col, item_text_col):
        if not block.ids:
            continue
        if sampled and sample is None:
            sample = _fit_sample(texts)  # the same for every block
        yield fit_block(texts, block, fit_on=sample)


def _fit_sample(texts: DataFrame) -> DataFrame:
    """At most MAX_FIT_DOCS texts, those of the smallest hashes of id and text; rows that repeat both count once."""
    keyed = texts.select(F.xxhash64("doc_id", "text").alias("h"), "text")
    last = keyed.select("h").orderBy("h").limit(MAX_FIT_DOCS).agg(F.max("h")).first()[0]
    return staged(keyed.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.min("text").alias("text")).select("text"), "leak-sample")


def _searcher(block: Block, min_cosine: float, min_lcs: float):
    """A mapInArrow function that finds a block's items in texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(block, min_cosine, min_lcs)
        for batch in batches:
            for part in slices(batch, "text"):
                best = find(part.column("text"))
                keys = sorted(best)
                ids = part.column("doc_id").take(pa.array([t for t, _ in keys], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([i for _, i in keys], pa.int64()),
                     *[pa.array([best[k][c] for k in keys], pa.float64() if c < 3 else pa.int64()) for c in range(4)]],
                    ["doc_id", "nth", "lcs", "answer", "cosine", "word"])

    return run


def _finder(block: Block, min_cosine: float, min_lcs: float):
    """A function from a column of texts to {(text, item): (lcs, answer, cosine, word)}."""
    bits = [place_bits(c) for c in block.codes]
    answer_bits = [place_bits(c) for c in block.answers]

    def find(column: pa.Array) -> dict[tuple[int, int], tuple]:
        words = tokens(column)
        at, item, cosine = candidates(words, block, min_cosine)
        text = np.searchsorted(words.first, at, side="right") - 1
        best: dict[tuple[int, int], tuple] = {}
        done = -1, -1, -1
        for k in np.lexsort([at, item, text]).tolist():
            n = len(block.codes[item[k]])
            reach = n // 2 + STRIDE
            low = max(words.first[text[k]], at[k] - reach)
            high = min(words.first[text[k] + 1], at[k] + max(WINDOW, n) + reach)
            if (text[k], item[k], low) == done:
                continue
            done = text[k], item[k], low
            around = words.hash[low:high].tolist()
            share = lcs_length(bits[item[k]], n, around) / n
            if share < min_lcs:
                continue
            m = max(len(block.answers[item[k]]), 1)
            answer = lcs_length(answer_bits[item[k]], m, around) / m
            if share < SURE and answer < MIN_ANSWER:
                continue
            found = share, answer, float(cosine[k]), int(at[k] - words.first[text[k]])
            key = int(text[k]), int(item[k])
            if key not in best or found[:2] > best[key][:2]:
                best[key] = found
        return best

    return find


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns and other rows unchanged.

    Each row is judged by its own text, so null and repeated ids are allowed.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = docs
    for block in _fitted_blocks(texts, items, item_col, item_text_col):
        out = out.mapInArrow(_clean_rows(block, text_col), docs.schema)
    return out


def _clean_rows(block: Block, text_col: str):
    """A mapInArrow function that keeps the rows whose text holds none of a block's items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(block, MIN_COSINE, MIN_LCS)
        for batch in batches:
            for part in slices(batch, text_col):
                keep = np.ones(part.num_rows, bool)
                keep[[t for t, _ in find(part.column(text_col))]] = False
                yield part.filter(pa.array(keep))

    return run
