"""Removal of repeated passages: every word covered by a window that starts elsewhere too.

A window is ``size`` consecutive words. Which windows recur is found without shuffling all of them:

1. Anchors. Of a window's short word runs (``RUN`` words) the one with the smallest hash is its anchor. Equal
   windows have equal anchors, so only windows whose anchor occurs in two places can recur. About
   one run in fourteen is an anchor, and only anchors are counted over the whole corpus.
2. Segments. Maximal stretches of windows with recurring anchors are cut out of one document per
   distinct text. All further work is on these.
3. Passages. Windows of the segments are counted by a 96-bit hash. Recurring windows that always follow one
   another (the same next and the same previous word in all places) are joined to a passage,
   so wherever one word of a passage's windows occurs, the whole passage does.
4. Automata. Segments are dealt into batches of bounded size; each batch compiles an Aho-Corasick automaton of the
   passages that share an anchor with it, and streams its segments through it. The matches, exact
   on the words themselves, give the words to remove.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import staged
from lapse.llm.wordarrays import Words, mix, sequence_hashes, slices, split_words, window_hashes

SIZE = 35
#: Words of an anchor run.
RUN = 8
#: Bytes of segment text that share one automaton.
BATCH_BYTES = 512 << 10
#: Windows of a segment at most; longer stretches continue in another segment, which shares words but no window.
SEGMENT_WINDOWS = 20_000


def joined_words(words: Words, keep: np.ndarray | None = None) -> list[bytes]:
    """Each text's (kept) words joined by one space."""
    inside = words.inside
    if keep is not None:
        change = np.zeros(len(words.data) + 1, np.int8)
        change[words.start[keep]] += 1
        np.subtract.at(change, words.end[keep], 1)
        inside = np.cumsum(change[:-1], dtype=np.int8) > 0
    # a word's bytes and the separator after it, which becomes the space
    taken = inside.copy()
    taken[1:] |= inside[:-1]
    heads = words.bounds[:-1][words.bounds[:-1] < len(taken)]
    taken[heads] = inside[heads]  # a text does not begin with the separator after another text
    spaced = np.where(inside, words.data, np.uint8(32))
    if taken.all():  # single separators throughout
        upto = words.bounds.tolist()
    else:
        upto = np.append(0, np.cumsum(taken))[words.bounds].tolist()
        spaced = spaced[taken]
    raw = spaced.tobytes()
    return [raw[a:b - (b > a and raw[b - 1] == 32)] for a, b in zip(upto, upto[1:])]


def text_keys(words: Words) -> pa.Array:
    """16 bytes that stand for each text's word sequence."""
    raw = np.column_stack([sequence_hashes(words, 1), sequence_hashes(words, 2)]).astype(">u8")
    return pa.array([r.tobytes() for r in raw], pa.binary())


def _sliding(values: np.ndarray, width: int, reduce: np.ufunc) -> np.ndarray:
    """``reduce`` over each stretch of ``width`` values (as many results as whole stretches)."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = reduce(values[:len(values) - step], values[step:])
        done += step
    return values


def anchors(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least, is_anchor, run_hash): each whole window's least run hash (0 for other places), which word
    positions begin such a run, and the run hashes. Equal runs in a window are all anchors."""
    run = min(RUN, size)
    code, _ = window_hashes(words, run, salt=11)
    code |= np.uint64(1)  # never 0
    n, spread = len(code), size - run + 1
    least = np.zeros(n, np.uint64)
    if n >= size:
        least[:n - spread + 1] = _sliding(code, spread, np.minimum)
    left = words.first[1:][words.text_of()] - np.arange(n)
    least[left < size] = 0
    # a run is an anchor if some window that holds it has it as its least one
    most = _sliding(np.append(np.zeros(spread - 1, np.uint64), least), spread, np.maximum)
    return least, most == code, code


def _ranges_mask(n: int, ranges: list) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    for a, b in ranges:
        change[a] += 1
        change[b] -= 1
    return np.cumsum(change)[:n] > 0


def _document_rows(texts: DataFrame, kind: str, size: int) -> DataFrame:
    """(doc_id, key, n_words, sha, hashes, places): one row per document, with its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                _, is_anchor, code = anchors(words, size)
                chosen = np.flatnonzero(is_anchor)
                first = np.searchsorted(chosen, words.first)
                text = words.text_of()[chosen]
                offsets = pa.array(first, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), text_keys(words), pa.array(words.counts),
                     pa.array([hashlib.sha256(t).hexdigest() for t in joined_words(words)], pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(code[chosen].view(np.int64))),
                     pa.ListArray.from_arrays(offsets, pa.array((chosen - words.first[text]).astype(np.int32)))],
                    ["doc_id", "key", "n_words", "sha", "hashes", "places"])

    return texts.mapInArrow(run, f"doc_id {kind}, key binary, n_words long, sha string, hashes array<long>, places array<int>")


def _packed(texts: DataFrame, kind: str) -> DataFrame:
    """(doc_id, key, z): compressed texts, so that joins on them shuffle less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), text_keys(words), pa.array([press.compress(t) for t in joined_words(words)], pa.binary())],
                    ["doc_id", "key", "z"])

    return texts.mapInArrow(run, f"doc_id {kind}, key binary, z binary")


def _unpacked(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([unpack.decompress(z) for z in column.to_pylist()], pa.large_binary()).view(pa.large_string())


def _chunks(batch: pa.RecordBatch, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose packed texts ``z`` hold about ``max_bytes`` (one text at least)."""
    size = np.cumsum([zstandard.frame_content_size(z) for z in batch.column("z").to_pylist()])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + max_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _segments(docs: DataFrame, size: int) -> DataFrame:
    """(key, start, t, size, z): stretches of windows whose anchors recur; t stands for the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in _chunks(batch):
                words = split_words(_unpacked(part.column("z")))
                least, _, code = anchors(words, size)
                places = part.column("places")
                row = np.repeat(np.arange(part.num_rows), [len(p) for p in places])
                at = words.first[row] + np.concatenate([np.asarray(p.values) for p in places])
                recurring = np.unique(code[at])
                found = np.minimum(np.searchsorted(recurring, least), len(recurring) - 1)
                # a text's anchors that recur elsewhere recur wherever they are
                flag = np.append((recurring[found] == least) & (least != 0), False).astype(np.int8)
                edge = np.flatnonzero(np.diff(np.append(0, flag)))
                starts, stops = [], []
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    for c in range(a, b, SEGMENT_WINDOWS):
                        starts.append(c)
                        stops.append(min(c + SEGMENT_WINDOWS, b) + size - 1)
                if not starts:
                    continue
                raw, text = words.data.tobytes(), words.text_of()[starts]
                cut = [raw[a:b] for a, b in zip(words.start[starts].tolist(), words.end[np.array(stops) - 1].tolist())]
                own = split_words(pa.array(cut, pa.large_binary()).view(pa.large_string()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(text)), pa.array(np.array(starts) - words.first[text]), text_keys(own),
                     pa.array([len(c) for c in cut], pa.int64()), pa.array([press.compress(c) for c in cut], pa.binary())],
                    ["key", "start", "t", "size", "z"])

    return docs.mapInArrow(run, "key binary, start long, t binary, size long, z binary")


def _windows(parts: DataFrame, size: int) -> DataFrame:
    """(w, v, after, before, t, at, times): each window of each distinct segment, with the words around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                words = split_words(_unpacked(part.column("z")))
                w, valid = window_hashes(words, size, salt=1)
                v, _ = window_hashes(words, size, salt=2)
                text = words.text_of()
                n = len(w)
                at = np.flatnonzero(valid)
                code = (words.hash | np.uint64(1)).view(np.int64)  # 0 stands for no word
                after = np.zeros(n, np.int64)
                more = at[at + size < words.first[1:][text[at]]]
                after[more] = code[more + size]
                before = np.zeros(n, np.int64)
                later = at[at > words.first[text[at]]]
                before[later] = code[later - 1]
                take = pa.array(text[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[at].view(np.int64)), pa.array(v[at].astype(np.uint32).view(np.int32)), pa.array(after[at]), pa.array(before[at]),
                     part.column("tid").take(take), pa.array((at - words.first[text[at]]).astype(np.int32)), part.column("times").take(take)],
                    ["w", "v", "after", "before", "tid", "at", "times"])

    return parts.select("tid", "z", "times").mapInArrow(run, "w long, v int, after long, before long, tid long, at int, times long")


def _passages(parts: DataFrame, size: int) -> DataFrame:
    """(anchor, words, passage) of segments that own recurring windows (at, to_next, to_last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                words = split_words(_unpacked(part.column("z")))
                least, _, _ = anchors(words, size)
                wins = part.column("wins")
                row = np.repeat(np.arange(part.num_rows), [len(w) for w in wins])
                flat = pa.concat_arrays([w.values for w in wins])
                at, to_next, to_last = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                at = at + words.first[row]
                order = np.argsort(at)
                at, to_next, to_last = at[order], to_next[order], to_last[order]
                # a passage goes on while its windows always follow one another
                goes_on = (at[1:] == at[:-1] + 1) & to_next[:-1] & to_last[1:]
                begin, stop = at[np.append(True, ~goes_on)], at[np.append(~goes_on, True)] + size
                raw = words.data.tobytes()
                out = [raw[a:b] for a, b in zip(words.start[begin].tolist(), words.end[stop - 1].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(least[begin].view(np.int64)), pa.array(stop - begin), pa.array(out, pa.binary())],
                                                 ["anchor", "words", "passage"])

    return parts.mapInArrow(run, "anchor long, words long, passage binary")


def _segment_anchors(parts: DataFrame, size: int) -> DataFrame:
    """(batch, anchor): the anchors of each batch's segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                words = split_words(_unpacked(part.column("z")))
                _, is_anchor, code = anchors(words, size)
                chosen = np.flatnonzero(is_anchor)
                yield pa.RecordBatch.from_arrays(
                    [part.column("batch").take(pa.array(words.text_of()[chosen])), pa.array(code[chosen].view(np.int64))], ["batch", "anchor"])

    return parts.select("batch", "z").mapInArrow(run, "batch long, anchor long").distinct()


def _matched(segments: pa.Table, passages: pa.Table) -> pa.Table:
    """(t, ranges): the word ranges of each segment that passages cover, found by one automaton."""
    if not passages.num_rows:
        return pa.table({"t": pa.array([], pa.binary()), "ranges": pa.array([], pa.list_(pa.list_(pa.int64())))})
    automaton = ahocorasick.Automaton()
    for text, n in zip(passages.column("passage").to_pylist(), passages.column("words").to_pylist()):
        automaton.add_word(f" {text.decode('utf-8', 'surrogatepass')} ", n)
    automaton.make_automaton()
    unpack = zstandard.ZstdDecompressor()
    out = []
    for z in segments.column("z").to_pylist():
        text = f" {unpack.decompress(z).decode('utf-8', 'surrogatepass')} "
        ends, lengths = [], []
        for end, n in automaton.iter(text):
            ends.append(end)
            lengths.append(n)
        if not ends:
            out.append([])
            continue
        spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        stop = np.searchsorted(spaces, ends)
        start = stop - np.array(lengths)
        order = np.argsort(start)
        start, reach = start[order], np.maximum.accumulate(stop[order])
        new = np.append(True, start[1:] > reach[:-1])
        first = np.flatnonzero(new)
        out.append([list(x) for x in zip(start[first].tolist(), reach[np.append(first[1:], len(start)) - 1].tolist())])
    return pa.table({"t": segments.column("t"), "ranges": pa.array(out, pa.list_(pa.list_(pa.int64())))})


def _kept(docs: DataFrame) -> DataFrame:
    """(key, n_removed, kept_sha256) from (key, z, ranges)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digest = [], []
            for row in range(batch.num_rows):
                words = split_words(_unpacked(batch.column("z").slice(row, 1)))
                gone = _ranges_mask(len(words.start), batch.column("ranges")[row].as_py())
                removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(joined_words(words, ~gone)[0]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                                             ["key", "n_removed", "kept_sha256"])

    return docs.select("key", "z", "ranges").mapInArrow(run, "key binary, n_removed long, kept_sha256 string")


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, ranges, packed): per document its key and size; per key the repeated word ranges; and the texts by key.

    rows: doc_id, key, n_words, sha. ranges: doc_id (one document of the key), key, ranges, an array of
    [first word, one past the last]. packed: doc_id, key, z (words joined by one space, zstandard).
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = staged(_document_rows(texts, kind, size), "rep-rows")
    keys = staged(rows.where(F.col("n_words") >= size).groupBy("key", "n_words").agg(
        F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("rep")), "rep-keys")
    places = rows.select(F.xxhash64("key").alias("k"), F.explode(F.arrays_zip("hashes", "places")).alias("x")).select(
        "k", F.col("x.hashes").alias("h"), F.col("x.places").alias("place"))
    spot = F.xxhash64("k", "place")
    often = places.groupBy("h").agg(F.min(spot).alias("lo"), F.max(spot).alias("hi")).where("lo != hi").select("h")
    often = staged(often, "rep-anchors")  # a table of its own: Spark can split a hot anchor's side of the join
    held = places.join(often, "h").groupBy("k").agg(F.collect_set("place").alias("places"))
    held = held.join(keys.select("key", "rep", F.xxhash64("key").alias("k")), "k").select(
        F.col("key").alias("hkey"), "rep", "places")
    packed = _packed(texts, kind)
    cut = packed.join(held, (packed.key == held.hkey) & packed.doc_id.eqNullSafe(held.rep)).select("key", "places", "z")
    segments = staged(_segments(cut, size).dropDuplicates(["key", "start"]), "rep-segments")
    total = segments.agg(F.sum("size")).first()[0] or 0
    n_batches = int(total // BATCH_BYTES) + 1
    # equal segments are one part; times counts them
    parts = segments.groupBy("t").agg(F.count(F.lit(1)).alias("times"), F.first("z").alias("z"))
    parts = staged(parts.withColumns({"tid": F.xxhash64("t"), "batch": F.pmod(F.xxhash64("t", F.lit(1)), F.lit(n_batches))}), "rep-parts")
    often = _windows(parts, size).groupBy("w", "v").agg(
        F.sum("times").alias("times"), F.min("after").alias("a0"), F.max("after").alias("a1"), F.min("before").alias("b0"),
        F.max("before").alias("b1"), F.min("tid").alias("tid"), F.min_by("at", "tid").alias("at")).where("times > 1")
    owned = often.groupBy("tid").agg(F.collect_list(F.struct(
        "at", (F.col("a0") == F.col("a1")).alias("to_next"), (F.col("b0") == F.col("b1")).alias("to_last"))).alias("wins"))
    passages = staged(_passages(parts.join(owned, "tid").select("z", "wins"), size), "rep-passages")
    dealt = passages.join(_segment_anchors(parts, size), "anchor").select("batch", "words", "passage").distinct()
    matches = parts.select("batch", "t", "z").groupBy("batch").cogroup(dealt.groupBy("batch")).applyInArrow(
        _matched, "t binary, ranges array<array<long>>")
    matches = matches.where(F.size("ranges") > 0)
    found = segments.select("key", "start", "t").join(matches, "t").select(
        "key", F.explode("ranges").alias("r"), "start").select(
        "key", F.array(F.col("r")[0] + F.col("start"), F.col("r")[1] + F.col("start")).alias("r"))
    found = found.groupBy("key").agg(F.collect_set("r").alias("ranges"))
    # texts that occur twice are repeated from end to end
    copied = keys.where("times > 1").select("key", "rep", F.array(F.array(F.lit(0).cast("long"), F.col("n_words"))).alias("ranges"))
    single = keys.where("times = 1").join(found, "key").select("key", "rep", "ranges")
    ranges = staged(copied.unionByName(single).withColumnRenamed("rep", "doc_id"), "rep-ranges")
    return rows.select("doc_id", "key", "n_words", "sha"), ranges, packed


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).

    Words are runs without the six ASCII separators, compared unchanged. Null and empty texts have no words, and texts
    shorter than a window lose none. Rows that repeat a text lose all of it if it holds a window. Null and
    repeated ids are allowed. An empty table gives an empty result. Other columns are ignored.
    """
    rows, ranges, packed = repeated_ranges(docs, id_col, text_col, size)
    whole = F.expr("exists(ranges, r -> r[0] = 0 and r[1] = n_words)")
    sized = ranges.join(rows.select("key", "n_words").distinct(), "key")
    gone = sized.where(whole).select("key", F.col("n_words").alias("n_removed"),
                                     F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"))
    partly = sized.where(~whole).select(F.col("key").alias("rkey"), F.col("doc_id").alias("rep"), "ranges")
    some = _kept(packed.join(partly, (packed.key == partly.rkey) & packed.doc_id.eqNullSafe(partly.rep)))
    changed = gone.unionByName(some.dropDuplicates(["key"]))
    return rows.join(changed, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
