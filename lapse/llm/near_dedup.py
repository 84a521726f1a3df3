"""Near-duplicate detection by HyperMinHash sketches, with every link confirmed on full sets.

A text's set holds its distinct five-word shingles. Texts with equal sets form a class (128-bit sum
over the set), and classes are compared, so exact copies cost nothing further.

1. Sketch: shingle hashes fall into registers; a register keeps the leading-zero
   count of its smallest hash and the ten bits after it (a 16-bit number).
2. Bands of four registers (empty ones borrow another's value) give candidate keys. In a key's group, one class (the pivot) is tried
   against the others and linked ones join its component. Afterwards only classes of different components are tried
   against each other, and of these only such whose distances from the pivot do not rule out a link.
3. A candidate whose Jaccard estimate (corrected for registers that agree by chance) is five standard
   errors below the bound is dropped; all others are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import WORD, partitions, staged
from lapse.llm.components import components
from lapse.llm.wordarrays import SLICE_BYTES, Words, mix, sequence_hashes, slices, split_words, window_hashes

SHINGLE = 5
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
#: Two unrelated registers agree if their leading zeros do (about one in three) and all mantissa bits do.
CHANCE = 1 / 3 / (1 << MANTISSA)
#: Members (and bytes of their packed texts) of a key that one part holds at most; a task compares two parts.
CELL_ROWS, CELL_BYTES = 2_048, 16 << 20


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, first): the distinct shingles of each text, sorted, and where each text's begin."""
    n = len(words.first) - 1
    code, valid = window_hashes(words, SHINGLE)
    text = words.text_of()
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    text = np.concatenate([text[valid], short])
    code = np.concatenate([code[valid], sequence_hashes(words)[short]])
    order = np.argsort(code)
    owner = text[order]
    if n <= 1 << 16:
        order = order[np.argsort(owner.astype(np.uint16), kind="stable")]
    else:
        order = order[np.argsort(owner, kind="stable")]
    text, code = text[order], code[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    text, code = text[new], code[new]
    return text, code, np.searchsorted(text, np.arange(n + 1))


def sketches(text: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """(n, REGISTERS) uint16: leading zeros and mantissa of each register's least hash; EMPTY if none."""
    code = mix(code ^ np.uint64(0xA24BAED4963EE407))
    place = text * REGISTERS + (code % np.uint64(REGISTERS)).astype(np.int64)
    least = np.full(n * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, place, code // np.uint64(REGISTERS))
    bits = (least + np.uint64(1)).astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA)
    out = (bits - np.uint64(1023 << MANTISSA)).astype(np.uint16)
    out[least == np.iinfo(np.uint64).max] = EMPTY
    return out.reshape(n, REGISTERS)


#: For each register, the order in which it looks for another to borrow from when it is empty.
_LENDERS = np.argsort(mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(77)).reshape(REGISTERS, REGISTERS), axis=1)


def dense(sketch: np.ndarray) -> np.ndarray:
    """Sketches whose empty registers hold the value of the first filled one in a fixed order of their own.

    So a short text's bands hold four values like a long one's, and texts that share one
    shingle of many do not meet in a band. Sketches without any value stay empty.
    """
    out = sketch.copy()
    for i in np.flatnonzero((sketch == EMPTY).any(1) & (sketch != EMPTY).any(1)).tolist():
        empty = np.flatnonzero(sketch[i] == EMPTY)
        filled = (sketch[i] != EMPTY)[_LENDERS[empty]]
        out[i, empty] = sketch[i, _LENDERS[empty, filled.argmax(1)]]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """(n, BANDS): a hash of each band's registers."""
    packed = np.ascontiguousarray(dense(sketch)).view(np.uint64).reshape(len(sketch), BANDS)
    return mix(packed ^ mix(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :])


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate, registers compared) for rows of sketches."""
    used = np.maximum(((a != EMPTY) | (b != EMPTY)).sum(1), 1)
    same = ((a == b) & (a != EMPTY)).sum(1)
    return (same / used - CHANCE) / (1 - CHANCE), used


def _sketched(texts: DataFrame, kind: str) -> DataFrame:
    """(doc_id, th, n, c, sketch); c identifies the set and is null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = part.num_rows
                text, code, first = shingle_sets(split_words(part.column("text"), lower=True))
                size = np.diff(first)
                sketch = sketches(text, code, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("th"), pa.array(size), _set_ids(text, code, size),
                     pa.array([bytes(s) if k else None for s, k in zip(sketch, size)], pa.binary())],
                    ["doc_id", "th", "n", "c", "sketch"])

    return texts.mapInArrow(run, f"doc_id {kind}, th long, n long, c binary, sketch binary")


def _set_ids(text: np.ndarray, code: np.ndarray, size: np.ndarray) -> pa.Array:
    """16 bytes per set: two sums of differently mixed hashes, and the size."""
    bounds = np.append(0, np.cumsum(size))
    out = []
    for salt in (np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1B54A32D192ED03)):
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(mix(code ^ salt), out=sums[1:])
        out.append(mix(sums[bounds[1:]] - sums[bounds[:-1]] + size.astype(np.uint64)))
    raw = np.column_stack(out).astype(">u8")
    return pa.array([r.tobytes() if k else None for r, k in zip(raw, size)], pa.binary())


def _bands(classes: DataFrame) -> DataFrame:
    """(key, c, n): a row per class and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = band_keys(_matrix(batch.column("sketch"))).ravel()
            take = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), batch.column("c").take(take), batch.column("n").take(take)], ["key", "c", "n"])

    return classes.select("c", "n", "sketch").mapInArrow(run, "key long, c binary, n long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _bounds(pairs: DataFrame, classes: DataFrame, bound: float) -> DataFrame:
    """(a, b, lo, hi): limits of each pair's Jaccard distance by its estimate."""
    side = classes.select("c", "sketch")
    joined = pairs.join(side.select(F.col("c").alias("a"), F.col("sketch").alias("sa")), "a").join(
        side.select(F.col("c").alias("b"), F.col("sketch").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near, used = estimate(_matrix(batch.column("sa")), _matrix(batch.column("sb")))
            slack = np.where(used < 16, 1.0, 2.5 / np.sqrt(used))  # five standard errors at any similarity
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(1 - near - slack), pa.array(1 - near + slack)], ["a", "b", "lo", "hi"])

    return joined.mapInArrow(run, "a binary, b binary, lo double, hi double")


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, z): the compressed text of one document of each wanted class (c, text_th, text_id)."""
    joined = texts.join(wanted, (texts.th == wanted.text_th) & texts.doc_id.eqNullSafe(wanted.text_id)).select("c", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, "text"):
                text, code, first = shingle_sets(split_words(part.column("text"), lower=True))
                ids = _set_ids(text, code, np.diff(first)).to_pylist()
                mine = [i for i, c in enumerate(part.column("c").to_pylist()) if c == ids[i]]  # hashes may collide
                raw = part.column("text").take(pa.array(mine, pa.int64())).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("c").take(pa.array(mine, pa.int64())),
                     pa.array([press.compress(t.encode("utf-8", "surrogatepass")) for t in raw], pa.binary())], ["c", "z"])

    return joined.mapInArrow(run, "c binary, z binary")


def _distances(pairs: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """(a, b, lo, hi, linked): the pairs' Jaccard distance (lo = hi) on full shingle sets, and whether
    100 * intersection >= percent * union."""
    joined = pairs.join(packed.select(F.col("c").alias("a"), F.col("z").alias("za")), "a").join(
        packed.select(F.col("c").alias("b"), F.col("z").alias("zb")), "b").select("a", "b", "za", "zb")

    def measured(za: list[bytes], zb: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # a text that stands in many pairs of the batch is taken apart once
        texts = list(dict.fromkeys([*za, *zb]))
        sets = dict(zip(texts, _sets_of(texts)))
        size = np.array([(len(sets[a]), len(sets[b])) for a, b in zip(za, zb)]).reshape(-1, 2)
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(za, zb)], np.int64)
        union = size.sum(1) - both
        return 1 - both / np.maximum(union, 1), 100 * both >= percent * union

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            za, zb = batch.column("za").to_pylist(), batch.column("zb").to_pylist()
            at = 0
            while at < len(za):
                to, size, seen = at, 0, set()
                while to < len(za) and (to == at or size < SLICE_BYTES):
                    for z in {za[to], zb[to]} - seen:
                        size += zstandard.frame_content_size(z)
                        seen.add(z)
                    to += 1
                far, linked = measured(za[at:to], zb[at:to])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").slice(at, to - at), batch.column("b").slice(at, to - at), pa.array(far), pa.array(far),
                     pa.array(linked)], ["a", "b", "lo", "hi", "linked"])
                at = to

    return joined.sortWithinPartitions("a").mapInArrow(run, "a binary, b binary, lo double, hi double, linked boolean")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _cross_links(members: DataFrame, packed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join different labels among the members (key, c, n, label, lo, hi) of each key.

    A key's members are dealt into parts of bounded size, and a task compares one part with one part. Within
    it, pairs are ruled out by label, by size, by their distances from the key's pivot (Jaccard distance is a metric,
    so two texts are at least as far apart as their distances from a third differ) and by estimate; the
    rest are confirmed on full sets, likeliest first, unless links found so far already connect them. Only
    links leave the task. A pair is looked at under the first band that it shares, and under no other.
    """
    parts = members.join(packed.select("c", F.octet_length("z").alias("bytes")), "c").groupBy("key").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / CELL_ROWS), F.ceil(F.sum("bytes") / CELL_BYTES)).cast("int").alias("parts"))
    parts = staged(parts, "near-parts")
    rows = members.join(parts, "key").join(packed, "c").join(classes.select("c", "sketch"), "c")
    own = F.pmod(F.xxhash64("c"), F.col("parts")).cast("int")
    rows = rows.withColumn("own", own).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("key", F.least("own", "j").alias("i"), F.greatest("own", "j").alias("j"), "own", "c", "n", "label", "lo", "hi", "sketch", "z")
    n = partitions(members.sparkSession)
    rows = rows.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*rest, batch]).combine_chunks()
            cell = np.column_stack([table.column(k).to_numpy() for k in ("key", "i", "j")])
            edge = np.flatnonzero((cell[1:] != cell[:-1]).any(1)) + 1 if len(cell) else np.zeros(0, int)
            for low, high in zip(np.append(0, edge[:-1]), edge):
                yield from _cell_links(table.slice(low, high - low), percent)
            last = int(edge[-1]) if len(edge) else 0
            rest = table.slice(last).combine_chunks().to_batches()
        if rest:
            yield from _cell_links(pa.Table.from_batches(rest), percent)

    return rows.mapInArrow(run, "a binary, b binary")


def _cell_links(cell: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between the rows of one cell; see _cross_links."""
    if cell.num_rows < 2:
        return
    bound = percent / 100
    cell = cell.combine_chunks()
    one = lambda name: cell.column(name).chunk(0)
    num = lambda name: one(name).to_numpy()
    labels = one("label").to_pylist()
    root = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    if len(root) < 2:
        return
    label = np.array([root[x] for x in labels])
    n, lo, hi, own = num("n"), num("lo"), num("hi"), num("own")
    same_part = num("i")[0] == num("j")[0]
    sketch, far = _matrix(one("sketch")), 1 - bound + 1e-9
    found_a, found_b, found_e = [], [], []
    for x in range(cell.num_rows - 1):
        y = np.arange(x + 1, cell.num_rows)
        y = y[(label[y] != label[x]) & (4 * np.minimum(n[y], n[x]) >= 3 * np.maximum(n[y], n[x])) & (lo[y] - hi[x] <= far)
              & (lo[x] - hi[y] <= far) & (same_part | (own[y] != own[x]))]
        if len(y):
            near, used = estimate(sketch[x][None, :], sketch[y])
            y, near = y[near >= bound - _slack(used, bound)], near[near >= bound - _slack(used, bound)]
            found_a.append(np.full(len(y), x))
            found_b.append(y)
            found_e.append(near)
    if not found_a or not sum(map(len, found_a)):
        return
    a, b, e = np.concatenate(found_a), np.concatenate(found_b), np.concatenate(found_e)
    keys = band_keys(sketch)
    common = keys[a] == keys[b]
    first = keys[a, common.argmax(1)] == np.int64(num("key")[0]).astype(np.uint64)
    a, b, e = a[first], b[first], e[first]
    used = np.unique(np.concatenate([a, b]))
    sets = dict(zip(used.tolist(), _sets_of([one("z")[int(i)].as_py() for i in used])))
    parent = list(range(len(root)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for k in np.argsort(-e, kind="stable").tolist():
        p, q = find(label[a[k]]), find(label[b[k]])
        if p == q:
            continue
        x, y = sets[int(a[k])], sets[int(b[k])]
        both = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * both >= percent * (len(x) + len(y) - both):
            parent[q] = p
            out.append(k)
    if out:
        c = one("c")
        yield pa.RecordBatch.from_arrays([c.take(pa.array(a[out])), c.take(pa.array(b[out]))], ["a", "b"])


def _slack(used: np.ndarray, bound: float) -> np.ndarray:
    """Five standard errors of an estimate near the bound; no limit where few registers are filled."""
    return np.where(used < 16, 1.0, 5 * np.sqrt(bound * (1 - bound) / used))


def _sets_of(packed: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of compressed texts, some MB of text at a time."""
    unpack = zstandard.ZstdDecompressor()
    at = 0
    while at < len(packed):
        to, size = at, 0
        while to < len(packed) and (to == at or size < SLICE_BYTES):
            size += zstandard.frame_content_size(packed[to])
            to += 1
        raw = pa.array([unpack.decompress(z) for z in packed[at:to]], pa.large_binary()).view(pa.large_string())
        _, code, first = shingle_sets(split_words(raw, lower=True))
        yield from (code[i:j] for i, j in zip(first, first[1:]))
        at = to


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Texts are lower-cased A-Z. Texts of fewer than five words are one shingle. Null, empty and blank texts
    have no set, link to nothing and stay. A null id ranks above all others as component id. Rows that
    repeat an id and a text are one class and both carry the result. An empty table gives an empty
    result. Other columns are ignored. ``percent`` must be at least 75 (sizes are compared by that bound).
    """
    rows, labelled = _labelled(docs, id_col, text_col, percent)
    heads = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = labelled.join(heads, "label").select("c", "component_id")
    out = rows.select("doc_id", "n", "c").join(named, "c", "left")
    owner = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), owner.alias("component_id"),
                      F.col("doc_id").eqNullSafe(owner).alias("kept"))


def _labelled(docs: DataFrame, id_col: str, text_col: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, th, n, c) of all documents, and classes (c, rep, label) with their component."""
    if percent < 75:
        raise ValueError("the bands are laid out for 75 percent and more")
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("th", F.xxhash64("text"))
    rows = staged(_sketched(texts, kind), "near-rows")
    with_set = rows.where("c is not null")
    # a class's text is found again by the text's hash and, of its copies, the least id
    least = with_set.groupBy("c", "th").agg(F.min("doc_id").alias("rid")).groupBy("c").agg(
        F.min("rid").alias("rep"), F.min("th").alias("text_th"), F.min_by("rid", "th").alias("text_id"))
    least = staged(least, "near-classes")
    classes = staged(with_set.dropDuplicates(["c"]).select("c", "n", "sketch"), "near-sketches")
    edges = _edges(texts, classes, least, percent)
    least = least.select("c", "rep")
    if edges is None:
        return rows, least.withColumn("label", F.col("c"))
    labels = components(edges).withColumnRenamed("node", "c")
    return rows, least.join(labels, "c", "left").select("c", "rep", F.coalesce("label", "c").alias("label"))


def _edges(texts: DataFrame, classes: DataFrame, least: DataFrame, percent: int) -> DataFrame | None:
    """Confirmed links (a, b) that connect every linked pair of classes, directly or by a path."""
    bound = percent / 100
    bands = _bands(classes)
    groups = bands.groupBy("key").agg(F.min("c").alias("pivot"), F.count(F.lit(1)).alias("m")).where("m > 1")
    groups = staged(groups, "near-groups")  # a table of its own: Spark can split a hot key's side of the join
    # only keys of at least two classes matter from here on
    members = staged(bands.join(groups.select("key", "pivot"), "key"), "near-members")
    if members.isEmpty():
        return None
    wanted = least.join(members.select("c").distinct(), "c")
    packed = staged(_texts_of(texts, wanted).dropDuplicates(["c"]), "near-texts")

    def tried(pairs: DataFrame) -> DataFrame:
        """(a, b, lo, hi, linked) of all pairs; those that cannot be linked keep the limits of their estimate."""
        rough = staged(_bounds(pairs, classes, bound), "near-bounds")
        near = F.col("lo") <= 1 - bound + 1e-9
        exact = _distances(rough.where(near).select("a", "b"), packed, percent)
        return staged(exact.unionByName(rough.where(~near).withColumn("linked", F.lit(False))), "near-tried")

    def labelled(rows: DataFrame) -> DataFrame:
        labels = components(edges).withColumnRenamed("node", "c")
        return rows.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))

    stars = tried(_ordered(members.select(F.col("pivot").alias("a"), F.col("c").alias("b"))))
    edges = stars.where("linked").select("a", "b")
    spans = stars.select(F.col("a").alias("x"), F.col("b").alias("y"), "lo", "hi").union(stars.select("b", "a", "lo", "hi"))
    members = members.join(spans, (members.pivot == spans.x) & (members.c == spans.y), "left").select(
        "key", "c", "n", F.coalesce("lo", F.lit(0.0)).alias("lo"), F.coalesce("hi", F.lit(0.0)).alias("hi"))
    left = labelled(members)
    mixed = left.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(
        F.count(F.lit(1)).alias("labels")).where("labels > 1")
    left = staged(left.join(staged(mixed, "near-mixed"), "key"), "near-left")
    links = _cross_links(left.drop("labels"), packed, classes, percent)
    return staged(edges.union(links).distinct(), "near-edges")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``docs`` with one document of each component, all columns unchanged: the one with the smallest id.

    Documents without words all stay. A null id comes after all others; among null ids the text's hash decides. Of rows that
    repeat the kept id and text, the one whose columns sort first stays.
    """
    rows, labelled = _labelled(docs, id_col, text_col, percent)
    by = F.struct(F.col("doc_id").isNull(), "doc_id", "th")
    heads = rows.where("c is not null").select("c", by.alias("by")).groupBy("c").agg(F.min("by").alias("by"))
    heads = labelled.join(heads, "c").groupBy("label").agg(F.min("by").alias("by"))
    heads = staged(heads.select(F.col("by.doc_id").alias("kid"), F.col("by.th").alias("kth")), "near-heads")
    # a struct of the whole row: columns of any name cannot clash with the working ones
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.col(id_col).alias("id"),
                       F.xxhash64(text).alias("th"), (~text.rlike(WORD)).alias("blank"))
    kept = held.where("not blank").join(heads, (held.th == heads.kth) & held.id.eqNullSafe(heads.kid), "left_semi")
    first = F.row_number().over(Window.partitionBy("th", "id").orderBy("r"))
    kept = kept.withColumn("nth", first).where("nth = 1")
    return held.where("blank").select("r.*").unionByName(kept.select("r.*"))
