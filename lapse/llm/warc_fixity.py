"""Fixity audit of archive replicas by Merkle trees over records and offset ranges.

A replica is a table of records (file, offset, length, sha256). Records are hashed into ranges of
``RANGE_BYTES`` of offsets, ranges into wider ranges (``FANOUT`` at a time) up to one root per file, and
files, by the digits of a hash of their name, up to one root of the collection. The audit compares
the roots and goes down only into branches whose hashes differ, to the records that differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import staged

#: A range holds a bounded number of records, as a record has a header of some 200 bytes at least.
RANGE_BYTES, FANOUT = 64 << 10, 16
#: Records per archive file, about.
FILE_RECORDS = 2_048


def record_of(url: Column, body: Column, record_id: Column) -> Column:
    """A WARC/1.1 response record as text; null parts count as empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    name = F.md5(F.concat_ws("|", F.coalesce(record_id.cast("string"), F.lit("")), url))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:md5:"), name, F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.sha2(body, 256), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
            file_records: int = FILE_RECORDS, copied: Callable[[Column], Column] | None = None) -> DataFrame:
    """(record_id, url, file, offset, length, sha256): pages laid out as records of WARC files.

    With ``copied``, a function from a record's text to what a copy of the archive holds in its place (null: nothing),
    copy_length and copy_sha256 follow; the copy's records stand at the same offsets.

    Files are named by leading digits of the MD5 of id and url, as many as leave about ``file_records``
    records a file; inside a file, records stand in order of id (nulls first), url and hash. Rows that
    repeat in all three lie one after another. Null urls and bodies count as empty.
    """
    text_id = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(url_col), F.lit("")))
    digits = 1
    total = pages.count()
    while total > file_records * 16 ** digits:
        digits += 1
    record = record_of(F.col(url_col), F.col(body_col), F.col(id_col))
    rows = pages.select(F.col(id_col).alias("record_id"), F.col(url_col).alias("url"),
                        F.substring(F.md5(text_id), 1, digits).alias("file"), record.alias("record"))
    rows = rows.withColumns({"length": F.octet_length("record").cast("long"), "sha256": F.sha2("record", 256)})
    if copied is not None:
        rows = rows.withColumn("copy", copied(F.col("record")))
        rows = rows.withColumns({"copy_length": F.octet_length("copy").cast("long"), "copy_sha256": F.sha2("copy", 256)})
    # only the narrow columns are dealt out by file
    rows = rows.drop("record", "copy")
    order = Window.partitionBy("file").orderBy(F.col("record_id").asc_nulls_first(), F.col("url").asc_nulls_first(), "sha256")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("offset", F.coalesce(before, F.lit(0)).cast("long"))


def _join_hash(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ";"), 256)


def tree(records: DataFrame, depth: int) -> list[DataFrame]:
    """Tables of nodes, leaves first: (file, node, parent, hash), then (file "", node, parent, hash) for files.

    Level 0 has the records, levels 1 to ``depth`` the offset ranges, the last of them one root per file;
    further levels shorten a hash of the file name digit by digit, to the collection's root.
    """
    leaves = records.select("file", F.col("offset").alias("node"), F.floor(F.col("offset") / RANGE_BYTES).alias("parent"),
                            F.concat_ws(":", F.col("length").cast("string"), "sha256").alias("hash"))
    # rows at one offset are one leaf
    levels = [leaves.groupBy("file", "node", "parent").agg(F.array_join(F.array_sort(F.collect_list("hash")), ",").alias("hash"))]
    for _ in range(depth):
        entry = F.struct("node", "hash")
        up = levels[-1].groupBy("file", F.col("parent").alias("node")).agg(_join_hash(F.transform(
            F.array_sort(F.collect_list(entry)), lambda x: F.concat_ws(":", x["node"].cast("string"), x["hash"]))).alias("hash"))
        levels.append(staged(up.select("file", "node", F.floor(F.col("node") / FANOUT).alias("parent"), "hash"), "merkle"))
    return levels


def name_levels(roots: DataFrame, digits: int) -> list[DataFrame]:
    """Levels above the file roots: (name, parent, hash), shortening the hashed name by a digit each."""
    name = F.md5(F.col("file"))
    levels = [roots.select("file", name.alias("name"), F.substring(name, 1, digits).alias("parent"), "hash")]
    for d in range(digits - 1, -2, -1):
        up = levels[-1].groupBy(F.col("parent").alias("name")).agg(_join_hash(F.transform(F.array_sort(F.collect_list(
            F.struct("name", "hash"))), lambda x: F.concat_ws(":", x["name"], x["hash"]))).alias("hash"))
        levels.append(staged(up.withColumn("parent", F.substring("name", 1, max(d, 0))), "merkle"))
    return levels


def audit(mine: DataFrame, other: DataFrame) -> DataFrame:
    """(file, offset, mine, other) of the records that differ: "length:sha256" on either side, null where missing.

    Both tables have file, offset, length and sha256, not null. Equal replicas give an empty result after one
    comparison of roots; an empty replica lacks every record of the other. Other columns are ignored.
    """
    far, files = mine.select("file", "offset").unionByName(other.select("file", "offset")).agg(
        F.max("offset"), F.approx_count_distinct("file")).first()
    depth = 1
    while RANGE_BYTES * FANOUT ** (depth - 1) <= (far or 0):
        depth += 1
    digits = 0
    while FANOUT ** (digits + 1) < files:
        digits += 1
    sides = []
    for side in (mine, other):
        levels = tree(side, depth)
        sides.append((levels, name_levels(levels[-1], digits)))
    keys, wrong = ["name"], None
    for a, b in zip(reversed(sides[0][1]), reversed(sides[1][1])):  # from the collection's root to the files
        wrong = _differing(a, b, keys, wrong, ["parent"], ["name"])
        if wrong.isEmpty():
            return mine.sparkSession.createDataFrame([], "file string, offset long, mine string, other string")
    # the lowest of these levels are the file roots, under their real names
    names = sides[0][1][0].select("file", "name").unionByName(sides[1][1][0].select("file", "name")).distinct()
    wrong = names.join(wrong, "name").select("file", F.lit(0).cast("long").alias("node"))
    for level in range(depth - 1, -1, -1):
        wrong = _differing(sides[0][0][level], sides[1][0][level], ["file", "node"], wrong, ["file", "parent"], ["file", "node"],
                           keep=level == 0)
    return wrong.select("file", F.col("node").alias("offset"), "mine", "other")


def _differing(a: DataFrame, b: DataFrame, keys: list[str], wrong: DataFrame | None, parent: list[str], above: list[str],
               keep: bool = False) -> DataFrame:
    """Keys of nodes below ``wrong`` whose hashes differ or that one side lacks."""
    if wrong is not None:
        branch = wrong.select(*[F.col(c).alias(p) for c, p in zip(above, parent)])
        a, b = (x.join(branch, parent, "left_semi") for x in (a, b))
    both = a.select(*keys, F.col("hash").alias("mine")).join(b.select(*keys, F.col("hash").alias("other")), keys, "full")
    return staged(both.where(~F.col("mine").eqNullSafe(F.col("other"))).select(*keys, *(["mine", "other"] if keep else [])), "merkle-diff")
