"""Exact deduplication by 128-bit content hash with a byte comparison inside groups.

1. One narrow row per document: id, MD5 (128 bits) and length of the normalised text.
   Texts are not shuffled for this; a group's count and keeper come from a partial
   (map-side) aggregate, so a group holding a third of all rows costs one row per task.
2. Only hashes that occur more than once are looked at again: each member's bytes are
   compared with the keeper's by an equi-join on the hash (Spark splits a hot hash's side).
3. Rows whose bytes differ from their keeper's (hash collisions) are grouped by the whole
   text instead; normally there are none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import lower_ascii, staged


def group_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 digest=F.md5) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. ``keep`` is ``smallest`` (the
    default, a stable id) or ``largest``. ``digest`` maps a string column to its hash (the
    tests pass a weak one to force collisions).

    Null texts count as empty; empty texts are a group like any other. A null id ranks
    below every other id. Rows that repeat an id and a text are all listed and counted, but one of
    them alone is kept. An empty table gives an empty result. Other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    pick = F.min if keep == "smallest" else F.max
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
    texts = texts.withColumns({"h": digest("norm"), "n": F.octet_length("norm")})
    rows = staged(texts.select("id", "h", "n", F.sha2("norm", 256).alias("text_sha256")), "exact-rows")
    copies = rows.groupBy("id", "h", "n", "text_sha256").agg(F.count(F.lit(1)).alias("times"))
    groups = copies.groupBy("h", "n").agg(pick("id").alias("keep_id"), F.sum("times").alias("group_size"))
    groups = staged(groups, "exact-groups")
    many = groups.where("group_size > 1").select("h", "n", F.col("keep_id").alias("k"))
    odd = _unlike_keeper(texts, many)
    # collisions: (id, norm) rows unlike their keeper, grouped by the text itself
    odd = staged(odd, "exact-odd")
    exact = odd.groupBy("norm").agg(pick("id").alias("own_keep"), F.count(F.lit(1)).alias("own_size"))
    exact = odd.join(exact, "norm").select(F.col("id").alias("oid"), "h", F.sha2("norm", 256).alias("osha"),
                                           "own_keep", "own_size").distinct()
    lost = odd.groupBy("h", "n").agg(F.count(F.lit(1)).alias("odd_rows"))
    sized = groups.join(lost, ["h", "n"], "left").select(
        "h", "n", "keep_id", (F.col("group_size") - F.coalesce("odd_rows", F.lit(0))).alias("group_size"))
    each = copies.join(staged(sized, "exact-sized"), ["h", "n"]).join(
        exact, (copies.h == exact.h) & copies.id.eqNullSafe(exact.oid) & (copies.text_sha256 == exact.osha), "left")
    own = F.col("own_size").isNotNull()
    each = each.select(
        F.col("id").alias("doc_id"), F.when(own, F.col("own_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(own, F.col("own_size")).otherwise(F.col("group_size")).alias("group_size"), "text_sha256",
        F.posexplode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy", "_t"))
    return each.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                       (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
                       "text_sha256")


def _unlike_keeper(texts: DataFrame, many: DataFrame) -> DataFrame:
    """Members of groups whose bytes differ from those of the group's keeper: id, h, n, norm."""
    members = staged(texts.join(many, ["h", "n"]), "exact-members")  # every text is dealt out once
    keeper = members.where(F.col("id").eqNullSafe(F.col("k"))).groupBy("h", "n").agg(
        F.min("norm").alias("keeper_norm"))  # a repeated id may hold two texts of one hash
    keeper = staged(keeper, "exact-keepers")  # a table of its own: Spark can split a hot hash's side of the join
    return members.join(keeper, ["h", "n"]).where("norm != keeper_norm").select("id", "h", "n", "norm")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, every column unchanged.

    Of rows that repeat the kept id and text, the one whose columns sort first stays.
    """
    from pyspark.sql import Window

    # a struct of the whole row: columns of any name cannot clash with the working ones
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("r"), F.col(id_col).alias("id"), F.sha2(lower_ascii(F.coalesce(
        F.col(text_col), F.lit(""))), 256).alias("sha"))
    groups = group_copies(docs, id_col, text_col, keep).where("kept").select(
        F.col("doc_id").alias("kid"), F.col("text_sha256").alias("ksha"))
    out = held.join(groups, (held.sha == groups.ksha) & held.id.eqNullSafe(groups.kid), "left_semi")
    first = F.row_number().over(Window.partitionBy("sha", "id").orderBy(F.col("r")))
    return out.withColumn("nth", first).where("nth = 1").select("r.*")
