"""Registered queries of the llm operators: (spark, tables_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm import (code_cells, decontaminate, exact_dedup, hard_negatives, html_text, learned_partitions, license_scan, mixing, near_dedup, quality,
                       repeated_passages, toxicity, warc_fixity)
from lapse.llm.common import staged, table
from lapse.llm.sampling import fold_of


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold_of("doc_id", 3) == 1
    trees = quality.train(docs, labels.where(~held_out))
    return quality.score(docs, trees).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_copies(table(spark, sf_dir, "documents"), keep="largest")


def _damaged(record: Column) -> Column:
    """A copy's record: of 256 records about one is missing, one has a byte changed and one has lost its second half."""
    case = F.substring(F.md5(record), 1, 2)
    return F.when(case == "00", F.lit(None)).when(case == "01", F.overlay(record, F.lit("~"), 300)).when(
        case == "02", F.substring(record, F.lit(1), F.floor(F.char_length(record) / 2).cast("int"))).otherwise(record)


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record in the archive, and what the audit says of a damaged copy of the archive."""
    records = staged(warc_fixity.archive(table(spark, sf_dir, "pages"), copied=_damaged), "warc")
    copy = records.where("copy_sha256 is not null").select(
        "file", "offset", F.col("copy_length").alias("length"), F.col("copy_sha256").alias("sha256"))
    wrong = warc_fixity.audit(records.select("file", "offset", "length", "sha256"), copy).select(
        "file", "offset", F.when(F.col("other").isNull(), "missing").otherwise("changed").alias("found"))
    return records.join(wrong, ["file", "offset"], "left").select(
        F.col("record_id").alias("page_id"), "url", "file", "offset", "length", "sha256",
        F.coalesce("found", F.lit("intact")).alias("status"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.remove_repeats(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.coalesce(F.col("id") % 100 == 0, F.lit(False)))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_cells.compress(table(spark, sf_dir, "embeddings"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.nearest(table(spark, sf_dir, "embeddings"), F.coalesce(F.col("id") % 50 == 0, F.lit(False)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_license_scan": op2_license_scan,
    "op3_quality": op3_quality,
    "op4_near_dedup": op4_near_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_mixing": op8_mixing,
    "op9_decontamination": op9_decontamination,
    "op10_html_text": op10_html_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_vector_codes": op12_vector_codes,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds of integer k-means per part, spelt out one after another; every distance is computed."""
    def assign(n: int) -> str:
        return f"""a{n} as materialized (
            select vec_id, label, p.part, arg_min(entry, dist * {entries} + entry) as entry, min(dist) as dist from (
                select p.vec_id, p.label, p.part, c.entry, list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v) + list_inner_product(c.v, c.v) as dist
                from p join c{n} c on p.part = c.part) p group by vec_id, label, p.part)"""

    def refine(n: int) -> str:
        return f"""c{n + 1} as materialized (
            select c.part, c.entry, coalesce(m.v, c.v) as v from c{n} c left join (
                select part, entry, list(mean order by nth) as v from (
                    select part, entry, nth, floor(sum(x) / count(*)) as mean from (
                        select a.part, a.entry, unnest(p.v) as x, unnest(range(len(p.v))) as nth from a{n} a join p on p.vec_id = a.vec_id and p.part = a.part)
                    group by part, entry, nth) group by part, entry) m on m.part = c.part and m.entry = c.entry)"""

    steps = ", ".join(s for n in range(rounds) for s in (assign(n), refine(n)))
    return f"""
        with e as (select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)) as v from embeddings where {_FINITE}),
        p as materialized (select vec_id, label, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] as v
              from (select *, unnest(range({parts})) as part from e)),
        c0 as materialized (select part, (rank() over (partition by part order by vec_id) - 1) as entry, v from p
              where vec_id in (select vec_id from e order by vec_id limit {entries})),
        {steps}, {assign(rounds)},
        book as (select sha256(string_agg(part_text, ',' order by part)) as codebooks_sha256 from (
              select part, string_agg(array_to_string(list_transform(v, lambda x: x::bigint), ','), ',' order by entry) as part_text from c{rounds} group by part)),
        r as (select vec_id, any_value(label) as label, string_agg(lpad(printf('%x', entry::bigint), 2, '0'), '' order by part) as code, sum(dist)::bigint as error
              from a{rounds} group by vec_id)
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from r, book
    """


ORACLE: dict[str, str] = {
    "op11_hard_negatives": f"""
        with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                          list_transform(embedding, lambda x: floor(256 * x::double)) as v
                   from embeddings where label is not null and {_FINITE}),
        s as materialized (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
                                  list_inner_product(a.v, b.v)::bigint as score
                           from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
        pos as (select anchor_id, other as positive_id, score as positive_score from s where same
                qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
        select pos.anchor_id, positive_id,
               (row_number() over (partition by pos.anchor_id, positive_id order by score desc, other))::int as rank,
               other as negative_id, positive_score, score as negative_score
        from pos join s on s.anchor_id = pos.anchor_id and not same
             and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
        qualify row_number() over (partition by pos.anchor_id, positive_id order by score desc, other) <= 5
    """,
    "op12_vector_codes": _codes_sql(),
    "op5_exact_dedup": f"""
        with t as (select doc_id, {_LOWER} as norm from documents),
        g as (select norm, max(doc_id) as keep_id, count(*) as group_size from t group by norm)
        select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256
        from t join g using (norm)
    """,
    "op6_warc_fixity": """
        with p as (select page_id, url, coalesce(url, '') as u, coalesce(html, '') as body from pages),
        n as (select case when count(*) <= 2048 * 16 then 1 when count(*) <= 2048 * 256 then 2
                     when count(*) <= 2048 * 4096 then 3 else 4 end as digits from pages),
        r as (select page_id, url, md5(coalesce(page_id::varchar, '') || '|' || u) as name,
              'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:md5:'
              || md5(coalesce(page_id::varchar, '') || '|' || u) || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || u || chr(13) || chr(10)
              || 'WARC-Payload-Digest: sha256:' || sha256(body) || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
              || 'Content-Length: ' || strlen(body) || chr(13) || chr(10) || chr(13) || chr(10) || body
              || chr(13) || chr(10) || chr(13) || chr(10) as record from p),
        s as (select page_id, url, left(name, digits) as file, record, strlen(record) as length, sha256(record) as sha256,
              left(md5(record), 2) as c from r, n)
        select page_id, url, file, (sum(length) over (partition by file order by page_id nulls first, url nulls first, sha256
               rows between unbounded preceding and current row) - length)::bigint as offset, length, sha256,
               case when c = '00' then 'missing'
                    when c = '01' and left(record, 299) || '~' || substring(record, 301) <> record then 'changed'
                    when c = '02' then 'changed' else 'intact' end as status
        from s
    """,
}
