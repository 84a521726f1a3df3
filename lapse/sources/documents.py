"""Document collections as VARIANT: fields of changing type, told apart by the type that each document has.

A JSON-lines dump of a document store is read into one VARIANT column, without a schema and without an inference pass.
Numbers, texts and the store's own notations for dates and numbers (``{"$date": ...}``, ``{"$numberLong": ...}``) may alternate
from document to document; the expressions below look at a value's type before they convert it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparse import parse_mixed_timestamp

# The names of the notations.
NUMBER_NOTATIONS = ("$numberLong", "$numberInt", "$numberDouble", "$numberDecimal")
DATE_NOTATION = "$date"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One VARIANT column ``doc`` per line; a line that is no JSON gives NULL."""
    return spark.read.option("singleVariantColumn", "doc").option("mode", "PERMISSIVE").json(path)


def field(doc: Column | str, name: str) -> Column:
    """A field as VARIANT; NULL where the document lacks it or holds JSON null."""
    v = F.try_variant_get(doc, f"$['{name}']", "variant")
    return F.when(~F.coalesce(F.is_variant_null(v), F.lit(True)), v)


def first_field(doc: Column | str, names: Sequence[str]) -> Column:
    """The first of several names under which a field is found."""
    return F.coalesce(*[field(doc, n) for n in names])


def kind_of(v: Column) -> Column:
    """'number', 'text', 'bool', 'date', 'array', 'object', or NULL; a number notation is a number, a date notation a date."""
    head = F.regexp_extract(F.schema_of_variant(v), r"^(STRING|BOOLEAN|ARRAY|DATE|TIMESTAMP|OBJECT<[`\"']?\$(?:date|number)|OBJECT|VOID)?", 1)
    kinds = {"STRING": "text", "BOOLEAN": "bool", "ARRAY": "array", "DATE": "date", "TIMESTAMP": "date", "OBJECT": "object", "": "number",
             "OBJECT<$date": "date", "OBJECT<$number": "number"}
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), F.regexp_replace(head, "[`\"']", ""))


def text_of(v: Column, kind: Column | None = None) -> Column:
    """A number or text as text; NULL for anything else. ``kind``: the value's kind, where a column holds it already."""
    plain = F.try_variant_get(v, "$", "string")
    noted = F.coalesce(*[F.try_variant_get(v, f"$['{n}']", "string") for n in NUMBER_NOTATIONS])
    return F.when((kind_of(v) if kind is None else kind).isin("number", "text"), F.coalesce(noted, plain))


def instant_of(text: Column, kind: Column, date_text: Column, date_kind: Column) -> Column:
    """A date (its text, or milliseconds since the epoch) or a text in one of the known layouts, in UTC; NULL for anything else,
    numbers included: a document store converts no bare number to a date. Takes text and kind of the value and of its date notation."""
    counted = F.timestamp_add("MILLISECOND", date_text.try_cast("bigint"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    written = parse_mixed_timestamp(F.when(kind == "date", date_text).when(kind == "text", text))
    return F.when((kind == "date") & (date_kind == "number"), counted).otherwise(written)


def activity_documents(docs: DataFrame, members: Sequence[str], customers: Sequence[str]) -> DataFrame:
    """Activity documents in the shape that M0 takes: ids as texts (the first name found), the instant as a timestamp.

    Values, kinds and texts are columns one after another, so that each is worked out once per document.
    """
    doc = F.col("doc")
    names = {"member_id": members, "customer_id": customers, "at": ["timestamp"], "event_type": ["event_type"], "feature": ["feature"],
             "session_duration_sec": ["session_duration_sec"]}
    values = docs.select(*[first_field(doc, found).alias(n) for n, found in names.items()])
    values = values.withColumn("date", F.try_variant_get("at", f"$['{DATE_NOTATION}']", "variant"))
    kinds = values.select("*", *[kind_of(F.col(n)).alias(f"{n}_kind") for n in values.columns])
    texts = kinds.select(*[text_of(F.col(n), F.col(f"{n}_kind")).alias(n) for n in values.columns], "at_kind", "date_kind")
    return texts.select("member_id", "customer_id", instant_of(F.col("at"), F.col("at_kind"), F.col("date"), F.col("date_kind")).alias("timestamp"),
                        "event_type", "feature", "session_duration_sec")
