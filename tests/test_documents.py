"""Documents of changing field types, safe numbers, member ids of any kind, first rows of the input."""

import datetime as dt
import json
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.functions import safe_double
from lapse.plans import events as E
from lapse.sources.documents import activity_documents, first_field, kind_of, read_documents
from lapse.sources.tables import with_position

AT = dt.datetime(2024, 1, 5, 10, 11, 12)


def dump(tmp_path, rows):
    path = tmp_path / "docs"
    path.mkdir()
    (path / "a.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(path)


def test_fields_are_converted_by_the_type_that_each_document_has(spark, tmp_path):
    millis = int(AT.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [{"member_id": 5, "customer_id": "7", "timestamp": {"$date": "2024-01-05T10:11:12Z"}, "event_type": "a", "session_duration_sec": 30},
            {"userId": "5", "customerId": {"$numberLong": "7"}, "timestamp": "2024-01-05 10:11:12", "session_duration_sec": "30.5"},
            {"member_id": None, "userID": 5.0, "customerID": 7.0, "timestamp": {"$date": {"$numberLong": str(millis)}}, "session_duration_sec": "n/a"},
            {"memberId": {"$numberInt": "5"}, "customer_id": 7, "timestamp": {"$date": millis}, "feature": None},
            {"member_id": "m-5", "customer_id": 7, "timestamp": "01/05/2024 10:11:12", "feature": "f"},
            {"member_id": 5, "customer_id": 7, "timestamp": millis}, {"member_id": 5, "customer_id": {"x": 1}, "timestamp": "2024-01-05 10:11:12"},
            {"member_id": [5], "customer_id": 7, "timestamp": "junk"}, "no json", {}]
    docs = read_documents(spark, dump(tmp_path, rows))
    assert docs.count() == len(rows)
    events = activity_documents(docs, E.MEMBER_ID_VARIANTS, E.CUSTOMER_ID_VARIANTS)
    got = E.member_events(events).orderBy("session_duration_sec", "member_key").collect()
    assert [(r.member_key, r.member_id, r.customer_id, r.ts) for r in got] == [("5", 5, 7, AT)] * 2 + [("m-5", None, 7, AT)] + [("5", 5, 7, AT)] * 2
    assert [r.session_duration_sec for r in got] == [None, None, None, 30.0, 30.5]
    kinds = [r.k for r in docs.select(kind_of(first_field("doc", E.MEMBER_ID_VARIANTS)).alias("k")).collect()]
    assert kinds == ["number", "text", "number", "number", "text", "number", "number", "array", None, None]
    assert [r.k for r in docs.select(kind_of(first_field("doc", ["timestamp"])).alias("k")).collect()][:6] == ["date", "text", "date", "date", "text", "number"]


def test_safe_double(spark):
    texts = ["12", " 1.5 ", ".5", "5.", "-1e3", "1E+2", "inf", "-Infinity", "NaN", "1,5", "0x1F", "1d", "1.0f", "", "x", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(safe_double("t")).collect()]
    assert got[:8] == [12.0, 1.5, 0.5, 5.0, -1000.0, 100.0, math.inf, -math.inf] and math.isnan(got[8]) and got[9:] == [None] * 7
    assert spark.range(2).select(safe_double("id", T.LongType())).collect()[1][0] == 1.0


def test_reports_keep_members_whose_id_is_a_text(spark):
    rows = [("m-1", 7, "feature_click", "f"), ("m-1", 7, "feature_click", "f"), ("3", 7, "report_generate", "f"), ("3.0", 7, "x", None), (None, 7, "x", None)]
    raw = spark.createDataFrame(rows, "member_id string, customer_id long, event_type string, feature string").withColumns(
        {"timestamp": F.lit("2024-01-05 10:11:12"), "session_duration_sec": F.lit("60")})
    events = E.member_events(raw)
    top = [(r.member_id, r.total_events) for r in E.upsell_candidates(events).collect()]
    assert top == [("m-1", 2), ("3", 2)]
    assert E.session_cadence(events).first().user_count == 2
    assert E.feature_retention(events).first().total_unique_first_users == 1
    assert [r.member_id for r in E.upsell_candidates(E.normalize_events(raw)).collect()] == [3]


def test_the_first_row_of_the_input_is_kept(spark, tmp_path):
    rows = [(k % 37 if k % 11 else None, 1000 - k) for k in range(500)]
    path = str(tmp_path / "t")
    for n in range(3):  # files by path
        spark.createDataFrame(rows[n::3], "k int, v int").coalesce(1).write.parquet(f"{path}/{n}")
    want = {}
    for n in range(3):
        for k, v in rows[n::3]:
            want.setdefault(k, v)
    scan = spark.read.option("recursiveFileLookup", True).parquet(path)
    got = E.keep_first(with_position(scan), ["k"])
    assert got.columns == ["k", "v"] and {r.k: r.v for r in got.collect()} == want
    assert any(want[k] != min(v for j, v in rows if j == k) for k in want)  # not the smallest
