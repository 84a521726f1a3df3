"""The corpus pipeline's stages, each against its operator's brute-force version."""

import os
import re
import sys
from collections import Counter

import brute
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from lapse.llm.common import staged  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stage_order_and_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    for df in outputs[1:-1]:
        assert df.schema == outputs[0].schema
    counts = [df.count() for df in outputs]
    assert all(a >= b for a, b in zip(counts, counts[1:])) and counts[-1] == counts[-2]


def test_toxic_documents_go_and_clean_ones_stay(spark, outputs):
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    labelled = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    words = re.compile(r"\b(idiot|loser|pathetic|scum|moron|worthless|disgusting|trash|clown|stupid)\b")
    kept = {d for d, _ in texts(outputs[1])}
    named = {d for d, t in texts(outputs[0]) if d in toxic and words.search((t or "").lower())}
    assert named and len(named - kept) >= 0.8 * len(named)
    assert len(labelled - toxic - kept) == 0


def test_copies_and_near_copies_leave_one_each(outputs):
    before, after = texts(outputs[1]), texts(outputs[2])
    keep = {}
    for d, t in before:
        n = (t or "").translate(brute.LOWER)
        keep[n] = max(keep.get(n, d), d)
    assert Counter(d for d, _ in after) == Counter(keep.values())
    near = brute.near_duplicates(after)
    assert {d for d, _ in texts(outputs[3])} == {d for d, (_, c) in near.items() if d == c}


def test_leaks_go(spark, outputs):
    items = [" ".join(brute.words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(outputs[3]), {d for d, _ in texts(outputs[4])}
    leaked = {d for d, t in before if any(i in " ".join(brute.words(t)) for i in items)}
    assert not leaked & after and {d for d, _ in before} - after <= leaked


def test_mix_comes_near_its_targets(outputs):
    rows = outputs[5].collect()
    got, want = Counter(), {}
    for r in rows:
        got[r.source] += r.taken
        want[r.source] = r.target
        assert r.taken <= 3 * r.size
    assert abs(sum(got.values()) - sum(want.values())) <= 0.2 * sum(want.values())


def test_registered_queries(spark):
    names = list(entry.queries())
    assert [n for n in names if re.match(r"op\d+_", n)] and "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert entry.queries()["pipeline"](spark, SF).count() > 0
