"""Building a report starts no job; the work begins with the action on it."""

import pytest

from lapse.queries import QUERIES

SF = "/root/testdata/sf0.001"
#: Fitted, written or joined many times over one written table: these run jobs while they are built.
EAGER = ("p8", "p9_export_dashboard", "p9_export_written", "s5b", "m0_document_scan", "op_document_types")
NAMES = [n for n in QUERIES if not n.startswith(EAGER)]


@pytest.mark.parametrize("name", NAMES)
def test_no_job_before_the_action(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", name)
    try:
        df = QUERIES[name](spark, SF)
        built = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
        df.limit(1).collect()
        ran = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert all(_reads_schema(sc, j) for j in built) and len(ran) > len(built)


def _reads_schema(sc, job):
    """A file's schema is read by a job of one task over one file's footer."""
    info = sc.statusTracker().getJobInfo(job)
    stages = [sc.statusTracker().getStageInfo(s) for s in info.stageIds]
    return len(stages) == 1 and stages[0] is not None and stages[0].numTasks == 1 and stages[0].name.startswith("parquet at")
