"""Set reconciliation, pinned versions and pages by index."""

from __future__ import annotations

import random
import shutil
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docferry.operators import set_reconcile
from docferry.operators.jobs import JobSpec
from docferry.operators.paging import page_index, read_page
from docferry.plans.job_run import RunOptions, run_export
from docferry.sources.snapshots import SnapshotCatalog, SnapshotChanged, SnapshotLog


def surplus(ours, theirs):
    n = Counter(x for x in ours if x is not None)
    n.subtract(x for x in theirs if x is not None)
    return {k: v for k, v in n.items() if v}


def found(spark, ours, theirs, kind="long", **more):
    a, b = (spark.createDataFrame([(x,) for x in ids], f"id {kind}").repartition(3) for ids in (ours, theirs))
    return {r.id: r.surplus for r in set_reconcile.differences(a, b, "id", **more).collect()}


def test_ids_of_every_kind_of_difference(spark):
    rng = random.Random(1)
    common = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(4000)]
    extreme = [-(1 << 63), (1 << 63) - 1, 0, -1]
    ours = common + extreme + [5, 5, 5, None] + list(range(100, 160))
    theirs = common + [0, 0, 7, None, None] + list(range(130, 200)) + common[:20]
    assert found(spark, ours, theirs) == surplus(ours, theirs)


def test_a_large_difference_grows_the_table(spark, monkeypatch):
    tried = []
    real = set_reconcile.sketch
    monkeypatch.setattr(set_reconcile, "sketch", lambda ids, column, cells: tried.append(cells) or real(ids, column, cells))
    ours, theirs = list(range(0, 3000, 2)), list(range(0, 3000, 3))
    assert found(spark, ours, theirs, cells=30) == surplus(ours, theirs)
    assert len(set(tried)) > 2


def test_text_ids(spark):
    ours, theirs = [f"doc-{i}" for i in range(500)] + ["é", "twice", "twice"], [f"doc-{i}" for i in range(3, 503)] + ["twice"]
    assert found(spark, ours, theirs, "string") == surplus(ours, theirs)


def test_equal_and_empty_sides(spark):
    assert found(spark, [1, 2, 3], [3, 2, 1]) == {}
    assert found(spark, [], []) == {}
    assert found(spark, [], [4, None]) == {4: -1}


def test_cost_follows_the_difference(spark):
    ids = spark.range(200_000)
    cells = set_reconcile.subtract(set_reconcile.sketch(ids, "id"), set_reconcile.sketch(ids.filter("id != 77"), "id"))
    assert cells.count() == set_reconcile.HASHES


def table(spark, path, low, high, mode="overwrite"):
    spark.range(low, high).repartition(2).write.mode(mode).parquet(path)


def test_versions_are_replayed(spark, out_dir):
    path, log = f"{out_dir}/t", None
    log = SnapshotLog(spark, path, f"{out_dir}/log")
    table(spark, path, 0, 10)
    assert log.pin() == 0 and log.pin() == 0
    table(spark, path, 10, 15, "append")
    assert log.pin() == 1
    # An older version is still read while its files are there.
    assert log.read(0).count() == 10 and log.read(1).count() == 15
    table(spark, path, 0, 3)
    for version in (0, 1):
        with pytest.raises(SnapshotChanged):
            log.read(version)
    assert log.pin() == 2 and log.read(2).count() == 3
    with pytest.raises(ValueError):
        log.files(9)


def test_a_table_rewritten_before_the_extract_is_caught(spark, out_dir, monkeypatch):
    from docferry.plans import job_run

    path = f"{out_dir}/t"
    table(spark, path, 0, 40)
    cat = SnapshotCatalog(spark, {"t": path}, f"{out_dir}/log")
    job = JobSpec(job_id="j", data_index="t", query={"match_all": {}}, columns=["id"], remote_filename="t.csv")
    options = RunOptions(staging_root=f"{out_dir}/stage", publish_root=f"{out_dir}/out", waits=())
    now = datetime(2024, 1, 31)
    assert run_export(spark, job, cat, now=now, options=options).row_count == 40
    real = job_run.export_lines

    def rewritten(*args, **kwargs):
        done = real(*args, **kwargs)
        table(spark, path, 0, 40)  # the same rows, other files
        return done

    monkeypatch.setattr(job_run, "export_lines", rewritten)
    shutil.rmtree(f"{out_dir}/out")
    with pytest.raises(SnapshotChanged):
        run_export(spark, job, cat, now=now, options=options)
    assert not (shutil.os.path.exists(f"{out_dir}/out"))


@pytest.mark.parametrize("rows", [0, 1, 9, 10, 11, 95])
def test_pages_by_index(spark, out_dir, rows):
    data = [(i // 7, -i, f"r{i}") for i in range(rows)]
    random.Random(rows).shuffle(data)
    df = spark.createDataFrame(data, "a long, b long, name string").repartition(4)
    index = page_index(df, ["a", "b"], 10).cache()
    ordered = sorted(data)
    assert index.count() == -(-rows // 10)
    for page in range(-(-rows // 10) + 2):
        assert [tuple(r) for r in read_page(df, ["a", "b"], index, page).collect()] == ordered[10 * page:10 * page + 10]


def test_a_page_reads_by_its_keys(spark, out_dir):
    path = f"{out_dir}/sorted"
    spark.range(1000).withColumnRenamed("id", "a").withColumn("b", F.lit(1)).write.parquet(path)
    df = spark.read.parquet(path)
    index = page_index(df, ["a", "b"], 100)
    done = read_page(df, ["a", "b"], index, 3)._jdf.queryExecution()
    assert "GreaterThanOrEqual(a,300)" in done.executedPlan().toString()  # as long as the text isn't cut
    assert "<= 400)" in done.optimizedPlan().toString()
