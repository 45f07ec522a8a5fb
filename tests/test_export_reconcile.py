"""W1-W6, A2, A3, R1-R5 and the end-to-end job run."""

from __future__ import annotations

import glob
import hashlib
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docferry.operators.export import export_lines, part_count, verify_export
from docferry.operators.jobs import JobSpec
from docferry.operators.reconcile import WAITS, Check, Unreconciled, check_until_equal, checks_frame
from docferry.plans.job_run import RunOptions, run_export
from docferry.sources.tables import driver_catalog

from helpers import SMALL


def _read_parts(data_dir):
    files = sorted(glob.glob(f"{data_dir}/bucket=*/*.txt"))
    return {f: open(f, "rb").read() for f in files}


def test_basic_export_and_sidecar(spark, out_dir):
    df = spark.createDataFrame([("1", "a", "x"), ("2", "b,c", ""), ("3", 'q"', "z")], "id string, name string, v string")
    lines = df.select(F.lit(0).alias("bucket"),
                      F.concat_ws(",", "id", F.when(F.col("name").rlike('[,"]'), F.concat(F.lit('"'), F.replace("name", F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col("name")), "v").alias("line"))
    res = export_lines(lines, ["id", "name", "v"], job_id="j", out_dir=out_dir, n_parts=1, name="x.csv")
    parts = _read_parts(res.path)
    assert len(parts) == 1
    (path, body), = parts.items()
    assert body == b'id,name,v\n1,a,x\n2,"b,c",\n3,"q""",z\n'
    side = open(res.sidecar_path).read()
    rel = os.path.relpath(path, os.path.dirname(res.path))
    assert side == f"{hashlib.sha256(body).hexdigest()}  {rel}\n"
    assert res.row_count == 3
    assert verify_export(spark, res).count() == 0


def test_manifest_counts_records_not_lines(spark, out_dir):
    from docferry.functions.render import csv_line
    df = spark.createDataFrame([("1", "two\nlines"), ("2", 'q"\r\nx'), ("3", "")], "id string, t string")
    lines = df.select(F.lit(0).alias("bucket"), csv_line([F.col("id"), F.col("t")]).alias("line"))
    res = export_lines(lines, ["id", "t"], job_id="j", out_dir=out_dir, n_parts=1)
    assert res.row_count == 3
    assert spark.read.parquet(res.manifest_path).first()["rows"] == 3
    assert verify_export(spark, res).count() == 0


def test_zero_rows_is_header_only(spark, out_dir):
    lines = spark.createDataFrame([], "bucket int, line string")
    res = export_lines(lines, ["a", "b"], job_id="j", out_dir=out_dir, n_parts=1)
    assert list(_read_parts(res.path).values()) == [b"a,b\n"]
    assert res.row_count == 0


def test_multi_part_bytes(spark, out_dir):
    n = 3
    df = spark.range(100).select((F.col("id") % n).cast("int").alias("bucket"),
                                 F.format_string("r%03d", "id").alias("line"))
    res = export_lines(df, ["c"], job_id="j", out_dir=out_dir, n_parts=n)
    parts = _read_parts(res.path)
    assert len(parts) == n and res.row_count == 100
    for f, body in parts.items():
        k = int(f.split("bucket=")[1].split("/")[0])
        want = "c\n" + "".join(f"r{i:03d}\n" for i in range(100) if i % n == k)
        assert body == want.encode()
    # Tamper with one part and the check finds it.
    victim = next(iter(parts))
    with open(victim, "ab") as fh:
        fh.write(b"extra\n")
    # A change made outside Hadoop leaves a stale local checksum file behind.
    crc = os.path.join(os.path.dirname(victim), "." + os.path.basename(victim) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert verify_export(spark, res).count() == 1


def test_part_count():
    assert part_count(0, 10) == 1 and part_count(10, 10) == 1 and part_count(11, 10) == 2
    with pytest.raises(ValueError):
        part_count(5, 0)


class Rows:
    def __init__(self, n):
        self.row_count = n


def _checks(counts, written, again=None):
    """Run the checks over a sequence of source counts."""
    seq, slept, made = iter(counts), [], []

    def rewrite():
        made.append(Rows(again))
        return made[-1]

    export, checks = check_until_equal(Rows(written), lambda: next(seq), rewrite, sleep=slept.append)
    return export, checks, slept, len(made)


# FIXTURES §5 count sequences.
@pytest.mark.parametrize("counts,written,again,want_sleeps", [
    ([3], 3, None, []),
    ([99, 99, 3], 3, None, [1.0, 2.0]),
    ([99] * 5 + [7], 3, 7, list(WAITS)),
    ([99] * 6, 3, 3, list(WAITS)),
])
def test_count_sequences(spark, counts, written, again, want_sleeps):
    export, checks, slept, rewrites = _checks(counts, written, again)
    assert slept == want_sleeps and [c.source_count for c in checks] == counts
    assert rewrites == (again is not None)
    assert export.row_count == (written if again is None else again)
    assert checks[-1].agrees == (counts[-1] == export.row_count)
    assert [c.pass_no for c in checks] == [1] * (len(checks) - rewrites) + [2] * rewrites
    table = checks_frame(spark, "j", checks).orderBy("attempt").collect()
    assert [(r.source_count, r.written_rows, r.matched) for r in table] == [
        (c.source_count, c.written_rows, c.agrees) for c in checks]


def test_unreconciled_names_every_check():
    e = Unreconciled("j", [Check(2, 1), Check(3, 1)])
    assert "2 counted / 1 written, 3 counted / 1 written" in str(e) and e.job_id == "j"


ORDER_JOB = JobSpec(
    job_id="daily/orders", data_index="order_docs",
    query={"bool": {"filter": [{"range": {"order_date": {"gte": "1996-01-01"}}}]}},
    columns=["order_id", "customer", "amount", "first_sku"],
    column_paths={"customer": "customer.name", "amount": "totals.amount_cents", "first_sku": "items[0].sku"},
    remote_filename="upload/daily-orders.csv")


def test_job_run_end_to_end(spark, out_dir):
    cat = driver_catalog(spark, SMALL)
    opt = RunOptions(staging_root=f"{out_dir}/stage", publish_root=f"{out_dir}/out",
                     rows_per_part=300, ndjson_dir=f"{out_dir}/raw")
    out = run_export(spark, ORDER_JOB, cat, now=datetime(2024, 1, 31), options=opt)
    expected = (spark.read.parquet(f"{SMALL}/orders.parquet")
                .where("o_orderdate >= timestamp_ntz'1996-01-01 00:00:00'").count())
    assert out.row_count == expected and out.attempts == [(expected, expected)]
    assert out.n_parts == part_count(expected, 300) and out.ndjson_rows == expected
    assert os.path.isdir(f"{out_dir}/out/upload/daily-orders.csv")
    side = open(f"{out_dir}/out/upload/daily-orders.csv.sha256").read().splitlines()
    assert len(side) == out.n_parts
    for line in side:
        hexd, rel = line.split("  ")
        body = open(f"{out_dir}/out/upload/{rel}", "rb").read()
        assert hashlib.sha256(body).hexdigest() == hexd
        assert body.startswith(b"order_id,customer,amount,first_sku\n")


def test_mismatch_publishes_nothing(spark, out_dir):
    cat = driver_catalog(spark, SMALL)
    opt = RunOptions(staging_root=f"{out_dir}/stage", publish_root=f"{out_dir}/out",
                     waits=(0.0,), sleep=lambda s: None)
    with pytest.raises(Unreconciled) as e:
        run_export(spark, ORDER_JOB, cat, now=datetime(2024, 1, 31), options=opt,
                   count_source=lambda: 99)
    assert len(e.value.checks) == 3
    assert not os.path.exists(f"{out_dir}/out/upload/daily-orders.csv.sha256")


def test_growing_table_reconciles_on_shared_snapshot(spark, out_dir):
    """H9: count and extract read one snapshot, so rows landing in between do
    not cause a mismatch; a later run sees them."""
    from docferry.sources.tables import Catalog

    sizes = iter([3, 5, 8, 13])
    cat = Catalog()
    cat.register("grow", lambda: spark.range(next(sizes)).select(F.col("id").alias("k")))
    job = JobSpec(job_id="g", data_index="grow", query={"match_all": {}}, columns=["k"],
                  remote_filename="g.csv")
    opt = RunOptions(staging_root=f"{out_dir}/stage", sleep=lambda s: None)
    out = run_export(spark, job, cat, now=datetime(2024, 1, 31), options=opt)
    assert out.row_count == 3 and out.attempts == [(3, 3)] and not out.reextracted
    out2 = run_export(spark, job, cat, now=datetime(2024, 1, 31), options=opt)
    assert out2.row_count == 5


def _data_lines(sidecar_path):
    """Every data line of an export (headers dropped), as a sorted list."""
    base = os.path.dirname(sidecar_path)
    out = []
    for entry in open(sidecar_path).read().splitlines():
        rel = entry.split("  ", 1)[1]
        body = open(f"{base}/{rel}", "rb").read().decode()
        out += body.split("\n", 1)[1].split("\n")[:-1] if "\n" in body else []
    return sorted(out)


def test_one_scan_matches_single_runs(spark, out_dir):
    """Jobs sharing a table, exported in one pass, hold the same rows as each
    job exported alone; with a document id the parts are byte-identical."""
    from docferry.plans.job_run import run_exports_one_scan

    cat = driver_catalog(spark, SMALL)
    jobs = [
        JobSpec(job_id=f"seg/{s}", data_index="customer", query={"term": {"c_mktsegment": s}},
                columns=["c_custkey", "name", "balance"],
                column_paths={"name": "c_name", "balance": "c_acctbal"},
                remote_filename=f"by-segment/{s.lower()}.csv")
        for s in ("BUILDING", "MACHINERY")
    ] + [JobSpec(job_id="rich", data_index="customer",
                 query={"range": {"c_acctbal": {"gte": 5000}}}, columns=["c_name"],
                 remote_filename="rich.csv"),
         JobSpec(job_id="none", data_index="customer", query={"term": {"c_mktsegment": "X"}},
                 columns=["c_name"], remote_filename="none.csv"),
         JobSpec(job_id="texts", data_index="documents", query={"term": {"lang": "en"}},
                 columns=["doc_id", "text"], remote_filename="texts.csv")] + [
        JobSpec(job_id=f"orders-{st}", data_index="order_docs", query={"term": {"status": st}},
                columns=ORDER_JOB.columns, column_paths=ORDER_JOB.column_paths,
                remote_filename=f"orders/{st}.csv")
        for st in ("O", "F")]
    opt = RunOptions(staging_root=f"{out_dir}/multi", publish_root=f"{out_dir}/pub-multi",
                     rows_per_part=40)
    many = run_exports_one_scan(spark, jobs, cat, now=datetime(2024, 1, 31), options=opt)
    for j in jobs:
        single = run_export(spark, j, cat, now=datetime(2024, 1, 31),
                            options=RunOptions(staging_root=f"{out_dir}/single", rows_per_part=40))
        m = many[j.job_id]
        assert (m.row_count, m.n_parts) == (single.row_count, single.n_parts), j.job_id
        assert _data_lines(m.sidecar_path) == _data_lines(single.sidecar_path), j.job_id
        if j.data_index == "order_docs":
            a = sorted(l.split("  ")[0] for l in open(m.sidecar_path).read().splitlines())
            b = sorted(l.split("  ")[0] for l in open(single.sidecar_path).read().splitlines())
            assert a == b and m.n_parts > 1, j.job_id
    assert many["none"].row_count == 0
    en = spark.read.parquet(f"{SMALL}/documents.parquet").where("lang = 'en'")
    assert many["texts"].row_count == en.count() > 0
    assert en.where("text like '%' || chr(10) || '%'").count() > 0  # records span lines
    assert os.path.exists(f"{out_dir}/pub-multi/by-segment/building.csv.sha256")


def test_result_digest_is_digest_of_sidecar(spark, out_dir):
    df = spark.range(50).select((F.col("id") % 3).cast("int").alias("bucket"),
                                F.format_string("v%02d", "id").alias("line"))
    res = export_lines(df, ["v"], job_id="j", out_dir=out_dir, n_parts=3, name="v.csv")
    assert res.sha256 == hashlib.sha256(open(res.sidecar_path, "rb").read()).hexdigest()
    assert res.row_count == 50


def test_duplicate_output_columns(spark, out_dir):
    """A column listed twice gives two header cells and the value twice."""
    cat = driver_catalog(spark, SMALL)
    job = JobSpec(job_id="dup", data_index="region", query={"match_all": {}},
                  columns=["r_name", "r_name", "r_regionkey"], remote_filename="dup.csv")
    out = run_export(spark, job, cat, now=datetime(2024, 1, 31),
                     options=RunOptions(staging_root=f"{out_dir}/s"))
    body = b"".join(_read_parts(out.path).values()).decode()
    lines = body.splitlines()
    assert lines[0] == "r_name,r_name,r_regionkey"
    assert len(lines) == 1 + spark.read.parquet(f"{SMALL}/region.parquet").count()
    first, second, _ = lines[1].split(",")
    assert first == second


def test_ndjson_tee_lines_are_python_json(spark, out_dir):
    import json

    cat = driver_catalog(spark, SMALL)
    job = JobSpec(job_id="lab", data_index="labels", query={"term": {"quality": 1}},
                  columns=["doc_id"], remote_filename="lab.csv")
    out = run_export(spark, job, cat, now=datetime(2024, 1, 31),
                     options=RunOptions(staging_root=f"{out_dir}/s", ndjson_dir=f"{out_dir}/raw"))
    lines = sorted(r.value for r in spark.read.text(f"{out_dir}/raw/lab.ndjson").collect())
    want = sorted(json.dumps(r.asDict(), ensure_ascii=False) for r in
                  spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect())
    assert lines == want and out.ndjson_rows == len(want)


def test_parts_follow_what_the_job_selects(spark, out_dir):
    cat = driver_catalog(spark, SMALL)

    def run(name, query, **opt):
        job = JobSpec(job_id=name, data_index="documents", query=query, columns=["doc_id", "text"],
                      remote_filename=f"{name}.csv")
        return run_export(spark, job, cat, now=datetime(2024, 1, 31),
                          options=RunOptions(staging_root=f"{out_dir}/s", **opt))

    nothing = run("nothing", {"term": {"lang": "xx"}}, bytes_per_part=1000)
    assert (nothing.n_parts, nothing.row_count) == (1, 0)
    assert list(_read_parts(nothing.path).values()) == [b"doc_id,text\n"]
    few = run("few", {"term": {"doc_id": 3}}, bytes_per_part=1 << 20)
    assert (few.n_parts, few.row_count) == (1, 1)
    many = run("many", {"match_all": {}}, bytes_per_part=20_000)
    size = sum(map(len, _read_parts(many.path).values()))
    assert many.n_parts == len(_read_parts(many.path)) and size / 20_000 <= many.n_parts <= size / 20_000 + 1


def test_publish_replaces_only_earlier_exports(spark, out_dir):
    cat = driver_catalog(spark, SMALL)
    opt = RunOptions(staging_root=f"{out_dir}/s", publish_root=f"{out_dir}/pub")

    def run(remote):
        job = JobSpec(job_id="r", data_index="region", query={"match_all": {}}, columns=["r_name"],
                      remote_filename=remote)
        return run_export(spark, job, cat, now=datetime(2024, 1, 31), options=opt)

    run("all/one.csv")
    run("all/two.csv")
    run("all/one.csv")  # an earlier export is replaced
    with pytest.raises(FileExistsError):
        run("all")  # a folder of exports is not
    for bad in ("..", "../../x", "all/../..", ".", "/"):
        with pytest.raises(ValueError):
            run(bad)
    assert sorted(f for f in os.listdir(f"{out_dir}/pub/all") if not f.startswith(".")) == [
        "one.csv", "one.csv.sha256", "two.csv", "two.csv.sha256"]


def test_a_field_named_job_id_is_exported(spark, out_dir):
    from docferry.plans.job_run import run_exports_one_scan
    from docferry.sources.tables import Catalog

    cat = Catalog()
    cat.register("t", lambda: spark.createDataFrame([("mine", 1), ("yours", 2)], "job_id string, n int"))
    job = JobSpec(job_id="exported", data_index="t", query={"match_all": {}}, columns=["job_id", "n"],
                  remote_filename="t.csv")
    out = run_exports_one_scan(spark, [job], cat, now=datetime(2024, 1, 31),
                               options=RunOptions(staging_root=f"{out_dir}/s"))
    body = b"".join(_read_parts(out["exported"].path).values())
    assert body == b"job_id,n\nmine,1\nyours,2\n"
