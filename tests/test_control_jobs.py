"""T1-T3, V6, V9 (control records) and J1-J3, W5 (jobs)."""

from __future__ import annotations

import json

from docferry.operators.control import decode_control
from docferry.operators.jobs import JobSpec, delivery_plan, lookup_jobs, validate_jobs

CASES = [
    (b'{"job_doc_id":"abc"}', ("abc", None, None)),
    (None, (None, None, "null_value")),
    (b"not-json", (None, None, "undecodable")),
    (b"} not json {", (None, None, "undecodable")),
    (b'{"job_doc_id":"job-A","correlation_id":"demo-1"}', ("job-A", "demo-1", None)),
    (b'{"id":"z"}', ("z", None, None)),
    (b"[1]", (None, None, "not_an_object")),
    (b"5", (None, None, "not_an_object")),
    (b"null", (None, None, "not_an_object")),
    (b"{}", (None, None, "missing_job_doc_id")),
    (b'{"job_doc_id":""}', (None, None, "missing_job_doc_id")),
    (b'{"job_doc_id":5}', (None, None, "missing_job_doc_id")),
    (b'{"job_doc_id":0, "id": "fallback"}', ("fallback", None, None)),
    (b'{"job_doc_id":[], "id": "fb2"}', ("fb2", None, None)),
    (b'{"job_doc_id":true, "id": "x"}', (None, None, "missing_job_doc_id")),
    (b'{"job_doc_id":"a","correlation_id":7}', (None, None, "bad_correlation_id")),
    (b'{"job_doc_id":"a","correlation_id":null}', ("a", None, None)),
    (b'{"job_doc_id":"a","job_doc_id":"last"}', ("last", None, None)),
    (b"\xffA", (None, None, "undecodable")),
    (' {"job_doc_id": "ünï"} '.encode(), ("ünï", None, None)),
]


def test_decode_cases(spark):
    data = [(v, 2, i) for i, (v, _) in enumerate(CASES)]
    df = spark.createDataFrame(data, "value binary, partition int, offset long")
    out = {r.offset: (r.job_doc_id, r.correlation_id, r.error) for r in decode_control(df).collect()}
    for i, (_, want) in enumerate(CASES):
        assert out[i] == want, (CASES[i][0], out[i])


def test_partition_and_offset_kept(spark):
    df = spark.createDataFrame([('{"job_doc_id":"abc"}', 2, 99)], "value string, partition int, offset long")
    r = decode_control(df).first()
    assert (r.partition, r.offset, r.job_doc_id) == (2, 99, "abc")


JOBS = {
    "happy": {"job_id": "harbour-log", "data_index": "ship_calls", "query": {"match_all": {}},
              "column_paths": {"ship": "vessel.imo", "tons": "cargo.weight"}, "columns": ["ship", "tons"],
              "remote_filename": "port/berths.csv"},
    "no_paths": {"data_index": "tides", "query": {"match_all": {}}, "columns": ["level"], "remote_filename": "tides.csv"},
    "null_paths": {"data_index": "tides", "query": {"match_all": {}}, "columns": ["level"],
                   "column_paths": None, "remote_filename": "tides.csv", "job_id": None},
    "fields_missing": {"data_index": "tides"},
    "bad_columns": {"data_index": "tides", "query": {"match_all": {}}, "columns": [["berth"], "quay"],
                    "remote_filename": "tides.csv"},
    "bad_paths": {"data_index": "tides", "query": {"match_all": {}}, "columns": ["level"],
                  "column_paths": {"level": ["x"]}, "remote_filename": "tides.csv"},
    "query_list": {"data_index": "tides", "query": [{"match_all": {}}], "columns": ["level"],
                   "remote_filename": "tides.csv"},
    "query_empty": {"data_index": "tides", "query": {}, "columns": ["level"], "remote_filename": "tides.csv"},
    "columns_empty": {"data_index": "tides", "query": {"match_all": {}}, "columns": [],
                      "remote_filename": "tides.csv"},
    "bad_remote": {"data_index": "tides", "query": {"match_all": {}}, "columns": ["level"], "remote_filename": ""},
    "numeric_id": {"job_id": 12, "data_index": 3, "query": {"match_all": {}}, "columns": ["level"],
                   "remote_filename": "tides.csv"},
}


def _jobs(spark):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in JOBS.items()], "_id string, doc string")


def test_validate_jobs(spark):
    out = {r.job_doc_id: r for r in validate_jobs(_jobs(spark)).collect()}
    assert out["happy"].error is None and out["happy"].job_id == "harbour-log"
    assert JobSpec.from_row(out["happy"]).column_paths == {"ship": "vessel.imo", "tons": "cargo.weight"}
    assert out["no_paths"].error is None and out["no_paths"].job_id == "no_paths"
    assert dict(out["no_paths"].column_paths) == {}
    assert out["null_paths"].error is None and out["null_paths"].job_id == "null_paths"
    assert out["fields_missing"].error == "missing_fields"
    assert out["bad_columns"].error == "columns_not_strings"
    assert out["bad_paths"].error == "column_paths_not_strings"
    assert out["query_list"].error == "query_not_object"
    assert out["query_empty"].error == "query_empty"
    assert out["columns_empty"].error == "columns_empty"
    assert out["bad_remote"].error == "bad_remote_filename"
    assert (out["numeric_id"].job_id, out["numeric_id"].data_index) == ("12", "3")


def test_lookup_not_found_and_plan(spark):
    ctl = spark.createDataFrame([(0, 1, "happy", None, None), (0, 2, "ghost", None, None)],
                                "partition int, offset long, job_doc_id string, correlation_id string, error string")
    got = {r.offset: (r.job_id, r.error) for r in lookup_jobs(ctl, _jobs(spark)).collect()}
    assert got == {1: ("harbour-log", None), 2: (None, "not_found")}
    plan = sorted(tuple(r) for r in delivery_plan(validate_jobs(_jobs(spark)), "/stage")
                  .where("job_id = 'harbour-log'").collect())
    assert plan == [("harbour-log", 1, "/stage/harbour-log/berths.csv", "port/berths.csv"),
                    ("harbour-log", 2, "/stage/harbour-log/berths.csv.sha256", "port/berths.csv.sha256")]


def test_load_job_point_lookup(spark):
    import pytest

    from docferry.operators.jobs import JobSpecError, load_job

    jobs = _jobs(spark)
    spec = load_job(jobs, "happy")
    assert spec.job_id == "harbour-log" and spec.columns == ["ship", "tons"]
    with pytest.raises(JobSpecError) as e:
        load_job(jobs, "ghost")
    assert e.value.reason == "not_found"
    with pytest.raises(JobSpecError) as e:
        load_job(jobs, "bad_paths")
    assert e.value.reason == "column_paths_not_strings"


def test_run_one(spark, out_dir):
    from datetime import datetime

    from docferry.plans.job_run import RunOptions, run_one
    from docferry.sources.tables import driver_catalog

    from helpers import SMALL

    job = {"data_index": "labels", "query": {"term": {"toxic": 1}}, "columns": ["doc_id", "quality"],
           "remote_filename": "toxic.csv"}
    jobs = spark.createDataFrame([("t", json.dumps(job))], "_id string, doc string")
    out = run_one(spark, "t", jobs, driver_catalog(spark, SMALL), now=datetime(2024, 1, 31),
                  options=RunOptions(staging_root=f"{out_dir}/s", publish_root=f"{out_dir}/p"),
                  manifest_path=f"{out_dir}/manifest")
    want = spark.read.parquet(f"{SMALL}/labels.parquet").where("toxic = 1").count()
    assert out.row_count == want
    assert spark.read.parquet(f"{out_dir}/manifest").first()["row_count"] == want


def test_staging_names_never_collide(spark):
    from pyspark.sql import functions as F

    from docferry.operators.jobs import safe_name
    from docferry.plans.job_run import _safe

    ids = ["a/b", "a_b", "a b", "harbour-log", "..", "é"]
    py = [_safe(i) for i in ids]
    assert len(set(py)) == len(ids) and py[1] == "a_b" and py[3] == "harbour-log"
    df = spark.createDataFrame([(i,) for i in ids], "i string")
    assert [r[0] for r in df.select(safe_name(F.col("i"))).collect()] == py
