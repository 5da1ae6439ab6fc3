"""What the planner makes of the jobs, and all queries against their SQL."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from docstrata import catalog
from docstrata.operators import html, reconcile
from docstrata.sources.store import LANDING, Lake

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    result = entry.queries()[name](spark, SF_DIR)
    cursor = db.execute(entry.oracle_sql()[name])
    expected = check.rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert check.rows_of(result.columns, result.collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["body", "partition_date", "n_pages", "n_contents", "min_hash"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_query_uses_a_nested_loop_or_cartesian_join(spark):
    # These run whole jobs; what is left of their plans reads tables.
    jobs = {
        "landing_state", "landing_increment", "landing_stream", "landing_stream_late", "landing_range", "bad_documents", "objects_by_key", "hash_update_counts",
        "transformed_state", "transform_rerun", "transform_stream",
    }
    for name, query in catalog.queries().items():
        if name not in jobs:
            plan = plan_of(query(spark, SF_DIR))
            assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_known_rows_are_skipped_before_any_page_is_parsed(spark):
    lines = plan_of(catalog.queries()["flagship"](spark, SF_DIR)).splitlines()
    python = next(i for i, line in enumerate(lines) if "ArrowEvalPython" in line)
    anti = next(i for i, line in enumerate(lines) if "LeftAnti" in line)
    assert python < anti  # upstream operators are printed further down


def test_only_html_reaches_python_and_only_once(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    frame = pages.select("page_id", html.content_hash(F.encode("html", "UTF-8"), F.lit("html")).alias("h"))
    plan = plan_of(frame.filter("page_id > 3"))
    assert plan.count("ArrowEvalPython") == 1 and "GreaterThan(page_id,3)" in plan
    assert "url" not in plan


def test_state_scan_reads_only_what_it_needs(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", "2024-01-01", "h"), ("b", "2024-02-01", "g")], "identifier string, partition_date string, file_hash string")
    blank = {c: F.lit(None).cast("string") for c in lake.log(LANDING).columns if c not in (*rows.columns, "version", "arrived")}
    full = rows.withColumns({**blank, "action": F.lit("insert"), "arrived": F.current_timestamp()})
    lake.write_log(full, LANDING, 1)
    lake.commit(LANDING, 1, "t")
    log_only = plan_of(lake.current(LANDING, columns=["file_hash"]))
    assert "description" not in log_only
    lake.compact(LANDING, "t")
    narrow = plan_of(lake.current(LANDING, columns=["file_hash"]).select("identifier", "file_hash"))
    assert "description" not in narrow and "Exchange" not in narrow
    january = lake.in_range(LANDING, "2024-01-01", "2024-01-31")
    plan = plan_of(january.select("identifier"))
    assert "partition_date" in plan.split("PartitionFilters", 1)[1].split("]")[0]
    assert "description" not in plan
    assert [r.identifier for r in january.collect()] == ["a"]


def test_first_per_key_combines_before_the_shuffle(spark):
    documents = catalog._document_rows(spark, SF_DIR).select("file_hash", "doc_id")
    plan = plan_of(reconcile.first_per_key(documents, "file_hash", ["doc_id"]))
    exchange, partial = plan.index("Exchange"), plan.index("partial_min_by")
    assert exchange < partial


def test_adaptive_execution_splits_a_hot_key(spark, tmp_path):
    """The join shape of the landing job: staged lookup side, hot identifier on the other."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lake = Lake(spark, str(tmp_path))
        known = lake.stage(spark.range(0, 3000, 2).select(F.col("id").cast("string").alias("identifier")), "known", 1)
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 3000).cast("string")
        rows = spark.range(60_000, numPartitions=6).select(hot.alias("identifier"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        flagged = reconcile.flag_known(rows, known, unique=True)
        counts = flagged.groupBy("is_known").count()
        got = {r.is_known: r["count"] for r in counts.collect()}
        assert sum(got.values()) == 60_000
        assert "skew=true" in plan_of(counts)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_document_scan_is_limited_to_the_captures_needed(spark, tmp_path, monkeypatch):
    """The content scan gets time bounds it can prune by, and never sorts or groups content."""
    pages, responses = catalog._captures(spark, SF_DIR)
    responses.write.parquet(str(tmp_path / "responses"))
    plans = {}
    write = Lake.write_blobs

    def watched(lake, blobs, zone, version):
        spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
        plans[zone] = plan_of(blobs)
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        return write(lake, blobs, zone, version)

    monkeypatch.setattr(Lake, "write_blobs", watched)
    lake = Lake(spark, str(tmp_path / "lake"))
    run = catalog._run("2024-01-01", "2024-12-31")
    catalog.land(lake, pages, spark.read.parquet(str(tmp_path / "responses")), run)
    catalog.transform(lake, catalog.TransformRun("2024-01-01", "2024-12-31", 1, catalog.RUN_TS))
    landing = plans["landing"]
    assert "GreaterThanOrEqual(captured_at" in landing and "LessThanOrEqual(captured_at" in landing
    for plan in plans.values():
        assert plan.count("ArrowEvalPython") == 1 and "Broadcast" in plan and "NestedLoop" not in plan
        content_side = plan.split("BroadcastExchange")[0]
        assert "Exchange" not in content_side and "Sort" not in content_side


def test_jobs_with_every_join_shuffled(spark, db, monkeypatch):
    """Nothing depends on broadcasting; content is then shuffled exactly once per job."""
    plans, write = {}, Lake.write_blobs

    def watched(lake, blobs, zone, version):
        plans[zone] = plan_of(blobs)
        return write(lake, blobs, zone, version)

    monkeypatch.setattr(Lake, "write_blobs", watched)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        result = entry.queries()["transformed_state"](spark, SF_DIR)
        cursor = db.execute(entry.oracle_sql()["transformed_state"])
        expected = check.rows_of([d[0] for d in cursor.description], cursor.fetchall())
        assert check.rows_of(result.columns, result.collect()) == expected
        for physical in plans.values():
            assert "SortMergeJoin" in physical and physical.count("ArrowEvalPython") == 1
            content_lines = physical.split("SortMergeJoin", 1)[1].split("FileScan", 1)[0]
            assert content_lines.count("Exchange") == 1
    finally:
        for name in names:
            spark.conf.unset(name)
