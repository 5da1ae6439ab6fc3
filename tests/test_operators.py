"""Frontier, reconciliation, statistics, logs and sources."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from docstrata import schemas
from docstrata.operators import frontier, logs, reconcile, stats
from docstrata.sources import captures as sources

# -- frontier ---------------------------------------------------------------------


@pytest.mark.parametrize("start, end, message", [
    (None, "2024-01-01", "start_date is missing"), ("2024-01-01", "", "end_date is missing"),
    ("2024-02-30", "2024-03-01", "start_date is not a calendar day .*2024-02-30"),
    ("2024-01-01", "01/02/2024", "end_date is not a calendar day"), ("2024-02-01", "2024-01-31", "before it starts"),
])
def test_validate_range(start, end, message):
    with pytest.raises(ValueError, match=message):
        frontier.validate_range(start, end)


def test_check_ranges(spark):
    rows = [("2024-01-01", "2024-01-31"), ("2024-02-30", "2024-03-01"), ("2024-01-01", "x"), ("", "2024-01-01"),
            (None, "2024-01-01"), ("2024-02-01", "2024-01-01"), ("2024-01-01", "2024-01-01")]
    got = frontier.check_ranges(spark.createDataFrame(rows, "start_date string, end_date string"))
    assert [r.range_error for r in got.collect()] == [
        None, "invalid start_date", "invalid end_date", "missing date", "missing date", "end before start", None]


def test_frontier(spark):
    requests = frontier.frontier(frontier.range_row(spark, "2024-01-15", "2024-03-01"), sources.BODIES, "https://x/s/")
    rows = requests.collect()
    assert len(rows) == 12 and {r.page_number for r in rows} == {1}
    keys = {r.partition_key for r in rows}
    assert "Labour Court|2024-01-15" in keys and "Equality Tribunal|2024-03-01" in keys
    url = next(r.url for r in rows if r.partition_key == "Labour Court|2024-02-01")
    assert url == "https://x/s/?decisions=1&body=3&from=01%2F02%2F2024&to=29%2F02%2F2024&pageNumber=1"
    plan = requests._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert sources.body_dimension(spark).count() == 4


def test_generate_partitions_keeps_other_columns(spark):
    frame = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 2, 1)), (2, dt.date(2024, 3, 1), dt.date(2024, 2, 1))],
                                  "range_id int, range_start date, range_end date")
    assert [tuple(r)[0] for r in frontier.generate_partitions(frame).collect()] == [1, 1]


def test_unfinished(spark):
    requests = frontier.frontier(frontier.range_row(spark, "2024-01-01", "2024-03-31"), {"B": "1"}, "https://x/")
    done = spark.createDataFrame([("B", "2024-01-01", 2, 0), ("B", "2024-02-01", 2, 1)],
                                 "body string, partition_start string, pages_captured long, records_failed long")
    left = frontier.unfinished(requests, done)
    assert sorted(str(r.partition_start) for r in left.collect()) == ["2024-02-01", "2024-03-01"]


# -- reconciliation ------------------------------------------------------------------


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_skip_known_partitions_the_input(spark):
    rows = frame(spark, [("a", 1), ("b", 2), ("a", 3), (None, 4)], "identifier string, n int")
    known = frame(spark, [("a",), ("z",)], "identifier string")
    fresh = {r.n for r in reconcile.skip_known(rows, known).collect()}
    old = {r.n for r in reconcile.skipped_known(rows, known).collect()}
    assert (fresh, old) == ({2, 4}, {1, 3})
    assert {r.n: r.is_known for r in reconcile.flag_known(rows, known).collect()} == {1: True, 2: False, 3: True, 4: False}


def test_first_and_last_per_key(spark):
    rows = frame(spark, [("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert sorted(tuple(r) for r in reconcile.first_per_key(rows, "k", ["o"]).collect()) == [("a", 1, "y"), ("b", 5, "z")]
    assert sorted(tuple(r) for r in reconcile.last_per_key(rows, "k", ["o"]).collect()) == [("a", 2, "x"), ("b", 5, "z")]
    plan = reconcile.first_per_key(rows, "k", ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_classify_changes(spark):
    stored = frame(spark, [("null", None), ("same", "h"), ("differs", "h"), ("lost", "h")], "identifier string, file_hash string")
    rows = frame(spark, [("absent", "h"), ("null", "h"), ("same", "h"), ("differs", "g"), ("lost", None)],
                 "identifier string, file_hash string")
    actions = {r.identifier: r.action for r in reconcile.classify_changes(rows, stored).collect()}
    assert actions == {"absent": "insert", "null": "insert_noop", "same": "skip", "differs": "update", "lost": "update"}
    repaired = {r.identifier: r.action for r in reconcile.classify_changes(rows, stored, repair_failed=True).collect()}
    assert repaired == {"absent": "insert", "null": "update", "same": "skip", "differs": "update", "lost": "skip"}
    assert stats.sink_counts(reconcile.classify_changes(rows, stored)).first().asDict() == {
        "inserted": 2, "updated": 2, "skipped": 1}


def test_classify_upserts(spark):
    stored = frame(spark, [("null", None), ("same", "h"), ("differs", "h")], "identifier string, file_hash string")
    rows = frame(spark, [("absent", "h"), ("null", "h"), ("same", "h"), ("differs", "g")], "identifier string, file_hash string")
    got = {r.identifier: r.status for r in reconcile.classify_upserts(rows, stored).collect()}
    assert got == {"absent": "inserted", "null": "updated", "same": "skipped", "differs": "updated"}


def sequential_fold(rows, stored):
    """One pass in order with a cache of hashes, as a store that handles one item at a time."""
    cache, table, actions = dict(stored), dict(stored), {}
    for key, order, value in sorted(rows, key=lambda r: r[1]):
        if cache.get(key) is None:
            action = "insert" if key not in table else "insert_noop"
            table.setdefault(key, value)
        elif cache[key] != value:
            action = "update"
            table[key] = value
        else:
            action = "skip"
        if action != "skip":
            cache[key] = value
        actions[key, order] = action
    return actions, table


@pytest.mark.parametrize("keys, hot", [(150, 0.0), (20, 0.0), (40, 0.5)])
def test_fold_equals_a_sequential_loop(spark, keys, hot):
    rng = random.Random(keys)
    rows = [(0 if rng.random() < hot else rng.randrange(keys), i, rng.choice(["a", "b", "c", None])) for i in range(3000)]
    stored = {k: rng.choice(["a", "b", None]) for k in range(0, keys, 2)}
    expected, table = sequential_fold(rows, stored)
    incoming = frame(spark, rows, "identifier int, o int, file_hash string").repartition(5)
    before = frame(spark, list(stored.items()), "identifier int, file_hash string")
    folded = reconcile.fold_changes(incoming, before, ["o"])
    got = {(r.identifier, r.o): r.action for r in folded.collect()}
    assert got == expected
    final = {r.identifier: r.file_hash for r in reconcile.last_applied(folded, ["o"]).collect()}
    assert {**stored, **final} == table


def test_fold_without_stored_rows(spark):
    rows = frame(spark, [("k", 1, "h"), ("k", 2, "g"), ("k", 3, "g"), ("n", 1, None), ("n", 2, "h")],
                 "identifier string, o int, file_hash string")
    got = {(r.identifier, r.o): r.action for r in reconcile.fold_changes(rows, None, ["o"]).collect()}
    assert got == {("k", 1): "insert", ("k", 2): "update", ("k", 3): "skip", ("n", 1): "insert", ("n", 2): "insert_noop"}


def test_hot_key_is_spread_over_tasks(spark):
    """One key with all rows: its windows must run in several groups."""
    rows = spark.range(20_000, numPartitions=4).select(
        F.lit("hot").alias("identifier"), F.col("id").alias("o"), (F.col("id") % 3).cast("string").alias("file_hash"))
    chained = reconcile.previous_value(rows, "identifier", ["o"], "file_hash")
    wrong = chained.filter(~F.col("previous").eqNullSafe(F.when(F.col("o") > 0, ((F.col("o") - 1) % 3).cast("string"))))
    assert wrong.count() == 0 and chained.filter("is_first").count() == 1
    spread = chained.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 20_000


def test_changed_sources(spark):
    landing = frame(spark, [("a", "h"), ("b", "g"), ("c", None), ("d", "x")], "identifier string, file_hash string")
    done = frame(spark, [("a", "h"), ("b", "h"), ("c", None)], "identifier string, original_file_hash string")
    assert {r.identifier for r in reconcile.changed_sources(landing, done).collect()} == {"b", "c", "d"}


def test_uniqueness(spark):
    rows = frame(spark, [("a",), ("b",), ("a",)], "identifier string")
    assert [tuple(r) for r in reconcile.duplicate_keys(rows).collect()] == [("a", 2)]
    with pytest.raises(ValueError, match="duplicate values of identifier"):
        reconcile.require_unique(rows)
    assert reconcile.require_unique(rows.distinct()).count() == 2


def test_duplicate_content(spark):
    rows = frame(spark, [("a", "h"), ("b", "h"), ("c", "g"), ("d", None), ("e", None)], "identifier string, file_hash string")
    assert [tuple(r) for r in reconcile.duplicate_content(rows).collect()] == [("h", 2, "a")]


def test_reconcile_zones(spark):
    landing = frame(spark, [("ok", "p1"), ("new", "p2"), ("lost", "p3"), ("failed", None)], "identifier string, file_path string")
    transformed = frame(spark, [("ok", "ok.html"), ("gone", "gone.html")], "identifier string, file_path string")
    blobs = frame(spark, [("p1",), ("p2",)], "file_path string")
    got = {r.identifier: r.state for r in reconcile.reconcile_zones(landing, transformed, blobs).collect()}
    assert got == {"ok": "ok", "new": "pending", "lost": "missing_blob", "failed": "no_path", "gone": "orphan"}
    assert [r.identifier for r in reconcile.blobs_missing(landing, blobs).collect()] == ["lost"]
    assert {r.identifier for r in reconcile.blobs_present(landing, blobs).collect()} == {"ok", "new"}


# -- statistics --------------------------------------------------------------------------

JAN, JAN_END = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
OUTCOME = "body string, partition_start date, partition_end date, identifier string, outcome string, url string, error string"


def outcome(kind, n=0, error=None, body="B"):
    return (body, JAN, JAN_END, f"I{n}", kind, f"u{n}", error)


def make_stats(spark, outcomes, pages):
    requests = frontier.frontier(frontier.range_row(spark, "2024-01-01", "2024-02-29"), {"B": "1"}, "https://x/")
    page_frame = frame(spark, pages, "body string, partition_start date, partition_end date, page_number int, page_total long, error string")
    return stats.partition_stats(requests, page_frame, frame(spark, outcomes, OUTCOME))


def test_partition_stats(spark):
    outcomes = [outcome("landed"), outcome("no_url"), outcome("failed", 1, "503"), outcome("skipped"), outcome("skipped"),
                outcome("bad_item", 2, "x"), outcome("request_failed", 3, "timeout")]
    pages = [("B", JAN, JAN_END, 1, 9, None), ("B", JAN, JAN_END, 2, 99, None), ("B", JAN, JAN_END, 3, None, "timeout")]
    result = make_stats(spark, outcomes, pages)
    rows = {r.partition_start: r for r in stats.completeness(result).collect()}
    january = rows[JAN]
    assert (january.total_results, january.records_scraped, january.records_skipped, january.records_failed) == (9, 3, 2, 3)
    assert (january.pages_captured, january.missing_results) == (2, 4)
    february = rows[dt.date(2024, 2, 1)]
    assert (february.total_results, february.records_scraped, february.records_failed) == (0, 0, 0)

    frame_out = frame(spark, outcomes, OUTCOME)
    summary = stats.crawl_summary(result, "shutdown").first()
    assert json.loads(summary.message.removeprefix("Crawl summary: ")) == {
        "event": "crawl_complete", "reason": "shutdown", "total_expected": 9, "total_scraped": 3, "total_skipped": 2,
        "total_failed": 3, "partitions_processed": 2}
    messages = stats.partition_messages(result, frame_out, shown=2)
    data = json.loads(messages.filter("partition_start = '2024-01-01'").first().message.removeprefix("Partition summary: "))
    assert data == {"body": "B", "partition_start": "2024-01-01", "partition_end": "2024-01-31", "total_results": 9,
                    "records_scraped": 3, "records_skipped": 2, "records_failed": 3,
                    "failed_urls": [{"url": "u1", "error": "503"}, {"url": "u2", "error": "x"}]}
    for chunk_rows, chunks in ((1000, 1), (2, 2), (1, 3)):
        stored = stats.partition_summaries(result, frame_out, chunk_rows)
        history = logs.partition_history(stored.select("message")).filter("partition_start = '2024-01-01'")
        rows = logs.partition_failures(history).collect()
        assert history.count() == chunks and sorted((r.url, r.error) for r in rows if r.url) == [("u1", "503"), ("u2", "x"), ("u3", "timeout")]
        empty = logs.partition_failures(logs.partition_history(stored.select("message")).filter("partition_start = '2024-02-01'")).collect()
        assert [(r.records_failed, r.url) for r in empty] == [(0, None)]
    nulls = stats.partition_messages(result.withColumn("total_results", F.lit(None).cast("bigint")), frame_out).first().message
    assert '"total_results":null' in nulls
    assert logs.run_history(stats.crawl_summary(result).select("message")).first().total_failed == 3
    totals = {(r.body, r.partition_start): r.records_scraped for r in stats.rollup_stats(result).collect()}
    assert totals == {("B", JAN): 3, ("B", dt.date(2024, 2, 1)): 0, ("B", None): 3, (None, None): 3}


def test_failures(spark):
    rows = frame(spark, [outcome("failed", n, f"e{n}") for n in range(9)] + [outcome("landed", 10)], OUTCOME)
    assert stats.failed_urls(rows).count() == 9
    first = stats.first_failed_urls(rows, 3)
    assert [f.url for f in first.first().failed_urls] == ["u0", "u1", "u2"]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    events = stats.failure_events(frame(spark, [outcome("failed", 1, "503"), outcome("request_failed", 2, "t")], OUTCOME))
    messages = sorted(r.message for r in events.collect())
    assert json.loads(messages[0].removeprefix("Document download failed: ")) == {
        "event": "document_download_failed", "identifier": "I1", "url": "u1", "error": "503", "body": "B", "partition": "2024-01-01"}
    assert "identifier" not in messages[1] and messages[1].startswith("Request failed: ")


def test_transform_counts(spark):
    statuses = frame(spark, [("inserted",), ("updated",), ("skipped",), ("no_path",), ("missing_blob",)], "status string")
    assert stats.transform_counts(statuses).first().asDict() == {"inserted": 1, "updated": 1, "skipped": 1, "failed": 2}


def test_observed_counts_without_an_extra_job(spark):
    from pyspark.sql import Observation

    watch = Observation("scan")
    spark.range(7).observe(watch, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    assert watch.get["rows"] == 7
    assert stats.observed(spark.range(3), "m").count() == 3


# -- logs and sources -------------------------------------------------------------------------

LOG = """2024-01-01 [spider] INFO: Spider opened
{"level": "ERROR", "message": "Request failed: u"}
{"a": 1}

[x] DEBUG: noise
2024-01-01 [spider] INFO: Dumping stats:
{'item_scraped_count': 12,
 'elapsed_time_seconds': 69.5,
 'downloader/request_count': 40,
 'log_count/ERROR': 1}
 'item_scraped_count': 99,
"""


def test_log_files(spark, tmp_path):
    (tmp_path / "run1.log").write_text(LOG)
    (tmp_path / "run2.log").write_text("nothing\n")
    lines = sources.log_lines(spark, str(tmp_path))
    parsed = logs.parse_lines(lines)
    assert {r.channel: r.n_lines for r in logs.level_counts(parsed).collect()} == {"info": 2, "error": 1}
    shown = logs.shown_lines(parsed, ["Spider opened", "Request failed"])
    assert sorted((r.level, r.channel) for r in shown.collect()) == [("ERROR", "error"), ("INFO", "info")]
    got = {r.file[-8:]: r for r in logs.run_stats(lines, ["block", "seq"]).collect()}
    row = got["run1.log"]
    assert (row["items"], row.elapsed, row.requests, row.retries, row.errors) == ("12", "69.5", "40", None, "1")
    assert got["run2.log"]["items"] is None


def test_shown_lines_format_and_default_level(spark):
    rows = frame(spark, [(None, 'Crawl summary: {"event": "e"}'), ("INFO", "")], "level string, message string")
    shown = logs.shown_lines(rows, ["summary"], format_messages=True).collect()
    assert [(r.level, r.message) for r in shown] == [("INFO", "Crawl complete | partitions: 0, found: 0, new: 0, skipped: 0, failed: 0")]


def test_log_stream(spark, tmp_path):
    source = tmp_path / "logs"
    source.mkdir()
    (source / "a.log").write_text(LOG)
    query = (logs.parse_lines(sources.log_stream(spark, str(source))).filter("message <> ''").writeStream
             .format("memory").queryName("log_lines").trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("log_lines").count() == 3


def test_object_tree(spark, tmp_path):
    folder = tmp_path / "objects" / "Labour_Court" / "2024-01-01"
    folder.mkdir(parents=True)
    (folder / "A.html").write_bytes(b"<p>a</p>")
    row = sources.object_tree(spark, str(tmp_path / "objects"), str(tmp_path / "objects")).first()
    assert (row.file_path, bytes(row.content), row.length) == ("Labour_Court/2024-01-01/A.html", b"<p>a</p>", 8)


def test_capture_readers(spark, tmp_path):
    spark.createDataFrame([], schemas.SEARCH_PAGES).write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([], schemas.DOC_RESPONSES).write.parquet(str(tmp_path / "d"))
    assert sources.search_pages(spark, str(tmp_path / "p")).count() == 0
    assert sources.doc_responses(spark, str(tmp_path / "d")).columns == schemas.DOC_RESPONSES.fieldNames()
    assert sources.search_pages_stream(spark, str(tmp_path / "p"), 1).isStreaming
