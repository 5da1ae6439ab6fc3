"""The landing and transform jobs end to end, on small captures."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docstrata.plans.both import land_and_transform
from docstrata.plans.landing import LandingRun, land, write_reports
from docstrata.plans.transform import TransformRun, transform
from docstrata.sources.captures import ResponseLog
from docstrata.sources.store import LANDING, TRANSFORMED, Lake
from docstrata.streaming.jobs import stream_landing, stream_transform
from tests.conftest import SITE, TS, doc_row, page_row

BODIES = {"Labour Court": "3", "Equality Tribunal": "2"}
RUN = LandingRun("2024-01-01", "2024-02-29", SITE, 1, "2024-03-01T00:00:00", bodies=BODIES)


def html(text, extra=""):
    return f"<html><body>{extra}<div id='main'>{text}</div></body></html>".encode()


def first_captures():
    pages = [
        page_row("Labour Court", "2024-01-01", "2024-01-31", [
            {"id": "A/B 1", "href": "/a"}, {"id": "P1", "href": "/p"}, {"id": "", "href": "/none"}, {"id": "NOLINK"},
        ], total=5),
        page_row("Labour Court", "2024-02-01", "2024-02-29", [{"id": "F1", "href": "/f"}, {"id": "D1", "href": "/d"}], total=2),
        page_row("Equality Tribunal", "2024-01-01", "2024-01-31", [], error="timeout"),
    ]
    docs = [
        doc_row("/a", html("alpha")),
        doc_row("/p", b"%PDF raw", "application/PDF"),
        doc_row("/f", error="503"),
        doc_row("/d", b"DOC raw", "application/msword"),
    ]
    return pages, docs


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def state(lake, zone=LANDING):
    return {r.identifier: r for r in lake.current(zone).collect()}


def test_landing_records(lake, captures):
    result = land(lake, *captures(*first_captures()), RUN)
    rows = state(lake)
    assert set(rows) == {"A/B 1", "P1", "NOLINK", "F1", "D1"}
    assert rows["A/B 1"].file_path == "Labour_Court/2024-01-01/A-B 1.html"
    assert rows["P1"].file_type == "pdf" and rows["D1"].file_type == "doc"
    assert (rows["F1"].file_type, rows["F1"].file_hash, rows["F1"].file_path) == ("unknown", None, None)
    assert (rows["NOLINK"].file_type, rows["NOLINK"].doc_url) == (None, "")
    assert rows["P1"].partition_date == "2024-01-01" and rows["P1"].published_date_iso == "2024-01-05"

    stats = {(r.body, str(r.partition_start)): r for r in result.stats.collect()}
    assert len(stats) == 4
    january = stats["Labour Court", "2024-01-01"]
    assert (january.total_results, january.records_scraped, january.records_skipped, january.records_failed) == (5, 3, 0, 0)
    february = stats["Labour Court", "2024-02-01"]
    assert (february.records_scraped, february.records_failed) == (2, 1)
    assert stats["Equality Tribunal", "2024-01-01"].records_failed == 1
    assert stats["Equality Tribunal", "2024-02-01"].records_scraped == 0
    assert result.counts().first().asDict() == {"inserted": 5, "updated": 0, "skipped": 0}
    summary = result.summary().first()
    assert (summary.total_expected, summary.total_scraped, summary.total_failed, summary.partitions_processed) == (7, 5, 2, 4)
    failed = [r for r in result.summaries().collect() if r.failed_urls]
    assert {f.failed_urls[0].error for f in failed} == {"503", "timeout"}


def test_second_run_adds_nothing(lake, captures):
    frames = captures(*first_captures())
    land(lake, *frames, RUN)
    before = state(lake)
    again = land(lake, *frames, replace(RUN, version=2))
    assert again.counts().first().asDict() == {"inserted": 0, "updated": 0, "skipped": 0}
    assert state(lake) == before
    assert lake.log(LANDING).filter("version = 2").count() == 0


def test_replaying_a_version_changes_nothing(lake, captures):
    frames = captures(*first_captures())
    land(lake, *frames, RUN)
    before = state(lake)
    land(lake, *frames, RUN)
    assert state(lake) == before


@pytest.mark.parametrize("step", ["write_blobs", "write_log", "commit"])
def test_failed_replay_keeps_what_was_committed(lake, captures, monkeypatch, step):
    frames = captures(*first_captures())
    land(lake, *frames, RUN)
    transform(lake, TransformRun("2024-01-01", "2024-12-31", 1, RUN.run_ts))
    lake.compact(LANDING, "t")

    def content():
        return sorted((zone, r.file_path, bytes(r.content or b"")) for zone in (LANDING, TRANSFORMED) for r in lake.objects(zone).collect())

    before, objects = state(lake), content()
    assert objects

    def fail(*args, **kwargs):
        raise OSError("disk full")

    with monkeypatch.context() as broken:
        broken.setattr(type(lake), step, fail)
        with pytest.raises(OSError):
            land(lake, *frames, RUN)
        with pytest.raises(OSError):
            transform(lake, TransformRun("2024-01-01", "2024-12-31", 1, RUN.run_ts))
    assert state(lake) == before and content() == objects
    with monkeypatch.context() as broken:
        broken.setattr(type(lake), "_mark", fail)
        lake.write_log(lake.log(LANDING), LANDING, 2)
        with pytest.raises(OSError):
            lake.commit(LANDING, 2, "t")
    assert state(lake) == before
    land(lake, *frames, RUN)
    assert state(lake) == before and content() == objects


def test_dates_in_other_iso_forms(lake, captures):
    frames = captures(*first_captures())
    land(lake, *frames, RUN)
    basic = replace(RUN, start_date=RUN.start_date.replace("-", ""), end_date=RUN.end_date.replace("-", ""), version=2)
    again = land(lake, *frames, basic)
    assert again.counts().first().inserted == 0
    moved = transform(lake, TransformRun(basic.start_date, basic.end_date, 1, RUN.run_ts))
    assert moved.statuses.count() > 0


def test_uncommitted_version_is_invisible(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    lake.write_log(lake.log(LANDING).withColumn("identifier", F.lit("GHOST")), LANDING, 2)
    assert "GHOST" not in state(lake)


def rerun(lake, captures, items, docs, start="2024-01-15", **changes):
    """A later run over another partition start, so the skip set does not cover the rows."""
    run = replace(RUN, start_date=start, version=2, **changes)
    pages = [page_row("Labour Court", start, "2024-02-29", items, total=1)]
    return land(lake, *captures(pages, docs), run)


def test_changed_hash_updates_and_moves_the_row(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    result = rerun(lake, captures, [{"id": "A/B 1", "href": "/a2"}, {"id": "P1", "href": "/p"}],
                   [doc_row("/a2", html("beta")), doc_row("/p", b"%PDF raw", "application/pdf")])
    assert result.counts().first().asDict() == {"inserted": 0, "updated": 1, "skipped": 1}
    row = state(lake)["A/B 1"]
    assert (row.partition_date, row.file_path) == ("2024-01-15", "Labour_Court/2024-01-15/A-B 1.html")
    in_january = {r.identifier for r in lake.in_range(LANDING, "2024-01-01", "2024-01-10").collect()}
    assert in_january == {"P1", "NOLINK"}


def test_null_hash_is_sticky_unless_repaired(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    good = ([{"id": "F1", "href": "/f"}], [doc_row("/f", html("now fine"))])
    result = rerun(lake, captures, *good, start="2024-02-15")
    assert result.counts().first().inserted == 1
    assert state(lake)["F1"].file_hash is None
    rerun(lake, captures, *good, start="2024-02-15", repair_failed=True)
    assert state(lake)["F1"].file_hash is not None


def test_failed_download_nulls_a_good_row_unless_repaired(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    bad = ([{"id": "A/B 1", "href": "/a"}], [doc_row("/a", error="reset")])
    rerun(lake, captures, *bad, repair_failed=True)
    assert state(lake)["A/B 1"].file_hash is not None
    rerun(lake, captures, *bad)
    assert (state(lake)["A/B 1"].file_hash, state(lake)["A/B 1"].file_type) == (None, "unknown")


def test_record_without_link_keeps_stored_file_fields(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    old = state(lake)["A/B 1"]
    result = rerun(lake, captures, [{"id": "A/B 1", "description": "renamed"}], [])
    assert result.counts().first().updated == 1
    new = state(lake)["A/B 1"]
    assert new.description == "renamed"
    assert (new.file_path, new.file_hash, new.file_type) == (old.file_path, old.file_hash, old.file_type)


def test_in_run_duplicates(lake, captures):
    pages = [
        page_row("Labour Court", "2024-01-01", "2024-01-31", [
            {"id": "X", "href": "/bad", "description": "first"},
            {"id": "X", "href": "/x", "description": "second"},
            {"id": "X", "href": "/x2", "description": "third"},
        ], total=3),
    ]
    docs = [doc_row("/bad", error="503"), doc_row("/x", html("x")), doc_row("/x2", html("x2"))]
    result = land(lake, *captures(pages, docs), RUN)
    january = result.stats.filter("body = 'Labour Court' and partition_start = '2024-01-01'").first()
    assert (january.records_scraped, january.records_skipped, january.records_failed) == (2, 1, 1)
    assert result.counts().first().asDict() == {"inserted": 2, "updated": 0, "skipped": 0}
    assert state(lake)["X"].description == "first" and state(lake)["X"].file_hash is None
    # The document of the second arrival is stored all the same.
    assert [r.file_path for r in lake.blob_index(LANDING).collect()] == ["Labour_Court/2024-01-01/X.html"]


def test_hash_update_folds_all_arrivals(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    pages = [page_row("Labour Court", "2024-01-01", "2024-01-31", [
        {"id": "P1", "href": "/p", "description": "same"},
        {"id": "P1", "href": "/p2", "description": "changed"},
        {"id": "P1", "href": "/p3", "description": "same again"},
        {"id": "F1", "href": "/p", "description": "stuck"},
        {"id": "F1", "href": "/p2", "description": "applied"},
    ], total=5)]
    docs = [doc_row("/p", b"%PDF raw", "application/pdf"), doc_row("/p2", b"%PDF two", "application/pdf"),
            doc_row("/p3", b"%PDF two", "application/pdf")]
    result = land(lake, *captures(pages, docs), replace(RUN, version=2, policy="hash_update"))
    assert result.counts().first().asDict() == {"inserted": 1, "updated": 2, "skipped": 2}
    assert state(lake)["P1"].description == "changed"
    assert state(lake)["F1"].description == "applied"


def test_link_less_rows_keep_file_fields_of_the_same_run(lake, captures):
    pages = [page_row("Labour Court", "2024-01-01", "2024-01-31", [
        {"id": "N", "href": "/n", "description": "with file"}, {"id": "N", "description": "renamed"},
        {"id": "M", "description": "no file"}, {"id": "M", "href": "/n", "description": "stuck"},
        {"id": "F", "href": "/bad"}, {"id": "F", "description": "x"},
    ], total=6)]
    docs = [doc_row("/n", html("n")), doc_row("/bad", error="503")]
    result = land(lake, *captures(pages, docs), replace(RUN, policy="hash_update"))
    assert result.counts().first().asDict() == {"inserted": 5, "updated": 1, "skipped": 0}
    rows = state(lake)
    assert rows["N"].description == "renamed" and rows["N"].file_path == "Labour_Court/2024-01-01/N.html"
    assert (rows["M"].description, rows["M"].file_path, rows["M"].file_type) == ("no file", None, None)
    assert (rows["F"].file_type, rows["F"].file_hash) == ("unknown", None)


def test_transform_by_published_date(lake, captures):
    pages = [page_row("Labour Court", "2024-01-01", "2024-01-31", [
        {"id": "EARLY", "href": "/n", "date": "05/01/2024"}, {"id": "LATE", "href": "/n", "date": "25/01/2024"}], total=2)]
    land(lake, *captures(pages, [doc_row("/n", html("n"))]), RUN)
    run = replace(TRANSFORM, start_date="2024-01-20", date_col="published_date_iso")
    assert [r.identifier for r in transform(lake, run).statuses.collect()] == ["LATE"]


def test_write_once_policy(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    before = state(lake)
    result = rerun(lake, captures, [{"id": "A/B 1", "href": "/a2"}], [doc_row("/a2", html("beta"))], policy="write_once")
    assert result.outcomes.first().outcome == "skipped"
    assert state(lake) == before


def test_pending_documents_are_not_landed(lake, captures):
    pages, docs = first_captures()
    result = land(lake, *captures(pages, docs[:1]), RUN)
    assert set(state(lake)) == {"A/B 1", "NOLINK"}
    assert {r.url for r in result.pending().collect()} == {SITE + "/p", SITE + "/f", SITE + "/d"}


TRANSFORM = TransformRun("2024-01-01", "2024-02-29", 1, "2024-03-02T00:00:00")


def content_of(lake, zone):
    return {r.file_path: bytes(r.content) for r in lake.objects(zone).collect()}


def test_transform(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    result = transform(lake, TRANSFORM)
    assert result.counts().first().asDict() == {"inserted": 3, "updated": 0, "skipped": 0, "failed": 2}
    rows = state(lake, TRANSFORMED)
    assert rows["A/B 1"].file_path == "A-B_1.html"
    assert rows["A/B 1"].original_file_path == "Labour_Court/2024-01-01/A-B 1.html"
    assert content_of(lake, TRANSFORMED) == {
        "A-B_1.html": b'<div id="main">alpha</div>', "P1.pdf": b"%PDF raw", "D1.doc": b"DOC raw",
    }
    again = transform(lake, replace(TRANSFORM, version=2))
    assert again.counts().first().asDict() == {"inserted": 0, "updated": 0, "skipped": 3, "failed": 2}
    assert lake.blobs(TRANSFORMED).filter("version = 2 and content is not null").count() == 0
    assert set(content_of(lake, TRANSFORMED)) == {"A-B_1.html", "P1.pdf", "D1.doc"}


def test_transform_updates_only_the_changed(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    transform(lake, TRANSFORM)
    rerun(lake, captures, [{"id": "A/B 1", "href": "/a2"}], [doc_row("/a2", html("beta"))])
    for mode, version in (("source_hash", 2), ("code", 3)):
        result = transform(lake, replace(TRANSFORM, version=version, mode=mode))
        expected = {"source_hash": (1, 2), "code": (0, 3)}[mode]
        counts = result.counts().first()
        assert (counts.updated, counts.skipped, counts.failed) == (*expected, 2)
    assert content_of(lake, TRANSFORMED)["A-B_1.html"] == b'<div id="main">beta</div>'


def test_empty_document_keeps_path_and_fails_in_transform(lake, captures):
    pages = [page_row("Labour Court", "2024-01-01", "2024-01-31", [{"id": "E", "href": "/e"}], total=1)]
    land(lake, *captures(pages, [doc_row("/e", b"")]), RUN)
    assert state(lake)["E"].file_path == "Labour_Court/2024-01-01/E.html"
    assert transform(lake, TRANSFORM).statuses.first().status == "missing_blob"


def test_shared_document_is_stored_once(lake, captures):
    items = [{"id": f"S{i}", "href": "/shared"} for i in range(20)]
    pages = [page_row("Labour Court", "2024-01-01", "2024-01-31", items, total=20)]
    land(lake, *captures(pages, [doc_row("/shared", html("same"))]), RUN)
    assert lake.blobs(LANDING).count() == 1 and lake.current(LANDING).count() == 20
    assert transform(lake, TRANSFORM).counts().first().inserted == 20
    assert lake.blobs(TRANSFORMED).count() == 1 and len(content_of(lake, TRANSFORMED)) == 20


def test_repeated_captures_change_nothing(lake, spark, captures, tmp_path):
    pages, docs = first_captures()
    later = dt.timedelta(hours=1)
    retried = [doc_row("/f", error="504", at=TS + later), doc_row("/a", html("newer"), at=TS + later),
               doc_row("/p", error="reset", at=TS - later)]
    once = Lake(spark, str(tmp_path / "once"))
    first = land(once, *captures(pages, docs), RUN)
    twice = land(lake, *captures(pages * 2, docs * 3 + retried), RUN)
    assert state(lake) == state(once)
    assert content_of(lake, LANDING) == content_of(once, LANDING)
    assert sorted(map(tuple, twice.stats.collect())) == sorted(map(tuple, first.stats.collect()))
    assert transform(lake, TRANSFORM).counts().first() == transform(once, TRANSFORM).counts().first()


def test_hot_identifier_and_hot_link(lake, captures):
    """A third of all rows share one identifier, another third one link."""
    items, number = [], 120
    for n in range(number):
        items.append({"id": "HOT", "href": f"/hot{n}", "description": f"d{n}"})
        items.append({"id": f"L{n}", "href": "/link"})
        items.append({"id": f"P{n}"})
    pages = [page_row("Labour Court", "2024-01-01", "2024-01-31", items[i:i + 30], total=3 * number, number=i // 30 + 1)
             for i in range(0, len(items), 30)]
    docs = [doc_row("/link", html("link"))] + [
        doc_row(f"/hot{n}", html(str(n)), error="503" if n < 50 else None) for n in range(number)]
    result = land(lake, *captures(pages, docs), RUN)
    january = result.stats.filter("body = 'Labour Court' and partition_start = '2024-01-01'").first()
    # 50 failures, then one that lands, then 69 repeats.
    assert (january.records_scraped, january.records_skipped, january.records_failed) == (51 + 2 * number, 69, 50)
    rows = state(lake)
    assert len(rows) == 1 + 2 * number and rows["HOT"].file_hash is None and rows["HOT"].description == "d0"
    assert lake.blobs(LANDING).count() == 2
    repeat = replace(RUN, version=2, start_date="2024-01-01", policy="hash_update")
    folded = land(lake, *captures(pages, docs), repeat).counts().first()
    assert folded.asDict() == {"inserted": 51 + number, "updated": 69, "skipped": number}
    assert state(lake)["HOT"].description == f"d{number - 1}"


def test_colliding_names_last_upload_wins(lake, captures):
    pages = [page_row("Labour Court", "2024-01-01", "2024-01-31", [{"id": "A/B", "href": "/1"}, {"id": "A-B", "href": "/2"}], total=2)]
    land(lake, *captures(pages, [doc_row("/1", html("one")), doc_row("/2", html("two"))]), RUN)
    assert lake.current(LANDING).count() == 2 and lake.blob_index(LANDING).count() == 1


def test_snapshot_gives_the_same_state(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    assert lake.compact(LANDING, "t") == 1
    rerun(lake, captures, [{"id": "A/B 1", "href": "/a2"}, {"id": "NEW", "href": "/n"}],
          [doc_row("/a2", html("beta")), doc_row("/n", html("n"))])
    columns = ["identifier", "file_hash", "partition_date", "file_path"]
    with_snapshot = {tuple(r) for r in lake.current(LANDING).select(*columns).collect()}
    index = {tuple(r) for r in lake.blob_index(LANDING).collect()}
    assert lake.compact(LANDING, "t") == 2
    assert {tuple(r) for r in lake.current(LANDING).select(*columns).collect()} == with_snapshot
    assert {tuple(r) for r in lake.blob_index(LANDING).collect()} == index
    # A replay of version 2 must not see the snapshot that contains it.
    assert lake.current(LANDING, before=2).filter("identifier = 'NEW'").count() == 0
    assert {r.identifier for r in lake.current(LANDING).collect()} == {"A/B 1", "P1", "NOLINK", "F1", "D1", "NEW"}


def test_land_and_transform_twice(lake, captures):
    frames = captures(*first_captures())
    first = land_and_transform(lake, *frames, RUN)
    assert first.transform.counts().first().inserted == 3
    second = land_and_transform(lake, *frames, replace(RUN, version=2))
    assert second.landing.counts().first().inserted == 0
    assert second.transform.counts().first().skipped == 3


def test_streams(lake, spark, captures, tmp_path):
    pages, docs = first_captures()
    frame, responses = captures(pages, docs)
    source = str(tmp_path / "pages")
    frame.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(frame.schema).parquet(source)
    stream_landing(lake, stream, responses, RUN, str(tmp_path / "c1")).awaitTermination()
    landed = state(lake)
    assert set(landed) == {"A/B 1", "P1", "NOLINK", "F1", "D1"}
    stream_transform(lake, TRANSFORM, str(tmp_path / "c2")).awaitTermination()
    assert set(state(lake, TRANSFORMED)) == {"A/B 1", "P1", "D1"}
    # Replay with a fresh checkpoint and fresh versions: nothing new.
    stream = spark.readStream.schema(frame.schema).parquet(source)
    later = replace(RUN, version=lake.next_version(LANDING))
    stream_landing(lake, stream, responses, later, str(tmp_path / "c3")).awaitTermination()
    assert state(lake) == landed
    stream_transform(lake, replace(TRANSFORM, version=2), str(tmp_path / "c2")).awaitTermination()
    assert lake.log(TRANSFORMED).filter("version > 1").count() == 0


def test_views(lake, spark, captures):
    land(lake, *captures(*first_captures()), RUN)
    transform(lake, TRANSFORM)
    lake.create_views()
    joined = spark.sql(
        "SELECT t.identifier, o.length FROM transformed_metadata t JOIN transformed_objects o USING (file_path) ORDER BY 1"
    )
    assert [tuple(r) for r in joined.collect()] == [("A/B 1", 26), ("D1", 7), ("P1", 8)]
    assert spark.sql("SELECT count(*) FROM landing_metadata").first()[0] == 5


def test_reports(lake, spark, captures):
    result = land(lake, *captures(*first_captures()), RUN)
    write_reports(lake, result)
    summary = spark.read.json(lake.path("reports", "crawl_summary")).first()
    assert (summary.event, summary.total_scraped) == ("crawl_complete", 5)
    assert spark.read.json(lake.path("reports", "failures")).count() == 2
    assert spark.read.json(lake.path("reports", "partition_summaries")).count() == 4


def test_unknown_parameters(lake, captures):
    with pytest.raises(ValueError, match="policy"):
        land(lake, *captures(*first_captures()), replace(RUN, policy="x"))
    with pytest.raises(ValueError, match="mode"):
        transform(lake, replace(TRANSFORM, mode="x"))
    with pytest.raises(ValueError, match="before it starts"):
        land(lake, *captures(*first_captures()), replace(RUN, end_date="2023-01-01"))


# -- late documents ---------------------------------------------------------------------------


def response_log(spark, captures, path, *parts):
    """A folder with one file for each list of response rows."""
    for rows in parts:
        captures([], rows)[1].coalesce(1).write.mode("append").parquet(str(path))
    return ResponseLog(spark, str(path))


def test_late_documents_land_with_a_later_run(lake, spark, captures, tmp_path):
    pages, docs = first_captures()
    none = captures([], [])[0]
    log = response_log(spark, captures, tmp_path / "docs", docs[:1])
    run = replace(RUN, keep_pending=True)
    land(lake, captures(pages, [])[0], log, run)
    assert set(state(lake)) == {"A/B 1", "NOLINK"}
    assert {r.identifier for r in lake.pending().collect()} == {"P1", "F1", "D1"}
    response_log(spark, captures, tmp_path / "docs", docs[1:3])
    second = land(lake, none, log, replace(run, version=2))
    assert {r.identifier for r in lake.pending().collect()} == {"D1"}
    assert {(r.identifier, r.outcome) for r in second.outcomes.collect()} == {("P1", "landed"), ("F1", "failed")}
    response_log(spark, captures, tmp_path / "docs", docs[3:])
    land(lake, none, log, replace(run, version=3))
    before = state(lake)
    assert lake.pending().isEmpty() and set(before) == {"A/B 1", "P1", "NOLINK", "F1", "D1"}
    # Delivered again: the queue of the version before counts, not the one it left.
    land(lake, none, log, replace(run, version=2))
    assert state(lake).keys() == before.keys()
    other = Lake(spark, str(tmp_path / "once"))
    land(other, *captures(pages, docs), RUN)
    strip = lambda rows: {k: {c: v for c, v in r.asDict().items() if c != "version"} for k, r in rows.items()}
    assert strip(before) == strip(state(other))


def test_queue_keeps_no_page_twice_and_obeys_the_range(lake, spark, captures, tmp_path):
    pages, docs = first_captures()
    log = response_log(spark, captures, tmp_path / "docs", [])
    run = replace(RUN, keep_pending=True)
    for version in (1, 2):
        land(lake, captures(pages, [])[0], log, replace(run, version=version))
        assert sorted(r.identifier for r in lake.pending().collect()) == ["A/B 1", "D1", "F1", "P1"]
    response_log(spark, captures, tmp_path / "docs", docs)
    land(lake, captures([], [])[0], log, replace(run, version=3, end_date="2024-01-31"))
    assert set(state(lake)) == {"NOLINK", "A/B 1", "P1"}


def test_failed_run_leaves_the_queue(lake, spark, captures, tmp_path, monkeypatch):
    pages, docs = first_captures()
    log = response_log(spark, captures, tmp_path / "docs", docs[:1])
    run = replace(RUN, keep_pending=True)
    land(lake, captures(pages, [])[0], log, run)
    response_log(spark, captures, tmp_path / "docs", docs[1:])
    queue = {r.identifier for r in lake.pending().collect()}
    with monkeypatch.context() as broken:
        broken.setattr(type(lake), "commit", lambda *args: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            land(lake, captures([], [])[0], log, replace(run, version=2))
    assert {r.identifier for r in lake.pending().collect()} == queue
    fresh = Lake(spark, lake.root)
    land(fresh, captures([], [])[0], log, replace(run, version=2))
    assert fresh.pending().isEmpty() and set(state(fresh)) == {"A/B 1", "P1", "NOLINK", "F1", "D1"}


def test_index_reads_the_headers_of_new_files_only(lake, spark, captures, tmp_path, monkeypatch):
    pages, docs = first_captures()
    log = response_log(spark, captures, tmp_path / "my docs", docs[:2])
    opened, contents = [], []
    heads, read = ResponseLog.heads, ResponseLog.read
    monkeypatch.setattr(ResponseLog, "heads", lambda self, files: opened.append(list(files)) or heads(self, files))
    land(lake, captures(pages, [])[0], log, RUN)
    first = set(opened[-1])
    response_log(spark, captures, tmp_path / "my docs", docs[2:])
    monkeypatch.setattr(ResponseLog, "read", lambda self, files=None: contents.append(list(files)) or read(self, contents[-1]))
    land(lake, captures(pages, [])[0], log, replace(RUN, version=2))
    assert len(opened) == 2 and len(opened[1]) == 1 and not first & set(opened[1])
    # Of the content, too, only the file that holds what was missing is read.
    assert all(set(x.split("/")[-1] for x in files) == {opened[1][0].split("/")[-1]} for files in contents if files)
    assert set(state(lake)) == {"A/B 1", "P1", "NOLINK", "F1", "D1"}
    land(lake, captures(pages, [])[0], log, replace(RUN, version=3))
    assert len(opened) == 2
    rows = lake.heads(log, 4).collect()
    assert sorted(r.url for r in rows) == sorted(SITE + x for x in ("/a", "/p", "/f", "/d"))


def test_stream_lands_documents_that_come_after_their_page(lake, spark, captures, tmp_path):
    pages, docs = first_captures()
    captures(pages, [])[0].write.parquet(str(tmp_path / "pages"))
    log = response_log(spark, captures, tmp_path / "docs", docs[:1])
    stream = spark.readStream.schema(captures([], [])[0].schema).parquet(str(tmp_path / "pages"))
    run = lambda: stream_landing(lake, stream, log, RUN, str(tmp_path / "c")).awaitTermination()
    run()
    assert set(state(lake)) == {"A/B 1", "NOLINK"}
    response_log(spark, captures, tmp_path / "docs", docs[1:])
    run()
    assert set(state(lake)) == {"A/B 1", "P1", "NOLINK", "F1", "D1"}
    versions = lake.committed(LANDING)
    run()
    assert lake.committed(LANDING) == versions


# -- documents that cannot be read ------------------------------------------------------------


def test_bad_documents_and_pages_are_counted_and_passed_over(lake, captures, monkeypatch):
    pages, docs = first_captures()
    pages.append(page_row("Labour Court", "2024-02-01", "2024-02-29", [{"id": "LOST", "href": "/l", "description": "x" * 5000}], number=2))
    docs += [doc_row("/a", html("alpha")), doc_row("/n", html("y" * 900))]
    pages.append(page_row("Equality Tribunal", "2024-02-01", "2024-02-29", [{"id": "BIG", "href": "/n"}], total=1))
    result = land(lake, *captures(pages, docs), replace(RUN, max_bytes=500, max_page_bytes=4000))
    assert set(state(lake)) == {"A/B 1", "P1", "NOLINK", "F1", "D1"}
    bad = {r.identifier: (r.url, r.body, r.partition_date, r.error) for r in lake.quarantine(LANDING).collect()}
    assert set(bad) == {"BIG", None}
    assert bad["BIG"][:3] == (SITE + "/n", "Equality Tribunal", "2024-02-01") and bad["BIG"][3].startswith("ValueError: 9")
    assert bad[None][0].endswith("pageNumber=2") and bad[None][3].endswith("more than 4000")
    outcomes = {(r.identifier, r.outcome) for r in result.outcomes.collect()}
    assert ("BIG", "bad_item") in outcomes and (None, "bad_item") in outcomes and (None, "request_failed") in outcomes
    failed = {(r.body, str(r.partition_start)): r.records_failed for r in result.stats.collect()}
    assert failed["Equality Tribunal", "2024-02-01"] == 1 and failed["Labour Court", "2024-02-01"] == 2
    assert {u.error for r in result.summaries().collect() for u in r.failed_urls} == {"503", "timeout", bad["BIG"][3], bad[None][3]}
    # The next run, with room for it, lands the document.
    land(lake, *captures(pages, docs), replace(RUN, version=2, max_page_bytes=4000))
    assert set(state(lake)) == {"A/B 1", "P1", "NOLINK", "F1", "D1", "BIG"}

    done = transform(lake, replace(TRANSFORM, max_bytes=500))
    assert {r.identifier: r.status for r in done.statuses.collect()}["BIG"] == "clean_error"
    assert done.counts().first().asDict() == {"inserted": 3, "updated": 0, "skipped": 0, "failed": 3}
    assert [(r.identifier, r.version) for r in lake.quarantine(TRANSFORMED).collect()] == [("BIG", 1)]
    assert "BIG" not in state(lake, TRANSFORMED)
    again = transform(lake, replace(TRANSFORM, version=2))
    assert again.counts().first().asDict() == {"inserted": 1, "updated": 0, "skipped": 3, "failed": 2}
    assert [(r.identifier, r.version) for r in lake.quarantine(TRANSFORMED).collect()] == [("BIG", 1)]


def test_a_failing_update_keeps_the_good_row(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    transform(lake, TRANSFORM)
    rerun(lake, captures, [{"id": "A/B 1", "href": "/a2"}], [doc_row("/a2", html("z" * 900))])
    before = state(lake, TRANSFORMED)
    done = transform(lake, replace(TRANSFORM, version=2, max_bytes=500))
    assert {r.identifier: r.status for r in done.statuses.collect()}["A/B 1"] == "clean_error"
    assert state(lake, TRANSFORMED) == before and content_of(lake, TRANSFORMED)["A-B_1.html"] == b'<div id="main">alpha</div>'


# -- objects by key ---------------------------------------------------------------------------


def spoil(lake, zone, spare):
    """Make every blob file unreadable but those of one day."""
    folder = Path(lake.path(zone, "blobs"))
    spoiled = [f for f in folder.rglob("*.parquet") if f"day={spare}" not in str(f)]
    for file in spoiled:
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    return spoiled


def test_one_key_reads_the_folder_it_is_in(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    everything = content_of(lake, LANDING)
    assert spoil(lake, LANDING, "2024-02-01")
    wanted = "Labour_Court/2024-02-01/D1.doc"
    one = lake.objects(LANDING, [wanted, "Labour_Court/2024-02-01/none.pdf"])
    assert {r.file_path: bytes(r.content) for r in one.collect()} == {wanted: everything[wanted]}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "(blob_id,%s" % (SITE + "/d") in plan.split("PushedFilters: ")[1].replace("EqualTo", "").replace("In(blob_id, [", "(blob_id,") or "EqualTo(blob_id" in plan
    assert lake.objects(LANDING, ["nowhere"]).collect() == [] and lake.objects(LANDING, []).collect() == []
    keys = lake.spark.createDataFrame([(wanted,), (wanted,), (None,)], "file_path string")
    assert [r.file_path for r in lake.objects(LANDING, keys).collect()] == [wanted]


def test_a_month_is_transformed_without_reading_the_others(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    spoil(lake, LANDING, "2024-02-01")
    done = transform(lake, replace(TRANSFORM, start_date="2024-02-01"))
    assert {r.identifier: r.status for r in done.statuses.collect()} == {"D1": "inserted", "F1": "no_path"}
    assert content_of(lake, TRANSFORMED) == {"D1.doc": b"DOC raw"}


def test_a_document_of_two_partitions_is_found_from_both(lake, captures):
    pages = [
        page_row("Labour Court", "2024-01-01", "2024-01-31", [{"id": "J", "href": "/x"}], total=1),
        page_row("Labour Court", "2024-02-01", "2024-02-29", [{"id": "F", "href": "/x"}], total=1),
    ]
    land(lake, *captures(pages, [doc_row("/x", html("both"))]), RUN)
    lake.compact(LANDING, "t")
    paths = ["Labour_Court/2024-01-01/J.html", "Labour_Court/2024-02-01/F.html"]
    assert {r.file_path for r in lake.objects(LANDING, paths).collect()} == set(paths)
    assert [r.file_path for r in lake.objects(LANDING, paths[1:]).collect()] == paths[1:]
    done = transform(lake, replace(TRANSFORM, start_date="2024-02-01"))
    assert done.counts().first().inserted == 1 and content_of(lake, TRANSFORMED) == {"F.html": b'<div id="main">both</div>'}


@pytest.mark.parametrize("policy", ["default", "hash_update"])
def test_texts_of_results_are_in_no_table_that_decides(lake, captures, monkeypatch, policy):
    """They go from the parsed pages to the log; a result that arrives twice keeps the text of its own arrival."""
    staged, stage = {}, Lake.stage

    def watched(lake, rows, name, version):
        staged[name] = rows.columns
        return stage(lake, rows, name, version)

    monkeypatch.setattr(Lake, "stage", watched)
    pages = [
        page_row("Labour Court", "2024-01-01", "2024-01-31", [{"id": "A", "href": "/a", "description": "first"}, {"id": "B", "description": "no link"}], 2),
        page_row("Labour Court", "2024-02-01", "2024-02-29", [{"id": "A", "href": "/a", "description": "second"}, {"id": "C", "href": "/c", "description": "third"}], 2),
    ]
    land(lake, *captures(pages, [doc_row("/a"), doc_row("/c")]), replace(RUN, policy=policy))
    transform(lake, TransformRun("2024-01-01", "2024-12-31", 1, RUN.run_ts))
    assert {"arrivals", "decided", "work", "transformed"} <= set(staged)
    assert [name for name, columns in staged.items() if "description" in columns] == []
    assert {i: r.description for i, r in state(lake).items()} == {"A": "first", "B": "no link", "C": "third"}
    assert {i: r.description for i, r in state(lake, TRANSFORMED).items()} == {"A": "first", "C": "third"}


def test_small_object_files_have_small_filters(lake, captures):
    land(lake, *captures(*first_captures()), RUN)
    files = list(Path(lake.path(LANDING, "blobs")).rglob("*.parquet"))
    assert files and all(f.stat().st_size < 100_000 for f in files)


def test_logs_name_the_places_of_texts(lake, captures):
    """A text stays on its parsed page: neither log nor the snapshot nor the queue holds it again."""
    def pages(text):
        items = [{"id": "A", "href": "/a", "description": "one"}, {"id": "B", "href": "/b", "description": text}, {"id": "C", "description": "three"}]
        return [page_row("Labour Court", "2024-01-01", "2024-01-31", items, 3)]

    run = replace(RUN, keep_pending=True)
    land(lake, *captures(pages("two"), [doc_row("/a")]), run)
    land(lake, *captures([], [doc_row("/b")]), replace(run, version=2))
    # A replay numbers its pages anew; what came from the queue keeps the text it was queued with.
    land(lake, *captures(pages("new"), [doc_row("/a")]), run)
    transform(lake, TransformRun("2024-01-01", "2024-12-31", 1, RUN.run_ts))
    lake.compact(LANDING, "t")
    for table in ("landing/log", "landing/snapshot/state", "landing/pending", "transformed/log"):
        files = [str(f) for f in Path(lake.path(table)).rglob("part-*.parquet") if "commits" not in f.parts]
        stored = lake.spark.read.parquet(*files)
        assert stored.filter("description is not null").isEmpty(), table
    assert {i: r.description for i, r in state(lake).items()} == {"A": "one", "B": "two", "C": "three"}
    assert {i: r.description for i, r in state(lake, TRANSFORMED).items()} == {"A": "one", "B": "two"}
    assert "text_id" not in lake.current(LANDING).columns


def test_logs_that_hold_their_texts_are_read_as_before(lake, captures):
    land(lake, *captures([page_row("Labour Court", "2024-01-01", "2024-01-31", [{"id": "A", "href": "/a", "description": "one"}], 1)], [doc_row("/a")]), RUN)
    held = lake.log(LANDING).withColumns({c: F.lit(None).cast("string") for c in ("text_id", "blob_id", "blob_day")})
    lake.write_log(held.withColumn("description", F.lit("held")), LANDING, 2)
    lake.commit(LANDING, 2, "t")
    transform(lake, TransformRun("2024-01-01", "2024-12-31", 1, RUN.run_ts))
    assert [state(lake, zone)["A"].description for zone in (LANDING, TRANSFORMED)] == ["held", "held"]


def test_rows_of_a_range_have_their_texts(lake, captures):
    """Left out of the plan only if they are not used."""
    items = [{"id": "A", "href": "/a", "description": "one"}, {"id": "B", "href": "/b", "description": "two"}]
    land(lake, *captures([page_row("Labour Court", "2024-01-01", "2024-01-31", items, 2)], [doc_row("/a"), doc_row("/b")]), RUN)
    rows = lake.in_range(LANDING, "2024-01-01", "2024-12-31")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, lake.current(LANDING).collect()))
    assert {r.identifier: r.description for r in rows.collect()} == {"A": "one", "B": "two"}
    assert "items" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert "items" not in rows.select("identifier", "file_hash")._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_kept_where_they_are_parsed(lake, spark, captures, monkeypatch):
    """No shuffle between the parser and the table of parsed pages: a text does not move for it."""
    pages = [page_row("Labour Court", f"2024-0{m}-01", f"2024-0{m}-28", [{"id": f"A{m}", "href": f"/{m}", "description": f"text {m}"}], 1) for m in (1, 2)]
    found, responses = captures(pages, [doc_row(f"/{m}") for m in (1, 2)])
    written, write = [], Lake.write_pages

    def watched(self, rows, version):
        group = f"pages-{version}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            return write(self, rows, version)
        finally:
            tracker = spark.sparkContext.statusTracker()
            written.extend(len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup(group))
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    monkeypatch.setattr(Lake, "write_pages", watched)
    land(lake, found, responses, RUN)
    assert written and set(written) == {1}
    assert {i: r.description for i, r in state(lake).items()} == {f"A{m}": f"text {m}" for m in (1, 2)}


def test_pages_kept_in_folders_by_day_are_still_read(lake, spark, captures):
    land(lake, *captures([page_row("Labour Court", "2024-01-01", "2024-01-31", [{"id": "A", "href": "/a", "description": "one"}], 1)], [doc_row("/a")]), RUN)
    attempt = next(Path(lake.path(LANDING, "parsed", "version=1")).iterdir())
    rows = spark.read.parquet(str(attempt))
    older = replace(RUN, version=2)
    land(lake, *captures([page_row("Labour Court", "2024-02-01", "2024-02-28", [{"id": "B", "href": "/b", "description": "two"}], 1)], [doc_row("/b")]), older)
    # The first run's pages as lakes had them before: in another folder, by day.
    rows.write.partitionBy("day").parquet(lake.path(LANDING, "pages", "version=1", attempt.name))
    empty = spark.read.schema(rows.schema).parquet(str(attempt)).filter("false")
    empty.write.mode("overwrite").parquet(lake.path("empty"))
    for file in attempt.glob("part-*.parquet"):
        file.write_bytes(next(Path(lake.path("empty")).glob("part-*.parquet")).read_bytes())
    for crc in attempt.glob(".part-*.crc"):
        crc.unlink()
    assert {i: r.description for i, r in state(lake).items()} == {"A": "one", "B": "two"}
