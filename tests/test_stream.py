from helpers import NEWS, news_row
from test_messages import bubble, page

from wireloom import schemas
from wireloom.operators import messages
from wireloom.plans import jobs
from wireloom.sources import tables
from wireloom.streaming.ingest import ingest, run_name


def write_file(spark, folder, name, rows):
    spark.createDataFrame(rows, NEWS).coalesce(1).write.mode("append").parquet(f"{folder}/{name}.parquet")


def run(spark, folder, store, checkpoint, seen=None):
    schema = spark.createDataFrame([], NEWS).schema
    messages = tables.table_stream(spark, folder, "messages", schema, maxFilesPerTrigger=1)
    query = ingest(messages, store, "russian", checkpoint, "feed", on_batch=seen)
    query.awaitTermination()


def test_stream_equals_batch_and_resumes(spark, store, tmp_path):
    folder, checkpoint = str(tmp_path), str(tmp_path / "checkpoint")
    log = []
    first = [news_row("a", i, "" if i % 10 == 0 else "text") for i in range(30)]
    second = [news_row("a", i) for i in range(20, 50)]
    write_file(spark, folder, "messages", first)
    write_file(spark, folder, "messages", second)
    store.append(*jobs.PUBLISHED, spark.createDataFrame([news_row("a", 5)], NEWS), "earlier")
    run(spark, folder, store, checkpoint, lambda name, counts: log.append((name, counts)))
    assert [name for name, _ in log] == [run_name("feed", 0), run_name("feed", 1)]
    assert sum(valid + invalid for _, (valid, invalid) in log) == 49
    staged = {row["url"] for row in store.read("russian", "news").collect()}
    rejected = {row["url"] for row in store.read(*jobs.ERRORS).collect()}
    assert len(staged) + len(rejected) == 49 and not staged & rejected

    write_file(spark, folder, "messages", [news_row("a", 49), news_row("a", 60), news_row("a", 60)])
    run(spark, folder, store, checkpoint, lambda name, counts: log.append((name, counts)))
    assert log[-1] == (run_name("feed", 2), (1, 0))


def test_a_stream_of_pages(spark, store, tmp_path):
    folder = str(tmp_path)
    for number in range(2):
        html = page(*[bubble(f"text {i}", str(i)) for i in range(number * 5, number * 5 + 10)], bubble("bad", "x?single"))
        rows = spark.createDataFrame([("chan", html)], schemas.PAGES)
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/pages.parquet")
    pages = tables.table_stream(spark, folder, "pages", schemas.PAGES, maxFilesPerTrigger=1)
    found = messages.well_formed(messages.parse_messages(pages)).drop("id")
    ingest(found, store, "russian", str(tmp_path / "checkpoint"), "pages").awaitTermination()
    assert sorted(row["news"] for row in store.read("russian", "news").collect()) == sorted(f"text {i}" for i in range(15))


def test_a_replayed_micro_batch_changes_nothing(spark, store):
    rows = spark.createDataFrame([news_row("a", 1), news_row("a", 2, "")], NEWS)
    for _ in range(2):
        assert jobs.collect(store, rows, "russian", run_name("feed", 0)) == (1, 1)
    assert store.read("russian", "news").count() == 1 and store.read(*jobs.ERRORS).count() == 1


def test_pages_of_a_stream_are_written_side_by_side(spark, monkeypatch, tmp_path):
    """A part of the pages is not one task's work, and is one micro-batch."""
    from wireloom.plans import queries

    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    done, start = [], queries.ingest_pages
    monkeypatch.setattr(queries, "ingest_pages", lambda *args, on_batch, **own: start(*args, on_batch=lambda name, counts: (done.append(name), on_batch(name, counts)), **own))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = queries.stream_pages(spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows > 0 and len(done) == 4 and len(list((tmp_path / "pages").rglob("part-*.parquet"))) > 8
