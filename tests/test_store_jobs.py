import datetime as dt
import os
import threading

import pytest
from helpers import NEWS, news_row
from pyspark.sql import functions as F

from wireloom import schemas
from wireloom.operators import ids, updates
from wireloom.plans import jobs
from wireloom.sources import store as store_of
from wireloom.sources import tables
from wireloom.sources.commits import CommitLog, SharedFolder
from wireloom.sources.store import Conflict, NewsStore, to_table

STAGED = ("russian", "news")
AGENCIES = "telegram string, mono_category string, is_parsing boolean, language string, priority int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), NEWS)


def urls(df):
    return sorted(row["url"].removeprefix("https://t.me/") for row in df.collect())


def test_schemas():
    assert len(schemas.table_schema("russian", "news")) == 5
    assert len(schemas.table_schema("russian", "final")) == 8
    assert len(schemas.table_schema("published", "news")) == 8
    assert schemas.table_schema("error", "error_table").fieldNames()[-1] == "errors"


def test_conform(spark):
    got = schemas.conform(frame(spark, news_row("a", 1)).withColumn("extra", F.lit(1)), schemas.ENRICHED)
    assert got.schema.fieldNames() == schemas.ENRICHED.fieldNames() and got.first()["title"] is None


def test_empty_table_and_query(spark, store):
    assert not tables.is_not_empty(store.read(*STAGED))
    store.append(*STAGED, frame(spark, news_row("a", 1), news_row("b", 2)), "1")
    assert tables.is_not_empty(store.read(*STAGED))
    got = tables.run_query(spark, "SELECT url FROM {news} WHERE agency = :agency", {"news": store.read(*STAGED)}, agency="b")
    assert urls(got) == ["b/2"]


def test_writing_a_batch_again_replaces_it(spark, store):
    store.append(*STAGED, frame(spark, news_row("a", 1), news_row("a", 2)), "1")
    store.append(*STAGED, frame(spark, news_row("a", 3)), "2")
    store.append(*STAGED, frame(spark, news_row("a", 9)), "1")
    assert urls(store.read(*STAGED)) == ["a/3", "a/9"]
    store.append(*STAGED, frame(spark, news_row("a", 9)).limit(0), "1")
    assert urls(store.read(*STAGED)) == ["a/3"]
    assert store.batches(*STAGED) == ["1", "2"]


def test_failed_write_is_kept_aside_and_raised(spark, store):
    store = NewsStore(spark, store.root, data="unknown-scheme://nowhere")
    with pytest.raises(Exception, match="unknown-scheme"):
        store.append(*STAGED, frame(spark, news_row("a", 1)), "1")
    assert urls(store.dead_letters(*STAGED)) == ["a/1"] and urls(store.read(*STAGED)) == []
    (failure,) = store.failures().collect()
    assert failure["targets"] == ["russian/news/1"] and "unknown-scheme" in failure["error"]


def test_a_failing_plan_leaves_the_old_batch(spark, store):
    store.append(*STAGED, frame(spark, news_row("a", 1), news_row("a", 2)), "1")
    failing = frame(spark, news_row("a", 3)).withColumn("news", F.raise_error(F.lit("broken plan")).cast("string"))
    with pytest.raises(Exception, match="broken plan"):
        store.move(STAGED, STAGED, failing, "1", ["0"])
    assert urls(store.read(*STAGED)) == ["a/1", "a/2"] and store.consumed(*STAGED) == []
    (failure,) = store.failures().collect()
    assert failure["sources"] == ["russian/news/0"] and failure["targets"] == ["russian/news/1"]


def test_both_groups_under_one_run_keep_their_rejects(spark, store):
    home = frame(spark, news_row("a", 1, ""), news_row("a", 2, ""), news_row("a", 3))
    foreign = frame(spark, news_row("f", 1, ""), news_row("f", 2, ""), news_row("f", 3, ""))
    assert jobs.collect(store, home, "russian", "run-1") == (1, 2)
    assert jobs.collect(store, foreign, "foreign", "run-1") == (0, 3)
    assert len(urls(store.read(*jobs.ERRORS))) == 5
    assert jobs.collect(store, home, "russian", "run-2") == (0, 0)


def plain(rows):
    return rows.withColumn("category", F.lit("society"))


def test_a_retry_keeps_rows_when_new_batches_arrive(spark, store):
    jobs.collect(store, frame(spark, news_row("a", 1), news_row("a", 2)), "russian", "c1")
    assert jobs.enrich(store, plain, agencies(spark), "e1") == ["collect-russian-c1"]
    jobs.collect(store, frame(spark, news_row("a", 3)), "russian", "c2")
    assert jobs.enrich(store, plain, agencies(spark), "e1") == ["collect-russian-c1"]
    assert urls(store.read(*jobs.FINAL)) == ["a/1", "a/2"] and urls(store.pending(*STAGED)) == ["a/3"]
    assert jobs.enrich(store, plain, agencies(spark), "e2") == ["collect-russian-c2"]
    assert jobs.collect(store, frame(spark, news_row("a", 1), news_row("a", 2)), "russian", "c1") == (2, 0)
    assert urls(store.read(*STAGED)) == ["a/1", "a/2", "a/3"]


@pytest.mark.parametrize("step", ["before", "after"])
def test_a_crash_around_the_commit(spark, store, monkeypatch, step):
    jobs.collect(store, frame(spark, news_row("a", 1), news_row("a", 2)), "russian", "c1")
    jobs.collect(store, frame(spark, news_row("b", 3), news_row("b", 4)), "russian", "c2")
    put = store.log.files.put_if_absent

    def crash(name, text):
        if '"writes"' not in text:
            return put(name, text)
        if step == "after":
            put(name, text)
        raise KeyboardInterrupt

    monkeypatch.setattr(store.log.files, "put_if_absent", crash)
    with pytest.raises(KeyboardInterrupt):
        jobs.enrich(store, plain, agencies(spark), "e1")
    monkeypatch.setattr(store.log.files, "put_if_absent", put)
    jobs.collect(store, frame(spark, news_row("c", 5)), "russian", "c3")
    jobs.enrich(store, plain, agencies(spark), "e1")
    assert urls(store.read(*jobs.FINAL)) == ["a/1", "a/2", "b/3", "b/4"]
    assert urls(store.pending(*STAGED)) == ["c/5"]


def test_a_failing_model_is_data(spark, store):
    from wireloom.operators.enrich import batch_inference

    def load():
        def model(texts):
            if any("bad" in text for text in texts):
                raise ValueError("too bad")
            return [text.upper() for text in texts]

        return model

    infer = batch_inference(load)
    jobs.collect(store, frame(spark, news_row("a", 1, "good text"), news_row("a", 2, "bad text")), "russian", "c1")
    jobs.enrich(store, plain, agencies(spark), "e1", title=infer, resume=infer)
    (final,) = store.read(*jobs.FINAL).collect()
    assert (final["title"], final["resume"]) == ("GOOD TEXT", "GOOD TEXT")
    (failed,) = store.read(*jobs.MODEL_REJECTS).collect()
    assert failed["url"].endswith("a/2") and failed["errors"] == ["title_error: ValueError: too bad", "resume_error: ValueError: too bad"]
    rows = [(f"https://t.me/h/{i}", dt.datetime(2001, 3, 1, 13), text, "l", "h", None) for i, text in enumerate(["fine", "bad"])]
    store.append(*jobs.ARCHIVE, spark.createDataFrame(rows, NEWS + ", resume string"), "1")
    jobs.backfill(store, dt.date(2002, 3, 1), infer)
    assert {row["news"]: row["resume"] for row in store.read(*jobs.ARCHIVE).collect()} == {"fine": "FINE", "bad": None}


def test_known_ids_are_pruned_and_read_no_texts(spark, store):
    from helpers import plan

    store.append(*STAGED, frame(spark, news_row("a", 3_000_000_000), news_row("a", 7)), "1")
    known = store.known_words(*STAGED).filter(F.col("word").between(0, 9))
    assert [tuple(row) for row in ids.ids_of_words(known).collect()] == [("a", 7)]
    text = plan(known)
    assert "GreaterThanOrEqual(word,0)" in text and "news:string" not in text and "url:string" not in text
    assert jobs.collect(store, frame(spark, news_row("a", 3_000_000_000)), "russian", "c1") == (0, 0)


def test_pages_to_both_groups(spark, store):
    from test_messages import bubble, page

    html = page(bubble("text one", "1"), bubble("text two", "2"), bubble("odd", "x?single"))
    pages = spark.createDataFrame([("a", html), ("f", html), ("off", html)], "channel string, html string")
    assert jobs.collect_pages(store, pages, agencies(spark), "p1") == {"russian": (2, 1), "foreign": (2, 1)}
    assert jobs.collect_pages(store, pages, agencies(spark), "p2") == {"russian": (0, 0), "foreign": (0, 0)}
    assert [row["errors"] for row in store.read(*jobs.ERRORS).collect()] == [["id"], ["id"]]


def test_rows_that_arrive_during_a_move_stay_pending(spark, store):
    store.append(*STAGED, frame(spark, news_row("a", 1)), "1")
    taken = store.pending_batches(*STAGED)
    rows = store.batch_rows(*STAGED, taken)
    store.append(*STAGED, frame(spark, news_row("a", 2)), "2")
    store.move(STAGED, jobs.FINAL, rows, "f1", taken)
    assert urls(store.pending(*STAGED)) == ["a/2"]
    assert urls(store.read(*jobs.FINAL)) == ["a/1"]
    store.mark_consumed(*STAGED, ["1", "2"])
    assert urls(store.pending(*STAGED)) == [] and urls(store.read(*STAGED)) == ["a/1", "a/2"]


def test_an_update_writes_changes_only(spark, store):
    target = jobs.ARCHIVE
    store.append(*target, frame(spark, news_row("a", 1, "long " * 10_000), news_row("a", 2), news_row("a", 1, minute=3)), "1")
    store.append(*target, frame(spark, news_row("b", 1)), "2")
    before = files_below(store.data)
    changes = spark.createDataFrame([("https://t.me/a/1", "new"), ("https://t.me/zzz/1", "x")], "url string, resume string")
    assert store.update(*target, changes, "url", "resume") == 1
    got = sorted((row["url"], row["resume"]) for row in store.read(*target).collect())
    assert got == [
        ("https://t.me/a/1", "new"), ("https://t.me/a/1", "new"), ("https://t.me/a/2", None), ("https://t.me/b/1", None),
    ]
    assert files_below(store.data) == before
    assert sum(os.path.getsize(f) for f in files_below(f"{store.root}/changes")) < 5000
    assert store.update(*target, changes.limit(0), "url", "resume") == 0


def files_below(folder):
    return sorted(os.path.join(d, name) for d, _, names in os.walk(folder) for name in names if name.endswith(".parquet"))


def test_later_rows_do_not_get_earlier_changes(spark, store):
    target = jobs.ARCHIVE
    one = spark.createDataFrame([("https://t.me/a/1", "new")], "url string, resume string")
    store.append(*target, frame(spark, news_row("a", 1)), "1")
    store.update(*target, one, "url", "resume")
    store.append(*target, frame(spark, news_row("a", 1)), "2")
    assert {row["batch_id"]: row["resume"] for row in store.read(*target).collect()} == {"1": "new", "2": None}
    for number in range(store_of.FAN):
        store.update(*target, one.withColumn("resume", F.lit(f"newer {number}")), "url", "resume")
    store.append(*target, frame(spark, news_row("a", 1)), "3")
    want = {"1": "newer 7", "2": "newer 7", "3": None}
    assert {row["batch_id"]: row["resume"] for row in store.read(*target).collect()} == want
    store.tend([target])
    assert len(store.log.state().changes["time_machine/news"]) == 1
    assert {row["batch_id"]: row["resume"] for row in store.read(*target).collect()} == want


def test_a_batch_is_handed_over_once(spark, tmp_path):
    first, second = (NewsStore(spark, str(tmp_path / "store"), lease=0) for _ in range(2))
    jobs.collect(first, frame(spark, news_row("a", 1), news_row("a", 2)), "russian", "c1")

    def broken(rows):
        raise InterruptedError

    with pytest.raises(InterruptedError):
        jobs.enrich(first, broken, agencies(spark), "e1")
    assert jobs.enrich(second, plain, agencies(spark), "e2") == ["collect-russian-c1"]
    assert jobs.enrich(first, plain, agencies(spark), "e1") == []
    jobs.collect(first, frame(spark, news_row("a", 3)), "russian", "c2")
    assert jobs.enrich(first, plain, agencies(spark), "e1") == ["collect-russian-c2"]
    assert urls(second.read(*jobs.FINAL)) == ["a/1", "a/2", "a/3"]


def test_a_commit_that_comes_second_fails_and_the_run_goes_on_with_the_rest(spark, tmp_path):
    first, second = (NewsStore(spark, str(tmp_path / "store"), lease=0) for _ in range(2))
    jobs.collect(first, frame(spark, news_row("a", 1)), "russian", "c1")
    rows = to_table(frame(spark, news_row("a", 1)), jobs.FINAL)
    uses = [(STAGED, "collect-russian-c1")]
    first.commit("one", "one", rows, [jobs.FINAL], uses)
    with pytest.raises(Conflict, match="collect-russian-c1"):
        second.commit("two", "two", rows, [jobs.FINAL], uses)
    assert urls(second.read(*jobs.FINAL)) == ["a/1"]

    # While a run is at work, another one uses up half of its batches.
    jobs.collect(first, frame(spark, news_row("a", 2)), "russian", "c2")
    jobs.collect(first, frame(spark, news_row("a", 3)), "russian", "c3")

    def overtaken(rows):
        if "e9" not in second.log.state().runs:
            second.commit("e9", "e9", to_table(frame(spark, news_row("a", 2)), jobs.FINAL), [jobs.FINAL], [(STAGED, "collect-russian-c2")])
        return plain(rows)

    assert jobs.enrich(first, overtaken, agencies(spark), "e1") == ["collect-russian-c3"]
    assert urls(first.read(*jobs.FINAL)) == ["a/1", "a/2", "a/3"]


def test_two_runs_at_once_take_different_batches(spark, tmp_path):
    stores = [NewsStore(spark, str(tmp_path / "store")) for _ in range(4)]
    for number in range(3):
        stores[0].append(*STAGED, frame(spark, news_row("a", number)), str(number))
    taken, gate = {}, threading.Barrier(len(stores))

    def take(number):
        gate.wait()
        taken[number] = stores[number].take(f"run-{number}", *STAGED)

    threads = [threading.Thread(target=take, args=(number,)) for number in range(len(stores))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(batch for own in taken.values() for batch in own) == ["0", "1", "2"]
    assert stores[0].take("late", *STAGED) == []
    assert NewsStore(spark, str(tmp_path / "store"), lease=0).take("later", *STAGED) == ["0", "1", "2"]


@pytest.mark.parametrize("way", ["link", "rename"])
def test_commits_at_once_get_numbers_of_their_own(spark, tmp_path, monkeypatch, way):
    if way == "rename":
        lock = threading.Lock()  # a local rename is not atomic

        def rename(self, aside, name):
            with lock:
                return self._rename(aside, name)

        monkeypatch.setattr(SharedFolder, "_link", rename)
    logs = [CommitLog(spark, str(tmp_path / "log"), 5) for _ in range(4)]

    def commit(number):
        for i in range(10):
            logs[number].commit(lambda state: {"run": f"{number}-{i}", "note": str(state.seq)})

    threads = [threading.Thread(target=commit, args=(number,)) for number in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    state = CommitLog(spark, str(tmp_path / "log"), 5).state()
    assert state.seq == 40 and sorted(state.runs.values(), key=int) == [str(n) for n in range(40)]


def test_a_reader_reads_one_snapshot_and_few_commits(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    for number in range(1003):
        log.commit(lambda state: {"run": f"r{number}", "writes": [["a/b", f"batch{number}", "x"]]})
    assert log.reads <= 1003 + 1003 // 16
    fresh = CommitLog(spark, str(tmp_path / "log"))
    assert fresh.state() == log.state() and fresh.state().seq == 1003
    assert fresh.reads <= 2 + 16


def test_seen_ids_lie_in_few_files(spark, store, monkeypatch):
    monkeypatch.setattr(store_of, "FAN", 3)
    for number in range(10):
        store.append("foreign", "news", frame(spark, news_row("f", number), news_row("f", number + 100), news_row("g", number)), str(number))
        store.tend([("foreign", "news")])
        assert len(store.log.state().ids["foreign/news"]) <= 2 * 3
    assert sorted(own[1] for own in store.log.state().ids["foreign/news"]) == [0, 2]
    got = sorted(map(tuple, ids.ids_of_words(ids.merged_words(store.known_words("foreign", "news"))).collect()))
    assert got == sorted([("f", n) for n in range(10)] + [("f", n + 100) for n in range(10)] + [("g", n) for n in range(10)])
    messages = frame(spark, news_row("f", 5), news_row("f", 11), news_row("g", 9))
    assert jobs.collect(store, messages, "foreign", "c") == (1, 0)


def test_a_channel_that_both_groups_poll(spark, store):
    from test_messages import bubble, page

    html = page(bubble("text one", "1"), bubble("odd", "x?single"))
    both = spark.createDataFrame([("a", None, True, "en", 1), ("a", None, False, "en", 1)], AGENCIES)
    pages = spark.createDataFrame([("a", html)], "channel string, html string")
    assert jobs.collect_pages(store, pages, both, "p1") == {"russian": (1, 0), "foreign": (1, 1)}
    assert urls(store.read(*STAGED)) == urls(store.read("foreign", "news")) == ["chan/1"]
    assert jobs.collect_pages(store, pages, both, "p2") == {"russian": (0, 0), "foreign": (0, 0)}
    assert store.read(*jobs.ERRORS).count() == 1


def test_pages_are_parsed_for_polled_channels_and_once(spark, store):
    from test_messages import bubble, page

    from wireloom.operators.messages import read_bubbles

    html = page(bubble("text one", "1"), bubble("odd", "x?single"))
    pages = spark.createDataFrame([("a", html), ("f", html), ("off", html), (None, html)], "channel string, html string")
    read = []

    def reader(own):
        read.append(sorted(row["channel"] for row in own.collect()))
        return read_bubbles(own)

    told = jobs.collect_pages(store, pages, agencies(spark), "p1", reader=reader)
    assert told == {"russian": (1, 1), "foreign": (1, 1)} and read == [["a", "f"]]
    assert jobs.collect_pages(store, pages, agencies(spark), "p1", reader=reader) == told
    assert len(read) == 1
    assert jobs.collect(store, frame(spark, news_row("a", 7)), "russian", "c1") == (1, 0)
    gone = frame(spark, news_row("a", 8)).withColumn("news", F.raise_error(F.lit("read again")).cast("string"))
    assert jobs.collect(store, gone, "russian", "c1") == (1, 0)


def test_update_can_set_null(spark):
    target = spark.createDataFrame([("u", "old"), ("v", "old")], "url string, resume string")
    changes = spark.createDataFrame([("u", None)], "url string, resume string")
    got = {row["url"]: row["resume"] for row in updates.apply_updates(target, changes, "url", "resume").collect()}
    assert got == {"u": None, "v": "old"}


def test_several_updates_of_a_key_do_not_multiply_rows(spark):
    target = spark.createDataFrame([("u", "old"), ("u", "old")], "url string, resume string")
    changes = spark.createDataFrame([("u", "a"), ("u", "b")], "url string, resume string")
    assert [row["resume"] for row in updates.apply_updates(target, changes, "url", "resume").collect()] == ["b", "b"]


def test_last_update_per_key(spark):
    rows = [("u", "b", 1), ("u", "a", 2), (None, "x", 3)]
    got = updates.last_update_per_key(spark.createDataFrame(rows, "url string, r string, n int"), "url", "r", F.col("n"))
    assert [tuple(row) for row in got.collect()] == [("u", "a")]


def agencies(spark):
    rows = [("a", "sports", True, "ru", 1), ("b", None, True, "ru", 1), ("f", None, False, "en", 1), ("off", None, None, "en", 1)]
    return spark.createDataFrame(rows, AGENCIES)


def test_collect_enrich_publish(spark, store):
    messages = frame(
        spark, news_row("a", 1, "Good. Text."), news_row("a", 1, "Good. Text."), news_row("b", 2, ""), news_row("b", 3, "Other."),
        news_row("b", 4, "Fine. Text."), news_row("off", 5), news_row("f", 6),
    )
    assert jobs.collect(store, messages, "russian", "c1", agencies(spark)) == (3, 1)
    assert jobs.collect(store, messages, "russian", "c1", agencies(spark)) == (3, 1)
    assert jobs.collect(store, messages, "russian", "c2", agencies(spark)) == (0, 0)
    assert jobs.collect(store, messages, "foreign", "c3", agencies(spark)) == (1, 0)
    assert urls(store.read(*STAGED)) == ["a/1", "b/3", "b/4"]
    assert urls(store.read("foreign", "news")) == ["f/6"]
    (reject,) = store.read(*jobs.ERRORS).collect()
    assert reject["url"] == "https://t.me/b/2" and reject["errors"] == ["news"]

    def classify(rows):
        return rows.withColumn("category", F.when(F.col("news") == "Other.", "other").otherwise("society"))

    assert jobs.enrich(store, classify, agencies(spark), "e1") == ["collect-russian-c1", "collect-russian-c2"]
    assert jobs.enrich(store, classify, agencies(spark), "e2") == []
    final = {row["url"]: (row["category"], row["title"]) for row in store.read(*jobs.FINAL).collect()}
    assert final == {"https://t.me/a/1": ("sports", "Good"), "https://t.me/b/4": ("society", "Fine")}

    store.append(*jobs.FINAL, frame(spark, news_row("b", 9)), "by-hand")
    assert jobs.publish(store, "p1") == ["by-hand", "enrich-e1"]
    assert [(row["url"], row["errors"]) for row in store.read(*jobs.FINAL_REJECTS).collect()] == [
        ("https://t.me/b/9", ["title", "resume", "category"])
    ]
    assert jobs.publish(store, "p2") == []
    assert urls(store.read(*jobs.PUBLISHED)) == ["a/1", "b/4"]

    # Published and rejected ids stay known; what was dropped as no news does not.
    assert jobs.collect(store, messages, "russian", "c9", agencies(spark)) == (1, 0)
    assert urls(store.pending(*STAGED)) == ["b/3"]


def test_ids_known_in_range(spark):
    batch = spark.createDataFrame([("a", 5), ("a", 9), ("b", 1)], "agency string, id int")
    seen = ids.words(spark.createDataFrame([("a", i) for i in range(200)] + [("b", 1), ("c", 1), (None, 5)], "agency string, id long"))
    assert sorted(map(tuple, ids.ids_of_words(ids.in_range_of(seen, batch)).collect())) == [("a", i) for i in range(64)] + [("b", 1)]


def test_backfill(spark, store):
    schema = NEWS + ", resume string"

    def past(number, day, resume, text):
        url = f"https://t.me/h/{number}"
        return (url, dt.datetime(*day, 13), text, url, "h", resume)

    rows = [
        past(1, (2001, 3, 1), None, "It's one. Two."), past(2, (2000, 3, 1), "", "Three."), past(3, (1999, 3, 1), "kept", "x"),
        past(4, (2001, 3, 2), None, "wrong day"), past(5, (1998, 3, 1), None, "too early"), past(6, (2002, 3, 1), None, "same year"),
        past(1, (1999, 3, 1), "", "Oldest."), past(1, (1990, 1, 1), "old", "y"),
    ]
    store.append(*jobs.ARCHIVE, spark.createDataFrame(rows, schema), "1")
    assert jobs.backfill(store, dt.date(2002, 3, 1)) == 2
    got = sorted((row["url"][-1], row["resume"] or "") for row in store.read(*jobs.ARCHIVE).collect())
    assert got == [
        ("1", "Oldest."), ("1", "Oldest."), ("1", "Oldest."), ("2", "Three."), ("3", "kept"), ("4", ""), ("5", ""), ("6", ""),
    ]
    assert jobs.backfill(store, dt.date(2002, 3, 1)) == 0


def test_group_routing(spark):
    frame = spark.createDataFrame([("ru",), ("en",), (None,)], "lang string")
    got = {row["lang"]: row["g"] for row in frame.select("lang", jobs.group_of(F.col("lang"), "ru").alias("g")).collect()}
    assert got == {"ru": "russian", "en": "foreign", None: "foreign"}
