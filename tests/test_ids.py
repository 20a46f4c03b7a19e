import datetime as dt
from collections import Counter

from helpers import NEWS, news_row, plan
from pyspark.sql import functions as F

from wireloom.operators import agencies as ag
from wireloom.operators import ids

AGENCIES = "telegram string, mono_category string, is_parsing boolean, language string, priority int"


def frame(spark, rows):
    return spark.createDataFrame(rows, NEWS).repartition(3)


def names(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "telegram string")


def test_agency_filters(spark):
    rows = [
        ("a", "sports", True, "en", 1), ("b", None, None, "en", 1), ("c", "None", True, "", 1), ("d", "x", False, "en", 6),
        ("e", "x", False, "en", None), ("f", "x", False, None, 1), ("g", "x", False, "", 1), ("h", "x", False, "en", 1),
    ]
    frame = spark.createDataFrame(rows, AGENCIES)
    assert sorted(row[0] for row in ag.active_agencies(frame).collect()) == ["a", "c"]
    assert [row[0] for row in ag.foreign_agencies(frame).collect()] == ["h"]
    assert [tuple(row) for row in ag.mono_categories(frame).collect()] == [("a", "sports")]
    assert ag.agencies_of_group(frame, "russian").count() == 2 and ag.agencies_of_group(frame, "foreign").count() == 1


def test_last_row_wins(spark):
    rows = [("a", "sports", True, 1), ("a", "economy", True, 3), ("a", "science", True, 2), ("a", "x", False, 9)]
    frame = spark.createDataFrame(rows, "telegram string, mono_category string, is_parsing boolean, place int")
    assert [tuple(row) for row in ag.mono_categories(frame, F.col("place")).collect()] == [("a", "economy")]


def test_known_ids_is_a_bag_without_bad_rows(spark):
    one = frame(spark, [news_row("a", 1), news_row("a", 1), news_row("newsru.co.il", 2), news_row("a", "1?single")])
    two = frame(spark, [news_row("a", 1), ("https://t.me/x/5", None, "n", "l", None)])
    assert Counter(map(tuple, ids.known_ids(one, two).collect())) == {("a", 1): 3}
    assert ids.rows_without_id(one).count() == 1


def test_id_lists_hold_the_whole_bag_in_bounded_chunks(spark):
    bag = [("hot", i % 5000) for i in range(20000)] + [("b", 7), ("inactive", 1), (None, 3)]
    known = spark.createDataFrame(bag, "agency string, id int").repartition(4)
    rows = ids.id_lists(names(spark, "hot", "b", "silent"), known, per_chunk=100).collect()
    assert max(len(row["ids"]) for row in rows) <= 100
    assert all(row["ids"] == sorted(row["ids"]) for row in rows)
    whole = Counter()
    for row in rows:
        whole.update({(row["agency"], i): n for i, n in zip(row["ids"], row["copies"])})
    assert whole == Counter(pair for pair in bag if pair[0] in ("hot", "b"))
    assert [(row["chunk"], row["ids"]) for row in rows if row["agency"] == "silent"] == [(None, [])]


def test_article_ids(spark):
    news = frame(spark, [news_row("a", 1), news_row("a", 1), news_row("a", "x1"), news_row("zzz", 1)])
    rows = ids.article_ids(names(spark, "a", "silent"), news)
    assert {tuple(row) for row in rows.collect()} == {("a", "1", 2), ("a", "x1", 1), ("silent", None, 0)}
    assert ids.articles_of(rows, "a").count() == 2


def test_last_message_ids(spark):
    news = frame(
        spark,
        [news_row("a", 9, minute=1), news_row("a", 3, minute=2), news_row("a", 5, minute=2), news_row("c", 1),
         ("https://t.me/x/5", dt.datetime(2023, 1, 1), "n", "l", None)],
    )
    rows = ids.last_message_ids(names(spark, "a", "b"), news)
    assert {tuple(row) for row in rows.collect()} == {("https://t.me/s/a", 5), ("https://t.me/s/b", 0)}
    assert {tuple(row) for row in ids.latest_per_agency(news).filter("agency = 'a'").collect()} == {
        ("a", dt.datetime(2023, 1, 1, 0, 2))
    }


def test_newest_rows_are_found_by_hash_aggregates(spark):
    text = plan(ids.last_message_ids(names(spark, "a"), frame(spark, [news_row("a", 1)])))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_fresh_and_first_copies(spark):
    rows = [news_row("a", 1, "late", 5), news_row("a", 1, "b", 2), news_row("a", 1, "a", 2), news_row("a", 2), news_row("b", 1)]
    rows += [news_row("hot", 1, f"t{i}", 30) for i in range(500)]
    numbered = frame(spark, rows).withColumn("id", F.split_part("url", F.lit("/"), F.lit(5)).cast("int"))
    first = ids.first_copies(numbered)
    assert first.columns == numbered.columns
    assert {(row["agency"], row["id"], row["news"]) for row in first.collect()} == {
        ("a", 1, "a"), ("a", 2, "text"), ("b", 1, "text"), ("hot", 1, "t0"),
    }
    seen = spark.createDataFrame([("a", 1), ("a", 1), ("b", 9)], "agency string, id int")
    new = ids.fresh(first, ids.words(seen))
    assert {(row["agency"], row["id"]) for row in new.collect()} == {("a", 2), ("b", 1), ("hot", 1)}
    assert "LeftAnti" in plan(new)


def test_rows_without_id_are_not_taken_for_copies(spark):
    rows = [news_row("a", "x"), news_row("a", "y"), news_row("a", "y"), (None, None, "n", None, None), (None, None, "m", None, None),
            ("https://t.me/z/1", None, "p", None, None), ("https://t.me/q/1", None, "p", None, None)]
    numbered = frame(spark, rows).withColumn("id", F.split_part("url", F.lit("/"), F.lit(5)).try_cast("int"))
    assert ids.first_copies(numbered).count() == 6


def test_messages_move_once(spark):
    rows = frame(spark, [news_row("a", i) for i in range(50)])
    numbered = rows.withColumn("id", F.split_part("url", F.lit("/"), F.lit(5)).try_cast("bigint"))
    seen = spark.createDataFrame([("a", 0, 0b110)], "agency string, word long, mask long").hint("shuffle_merge")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(ids.fresh_copies(ids.keyed_copies(numbered), seen))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange each for the messages and the seen ids, plus the test's own repartition.
    assert "LeftAnti" in text and text.count("\nArguments: hashpartitioning(") == 2
    assert ids.fresh_copies(ids.keyed_copies(numbered), seen).count() == 48
