import random
from collections import Counter, defaultdict

import pytest
from helpers import plan
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wireloom.operators import boilerplate, joins, metrics


def facts(spark, count=3000):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None]), i) for i in range(count)]
    return rows, spark.createDataFrame(rows, "k string, v int").repartition(4)


def test_size_check(spark):
    lookup = spark.range(1000).withColumn("t", F.repeat(F.lit("x"), 100))
    assert joins.fits_broadcast(lookup)
    assert not joins.fits_broadcast(lookup, max_rows=999)
    assert not joins.fits_broadcast(lookup, max_bytes=50_000)
    assert joins.fits_broadcast(lookup.limit(0))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_broadcast_and_salted_joins_agree(spark, how):
    _, frame = facts(spark)
    lookup = spark.createDataFrame([("hot", 1), ("a", 2), ("zzz", 3)], "k string, w int")
    plain = joins.lookup_join(frame, lookup, "k", how)
    salted = joins.lookup_join(frame, lookup, "k", how, max_rows=1)
    assert plain.columns == salted.columns
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, salted.collect()))
    assert "BroadcastHashJoin" in plan(plain)


def test_large_lookup_spreads_a_hot_key(spark):
    _, frame = facts(spark)
    lookup = spark.createDataFrame([("hot", 1), ("a", 2)], "k string, w int")
    assert "_salt" in plan(joins.lookup_join(frame, lookup, "k", "inner", max_rows=1))


def test_hot_keys(spark):
    rows, frame = facts(spark)
    got = {r["_key"]: r["_salts"] for r in joins.hot_keys(frame, ["k"], pieces=4).collect()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = {r["k"]: r["h"] for r in frame.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    counts = Counter(k for k, _ in rows)
    assert got == {keys[k]: -(-n * parts * 4 // len(rows)) for k, n in counts.items() if n * 2 * parts > len(rows)}
    many = spark.range(20_000).select((F.col("id") % 9000).alias("k"))
    assert joins.hot_keys(many, ["k"]).collect() == [] and joins.hot_keys(many.limit(0), ["k"]).collect() == []


def test_a_hot_key_fills_no_task(spark):
    """Half of all facts have one key, a sixth another; no task gets beyond twice the median."""
    number = F.col("id")
    key = F.when(number % 2 == 0, -1).when(number % 3 == 0, -2).otherwise(number % 5000).cast("long")
    frame = spark.range(0, 600_000, 1, 8).select(key.alias("k"), number.alias("v"))
    lookup = spark.range(-2, 5000).select(number.alias("k"), (number * 2).alias("w"))
    wanted = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        joined = joins.lookup_join(frame, lookup, "k", "inner", max_rows=1, by=["v"])
        sizes = sorted(r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        salted, repeated = joins.spread(frame, lookup, ["k"])
        copies = repeated.groupBy("k").count().filter("count > 1").collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 600_000 and len(sizes) == 40
    assert sizes[-1] <= 2 * sizes[20]
    assert {r["k"] for r in copies} == {-1, -2}  # plain keys are not repeated


def test_unknown_join_type(spark):
    with pytest.raises(ValueError):
        joins.lookup_join(spark.range(1), spark.range(1), "id", "full")


def test_positions(spark):
    rng = random.Random(2)
    rows = [("hot", 5, "same")] * 9000
    rows += [(rng.choice(["hot", "a", "b", None]), rng.randint(0, 50), f"u{rng.randint(0, 40)}") for _ in range(3000)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "g string, d int, u string").repartition(5)
    got = metrics.batch_positions(frame, "g", ["d", "u"]).collect()
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row[1:])
    wanted = {
        (group, *key, place, len(keys)) for group, keys in groups.items() for place, key in enumerate(sorted(keys), 1)
    }
    assert len(got) == len(rows) and set(map(tuple, got)) == wanted


def test_totals(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,)], "agency string")
    rows = {(row["agency"], row["is_total"]): row["news_amount"] for row in metrics.collected_per_agency(frame).collect()}
    assert rows == {("a", False): 2, (None, False): 1, (None, True): 3}


def test_enrich_counts(spark):
    frame = spark.createDataFrame([("economy",), ("other",), ("not_news",), (None,)], "category string")
    assert tuple(metrics.enrich_counts(frame).first()) == (1, 3)
    assert tuple(metrics.enrich_counts(frame.limit(0)).first()) == (0, 0)


def test_rate_of_nothing(spark):
    row = spark.range(1).select(metrics.seconds_per_item(F.lit(2), F.lit(0)), metrics.seconds_per_item(F.lit(7), F.lit(3)))
    assert tuple(row.first()) == (2000000.0, 2.33)


def test_labels_from_a_table(spark):
    news = spark.createDataFrame([("c", "ab abc x 18+"), ("d", "abc 18+"), (None, "abc")], "agency string, news string")
    labels = spark.createDataFrame([("c", "ab"), ("c", "abc"), ("c", "ab"), ("c", "")], "channel string, phrase string")
    got = {row["agency"]: row["news"] for row in boilerplate.strip_by_labels(news, labels).collect()}
    assert got == {"c": "    x  ", "d": "abc  ", None: "abc"}


def replaced(text, phrases):
    for phrase in sorted({p for p in phrases if p}, key=lambda p: (-len(p), p)):
        text = text.replace(phrase, " ")
    return text


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("ab é", max_size=4), max_size=8), st.text("ab é", max_size=30))
def test_stripper_replaces_one_after_another(phrases, text):
    assert boilerplate.PhraseStripper(phrases).strip(text) == replaced(text, phrases)


@pytest.mark.parametrize("few, block, max_rows", [(50, 1000, 1000), (2, 1000, 1000), (2, 1000, 1), (2, 11, 1)])
def test_many_phrases(spark, few, block, max_rows):
    rng = random.Random(8)
    listed = [("hot" if rng.random() < 0.5 else rng.choice("abcd"), "".join(rng.choices("xy z", k=rng.choice([0, 2, 3, 4])))) for _ in range(40)]
    rows = [(rng.choice(["hot", "hot", "a", "b", "q", None]), i, "".join(rng.choices("xy z18+", k=40))) for i in range(600)]
    rows += [("hot", -1, None), ("a", -2, ""), (None, -3, None)]
    news = spark.createDataFrame(rows, "agency string, _salt int, news string").withColumnRenamed("_salt", "n").repartition(4)
    labels = spark.createDataFrame([*listed, (None, "y"), ("a", None)], "channel string, phrase string")
    how = {"common": ("18+", "x "), "few": few, "block": block, "max_rows": max_rows}
    done = boilerplate.strip_by_labels(news, labels, **how)
    assert done.columns == news.columns
    got = {r["n"]: (r["agency"], r["news"]) for r in done.collect()}
    own = defaultdict(set)
    for channel, phrase in listed:
        own[channel].add(phrase)
    assert got == {n: (a, None if t is None else replaced(t, own[a] | {"18+", "x "})) for a, n, t in rows}
    assert boilerplate.strip_by_labels(news.limit(0), labels, **how).collect() == []


def test_many_phrases_cost_little_more(spark):
    """10,000 phrases of a channel take at most three times as long as 10."""
    import time

    news = spark.range(0, 60_000, 1, 8).selectExpr("'c' agency", "id", "repeat(concat('some words of news ', id, ' '), 15) news")

    def seconds(n):
        labels = spark.range(n).selectExpr("'c' channel", "concat('words of news ', id + 59000, ' ') phrase")
        start = time.perf_counter()
        boilerplate.strip_by_labels(news, labels).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(10)
    assert seconds(10_000) < 3 * max(seconds(10), 1)
