import math
import random
import re
from collections import Counter, defaultdict

from helpers import NEWS, column, news_row, plan
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from wireloom.operators import enrich as en


def test_filter_comes_before_the_model(spark):
    frame = spark.createDataFrame([(1, "economy"), (2, "other"), (3, "not_news"), (4, None)], "i int, category string")
    assert [row["i"] for row in en.drop_non_news(frame).collect()] == [1]


def test_summary_and_headline(spark):
    text = "One here. Two!  Two! Three?\nOne here. Four… Five."
    assert column(spark, [text, "", None, "no stop"], en.summarize(F.col("x"))) == [
        "One here. Two! Three?", "", None, "no stop",
    ]
    central = "Nothing in common. The cat sat here. Alone. A cat sat there. Where the cat was. Odd one out."
    assert column(spark, [central], en.summarize(F.col("x"))) == ["The cat sat here. A cat sat there. Where the cat was."]
    assert column(spark, [text, "", None, "End..."], en.headline(F.col("x"))) == ["One here", "", None, "End"]
    long = " ".join(["w"] * 700) + ". Second."
    assert column(spark, [long], en.summarize(F.col("x"))) == ["w w w w"]


def brute_rank(sentences, count):
    words = [set(re.findall(r"[^\s.,;:!?…\"()]+", s)) for s in sentences]
    shared = [[0 if i == j else len(a & b) for j, b in enumerate(words)] for i, a in enumerate(words)]
    rank = [1000] * len(words)
    for _ in range(3):
        rank = [sum(w * r for w, r in zip(row, rank)) for row in shared]
        rank = [r * 1000 // (max(rank) or 1) for r in rank]
    return sorted(sorted(range(len(rank)), key=lambda i: (-rank[i], i))[:count])


def test_ranks_equal_power_iterations_over_the_matrix():
    rng = random.Random(2)
    for _ in range(200):
        sentences = [" ".join(rng.choices(["a", "b", "cat", "dog", "e,", "f"], k=rng.randint(0, 6))) + "." for _ in range(rng.randint(1, 20))]
        assert en.ranked_sentences(sentences, 3) == brute_rank(sentences, 3)


def test_no_run_of_four_words_twice(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "b", "c"], k=rng.randint(0, 60))) for _ in range(200)]
    for text, got in zip(texts, column(spark, texts, en.without_repeats(F.col("x")))):
        words, out = text.split(), got.split()
        runs = [tuple(out[i : i + 4]) for i in range(len(out) - 3)]
        assert len(set(runs)) == len(runs) and words[: len(out)] == out
        if len(out) < len(words):
            assert tuple(words[len(out) - 3 : len(out) + 1]) in runs


def test_batch_inference_keeps_order_and_errors(spark):
    def load():
        def model(texts):
            if any("bad" in text for text in texts):
                raise ValueError("bad text")
            return [text.upper() for text in texts]

        return model

    values = [("x" * (i % 7)) + str(i) for i in range(300)]
    values[50], values[99] = "bad", None
    run = en.batch_inference(load, batch_size=16)
    got = column(spark, values, run(F.col("x")))
    for value, result in zip(values, got):
        if value is None:
            assert tuple(result) == (None, None)
        elif value == "bad":
            assert tuple(result) == (None, "ValueError: bad text")
        else:
            assert tuple(result) == (value.upper(), None)


def test_enrich_composition(spark):
    rows = [news_row("a", 1, "Alpha one. Beta."), news_row("b", 2, "Gamma. Delta."), news_row("a", 3, "Junk.")]
    frame = spark.createDataFrame(rows, NEWS).withColumn(
        "category", F.when(F.contains("news", F.lit("Junk")), "other").otherwise("science")
    )
    mono = spark.createDataFrame([("a", "sports")], "telegram string, mono_category string")
    got = {row["url"]: (row["category"], row["title"], row["resume"]) for row in en.enrich(frame, mono).collect()}
    assert got == {
        "https://t.me/a/1": ("sports", "Alpha one", "Alpha one. Beta."),
        "https://t.me/b/2": ("science", "Gamma", "Gamma. Delta."),
    }


def naive_bayes(train, texts):
    """Multinomial naive Bayes with add-one smoothing over hashed features counted by hand."""
    features = 1 << 16
    words, docs = defaultdict(Counter), Counter()
    for text, label in train:
        docs[label] += 1
        words[label].update(text.split())
    best = []
    for text in texts:
        scores = {
            label: math.log((docs[label] + 1) / (len(train) + len(docs)))
            + sum(
                math.log((words[label][w] + 1) / (sum(words[label].values()) + features)) for w in text.split()
            )
            for label in docs
        }
        best.append(max(scores, key=scores.get))
    return best


def test_classifier_against_counting(spark):
    train = [("goal match win", "sports"), ("match team goal goal", "sports"), ("market price rate", "economy"),
             ("bank rate price", "economy"), ("atom cell lab", "science"), ("lab cell dna", "science"), ("win bank", "economy")]
    texts = ["goal team", "rate bank match", "cell price lab", "dna", "win win win", "unseen words"]
    model = en.train_classifier(spark.createDataFrame(train, "news string, label string"))
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, news string")
    got = [row["category"] for row in sorted(en.classify(frame, model).collect())]
    assert got == naive_bayes(train, texts)


def test_classifier_with_another_estimator(spark):
    train = spark.createDataFrame(
        [("goal match", "__label__sports"), ("price rate", "__label__economy"), ("match goal", "__label__sports")],
        "news string, label string",
    )
    model = en.train_classifier(train, features=1 << 10, estimator=LogisticRegression(maxIter=20))
    got = en.classify(spark.createDataFrame([("goal",), ("rate",)], "news string"), model)
    assert {row["news"]: row["category"] for row in got.collect()} == {"goal": "sports", "rate": "economy"}


def test_defaults_send_sentences_only(spark):
    frame = spark.createDataFrame([news_row("a", 1)], NEWS)
    text = plan(frame.select(en.headline(F.col("news"))))
    assert "EvalPython" not in text and "MapIn" not in text
    text = plan(frame.select(en.summarize(F.col("news"))))
    assert text.count("\n+- ArrowEvalPython") + text.count("- ArrowEvalPython") >= 1 and "BatchEvalPython" not in text


def test_labels_do_not_depend_on_what_is_broadcast(spark):
    rng = random.Random(6)
    train = [(i, " ".join(rng.choices([f"{label}{n}" for n in range(40)] + ["the", "of"] * 20, k=20)), label) for i, label in enumerate("abc" * 20)]
    train += [(100, None, "a"), (101, "", "b"), (102, "x", None), (103, "", "d")]
    rows = spark.createDataFrame(train, "doc_id int, news string, label string")
    found = [sorted(map(tuple, en.bayes_labels(rows, rows, frequent=most).collect())) for most in (1, 7, 100_000)]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(train)
    assert sum(dict(found[0])[i] == label for i, _, label in train[:60]) >= 58
    assert en.bayes_labels(rows.limit(0), rows).filter("category is not null").count() == 0


def test_summaries_hold_few_texts_at_once():
    """A batch of many texts is ranked in slices, so a worker's memory does not follow the size of its batches."""
    import tracemalloc

    import pyarrow as pa

    own = [f"sentence {i} of words {'long ' * 30}" for i in range(30)]
    one = pa.array([own, None, [], own[:2]] * 2, pa.list_(pa.string()))
    many = pa.concat_arrays([pa.array([own[:3] * 10], pa.list_(pa.string()))] * 10_000)
    told = en.central_sentences(one, pa.array([3] * 8, pa.int32())).to_pylist()
    assert told == [" ".join(own[i] for i in en.ranked_sentences(own, 3)), None, "", " ".join(own[:2])] * 2
    tracemalloc.start()
    found = en.central_sentences(many, pa.array([3] * 10_000, pa.int32()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 10_000 and peak < 16_000_000  # all texts together are 60 MB and more
