"""Category, headline and summary of news."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom import fixed_values as fv
from wireloom.functions import text as tx
from wireloom.operators.compute import with_value
from wireloom.operators.joins import fits_broadcast, lookup_join
from wireloom.session import checkpointed

SUMMARY_SENTENCES = 3
#: Power iterations over the graph of sentences, and the greatest rank after each.
RANKING_ROUNDS, RANK_SCALE = 3, 1000
#: Words of sentences, by which they are alike.
WORD = re.compile(r"[^\s.,;:!?…\"()]+")
#: Runs of so many words occur once in a headline or summary.
NO_REPEAT_WORDS = 4

#: Texts whose sentences a worker holds as Python objects.
TEXTS_AT_ONCE = 256

#: Words of a classifier that are broadcast at most.
FREQUENT_WORDS = 100_000

MODEL_ERRORS = ("title_error", "resume_error")

BatchModel = Callable[[Sequence[str]], Sequence[str]]


def drop_non_news(df: DataFrame, category: str = "category") -> DataFrame:
    """Leave out what the classifier takes for no news, before any costly step."""
    return df.filter(F.col(category).isNotNull() & ~F.col(category).isin(*fv.NON_NEWS_LABELS))


def override_category(df: DataFrame, mono: DataFrame) -> DataFrame:
    """Specialised agencies (telegram, mono_category) set the category of their news."""
    fixed = mono.select(F.col("telegram").alias("agency"), "mono_category")
    return lookup_join(df, fixed, "agency", "left").select(
        *[
            F.coalesce("mono_category", "category").alias("category") if name == "category" else F.col(name)
            for name in df.columns
        ]
    )


def train_classifier(
    labelled: DataFrame,
    text: str = "news",
    label: str = "label",
    features: int = 1 << 16,
    estimator: Estimator | None = None,
) -> PipelineModel:
    """A linear bag-of-words topic classifier, trained on all labelled rows.

    The default is multinomial naive Bayes: one distributed pass over the labelled
    rows, and a model whose size depends on labels and features only.  Any Spark
    ML classifier can take its place, for instance ``LogisticRegression``.
    """
    final = estimator.copy() if estimator is not None else NaiveBayes()
    final.setLabelCol("_label").setFeaturesCol("_features").setPredictionCol("_prediction")
    stages = [
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol=text, outputCol="_words", pattern="[^\\p{L}\\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_features", numFeatures=features),
        final,
    ]
    trained = Pipeline(stages=stages).fit(labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull()))
    names = IndexToString(inputCol="_prediction", outputCol="category", labels=trained.stages[0].labels)
    return PipelineModel([*trained.stages[1:], names])


def classify(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``category`` as the classifier names it; one pass, no shuffle."""
    scored = model.transform(df)
    return scored.select(*df.columns, tx.label_name(F.col("category")).alias("category"))


def words_of(text: str) -> Column:
    """The words of a text, as an array."""
    return F.array_remove(F.split(text, r"[ \n]+"), "")


def _micro(value: Column) -> Column:
    """A logarithm in whole millionths, so that sums are exact and ties are ties."""
    return F.round(F.log(value) * 1_000_000).cast("bigint")


def bayes_labels(labelled: DataFrame, rows: DataFrame, key: str = "doc_id", text: str = "news", label: str = "label", frequent: int = FREQUENT_WORDS) -> DataFrame:
    """(key, category): the label that naive Bayes over exact words finds for each row; the least one on ties.

    Every word of every labelled text counts; there is no bound on the vocabulary.  Counts are smoothed by one.  The model
    has one row per word with a weight for each label; the labels are few.  Its most frequent words are broadcast
    (``frequent`` of them at most, and only if they measure small), so most words of a text are weighed where the text is
    and reach the shuffle as one sum per row.  Only rare words are joined by word, and those cannot be skewed.
    """
    known = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    priors = {r[0]: r[1] for r in known.groupBy(label).agg(_micro(F.count(F.lit(1)))).orderBy(label).collect()}  # the labels are few
    if not priors:
        return rows.select(key, F.lit(None).cast("string").alias("category"))
    names = list(priors)
    tokens = known.select(F.col(label).alias("_label"), F.explode(words_of(text)).alias("term"))
    counted = [F.count_if(F.col("_label") == name).alias(f"n{i}") for i, name in enumerate(names)]
    model = checkpointed(tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n"), *counted))
    vocabulary, *totals = model.agg(F.count(F.lit(1)), *[_micro(F.sum(f"n{i}") + F.count(F.lit(1))) for i in range(len(names))]).first()
    weights = model.select("term", "n", *[_micro(F.col(f"n{i}") + 1).alias(f"w{i}") for i in range(len(names))])
    summed = [F.sum(f"w{i}").alias(f"w{i}") for i in range(len(names))]
    own = rows.select(key, F.explode(words_of(text)).alias("term"))
    common = checkpointed(weights.orderBy(F.desc("n"), "term").limit(frequent).drop("n"))
    if fits_broadcast(common, frequent):
        hits = own.join(F.broadcast(common), "term").groupBy(key).agg(*summed)
        others, rare = own.join(F.broadcast(common.select("term")), "term", "left_anti"), weights.join(F.broadcast(common.select("term")), "term", "left_anti")
        met = hits.unionByName(others.join(rare.drop("n"), "term").groupBy(key).agg(*summed))
    else:
        met = own.join(weights.drop("n"), "term").groupBy(key).agg(*summed)
    met = met.groupBy(key).agg(*summed)
    scored = rows.select(key, F.size(words_of(text)).cast("long").alias("words")).join(met, key, "left")

    def cost(i: int) -> Column:
        return F.struct((F.coalesce("words", F.lit(0)) * (totals[i] or 0) - priors[names[i]] - F.coalesce(f"w{i}", F.lit(0))).alias("cost"), F.lit(names[i]).alias("label"))

    return scored.select(key, F.array_min(F.array(*map(cost, range(len(names)))))["label"].alias("category"))


def window_sentences(text: Column, window: int = fv.MODEL_INPUT_TOKENS) -> Column:
    """The sentences within a model's input window, as an array."""
    return tx.sentences(tx.truncate_tokens(text, window))


def ranked_sentences(sentences: Sequence[str], count: int, rounds: int = RANKING_ROUNDS) -> list[int]:
    """Places of the sentences that share most words with others that do, in text order; earlier ones on ties.

    Sentences are nodes of a graph, joined by as many edges as they have distinct words in common.  A few power iterations
    in whole numbers give every sentence the sum of its neighbours' ranks; each costs as much as there are words.
    """
    numbers: dict[str, int] = {}
    held = [{numbers.setdefault(word, len(numbers)) for word in WORD.findall(sentence)} for sentence in sentences]
    size = np.array([len(own) for own in held], np.int64)
    place, word = np.repeat(np.arange(len(held)), size), np.fromiter((number for own in held for number in own), np.int64, int(size.sum()))
    rank = np.full(len(held), RANK_SCALE, np.int64)
    for _ in range(rounds):  # all sums are whole numbers far below 2**53
        total = np.bincount(word, rank[place], len(numbers))
        rank = np.bincount(place, total[word], len(held)).astype(np.int64) - size * rank
        rank = rank * RANK_SCALE // max(1, rank.max(initial=0))
    return sorted(sorted(range(len(rank)), key=lambda i: (-rank[i], i))[:count])


def central_sentences(sentences: pa.Array, count: pa.Array) -> pa.Array:
    """The central ones of the distinct sentences of each text, joined; null for null.

    Only ``TEXTS_AT_ONCE`` texts of a batch are Python objects at a time.
    """

    def joined(own: list[str] | None, most: int) -> str | None:
        if own is None:
            return None
        distinct = list(dict.fromkeys(own))
        chosen = range(len(distinct)) if len(distinct) <= most else ranked_sentences(distinct, most)
        return " ".join(distinct[i] for i in chosen)

    made = [pa.array([], pa.string())]
    for start in range(0, len(sentences), TEXTS_AT_ONCE):
        part = (column.slice(start, TEXTS_AT_ONCE).to_pylist() for column in (sentences, count))
        made.append(pa.array(map(joined, *part), pa.string()))
    return pa.concat_arrays(made)


@F.arrow_udf(T.StringType())
def _central(sentences: pa.Array, count: pa.Array) -> pa.Array:
    return central_sentences(sentences, count)


def _summary_of(sentences: Column, count: int = SUMMARY_SENTENCES) -> Column:
    """The most central sentences without repeated n-grams."""
    return without_repeats(_central(sentences, F.lit(count)))


def _headline_of(sentences: Column) -> Column:
    first = F.coalesce(F.get(sentences, 0), F.lit(""))
    return F.when(sentences.isNotNull(), without_repeats(F.rtrim(first, F.lit("."))))


def without_repeats(text: Column, size: int = NO_REPEAT_WORDS) -> Column:
    """A text that ends before the word which would complete a run of ``size`` words for the second time."""

    def cut(words: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.array_join(F.slice(words, i, size), " "))

        def at_first(found: Column) -> Column:
            again = F.filter(F.sequence(F.lit(1), F.size(found)), lambda i: F.array_position(found, F.element_at(found, i)) < i)
            return F.array_join(F.slice(words, 1, F.get(again, 0) + (size - 2)), " ")

        return F.when(F.size(F.array_distinct(runs)) < F.size(runs), tx.bind(runs, at_first))

    words = F.filter(F.split(text, r"\s+"), lambda word: word != "")
    return F.coalesce(F.when(F.size(words) > size, tx.bind(words, cut)), text)


def summarize(text: Column, sentences: int = SUMMARY_SENTENCES, window: int = fv.MODEL_INPUT_TOKENS) -> Column:
    """Default summary: the most central sentences within the model's input window, in text order, without repeated n-grams.

    Only the sentences of the window reach Python, so what travels is bounded however long a text is.
    """
    return _summary_of(window_sentences(text, window), sentences)


def headline(text: Column, window: int = fv.MODEL_INPUT_TOKENS) -> Column:
    """Default headline: the first sentence within the input window, without its full stop and without repeated n-grams."""
    return tx.bind(window_sentences(text, window), _headline_of)


def batch_inference(load_model: Callable[[], BatchModel], batch_size: int = 32) -> Callable[[Column], Column]:
    """Turn a text-to-text batch model into a Column function.

    The model is loaded once per task and only the text column goes to Python.
    Texts of similar length share a batch.  The result is a struct of ``value``
    and ``error``: a failing text does not stop the others.
    """

    def attempt(model: BatchModel, texts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            return [(value, None) for value in model(texts)]
        except Exception as failure:  # noqa: BLE001 - any model error becomes data
            if len(texts) > 1:
                return [result for text in texts for result in attempt(model, [text])]
            return [(None, f"{type(failure).__name__}: {failure}")]

    @F.pandas_udf("value string, error string")
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for texts in batches:
            results: list[tuple[str | None, str | None]] = [(None, None)] * len(texts)
            order = [i for i in texts.str.len().argsort() if texts.iloc[i] is not None]
            for start in range(0, len(order), batch_size):
                places = order[start : start + batch_size]
                for place, result in zip(places, attempt(model, [texts.iloc[i] for i in places])):
                    results[place] = result
            yield pd.DataFrame(results, columns=["value", "error"])

    return infer


def enrich(
    df: DataFrame,
    mono: DataFrame,
    title: Callable[[Column], Column] | None = None,
    resume: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Classified staged news to final news: filter, override, headline, summary.

    ``df`` carries the classifier's ``category``.  Headline and summary are both
    made from the full news text; the defaults for both share one split into
    sentences.  A plugged-in model gives a struct of ``value`` and ``error``, as
    ``batch_inference`` does, or plain text; errors are kept as ``title_error``
    and ``resume_error``.
    """
    kept = override_category(drop_non_news(df), mono)
    news, sentences = F.col("news"), F.col("_sentences")
    if title is None or resume is None:
        kept = with_value(kept, "_sentences", window_sentences(news))
    made = kept.withColumns(
        {
            "title": title(news) if title else _headline_of(sentences),
            "resume": resume(news) if resume else _summary_of(sentences),
        }
    ).drop("_sentences")
    return _split_errors(_split_errors(made, "title"), "resume")


def _split_errors(df: DataFrame, column: str) -> DataFrame:
    """Take value and error of a model's column apart."""
    if not isinstance(df.schema[column].dataType, T.StructType):
        return df
    return df.withColumns({column: F.col(column)["value"], f"{column}_error": F.col(column)["error"]})


def value_of(made: DataFrame, column: str) -> DataFrame:
    """The frame with a model's column as plain text; rows that the model failed on are left out."""
    split = _split_errors(made, column)
    return split.filter(F.col(f"{column}_error").isNull()).drop(f"{column}_error") if f"{column}_error" in split.columns else split
