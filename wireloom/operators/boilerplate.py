"""Boilerplate phrases kept in a table.

Phrases of a channel go longest first, then in code-point order, each replaced by a space in what the ones before left.
Few phrases travel as an array next to the row and stay in the JVM.  Of many, hardly any occurs in a text: there an
automaton over all phrases of a channel tells which do, and only those are replaced, with the same result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom import fixed_values as fv
from wireloom.functions import text as tx
from wireloom.operators.joins import MAX_BROADCAST_ROWS, fits_broadcast, lookup_join, spread
from wireloom.operators.metrics import batch_positions

#: Phrases of a channel that travel as an array; phrases in one automaton.
FEW_PHRASES, BLOCK_PHRASES = 50, 100_000


def phrases_per_channel(labels: DataFrame) -> DataFrame:
    """(channel, phrase) rows to one array per channel."""
    return labels.filter(F.col("phrase") != "").groupBy("channel").agg(F.collect_set("phrase").alias("phrases"))


class PhraseStripper:
    """Replaces phrases by a space as if one after another was sought, longest first, then in code-point order.

    The automaton finds all phrases that a text holds.  A replacement can only bring about phrases that reach over the
    new space, so only its surroundings are looked at again.
    """

    def __init__(self, phrases: Iterable[str]) -> None:
        import ahocorasick

        self.phrases = sorted({p for p in phrases if p}, key=lambda phrase: (-len(phrase), phrase))
        self.reach = len(self.phrases[0]) - 1 if self.phrases else 0
        self.automaton = ahocorasick.Automaton()
        for rank, phrase in enumerate(self.phrases):
            self.automaton.add_word(phrase, rank)
        if self.phrases:
            self.automaton.make_automaton()

    def found(self, text: str) -> set[int]:
        """Ranks of the phrases that a text holds."""
        return {rank for _, rank in self.automaton.iter(text)} if self.phrases else set()

    def strip(self, text: str) -> str:
        known = self.found(text)
        waiting = sorted(known)
        while waiting:
            rank = heapq.heappop(waiting)
            parts = text.split(self.phrases[rank])
            if len(parts) == 1:
                continue
            text, at = " ".join(parts), -1
            for part in parts[:-1]:
                at += len(part) + 1
                for new in self.found(text[max(0, at - self.reach) : at + self.reach + 1]) - known:
                    known.add(new)
                    if new > rank:
                        heapq.heappush(waiting, new)
        return text


class ChannelStrippers:
    """A stripper per channel, made when its first row comes; ``others`` are for channels that list nothing."""

    def __init__(self, listed: dict[str, list[str]], others: Sequence[str]) -> None:
        self.listed, self.others, self.made = listed, list(others), {}

    def of(self, channel: str | None) -> PhraseStripper:
        key = channel if channel in self.listed else None
        if key not in self.made:
            self.made[key] = PhraseStripper(self.others if key is None else self.listed[key])
        return self.made[key]


def _strip_in_place(news: DataFrame, listed: DataFrame, text: str, channel: str, others: Sequence[str]) -> DataFrame:
    """Strip phrases that were measured as small enough to be sent along: rows stay where they are.

    What was sent is kept by a Python worker with the automata it made, so they are built once per worker.
    """
    by_channel: dict[str, list[str]] = {}
    for own, phrase in listed.collect():  # fits_broadcast has bounded it
        by_channel.setdefault(own, []).append(phrase)
    sent = news.sparkSession.sparkContext.broadcast(ChannelStrippers(by_channel, others))
    place, key = news.columns.index(text), news.columns.index(channel)

    def run(batches):
        import pyarrow as pa

        strippers = sent.value
        for batch in batches:
            rows = zip(batch.column(key).to_pylist(), batch.column(place).to_pylist(), strict=True)
            out = pa.array([None if own is None else strippers.of(name).strip(own) for name, own in rows], pa.string())
            yield pa.RecordBatch.from_arrays([out if i == place else column for i, column in enumerate(batch.columns)], batch.schema.names)

    return news.mapInArrow(run, _as_nullable(news.schema))


def _as_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(field.name, field.dataType, True) for field in schema])


def _strip_blocks(news: DataFrame, blocks: DataFrame, text: str, channel: str, others: Sequence[str]) -> DataFrame:
    """Strip the phrases (channel, phrase) from the rows of their channels, ``others`` from rows of channels without any.

    Phrases and rows of a channel meet in one stream, phrases first, so no row carries phrases and no group is held; a
    hot channel is spread over several streams, each with its phrases.
    """
    columns, place = news.columns, news.columns.index(text)
    whole = F.struct(*[F.col(name) for name in columns])
    named = news.select(F.col(channel).alias("_channel"), whole.alias("_row"))
    rows, rules = spread(named, blocks.select(F.col("channel").alias("_channel"), F.col("phrase").alias("_phrase")), ["_channel"], pieces=2)
    rows = rows.select("_channel", "_salt", F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("_phrase"), "_row")
    rules = rules.select("_channel", "_salt", F.lit(0).alias("_kind"), "_phrase", F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    stream = rules.unionByName(rows).repartition("_channel", "_salt").sortWithinPartitions("_channel", "_salt", "_kind")

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        rest = PhraseStripper(others)
        group, listed, stripper = None, [], rest
        for batch in batches:
            kinds = batch.column("_kind").to_pylist()
            keys = zip(batch.column("_channel").to_pylist(), batch.column("_salt").to_pylist(), strict=True)
            phrases = batch.column("_phrase").to_pylist()
            kept = batch.filter(pc.equal(batch.column("_kind"), 1)).column("_row")
            fields = kept.flatten()
            texts, out = iter(fields[place].to_pylist()), []
            for key, kind, phrase in zip(keys, kinds, phrases, strict=True):
                if key != group:
                    group, listed, stripper = key, [], rest
                if kind == 0:
                    listed.append(phrase)
                    continue
                if listed:
                    stripper, listed = PhraseStripper(listed), []
                own = next(texts)
                out.append(None if own is None else stripper.strip(own))
            fields[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(fields, columns)

    return stream.mapInArrow(run, _as_nullable(news.schema))


def strip_by_labels(
    news: DataFrame,
    labels: DataFrame,
    text: str = "news",
    channel: str = "agency",
    common: Sequence[str] = fv.BOILERPLATE[fv.COMMON_LABELS_KEY],
    few: int = FEW_PHRASES,
    block: int = BLOCK_PHRASES,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Replace the phrases a table lists for a row's channel, and the common ones, by a space.

    Where no channel has more than ``few`` phrases they are joined as arrays.  Otherwise automata find them: where the
    rows are, if the phrases measure small, else where rows and phrases of a channel meet; there a channel with more than
    ``block`` phrases is worked through in several passes, in the phrases' order.  The result is the same.  For phrases known when
    the job is written, ``functions.text.strip_boilerplate`` does the same without a join.  Null texts and rows of null
    channels are allowed; the latter have the common phrases only.
    """
    wanted = labels.filter((F.col("phrase") != "") & F.col("channel").isNotNull()).select("channel", "phrase")
    most = wanted.groupBy("channel").agg(F.count_distinct("phrase").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    if most > few:
        shared = F.array(*[F.lit(phrase) for phrase in common]).cast("array<string>")
        listed = wanted.unionByName(wanted.select("channel").distinct().select("channel", F.explode(shared).alias("phrase"))).distinct()
        if fits_broadcast(listed, max_rows):
            return _strip_in_place(news, listed, text, channel, common)
        if most + len(common) <= block:
            return _strip_blocks(news, listed, text, channel, common)
        ranked = batch_positions(listed.withColumn("shortness", -F.char_length("phrase")), "channel", ["shortness", "phrase"])
        ranked = ranked.select("channel", "phrase", F.floor((F.col("place") - 1) / block).alias("block"))
        for turn in range(-(-(most + len(common)) // block)):
            # The channels without phrases have the common ones in the first pass only.
            own = ranked.filter(F.col("block") == turn)
            news = _strip_blocks(news, own.select("channel", "phrase"), text, channel, common if turn == 0 else ())
        return news
    listed = phrases_per_channel(labels).withColumnRenamed("channel", channel)
    everywhere = F.array(*[F.lit(phrase) for phrase in common])
    own = F.coalesce("phrases", F.array().cast("array<string>"))
    joined = lookup_join(news, listed, channel, "left")
    phrases = tx.order_phrases(F.array_union(own, everywhere))
    return joined.select(
        *[
            tx.strip_listed_phrases(F.col(text), phrases).alias(text) if name == text else F.col(name)
            for name in news.columns
        ]
    )
