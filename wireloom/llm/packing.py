"""Vector best-fit packing of tokenised documents into sequences.

A piece of ``n`` tokens asks for the vector (n tokens, 1 document, n * n attention cost), so its length says all about it.
Best-fit in falling order of length needs only the number of pieces of each length, never the pieces: at most
``capacity`` counts, however large the corpus.  Bins that were filled alike form one class; of all classes that have
room for a piece under every constraint, the one with the smallest weighted residual norm after placing it (or the
largest weighted dot product of piece and residual) takes pieces first.  The plan gives each length's pieces their
class by rank, and each piece computes its own sequence and offset from its rank.

Ranks need no sort: a task numbers its pieces of a length as it writes them, and a prefix sum over one count per task
and length gives the rest.

Nulls: a null text is an empty one, a null id stays null.  An empty text is one piece that holds the end id.  Rows with
equal ids are packed as documents of their own.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wireloom.llm.storage import stored
from wireloom.llm.tokens import default_vocabulary, word_ids

#: Bytes of a generation of the word cache: packing holds pieces beside it.
CACHED_BYTES = 20 << 20
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, turn long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence may hold.  None: as much as its tokens allow, so that the limit never costs a sequence."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        tokens = self.tokens
        return np.array([tokens, self.documents or tokens, self.attention or tokens * tokens], dtype=np.int64)


@dataclass
class Plan:
    """For each length: where its ranks begin in each class, the class's first sequence, pieces a sequence, and offset."""

    spans: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    sequences: int

    def place(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins, first, each, offset = self.spans[length]
        at = np.searchsorted(begins, ranks, side="right") - 1
        within = ranks - begins[at]
        return first[at] + within // each[at], offset[at] + within % each[at] * length


def best_fit(counts: dict[int, int], capacity: Capacity, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.25, 0.25)) -> Plan:
    """Pack pieces, given the number of pieces of each length."""
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    limit = capacity.vector()
    weight = np.array(weights)
    rest = np.zeros((0, 3), np.int64)  # residual vector of each class of bins
    bins = np.zeros(0, np.int64)
    held: list[list[tuple[int, int]]] = []  # (length, pieces in each bin), as placed

    def put(at: int, length: int, times: int, many: int, item: np.ndarray) -> None:
        """Move ``many`` bins of a class on, with ``times`` more pieces of a length in each."""
        nonlocal rest, bins
        row = rest[at] - times * item
        if many == bins[at]:
            rest[at] = row
            held[at] = [*held[at], (length, times)]
        else:
            bins[at] -= many
            rest, bins = np.vstack([rest, row]), np.append(bins, many)
            held.append([*held[at], (length, times)])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        item = np.array([length, 1, length * length], np.int64)
        if (item > limit).any():
            raise ValueError(f"a piece of {length} tokens exceeds a sequence's capacity")
        room = (rest // item).min(axis=1) if len(rest) else np.zeros(0, np.int64)
        fits = np.flatnonzero(room)
        if rule == "norm":
            score = (weight * ((rest[fits] - item) / limit) ** 2).sum(axis=1)
        else:
            score = -(weight * (item / limit) * (rest[fits] / limit)).sum(axis=1)
        for at in fits[np.argsort(score, kind="stable")]:
            if not left:
                break
            times = int(room[at])
            if left >= times * bins[at]:
                left -= times * int(bins[at])
                put(at, length, times, int(bins[at]), item)
                continue
            full, over = divmod(left, times)
            if full:
                put(at, length, times, full, item)
            if over:
                put(at, length, over, 1, item)
            left = 0
        if left:
            times = int((limit // item).min())
            full, over = divmod(left, times)
            for many, each in ((full, times), (1, over)):
                if many and each:
                    rest, bins = np.vstack([rest, limit - each * item]), np.append(bins, many)
                    held.append([(length, each)])
    first = np.concatenate([[0], np.cumsum(bins)])
    spans: dict[int, list] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    for at, pattern in enumerate(held):
        offset = 0
        for length, each in pattern:
            spans[length].append((ranks[length], first[at], each, offset))
            ranks[length] += int(bins[at]) * each
            offset += length * each
    if ranks != {length: n for length, n in counts.items() if n}:
        raise AssertionError("the plan does not hold every piece")
    columns = {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in spans.items()}
    return Plan(columns, int(first[-1]))


def token_pieces(docs: DataFrame, end_id: int, size: int, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Encode texts, end each with ``end_id`` and cut the longer ones; ``turn`` counts a task's pieces of one length."""
    vocabulary = vocabulary or default_vocabulary()

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, end, part = word_ids(vocabulary, CACHED_BYTES), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        turns: dict[int, int] = defaultdict(int)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids = encoder.text_ids(text.as_py() or b"") + end
                for piece, start in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[start : start + 4 * size]
                    length = len(own) // 4
                    rows.append((doc_id, piece, start // 4, length, zlib.crc32(own), part, turns[length]))
                    turns[length] += 1
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "turn"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(cut, PIECE)


def pack(pieces: DataFrame, capacity: Capacity, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.25, 0.25)) -> DataFrame:
    """Place pieces (columns of ``token_pieces``, stored) into sequences."""
    per_task = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()  # one row per length: at most capacity.tokens
    plan = best_fit({row["length"]: row["n"] for row in totals}, capacity, rule, weights)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    bases = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            order = np.argsort(length, kind="stable")
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(own):
                    sequence[own], offset[own] = plan.place(int(length[own[0]]), rank[own])
            kept = batch.drop_columns(["rank"])
            columns = [*kept.columns, pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*kept.schema.names, "sequence_id", "offset"])

    ranked = pieces.join(bases, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("turn")).alias("rank"))
    return ranked.mapInArrow(place, PLACED)


def pack_documents(docs: DataFrame, capacity: Capacity | None = None, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Sequences of a table of documents: one row per piece with its sequence and its offset there."""
    capacity = capacity or Capacity()
    return pack(stored(token_pieces(docs, end_id, capacity.tokens, vocabulary=vocabulary), "pieces"), capacity)
