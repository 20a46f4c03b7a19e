"""How far the sources of a language diverge: from each other over all terms, and from their language term by term.

A term is a run of letters (ASCII letters, lower-cased, and everything beyond ASCII).  Each language keeps the terms that
enough of its documents hold.  A group is a source of a language; it gives a kept term with ``count`` occurrences the
smoothed share ``p = 1 + floor(10**9 * (count + 2) / (N + 2 * V))``, where N adds up its counts and V is the number of kept
terms; a language gives its share q alike.  Two shares diverge by ``floor((p - q)**2 / (p + q))``.  All of it is whole numbers.

The terms that set a group apart are a top-k query.  Divergence of a term with p > q grows with its count in the group and
falls with its count in the language, and ties go to the earlier term, so a term that k others beat in all three cannot be
among the first k.  Each part of the table keeps its k-skyband (terms dominated by fewer than k others), skybands are
merged in two steps of equal fan-in, and what is left is ranked exactly.

Divergence between sources is a sum over all kept terms.  Terms are dealt into blocks of bounded size; a block holds the
counts of its terms in all sources as a matrix, and gives one partial sum per pair of sources, of which there are as many
as the result has rows.

Nulls: a null text, language or source is an empty one.  Repeated rows count as often as they occur.  A group without
terms has shares like any other; a language without kept terms gives pairs of value 0 and no terms.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wireloom.llm.storage import stored
from wireloom.llm.tokens import parts

#: Documents of a language that a kept term occurs in at least, and ranks that are returned for terms.
LEAST_DOCUMENTS = 10
TOP = 10
#: Shares are parts of this.
SCALE = 1_000_000_000
#: Distinct terms of groups that a task holds before it hands on their counts.
HELD_TERMS = 400_000
#: Rows (term, source) of a block of terms, about, and cells of a matrix over them.
BLOCK_ROWS = 50_000
CELLS = 1 << 20
#: Points that are compared with a skyband at once.
POINTS = 256

COUNTS = "lang string, source string, term string, n long, docs long"
POINT = "lang string, source string, term string, n long, total long, value long, part int"
PAIR = "lang string, source string, item string, value long"


def _letters() -> bytes:
    """Byte to byte: ASCII letters to lower case, bytes of other characters as they are, all else to a space."""
    return bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


LETTERS = _letters()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and documents of the group that hold it.

    Tasks add up what they meet before anything is shuffled.
    """

    def count(batches):
        import pyarrow as pa

        def told():
            for (lang, source), (occurs, holds) in groups.items():
                if occurs:
                    terms = list(occurs)
                    columns = [
                        pa.array([lang] * len(terms)),
                        pa.array([source] * len(terms)),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(list(occurs.values()), pa.int64()),
                        pa.array([holds[term] for term in terms], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        groups, held = {}, 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
                occurs, holds = groups.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(occurs), set()
                for part in parts(text.as_py().translate(LETTERS)):
                    words = part.split()
                    occurs.update(words)
                    own.update(words)
                holds.update(own)
                held += len(occurs) - before
                if held > HELD_TERMS:
                    yield from told()
                    groups, held = {}, 0
        yield from told()

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    told = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), text)
    return told.mapInArrow(count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def skyband(n: np.ndarray, total: np.ndarray, terms: np.ndarray, k: int) -> np.ndarray:
    """Places of the points that fewer than k others dominate: no lower n, no higher total and an earlier term.

    Points are taken in an order in which each comes after those that dominate it.  Who is dominated by k points is
    dominated by k points of the skyband, so comparing with the kept ones is enough.
    """
    place = np.empty(len(terms), np.int64)
    place[np.argsort(terms, kind="stable")] = np.arange(len(terms))
    order = np.lexsort((place, total, -n))
    kept_total, kept_place, kept = np.empty(0, np.int64), np.empty(0, np.int64), []
    for start in range(0, len(order), POINTS):
        own = order[start : start + POINTS]
        t, p = total[own], place[own]
        beaten = ((kept_total <= t[:, None]) & (kept_place < p[:, None])).sum(1)
        inside = (t <= t[:, None]) & (p < p[:, None]) & np.tri(len(own), k=-1, dtype=bool)
        stays = np.zeros(len(own), bool)
        for i in np.flatnonzero(beaten < k):
            stays[i] = beaten[i] + np.count_nonzero(inside[i] & stays) < k
        kept.append(own[stays])
        kept_total, kept_place = np.append(kept_total, t[stays]), np.append(kept_place, p[stays])
    return np.concatenate(kept) if kept else np.empty(0, np.int64)


def _band(frame, k: int):
    """The rows of a data frame of one group that are in its skyband."""
    return frame.iloc[skyband(frame["n"].to_numpy(), frame["total"].to_numpy(), frame["term"].to_numpy(object), k)]


def skybands(points: DataFrame, k: int) -> DataFrame:
    """The k-skyband of each group of points (lang, source, term, n, total, value): of each part, of parts, of all."""

    def plain(frame):
        """Strings as objects: joined columns of strings would be in several chunks."""
        return frame.astype(dict.fromkeys(("lang", "source", "term"), object))

    def of_part(frames):
        import pandas as pd
        from pyspark import TaskContext

        part, bands = TaskContext.get().partitionId(), {}
        for frame in frames:
            for key, own in plain(frame).groupby(["lang", "source"], sort=False):
                joined = pd.concat([bands[key], own]) if key in bands else own
                bands[key] = _band(joined, k)
        for band in bands.values():
            yield plain(band).assign(part=part)

    def merged(frame):
        return plain(_band(frame, k))

    own = stored(points.mapInPandas(of_part, POINT), "skybands")
    fan = max(1, round((own.agg(F.max("part")).first()[0] or 0) ** 0.5))
    some = own.withColumn("part", F.expr(f"part div {fan}")).groupBy("lang", "source", "part").applyInPandas(merged, POINT)
    return some.groupBy("lang", "source").applyInPandas(merged, POINT).drop("part")


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): divergence of each two sources of a language, summed over its kept terms.

    ``counts`` are (lang, source, term, n) of kept terms, stored; ``groups`` are (lang, source, occurrences, kept).
    """
    blocks = counts.count() // BLOCK_ROWS + 1

    def sums(own, sources):
        import pandas as pd

        sources = sources.sort_values("source").reset_index(drop=True)
        names, many = sources["source"].to_numpy(object), len(sources)
        whole = (sources["occurrences"] + 2 * sources["kept"]).to_numpy(np.int64)
        value = np.zeros((many, many), np.int64)
        if len(own):
            column = pd.Index(names).get_indexer(own["source"])
            row, terms = pd.factorize(own["term"])
            n = own["n"].to_numpy(np.int64)
            share, none = 1 + SCALE * (n + 2) // whole[column], 1 + SCALE * 2 // whole
            order, step = np.argsort(row, kind="stable"), max(1, CELLS // many)
            cuts = np.searchsorted(row[order], np.arange(0, len(terms) + step, step))
            for at, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
                some = order[start:end]
                shares = np.tile(none, (min(step, len(terms) - at * step), 1))
                shares[row[some] - at * step, column[some]] = share[some]
                for a in range(many - 1):
                    p, q = shares[:, a : a + 1], shares[:, a + 1 :]
                    value[a, a + 1 :] += ((p - q) ** 2 // (p + q)).sum(0)
        a, b = np.nonzero(~np.eye(many, dtype=bool))
        value += value.T
        made = pd.DataFrame({"lang": [sources["lang"].iloc[0]] * len(a) if many else [], "source": names[a], "item": names[b], "value": value[a, b]})
        return made.astype({"lang": object, "source": object, "item": object})

    dealt = counts.select("lang", "source", "term", "n", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"))
    told = groups.select("lang", "source", "occurrences", "kept", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    some = dealt.groupBy("lang", "block").cogroup(told.groupBy("lang", "block")).applyInPandas(sums, PAIR)
    return some.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank of a table of documents."""
    counts = stored(term_counts(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_documents)
    kept = stored(kept.select("lang", "term", "total"), "kept-terms")
    counts = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total"), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_occurrences"))
    present = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    occurs = counts.groupBy("lang", "source").agg(F.sum("n").alias("occurrences"))
    groups = stored(present.join(occurs, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["occurrences", "kept", "lang_occurrences"]), "groups")

    def share(count: str, whole: str):
        return F.expr(f"1 + {SCALE}L * ({count} + 2) div ({whole} + 2 * kept)")

    shares = counts.join(groups, ["lang", "source"]).withColumns({"p": share("n", "occurrences"), "q": share("total", "lang_occurrences")})
    points = shares.filter("p > q").selectExpr("lang", "source", "term", "n", "total", "(p - q) * (p - q) div (p + q) as value")
    parts_of = {
        "pair": pair_values(counts, groups).withColumn("part", F.lit("pair")),
        "term": skybands(points, top).select("lang", "source", F.col("term").alias("item"), "value", F.lit("term").alias("part")),
    }
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = {name: rows.withColumn("rank", F.row_number().over(order)) for name, rows in parts_of.items()}
    both = ranked["pair"].unionByName(ranked["term"].filter(F.col("rank") <= top))
    return both.select("lang", "source", "part", "item", "value", "rank")
