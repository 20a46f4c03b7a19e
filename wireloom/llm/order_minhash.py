"""Order MinHash fingerprints: sensitive to the order of a text, hence to edit distance.

The k-mers of a text are runs of three tokens: words, and the characters of words longer than ``LONG`` (scripts without
spaces, encoded runs), so every text has k-mers in proportion to its length.  Each is numbered by how often it occurred
before, so equal k-mers of a text count apart.  Each of ``SKETCHES`` sketches has an order of k-mers, a hash; the
``CHOSEN`` least are selected, listed in the order of the text and hashed as a tuple.  Two texts agree in a sketch if the same k-mers were
selected and stand in the same order.  The likeness of fingerprints is the share of sketches that agree.

The next document comes from ranges of the id: a document's range is found by binary search among the ranges' first
ids (one number per range), and each range gets a copy of the next range's first document, so every document meets its
successor inside its range and texts move once.

All of it is built-in functions.  A fingerprint is an expression over plain numbers of one row and needs neither
aggregate nor shuffle.

Nulls: a null text is an empty one; documents with a null id come last.  Rows with equal ids follow one another by text.
A text without words has an empty fingerprint, which is like another empty one and nothing else.  The only document of
a table is its own successor.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireloom.functions.text import bind

KMER = 3
#: Words of more characters than this are taken character by character.
LONG = 20
SKETCHES = 32
CHOSEN = 2
#: K-mers of a text are compared in pieces of so many: n of them cost n / PIECE + CHOSEN * PIECE further comparisons, least near the root of n / CHOSEN.
PIECE = 12
#: Ranges of ids for each shuffle partition, so that hashing ranges to partitions is even.
RANGES = 8

WHITE = r"[\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    """Words of a text, and the characters of long ones."""

    def cut(words: Column) -> Column:
        long = lambda w: F.char_length(w) > LONG
        pieces = F.flatten(F.transform(words, lambda w: F.when(long(w), F.split(w, "")).otherwise(F.array(w))))
        return F.when(F.exists(words, long), pieces).otherwise(words)

    return bind(F.array_remove(F.split(text, WHITE), ""), cut)


def with_kmers(rows: DataFrame, text_col: str, out: str, k: int = KMER) -> DataFrame:
    """Add an array of (slot, name) of the occurrence-numbered k-mers of a text, in order; a shorter text is one k-mer."""
    hashed = rows.withColumn("_words", F.transform(tokens(F.col(text_col)), lambda w: F.xxhash64(w)))
    number = F.size("_words") - k + 1
    starts = F.slice("_words", 1, F.greatest(number, F.lit(1)))
    names = F.transform(starts, lambda w, i: F.xxhash64(w, *(F.get("_words", i + j) for j in range(1, k))))
    named = hashed.withColumns({"_names": F.when(F.size("_words") > 0, names).otherwise(F.array().cast("array<bigint>"))})

    def kmer(place: Column, name: Column, number: Column) -> Column:
        return F.struct(place.alias("slot"), F.xxhash64(name, number).alias("name"))

    plain = F.transform("_names", lambda h, i: kmer(i, h, F.lit(0)))
    # Equal names stand together once sorted; a run's first place in that order gives each its number.
    sorted_ = F.sort_array(F.transform("_names", lambda h, i: F.struct(h.alias("h"), i.alias("place"))))
    named = named.withColumn("_sorted", F.when(F.size(F.array_distinct("_names")) < F.size("_names"), sorted_))
    first = F.filter(
        F.transform("_sorted", lambda x, i: F.when((i == 0) | (F.get("_sorted", i - 1)["h"] != x["h"]), i)), lambda i: i.isNotNull()
    )
    named = named.withColumn("_first", first)
    numbered = F.flatten(
        F.transform(
            "_first",
            lambda s, r: F.transform(
                F.slice("_sorted", s + 1, F.coalesce(F.get("_first", r + 1), F.size("_sorted")) - s),
                lambda x, o: kmer(x["place"], x["h"], o),
            ),
        )
    )
    return named.withColumn(out, F.when(F.col("_sorted").isNull(), plain).otherwise(F.sort_array(numbered))).drop("_words", "_names", "_sorted", "_first")


def _pieces(names: Column) -> Column:
    """Names in order, as an array of pieces; one empty piece of none."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(names), F.lit(1)), F.lit(PIECE)), lambda start: F.slice(names, start, PIECE))


def _last_chosen(values: Column) -> Column:
    """The greatest of the ``CHOSEN`` least of a few values; null of none."""
    return F.array_max(F.slice(F.sort_array(values), 1, CHOSEN))


def _least(values: Column) -> Column:
    """The ``CHOSEN`` least of a few values, as they stand."""
    return bind(_last_chosen(values), lambda bound: F.filter(values, lambda v: v <= bound))


def _chosen(pieces: Column, j: Column) -> Column:
    """The hashes of the ``CHOSEN`` least k-mers under the ``j``-th order, in the order of the text; fewer in short texts.

    They lie in those pieces whose own least ones are the ``CHOSEN`` least, so only a few pieces are searched for more.
    """

    def near(values: Column, least: Column) -> Column:
        return bind(_last_chosen(least), lambda bound: F.flatten(F.filter(values, lambda own, i: F.get(least, i) <= bound)))

    def choose(values: Column) -> Column:
        return bind(F.transform(values, lambda own: F.array_min(own)), lambda least: near(values, least), _least)

    return bind(F.transform(pieces, lambda own: F.transform(own, lambda name: F.xxhash64(name, j))), choose)


def _merged(one: Column, other: Column) -> Column:
    """The sketch of a text from the hashes chosen of two parts of it."""
    return bind(F.concat(one, other), lambda values: F.xxhash64(_least(values)))


def _of_each(work: Callable[[Column], Column]) -> Column:
    """An array of what is made for each order."""
    return F.transform(F.sequence(F.lit(0), F.lit(SKETCHES - 1)), work)


def _unless_empty(kmers: Column, sketches: Column) -> Column:
    return F.coalesce(F.when(F.size(kmers) > 0, sketches), F.array().cast("array<bigint>"))


def fingerprint(kmers: Column) -> Column:
    """An array of sketches, empty where there are no k-mers; those are in the order of the text."""
    return _unless_empty(kmers, bind(kmers["name"], _pieces, lambda held: _of_each(lambda j: F.xxhash64(_chosen(held, j)))))


def with_fingerprints(rows: DataFrame, kmers: str, edited: str, out: str, edited_out: str) -> DataFrame:
    """Add the fingerprints of two texts that may begin alike; what their k-mers have in common at the beginning is hashed once."""

    def alike(names: Column) -> Column:
        differs = F.array_position(F.zip_with(names["one"], names["other"], lambda a, b: a.eqNullSafe(b)), F.lit(False)).cast("int")
        return F.struct(names["one"].alias("one"), names["other"].alias("other"), F.when(differs > 0, differs - 1).otherwise(F.size(names["one"])).alias("alike"))

    def parts(names: Column) -> Column:
        rest = lambda of: F.slice(of, names["alike"] + 1, F.size(of))
        return F.transform(F.array(F.slice(names["one"], 1, names["alike"]), rest(names["one"]), rest(names["other"])), _pieces)

    def sketches(held: Column) -> Column:
        def of_order(j: Column) -> Column:
            return bind(F.transform(held, lambda pieces: _chosen(pieces, j)), lambda x: F.struct(_merged(x[0], x[1]).alias("one"), _merged(x[0], x[2]).alias("other")))

        return _of_each(of_order)

    both = bind(F.struct(F.col(kmers)["name"].alias("one"), F.col(edited)["name"].alias("other")), alike, parts, sketches)
    made = rows.withColumn("_both", both)
    return made.withColumns({out: _unless_empty(F.col(kmers), F.col("_both.one")), edited_out: _unless_empty(F.col(edited), F.col("_both.other"))}).drop("_both")


def likeness(one: Column, other: Column) -> Column:
    """The share of sketches that agree; two empty fingerprints are alike."""
    same = F.size(F.filter(F.zip_with(one, other, lambda a, b: a.eqNullSafe(b)), lambda x: x))
    return F.when((F.size(one) == 0) & (F.size(other) == 0), F.lit(1.0)).when((F.size(one) == 0) | (F.size(other) == 0), F.lit(0.0)).otherwise(same / SKETCHES)


def as_text(fingerprint: Column) -> Column:
    """16 hexadecimal digits for each sketch."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def range_of(value: Column, firsts: list[int]) -> Column:
    """How many of the ascending numbers are not above the value: binary search in a constant array."""
    if not firsts:
        return F.lit(0)
    steps = [1 << b for b in reversed(range(len(firsts).bit_length()))]
    bounds = F.split(F.lit(",".join(map(str, firsts))), ",").cast("array<bigint>")
    found = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(bounds, at + step - 1) <= value, F.lit(False)), at + step).otherwise(at),
    )
    return F.when(value.isNull(), F.lit(len(firsts))).otherwise(found)


def with_next(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) in ranges: part, idx in the part, copy (whether it stands for the next part's first), next."""
    spark = docs.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id").filter("doc_id is not null").repartitionByRange(ranges, "doc_id")
    firsts = sorted(r[0] for r in ids.groupBy(F.spark_partition_id()).agg(F.min("doc_id")).select("min(doc_id)").collect())  # one per range
    part = range_of(F.col("doc_id"), firsts[1:])
    heads = docs.filter(F.col("doc_id").isin(firsts) if firsts else F.col("doc_id").isNull())
    heads = heads.groupBy("doc_id").agg(F.min("text").alias("text"))
    at = F.when(part == 0, F.lit(max(0, len(firsts) - 1))).otherwise(part - 1)
    rows = docs.select("doc_id", "text", part.alias("part"), F.lit(False).alias("copy"))
    rows = rows.unionByName(heads.select("doc_id", "text", at.alias("part"), F.lit(True).alias("copy")))
    order = Window.partitionBy("part").orderBy("copy", F.col("doc_id").asc_nulls_last(), "text")
    return rows.withColumns({"idx": F.row_number().over(order), "next": F.lead("text").over(order)})


def order_minhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts and of edited texts, whose second half is replaced by the next document's beginning."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - half), F.coalesce(F.col("next"), F.lit("")).substr(F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_kmers(with_kmers(rows, "text", "kmers"), "edited", "edited_kmers")
    keys = ["part", "idx", "copy", "doc_id", "n_chars", "edited_sha256"]
    found = with_fingerprints(rows, "kmers", "edited_kmers", "fingerprint", "edited_fp").select(*keys, "fingerprint", "edited_fp")
    found = found.withColumn("next_fp", F.lead("fingerprint").over(Window.partitionBy("part").orderBy("idx")))
    return found.filter("not copy").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fp")).alias("near_next"),
    )
