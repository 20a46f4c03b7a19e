"""Near-duplicates by min-max hashing with confirmation on full shingle sets.

A document is the set of its distinct five-word shingles.  Under each permutation both the least and the greatest value
are kept, so half as many permutations are evaluated as a signature has values, and the estimate has less variance than
one of as many minima.  Bands of the signature name candidates; a candidate pair counts only if its full sets agree.

With 96 permutations, 192 values make 32 bands of six: a pair with similarity 0.85 is missed with probability 3e-7.

Documents with equal word sequences form a class that is compared once.  Members of a bucket are compared with its
middle, the one that meets the most others, not with each other.  Where that leaves members of several components,
two of them can still be linked; but then, beyond what the middle has, they share at least a computable number of
shingles, so that prefixes of these meet (``own_prefixes``), or their sizes allow it without (``inner_pairs``).  Groups
that share such a shingle are compared with one of their own, and what is still apart pair by pair.  So no link between
candidates is lost, and a large group of copies whose far members are unlike costs a number of comparisons in
proportion to its size.  Sets are rebuilt from the texts of candidates only.

Nulls: documents without text or words are linked with nothing.  A null id stays null, in its class's component if
another of the class has an id.  Rows with one id are one document with several texts.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom.llm.components import connected_components
from wireloom.llm.ordering import numbered
from wireloom.llm.storage import discard, stored

SHINGLE = 5
PERMUTATIONS = 96
#: Values of the signature, two from each permutation, in a band.
ROWS = 6
SIGNATURE = "doc_id long, n_shingles long, digest binary, bands array<long>"
COMPARED = "a long, b long, na long, nb long, both long"

_rng = np.random.default_rng(20240611)
_TIMES = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_PLACE = _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 1 << 63, ROWS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit names of distinct shingles; the whole sequence if there are fewer words."""
    from xxhash import xxh3_64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    names = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    total = np.full(n, min(len(words), size), np.uint64)
    for k in range(min(size, len(words))):
        total += names[k : k + n] * _PLACE[k]
    return np.unique(mixed(total))


def min_max(names: np.ndarray, block: int = 2048) -> np.ndarray:
    """Least and greatest value under each permutation, side by side."""
    low, high = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(names), block):
        values = names[None, start : start + block] * _TIMES[:, None]
        values += _PLUS[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.stack([low, high], axis=1).ravel()


def band_names(values: np.ndarray) -> np.ndarray:
    bands = values.reshape(-1, ROWS)
    total = np.arange(1, len(bands) + 1, dtype=np.uint64) * _BAND[ROWS]
    for k in range(ROWS):
        total = total + mixed(bands[:, k]) * _BAND[k]
    return mixed(total).view(np.int64)


def signed_text(text: bytes | None) -> tuple[int, bytes, np.ndarray]:
    """Number of shingles, digest of the word sequence, and names of bands (none without words) of a text."""
    words = (text or b"").lower().split()
    names = shingle_set(words)
    bands = band_names(min_max(names)) if len(names) else np.zeros(0, np.int64)
    return len(names), hashlib.blake2b(b" ".join(words), digest_size=16).digest(), bands


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, a digest of the word sequence, and the names of bands (none for documents without words)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            made = [signed_text(text.as_py()) for text in batch.column("text")]
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
            arrays = [pa.array([own[i] for own in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_shingles", "digest", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, SIGNATURE)


def _sets(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with the shingle sets of both (left, right); texts move once for each end of a pair."""

    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            made = [shingle_set((text.as_py() or b"").lower().split()).tobytes() for text in batch.column("text")]
            kept = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(made, pa.binary())], [*kept.schema.names, "names"])

    first = texts.join(pairs.select("a").distinct(), F.col("id") == F.col("a")).select("a", "text").mapInArrow(sets, "a long, names binary")
    second = texts.join(pairs, F.col("id") == F.col("b")).select(F.col("a").alias("to"), "b", "text").mapInArrow(sets, "to long, b long, names binary")
    joined = second.withColumnRenamed("names", "right").join(first.withColumnRenamed("names", "left"), F.col("to") == F.col("a"))
    return joined.select("a", "b", "left", "right")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their sets (na, nb) and of the intersection (both); ``texts`` has id and text."""

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            counts = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                counts.append((len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
            own = [pa.array(c, pa.int64()) for c in (zip(*counts, strict=True) if counts else [()] * 3)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *own], ["a", "b", "na", "nb", "both"])

    return _sets(texts, pairs).mapInArrow(compare, COMPARED)


def linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))


def own_prefixes(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b, name): shingles of b that are not a's, as many as a partner of b that is not told by a's shingles must meet.

    Let x and y be compared with c.  If they are linked, they share at least ``percent`` of the larger one, and of what
    they share at most what x has in common with c lies in c.  So outside of c they share at least
    ``need = percent of x - common of x and c``, the same holds for y, and of two sets in one order that share that much,
    the first ``outside - need + 1`` names (all of them, if need is below one) have one in common.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            prefixes = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                c, x = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                outside = np.setdiff1d(x, c, assume_unique=True)
                need = max(1, -(-percent * len(x) // 100) - (len(x) - len(outside)))
                prefixes.append(outside[: max(0, len(outside) - need + 1)].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(prefixes, pa.list_(pa.int64()))], ["a", "b", "names"])

    return _sets(texts, pairs).mapInArrow(run, "a long, b long, names array<long>").select("a", "b", F.explode("names").alias("name"))


def inner_pairs(tests: DataFrame, percent: int) -> DataFrame:
    """Pairs of what was compared with one a, that can be linked by shingles of a alone, from the sizes.

    They need ``common >= percent / (100 + percent) * (nx + ny)`` on both sides, so x names the sizes that y may have.
    """
    least = F.ceil(F.lit(percent) * F.col("nb") / 100).cast("long")
    most = F.floor(F.col("both") * (100 + percent) / F.lit(percent)).cast("long") - F.col("nb")
    x = tests.filter(~linked(percent) & (least <= most)).select("a", F.col("b").alias("x"), F.col("component").alias("cx"), F.explode(F.sequence(least, most)).alias("ny"))
    y = tests.select("a", F.col("b").alias("y"), F.col("component").alias("cy"), F.col("nb").alias("ny"), F.col("both").alias("by"), F.lit(percent).alias("p"))
    sizes = tests.select("a", F.col("b").alias("x"), F.col("nb").alias("nx"))
    found = x.join(y, ["a", "ny"]).filter("cx <> cy").join(sizes, ["a", "x"]).filter("by * (100 + p) >= p * (nx + ny)")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(signed: DataFrame, docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, component) of every class; ``signed`` holds the stored signatures of ``docs``."""
    classes = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("id"))
    classes = stored(classes, "classes")
    of_class = classes.withColumnRenamed("digest", "own")
    bands = signed.join(of_class, (F.col("digest") == F.col("own")) & (F.col("doc_id") == F.col("id"))).select("id", F.explode("bands").alias("band"))
    buckets = bands.groupBy("band").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("size")).filter("least < most")
    members = bands.join(buckets.select(F.col("band").alias("own"), "size"), F.col("band") == F.col("own"))
    members = stored(members.select("band", "id", "size").distinct(), "members")
    # The member that meets the most others stands nearest to the middle of a group.
    meets = members.groupBy("id").agg(F.sum("size").alias("meets"))
    middle = F.max(F.struct("meets", (-F.col("id")).alias("minus"))).alias("top")
    middles = members.join(meets, "id").groupBy("band").agg(middle).select("band", (-F.col("top.minus")).alias("a"))
    rays = stored(members.select("band", F.col("id").alias("b")).join(middles, "band"), "rays")
    pairs = rays.filter("a <> b").select("a", "b").distinct()
    candidates = members.select(F.col("id").alias("candidate")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    texts = stored(texts.join(candidates, F.col("id") == F.col("candidate"), "left_semi"), "candidates")
    tests = stored(compared(pairs, texts), "tests")
    links = tests.filter(linked(percent)).select("a", "b")
    found = connected_components(links, "a", "b")

    def labelled(rows: DataFrame, column: str) -> DataFrame:
        """Rows with the component of the document in a column."""
        return rows.join(found.withColumnRenamed("node", column), column, "left").withColumn("component", F.coalesce("component", column))

    several = labelled(rays, "b").groupBy("band", "a").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = stored(several.filter("low < high").select("a").distinct(), "open-middles")
    if not open_.isEmpty():
        rest = stored(tests.join(open_, "a", "left_semi"), "open-tests")
        groups = stored(own_prefixes(rest.select("a", "b").distinct(), texts, percent).distinct(), "prefixes")
        for last in (False, True):
            label = stored(labelled(groups, "b"), "labels")
            mixed_ = label.groupBy("a", "name").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("b").alias("first")).filter("low < high")
            own = label.join(mixed_.select("a", "name", "first"), ["a", "name"]).select("a", "name", "first", "b", "component")
            if last:
                other = own.select("a", "name", F.col("b").alias("y"), F.col("component").alias("cy"))
                fresh = own.join(other, ["a", "name"]).filter("component < cy").select(F.least("b", "y").alias("a"), F.greatest("b", "y").alias("b"))
            else:
                fresh = own.filter("b > first").select(F.col("first").alias("a"), "b").unionByName(inner_pairs(labelled(rest, "b"), percent))
            more = stored(compared(stored(fresh.distinct(), "pairs"), texts), "tests")
            links = links.unionByName(more.filter(linked(percent)).select("a", "b"))
            found = connected_components(links, "a", "b")
            discard(label)
    discard(texts)
    named = found.withColumnRenamed("node", "id")
    return classes.join(named, "id", "left").select(F.col("digest").alias("own"), F.coalesce("component", "id").alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable over links) and kept (whether that is its own)."""
    signed = stored(signatures(docs, id_col, text_col), "signatures")
    found = components(signed, docs, percent, id_col, text_col)
    rows = signed.select("doc_id", "n_shingles", "digest").join(found, F.col("digest") == F.col("own"), "left")
    component = F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component_id")), F.col("doc_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def one_of_each(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with all columns of the table, whatever its ids are.

    Rows are told apart by the row, not by their id: of a group stays a row with the least id (null ids last), of several
    texts with that id one, and of equal rows one.  Rows without words are in no group and stay.
    """
    rows = stored(docs.select(F.struct(*docs.columns).alias("kept"), F.monotonically_increasing_id().alias("row")), "rows")
    signed = signatures(rows.select("row", F.col(f"kept.{text_col}").alias("text")), "row", "text").withColumnRenamed("doc_id", "row")
    signed = stored(signed, "signatures")  # texts go to Python and do not come back
    named = rows.select(F.col("row").alias("_row"), F.col(f"kept.{id_col}").alias("id"))
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    classes = signed.filter("n_shingles > 0").select("row", "digest").join(named, F.col("row") == F.col("_row"))
    classes = classes.groupBy("digest").agg(F.min(place).alias("first")).select("first.unnamed", "first.id", F.col("first.row").alias("first"))
    # Numbers in the order of ids stand for classes, so no two texts share one.
    order = stored(numbered(classes, ["unnamed", "id", "first"], ["first"]), "order")
    firsts = signed.join(order, F.col("row") == F.col("first")).select(F.col("place").alias("doc_id"), "row", "n_shingles", "digest", "bands")
    firsts = stored(firsts, "firsts")
    texts = rows.join(order, F.col("row") == F.col("first")).select(F.col("place").alias("doc_id"), F.col(f"kept.{text_col}").alias("text"))
    found = components(firsts, texts, percent, "doc_id", "text")
    stays = firsts.join(found, F.col("digest") == F.col("own")).filter("doc_id = component_id").select("row")
    stays = stays.unionByName(signed.filter("n_shingles = 0").select("row"))
    return rows.join(stays, "row", "left_semi").select("kept.*")
