"""A trie of conversations by their first turns, with totals over every subtree by centroid decomposition.

A node is a distinct sequence of first turns (role, text); its name is (least conversation that starts with it, depth),
which is unique.  Sequences are told apart by 128 bits: every turn has a hash of its place, role and text, and a prefix
has the exclusive or of its turns' hashes.  Places and prefixes are running values over a range-partitioned, sorted
table: each part computes its own, and a conversation that spans parts adds what came before, so that no conversation has to
fit into a task.

Totals over subtrees come from a centroid decomposition of the parent edges.  A component is a connected piece of the
trie with one top node.  Its centroid is its deepest node with at least half of its weight below it; the weight of a subtree
is the number of turns of conversations in it, which one plain aggregate gives for every node.  Taking out the centroid splits
the component into pieces of at most half the weight.  The total of what hangs on the centroid goes to the centroid and to all
nodes on its path to the top, and a node's total over all rounds is its subtree's.  All components are split at
once; who lies below a centroid or on its path is looked up by conversation and depth.  Rounds end when no component is
above ``SMALL``, after the logarithm of their number at most; small components are finished in tasks that read one after another.

Nulls: a null turn comes first, a null role or text is an empty one.  A row without a conversation belongs to none and is left out.
Turns of one number are ordered by role and text; repeated rows are turns of their own.  A conversation may
end up without turns; it then ends at the root.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireloom.llm.storage import stored

#: Conversations that share their opening turns, and the number of values that the length of an opening has.
FAMILY, OPENINGS = 100, 6
#: Weight up to which a component is finished in one task.
SMALL = 2_000
#: Characters of a text that rows are dealt by (they are ordered by the whole of it).
DEALT = 32
#: Bytes of conversation ids that travel in one row.
CHUNK = 1 << 16

NODE = ["conv", "depth"]
VALUES = ["leaves", "saved"]


def running(rows: DataFrame, key: str, order: Sequence[str], dealt: Sequence[str | Column], lanes: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows (key, keep) with ``place``, from 0 in each key by ``order``, and the running exclusive or of ``lanes``.

    Rows are dealt by ranges of ``key`` and ``dealt``, of which ``order`` is a refinement.
    """
    names = [key, *keep, *lanes]

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, last, count, sums = TaskContext.get().partitionId(), None, 0, {lane: np.int64(0) for lane in lanes}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            starts = np.flatnonzero(first)
            group, carried = np.cumsum(first) - 1, keys[0] == last
            place = np.arange(len(keys)) - starts[group]
            place[group == 0] += count if carried else 0
            columns = {}
            for lane in lanes:
                whole = np.bitwise_xor.accumulate(batch.column(lane).to_numpy())
                before = np.concatenate([[0], whole[starts[1:] - 1]])
                columns[lane] = whole ^ before[group]
                if carried:
                    columns[lane][group == 0] ^= sums[lane]
                sums[lane] = columns[lane][-1]
            last, count = keys[-1], int(place[-1]) + 1
            made = [pa.array(columns[name]) if name in columns else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*made, pa.array(place), pa.array(np.full(len(keys), part, np.int32))], [*names, "place", "part"])

    schema = [*(f"{name} long" for name in names), "place long", "part int"]
    sorted_rows = rows.repartitionByRange(key, *dealt).sortWithinPartitions(key, *order).select(*names)
    own = stored(sorted_rows.mapInArrow(run, ", ".join(schema)), "running")
    told = own.groupBy(key, "part").agg(F.count("*").alias("rows"), *[F.max_by(lane, "place").alias(lane) for lane in lanes])
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part of a key
    before = told.select(F.col(key).alias("_key"), F.col("part").alias("_part"), F.sum("rows").over(earlier).alias("_rows"), *[F.bit_xor(lane).over(earlier).alias(f"_{lane}") for lane in lanes])
    before = before.filter("_rows > 0")  # of keys that span parts
    joined = own.join(before, (F.col(key) == F.col("_key")) & (F.col("part") == F.col("_part")), "left")
    return joined.select(
        key,
        *keep,
        *[F.col(lane).bitwiseXOR(F.coalesce(f"_{lane}", F.lit(0).cast("long"))).alias(lane) for lane in lanes],
        (F.col("place") + F.coalesce("_rows", F.lit(0))).alias("place"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, length), and their turns (conv, place, a, b, chars, length) after rebuilding.

    A conversation opens with the first turns of its family's first one, and goes on with its own turns after as many.
    """
    empty = F.lit("")
    told = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    hashed = told.withColumns({"a": F.xxhash64(F.lit(1), "role", "text"), "b": F.xxhash64(F.lit(2), "role", "text"), "chars": F.length("text").cast("long")})
    own = stored(running(hashed, "conv", ["turn", "role", "text"], ["turn", "role", F.substring("text", 1, DEALT)], [], ["a", "b", "chars"]), "turns")

    convs = own.groupBy("conv").agg(F.count("*").alias("turns"))
    convs = convs.withColumns({"family": F.expr(f"conv - conv % {FAMILY}"), "opening": F.crc32(F.col("conv").cast("string")) % OPENINGS})
    firsts = convs.select(F.col("conv").alias("family"), F.least("turns", F.lit(OPENINGS - 1)).alias("at_most")).filter(f"family % {FAMILY} = 0")
    convs = convs.join(firsts, "family", "left").withColumn("opening_turns", F.least("opening", F.coalesce("at_most", F.lit(0))))
    convs = convs.withColumn("length", F.col("opening_turns") + F.greatest(F.col("turns") - F.col("opening"), F.lit(0)))
    convs = stored(convs.select("conv", "family", "opening", "opening_turns", "length"), "conversations")

    after = own.join(convs, "conv").filter("place >= opening").withColumn("place", F.expr("place - opening + opening_turns"))
    openings = own.filter(f"conv % {FAMILY} = 0 and place < {OPENINGS - 1}").withColumnRenamed("conv", "family")
    opened = openings.join(convs, "family").filter("place < opening_turns")
    columns = ["conv", "place", "a", "b", "chars", "length"]
    return convs.select("conv", "length"), after.select(columns).unionByName(opened.select(columns))


def paths_and_nodes(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(member, depth, conv, ends) of every conversation and depth, and (conv, depth, n_convs, chars, weight) of every node."""
    lanes = {name: F.xxhash64(F.lit(seed), "place", "a", "b") for seed, name in ((3, "p"), (4, "q"))}
    numbered = turns.withColumns(lanes).withColumn("depth", F.col("place") + 1).drop("place")
    prefixes = running(numbered, "conv", ["depth"], ["depth"], ["p", "q"], ["depth", "chars", "length"]).drop("place")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", "length", *[zero.alias(name) for name in ("depth", "chars", "p", "q")])
    prefixes = stored(prefixes.unionByName(roots), "prefixes")
    nodes = prefixes.groupBy("depth", "p", "q").agg(
        F.min("conv").alias("least"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight")
    )
    nodes = stored(nodes, "nodes")
    paths = prefixes.join(nodes.select("depth", "p", "q", "least"), ["depth", "p", "q"])
    paths = paths.select(F.col("conv").alias("member"), "depth", F.col("least").alias("conv"), (F.col("length") == F.col("depth")).alias("ends"))
    return stored(paths, "paths"), nodes.select(F.col("least").alias("conv"), "depth", "n_convs", "chars", "weight")


def _at(paths: DataFrame, name: str) -> DataFrame:
    """Paths as a lookup by (_member, _depth)."""
    return paths.select(F.col("member").alias("_member"), F.col("depth").alias("_depth"), F.col("conv").alias(name))


def with_parents(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes with the conversation that names their parent, their number of children, and what they add to totals."""
    asked = nodes.withColumns({"_member": F.col("conv"), "_depth": F.col("depth") - 1})
    edges = stored(asked.join(_at(paths, "parent"), ["_member", "_depth"], "left").drop("_member", "_depth"), "edges")
    children = edges.filter("parent is not null").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    whole = edges.join(children, NODE, "left").na.fill(0, ["n_children"])
    return stored(whole.withColumns({"leaves": F.expr("cast(n_children = 0 as bigint)"), "saved": F.expr("(n_convs - 1) * chars")}), "trie")


def rollup(parent: Sequence[int], values: Sequence[Sequence[int]]) -> list[list[int]]:
    """Totals of every subtree of one component: nodes in order of depth, parents by place, -1 for the top."""
    n, wide = len(parent), range(len(values[0]))
    children: list[list[int]] = [[] for _ in range(n)]
    size, out, gone = [1] * n, [[0] * len(wide) for _ in range(n)], [False] * n
    for v in range(n - 1, 0, -1):
        children[parent[v]].append(v)
        size[parent[v]] += size[v]
    tops = [0]
    while tops:
        top = tops.pop()
        centroid, below = top, top
        while below is not None:
            centroid = below
            below = next((c for c in children[centroid] if not gone[c] and 2 * size[c] >= size[top]), None)
        total, reached = [0] * len(wide), [centroid]
        for v in reached:
            for i in wide:
                total[i] += values[v][i]
            reached.extend(c for c in children[v] if not gone[c])
        gone[centroid] = True
        v = centroid
        while True:  # along the path to the top
            for i in wide:
                out[v][i] += total[i]
            if v == top:
                break
            v = parent[v]
            size[v] -= size[centroid]
        tops.extend(c for c in children[centroid] if not gone[c])
        if centroid != top:
            tops.append(top)
    return out


def _finished(batches) -> Iterator:
    """Totals of whole small components, which come one after another, each in order of depth."""
    import pyarrow as pa

    def totals(rows: list[tuple]):
        places = {(row[2], row[3]): i for i, row in enumerate(rows)}
        found = rollup([-1, *(places[row[4], row[3] - 1] for row in rows[1:])], [row[5:7] for row in rows])
        return [(row[2], row[3], *total) for row, total in zip(rows, found, strict=True)]

    def told(made: list[tuple]):
        return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*made, strict=True)], [*NODE, *VALUES])

    rows: list[tuple] = []
    for batch in batches:
        made = []
        for row in zip(*(batch.column(name).to_pylist() for name in ("top", "top_depth", *NODE, "parent", *VALUES)), strict=True):
            if rows and rows[0][:2] != row[:2]:
                made += totals(rows)
                rows = []
            rows.append(row)
        if made:
            yield told(made)
    if rows:
        yield told(totals(rows))


def subtree_totals(nodes: DataFrame, paths: DataFrame, small: int = SMALL) -> DataFrame:
    """(conv, depth, leaves, saved) of every node, summed over its subtree, by centroid decomposition."""
    top = ["top", "top_depth"]
    columns = [*top, *NODE, "parent", *VALUES, "weight"]
    same = (F.col("top") == F.col("_top")) & (F.col("top_depth") == F.col("_top_depth"))
    # The trie is one component at first: that of the root, which all conversations pass.
    root = nodes.filter("depth = 0").select("conv", "weight").first() or (0, 0)
    sized = nodes.withColumns({"top": F.lit(root[0]).cast("long"), "top_depth": F.lit(0).cast("long"), "total": F.lit(root[1]).cast("long")}).select(*columns, "total")
    finished, added = [], []
    while True:
        finished.append(sized.filter(F.col("total") <= small).select(columns))
        large = sized.filter(F.col("total") > small)
        if large.isEmpty():
            break
        # The nodes with half of the weight below them are a path that ends at the centroid.
        centroids = large.filter("2 * weight >= total").groupBy(*top).agg(F.max_by(F.struct("conv", "weight"), "depth").alias("c"), F.max("depth").alias("c_depth"))
        centroids = centroids.select(*[F.col(name).alias(f"_{name}") for name in top], F.col("c.conv").alias("c_conv"), F.col("c.weight").alias("c_weight"), "c_depth")
        near = large.join(centroids, same).drop("_top", "_top_depth")
        # A node at the centroid's depth or deeper asks for its own ancestor there, a higher one for the centroid's ancestor at its depth.
        deep = F.col("depth") >= F.col("c_depth")
        asked = near.withColumns({"_member": F.when(deep, F.col("conv")).otherwise(F.col("c_conv")), "_depth": F.least("depth", "c_depth")})
        met = asked.join(_at(paths, "met"), ["_member", "_depth"]).drop("_member", "_depth")
        below = deep & (F.col("met") == F.col("c_conv"))
        met = met.withColumns({"below": below, "on_path": ~deep & (F.col("met") == F.col("conv")), "is_centroid": below & (F.col("depth") == F.col("c_depth"))})
        asked = met.withColumns({"_member": F.when(F.expr("below and not is_centroid"), F.col("conv")), "_depth": F.col("c_depth") + 1})
        marked = stored(asked.join(_at(paths, "branch"), ["_member", "_depth"], "left").drop("_member", "_depth"), "split")
        hanging = marked.filter("below").groupBy(*top).agg(*[F.sum(name).alias(name) for name in VALUES])
        hanging = hanging.select(*[F.col(name).alias(f"_{name}") for name in top], *VALUES)
        given = marked.filter("on_path or is_centroid").select(*top, *NODE).join(hanging, same)
        added.append(stored(given.select(*NODE, *VALUES), "added"))
        upper = marked.filter("not below").withColumn("weight", F.expr("weight - if(on_path, c_weight, 0L)"))
        lower = marked.filter("below and not is_centroid").withColumns({"top": F.col("branch"), "top_depth": F.col("c_depth") + 1})
        active = upper.select(columns).unionByName(lower.select(columns))
        totals = active.groupBy(*top).agg(F.max("weight").alias("total"))
        totals = totals.select(*[F.col(name).alias(f"_{name}") for name in top], "total")
        sized = stored(active.join(totals, same).select(*columns, "total"), "components")
    rest = finished[0]
    for more in finished[1:]:
        rest = rest.unionByName(more)
    dealt = rest.repartition(*top).sortWithinPartitions(*top, *NODE[::-1])
    done = dealt.mapInArrow(_finished, ", ".join(f"{name} long" for name in (*NODE, *VALUES)))
    for more in added:
        done = done.unionByName(more)
    return done.groupBy(*NODE).agg(*[F.sum(name).alias(name) for name in VALUES])


def end_digests(paths: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256): SHA-256 of the ascending ids, joined by commas, of the conversations that end at a node.

    Ids are sorted by ranges over all tasks and travel on as pieces of text; a digest reads its pieces one after another,
    so its task holds one of them at a time.
    """

    def pieces(batches):
        import pyarrow as pa

        def told(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], [*NODE, "first", "ids"])

        key, ids, length = None, [], 0
        for batch in batches:
            rows = []
            for conv, depth, member in zip(*(batch.column(name).to_pylist() for name in (*NODE, "member")), strict=True):
                if ids and ((conv, depth) != key or length >= CHUNK):
                    rows.append((*key, int(ids[0]), ",".join(ids)))
                    ids, length = [], 0
                key = conv, depth
                ids.append(str(member))
                length += len(ids[-1]) + 1
            if rows:
                yield told(rows)
        if ids:
            yield told([(*key, int(ids[0]), ",".join(ids))])

    def digests(batches):
        import pyarrow as pa

        def told(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], [*NODE, "ends_sha256"])

        key, state = None, None
        for batch in batches:
            rows = []
            for conv, depth, ids in zip(batch.column("conv").to_pylist(), batch.column("depth").to_pylist(), batch.column("ids"), strict=True):
                if (conv, depth) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        rows.append((*key, state.hexdigest()))
                    key, state = (conv, depth), hashlib.sha256()
                state.update(ids.as_py().encode())
            if rows:
                yield told(rows)
        if key is not None:
            yield told([(*key, state.hexdigest())])

    ends = paths.filter("ends").select(*NODE, "member")
    dealt = ends.repartitionByRange(*NODE, "member").sortWithinPartitions(*NODE, "member")
    some = stored(dealt.mapInArrow(pieces, "conv long, depth long, first long, ids string"), "ends")
    return some.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, "conv long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, small: int = SMALL) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node of a table of turns."""
    convs, whole = rebuilt(turns)
    paths, nodes = paths_and_nodes(convs, whole)
    trie = with_parents(paths, nodes)
    totals = subtree_totals(trie, paths, small).select(*NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    joined = trie.drop(*VALUES).join(totals, NODE).join(end_digests(paths), NODE, "left")
    return joined.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
