"""Flat files of unsigned token ids with 64-bit document offsets.

Documents are dealt by ranges of their id, so that a shard holds consecutive documents.  A task writes one shard: the
ids of its documents one after another as unsigned integers (16 bits if the vocabulary allows, else 32), and beside it
an index of 64-bit offsets and ids.  A shard's base, the number of ids in all shards before it, is a prefix sum over one
count per shard.  Readers map shards into memory and add the base.

A task names its files by its attempt and its row in the manifest names them again, so a repeated or speculative task
never disturbs files that are in use.

Nulls: a null text is an empty one.  Null ids come first.  Rows with equal ids are ordered by text.  Further columns of
the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wireloom.llm.storage import filesystem, make_folder, mapped, stored
from wireloom.llm.tokens import default_vocabulary, word_ids
from wireloom.session import scratch_path

#: Index: mark, bytes per id, number of documents; then offsets (one more than documents), ids of documents, and a byte each: 1 if the id is null.
HEAD = "<8sqq"
MARK = b"TOKENS01"

SHARD = "part int, name string, n_docs long, n_tokens long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, folder: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Encode texts into shards below ``folder``; returns the manifest (part, name, n_docs, n_tokens, base)."""
    vocabulary = vocabulary or default_vocabulary()
    make_folder(folder)

    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        context, encoder, end = TaskContext.get(), word_ids(vocabulary), struct.pack("<I", end_id)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        part, out, place, path = context.partitionId(), None, *filesystem(folder)
        name, offset, offsets, ids, nulls = f"shard-{part:07d}-{context.taskAttemptId()}", 0, [np.zeros(1, "<i8")], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or place.open_output_stream(os.path.join(path, f"{name}.bin"))
            lengths = []
            for text in batch.column("text"):
                encoded = encoder.text_ids(text.as_py() or b"") + end
                out.write(encoded if width == 4 else np.frombuffer(encoded, "<u4").astype("<u2").tobytes())
                lengths.append(len(encoded) // 4)
            offsets.append(offset + np.cumsum(np.array(lengths, "<i8")))
            offset = int(offsets[-1][-1])
            ids.append(batch.column("id").fill_null(0).to_numpy().astype("<i8"))
            nulls.append(batch.column("id").is_null().to_numpy(zero_copy_only=False).astype("u1"))
        if out is not None:
            out.close()
            with place.open_output_stream(os.path.join(path, f"{name}.idx")) as index:
                n_docs = sum(map(len, ids))
                index.write(struct.pack(HEAD, MARK, width, n_docs))
                for column in (*offsets, *ids, *nulls):
                    index.write(column.tobytes())
            row = [[part], [name], [n_docs], [offset]]
            yield pa.RecordBatch.from_arrays([pa.array(value, kind) for value, kind in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["part", "name", "n_docs", "n_tokens"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    shards = stored(texts.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(write, SHARD), "token-shards")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def shard_documents(folder: str, name: str) -> Iterator[tuple]:
    """Documents of a shard: id, offset in the shard, ids as an array over the mapped file."""
    import numpy as np

    index = mapped(folder, f"{name}.idx")
    mark, width, n_docs = struct.unpack_from(HEAD, index)
    head = struct.calcsize(HEAD)
    if mark != MARK:
        raise ValueError(f"{name}.idx is not an index of token ids")
    offsets = np.frombuffer(index, "<i8", n_docs + 1, head)
    ids = np.frombuffer(index, "<i8", n_docs, head + offsets.nbytes)
    nulls = np.frombuffer(index, "u1", n_docs, head + offsets.nbytes + ids.nbytes)
    tokens = np.frombuffer(mapped(folder, f"{name}.bin"), f"<u{width}")
    if len(tokens) != offsets[-1]:
        raise ValueError(f"{name}.bin holds {len(tokens)} ids; its index says {offsets[-1]}")
    for i in range(n_docs):
        yield None if nulls[i] else int(ids[i]), int(offsets[i]), tokens[offsets[i] : offsets[i + 1]]


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start over all shards, n_tokens, ids_crc32 of its 32-bit ids."""

    def read(batches):
        import pyarrow as pa

        kinds = [pa.int64()] * 4
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for shard in batch.to_pylist():
                rows = []
                for doc_id, offset, tokens in shard_documents(folder, shard["name"]):
                    rows.append((doc_id, shard["base"] + offset, len(tokens), zlib.crc32(tokens.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    shards = max(1, manifest.count())
    return manifest.select("part", "name", "base").repartition(shards, "part").mapInArrow(read, DOCUMENT)


def token_file_digests(docs: DataFrame, end_id: int = 1, vocabulary: str | None = None) -> DataFrame:
    """Write a table's token files into the shared folder and read their documents back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, end_id, vocabulary=vocabulary), folder)
