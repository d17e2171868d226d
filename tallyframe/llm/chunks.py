"""Documents dealt to chunks, so that tables of n-grams or words meet the texts chunk by chunk.

A chunk is a hash class of document ids that holds ``CHUNK_BYTES`` of text on average; their number grows
with the corpus.  Texts travel as compressed fragments, one for each chunk and input batch.  What a
chunk asks of a corpus-wide table are its distinct keys, far fewer than its tokens, and the answers
come back to the chunk, not to each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import col, text_of

CHUNK_BYTES = 16 << 20
#: Chunks are numbered in this many bits; a corpus that would need more gets larger chunks.
CHUNK_BITS, COUNT_BITS = 22, 40


def chunk_count(docs: DataFrame, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> int:
    """How many chunks the corpus needs; only the total reaches the driver."""
    total = docs.agg(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0
    return chunks_for(int(total), chunk_bytes)


def chunks_for(total_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    size = max(chunk_bytes, -(-total_bytes // (1 << CHUNK_BITS)), 1)
    return max(1, -(-total_bytes // size))


def tagged(chunk: int, counts: np.ndarray) -> np.ndarray:
    """A chunk's number and a count in one long.  Readers of a table of keys that want either then read the same
    columns, so that Spark makes the table once for all of them (it reuses an exchange that is alike)."""
    return (np.int64(chunk) << COUNT_BITS) | counts


def tag_chunk(tag: Column) -> Column:
    return F.shiftright(tag, COUNT_BITS)


def tag_count(tag: Column) -> Column:
    return tag.bitwiseAND(F.lit((1 << COUNT_BITS) - 1))


def chunk_of(id_: Column, chunks: int) -> Column:
    """The chunk of a document id, by the id alone."""
    return F.pmod(F.xxhash64(F.lit(5), id_.cast("string")), F.lit(chunks)).cast("long")


def fragments(docs: DataFrame, chunks: int, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """(chunk, payload): the columns id, th (hash of the text), t (the text in UTF-8) and ``more`` of some documents of a
    chunk, in one compressed message; dealt by chunk."""
    text = text_of(text_col)
    id_ = col(id_col)
    rows = docs.select(chunk_of(id_, chunks).alias("chunk"), id_.alias("id"), F.xxhash64(text).alias("th"),
                       *[c.alias(name) for name, c in more.items()], text.cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
            order = np.argsort(chunk, kind="stable")
            cut = np.flatnonzero(np.r_[True, np.diff(chunk[order]) != 0, True])
            table = pa.Table.from_batches([batch]).drop_columns(["chunk"])
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk[order[a]]], pa.int64()), pa.array([_pack(table.take(order[a:b]))], pa.binary())],
                    ["chunk", "payload"])

    return rows.mapInArrow(run, "chunk long, payload binary").repartition(chunks, "chunk")


def _pack(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return out.getvalue().to_pybytes()


def opened(payloads: pa.ChunkedArray) -> Iterator[pa.Table]:
    """The fragments of a chunk, one after the other."""
    for part in payloads.chunks:
        for i in range(len(part)):
            yield pa.ipc.open_stream(part[i].as_buffer()).read_all()
