"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.batches import pieces, texts_of
from ledgerline.llm.encoder import encoder, with_end
from ledgerline.llm.tables import narrow, type_of

#: Writer options. Stripes are what readers share out; each index entry covers ``row.index.stride`` documents.
ORC = {
    "compression": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _schema(id_type: str) -> str:
    return f"doc_id {id_type}, file_no int, start_in_file bigint, n_tokens bigint, tokens array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end``, and write ORC files in ascending order of the key.

    Rows are dealt out by ranges of the key, so the files, in the order of their names, ascend. A null
    text is empty (``end`` alone), null keys come first, and rows with the same key are ordered by text. An empty
    table writes no rows.
    """
    rows = narrow(docs, key, text)
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_no, written = TaskContext.get().partitionId(), 0
        for batch in pieces(batches):
            ids, counts = with_end(*encoder(tokenizer).encode(texts_of(batch)), end)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(batch.num_rows, file_no), pa.int32()),
                    pa.array(written + offsets[:-1], pa.int64()),
                    pa.array(counts, pa.int64()),
                    lists,
                ],
                ["doc_id", "file_no", "start_in_file", "n_tokens", "tokens"],
            )
            written += int(offsets[-1])

    encoded = ordered.mapInArrow(encode, _schema(type_of(rows, "doc_id")))
    encoded.write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint", only: list[int] | None = None) -> DataFrame:
    """Rows of the files. ``only`` keeps some document ids, by the row indexes and Bloom filters of the stripes."""
    rows = spark.read.schema(_schema(id_type)).orc(path)
    return rows if only is None else rows.where(F.col("doc_id").isin(only))


def token_digest(rows: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of the rows of a token table.

    Only one sum per file is gathered for the starts.
    """
    sums = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("in_file"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = sums.select("file_no", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("before"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            ids = lists.values.to_numpy(zero_copy_only=False).view(np.uint32)
            bounds = lists.offsets.to_numpy()
            sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "file_no", "start_in_file", "n_tokens")), pa.array(sums, pa.int64())],
                ["doc_id", "file_no", "start_in_file", "n_tokens", "ids_crc32"],
            )

    kept = f"doc_id {type_of(rows, 'doc_id')}, file_no int, start_in_file bigint, n_tokens bigint, ids_crc32 bigint"
    # One row per file, and a writing task makes one file: small at any size of the texts.
    return (
        rows.mapInArrow(check, kept)
        .join(F.broadcast(files), "file_no")
        .select("doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")
    )
