"""Length-delimited binary records of token ids, with an offset index for shuffled reads.

File format, all integers little-endian::

    record := length u64 | masked crc32 of those 8 bytes u32 | payload | masked crc32 of the payload u32
    payload := width u8 (2 or 4 bytes an id) | ids

A mask keeps a checksum stored next to its data from looking like data
(rotate right by 15, add a constant). Files ``tokens-NNNNN.bin`` hold ascending,
disjoint ranges of ``doc_id``; the index is a Parquet table with file, offset
and length of every record.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlab.llm.common import chunks
from churnlab.llm.tokens import encoder

MASK = 0xA282EAD8
HEAD_BYTES, TAIL_BYTES = 12, 4
INDEX_SCHEMA = "doc_id long, file_no int, offset long, length long, token_start long, n_tokens long"
READ_SCHEMA = "doc_id long, file_no int, token_start long, n_tokens long, ids binary"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def unframe(record: bytes) -> bytes:
    """The payload; ``ValueError`` if a checksum or the length does not fit."""
    if len(record) < HEAD_BYTES + TAIL_BYTES:
        raise ValueError("record is cut off")
    size, crc = struct.unpack_from("<QI", record)
    if masked_crc(record[:8]) != crc or len(record) != HEAD_BYTES + size + TAIL_BYTES:
        raise ValueError("record length is damaged")
    payload = record[HEAD_BYTES:HEAD_BYTES + size]
    if masked_crc(payload) != struct.unpack_from("<I", record, HEAD_BYTES + size)[0]:
        raise ValueError("record payload is damaged")
    return payload


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark itself would read it under, so that tasks do not take it for their own disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """``uri`` is qualified; Hadoop writes local ones with a single slash."""
    return fs.FileSystem.from_uri(f"file://{uri[5:]}" if uri.startswith("file:/") and "://" not in uri else uri)


def file_name(file_no: int) -> str:
    return f"tokens-{file_no:05d}.bin"


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, keeps_space: bool = True,
                      docs_per_file: int = 100_000, bytes_per_file: int = 256_000_000) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write framed records in ascending ``doc_id`` order.

    ``folder`` is a path or URI that all executors reach. One range of ``doc_id``
    makes one file, as many as rows and bytes of text call for; a task writes under a name of its own and renames at the end, so
    a repeated task replaces the file by equal bytes. The index is written to
    ``folder/index`` and returned. Null doc_ids come first, null texts count as
    empty, repeated doc_ids follow each other in the order of their texts,
    an empty table makes an index without rows. Other columns of ``docs`` are not
    read.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    # Spark's own estimate of the bytes decides on the number of files only, a thousand documents each at least
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    by_bytes = min(-(-size // bytes_per_file), -(-n // 1000))
    parts = max(1, -(-n // docs_per_file), by_bytes, min(n, spark.sparkContext.defaultParallelism * 2))
    # a hot or null doc_id is split by its texts, by their beginnings so that the ranges are found without whole texts
    ordered = rows.repartitionByRange(parts, "doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer_path, keeps_space)
        end = np.asarray([end_id], f"<u{enc.width}").tobytes()
        width = bytes([enc.width])
        file_no = TaskContext.get().partitionId()
        store, base = _file_system(folder)
        store.create_dir(base, recursive=True)
        temporary = f"{base}/_{file_name(file_no)}.{uuid.uuid4().hex}"
        offset = tokens = 0
        with store.open_output_stream(temporary) as out:
            for batch in batches:
                texts = batch["text"].tolist()
                offsets, lengths, starts, counts = [], [], [], []
                for a, b in chunks(texts, 4_000_000):
                    records = [frame(width + ids + end) for ids in enc.encode(texts[a:b])]
                    out.write(b"".join(records))
                    for r in records:
                        count = (len(r) - HEAD_BYTES - TAIL_BYTES - 1) // enc.width
                        offsets.append(offset), lengths.append(len(r)), starts.append(tokens), counts.append(count)
                        offset, tokens = offset + len(r), tokens + count
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "file_no": file_no, "offset": offsets,
                                    "length": lengths, "token_start": starts, "n_tokens": counts})
        store.move(temporary, f"{base}/{file_name(file_no)}")

    ordered.mapInPandas(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def _payloads(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Each batch of index rows with the checked ids that its rows point to."""
    store, base = _file_system(folder)
    opened: dict[int, object] = {}
    try:
        for batch in batches:
            ids = []
            for file_no, offset, length in zip(batch["file_no"], batch["offset"], batch["length"]):
                if file_no not in opened:
                    if len(opened) >= 8:
                        opened.pop(next(iter(opened))).close()
                    opened[file_no] = store.open_input_file(f"{base}/{file_name(file_no)}")
                payload = unframe(opened[file_no].read_at(length, offset))
                ids.append(np.frombuffer(payload, f"<u{payload[0]}", offset=1).astype("<u4"))
            yield batch, ids
    finally:
        for f in opened.values():
            f.close()


def _spread(index: DataFrame) -> DataFrame:
    """Index rows dealt by place: a task reads about one file's worth of neighbouring records."""
    files = (index.agg(F.max("file_no")).first()[0] or 0) + 1
    return index.repartitionByRange(files, "file_no", "offset")


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of ``index`` point to, in any order or subset: ids as u32 bytes.

    Every frame is checked on the way; a damaged one fails the read.
    """

    folder = qualified(index.sparkSession, folder)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, ids in _payloads(batches, folder):
            yield batch[["doc_id", "file_no", "token_start", "n_tokens"]].assign(
                doc_id=batch["doc_id"].astype("Int64"), ids=[a.tobytes() for a in ids])

    return index.mapInPandas(read, READ_SCHEMA)


def file_starts(index: DataFrame) -> DataFrame:
    """(file_no, file_start): tokens in all files before; one row per file, so the running sum is short."""
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = index.groupBy("file_no").agg(F.sum("n_tokens").alias("_n"))
    return sums.select("file_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("file_start"))


def token_digests(index: DataFrame, folder: str) -> DataFrame:
    """Per record: doc_id, start (ids of all records before it), n_tokens, ids_crc32 over its u32 ids, as read back."""
    folder = qualified(index.sparkSession, folder)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, ids in _payloads(batches, folder):
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "file_no": batch["file_no"],
                                "token_start": batch["token_start"], "n_tokens": [len(a) for a in ids],
                                "ids_crc32": [zlib.crc32(a.tobytes()) for a in ids]})

    records = _spread(index).mapInPandas(
        read, "doc_id long, file_no int, token_start long, n_tokens long, ids_crc32 long")
    return records.join(file_starts(index), "file_no").select(
        "doc_id", (F.col("file_start") + F.col("token_start")).alias("start"), "n_tokens", "ids_crc32")
