"""Words, five-word shingles and storage helpers shared by the operators of this subpackage.

A *word* is a maximal run of letters and digits of the lower-cased text, i.e.
``re.findall(r"[^\\W_]+", text.lower())``. A *shingle* is five words in a row; a
text of one to four words has one shingle of all its words; a text without a
word has none.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.session import ensure_checkpoint_dir

WORD_RE = re.compile(r"[^\W_]+")
SHINGLE_WORDS = 5
HASH_BITS = 52  # the other 12 bits of a sort key number the documents of a chunk
MAX_CHUNK_DOCS = 1 << (64 - HASH_BITS)
CHUNK_BYTES = 400_000
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000

_NON_ASCII_GAP = re.compile(r"[^\x00-\x7f\w]")
_TO_SPACE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_U = np.uint64
_MUL1, _MUL2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def words_of(text: str) -> list[str]:
    return WORD_RE.findall(text.lower())


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and shift-xor, twice)."""
    x = (x ^ (x >> _U(32))) * _MUL2
    x = (x ^ (x >> _U(29))) * _MUL1
    return x ^ (x >> _U(32))


def spaced_bytes(text: str) -> bytes:
    """Lower-cased UTF-8 with every character outside words turned into spaces."""
    text = text.lower()
    if not text.isascii():
        text = _NON_ASCII_GAP.sub(" ", text)
    return text.encode("utf-8", "surrogatepass").translate(_TO_SPACE)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, 64-bit hash) of every word of every text, in order."""
    return word_table(texts)[:2]


def word_table(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document number, 64-bit hash, first eight bytes, length in bytes) of every word of every text, in order."""
    parts = [spaced_bytes(t) for t in texts]
    buf = b" " + b" ".join(parts) + b" " * 9
    raw = np.frombuffer(buf, np.uint8)
    gap = raw == 32
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    first = np.cumsum([1] + [len(p) + 1 for p in parts[:-1]]) if parts else np.zeros(0, np.int64)
    docs = np.searchsorted(first, starts, side="right") - 1
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    size = ends - starts
    h = size.astype(_U) * _MUL1
    at, left, live, heads = starts, size, None, np.zeros(0, _U)
    while len(at):
        take = np.minimum(left, 8).astype(_U)
        piece = eight[at] & (~_U(0) >> (_U(64) - take * _U(8)))
        if live is None:
            heads = piece
            h = mix64(h ^ piece)
        else:
            h[live] = mix64(h[live] ^ piece)
        keep = np.flatnonzero(left > 8)
        live = keep if live is None else live[keep]
        at, left = at[keep] + 8, left[keep] - 8
    return docs, h, heads, size


def shingle_hashes(texts: list[str], width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document number, 52-bit hash) of every shingle, by document; repeats are kept."""
    docs, words = word_hashes(texts)
    counts = np.bincount(docs, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(texts) else counts
    n = len(words) - width + 1
    out_d, out_h = [], []
    if n > 0:
        same = docs[:n] == docs[width - 1:]
        out_d.append(docs[:n][same])
        out_h.append(_fold([words[j:j + n][same] for j in range(width)]))
    for k in range(1, width):
        short = np.flatnonzero(counts == k)
        if len(short):
            out_d.append(short)
            out_h.append(_fold([words[first[short] + j] for j in range(k)]))
    if not out_d:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(out_d), np.concatenate(out_h)


def _fold(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), len(columns), _U)
    for c in columns:
        h = mix64(h * _MUL1 + c)
    return h >> _U(64 - HASH_BITS)


def shingle_counts(texts: list[str], width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, hash, occurrences) of the distinct shingles, sorted by document and hash."""
    docs, h = shingle_hashes(texts, width)
    if not len(h):
        return docs, h, np.zeros(0, np.int64)
    keys = np.sort((docs.astype(_U) << _U(HASH_BITS)) | h)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    tf = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    return (keys >> _U(HASH_BITS)).astype(np.int64), keys & _U((1 << HASH_BITS) - 1), tf


def chunks(texts: list[str], max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` of text, so that working arrays stay in cache."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= max_bytes or i - at + 1 >= MAX_CHUNK_DOCS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def text_key() -> tuple[Column, Column]:
    """128 bits that stand for a text; null texts have null keys."""
    text = F.col("text")
    none = text.isNull()
    return (F.when(~none, F.xxhash64(text)).alias("k1"),
            F.when(~none, F.xxhash64(F.lit("second"), text)).alias("k2"))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``docs`` does not have."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder of the shared checkpoint folder and read it again.

    The plan behind it ends here; the files outlive executors, and column
    pruning and filters still reach them. Whole texts go to Python workers in
    batches of ``BATCH_ROWS`` rows, which bounds what worker and JVM hold.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    rows = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(min(int(rows), BATCH_ROWS) if int(rows) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, rows)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


HOT_GROUPS = 4096


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """``rows`` inner-joined with ``groups`` (one row per key), large groups apart from the others.

    ``groups`` tells in ``size`` how many of the ``total`` rows a key has. Keys
    with at least 1/4096 of all rows, so no more than 4,096 of them, are
    broadcast and their rows stay where they are; the others meet by a shuffle
    in which no key is large. Null keys match nothing.
    """
    least = max(1, -(-total // HOT_GROUPS))
    hot, rest = groups.where(F.col(size) >= least), groups.where(F.col(size) < least)
    near = rows.join(F.broadcast(hot), on)
    far = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(rest, on)
    return near.unionByName(far)
