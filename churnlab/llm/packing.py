"""Harmonic packing of token sequences (Lee & Lee, 1985) with cuts.

Lengths fall into reciprocal classes: class k holds lengths in
(capacity/(k+1), capacity/k], and a bin of class k takes exactly k pieces. Each
worker fills the bins of its own pieces. A document is cut at class bounds
first, so that most pieces fill their share of a bin to the last token or two:
a length above ``capacity`` gives whole bins, and the rest gives a piece of
exactly ``capacity // (k + 1)`` while its class k is below ``whole_from``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import chunks, store
from churnlab.llm.tokens import encoder

CAPACITY = 4096
WHOLE_FROM = 16
PIECES_PER_WORKER = 500_000
MERGED, LAST_LEVEL = 64, 7  # workers whose leftovers meet on the next level; the number of the first-fit level
PIECE_SCHEMA = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def cut_lengths(length: int, capacity: int = CAPACITY, whole_from: int = WHOLE_FROM) -> list[int]:
    """Piece lengths of a document, in order."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        share = capacity // (k + 1)
        piece = rest if k >= whole_from or rest * k >= capacity - k or not share else share
        out.append(piece)
        rest -= piece
    return out


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, keeps_space: bool = False, with_ids: bool = False,
                 capacity: int = CAPACITY, whole_from: int = WHOLE_FROM) -> DataFrame:
    """Map-only: every whole text's ids and ``end_id``, cut; one row per piece (``ids`` as u32 bytes on demand).

    A null text counts as empty and gives the end id alone.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer_path, keeps_space)
        end = np.asarray([end_id], f"<u{enc.width}").tobytes()
        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["doc_id"].astype("Int64")
            for a, b in chunks([t or "" for t in texts], 4_000_000):
                rows, at = [], []
                for i, ids in enumerate(enc.encode(texts[a:b]), a):
                    data = np.frombuffer(ids + end, f"<u{enc.width}").astype("<u4").tobytes()
                    start, total = 0, len(data) // 4
                    for n in cut_lengths(total, capacity, whole_from):
                        piece = data[start * 4:(start + n) * 4]
                        rows.append((start, n, zlib.crc32(piece), total, *([piece] if with_ids else [])))
                        at.append(i)
                        start += n
                frame = pd.DataFrame(rows, columns=["start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids])
                frame.insert(0, "doc_id", keys.iloc[at].reset_index(drop=True))
                yield frame

    return docs.select("doc_id", "text").mapInPandas(cut, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def _fill(pieces: DataFrame, workers: Column, level: int, capacity: int) -> tuple[DataFrame, DataFrame]:
    """Bins of k pieces per (worker, class k), and the fewer than k pieces that are left of each."""
    dealt = pieces.withColumns({"_k": F.floor(F.lit(capacity) / F.col("length")).cast("int"), "_w": workers})
    own = Window.partitionBy("_k", "_w")
    order = ["length", "doc_id", "start", "ids_crc32"]
    ranked = dealt.withColumns({
        "_rank": F.row_number().over(own.orderBy(*[F.col(c).desc() for c in order])) - 1,
        "_count": F.count("*").over(own)})
    ranked = ranked.withColumns({"_bin": F.floor(F.col("_rank") / F.col("_k")).cast("long"),
                                 "_full": F.col("_rank") < F.col("_count") - F.col("_count") % F.col("_k")})
    inside = Window.partitionBy("_k", "_w", "_bin").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.where("_full").select(
        *pieces.columns, F.struct(F.lit(level).alias("level"), "_w", "_k", "_bin").alias("_seq"),
        F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"))
    return placed, ranked.where("not _full").select(*pieces.columns)


def _last_bins(pieces: DataFrame, capacity: int) -> DataFrame:
    """First-fit decreasing over what no class could fill: fewer than k pieces of each class k, however large the input."""
    columns = pieces.columns

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        room = np.full(0, capacity, np.int64)
        bins, offsets = [], []
        for n in rows["length"].to_numpy():
            fits = np.flatnonzero(room >= n)
            if not len(fits):
                room = np.append(room, capacity)
                fits = [len(room) - 1]
            b = fits[0]
            bins.append(b)
            offsets.append(capacity - room[b])
            room[b] -= n
        out = rows[columns].copy()
        out["_bin"], out["offset"] = bins, offsets
        return out.astype({"doc_id": "Int64"})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    placed = pieces.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(fit, f"{schema}, _bin long, offset long")
    return placed.select(*columns, F.struct(F.lit(LAST_LEVEL).alias("level"), F.lit(0).alias("_w"), F.lit(0).alias("_k"),
                                            "_bin").alias("_seq"), "offset")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence).

    Workers are hashes of (doc_id, start), as many as hold ``PIECES_PER_WORKER``
    pieces each. What the classes of 64 workers leave goes to one worker of the
    next level, until one is left, and the rest of that (a number of pieces that
    depends on ``capacity`` alone) is packed by first-fit decreasing. No worker of
    a later level gets more than 64 times k - 1 pieces of class k. Lengths must be 1 to
    ``capacity``; repeated rows are packed each; an empty table gives no rows.
    """
    workers = max(1, -(-pieces.count() // PIECES_PER_WORKER))
    hashed = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(workers))
    placed, left, level = None, pieces, 0
    while True:
        filled, left = _fill(left, F.floor(hashed / MERGED ** level).cast("int"), level, capacity)
        placed = filled if placed is None else placed.unionByName(filled)
        if workers <= MERGED ** level:
            break
        left, level = store(left, "left-pieces"), level + 1
    placed = placed.unionByName(_last_bins(left, capacity))
    # level, worker, class and bin side by side in one number: 3 + 20 + 13 + 27 bits
    seq = [F.col(f"_seq.{c}").cast("long") for c in ("level", "_w", "_k", "_bin")]
    number = ((seq[0] * (1 << 20) + seq[1]) * (1 << 13) + seq[2]) * (1 << 27) + seq[3]
    return placed.withColumn("sequence_id", number).drop("_seq")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, keeps_space: bool = False,
                   with_ids: bool = False, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack ``docs`` (doc_id, text): one row per piece.

    The pieces are written to the shared folder before they are dealt out, so
    each text is tokenized once.
    """
    pieces = store(token_pieces(docs, tokenizer_path, end_id, keeps_space, with_ids, capacity), "pieces")
    return pack(pieces, capacity)
