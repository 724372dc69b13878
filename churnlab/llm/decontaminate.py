"""Benchmark decontamination: size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity but a high
containment |Q & X| / |Q|. The item's MinHash signature (the shingle of
smallest hash under each of K permutations) is a uniform sample of its
shingles, so each signature entry lies in the document with probability equal
to the containment (containment MinHash, Koslicki & Zabeti 2019). Items and
documents are partitioned by size (powers of two of the shingle count): a class
has its own K and its own least number of matches, and documents too small to
hold 0.8 of an item's shingles are never compared with it. Candidates are
verified by exact containment over the shingles' words.

An item of one to four words is a size class of its own per number of words: it
is one shingle of all its words, and documents are cut into shingles of that
many words to look for it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm.common import SHINGLE_WORDS, chunks, mix64, shingle_counts, text_key, words_of

THRESHOLD = 0.8
MISS = 1e-6  # chance that an item at the threshold falls short of its class's least number of matches
ITEM_BLOCK_BYTES = 32_000_000
MATCH_SCHEMA = "doc_id long, k1 long, k2 long, item_id long, containment double, n_shingles int"


def shingle_set(text: str, width: int = SHINGLE_WORDS) -> set[tuple[str, ...]]:
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}


def signature_size(size_class: int) -> int:
    """Permutations of a class: more for larger items, 16 to 64."""
    return int(min(64, 8 * max(2, size_class)))


def least_matches(k: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Largest m with P(Binomial(k, threshold) < m) <= ``miss``, at least 1."""
    below, m = 0.0, 0
    while m < k:
        below += math.comb(k, m) * threshold ** m * (1 - threshold) ** (k - m)
        if below > miss:
            break
        m += 1
    return max(1, m)


class ItemBlock:
    """Signatures and texts of a block of items of ``width`` words a shingle, made once on the driver and sent to the tasks."""

    def __init__(self, items: list[tuple[int, str]], threshold: float, width: int = SHINGLE_WORDS):
        self.threshold, self.width = threshold, width
        self.ids, self.texts, entries, owners, counts = [], [], [], [], []
        size, least = [], []
        for item_id, text in items:
            _, hashes, _ = shingle_counts([text], width)
            if not len(hashes):
                continue
            k = signature_size(int(math.log2(len(hashes))))
            smallest = [hashes[np.argmin(mix64(hashes ^ np.uint64(0xA5A5 + 7919 * j)))] for j in range(k)]
            entry, times = np.unique(np.asarray(smallest, np.uint64), return_counts=True)
            entries.append(entry)
            counts.append(times)
            owners.append(np.full(len(entry), len(self.ids)))
            self.ids.append(item_id)
            self.texts.append(text)
            size.append(len(hashes))
            least.append(least_matches(k, threshold))
        self.entries = np.concatenate(entries) if entries else np.zeros(0, np.uint64)
        self.owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        self.times = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        order = np.argsort(self.entries, kind="stable")
        self.entries, self.owners, self.times = self.entries[order], self.owners[order], self.times[order]
        self.size, self.least = np.asarray(size, np.int64), np.asarray(least, np.int64)
        bits = 1 << max(16, int(math.log2(len(self.entries) + 1)) + 6)
        self.mask = np.uint64(bits - 1)
        self.seen = np.zeros(bits, bool)
        self.seen[self.entries & self.mask] = True

    def candidates(self, texts: list[str]) -> list[tuple[int, int]]:
        """(document number, item number) with enough matches of the item's signature."""
        docs, hashes, _ = shingle_counts(texts, self.width)
        sizes = np.bincount(docs, minlength=len(texts))
        at = np.flatnonzero(self.seen[hashes & self.mask])
        low = np.searchsorted(self.entries, hashes[at], "left")
        many = np.searchsorted(self.entries, hashes[at], "right") - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        if not len(at):
            return []
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        doc, item = np.repeat(docs[at], many), self.owners[entry]
        fits = sizes[doc] >= self.threshold * self.size[item]
        pair, where = np.unique(doc[fits] * len(self.ids) + item[fits], return_inverse=True)
        matches = np.bincount(where, self.times[entry[fits]], len(pair))
        doc, item = pair // len(self.ids), pair % len(self.ids)
        enough = matches >= self.least[item]
        return list(zip(doc[enough].tolist(), item[enough].tolist()))

    def found(self, texts: list[str]) -> Iterator[tuple[int, int, float, int]]:
        """(document number, item_id, containment, shingles of the item) by the words themselves, of the candidates."""
        last, grams = -1, set()
        for doc, item in self.candidates(texts):
            if doc != last:
                last, grams = doc, shingle_set(texts[doc], self.width)
            wanted = shingle_set(self.texts[item], self.width)
            share = len(wanted & grams) / len(wanted)
            if share >= self.threshold:
                yield doc, self.ids[item], share, len(wanted)


def item_blocks(items: list[tuple[int, str]], threshold: float) -> list[ItemBlock]:
    """A block per number of words a shingle: items of five words and more, and those of four, three, two and one."""
    by_width: dict[int, list[tuple[int, str]]] = {}
    for item_id, text in items:
        words = len(words_of(text))
        if words:
            by_width.setdefault(min(words, SHINGLE_WORDS), []).append((item_id, text))
    return [ItemBlock(part, threshold, width) for width, part in sorted(by_width.items())]


def _search(docs: DataFrame, items: list[tuple[int, str]], threshold: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(item_blocks(items, threshold))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            found = [(a + doc, *rest) for a, b in chunks(texts) for block in sent.value for doc, *rest in block.found(texts[a:b])]
            out = batch[["doc_id", "k1", "k2"]].iloc[[f[0] for f in found]].reset_index(drop=True).astype("Int64")
            out["item_id"] = pd.array([f[1] for f in found], "Int64")
            out["containment"] = [f[2] for f in found]
            out["n_shingles"] = [f[3] for f in found]
            yield out.astype({"containment": "float64", "n_shingles": "int32"})

    return docs.mapInPandas(search, MATCH_SCHEMA)


def find_items(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, k1, k2, item_id, containment, n_shingles): items at least ``threshold`` contained in a document.

    k1 and k2 stand for the document's text (``text_key``). Items pass in blocks
    of at most ``ITEM_BLOCK_BYTES`` of text, each block against all documents in
    one map-only pass. Null and word-free texts match nothing; an item of fewer
    than five words is found wherever its words stand in a row, even inside a
    long document; texts of any length are searched whole; repeated documents are
    reported each; empty tables give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.where("text is not null").select("doc_id", "text", *text_key())
    items = benchmark.where("text is not null").select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // ITEM_BLOCK_BYTES)
    found = spark.createDataFrame([], MATCH_SCHEMA)
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text")
        found = found.unionByName(_search(rows, [tuple(r) for r in block.collect()], threshold))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns and clean rows stay as they are.

    Rows that agree in doc_id and text share their fate; null texts stay.
    """
    hit = find_items(docs, benchmark, threshold).select(
        F.col("doc_id").alias("_hit_id"), F.col("k1").alias("_hit_1"), F.col("k2").alias("_hit_2")).distinct()
    k1, k2 = text_key()
    return docs.join(hit, (docs["doc_id"].eqNullSafe(hit["_hit_id"])) & (k1 == hit["_hit_1"]) & (k2 == hit["_hit_2"]),
                     "left_anti")


def items_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")
