"""Near-duplicate documents by improved consistent weighted sampling (Ioffe, 2010).

A text is the weighted set of its five-word shingles, weight = occurrences x
idf. The document frequencies are counted over all documents in a hashed table
of fixed width (feature hashing), so the table is as large for any corpus. Each
sample of a text is one (shingle, level) pair; two texts agree in a sample with
probability equal to their weighted Jaccard similarity. Three samples make a
band; texts that share a band are candidates, and candidates are verified by
their exact weighted Jaccard similarity.

Candidates of a band are compared in two passes. First every member meets its
band's leader, which joins real groups at a cost linear in their size. The
leader is the most central member, the one that shares most bands with others,
as the original of many edited copies does. Then, only in bands whose members
are still in different classes, the members outside the band's largest class
meet the members of other classes: blocks of bounded size are dealt out, each
task compares two blocks by a sparse matrix product and gives no more links
than join their members. No link between different classes is left out, and no
pair that does not link is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import chunks, mix64, shingle_counts, store, text_key, unused
from churnlab.llm.graph import components

THRESHOLD = 0.8
BANDS, ROWS = 20, 3  # a pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 3) ** 20 = 6e-7
IDF_BITS = 18
BLOCK = 256  # documents of a block
FEATURES_AT_ONCE = 4096  # columns of the dense slices that a pair of blocks is compared by
_U = np.uint64


def idf_slots(hashes: np.ndarray) -> np.ndarray:
    return (mix64(hashes) >> _U(64 - IDF_BITS)).astype(np.int64)


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf per slot of the hashed frequency table: 1 + ln(N / df) / ln(2 ** IDF_BITS), 1 to 2.

    df of a slot is the number of documents with a shingle in it. Every task
    sends its counts in packed chunks, equal chunks are added up on the way, and
    the driver gets one packed row per chunk.
    """
    size, chunk = 1 << IDF_BITS, 1 << 12

    def packed(at: int, counts: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"chunk": [at], "counts": [counts.astype("<i8").tobytes()]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(size, np.int64), 0
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in chunks(texts):
                docs, hashes, _ = shingle_counts(texts[a:b])
                keys = np.unique((docs << IDF_BITS) | idf_slots(hashes))
                seen += np.bincount(keys & (size - 1), minlength=size)
            n += len(texts)
        parts = seen.reshape(-1, chunk)
        for at in np.flatnonzero(parts.any(axis=1)).tolist():
            yield packed(at, parts[at])
        yield packed(-1, np.asarray([n]))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in batch.itertuples(index=False):
                sums[at] = sums.get(at, 0) + np.frombuffer(counts, "<i8")
        for at, counts in sums.items():
            yield packed(at, counts)

    kind = "chunk int, counts binary"
    counted = docs.where("text is not null").select("text").mapInPandas(count, kind).repartition("chunk").mapInPandas(add, kind)
    total, df = 0, np.ones(size)
    for at, counts in counted.collect():
        counts = np.frombuffer(counts, "<i8")
        if at < 0:
            total = int(counts[0])
        else:
            df[at * chunk:(at + 1) * chunk] = np.maximum(counts, 1)
    return (1 + np.log(np.maximum(total / df, 1)) / np.log(2.0 ** IDF_BITS)).astype(np.float32)


def weighted_shingles(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, hash, weight) sorted by document and hash."""
    docs, hashes, tf = shingle_counts(texts)
    return docs, hashes, tf.astype(np.float32) * idf[idf_slots(hashes)]


def consistent_samples(docs: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_docs: int,
                       samples: int = BANDS * ROWS) -> np.ndarray:
    """(documents, samples) 64-bit marks of the drawn (shingle, level); rows of documents without shingles are 0.

    Per sample each shingle has r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its
    hash alone: level t = floor(ln w / r + b), and the shingle of smallest
    ln c - r (t - b) - r is drawn.
    """
    out = np.zeros((n_docs, samples), _U)
    if not len(docs):
        return out
    starts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    sizes = np.diff(np.append(starts, len(docs)))
    log_w = np.log(weights)
    scale, half = np.float32(2.0 ** -24), np.float32(2.0 ** -25)
    low24 = _U(0xFFFFFF)
    for k in range(samples):
        z1 = mix64(hashes + _U((2 * k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        z2 = mix64(z1 + _U(0xD1B54A32D192ED03))
        u = [(x.astype(np.float32) * scale + half) for x in (
            z1 >> _U(40), (z1 >> _U(16)) & low24, z2 >> _U(40), (z2 >> _U(16)) & low24)]
        b = (((z1 & _U(0xFFFF)) << _U(8)) | (z2 & _U(0xFF))).astype(np.float32) * scale
        r = -np.log(u[0] * u[1])
        level = np.floor(log_w / r + b)
        rank = np.log(-np.log(u[2] * u[3])) - r * (level - b) - r
        least = np.minimum.reduceat(rank, starts)
        at = np.flatnonzero(rank == np.repeat(least, sizes))
        at = at[np.concatenate([[True], docs[at[1:]] != docs[at[:-1]]])]
        out[docs[at], k] = mix64(hashes[at] + level[at].astype(np.int64).astype(_U) * _U(0xA24BAED4963EE407))
    return out


def band_keys(marks: np.ndarray) -> np.ndarray:
    """(documents, BANDS) keys; a band's number is part of its key."""
    keys = np.zeros((len(marks), BANDS), _U)
    for band in range(BANDS):
        h = np.full(len(marks), band + 1, _U)
        for row in range(ROWS):
            h = mix64(h ^ marks[:, band * ROWS + row])
        keys[:, band] = h
    return keys


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller weights over sum of larger ones; (sorted hashes, weights) each; 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).astype(np.float64).sum())
    total = float(a[1].astype(np.float64).sum() + b[1].astype(np.float64).sum()) - both
    return both / total if total else 0.0


def signatures(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """(doc_id, k1, k2, bands) of all non-null texts, map-only; texts without a shingle have no bands. ``sent`` is the idf table."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, bands = batch["text"].tolist(), []
            for a, b in chunks(texts):
                at, hashes, weights = weighted_shingles(texts[a:b], sent.value)
                keys = band_keys(consistent_samples(at, hashes, weights, b - a)).view(np.int64)
                some = np.bincount(at, minlength=b - a) > 0
                bands += [k if s else k[:0] for k, s in zip(keys, some)]
            yield batch[["doc_id", "k1", "k2"]].astype({"doc_id": "Int64"}).assign(bands=bands)

    return docs.where("text is not null").select("doc_id", "text", *text_key()).mapInPandas(
        sign, "doc_id long, k1 long, k2 long, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, sent: Broadcast, threshold: float) -> DataFrame:
    """The rows of ``pairs`` (u, v) whose texts are at least ``threshold`` similar."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            left, right = batch["text_u"].tolist(), batch["text_v"].tolist()
            for a, b in chunks(left, 200_000):
                distinct = sorted(set(left[a:b]) | set(right[a:b]))
                place = {t: i for i, t in enumerate(distinct)}
                sets = []
                for c, d in chunks(distinct):
                    at, hashes, weights = weighted_shingles(distinct[c:d], sent.value)
                    cut = np.searchsorted(at, np.arange(d - c + 1))
                    sets += [(hashes[cut[i]:cut[i + 1]], weights[cut[i]:cut[i + 1]]) for i in range(d - c)]
                for i in range(a, b):
                    keep[i] = weighted_jaccard(sets[place[left[i]]], sets[place[right[i]]]) >= threshold
            yield batch.loc[keep, ["u", "v"]]

    both = (pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
            .join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v"))
    return both.select("u", "v", "text_u", "text_v").mapInPandas(verify, "u long, v long")


def _open_links(still: DataFrame, texts: DataFrame, sent: Broadcast, threshold: float) -> DataFrame:
    """Links (u, v) of classes, by their names, within the bands of ``still`` (band, node, component).

    Per band, members outside the largest class are dealt into blocks, all
    members likewise, and a task gets one block of either kind.
    """
    sizes = still.groupBy("band", "component").agg(F.count("*").alias("n"))
    bands = sizes.groupBy("band").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
    bands = bands.select("band", F.col("top.component").alias("largest"),
                         F.ceil(F.col("all") / BLOCK).cast("int").alias("n_all"),
                         F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("n_out"))
    rows = still.join(bands, "band")
    block = lambda n: F.pmod(F.xxhash64(F.lit("block"), "node"), F.col(n)).cast("int")
    count = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    out = rows.where("component <> largest").select("band", block("n_out").alias("i"), count("n_all").alias("j"),
                                                    F.lit(True).alias("out"), "node", "component")
    every = rows.select("band", count("n_out").alias("i"), block("n_all").alias("j"), F.lit(False).alias("out"), "node", "component")
    dealt = out.unionByName(every).join(texts, "node")
    dealt = dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None
        for batch in batches:
            batch = batch if left is None else pd.concat([left, batch])
            key = batch[["band", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if len(cuts):
                links = [x for a, b in zip(np.append(0, cuts[:-1]), cuts) for x in block_links(batch.iloc[a:b], sent.value, threshold)]
                yield pd.DataFrame(links, columns=["u", "v"], dtype="int64")
            left = batch.iloc[cuts[-1]:] if len(cuts) else batch
        if left is not None and len(left):
            yield pd.DataFrame(block_links(left, sent.value, threshold), columns=["u", "v"], dtype="int64")

    return dealt.mapInPandas(compare, "u long, v long").distinct()


def block_links(rows: pd.DataFrame, idf: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """A spanning set of the linked pairs of classes in one pair of blocks (columns out, node, component, text)."""
    one = rows.drop_duplicates("node")
    nodes, texts = one["node"].to_numpy(), one["text"].tolist()
    place = {n: i for i, n in enumerate(nodes.tolist())}
    parts, at = [], 0
    for a, b in chunks(texts):
        docs, hashes, tf = shingle_counts(texts[a:b])
        # a shingle that occurs n times is n features of its idf each, so that shared features sum to the smaller weight
        level = np.arange(tf.sum()) - np.repeat(np.cumsum(tf) - tf, tf)
        feature = np.repeat(hashes, tf) ^ (mix64(level.astype(_U)) * (level > 0).astype(_U))
        parts.append((np.repeat(docs + at, tf), feature, np.repeat(idf[idf_slots(hashes)], tf).astype(np.float64)))
        at += b - a
    owner, feature, weight = (np.concatenate(x) for x in zip(*parts))
    total = np.bincount(owner, weight, len(nodes))
    distinct, column, times = np.unique(feature, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column, weight = owner[shared], column[shared], weight[shared]
    order = np.argsort(column, kind="stable")
    owner, column, weight = owner[order], column[order], weight[order]
    mine = np.asarray([place[n] for n in rows.loc[rows["out"], "node"].tolist()], np.int64)
    theirs = np.asarray([place[n] for n in rows.loc[~rows["out"], "node"].tolist()], np.int64)
    both = np.zeros((len(mine), len(theirs)))
    steps = np.flatnonzero(np.diff(column)) + 1
    for a in range(0, len(steps) + 1, FEATURES_AT_ONCE):
        low = steps[a - 1] if a else 0
        high = steps[a + FEATURES_AT_ONCE - 1] if a + FEATURES_AT_ONCE - 1 < len(steps) else len(column)
        if low == high:
            continue
        c = np.cumsum(np.append(0, np.diff(column[low:high]) > 0))
        dense = np.zeros((len(nodes), c[-1] + 1))
        dense[owner[low:high], c] = weight[low:high]
        both += dense[mine] @ (dense[theirs] > 0).T
    similar = both >= threshold * (total[mine][:, None] + total[theirs][None] - both) - 1e-9
    component = one["component"].to_numpy()
    found, root = [], {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in np.argwhere(similar & (component[mine][:, None] != component[theirs][None])):
        a, b = find(int(component[mine[i]])), find(int(component[theirs[j]]))
        if a != b:
            root[a] = b
            found.append((int(component[mine[i]]), int(component[theirs[j]])))
    return found


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, k1, k2, class_id, stays, copies): one row per distinct (doc_id, text); null texts are left out.

    Texts are the nodes, so null and repeated doc_ids do no harm; texts of any
    length are compared whole. ``class_id`` is the smallest doc_id (null if all are)
    among the texts linked to this one, directly or over others; ``stays`` marks
    one row of each class, that of the smallest doc_id and text key; ``copies``
    counts the rows with this doc_id and text. Texts without a word link only to
    equal texts. An empty table gives an empty result; other columns are not
    read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(idf_table(docs))
    signed = store(signatures(docs, sent), "signatures")
    signed, nodes = _nodes(signed)
    rows = store(nodes.select("node", F.explode("bands").alias("band")), "bands")

    shared = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = store(rows.join(shared, "band"), "members")
    central = members.groupBy("node").agg(F.sum("n").alias("met"))
    leaders = store(members.select("band", "node").join(central, "node").groupBy("band").agg(
        F.max(F.struct("met", "node"))["node"].alias("u")), "leaders")
    members = members.select("band", "node")
    near_leader = members.join(leaders, "band").where("node <> u").select("u", F.col("node").alias("v")).distinct()
    near_leader = store(near_leader, "leader-pairs")
    texts = _candidate_texts(docs, nodes, near_leader)
    links = store(_verified(near_leader, texts, sent, threshold), "leader-links")

    # the members of bands that still hold several classes
    classes = store(components(links), "classes")
    placed = members.join(classes, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    open_bands = placed.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where(
        "a <> b").select("band")
    still = store(placed.join(open_bands, "band", "left_semi"), "open-bands")
    more = store(_open_links(still, texts, sent, threshold), "class-links")
    sent.destroy()
    joined = classes
    if not more.isEmpty():
        # links between classes merge whole classes, so only the classes' names go through another run
        merged = store(components(more), "merged-classes").select(F.col("node").alias("name"), F.col("component").alias("whole"))
        known = classes.join(merged, F.col("component") == F.col("name"), "left").select(
            "node", F.coalesce("whole", "component").alias("component"))
        alone = merged.join(classes, F.col("name") == F.col("node"), "left_anti").select(
            F.col("name").alias("node"), F.col("whole").alias("component"))
        joined = store(known.unionByName(alone), "joined-classes")

    named = (signed.groupBy("doc_id", "k1", "k2", "node").agg(F.count("*").alias("copies"))
             .join(joined, "node", "left")
             .select("doc_id", "k1", "k2", "copies", F.coalesce("component", "node").alias("component")))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    first = named.groupBy("component").agg(F.min(row).alias("first"))
    return named.join(first, "component").select(
        "doc_id", "k1", "k2", F.col("first.doc_id").alias("class_id"), row.eqNullSafe(F.col("first")).alias("stays"), "copies")


def _nodes(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``signed`` with ``node``, and one row per text (node, k1, k2, rep, bands); every copy has its text's bands.

    A text's node is the first 64 bits of its key. Where different texts share
    these, which their other 64 bits show, all but one get another node.
    """
    signed = signed.withColumn("node", F.col("k1"))

    def of(signed: DataFrame, k2) -> DataFrame:
        return signed.groupBy("node").agg(F.min("k1").alias("k1"), F.min("k2").alias("k2"), k2.alias("last"), F.min("doc_id").alias("rep"),
                                          F.min("bands").alias("bands"))

    nodes = store(of(signed, F.max("k2")), "texts")
    shared = nodes.where("k2 <> last").select(F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    if not shared.isEmpty():
        signed = signed.join(shared, F.col("k1") == F.col("s1"), "left").withColumn("node", F.when(
            F.col("k2") != F.col("s2"), F.xxhash64(F.lit("another"), "k1", "k2")).otherwise(F.col("k1"))).drop("s1", "s2")
        nodes = store(of(signed, F.max("k2")), "texts")
    return signed, nodes


def _candidate_texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the texts that have a candidate: one row per text, stored."""
    wanted = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    keys = nodes.join(wanted, "node", "left_semi").select("node", F.col("k1").alias("n1"), F.col("k2").alias("n2"), "rep")
    own = docs.where("text is not null").select("doc_id", "text", *text_key())
    found = own.join(keys, (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    return store(found.groupBy("node").agg(F.first("text").alias("text")), "candidate-texts")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class; all columns stay.

    Null texts stay. Of rows that agree in doc_id and text one stays.
    """
    found = store(near_duplicates(docs, threshold), "near-duplicates")
    n1, n2, g0, g1, g2 = unused(docs, "_n1", "_n2", "_g0", "_g1", "_g2")
    k1, k2 = text_key()
    keyed = docs.withColumns({n1: k1, n2: k2})

    def those(rows: DataFrame, how: str) -> DataFrame:
        rows = rows.select(F.col("doc_id").alias(g0), F.col("k1").alias(g1), F.col("k2").alias(g2))
        return keyed.join(rows, F.col("doc_id").eqNullSafe(F.col(g0)) & (F.col(n1) == F.col(g1)) & (F.col(n2) == F.col(g2)), how)

    single = those(found.where("not stays or copies > 1"), "left_anti")
    one = those(found.where("stays and copies > 1"), "left_semi").dropDuplicates(["doc_id", n1, n2])
    return single.unionByName(one).select(*docs.columns)
