"""The trie of conversation prefixes: count-min screening, then exact grouping of what may be shared.

A node is a distinct sequence of first turns. A prefix's digest is the XOR of
two 64-bit hashes of (position, turn), so it is a running aggregate and a long
conversation can be cut into blocks. A count-min sketch over all prefix digests
never counts too little: where its estimate is one, the prefix belongs to one
conversation, and that node is emitted where it lies, with no shuffle. Only
prefixes that may be shared are grouped exactly.

Sums over subtrees need no walk through the tree. A node is credited to its
smallest member, which is a member of all nodes above as well. So a subtree's
sum is that of its members' credits, taken from the node's depth down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import join_groups, mix64, store

FAMILY, HEADS = 100, 6  # a conversation takes up to HEADS - 1 first turns of the first conversation of its hundred
SKETCH_ROWS, MIN_BITS, MAX_BITS = 3, 14, 24  # counters a row: 2 ** bits, at most 2 ** MAX_BITS
CHUNK_BITS = 14  # counters that travel as one row
IDS_BITS = 8  # ids of a node's ends that are joined at once: 2 ** IDS_BITS
DEPTH_BLOCK = 1024
NODE = ["depth", "d1", "d2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_U = np.uint64


# ---------------------------------------------------------------- conversations

def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, chars): a turn stands by 128 bits of its role and text; null role and text are empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.md5(key)).alias("mark"),
        F.char_length(text).cast("long").alias("chars"))


def numbered_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, block, pos, mark, chars, heads, skip, n_turns), conversations).

    ``pos`` numbers a conversation's turns from 0 by turn (null first), then
    mark. Turns are dealt in ranges, so a long conversation is many blocks;
    blocks are counted and their counts added up. ``conversations`` has one row
    per conversation: conv_id, base, skip (own turns that are replaced), heads
    (turns taken from its base), n_turns (after both).
    """
    order = [F.col("turn").asc_nulls_first(), F.col("mark")]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = store(turns.repartitionByRange(parts, "conv_id", *order).withColumn("block", F.spark_partition_id()), "turns")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    own = blocks.groupBy("conv_id").agg(F.sum("n").alias("own")).withColumns({
        "skip": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS,
        "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    first = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = own.join(first, "base", "left").withColumn("heads", F.least("skip", F.coalesce("base_own", F.lit(0))))
    convs = store(convs.select("conv_id", "base", "skip", "heads", (F.col("heads") + F.greatest(
        F.col("own") - F.col("skip"), F.lit(0))).alias("n_turns")), "conversations")
    blocks = blocks.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).join(convs, "conv_id").drop("n", "base")
    inside = Window.partitionBy("conv_id", "block").orderBy(*order)
    rows = dealt.join(blocks, ["conv_id", "block"]).withColumn("pos", F.col("start") + F.row_number().over(inside) - 1)
    return store(rows.drop("turn", "start"), "numbered-turns"), convs


def rebuilt_turns(numbered: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, block, pos, mark, chars, last): the turns of every rebuilt conversation, its heads in block -1."""
    own = numbered.where("pos >= skip").withColumn("pos", F.col("pos") - F.col("skip") + F.col("heads"))
    heads = numbered.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1)).select(
        F.col("conv_id").alias("base"), "pos", "mark", "chars")
    heads = heads.join(convs, "base").where("pos < skip").withColumn("block", F.lit(-1))
    names = ["conv_id", "block", "pos", "mark", "chars", (F.col("pos") + 1 == F.col("n_turns")).alias("last")]
    return own.select(*names).unionByName(heads.select(*names))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, d1, d2, u1, u2, chars, last): every prefix by its digest and that of the prefix above."""
    turns = turns.withColumns({f"z{k}": F.xxhash64(F.lit(k), F.col("pos").cast("long"), "mark") for k in (1, 2)})
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"))
    blocks = blocks.select("conv_id", "block", *[
        F.coalesce(F.bit_xor(f"x{k}").over(before), F.lit(0)).cast("long").alias(f"b{k}") for k in (1, 2)])
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = turns.join(blocks, ["conv_id", "block"])
    digest = {f"d{k}": F.col(f"b{k}").bitwiseXOR(F.bit_xor(f"z{k}").over(inside)) for k in (1, 2)}
    return rows.withColumns(digest).select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "d1", "d2", F.col("d1").bitwiseXOR(F.col("z1")).alias("u1"),
        F.col("d2").bitwiseXOR(F.col("z2")).alias("u2"), "chars", "last")


# ---------------------------------------------------------------- screening

def sketch_cells(d1: np.ndarray, d2: np.ndarray, bits: int) -> np.ndarray:
    """(SKETCH_ROWS, digests) places in the rows of the sketch laid end to end."""
    a, b = mix64(d1.astype(np.int64).view(_U)), mix64(d2.astype(np.int64).view(_U)) | _U(1)
    return np.stack([((a + _U(r) * b) >> _U(64 - bits)).astype(np.int64) + (r << bits) for r in range(SKETCH_ROWS)])


def shared_cells(prefix_rows: DataFrame, bits: int) -> np.ndarray:
    """The count-min sketch of all prefix digests, as a bit per counter: whether it counts more than one.

    Counters stop at 2, which is all the screening asks. A task sends its
    counters in packed chunks, equal chunks of all tasks are added up, and the
    driver gets the bits: SKETCH_ROWS * 2 ** bits of them, whatever the input.
    """
    size, chunk = SKETCH_ROWS << bits, 1 << CHUNK_BITS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(size, np.uint8)
        for batch in batches:
            cells, times = np.unique(sketch_cells(batch["d1"].to_numpy(), batch["d2"].to_numpy(), bits), return_counts=True)
            seen[cells] = np.minimum(seen[cells] + np.minimum(times, 2), 2)
        parts = seen.reshape(-1, chunk)
        for at in np.flatnonzero(parts.any(axis=1)):
            yield pd.DataFrame({"chunk": [at], "once": [np.packbits(parts[at] == 1).tobytes()],
                                "more": [np.packbits(parts[at] == 2).tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for at, once, more in batch.itertuples(index=False):
                once, more = np.frombuffer(once, np.uint8), np.frombuffer(more, np.uint8)
                if at in sums:
                    before, many = sums[at]
                    once, more = before | once, many | more | (before & once)
                sums[at] = once, more
        for at, (_, more) in sums.items():
            yield pd.DataFrame({"chunk": [at], "more": [more.tobytes()]})

    counted = prefix_rows.select("d1", "d2").mapInPandas(count, "chunk long, once binary, more binary")
    found = counted.repartition("chunk").mapInPandas(add, "chunk long, more binary").collect()
    out = np.zeros(size, bool)
    for at, more in found:
        out[at * chunk:(at + 1) * chunk] = np.unpackbits(np.frombuffer(more, np.uint8))
    return out


def screened(prefix_rows: DataFrame, bits: int | None = None) -> DataFrame:
    """``prefix_rows`` with ``shared`` and ``up_shared``: whether the prefix, and the one above it, may be shared."""
    if bits is None:
        bits = min(MAX_BITS, max(MIN_BITS, int(prefix_rows.count()).bit_length() + 2))
    sent = prefix_rows.sparkSession.sparkContext.broadcast(np.packbits(shared_cells(prefix_rows, bits)))

    @F.pandas_udf("boolean")
    def may_be_shared(d1: pd.Series, d2: pd.Series) -> pd.Series:
        cells = sketch_cells(d1.to_numpy(), d2.to_numpy(), bits)
        return pd.Series((sent.value[cells >> 3] >> (7 - (cells & 7)) & 1).all(axis=0))

    return prefix_rows.withColumns({"shared": may_be_shared("d1", "d2"),
                                    "up_shared": (F.col("depth") == 1) | may_be_shared("u1", "u2")})


# ---------------------------------------------------------------- the trie

def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, d1, d2, sha): SHA-256 of each node's ends (conv_id), in order and comma-joined.

    Ids are joined in blocks of neighbouring ids, and a node's blocks are hashed
    one after the other as they come: no list of a node's ids is held anywhere.
    """
    block = F.shiftright("conv_id", IDS_BITS)
    joined = ends.groupBy(*NODE, block.alias("block")).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = joined.repartition(*NODE).sortWithinPartitions(*NODE, "block")

    def hash_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, sha = None, None
        for batch in batches:
            done = []
            for depth, d1, d2, ids in batch.itertuples(index=False):
                if (depth, d1, d2) != node:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (depth, d1, d2), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "sha"])
        if node is not None:
            yield pd.DataFrame([(*node, sha.hexdigest())], columns=[*NODE, "sha"])

    return ordered.select(*NODE, "ids").mapInPandas(hash_all, "depth long, d1 long, d2 long, sha string")


def _below(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``own_below``, the weights of nodes credited to the same conversation from here down, and their ``total``."""
    blocks = nodes.groupBy("conv_id", F.floor(F.col("depth") / DEPTH_BLOCK).alias("span")).agg(F.sum("weight").alias("w"))
    later = Window.partitionBy("conv_id").orderBy("span").rowsBetween(1, Window.unboundedFollowing)
    blocks = blocks.select("conv_id", "span", F.coalesce(F.sum("w").over(later), F.lit(0)).alias("later"),
                           F.sum("w").over(Window.partitionBy("conv_id")).alias("total"))
    inside = Window.partitionBy("conv_id", "span").orderBy("depth").rowsBetween(0, Window.unboundedFollowing)
    return (nodes.withColumn("span", F.floor(F.col("depth") / DEPTH_BLOCK)).join(blocks, ["conv_id", "span"])
            .withColumn("own_below", F.col("later") + F.sum("weight").over(inside)).drop("span", "later"))


def prefix_trie(conversations: DataFrame, bits: int | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt first (``rebuilt_turns``). Turns of equal number
    follow the MD5 of their role and text, rows that repeat all of it are turns
    of their own; rows without a conv_id belong to no conversation. A conversation that is
    left without turns ends at the root. Texts of any length count whole. An
    empty table has no node. Columns other than conv_id, turn, role and text are
    not read.
    """
    numbered, convs = numbered_turns(turn_rows(conversations))
    rows = store(prefixes(rebuilt_turns(numbered, convs)), "prefixes")
    rows = store(screened(rows, bits), "screened")
    shared, alone = rows.where("shared"), rows.where("not shared")

    n_turns = convs.agg(F.sum("n_turns")).first()[0] or 0
    zero = [F.lit(0).cast("long").alias(c) for c in NODE]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                     F.count_if(F.col("n_turns") == 0).alias("n_ends")).where("n_convs > 0").select(
        *zero, "conv_id", "n_convs", "n_ends", F.lit(0).cast("long").alias("weight"),
        *[F.lit(None).cast("long").alias(c) for c in ("u1", "u2")], F.lit(False).alias("up_shared"))
    weight = (F.col("n_convs") - 1) * F.col("chars")
    nodes = shared.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"),
        F.max("chars").alias("chars"), F.max("u1").alias("u1"), F.max("u2").alias("u2"),
        F.max("up_shared").alias("up_shared")).withColumn("weight", weight)
    nodes = store(_below(store(root.unionByName(nodes.drop("chars")), "node-counts")), "nodes")

    # children: exact ones, and the topmost of those that the sketch proved to be single
    up = [(F.col("depth") - 1).alias("depth"), F.col("u1").alias("d1"), F.col("u2").alias("d2")]
    edge = alone.where("up_shared").withColumn("n", F.lit(1))
    kids = store(nodes.where("up_shared").select(*up, F.lit(1).alias("exact"), F.lit(0).alias("single")).unionByName(
        edge.select(*up, F.lit(0).alias("exact"), F.lit(1).alias("single"))).groupBy(*NODE).agg(
        F.sum("exact").alias("exact"), F.sum("single").alias("single")), "children")

    # credits of a conversation: weights of the nodes it leads, and whether it leads a childless node
    credit = nodes.select("conv_id", "weight", (F.col("n_ends") == F.col("n_convs")).cast("int").alias("leaf")).unionByName(
        alone.where("last").select("conv_id", F.lit(0).cast("long").alias("weight"), F.lit(1).alias("leaf")))
    credit = credit.groupBy("conv_id").agg(F.sum("weight").alias("weight"), F.max("leaf").alias("leaf")).where(
        "weight > 0 or leaf > 0").join(convs.select("conv_id", "n_turns"), "conv_id")
    credit = store(credit, "credits")
    members = join_groups(shared.select(*NODE, "conv_id"), credit, ["conv_id"], "n_turns", n_turns)
    sums = members.groupBy(*NODE).agg(F.sum("weight").alias("members_weight"), F.sum("leaf").alias("n_leaves"))
    sums = sums.unionByName(credit.groupBy(*zero).agg(F.sum("weight").alias("members_weight"), F.sum("leaf").alias("n_leaves")))
    ends = ends_digests(shared.where("last").select(*NODE, "conv_id").unionByName(
        convs.where("n_turns = 0").select(*zero, "conv_id")))

    exact = nodes.join(sums, NODE, "left").join(kids, NODE, "left").join(ends, NODE, "left")
    exact = exact.select(
        "conv_id", "depth", "u1", "u2", "up_shared", "n_convs", (F.coalesce("exact", F.lit(0)) + F.coalesce("single", F.lit(0))).alias("n_children"),
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        (F.col("own_below") + F.coalesce("members_weight", F.lit(0)) - F.col("total")).alias("saved_tokens"),
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    single = [F.lit(1).alias("n_convs"), F.when(F.col("last"), 0).otherwise(1).alias("n_children"), F.lit(1).alias("n_leaves"),
              F.lit(0).alias("saved_tokens"),
              F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256")]

    # the parent's smallest member; a parent that was proved to be single has the same one
    leads = kids.join(nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id")), NODE)
    n_kids = leads.agg(F.sum("exact").alias("exact"), F.sum("single").alias("single")).first()
    leads = leads.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("u1"), F.col("d2").alias("u2"), "parent_conv_id",
                         "exact", "single")
    to_up = ["depth", "u1", "u2"]
    led = lambda rows, size: join_groups(
        rows, leads.select(*to_up, size, "parent_conv_id"), to_up, size, n_kids[size] or 0).drop(size)
    own = F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id")
    below_single = exact.where("not up_shared").select(*exact.columns, own).drop("up_shared")
    exact = led(exact.where("up_shared").drop("up_shared"), "exact").unionByName(below_single)
    edge = led(edge.select("conv_id", *to_up, *single), "single")
    tails = alone.where("not up_shared").select("conv_id", *to_up, *single, own)
    out = exact.unionByName(edge).unionByName(tails)
    number = lambda c: F.col(c).cast("long").alias(c)
    return out.select(*[number(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                            "saved_tokens")], "ends_sha256")
