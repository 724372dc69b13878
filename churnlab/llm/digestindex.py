"""Exact dedup against a persistent digest index. Spark functions only.

The index is a table of one row per digest ever seen, bucketed and sorted by
the digest. A delivery of documents is folded to one row per digest where it
lies (copies never travel as texts), then split by sort-merge joins with the
index, whose side is read in its buckets and not shuffled: digests that the
anti-join finds new are appended to ``entries``, the others to ``repeats``,
bucketed alike. A digest's group is its entry and its repeats, found without a
shuffle of either.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm.common import join_groups, store, unused

BLANKS = r"[\x20\x09-\x0D]+"
_ROW = ("digest binary, n bigint, best struct<fewer: bigint, none: boolean, doc_id: bigint, mark: bigint>, "
        "delivery string")


def bare_text(text: Column) -> Column:
    """The text without blanks (space, tab, line ends, form feeds); null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def digest_columns() -> dict[str, Column]:
    """What the index knows of a row: SHA-256 of its bare text, code points of the whole text, 64 bits of that text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return {"digest": F.unhex(F.sha2(bare_text(F.col("text")), 256)), "chars": F.char_length(text).cast("long"),
            "mark": F.xxhash64(text)}


def digest_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, chars, mark) of every row of ``docs``; map-only."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(n) for n, c in digest_columns().items()])


def _place() -> Column:
    """The smallest stays: most code points, then a doc_id before none, the smallest doc_id, the text's hash."""
    return F.struct((-F.col("chars")).alias("fewer"), F.col("doc_id").isNull().alias("none"), "doc_id", "mark")


class DigestIndex:
    """An index in ``folder`` (a URI that driver and executors share), made there if there is none.

    ``buckets`` counts only when the index is made; as many as the session has
    shuffle partitions unless given. Every delivery writes under a name of its
    own and counts from the moment its name is in ``deliveries``: what a driver
    that died half-way left is never read.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/layout/_SUCCESS")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            made = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(made).alias("buckets")).write.mode("overwrite").parquet(f"{self.folder}/layout")
            spark.createDataFrame([], "delivery string").write.mode("overwrite").parquet(f"{self.folder}/deliveries")
        self.buckets = spark.read.parquet(f"{self.folder}/layout").first()[0]
        name = "digests_" + uuid.uuid4().hex  # the session's name for the files; several sessions may use them
        self.tables = {part: f"{name}_{part}" for part in ("entries", "repeats")}
        for part, table in self.tables.items():
            spark.sql(f"CREATE TABLE {table} ({_ROW}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                      f"INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{part}'")

    def _read(self, part: str) -> DataFrame:
        done = [r[0] for r in self.spark.read.schema("delivery string").parquet(f"{self.folder}/deliveries").collect()]
        return self.spark.table(self.tables[part]).where(F.col("delivery").isin(done))

    def _append(self, rows: DataFrame, part: str) -> None:
        rows.select("digest", "n", "best", "delivery").write.insertInto(self.tables[part])

    def add(self, rows: DataFrame) -> str:
        """Take in a delivery of ``digest_rows``; returns its name. Digests new to the index become entries."""
        name = uuid.uuid4().hex
        folded = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(_place()).alias("best")).withColumn(
            "delivery", F.lit(name))
        known = self._read("entries").select("digest").hint("merge")
        self._append(folded.join(known, "digest", "left_anti"), "entries")
        self._append(folded.join(known, "digest", "left_semi"), "repeats")
        self.spark.createDataFrame([(name,)], "delivery string").write.mode("append").parquet(f"{self.folder}/deliveries")
        return name

    def entries(self, delivery: str) -> DataFrame:
        """(digest, best) of the digests that this delivery brought first."""
        return self._read("entries").where(F.col("delivery") == delivery).select("digest", "best")

    def groups(self) -> DataFrame:
        """(digest, group_size, best) over all deliveries."""
        again = self._read("repeats").groupBy("digest").agg(F.sum("n").alias("more"), F.min("best").alias("other"))
        return self._read("entries").join(again.hint("merge"), "digest", "left").select(
            "digest", (F.col("n") + F.coalesce("more", F.lit(0))).alias("group_size"), F.least("best", "other").alias("best"))

    def close(self) -> None:
        """Take the session's names for the files out of its catalog; the files stay."""
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def memberships(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``rows``.

    The row with the most code points stays, then the smallest doc_id (null
    after all), then the smallest text hash; of rows equal in all of these one
    stays. Null texts are empty texts, and all blank texts are equal. Texts of
    any length are hashed whole. An empty table gives an empty result.
    """
    groups = store(groups, "digest-groups")
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    found = join_groups(rows, groups, ["digest"], "group_size", total)
    found = found.withColumn("first", _place().eqNullSafe(F.col("best")))
    out = [F.col("best.doc_id").alias("keep_id"), "group_size"]
    others = found.where("not first").select("doc_id", *out, F.lit(False).alias("kept"), "digest")
    # rows that repeat the one that stays, folded to one row with a count
    same = found.where("first").groupBy("digest", "doc_id", "group_size", "best").agg(F.count("*").alias("times"))
    first = same.select("doc_id", *out, "digest", F.explode(F.sequence(F.lit(1), "times")).alias("nth")).select(
        "doc_id", "keep_id", "group_size", (F.col("nth") == 1).alias("kept"), "digest")
    return others.unionByName(first).select("doc_id", "keep_id", "group_size", "kept",
                                            F.lower(F.hex("digest")).alias("text_sha256"))


def keep_new(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` whose text the index has not seen, one per text, all columns as they are; the index takes them in.

    Of equal texts within ``docs`` the one that ``memberships`` would keep
    stays; a text of an earlier delivery goes, however long this copy is.
    """
    names = unused(docs, "_digest", "_chars", "_mark", "_entry", "_best")
    keyed = docs.withColumns(dict(zip(names, digest_columns().values())))
    fresh = index.entries(index.add(store(digest_rows(docs), "digest-rows"))).toDF(*names[3:])
    digest, chars, mark, entry, best = (F.col(n) for n in names)
    same = ((digest == entry) & (-chars == best["fewer"]) & (mark == best["mark"])
            & F.col("doc_id").cast("long").eqNullSafe(best["doc_id"]))
    return keyed.join(fresh, same, "left_semi").dropDuplicates([names[0]]).select(*docs.columns)
