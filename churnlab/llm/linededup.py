"""Cross-site line dedup by distinct-site spread. Spark functions only.

Sites per line hash are HyperLogLog sketches, which merge by aggregation:
each task folds its lines into one sketch per line hash, and the sketches of a
hash meet in one small merge, so a line on a third of all pages is no hot
group. Lines whose estimate lies near the threshold get an exact distinct
count; the others are decided by the estimate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import store, text_key, unused

MIN_SITES = 5
LG_K = 12
SIGMAS = 6.0  # the estimate decides alone only this many standard errors away from the threshold


def line_key(line: Column) -> tuple[Column, Column]:
    trimmed = F.trim(line)
    return F.xxhash64(trimmed), F.xxhash64(F.lit("second"), trimmed)


def exploded_lines(docs: DataFrame, site: str) -> DataFrame:
    """(doc_id, k1, k2, site, pos, h1, h2): non-blank lines of all texts by two 64-bit hashes of the trimmed line."""
    rows = docs.select("doc_id", F.col(site).cast("string").alias("site"), *text_key(),
                       F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    h1, h2 = line_key(F.col("line"))
    return rows.where(F.trim("line") != "").select("doc_id", "k1", "k2", "site", "pos", h1.alias("h1"), h2.alias("h2"))


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "pos")


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2, first): lines on at least ``min_sites`` distinct non-null sites, with their first place."""
    error = SIGMAS * 1.04 / 2 ** (lg_k / 2)
    sketched = (lines.groupBy("h1", "h2")
                .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"), F.min(_place()).alias("first"))
                .where(F.col("sites") >= min_sites * (1 - error) - 1))
    sketched = store(sketched, "line-spread")
    near = F.col("sites") <= min_sites * (1 + error) + 1
    exact = (lines.where("site is not null").join(sketched.where(near).select("h1", "h2"), ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
             .groupBy("h1", "h2").agg(F.count("*").alias("exact")).where(F.col("exact") >= min_sites).select("h1", "h2"))
    return (sketched.where(~near).select("h1", "h2", "first")
            .unionByName(sketched.where(near).join(exact, ["h1", "h2"], "left_semi").select("h1", "h2", "first")))


def removed_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(doc_id, k1, k2, gone): per text with any, the line numbers to remove.

    A spread line stays at its first place (smallest doc_id, then text key and
    line number) and goes everywhere else.
    """
    lines = exploded_lines(docs, site)
    spread = store(spread_lines(lines, min_sites, lg_k), "spread-lines")
    gone = lines.drop("site").join(spread, ["h1", "h2"]).where(~_place().eqNullSafe(F.col("first")))
    return gone.groupBy("doc_id", "k1", "k2").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K,
                counted: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines cut out of ``text``; every row and column stays.

    A line (trimmed, not blank) is boilerplate if it stands in texts of at least
    ``min_sites`` sites; its first place in the corpus keeps it, the others lose
    it. Blank lines and the order of lines stay. Null texts stay null, null
    sites are no site, a text may become empty, rows that agree in doc_id and
    text are treated alike, an empty table gives an empty result. ``n_chars`` is
    brought up to date where there is one; ``counted`` adds ``lines_removed``.
    """
    t1, t2, lines, g0, g1, g2, gone = unused(docs, "_t1", "_t2", "_lines", "_g0", "_g1", "_g2", "_gone")
    removed = removed_lines(docs, site, min_sites, lg_k).select(
        *[F.col(c).alias(n) for c, n in zip(("doc_id", "k1", "k2", "gone"), (g0, g1, g2, gone))])
    k1, k2 = text_key()
    # the lines travel instead of the text: they are cut once, before the join
    keyed = docs.withColumns({t1: k1, t2: k2, lines: F.split("text", "\n")}).drop("text")
    joined = keyed.join(removed, F.col("doc_id").eqNullSafe(F.col(g0)) & (F.col(t1) == F.col(g1))
                        & (F.col(t2) == F.col(g2)), "left")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.when(F.col(gone).isNull(), F.col(lines)).otherwise(F.transform(places, lambda i: F.get(F.col(lines), i)))
    out = joined.withColumn("text", F.array_join(kept, "\n"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    extra = [F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias("lines_removed")] if counted else []
    return out.select(*docs.columns, *extra)
