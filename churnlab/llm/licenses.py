"""Canonical digest lookup of licence texts.

A text is brought to a canonical form (case, punctuation, copyright lines and
equivalent spellings), and the MD5 of the whole form is looked up among the
digests of known licences and notices by a hash join.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm.common import spaced_bytes
from churnlab.llm.licence_texts import EQUIVALENT, KNOWN

LINES_HELD = 20_000  # distinct lines of a batch whose digests are kept
BROADCAST_BYTES = 8_000_000
# a copyright line: the word, sign or (c) comes first, or the line only reserves all rights
_NO_WORD = r"(?:[^\w\n]|_)*"
_COPYRIGHT_LINE = re.compile(rf"(?im)^{_NO_WORD}(?:copyright|©|\(c\))[^\n]*$|^{_NO_WORD}all rights reserved{_NO_WORD}$")
_COPYRIGHT_SIGNS = ("copyright", "©", "(c)", "all rights reserved")
# words stand two spaces apart, so that neighbouring spellings do not share one
_SPELLINGS = [tuple(f" {x.replace(' ', '  ')} ".encode() for x in pair) for pair in EQUIVALENT]


def canonical(text: str) -> bytes:
    """Copyright lines dropped, lower case, words joined by single spaces, equivalent spellings made one."""
    low = text.lower()
    if any(sign in low for sign in _COPYRIGHT_SIGNS):
        text = _COPYRIGHT_LINE.sub("", text)
    form = b" " + b"  ".join(spaced_bytes(text).split()) + b" "
    for spelling, standard in _SPELLINGS:
        if spelling in form:
            form = form.replace(spelling, standard)
    return form[1:-1].replace(b"  ", b" ")


def text_digest(text: str | None) -> str | None:
    form = canonical(text) if text else b""
    return hashlib.md5(form).hexdigest() if form else None


def digest(text: Column) -> Column:
    """MD5 of the canonical form; null where the text is null or has no word left."""

    @F.pandas_udf("string")
    def digests(texts: pd.Series) -> pd.Series:
        return pd.Series([text_digest(t) for t in texts], dtype=object)

    return digests(text)


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license_id, text) of the known licences and notices; ``texts`` replaces the built-in list."""
    return spark.createDataFrame(texts if texts is not None else KNOWN, "license_id string, text string")


def license_digests(known: DataFrame) -> DataFrame:
    """One row per digest: licences of equal canonical form share the smallest ``license_id``."""
    return (known.select("license_id", digest(F.col("text")).alias("digest")).where("digest is not null")
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast hint only if the digests (32 characters and an id each) fit the bound."""
    size = df.agg(F.sum(F.length("digest") + F.length("license_id") + 64)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def scan_texts(docs: DataFrame, known: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, ``digest`` of its whole text and ``license_id`` (null: not a known licence).

    Null and word-free texts have no digest and no licence; repeated rows give
    repeated results; an empty table gives an empty result; further columns of
    ``docs`` are not touched.
    """
    table = _small(license_digests(known))
    return docs.select(F.col(key), digest(F.col("text")).alias("digest")).join(table, "digest", "left").select(
        key, "digest", "license_id")


def scan_rows(docs: DataFrame, known: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, ``digest``, ``license_id`` of its whole text and sorted ``notice_ids`` of its lines.

    A line counts if it is a known licence or notice in whole, by the same
    canonical digest; without one ``notice_ids`` is null. Text and lines are made
    canonical in one pass, where the lines are looked up; the known digests go to
    the tasks in parts of bounded size. Rows stand for themselves, so null and
    repeated keys do no harm; texts of any length are scanned whole; null texts
    have neither digest nor notices; an empty table gives an empty result.
    """
    digests = license_digests(known)
    size = digests.agg(F.sum(F.length("digest") + F.length("license_id") + 64)).first()[0] or 0
    parts = max(1, -(-size // BROADCAST_BYTES))
    notices = []
    for part in range(parts):
        rows = digests.where(F.pmod(F.xxhash64("digest"), F.lit(parts)) == part).collect()
        notices.append(_notices({r["digest"]: r["license_id"] for r in rows}, docs.sparkSession)(F.col("text")))
    ids = F.array_sort(F.array_distinct(F.flatten(F.array(*notices))))
    rows = docs.select(F.col(key), digest(F.col("text")).alias("digest"), F.when(F.size(ids) > 0, ids).alias("notice_ids"))
    return rows.join(_small(digests), "digest", "left").select(key, "digest", "license_id", "notice_ids")


def _notices(known: dict[str, str], spark: SparkSession):
    """A UDF: licence ids of the lines of a text whose digest is in ``known``."""
    sent = spark.sparkContext.broadcast(known)

    @F.pandas_udf("array<string>")
    def notices(texts: pd.Series) -> pd.Series:
        ids, seen = sent.value, {}
        out = []
        for text in texts:
            found = []
            for line in (text or "").split("\n"):
                if line not in seen:
                    if len(seen) >= LINES_HELD:
                        seen.clear()
                    seen[line] = ids.get(text_digest(line))
                if seen[line] is not None:
                    found.append(seen[line])
            out.append(found)
        return pd.Series(out, dtype=object)

    return notices
