"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features of a whole text: densities of a given insult lexicon and of learned words and word stems,
how near the hits stand to second-person words, capitals, punctuation, and
obfuscated spellings (symbols inside words, and lexicon words that appear once
the symbols are undone). The learned lexicon, the trees and the calibration see
rows outside the held-out quarter only; a bounded number of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm.common import chunks, store, word_hashes, word_table
from churnlab.llm.langid import held_out

MAX_LABELLED_ROWS = 20_000  # bound of the rows that lexicon, trees and calibration learn from
LEXICON_WORDS = 500  # bound of each learned lexicon
STEM_BYTES = 6
MIN_SUPPORT = 6
NEAR_WORDS = 12
PREDICT_FROM = 0.3
SEED = 17

# A starting lexicon of insults, and second-person words of the languages at hand.
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "pathetic",
           "worthless", "disgusting", "clown", "imbecile", "fool", "jerk", "creep", "vermin", "filth", "idiota",
           "estúpido", "imbécil", "basura", "escoria", "payaso", "dumm", "dummkopf", "abschaum", "trottel", "depp",
           "imbécile", "crétin", "ordure", "débile", "connard")
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu",
                 "te", "toi", "vous", "votre", "ton", "tes", "tú", "ti", "usted", "ustedes", "vosotros")

_INSIDE = re.compile(r"(?<=[A-Za-z])[@$*#%!|0-9.\-_]{1,3}(?=[A-Za-z])")
_SHOUT = re.compile(r"(?<![A-Za-z])[A-Z]{3,}(?![A-Za-z])")
_PLAIN = str.maketrans({"@": "a", "$": "s", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "!": "i", "|": "l",
                        "*": None, "#": None, "%": None, ".": None, "-": None, "_": None})
FEATURES = ("log_words", "given", "learned", "given_any", "learned_any", "stems", "stems_any", "near", "second_person", "capitals", "shouted",
            "exclaims", "questions", "symbols", "other_marks", "digits", "obfuscated", "obfuscated_hits")


def _hash_set(words: list[str]) -> np.ndarray:
    return np.unique(word_hashes([" ".join(words)])[1])


class Features:
    """Dense features of whole texts; the lexicons are looked up by word hash."""

    def __init__(self, learned: list[str], stems: list[bytes]):
        self.stems = np.asarray([int.from_bytes(s, "little") for s in sorted(stems)], np.uint64)
        self.given, self.learned, self.second = _hash_set(INSULTS), _hash_set(learned), _hash_set(SECOND_PERSON)
        self.words = set(INSULTS) | set(learned)

    def obfuscated_hits(self, text: str, marks: list[re.Match]) -> int:
        hits = 0
        for m in marks:
            a, b = m.start(), m.end()
            while a > 0 and m.start() - a < 24 and not text[a - 1].isspace():
                a -= 1
            while b < len(text) and b - m.end() < 24 and not text[b].isspace():
                b += 1
            hits += text[a:b].lower().translate(_PLAIN).strip(",;:?\"'()") in self.words
        return hits

    def table(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(FEATURES)))
        docs, words, heads, sizes = word_table(texts)
        n = np.maximum(np.bincount(docs, minlength=len(texts)), 1)
        kinds = [np.flatnonzero(np.isin(words, s)) for s in (self.given, self.learned, self.second)]
        given, learned, second = (np.bincount(docs[k], minlength=len(texts)) for k in kinds)
        out[:, 0], out[:, 1], out[:, 2], out[:, 3], out[:, 4] = np.log1p(n), given / n, learned / n, given, learned
        mask = np.uint64((1 << (8 * STEM_BYTES)) - 1)
        stem = np.flatnonzero(np.isin(heads & mask, self.stems) & (sizes > STEM_BYTES))
        out[:, 6] = np.bincount(docs[stem], minlength=len(texts))
        out[:, 5] = out[:, 6] / n
        hits = np.union1d(np.union1d(kinds[0], kinds[1]), stem)
        if len(hits) and len(kinds[2]):
            right = np.searchsorted(kinds[2], hits)
            best = np.full(len(hits), np.inf)
            for side in (np.minimum(right, len(kinds[2]) - 1), np.maximum(right - 1, 0)):
                other = kinds[2][side]
                best = np.minimum(best, np.where(docs[other] == docs[hits], np.abs(other - hits), np.inf))
            near = np.where(best <= NEAR_WORDS, 1 / (1 + best), 0)
            out[:, 7] = np.bincount(docs[hits], near, len(texts)) / np.maximum(np.bincount(docs[hits], minlength=len(texts)), 1)
        out[:, 8] = second / n
        for i, text in enumerate(texts):
            size = max(1, len(text))
            counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
            marks = list(_INSIDE.finditer(text))
            out[i, 9:] = (counts[65:91].sum() / size, len(_SHOUT.findall(text)) / n[i], counts[33] / size, counts[63] / size,
                          counts[[35, 36, 37, 38, 42, 64, 94, 124, 126]].sum() / size,
                          counts[[34, 39, 40, 41, 44, 45, 46, 58, 59]].sum() / size, counts[48:58].sum() / size,
                          len(marks) / n[i], self.obfuscated_hits(text, marks))
        return out


def learned_lexicons(sample: DataFrame, size: int = LEXICON_WORDS) -> tuple[list[str], list[bytes]]:
    """Words, and first bytes of longer words, that mark label 1 in ``sample`` (text, label).

    Those count whose share of label 1 among the documents that hold them has a
    lower confidence bound well above the base rate; at most ``size`` of each.
    """
    base = sample.agg(F.avg("label")).first()[0]
    if base is None or not 0 < base < 1:
        return [], []
    words = sample.select("label", F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), 1)).alias("words"))
    longer = F.filter("words", lambda w: F.octet_length(w) > STEM_BYTES)
    stems = F.array_distinct(F.transform(longer, lambda w: F.hex(F.substring(F.encode(w, "utf-8"), 1, STEM_BYTES))))

    def marking(each: DataFrame) -> list[str]:
        z, n = 1.96, F.col("n")
        share = F.col("hits") / n
        low = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        rows = (each.groupBy("mark").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
                .where((n >= MIN_SUPPORT) & (low > 0.5 + base / 2)).orderBy(F.desc("hits"), "mark").limit(size))
        return [r["mark"] for r in rows.select("mark").collect()]

    return (marking(words.select("label", F.explode("words").alias("mark"))),
            [bytes.fromhex(m) for m in marking(words.select("label", F.explode(stems).alias("mark")))])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = MAX_LABELLED_ROWS) -> DataFrame:
    """(doc_id, text, label, fold) of at most ``rows`` labelled documents outside the held-out quarter, by hash order.

    Several labels of one doc_id count as their largest; fold 0 is for calibration.
    """
    ids = (labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
           .orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(rows))
    ids = ids.select(F.col("doc_id").alias("_id"), "label", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)).alias("fold"))
    # at most MAX_LABELLED_ROWS rows of 20 bytes
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "label", "fold")


def feature_table(docs: DataFrame, lexicons: tuple[list[str], list[bytes]], columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` and ``features`` (array of doubles) of each whole text; null counts as empty."""
    maker = Features(*lexicons)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*columns).schema.fields)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            rows = [r for a, b in chunks(texts) for r in maker.table(texts[a:b])]
            yield batch[columns].assign(features=rows)

    return docs.select(*columns, "text").mapInPandas(make, f"{schema}, features array<double>")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (calibrated), raw_score (of the trees) and predicted.

    Null texts count as empty and get a score too, repeated rows the same score.
    Without labels of both kinds the score is the mean label (0 where there is
    none). Equal features give equal scores, and those on one step of the
    calibration curve keep the trees' order. Texts of any length are read whole.
    An empty table gives an empty result; other columns are not read.
    """
    sample = store(labelled_sample(docs, labels), "toxicity-sample")
    counts = {(r["label"], r["fold"] == 0): r["n"] for r in
              sample.groupBy("label", F.col("fold")).agg(F.count("*").alias("n")).collect()}
    split = all(any(label == want and cal for label, cal in counts) and any(label == want and not cal for label, cal in counts)
                for want in (0.0, 1.0))
    # what calibrates has not been seen by the lexicons either
    lexicons = learned_lexicons(sample.where("fold <> 0") if split else sample)
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with_out = held_out(F.col("doc_id")).alias("held_out")
    both = all(any(label == want for label, _ in counts) for want in (0.0, 1.0))
    if not both:
        mean = sample.agg(F.avg("label")).first()[0] or 0.0
        return kept.select("doc_id", with_out, F.lit(float(mean)).alias("score"), F.lit(float(mean)).alias("raw_score"),
                           F.lit(int(mean >= PREDICT_FROM)).alias("predicted"))
    rows = store(feature_table(sample, lexicons, ["doc_id", "label", "fold"]), "toxicity-train")
    rows = rows.select("label", "fold", array_to_vector("features").alias("features")).coalesce(8).persist()
    fit = rows.where("fold <> 0") if split else rows
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, subsamplingRate=0.8, minInstancesPerNode=5, seed=SEED,
                          maxMemoryInMB=64).fit(fit)
    raw = vector_to_array("probability")[1]
    marked = trees.transform(rows.where("fold = 0") if split else rows).select("label", raw.alias("raw"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(marked)
    rows.unpersist()
    features = feature_table(kept, lexicons, ["doc_id"])
    scored = trees.transform(features.select("doc_id", array_to_vector("features").alias("features"))).select(
        "doc_id", raw.alias("raw"))
    # the steps of the isotonic curve tie; a thousandth of the trees' score keeps their order
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("calibrated") + 0.001 * F.col("raw")))
    return curve.transform(scored).select(
        "doc_id", with_out, score.alias("score"), F.col("raw").alias("raw_score"),
        (score >= PREDICT_FROM).cast("int").alias("predicted"))


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
