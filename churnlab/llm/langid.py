"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the bag of its byte 3- and 4-grams inside words (a space marks a
word's start and end), hashed into buckets. Each bucket has an embedding; a
text's embedding is their average; a linear softmax gives the languages. The
model is trained by stochastic gradient descent in numpy on a bounded,
hash-chosen sample per language, calibrated by a temperature on rows that the
descent has not seen, and rejects texts whose calibrated confidence lies below
that of nearly all rightly classified calibration rows. Because average and
softmax layer are linear, prediction sums one row of class scores per n-gram.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import chunks

BUCKET_BITS = 15
DIM = 16
GRAMS = (3, 4)
ROWS_PER_LANGUAGE = 600  # bound of the training sample, for each language
EPOCHS = 6
BATCH = 32
RATE = 0.5
CALIBRATION_SHARE = 0.25
REJECTED_SHARE = 0.001  # of rightly classified calibration rows
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
_NON_ASCII_GAP = re.compile(r"[^\x00-\x7f\w]")
_TO_SPACE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    found = _LETTER.search(text)
    return found is not None and (found[0].isalpha() or any(map(str.isalpha, text)))


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per n-gram size: how many n-grams each text has, and the buckets of them all, text after text."""
    parts = []
    for t in texts:
        t = t.lower()
        if not t.isascii():
            t = _NON_ASCII_GAP.sub(" ", t)
        parts.append(t.encode("utf-8", "surrogatepass").translate(_TO_SPACE))
    # each text is taken with the space before and the space after it
    raw = np.frombuffer(b" " + b"  ".join(parts) + b" ", np.uint8)
    first = np.cumsum([0] + [len(p) + 2 for p in parts[:-1]])
    gaps = np.cumsum(raw == 32, dtype=np.int32)
    wide = raw.astype(np.uint32)
    h = wide[:-1] * np.uint32(0x9E3779B1) + wide[1:]
    for n in range(3, max(GRAMS) + 1):
        if len(raw) < n:
            return
        h = h[:len(raw) - n + 1] * np.uint32(0x85EBCA6B) + wide[n - 1:]
        if n in GRAMS:
            inside = np.zeros(len(raw), bool)
            np.equal(gaps[n - 2:len(raw) - 1], gaps[:len(raw) - n + 1], out=inside[:len(h)])
            x = h[inside[:len(h)]]
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0xC2B2AE35)
            yield np.add.reduceat(inside, first, dtype=np.int64), (x >> np.uint32(32 - BUCKET_BITS)).view(np.int32)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets, their shares) of one text."""
    buckets = np.concatenate([b for _, b in subwords([text])] or [np.zeros(0, np.int32)])
    at, times = np.unique(buckets, return_counts=True)
    return at, (times / max(1, len(buckets))).astype(np.float32)


@dataclass
class LanguageModel:
    """``table``: class scores per bucket; a text's logits are their mean plus ``bias``, over ``temperature``."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        seen = np.zeros(len(texts))
        for a, b in chunks(texts, 200_000):
            for counts, buckets in subwords(texts[a:b]):
                some = np.flatnonzero(counts)
                if len(some):
                    starts = np.cumsum(counts[some]) - counts[some]
                    out[a + some] += np.add.reduceat(self.table[buckets], starts, axis=0)
                    seen[a:b] += counts
        return softmax((out / np.maximum(seen, 1)[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str],
          calibration: np.ndarray, seed: int = 7) -> LanguageModel:
    """SGD over (buckets, shares) bags; rows marked in ``calibration`` set temperature and rejection only."""
    rng = np.random.default_rng(seed)
    classes = len(languages)
    embed = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    weight = rng.normal(0, 0.1, (DIM, classes)).astype(np.float32)
    bias = np.zeros(classes, np.float32)
    fit = np.flatnonzero(~calibration)

    def averages(rows: np.ndarray) -> np.ndarray:
        return np.stack([bags[r][1] @ embed[bags[r][0]] for r in rows]) if len(rows) else np.zeros((0, DIM), np.float32)

    batches = max(1, -(-len(fit) // BATCH))
    for epoch in range(EPOCHS):
        for i, rows in enumerate(np.array_split(rng.permutation(fit), batches)):
            if not len(rows):
                continue
            rate = RATE * (1 - (epoch * batches + i) / (EPOCHS * batches))
            mean = averages(rows)
            error = softmax(mean @ weight + bias).astype(np.float32)
            error[np.arange(len(rows)), labels[rows]] -= 1
            back = error @ weight.T
            # a text's gradient is spread over many buckets: larger steps for embeddings than for the bias
            weight -= 4 * rate * mean.T @ error / len(rows)
            bias -= rate * error.mean(axis=0)
            for r, g in zip(rows, back):
                embed[bags[r][0]] -= (10 * rate * bags[r][1])[:, None] * g

    held = np.flatnonzero(calibration)
    held = held if len(held) else fit
    logits = averages(held) @ weight + bias
    truth = labels[held]
    scales = np.geomspace(0.05, 20, 121)
    # smoothed targets: separable calibration rows would else call for an endless sharpening
    doubt = 1 / (len(held) + 2)
    target = np.full((len(held), classes), doubt / max(1, classes - 1))
    target[np.arange(len(held)), truth] = 1 - doubt
    loss = [-(target * np.log(np.maximum(softmax(logits / s), 1e-12))).sum(axis=1).mean() for s in scales]
    temperature = float(scales[int(np.argmin(loss))]) if len(held) else 1.0
    best = softmax(logits / temperature) if len(held) else np.ones((1, classes))
    right = best[np.arange(len(held)), truth][best.argmax(axis=1) == truth] if len(held) else np.ones(1)
    lowest = float(np.quantile(right, REJECTED_SHARE)) if len(right) else 0.0
    return LanguageModel(languages, embed @ weight, bias, temperature, min(0.5, lowest))


def fit_language_model(labelled: DataFrame, key: str = "doc_id", rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel | None:
    """A model of the languages in ``labelled`` (key, text, lang); None if no row has a language and a letter.

    Per language the rows with the smallest hashes of their key, about
    ``rows_per_language`` of them; their bags are counted on the executors and
    the descent runs on these bounded bags. Null languages and texts are left
    out.
    """
    rows = labelled.where("lang is not null and text is not null").select(F.col(key).cast("string").alias("k"), "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, rows_per_language / counts[lang]))])
    drawn = (F.pmod(F.xxhash64(F.lit("draw"), "k"), F.lit(1 << 20)) / (1 << 20))
    sample = rows.where(drawn < F.try_element_at(shares, F.col("lang")))

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [bag(text) for text in batch["text"]]
            yield pd.DataFrame({"k": batch["k"], "lang": batch["lang"], "at": [o[0].astype("<i4").tobytes() for o in out],
                                "share": [o[1].astype("<f4").tobytes() for o in out]})

    # packed: as arrays each number would be an object of its own on the driver
    got = sample.mapInPandas(bags, "k string, lang string, at binary, share binary").toPandas()
    got = got[got["at"].map(len) > 0].sort_values(["k", "lang"]).reset_index(drop=True)
    if not len(got):
        return None
    pairs = [(np.frombuffer(a, "<i4"), np.frombuffer(s, "<f4")) for a, s in zip(got.pop("at"), got.pop("share"))]
    labels = np.searchsorted(languages, got["lang"].to_numpy())
    calibration = np.random.default_rng(11).random(len(got)) < CALIBRATION_SHARE
    if calibration.all():
        calibration[:] = False
    return train(pairs, labels, languages, calibration)


def predict_language(text: Column, model: LanguageModel | None, spark) -> Column:
    """struct(lang_pred, score, rejected) of a text column.

    Texts that are null or have no letter are ``und`` with score 0 and rejected;
    so are all texts without a model. Others get the likeliest language, its
    calibrated probability, and ``rejected`` where that lies below the
    calibrated bound.
    """
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = sent.value
        values = texts.tolist()
        known = [i for i, t in enumerate(values) if m is not None and t is not None and has_letter(t)]
        lang = np.full(len(values), UNDETERMINED, object)
        score, rejected = np.zeros(len(values)), np.ones(len(values), bool)
        if known:
            p = m.probabilities([values[i] for i in known])
            lang[known] = np.asarray(m.languages, object)[p.argmax(axis=1)]
            score[known] = p.max(axis=1)
            rejected[known] = p.max(axis=1) < m.reject_below
        return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": rejected})

    return predict(text)


def held_out(key: Column) -> Column:
    """Rows that no model learns from: CRC-32 of the key as text is 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def keep_known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that the language model rejects; all columns stay.

    The model learns from the rows of ``docs`` that are not held out.
    """
    model = fit_language_model(docs.where(~held_out(F.col("doc_id"))))
    return docs.where(~predict_language(F.col("text"), model, docs.sparkSession)["rejected"])
