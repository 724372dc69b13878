"""Spelling variants: words one edit apart, found in sorted lists of the vocabulary.

Two words one edit apart share their first half or their last half, so the
vocabulary is sorted twice, by the words and by the reversed words, and a word
looks for partners only between the words that share its half. Either list is
cut into ranges of bounded size. A range whose shared prefix is already more
than one edit away from a word is skipped; the others get the word as a visitor.

Inside a range, adjacent words share their longest common prefix (LCP). The
LCP intervals of the sorted list nest; the edit matrix of a word needs one row
per interval, banded to the three cells within one edit, and all words of the
interval reuse it. An interval whose row exceeds one edit everywhere is skipped
with all its words. The scan takes all words of a range one letter deeper at a
time, in numpy. No pair of words is ever a row: a range tells each word how many
partners it has there and the most frequent of them.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import store

MIN_LETTERS, MIN_COUNT, FORM_TIMES, DROP_EVERY = 7, 2, 10, 31
RANGE_WORDS = 20_000
QUERIES_AT_ONCE = 8192
LONG = 64  # longer words are compared one by one inside their interval
WORDS_HELD = 200_000  # distinct words that a task counts before it sends them on
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)  # shorter runs cannot give a word
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_AFTER = "Ā"  # sorts after every letter of a word
FOUND = "word string, n_near long, form_n long, form string"


# ---------------------------------------------------------------- vocabulary

def words_of_document(doc_id: str | None, text: str) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text, runs spoiled where the checksum says so; a null doc_id is written ``null``."""
    runs: Counter[str] = Counter()
    for run, n in Counter(_RUN.findall(text)).items():
        runs[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % DROP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= MIN_LETTERS:
            yield run, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least 7 code points with at least 2 occurrences in all of ``docs``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                for word, n in words_of_document(doc_id, text):
                    seen[word] += n
                if len(seen) >= WORDS_HELD:
                    yield pd.DataFrame({"word": pd.Series(list(seen), dtype="object"), "n": list(seen.values())})
                    seen.clear()
        yield pd.DataFrame({"word": pd.Series(list(seen), dtype="object"), "n": np.fromiter(seen.values(), np.int64, len(seen))})

    rows = docs.where("text is not null").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = rows.mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# ---------------------------------------------------------------- one range

def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point lies between ``a`` and ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = _shared(short, long)
    return short[at + (len(a) == len(b)):] == long[at + 1:]


def _shared(a: str, b: str) -> int:
    """Length of the shared prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def prefix_in_reach(prefix: str, word: str) -> bool:
    """Whether some word that starts with ``prefix`` is at most one edit away from ``word`` (banded rows)."""
    row = (2, 0, 1)  # edits between prefix[:d] and word[:d - 1], word[:d], word[:d + 1]
    for d, c in enumerate(prefix, 1):
        new = [2, 2, 2]
        for k in range(3):
            j = d + k - 1
            if 0 <= j <= len(word):
                new[k] = min(row[k] + (j == 0 or word[j - 1] != c), row[k + 1] + 1 if k < 2 else 2, new[k - 1] + 1 if k else 2)
        row = tuple(new)
        if min(row) > 1:
            return False
    return True


def half(length: int, backwards: bool) -> int:
    """Letters that a word of ``length`` shares at least with every partner that this list is to find."""
    return length // 2 if backwards else (length - 1) // 2


class SortedRange:
    """A range of the sorted list: ``words`` (reversed ones in the list sorted backwards) with their counts."""

    def __init__(self, words: list[str], counts: np.ndarray, backwards: bool):
        self.words, self.counts, self.backwards = words, counts, backwards
        real = np.asarray([w[::-1] for w in words] if backwards else words, object)
        self.order = np.empty(len(words), np.int64)  # place of a word among all in code-point order
        self.order[np.argsort(real, kind="stable")] = np.arange(len(words))
        short = np.fromiter((len(w) <= LONG + 1 for w in words), bool, len(words))
        self.at = np.flatnonzero(short)  # words of the letter matrix
        kept = [words[i] for i in self.at]
        self.size = np.fromiter(map(len, kept), np.int64, len(kept))
        self.kept = kept
        width = int(self.size.max(initial=0)) + 1
        raw = np.zeros((len(kept), width), np.uint8)
        for i, w in enumerate(kept):
            raw[i, :len(w)] = np.frombuffer(w.encode("latin-1"), np.uint8)
        alphabet = np.flatnonzero(np.bincount(raw.ravel(), minlength=256)[1:]) + 1
        self.code = np.full(256, -2, np.int16)  # letters by small numbers
        self.code[alphabet] = np.arange(1, len(alphabet) + 1)
        self.n_letters = len(alphabet) + 1
        self.letters = np.where(raw > 0, self.code[raw], 0).astype(np.uint8)  # 0 after a word's end
        same = self.letters[1:] == self.letters[:-1]
        # words that begin with nothing shared have LCP 0; a word that is the start of the next shares all of itself
        self.lcp = np.concatenate([[0], np.where(same.all(axis=1), width, same.argmin(axis=1))]) if len(kept) else np.zeros(0, np.int64)

    def starts(self, depth: int) -> np.ndarray:
        """First words of the LCP intervals of ``depth``."""
        return np.flatnonzero(self.lcp < depth)

    def partners(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query number, word number): all pairs one edit apart that are this list's to find."""
        short = [i for i, q in enumerate(queries) if len(q) <= LONG]
        found = [self._long(i, queries[i]) for i in range(len(queries)) if len(queries[i]) > LONG]
        for a in range(0, len(short), QUERIES_AT_ONCE):
            found.append(self._scan(np.asarray(short[a:a + QUERIES_AT_ONCE]), queries))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def _mine(self, query: str, word: str) -> bool:
        """A pair that shares its first half is found in the forward list and left out in the other."""
        if self.backwards:
            query, word = query[::-1], word[::-1]
        m = min(len(query), len(word)) // 2
        return (query[:m] == word[:m]) != self.backwards

    def _long(self, number: int, query: str) -> tuple[np.ndarray, np.ndarray]:
        start = query[:half(len(query), self.backwards)]
        low, high = bisect_left(self.words, start), bisect_left(self.words, start + _AFTER)
        hits = []
        while low < high:
            word = self.words[low]
            if one_edit(query, word) and self._mine(query, word):
                hits.append(low)
            # one edit behind the shared letters, then as far as the two agree; the word's next letter is one edit too many
            at = _shared(query, word)
            dead = 1 + max(at + 1 + _shared(query[at + 1:], word[at + 1:]), at + 1 + _shared(query[at:], word[at + 1:]),
                           at + _shared(query[at + 1:], word[at:]))
            low = bisect_left(self.words, word[:dead] + _AFTER, low) if dead <= len(word) else low + 1
        return np.full(len(hits), number), np.asarray(hits, np.int64)

    def _scan(self, numbers: np.ndarray, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the banded matrix for all queries at once, one letter deeper a step."""
        texts = [queries[i] for i in numbers]
        n, size = len(texts), np.fromiter(map(len, texts), np.int64, len(texts))
        width = int(size.max()) + 3
        # query letters from column 1, so that there is a cell before the first; -1 is no letter, -2 one that no word here has
        own = np.full((n, width + 2), -1, np.int16)
        for i, q in enumerate(texts):
            own[i, 1:len(q) + 1] = self.code[np.frombuffer(q.encode("latin-1"), np.uint8)]
        begin = np.fromiter((half(len(q), self.backwards) for q in texts), np.int64, n)
        low = np.fromiter((bisect_left(self.kept, q[:p]) for q, p in zip(texts, begin.tolist())), np.int64, n)
        there = np.fromiter((i < len(self.kept) and self.kept[i].startswith(q[:p])
                             for i, q, p in zip(low.tolist(), texts, begin.tolist())), bool, n)
        q = np.zeros(0, np.int32)
        node, row = np.zeros(0, np.int32), np.zeros((3, 0), np.int8)
        hits_q, hits_w = [], []
        depth = int(begin[there].min(initial=width))
        starts = self.starts(depth)
        while depth <= self.letters.shape[1] and (len(q) or (begin[there] >= depth).any()):
            new = np.flatnonzero(there & (begin == depth))
            if len(new):  # all words of the interval share these letters with the query
                q = np.concatenate([q, new.astype(np.int32)])
                node = np.concatenate([node, (np.searchsorted(starts, low[new], "right") - 1).astype(np.int32)])
                row = np.concatenate([row, np.repeat(np.asarray([[1], [0], [1]], np.int8), len(new), axis=1)], axis=1)
            # a word that ends here is the first of its interval
            first = starts[node]
            gap = size[q] - depth
            ends = (self.size[first] == depth) & (np.abs(gap) <= 1)
            at = np.flatnonzero(ends)
            at = at[row[gap[at] + 1, at] == 1]
            hits_q.append(q[at])
            hits_w.append(first[at])
            # intervals one letter deeper: of each the first word, its letter, the interval above
            if depth >= self.letters.shape[1] - 1:
                break
            below = self.starts(depth + 1)
            letter = self.letters[below, depth]
            above = np.searchsorted(starts, below, "right") - 1
            real = letter > 0  # words that end here have no deeper interval
            child = np.full((len(starts), self.n_letters), -1, np.int32)
            child[above[real], letter[real]] = np.flatnonzero(real)
            kids = np.bincount(above[real], minlength=len(starts))
            kid_list, kid_from = np.flatnonzero(real).astype(np.int32), np.concatenate([[0], np.cumsum(kids)[:-1]])
            # while no edit is used any letter may follow; with one used, only letters of the query within the band
            free = (row == 0).any(axis=0)
            f = np.flatnonzero(free)
            many = kids[node[f]]
            rep = np.repeat(f, many)
            offset = np.arange(len(rep)) - np.repeat(np.cumsum(many) - many, many)
            to = [kid_list[np.repeat(kid_from[node[f]], many) + offset]]
            by = [rep]
            u = np.flatnonzero(~free)
            near = [own[q[u], depth + k] for k in range(3)]  # letters depth - 1, depth and depth + 1, from 0
            for k in range(3):
                fresh = (row[k, u] <= 1) & (near[k] > 0)
                for j in range(k):
                    fresh &= ~((near[k] == near[j]) & (row[j, u] <= 1))
                v = u[fresh]
                reached = child[node[v], near[k][fresh]]
                to.append(reached[reached >= 0])
                by.append(v[reached >= 0])
            to, by = np.concatenate(to), np.concatenate(by)
            depth += 1
            starts = below
            q, old = q[by], row[:, by]
            c = letter[to].astype(np.int16)
            differ = [(own[q, depth + k - 1] != c).astype(np.int8) for k in range(3)]
            r0 = np.minimum(old[0] + differ[0], old[1] + 1)
            r1 = np.minimum(np.minimum(old[1] + differ[1], old[2] + 1), r0 + 1)
            r2 = np.minimum(old[2] + differ[2], r1 + 1)
            row = np.stack([r0, r1, r2])
            alive = (row <= 1).any(axis=0)
            q, node, row = q[alive], to[alive], np.minimum(row[:, alive], 2).astype(np.int8)
        hq = np.concatenate(hits_q) if hits_q else np.zeros(0, np.int64)
        hw = np.concatenate(hits_w) if hits_w else np.zeros(0, np.int64)
        mine = np.fromiter((self._mine(texts[a], self.kept[b]) for a, b in zip(hq.tolist(), hw.tolist())), bool, len(hq))
        return numbers[hq[mine]], self.at[hw[mine]]

    def found(self, queries: list[str]) -> pd.DataFrame:
        """(word, n_near, form_n, form) of the queries that have partners in this range."""
        q, w = self.partners(queries)
        order = np.lexsort((self.order[w], -self.counts[w], q))
        q, w = q[order], w[order]
        first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
        turned = (lambda x: x[::-1]) if self.backwards else (lambda x: x)
        strings = lambda found: pd.Series(found, dtype="object")
        return pd.DataFrame({"word": strings([turned(queries[i]) for i in q[first].tolist()]),
                             "n_near": np.diff(np.append(first, len(q))), "form_n": self.counts[w[first]],
                             "form": strings([turned(self.words[i]) for i in w[first].tolist()])})


# ---------------------------------------------------------------- the sorted lists

def near_words(words: DataFrame, backwards: bool, range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, n_near, form_n, form): per word and range the partners there; ``words`` is (word, n)."""
    spark = words.sparkSession
    ranges = max(1, -(-words.count() // range_words))
    key = F.reverse("word") if backwards else F.col("word")
    listed = store(words.select(key.alias("key"), "n").repartitionByRange(ranges, "key").withColumn(
        "range", F.spark_partition_id()), "sorted-words")
    # a row per range: its first and last word, cut so that the table's size is bounded by the number of ranges
    cut = lambda c: F.substring(c, 1, LONG)
    bounds = listed.groupBy("range").agg(cut(F.min("key")).alias("low"), cut(F.max("key")).alias("high")).orderBy("range").collect()
    number, low, high = ([r[k] for r in bounds] for k in ("range", "low", "high"))
    shared = [low[i][:_shared(low[i], high[i])] for i in range(len(bounds))]
    sent = spark.sparkContext.broadcast((number, low, high, shared))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, low, high, shared = sent.value
        for batch in batches:
            keys, to = [], []
            for word, home in zip(batch["key"].tolist(), batch["range"].tolist()):
                start = word[:min(LONG, half(len(word), backwards))]
                for i in range(bisect_left(high, start), bisect_left(low, start + _AFTER)):
                    if number[i] != home and prefix_in_reach(shared[i], word):
                        keys.append(word)
                        to.append(number[i])
            yield pd.DataFrame({"key": pd.Series(keys, dtype="object"), "range": pd.Series(to, dtype="int32")})

    visitors = store(listed.select("key", "range").mapInPandas(visit, "key string, range int"), "visiting-words")
    # a range with many visitors is copied, and the copies share them
    copies = visitors.groupBy("range").agg((F.floor(F.count("*") / (4 * range_words)) + 1).cast("int").alias("copies"))
    at_home = listed.join(F.broadcast(copies), "range", "left").select(
        "range", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"), "key", "n")
    away = visitors.join(F.broadcast(copies), "range").select(
        "range", F.pmod(F.xxhash64("key"), F.col("copies")).cast("int").alias("copy"), "key", F.lit(None).cast("long").alias("n"))
    dealt = at_home.unionByName(away).repartition("range", "copy")
    dealt = dealt.sortWithinPartitions("range", "copy", F.col("n").isNull(), "key")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held, listing = None, [], None  # the range's words until its first visitor comes or the next range begins

        def close() -> Iterator[pd.DataFrame]:
            nonlocal listing
            if listing is None and held:
                rows = pd.concat(held)
                listing = SortedRange(rows["key"].tolist(), rows["n"].to_numpy(np.int64), backwards)
                if place[1] == 0:
                    yield listing.found(listing.words)

        for batch in batches:
            at = batch[["range", "copy"]].to_numpy()
            cuts = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(batch))):
                if (here := tuple(at[a])) != place:
                    yield from close()
                    place, held, listing = here, [], None
                part = batch.iloc[a:b]
                guest = part["n"].isna().to_numpy()
                if not guest.all():
                    held.append(part[~guest])
                if guest.any():
                    yield from close()
                    yield listing.found(part["key"][guest].tolist())
        yield from close()

    return dealt.mapInPandas(scan, FOUND)


def spelling_variants(docs: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root): the vocabulary of ``docs`` with each word's standard spelling.

    Null texts have no words, texts and words of any length count whole, equal
    documents count each. Of near words of equal count the smallest in code-point
    order is the form. An empty table, or one without such words, gives an empty
    result. Columns other than doc_id and text are not read.
    """
    words = store(vocabulary(docs), "vocabulary")
    found = near_words(words, False, range_words).unionByName(near_words(words, True, range_words))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    known = F.col("best.less") <= -FORM_TIMES * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(known, F.col("best.form")).alias("form"),
        F.when(known, -F.col("best.less")).alias("form_n"))
    rows = store(rows, "forms")
    return rows.join(roots(rows), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(rows: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, the forms followed to the last.

    A form is ten times as frequent, so a chain has a few links only. Each step
    doubles what a word has followed; finished words leave the loop.
    """
    now, done = store(rows.where("form is not null").select("word", F.col("form").alias("root")), "chains"), None
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = store(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                         F.col("next").isNotNull().alias("moved")), "chains")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now
