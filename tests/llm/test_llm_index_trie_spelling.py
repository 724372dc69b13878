"""Digest index, prefix trie and spelling variants against brute force and odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.llm import digestindex, prefixtrie, spelling
from churnlab.llm.common import join_groups, new_folder
from churnlab.llm.queries import queries

DOCS = "doc_id long, text string, digest string, best int, range int, word string, n int, _digest int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", 3, 4) for i, t in rows], DOCS)


# ---------------------------------------------------------------- digest index

def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        best = min(groups[bare(t)], key=lambda x: x[:3])
        out.append((i, best[3], len(groups[bare(t)]), hashlib.sha256(bare(t).encode()).hexdigest()))
    return out


def text_rows():
    rng = random.Random(5)
    rows = [(i, rng.choice(["a b", "ab", "a  b\n", "c", "\t", "", None, "d\x0be", "de", "é x", "éx ", "x" * 300_000]))
            for i in range(300)]
    rows += [(None, "a b"), (None, "alone"), (7, "a   b    "), (7, "a   b    "), (7, "a   b    "), (8, "x y"), (9, "xy")]
    return rows + [(1000 + i, "hot text") for i in range(900)]


def test_digest_index_against_brute_force(spark):
    rows = text_rows()
    docs = docs_of(spark, rows)
    index = digestindex.DigestIndex(spark, new_folder(spark, "index"), buckets=3)
    parts = [docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 <> 0 or doc_id is null")]
    for part in parts:
        index.add(digestindex.digest_rows(part))
    got = digestindex.memberships(digestindex.digest_rows(docs), index.groups()).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(expected_groups(rows))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {e[3] for e in expected_groups(rows)}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_digest_index_is_read_again_and_ignores_unfinished_deliveries(spark):
    folder = new_folder(spark, "index")
    first = docs_of(spark, [(1, "one"), (2, "two"), (3, "o n e")])
    assert sorted(r.doc_id for r in digestindex.keep_new(first, digestindex.DigestIndex(spark, folder, buckets=2)).collect()) == [2, 3]
    again = digestindex.DigestIndex(spark, folder)  # another session's view of the same files
    assert again.buckets == 2
    half = digestindex.digest_rows(docs_of(spark, [(9, "three")])).groupBy("digest").agg(
        F.count("*").alias("n"), F.min(digestindex._place()).alias("best")).withColumn("delivery", F.lit("died"))
    again._append(half, "entries")
    second = docs_of(spark, [(4, "o n  e"), (5, "three"), (6, "three"), (6, "three"), (None, "four")])
    new = digestindex.keep_new(second, again)
    assert new.columns == second.columns
    assert sorted((r.doc_id or 0, r.text) for r in new.collect()) == [(0, "four"), (5, "three")]
    assert digestindex.keep_new(second.limit(0), again).count() == 0
    sizes = {r.group_size for r in again.groups().collect()}
    again.close()
    assert sizes == {3, 1}
    # closed, the files are still there for the next one
    assert digestindex.DigestIndex(spark, folder).groups().count() == 4


def test_digest_index_joins_in_buckets_without_python(spark):
    index = digestindex.DigestIndex(spark, new_folder(spark, "index"), buckets=8)
    rows = digestindex.digest_rows(docs_of(spark, [(1, "a"), (2, "b")]))
    index.add(rows)
    folded = rows.groupBy("digest").agg(F.count("*").alias("n"))
    plan = folded.join(index._read("entries").select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "SortMergeJoin" in physical and physical.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in physical
    whole = digestindex.memberships(rows, index.groups())._jdf.queryExecution().toString()
    assert "Python" not in whole and "Pandas" not in whole


def test_join_groups_splits_off_large_groups(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("size"))
    got = join_groups(rows, groups, ["k"], "size", 50_000)
    assert got.count() == 50_000 and got.where("k = 0").agg(F.min("size")).first()[0] == 16_667


# ---------------------------------------------------------------- prefix trie

TURNS = "conv_id long, turn long, role string, text string, depth int, block int, shared string"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "z") for r in rows], TURNS)


def expected_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [t[3] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in own.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        convs[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = Counter(node[:-1] for node in members if node)
    saved, leaves = Counter(), Counter()
    for node, who in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(who) - 1) * (len(node[-1][1]) if node else 0)
            leaves[node[:d]] += not kids[node]
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(convs[c]) == len(node)))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), kids[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversation_rows(seed):
    rng = random.Random(seed)
    words = ["hi", "hello", "", None, "é" * 5, "ok then", "long " * 2000]
    rows = []
    for c in [*range(120), *range(198, 230), *range(505, 530), -7, -100, -150, 2**40 + 3]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 9])):
            rows.append((c, t, rng.choice(["user", "bot", None]) if t else "user", rng.choice(words) if rng.random() < .7 else f"w{rng.random()}"))
    rows += [(300, None, "a", "x"), (300, None, "a", "x"), (300, 1, "a", "y"), (300, 1, "a", "b"), (None, 1, "a", "b")]
    for c in (700, 701, 702, 707):  # long copies and a common beginning
        rows += [(c, t, "user", f"turn {t % 50}") for t in range(150)]
    rows += [(c, 0, "user", "same first turn") for c in range(800, 900)] + [(c, 1, "bot", f"answer {c % 40}") for c in range(800, 900)]
    return rows


@pytest.mark.parametrize("bits", [None, 14])
def test_trie_against_brute_force(spark, bits):
    rows = conversation_rows(3)
    got = prefixtrie.prefix_trie(turns_of(spark, rows), bits).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_trie(rows)


def test_trie_with_a_sketch_that_screens_almost_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK_BITS", 4)
    rows = conversation_rows(4)
    got = prefixtrie.prefix_trie(turns_of(spark, rows), 5).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_trie(rows)


def test_sketch_never_counts_too_little_and_proves_most_singles(spark):
    rng = np.random.default_rng(1)
    single, twice = rng.integers(-2**62, 2**62, (5000, 2)), rng.integers(-2**62, 2**62, (500, 2))
    rows = spark.createDataFrame([(int(a), int(b), int(a), int(b), 2) for a, b in np.concatenate([single, twice, twice])],
                                 "d1 long, d2 long, u1 long, u2 long, depth int").repartition(5)
    got = prefixtrie.screened(rows, 16).groupBy("d1", "d2").agg(F.min("shared").alias("s"), F.min("up_shared").alias("u")).collect()
    shared = {(r.d1, r.d2) for r in got if r.s}
    assert {tuple(x) for x in twice.tolist()} <= shared and len(shared) < 600 and all(r.s == r.u for r in got)


def test_trie_of_an_empty_table_and_of_turnless_conversations(spark):
    assert prefixtrie.prefix_trie(turns_of(spark, [(None, 1, "a", "b")])).count() == 0
    rows = [(c, 0, "a", "b") for c in range(101, 110)]
    got = prefixtrie.prefix_trie(turns_of(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_trie(rows)


# ---------------------------------------------------------------- spelling variants

def expected_words(rows):
    lower = {c: c + 32 for c in range(65, 91)}
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = sorted(w for w, k in n.items() if len(w) >= 7 and k >= 2)

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        i = 0
        while i < min(len(a), len(b)) and a[i] == b[i]:
            i += 1
        return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]

    out, forms = [], {}
    for w in words:
        partners = [v for v in words if near(w, v)]
        best = min(partners, key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best and n[best] >= 10 * n[w] else None
        out.append((w, len(partners)))
    result = []
    for w, k in out:
        root = w
        while forms[root]:
            root = forms[root]
        result.append((w, forms[w], root, n[w], k, n[forms[w]] if forms[w] else None))
    return sorted(result, key=str)


def spelling_rows(seed, letters="abÀÿ÷x"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.choice([7, 7, 8, 9, 12]))) for _ in range(25)] + ["Common" * 14]

    def variant(w):
        at, kind = rng.randrange(len(w)), rng.random()
        return w[:at] + ("" if kind < .3 else rng.choice(letters)) + w[at + (kind < .7):]

    rows, i = [], 0
    for b in base:
        once = [variant(b) for _ in range(8)]
        for w, k in [(b, 300)] + [(v, 25) for v in once] + [(variant(v), 2) for v in once]:
            for _ in range(k):
                rows.append((i, w))
                i += 1
    rng.shuffle(rows)
    rows = [(i, " ".join(w for _, w in rows[j:j + 40]).replace("x", "X")) for i, j in enumerate(range(0, len(rows), 40))]
    return rows + [(None, rows[0][1] + "\n" + "longword" * 20_000 + " " + "longword" * 20_000 + "s"), (5, None), (6, ""),
                   (9, "short abc"), (10, "longword" * 20_000), (11, "longword" * 20_000 + "s"), (12, "日本語 abcdefgh abcdefgi"), rows[1], rows[1]]


@pytest.mark.parametrize("range_words", [20_000, 40])
def test_spelling_against_brute_force(spark, range_words):
    rows = spelling_rows(1)
    got = spelling.spelling_variants(docs_of(spark, rows), range_words).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_words(rows)


def test_spelling_of_words_that_share_a_hot_half(spark):
    rng = random.Random(2)
    words = {"aaaaaaaa" + "".join(rng.choice("abcd") for _ in range(rng.choice([3, 4, 5]))) for _ in range(400)}
    words |= {w[::-1] for w in words}
    rows = [(i, " ".join(words)) for i in range(3)]
    got = spelling.spelling_variants(docs_of(spark, rows), 50).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_words(rows)


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(docs_of(spark, [(1, None), (2, "few words")])).count() == 0


def test_scan_equals_brute_force_in_both_directions():
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([7, 8, 9]))) for _ in range(1500)})
    lists = [spelling.SortedRange(sorted(ws), np.ones(len(words), np.int64), back)
             for ws, back in ((words, False), ([w[::-1] for w in words], True))]
    found = Counter()
    for r in lists:
        q, w = r.partners(r.words)
        turn = (lambda x: x[::-1]) if r.backwards else (lambda x: x)
        found.update((turn(r.words[a]), turn(r.words[b])) for a, b in zip(q.tolist(), w.tolist()))
    assert found == Counter((a, b) for a in words for b in words if spelling.one_edit(a, b))


def test_queries_are_registered():
    assert {"op11_digest_index", "op12_prefix_trie", "op13_spelling_variants"} <= queries().keys()
