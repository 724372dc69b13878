"""Shared helpers, sharding, licences, line dedup: brute force and odd inputs."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.llm import common, graph, licenses, linededup, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, _lines int, _gone int, band int"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "x", 1, 2, 3) for i, t, s in rows], SCHEMA)


def test_words_agree_with_the_pattern():
    texts = ["Ab c_d, é1!", "", "ÉCOLE naïve—x", "¿Qué? 10.5", "a b　c", "İstanbul"]
    docs, hashes = common.word_hashes(texts)
    want = [w for t in texts for w in common.words_of(t)]
    assert len(hashes) == len(want)
    assert docs.tolist() == [i for i, t in enumerate(texts) for _ in common.words_of(t)]
    by = defaultdict(set)
    for w, h in zip(want, hashes.tolist()):
        by[w].add(h)
    assert all(len(v) == 1 for v in by.values()) and len({h for v in by.values() for h in v}) == len(by)


def test_shingles_of_short_and_repeated_texts():
    docs, hashes, tf = common.shingle_counts(["a b", "", "a b c d e a b c d e", "a b", "b a"])
    assert np.bincount(docs, minlength=5).tolist() == [1, 0, 5, 1, 1]
    assert hashes[docs == 0].tolist() == hashes[docs == 3].tolist() != hashes[docs == 4].tolist()
    assert sorted(tf[docs == 2].tolist()) == [1, 1, 1, 1, 2]


def test_components_of_chains_hubs_and_loops(spark):
    chain = [(i, i + 1) for i in range(40, 70)]
    hub = [(1000, i) for i in range(1, 30)]
    edges = spark.createDataFrame(chain + hub + [(500, 500)], "u long, v long")
    got = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert all(got[i] == 40 for i in range(40, 71))
    assert all(got[i] == 1 for i in list(range(1, 30)) + [1000])
    assert got[500] == 500
    assert graph.components(edges.limit(0)).count() == 0


def jump_reference(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_against_the_paper_and_growth():
    keys = np.random.default_rng(1).integers(0, 1 << 60, 3000)
    for shards in (1, 2, 7, 40):
        got = sharding.jump_hash(keys, shards)
        assert got.tolist() == [jump_reference(int(k), shards) for k in keys]
        more = sharding.jump_hash(keys, shards + 1)
        assert set(more[more != got].tolist()) <= {shards}


def test_shards_and_slots(spark):
    rows = make(spark, [(i % 50, "t", "a") for i in range(300)] + [(None, None, None)])
    got = sharding.slots(sharding.assign_shards(rows, 8), ["doc_id", "text"]).collect()
    assert len(got) == 301
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    shard = defaultdict(set)
    for r in got:
        shard[r["doc_id"]].add(r["shard"])
    assert all(len(v) == 1 for v in shard.values())
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got)
    assert sharding.slots(sharding.assign_shards(rows.limit(0), 8), ["doc_id"]).count() == 0


def test_slots_follow_the_order_at_any_number_of_blocks(spark, monkeypatch):
    """The order of the registered SQL: ORDER BY doc_id, text_crc32, size, nulls last."""
    rng = np.random.default_rng(6)
    rows = [(int(i), int(c), int(n)) for i, c, n in zip(rng.integers(0, 200, 1500), rng.integers(0, 1 << 32, 1500), rng.integers(0, 99, 1500))]
    rows += [(77, int(c), 5) for c in rng.integers(0, 1 << 32, 700)] + [(None, 3, 1), (None, 1, 1), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text_crc32 long, size long")
    for per_block in (25, 300, 100_000):
        # the old rule took 8 * ROWS_PER_BLOCK rows for a block
        monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", per_block)
        got = sharding.slots(sharding.assign_shards(docs, 4), ["doc_id", "text_crc32", "size"]).collect()
        by = defaultdict(list)
        for r in got:
            by[r["shard"]].append((r["slot"], r["doc_id"], r["text_crc32"], r["size"]))
        assert sum(map(len, by.values())) == len(rows)
        for numbered in by.values():
            numbered.sort()
            assert [x[0] for x in numbered] == list(range(len(numbered)))
            keys = [(x[1] is None, x[1] or 0, x[2], x[3]) for x in numbered]
            assert keys == sorted(keys)


def test_slots_leave_the_callers_columns_alone(spark):
    rows = spark.createDataFrame([(i, i % 2, 7, 8, 9, 5) for i in range(20)], "doc_id long, shard int, _block int, _start int, _n int, slot int")
    got = sharding.slots(rows, ["doc_id"]).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in ("_block", "_start", "_n", "slot")) for r in got] == [(7, 8, 9, i // 2) for i in range(20)]


def test_write_shards_round_trip(spark, tmp_dir):
    rows = make(spark, [(i, "t", "a") for i in range(100)])
    sharding.write_shards(rows, f"{tmp_dir}/s", 5, rows_per_file=10)
    back = spark.read.parquet(f"{tmp_dir}/s")
    assert back.count() == 100
    assert back.join(sharding.assign_shards(rows, 5).select("doc_id", F.col("shard").alias("want")), "doc_id").where(
        "shard <> want").count() == 0


def test_licence_digests_and_spellings(spark, monkeypatch):
    mit = dict(licenses.KNOWN[::-1])["MIT"]
    rows = [(1, "Copyright (c) 2020 A. Body\n" + mit.upper().replace("LICENSE", "LICENCE"), "a"),
            (2, mit + " more", "a"), (3, None, "a"), (4, "", "a"), (5, "...", "a"),
            (6, "text\n  released under the MIT licence\ntext", "a"), (6, "text\n  released under the MIT licence\ntext", "a"),
            (None, "Licensed under CC BY-NC 4.0", "a"), (7, "word " * 50_000, "a")]
    docs, known = make(spark, rows), licenses.known_licenses(spark)
    got = licenses.scan_texts(docs, known).collect()
    assert len(got) == len(rows)
    ids = {r["doc_id"]: r["license_id"] for r in got}
    assert ids[1] == "MIT" and ids[None] == "CC-BY-NC-4.0" and ids[2] is ids[3] is ids[7] is None
    assert {r["doc_id"] for r in got if r["digest"] is None} == {3, 4, 5}
    scanned = licenses.scan_rows(docs, known).collect()
    assert sorted(((r["doc_id"], r["digest"], r["license_id"]) for r in scanned), key=str) == sorted(
        ((r["doc_id"], r["digest"], r["license_id"]) for r in got), key=str)
    notices = {r["doc_id"]: r["notice_ids"] for r in scanned}
    assert notices[6] == ["MIT"] and notices[None] == ["CC-BY-NC-4.0"] and notices[7] is notices[3] is notices[2] is None
    # rows that share a doc_id keep notices of their own, also where the digests go out in parts
    rows = [(1, mit, "a"), (1, "quite another text", "a"), (None, "so\nLicensed under CC BY-NC 4.0\nreleased under the MIT license", "a"),
            (None, "nothing", "a")]
    for bound in (licenses.BROADCAST_BYTES, 1000):
        monkeypatch.setattr(licenses, "BROADCAST_BYTES", bound)
        found = {r["digest"]: r["notice_ids"] for r in licenses.scan_rows(make(spark, rows), known).collect()}
        assert found[licenses.text_digest("quite another text")] is None and found[licenses.text_digest("nothing")] is None
        assert found[licenses.text_digest(rows[2][1])] == ["CC-BY-NC-4.0", "MIT"]
    assert licenses.scan_texts(docs.limit(0), known).count() == 0


def test_full_licence_texts_are_known(spark):
    wanted = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0",
              "CC0-1.0": "CC0-1.0", "Artistic": "Artistic-1.0-Perl", "GFDL-1.3": "GFDL-1.3"}
    rows, want = [], {}
    for name, license_id in wanted.items():
        with open(f"/usr/share/common-licenses/{name}") as f:
            text = f.read()
        paragraphs = "\n\n".join(" ".join(p.split()) for p in re.split(r"\n\s*\n", text))
        for t in (text, paragraphs, text.upper(), text.split("END OF TERMS AND CONDITIONS")[0], "Copyright 2020 A. Body\n" + text):
            want[len(rows)] = license_id
            rows.append((len(rows), t, "a"))
    want[len(rows)] = None
    rows.append((len(rows), text + " and more", "a"))
    got = licenses.scan_texts(make(spark, rows), licenses.known_licenses(spark)).collect()
    assert {r["doc_id"]: r["license_id"] for r in got} == want


def test_canonical_form():
    assert licenses.canonical("(C) 2020 Me\nThe Licence licence, NON-COMMERCIAL non commercial\n © x\nAll rights reserved.") == (
        b"the license license noncommercial noncommercial")
    assert licenses.canonical("No copyright here") == b"no copyright here"
    assert licenses.canonical("...") == b"" and licenses.text_digest("...") is None is licenses.text_digest(None)


def reference_lines(rows, min_sites):
    sites, first = defaultdict(set), {}
    for i, t, s in rows:
        for p, line in enumerate((t or "").split("\n") if t is not None else []):
            if line.strip(" ") and s is not None:
                sites[line.strip(" ")].add(s)
    order = sorted([r for r in rows if r[1] is not None], key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, t, s in order:
        for p, line in enumerate(t.split("\n")):
            key = line.strip(" ")
            if len(sites[key]) >= min_sites and key not in first:
                first[key] = (i, t, p)
    for i, t, s in rows:
        out.append((i, None if t is None else "\n".join(
            line for p, line in enumerate(t.split("\n"))
            if not line.strip(" ") or len(sites[line.strip(" ")]) < min_sites or first[line.strip(" ")] == (i, t, p))))
    return sorted(out, key=repr)


def test_line_dedup_against_brute_force(spark):
    rng = np.random.default_rng(5)
    lines = [f"line {i}" for i in range(12)] + ["", "  ", " line 3 "]
    rows = [(int(i), "\n".join(rng.choice(lines, rng.integers(0, 9))), f"s{rng.integers(0, 9)}") for i in range(150)]
    rows += [rows[3], rows[3], (900, None, "s1"), (901, "line 1", None), (902, "", "s2"),
             (903, "\n".join(["line 1"] * 20_000 + ["own"]), "s3"), (None, "line 2\nnew", "s4")]
    docs = make(spark, rows)
    for min_sites in (3, 8, 9):
        got = linededup.dedup_lines(docs, min_sites=min_sites)
        assert got.columns == docs.columns
        assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=repr) == reference_lines(rows, min_sites)
    assert got.where("text is not null and n_chars <> length(text)").count() == 0
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_plan_has_no_python(spark):
    docs = make(spark, [(1, "a\nb", "s")])
    plan = linededup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


def test_many_sites_are_decided_by_the_sketch(spark):
    docs = make(spark, [(i, f"boiler\nown {i}", f"site{i}") for i in range(400)])
    got = linededup.dedup_lines(docs, min_sites=100, counted=True).collect()
    assert sum(r["lines_removed"] for r in got) == 399
    none = linededup.dedup_lines(docs, min_sites=401, counted=True).where("lines_removed > 0").count()
    assert none == 0


@pytest.mark.parametrize("shards", [0, -1])
def test_shard_count_is_checked(shards):
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit(1), shards)
