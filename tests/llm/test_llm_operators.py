"""Near-dedup, decontamination, tokens, packing, search, language, toxicity, pipeline against brute force."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from churnlab.llm import binary, decontaminate, langid, neardup, packing, rabitq, tokens, toxicity
from churnlab.llm import common
from churnlab.llm.common import new_folder

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, k1 string, node int, _n1 int, u int, bands int, "
          "ids string, start int")
WORDS = [f"w{i}x" for i in range(400)]


def make(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), "x", 1, 2, 3, 4, "z", 5) for i, t, lang, s in rows], SCHEMA)


def prose(rng, n):
    return " ".join(rng.choice(WORDS, n))


def edited(rng, text, edits):
    words = text.split()
    for at in rng.integers(0, len(words), edits):
        words[at] = "edited" + str(rng.integers(0, 10_000))
    return " ".join(words)


def corpus(rng):
    """Singles, exact copies, chains of near copies, one large group, odd rows."""
    rows = [(i, prose(rng, int(rng.integers(6, 300))), "en", f"s{i % 7}") for i in range(120)]
    base = prose(rng, 200)
    rows += [(200 + i, base if i % 3 == 0 else edited(rng, base, 1), "en", "s1") for i in range(60)]
    chain = prose(rng, 300)
    for i in range(8):
        rows.append((300 + i, chain, "en", f"s{i}"))
        chain = edited(rng, chain, 5)
    rows += [(400, None, "en", "s1"), (401, "", "en", "s1"), (402, "", "en", "s2"), (403, "a b", "en", "s1"), (404, "A, b!", "en", "s1"),
             (405, "...", "en", "s3"), (None, base, "en", "s1"), (None, prose(rng, 50), "en", "s1"), (rows[5]), (rows[5]),
             (406, " ".join(WORDS * 200), "en", "s1")]
    return rows


def reference_classes(rows, idf, threshold=0.8):
    texts = sorted({t for _, t, _, _ in rows if t is not None})
    sets = []
    for t in texts:
        _, h, w = neardup.weighted_shingles([t], idf)
        sets.append((h, w))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    close = 0
    for i in range(len(texts)):
        for j in range(i):
            s = neardup.weighted_jaccard(sets[i], sets[j])
            if s >= threshold:
                root[find(i)] = find(j)
                close += s < threshold + 0.03
    members = defaultdict(list)
    for i, t, _, _ in rows:
        if t is not None and i is not None:
            members[find(texts.index(t))].append(i)
    out = set()
    for i, t, _, _ in rows:
        if t is not None:
            found = members[find(texts.index(t))]
            out.add((i, min(found) if found else None))
    return out, close


def test_texts_that_share_half_their_key_stay_apart(spark, monkeypatch):
    """With 5 bits for the first half of the key nearly all texts share it."""
    few = lambda: tuple((F.pmod(k, F.lit(32)) if i == 0 else k).alias(f"k{i + 1}") for i, k in enumerate(common.text_key()))
    monkeypatch.setattr(neardup, "text_key", few)
    rows = corpus(np.random.default_rng(8))
    docs = make(spark, rows)
    got = {(r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == reference_classes(rows, neardup.idf_table(docs))[0]


def test_near_duplicates_against_brute_force(spark):
    rows = corpus(np.random.default_rng(3))
    docs = make(spark, rows)
    idf = neardup.idf_table(docs)
    got = neardup.near_duplicates(docs)
    want, _ = reference_classes(rows, idf)
    assert {(r["doc_id"], r["class_id"]) for r in got.collect()} == want
    classes = len({c for _, c in want if c is not None}) + 1  # one class has no doc_id at all
    assert got.where("stays").count() == classes
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == classes + 1  # and the null text
    assert neardup.near_duplicates(docs.limit(0)).count() == 0
    assert neardup.drop_near_duplicates(docs.limit(0)).count() == 0


def test_sampling_agrees_with_weighted_jaccard():
    rng = np.random.default_rng(8)
    a, b = prose(rng, 400), None
    b = " ".join(a.split()[:300] + prose(rng, 100).split())
    idf = np.ones(1 << neardup.IDF_BITS, np.float32)
    docs, h, w = neardup.weighted_shingles([a, b], idf)
    marks = neardup.consistent_samples(docs, h, w * np.float32(1.7), 2, samples=3000)
    want = neardup.weighted_jaccard((h[docs == 0], w[docs == 0]), (h[docs == 1], w[docs == 1]))
    assert abs((marks[0] == marks[1]).mean() - want) < 0.03


def test_pairs_near_the_threshold_share_a_band():
    """20,000 planted pairs of similarity 0.80 to 0.85: 8 bands of 3 samples miss about 40, the chance of one miss is now under 1 %."""
    rng = np.random.default_rng(11)
    n, size, missed = 4000, 120, 0
    for _ in range(5):
        hashes = np.sort(rng.integers(0, 1 << 52, (n, size), dtype=np.uint64), axis=1)
        changed = np.ceil(size * (1 - rng.uniform(0.80, 0.85, n)) / 2 * 1.05).astype(int)  # about (1 - s) / (1 + s) of the shingles
        other = hashes.copy()
        new = np.argsort(rng.random((n, size)), axis=1) < changed[:, None]
        other[new] = rng.integers(0, 1 << 52, int(new.sum()), dtype=np.uint64)
        same = (size - changed) / (size + changed)
        other = np.sort(other, axis=1)
        docs = np.repeat(np.arange(n), size)
        ones = np.full(n * size, 1.5, np.float32)
        a, b = (neardup.band_keys(neardup.consistent_samples(docs, x.ravel(), ones, n)) for x in (hashes, other))
        near = same >= neardup.THRESHOLD
        assert near.mean() > 0.8 and same.max() < 0.87
        missed += int((near & ~(a == b).any(axis=1)).sum())
    assert missed == 0


def test_bands_with_several_classes_are_compared_across(spark, monkeypatch):
    """With one-row bands nearly everything is a candidate; the second pass must find what leaders do not."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "FEATURES_AT_ONCE", 7)
    monkeypatch.setattr(neardup, "BANDS", 24)
    monkeypatch.setattr(neardup, "ROWS", 1)
    rng = np.random.default_rng(4)
    shared = prose(rng, 30)
    rows = []
    for g in range(6):
        base = shared + " " + prose(rng, 60)
        rows += [(10 * g + i, edited(rng, base, 1), "en", "s") for i in range(5)]
    docs = make(spark, rows)
    got = {(r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == reference_classes(rows, neardup.idf_table(docs))[0]


def test_containment_against_brute_force(spark):
    rng = np.random.default_rng(6)
    items = [(i, prose(rng, int(rng.integers(3, 90)))) for i in range(40)] + [(90, None), (91, ""), (92, items_word := "w1x w2x")]
    rows = [(i, prose(rng, int(rng.integers(1, 3000))), "en", "s") for i in range(60)]
    for i in range(40):
        words = items[i][1].split()
        cut = words[: max(1, int(len(words) * rng.choice([0.5, 0.85, 1.0])))]
        rows.append((100 + i, prose(rng, 700) + " " + ", ".join(cut).upper() + " " + prose(rng, 20), "en", "s"))
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, items_word, "en", "s"), (None, items[7][1], "en", "s"), rows[70], rows[70]]
    docs = make(spark, rows)
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    want = []
    for i, t, _, _ in rows:
        # an item of fewer than five words is looked for among shingles of as many words
        grams = [decontaminate.shingle_set(t or "", width) for width in range(1, 6)]
        for j, q in items:
            width = min(5, len(decontaminate.words_of(q or "")))
            own, grams_of_width = decontaminate.shingle_set(q or "", max(1, width)), grams[width - 1]
            if own and len(own & grams_of_width) / len(own) >= 0.8:
                want.append((i, j))
    got = [(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(docs, bench).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = decontaminate.decontaminate(docs, bench)
    bad = {i for i, _ in want}
    assert kept.columns == docs.columns
    assert sorted([r["doc_id"] for r in kept.collect()], key=repr) == sorted([r[0] for r in rows if r[0] not in bad], key=repr)
    assert decontaminate.find_items(docs.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK_BYTES", 300)
    rng = np.random.default_rng(9)
    items = [(i, prose(rng, 20)) for i in range(12)]
    docs = make(spark, [(i, prose(rng, 50) + " " + t, "en", "s") for i, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_items(docs, bench)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(i, i) for i in range(12)]


def tokenizer(name):
    import public_tokenizers

    return public_tokenizers.path(name)


ODD = ["", "  a  b\n\n c\t d ", " x", "a b c", "é é ́e", "a\x1cb \x1d", "don't  '  s 'S x'll", "<|endoftext|> a", "\n\n",
       "ΑΣ ΟΔΟΣ.", "x" * 3000, "日本 語 text\r\n a", "12 3.5 ab12cd ²x", "thoner$$$ to%%%, x", "a\nb\n c \nd", "a\tb  c", "a\n\tb  c d",
       "IT'S a'S_b", "e\u0301a \u00c9T\u00c9"]


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_ids_of_whole_texts(spark, name, keeps):
    texts = ODD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    enc = tokens.PieceEncoder(tokenizer(name), keeps)
    for t, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t
    assert enc.encode([None]) == [b""]


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_added_tokens_in_texts_get_the_ids_of_the_library(name, keeps):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer(name))
    enc = tokens.PieceEncoder(tokenizer(name), keeps)
    texts = ODD + ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y\n<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> a", "<|endoftext"]
    for t, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(t, add_special_tokens=False).ids, t
    end = library.token_to_id("<|endoftext|>")
    assert np.frombuffer(enc.encode(["a <|endoftext|> b"])[0], "<u2").tolist().count(end) == 1


def library_ids(name, text):
    from tokenizers import Tokenizer

    if name not in LIBRARY:
        LIBRARY[name] = Tokenizer.from_file(tokenizer(name))
    return np.asarray(LIBRARY[name].encode(text or "", add_special_tokens=False).ids, "<u4")


LIBRARY = {}


def test_token_records_round_trip(spark, tmp_dir):
    rows = [(i * 7 % 50, t, "en", "s") for i, t in enumerate(ODD * 3)] + [(None, "first", "en", "s"), (60, None, "en", "s")]
    docs = make(spark, rows)
    folder = f"file://{tmp_dir}/records"
    index = binary.write_token_files(docs, folder, tokenizer("byte_bpe_50k.json"), 2, docs_per_file=20)
    order = sorted([(i, t or "") for i, t, _, _ in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    at, want = 0, []
    for i, t in order:
        ids = np.append(library_ids("byte_bpe_50k.json", t), 2).astype("<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [tuple(r) for r in binary.token_digests(index, folder).orderBy("start").collect()]
    assert got == want
    shuffled = binary.read_token_files(index.orderBy(F.rand(1)), folder)
    assert shuffled.where("octet_length(ids) <> 4 * n_tokens").count() == 0 and shuffled.count() == len(rows)
    empty = new_folder(spark, "empty-records")
    none = binary.write_token_files(docs.limit(0), empty, tokenizer("byte_bpe_50k.json"), 2)
    assert binary.token_digests(none, empty).count() == 0


def test_damaged_records_are_refused():
    record = binary.frame(b"\x02payload")
    assert binary.unframe(record) == b"\x02payload"
    for at in (0, 9, 14, len(record) - 1):
        damaged = bytearray(record)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            binary.unframe(bytes(damaged))
    with pytest.raises(ValueError):
        binary.unframe(record[:10])


def test_cut_lengths_fill_their_class():
    for n in list(range(1, 9000, 37)) + [4096, 4097, 8192, 2048, 1365, 1366]:
        cut = packing.cut_lengths(n)
        assert sum(cut) == n and max(cut) <= packing.CAPACITY
        for piece in cut:
            k = packing.CAPACITY // piece
            assert k >= packing.WHOLE_FROM or piece * k >= packing.CAPACITY - k


def test_packing_places_every_id_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_WORKER", 20)
    monkeypatch.setattr(packing, "MERGED", 3)
    rng = np.random.default_rng(2)
    rows = [(i, prose(rng, int(rng.integers(1, 2500))), "en", "s") for i in range(80)]
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (None, "a b", "en", "s"), rows[0], rows[0]]
    docs = make(spark, rows)
    got = packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), 2, with_ids=True).toPandas()
    want = sum(len(library_ids("word_bpe_49k.json", t)) + 1 for _, t, _, _ in rows)
    pieces = got[got["doc_id"].isin([3, 200])].sort_values(["doc_id", "start"]).groupby("doc_id")["ids"].agg(b"".join)
    assert pieces[3] == np.append(library_ids("word_bpe_49k.json", rows[3][1]), 2).astype("<u4").tobytes()
    assert pieces[200] == np.asarray([2], "<u4").tobytes()
    levels = got["sequence_id"].to_numpy() >> 60
    assert got["sequence_id"].min() >= 0 and {0, 1, packing.LAST_LEVEL} <= set(levels)
    assert got["length"].sum() == want
    assert (got["ids"].map(len) == 4 * got["length"]).all()
    assert (got["ids"].map(zlib.crc32) == got["ids_crc32"]).all()
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == (g["length"].cumsum() - g["length"]).tolist()
        assert g["length"].sum() <= packing.CAPACITY
    assert want / got["sequence_id"].nunique() / packing.CAPACITY > 0.95
    assert packing.pack_documents(docs.limit(0), tokenizer("word_bpe_49k.json"), 2).count() == 0


def test_search_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(12)
    for dim in (24, 64, 100):
        vectors = rng.normal(size=(600, dim)).astype(np.float32)
        vectors[300:340] = vectors[300]
        rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
        rows += [(1000, None, 0), (1100, [0.0] * dim, 0), (1200, [float("nan")] * dim, 0), (1300, [1.0] * (dim - 1) + [None], 0),
                 (1400, [float("inf")] + [1.0] * (dim - 1), 0), (None, [1.0] * dim, 0), (1500, [1.0, 2.0], 0), (1600, [1.0, 3.0], 0)]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code int")
        index, middle = rabitq.build_index(table)
        got = rabitq.search_index(index, middle, index.where("vec_id % 100 = 0").select("vec_id", "row", "dim", "vector"), 10, query_block=4)
        found = defaultdict(list)
        for r in got.orderBy("query_id", "rank").collect():
            found[r["query_id"]].append((r["score"], r["vec_id"]))
        assert set(found) == {0, 100, 200, 300, 400, 500, 1500, 1600}
        hits = 0
        v = vectors.astype(float)
        for q in range(0, 600, 100):
            d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
            d[q] = np.inf
            best = np.lexsort((np.arange(600), d))[:10]
            hits += len(set(best.tolist()) & {i for _, i in found[q]})
            assert found[q] == sorted(found[q]) and np.allclose([s for s, _ in found[q]], d[[i for _, i in found[q]]])
        assert hits / 60 >= 0.95
        assert [i for _, i in found[300]] == list(range(301, 311))
        assert found[1500] == [(1.0, 1600)]
    empty = table.limit(0)
    index, middle = rabitq.build_index(empty)
    assert rabitq.search_index(index, middle, index.select("vec_id", "row", "dim", "vector")).count() == 0


def test_search_with_repeated_ids_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 16))
    ids = [i // 3 * 100 if i < 30 else i for i in range(300)]
    vectors[1] = vectors[0]
    index, middle = rabitq.build_index(spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>"))
    queries = index.where("vec_id % 100 = 0")
    got = rabitq.search_index(index, middle, queries.select("vec_id", "row", "dim", "vector"), 10, query_block=7).collect()
    want = []
    for q in range(300):
        if ids[q] % 100 == 0:
            d = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
            others = sorted((round(d[j], 9), ids[j]) for j in range(300) if j != q)[:10]
            want += [(ids[q], rank, i, s) for rank, (s, i) in enumerate(others, 1)]
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == sorted(want)


def test_items_of_one_to_four_words_are_found_inside_documents(spark):
    docs = make(spark, [(1, "what is the Capital of Peru, is it Lima or not", "en", "a"), (2, "capital of peru", "en", "a"),
                        (3, "of the capital Peru is", "en", "a"), (3, "lima", "en", "a"), (4, None, "en", "a"),
                        (5, "word " * 30_000 + "capital of Peru is", "en", "a")])
    items = spark.createDataFrame([(1, "Capital of Peru is"), (2, "capital of Peru"), (3, "LIMA"), (4, "is it"), (5, "..."), (6, None),
                                   (7, "one two three four five"), (None, "peru is")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.containment, r.n_shingles) for r in decontaminate.find_items(docs, items).collect()}
    words = {(r.doc_id, r.text): decontaminate.words_of(r.text or "") for r in docs.collect()}
    want = set()
    for (doc_id, _), w in words.items():
        for r in items.collect():
            item = decontaminate.words_of(r.text or "")
            if 0 < len(item) < 5 and any(w[i:i + len(item)] == item for i in range(len(w))):
                want.add((doc_id, r.item_id, 1.0, 1))
    assert got == want and (5, 1, 1.0, 1) in got and (1, 2, 1.0, 1) in got

def test_language_model_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit_language_model(docs.where(~langid.held_out(F.col("doc_id"))))
    p = langid.predict_language(F.col("text"), model, spark)
    got = docs.where(langid.held_out(F.col("doc_id"))).select("lang", p.alias("p")).select("lang", "p.*").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97
    assert got["rejected"].mean() < 0.01
    odd = make(spark, [(1, None, None, None), (2, "", None, None), (3, "12 _ !!", None, None), (4, "a" * 200_000, None, None),
                       (4, "the of and", None, None)])
    seen = {(r["doc_id"], r["t"]): r["p"] for r in odd.select("doc_id", F.substring("text", 1, 3).alias("t"), p.alias("p")).collect()}
    assert all(seen[k]["lang_pred"] == "und" and seen[k]["rejected"] and seen[k]["score"] == 0 for k in [(1, None), (2, ""), (3, "12 ")])
    assert seen[(4, "the")]["lang_pred"] in model.languages
    assert langid.fit_language_model(odd) is None
    assert langid.keep_known_language(odd).count() == 0
    kept = langid.keep_known_language(docs)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()


def test_bags_sum_to_the_batch(spark):
    texts = ["Ab cé d", "", "x", "hello hello", "12"]
    for text, counts in zip(texts, zip(*[c for c, _ in langid.subwords(texts)])):
        assert sum(counts) == sum(len(b) for _, b in langid.subwords([text]))


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 3000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("doc_id < 3000")
    got = toxicity.score_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    pos, neg = got[got["toxic"] == 1]["score"].to_numpy(), got[got["toxic"] == 0]["score"].to_numpy()
    auc = (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()
    assert auc > 0.85
    assert (got[got["toxic"] == 0]["predicted"] == 0).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_toxicity_odd_inputs(spark):
    docs = make(spark, [(1, None, None, None), (2, "", None, None), (2, "", None, None), (None, "You idiot!", None, None), (3, "w " * 50_000, None, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, none).collect()
    assert len(got) == 5 and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    assert toxicity.score_documents(docs.limit(0), none).count() == 0
    maker = toxicity.Features(["blurgh"], [b"slurry"])
    table = maker.table(["You are an 1d10t", "plain words", "IDIOT", "slurryish blurgh", ""])
    at = toxicity.FEATURES.index
    assert table[0, at("obfuscated_hits")] == 1 and table[1].tolist()[1:8] == [0] * 7
    assert table[2, at("given_any")] == 1 and table[2, at("shouted")] == 1
    assert table[3, at("stems_any")] == 1 and table[3, at("learned_any")] == 1


def test_pipeline_stages_against_brute_force(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(9001, None, "en", "s", None), (9002, "", None, None, 0), (9003, "12 34", "en", "s", 5)], base.schema)
    docs = base.unionByName(odd).unionByName(base.limit(3))
    folder = new_folder(spark, "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
            out.write.parquet(f"{folder}/{name}")
            now = spark.read.parquet(f"{folder}/{name}")
            seen.append(now.select("doc_id", "text").toPandas())
    first, lines, near, clean = seen
    assert 9001 not in set(first["doc_id"]) and 9003 not in set(first["doc_id"])
    assert len(lines) == len(first)
    assert near["doc_id"].is_unique and len(near) <= len(lines)
    items = [decontaminate.shingle_set(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = {d for d, t in zip(near["doc_id"], near["text"])
             if any(q and len(q & decontaminate.shingle_set(t)) / len(q) >= 0.8 for q in items)}
    assert set(clean["doc_id"]) == set(near["doc_id"]) - dirty
    packed = corpus_pipeline.run(spark, folder).toPandas()
    totals = packed.groupby("doc_id")["length"].sum().to_dict()
    assert totals == {d: len(library_ids("word_bpe_49k.json", t)) + 1 for d, t in zip(clean["doc_id"], clean["text"])}


ALPHABET = [*"aabcdeXYZ  \n\t,.'’0²½Ⅷ-_!<|>", " ", " ", "　", "\u0085", "​", "İ", "ı", "ß", "Σ", "ς", "é", "é", "́",
            "̇", "\r", "\r\n", "\x0b", "\x0c", "日本", "한", "가", "ﬁ", "Å", "Å", "😀", "'s", "'LL", " \n", "  ", "  ",
            "ª", "ʰ", "\x1c", "\x00", "ا", "ِ", "क", "्", "<|endoftext|>"]


@pytest.mark.parametrize("name,keeps_space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_of_random_texts_equal_a_fresh_library_instance(name, keeps_space):
    from tokenizers import Tokenizer

    fresh, enc = Tokenizer.from_file(tokenizer(name)), tokens.PieceEncoder(tokenizer(name), keeps_space)
    rng = np.random.default_rng(5)
    texts = ["a b\n ", "a\tb\n ", "İ, a", "T.C. İ.", *["".join(rng.choice(ALPHABET, rng.integers(1, 15))) for _ in range(40_000)]]
    for text, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, f"<u{enc.width}").tolist() == fresh.encode(text, add_special_tokens=False).ids, ascii(text)
