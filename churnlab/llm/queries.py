"""Registered queries of this subpackage and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from churnlab.llm import (
    binary, decontaminate, digestindex, langid, licenses, linededup, neardup, packing, prefixtrie, rabitq, sharding, spelling,
    toxicity,
)
from churnlab.llm.common import documents, new_folder, store
from churnlab.llm.licence_texts import EQUIVALENT, KNOWN

SHARDS = 40
END_ID = 2
QUERY_EVERY, NEIGHBOURS = 100, 10


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_icws_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = neardup.near_duplicates(docs).select("doc_id", "class_id", "stays", "copies")
    alone = docs.where("text is null").groupBy("doc_id").agg(F.count("*").alias("copies")).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("stays"), "copies")
    return found.unionByName(alone)


def op2_gbt_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), toxicity.labels_of(spark, sf_dir)).select(
        "doc_id", "held_out", "score", "predicted", "raw_score")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-records")
    index = binary.write_token_files(documents(spark, sf_dir), folder, _tokenizer("byte_bpe_50k.json"), END_ID)
    return binary.token_digests(index, folder)


def op4_rabitq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, middle = rabitq.build_index(rabitq.embeddings(spark, sf_dir))
    queries = index.where(F.col("vec_id") % QUERY_EVERY == 0).select("vec_id", "row", "dim", "vector")
    return rabitq.search_index(index, middle, queries, NEIGHBOURS)


def op5_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = langid.held_out(F.col("doc_id"))
    model = langid.fit_language_model(docs.where(~out))
    found = langid.predict_language(F.col("text"), model, spark)
    return docs.select("doc_id", out.alias("held_out"), found.alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), END_ID)
    return placed.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
                         "sequence_id", "offset")


def op7_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(documents(spark, sf_dir), decontaminate.items_of(spark, sf_dir))
    return found.select("doc_id", "item_id", F.round("containment", 9).alias("containment"), "n_shingles")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(documents(spark, sf_dir), counted=True)


def op9_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                                           F.crc32(text.cast("binary")).alias("text_crc32"))
    sharded = sharding.assign_shards(rows, SHARDS).withColumn("law", F.lit("key"))
    return sharding.slots(sharded, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_rows(documents(spark, sf_dir), licenses.known_licenses(spark))
    return found.withColumn("notice_ids", F.array_join("notice_ids", ","))


def op11_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents go into a fresh index in two deliveries (by the sign of a hash of doc_id), so the second meets the first."""
    rows = store(digestindex.digest_rows(documents(spark, sf_dir)), "digest-rows")
    index = digestindex.DigestIndex(spark, new_folder(spark, "digest-index"))
    side = F.xxhash64("doc_id")
    index.add(rows.where(side < 0))
    index.add(rows.where(side >= 0))
    found = digestindex.memberships(rows, index.groups())
    index.close()
    return found


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {q.__name__: q for q in (
        op1_icws_neardup, op2_gbt_toxicity, op3_token_records, op4_rabitq_search, op5_subword_langid, op6_harmonic_packing,
        op7_minhash_containment, op8_line_dedup, op9_jump_sharding, op10_license_digests,
        op11_digest_index, op12_prefix_trie, op13_spelling_variants)}
    return {**found, "pipeline": corpus_pipeline.run}


# --- SQL ---------------------------------------------------------------------------------------------------------

_LINE_DEDUP = f"""
WITH numbered AS (SELECT *, row_number() OVER () AS r FROM documents),
lines AS (
  SELECT r, doc_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS line FROM numbered WHERE text IS NOT NULL),
spread AS (
  SELECT trim(line, ' ') AS l FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1
  HAVING count(DISTINCT source) >= {linededup.MIN_SITES}),
placed AS (
  SELECT r, pos, row_number() OVER (PARTITION BY l ORDER BY doc_id, pos) AS nth
  FROM lines JOIN spread ON trim(line, ' ') = l),
kept AS (
  SELECT lines.r, string_agg(line, chr(10) ORDER BY lines.pos) FILTER (nth IS NULL OR nth = 1) AS text,
         count(*) FILTER (nth > 1) AS gone
  FROM lines LEFT JOIN placed ON placed.r = lines.r AND placed.pos = lines.pos GROUP BY 1)
SELECT n.doc_id, CASE WHEN n.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, n.lang, n.source,
       length(CASE WHEN n.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END)::BIGINT AS n_chars,
       coalesce(kept.gone, 0)::INT AS lines_removed
FROM numbered n LEFT JOIN kept ON kept.r = n.r
"""

_WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
_GRAMS = "list_distinct([array_to_string(w[i : i + k - 1], ' ') for i in generate_series(1, len(w) - k + 1)])"
# k words a shingle: five, or all words of an item that has fewer.
_CONTAINMENT = f"""
WITH q AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
qw AS (SELECT *, least(5, len(w)) AS k FROM (SELECT item_id, text, {_WORDS} AS w FROM q) WHERE len(w) > 0),
qg AS (SELECT item_id, text, k, unnest({_GRAMS}) AS g FROM qw),
size AS (SELECT item_id, text, count(*) AS n FROM qg GROUP BY 1, 2),
widths AS (SELECT DISTINCT k FROM qw),
d AS (SELECT * FROM (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents WHERE text IS NOT NULL)
      JOIN widths ON len(w) >= k),
dg AS (SELECT DISTINCT r, doc_id, k, unnest({_GRAMS}) AS g FROM d)
SELECT dg.doc_id, qg.item_id, round(count(*)::DOUBLE / n, 9) AS containment, n::INT AS n_shingles
FROM dg JOIN qg USING (g, k) JOIN size ON size.item_id IS NOT DISTINCT FROM qg.item_id AND size.text = qg.text
GROUP BY dg.r, dg.doc_id, qg.item_id, qg.text, n HAVING count(*)::DOUBLE / n >= {decontaminate.THRESHOLD}
"""


# CRC-32 bit by bit into a table, then byte by byte; the jump hash advances every key until it has jumped past the shards.
# Slots follow (doc_id, text_crc32, size) as long as one block holds all rows (800,000).
_SHARDS = f"""
WITH RECURSIVE bits AS (
  SELECT i, i AS v, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) + 16 AS size, hex(encode(coalesce(text, ''))) AS x,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS key FROM documents),
crc AS (SELECT d.*, xor(list_reduce(list_prepend(4294967295::BIGINT,
          [CAST('0x' || substr(x, 2 * i - 1, 2) AS BIGINT) FOR i IN range(1, len(x) // 2 + 1)]),
          lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d, crc_table),
jump AS (
  SELECT r, shards, CAST(key AS HUGEINT) AS state, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j
  FROM d, (VALUES ({SHARDS}), ({SHARDS + 1})) n(shards)
  UNION ALL
  SELECT r, shards, next, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST(next // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM jump WHERE j < shards) x),
s AS (SELECT r, max(b) FILTER (WHERE shards = {SHARDS}) AS shard, max(b) FILTER (WHERE shards = {SHARDS + 1}) AS grown
      FROM jump WHERE j >= shards GROUP BY r)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown::INTEGER AS grown_shard
FROM crc JOIN s USING (r)
"""


_DIGESTS = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
                  length(coalesce(text, '')) AS chars FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS nth FROM d)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY nth) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size, nth = 1 AS kept, text_sha256
FROM placed
"""

# Each prefix by the MD5 of its turns' MD5s; a node's subtree is every deeper prefix of its members.
_TRIE = f"""
WITH RECURSIVE bits AS (
  SELECT i, i AS v, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
ids AS (SELECT DISTINCT conv_id, hex(encode(CAST(conv_id AS VARCHAR))) AS x FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT,
           [CAST('0x' || substr(x, 2 * i - 1, 2) AS BIGINT) FOR i IN range(1, len(x) // 2 + 1)]),
           lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h FROM ids, crc_table),
keyed AS (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
                 md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark
          FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS pos FROM keyed),
n AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1),
rebuilt AS (
  SELECT c.conv_id, t.pos, t.mark, t.chars FROM conv c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(n.n, 0)), t.mark, t.chars
  FROM conv c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h LEFT JOIN n ON n.conv_id = c.conv_id - c.conv_id % 100),
path AS (SELECT conv_id, pos + 1 AS depth, chars, md5(string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS node FROM rebuilt),
member AS (SELECT conv_id, 0 AS depth, 0 AS chars, 'root' AS node FROM conv UNION ALL SELECT * FROM path),
up AS (SELECT *, lag(node) OVER w AS above, lead(node) OVER w IS NULL AS ends FROM member WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
node AS (SELECT node, min(conv_id) AS conv_id, max(depth) AS depth, max(above) AS above, count(*) AS n_convs, max(chars) AS chars,
                sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM up GROUP BY 1),
kids AS (SELECT above AS node, count(*) AS n_children FROM node WHERE above IS NOT NULL GROUP BY 1),
below AS (SELECT DISTINCT a.node, b.node AS deeper FROM up a JOIN up b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (SELECT below.node, count(*) FILTER (kids.node IS NULL) AS n_leaves, sum((m.n_convs - 1) * m.chars) AS saved
         FROM below JOIN node m ON m.node = below.deeper LEFT JOIN kids ON kids.node = below.deeper GROUP BY 1)
SELECT node.conv_id, node.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, node.n_convs,
       coalesce(kids.n_children, 0) AS n_children, sums.n_leaves, sums.saved::BIGINT AS saved_tokens, node.ends_sha256
FROM node JOIN sums USING (node) LEFT JOIN kids USING (node) LEFT JOIN node p ON p.node = node.above
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    lines = (r"(?im)^[^\p{L}\p{N}\n]*(copyright|©|\(c\))[^\n]*$"
             r"|(?im)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$")
    form = f"regexp_replace(lower(regexp_replace({text}, '{lines}', '', 'g')), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')"
    form = f"' ' || trim({form}, ' ') || ' '"
    for spelling, standard in EQUIVALENT:
        a, b = spelling.replace(" ", "  "), standard.replace(" ", "  ")
        form = f"replace({form}, ' {a} ', ' {b} ')"
    return f"replace(trim({form}, ' '), '  ', ' ')"


def _license_sql() -> str:
    values = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in KNOWN)
    return f"""
WITH known AS (SELECT md5({_canonical_sql('t')}) AS digest, min(i) AS license_id FROM (VALUES {values}) v(i, t) GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, text, {_canonical_sql('text')} AS form FROM documents),
l AS (SELECT r, {_canonical_sql('line')} AS form FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
n AS (SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids
      FROM l JOIN known ON md5(l.form) = known.digest WHERE l.form <> '' GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.form <> '' THEN md5(d.form) END AS digest, known.license_id, n.notice_ids
FROM d LEFT JOIN known ON d.form <> '' AND md5(d.form) = known.digest LEFT JOIN n USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_minhash_containment": _CONTAINMENT, "op8_line_dedup": _LINE_DEDUP, "op9_jump_sharding": _SHARDS,
            "op10_license_digests": _license_sql(), "op11_digest_index": _DIGESTS, "op12_prefix_trie": _TRIE}
