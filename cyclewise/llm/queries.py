"""The text queries (opN_<name>) and the pipeline, with their DuckDB oracles where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.llm import (
    conversation_trie,
    exact_dedup,
    html_text,
    langid,
    licenses,
    mixing,
    packing,
    periodic,
    quality,
    rpforest,
    setsketch,
    toxicity,
    wavelet,
)
from cyclewise.llm.common import table

#: Folder of the tokenizer files; the public_tokenizers package's own unless the environment names another.
TOKENIZERS = os.environ.get("CYCLEWISE_TOKENIZERS", "")

QueryFn = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf, "documents"), width=2, percent=80)


def op2_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.learn_and_score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op4_token_shards(spark: SparkSession, sf: str) -> DataFrame:
    files = wavelet.write_shards(table(spark, sf, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)
    return wavelet.read_shards(files)


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


def op6_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return html_text.extract(pages, html_text.fit(pages)).select("page_id", "url", "text", "n_chars")


def op7_pack_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0)


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.learn_and_identify(table(spark, sf, "documents"))


def op10_nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return rpforest.search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf, "conversations"))


def op12_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.learn_and_score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.run_digest(table(spark, sf, "documents"), periodic.planted)


QUERIES: dict[str, QueryFn] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_toxicity": op3_toxicity,
    "op4_token_shards": op4_token_shards,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_html_text": op6_html_text,
    "op7_pack_sequences": op7_pack_sequences,
    "op8_license_scan": op8_license_scan,
    "op9_language_id": op9_language_id,
    "op10_nearest_vectors": op10_nearest_vectors,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_quality": op12_quality,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op11_prefix_trie": r"""
WITH t0 AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t1 AS (SELECT conv_id, turn, sha256(octet_length(encode(role)) || ':' || role || text) AS k, octet_length(encode(text)) AS bytes FROM t0),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM t1),
ids AS (SELECT DISTINCT conv_id FROM t),
c AS (  -- crc32 of the decimal id, bit by bit
  SELECT conv_id, conv_id - conv_id % 5 AS head,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda a, b: list_reduce([xor(a, b), 0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 9 AS h
  FROM ids),
r AS (
  SELECT c.conv_id, 1 AS own, t.pos, t.k, t.bytes FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.pos > c.h
  UNION ALL SELECT c.conv_id, 0, t.pos, t.k, t.bytes FROM c JOIN t ON t.conv_id = c.head WHERE t.pos <= c.h),
q AS (SELECT c.conv_id, coalesce(list(r.k ORDER BY own, pos) FILTER (r.k IS NOT NULL), []) AS ks,
             coalesce(list(r.bytes ORDER BY own, pos) FILTER (r.k IS NOT NULL), []) AS bs FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, ks, bs, unnest(range(0, len(ks) + 1)) AS d FROM q),
n AS (
  SELECT ks[1:d] AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN bs[d] ELSE 0 END) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ks) = d), '')) AS ends_sha256
  FROM p GROUP BY ks[1:d], d),
k AS (SELECT node[1:d - 1] AS parent, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.parent = n.node),
up AS (SELECT node, n_children, (n_convs - 1) * bytes AS saved, unnest(range(0, d + 1)) AS j FROM m),
s AS (SELECT node[1:j] AS top, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY 1)
SELECT m.conv_id, m.d AS depth, a.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM m JOIN s ON s.top = m.node LEFT JOIN n a ON m.d > 0 AND a.node = m.node[1:m.d - 1]""",
    "op5_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t""",
    "op2_mix_sources": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         0.25 + coalesce(length(regexp_replace(coalesce(text, ''), '[^\p{L}]+', '', 'g')) / nullif(length(text), 0), 0.0) AS w,
         ((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / w AS key FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
s1 AS (SELECT *, 3 * source_size AS cap,
              CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS sw FROM s0),
lv AS (  -- water level with the k sources of the smallest cap / weight full
  SELECT cap / sw AS own, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / sw, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(sw) OVER () - coalesce(sum(sw) OVER (ORDER BY cap / sw, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM s1),
v AS (SELECT arg_min(level, own) AS level FROM lv WHERE level <= own),
s AS (SELECT source, source_size, CASE WHEN cap <= level * sw THEN cap::DOUBLE ELSE level * sw END AS target FROM s1, v),
r AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS e FROM s),
q AS (SELECT *, target - e * source_size AS rest FROM r),
c AS (SELECT k.*, q.source_size, q.target, q.e, q.rest,
             sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
      FROM k JOIN q ON k.source IS NOT DISTINCT FROM q.source),
g AS (SELECT source, max(rest) - coalesce(max(CASE WHEN upto <= rest THEN upto END), 0) AS gap FROM c GROUP BY source),
l AS (SELECT c.source, c.size, c.upto, g.gap, row_number() OVER (PARTITION BY c.source ORDER BY upto) AS i
      FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source WHERE upto > rest AND size > 0),
f AS (  -- the later documents one after the other: what still fits is taken
  SELECT source, 0::BIGINT AS i, gap AS rest, NULL::BIGINT AS got FROM g
  UNION ALL
  SELECT l.source, l.i, CASE WHEN l.size <= f.rest THEN f.rest - l.size ELSE f.rest END, CASE WHEN l.size <= f.rest THEN l.upto::BIGINT END
  FROM f JOIN l ON l.source IS NOT DISTINCT FROM f.source AND l.i = f.i + 1),
h AS (SELECT source, min(rest) AS rest FROM f GROUP BY source),
n AS (SELECT l.source, min(abs(l.size - h.rest)) AS m, arg_min(l.upto, (abs(l.size - h.rest), l.upto)) AS upto
      FROM l JOIN h ON l.source IS NOT DISTINCT FROM h.source
      WHERE abs(l.size - h.rest) < h.rest AND NOT EXISTS (SELECT 1 FROM f WHERE f.source IS NOT DISTINCT FROM l.source AND f.got = l.upto) GROUP BY l.source),
o AS (SELECT source, min(abs(size - gap)) AS m, arg_min(upto, (abs(size - gap), upto)) AS upto FROM l WHERE abs(size - gap) < gap GROUP BY source),
b AS (SELECT h.source, coalesce(o.m < coalesce(n.m, h.rest), false) AS alone, o.upto AS one, n.upto AS last
      FROM h LEFT JOIN n ON n.source IS NOT DISTINCT FROM h.source LEFT JOIN o ON o.source IS NOT DISTINCT FROM h.source),
z AS (SELECT source, one AS upto FROM b WHERE alone
      UNION ALL SELECT source, last FROM b WHERE NOT alone AND last IS NOT NULL
      UNION ALL SELECT f.source, f.got FROM f JOIN b ON b.source IS NOT DISTINCT FROM f.source WHERE NOT b.alone AND f.got IS NOT NULL)
SELECT c.doc_id, c.size, c.source_size, c.target,
       (c.size * (c.e + CASE WHEN c.upto <= c.rest OR (z.upto IS NOT NULL AND c.size > 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c LEFT JOIN z ON c.source IS NOT DISTINCT FROM z.source AND c.upto = z.upto""",
}
