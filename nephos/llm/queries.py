"""The registered queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.llm import chat, flac, jaccard, mixing, packing, quality, secret_scan, token_counts, token_store, toxicity, trie, warc, whitening
from nephos.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file ``name`` lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_tokens(table(spark, sf_dir, "documents"), mixing.TARGETS, tokenizer_path("word_bpe_49k.json"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path("word_bpe_49k.json"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.secret_spans(docs, secret_scan.fit_thresholds(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_random")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_store.read_segments(token_store.write_segments(docs, tokenizer_path("word_bpe_49k.json")))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


def op7_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_digests(flac.encode_texts(table(spark, sf_dir, "documents")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality.fit_rules(docs, table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, rules)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(table(spark, sf_dir, "conversations"))
    return chat.conversation_digests(chat.format_turns(turns))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_archives(table(spark, sf_dir, "pages"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


#: The template's lengths and escapes, and digests over turns in order.
CHAT_SQL = r"""WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS body FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(body) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN body END, '' ORDER BY turn, role, body), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(body, '(<|\[)(\\*)(\||s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


#: All pairs of different texts that share a shingle, their similarity, the components and the links.
JACCARD_SQL = r"""WITH RECURSIVE t AS (SELECT md5(coalesce("text", '')) AS node, any_value(coalesce("text", '')) AS body, min(doc_id) AS least_id, count(*) AS n_copies FROM documents GROUP BY 1),
w AS (SELECT node, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM t),
i AS (SELECT node, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS k FROM w WHERE len(words) > 0),
s AS (SELECT DISTINCT node, array_to_string(words[k:k + 4], ' ') AS shingle FROM i),
z AS (SELECT node, count(*) AS n FROM s GROUP BY node),
p AS (SELECT a.node AS a, b.node AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.node <> b.node GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN z x ON x.node = a JOIN z y ON y.node = b WHERE c >= CAST(0.8 AS DOUBLE)*(x.n + y.n - c)),
r AS (SELECT node, node AS label FROM t UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node),
c AS (SELECT node, min(label) AS label FROM r GROUP BY node),
g AS (SELECT label, min(least_id) AS class_id FROM c JOIN t USING (node) GROUP BY label),
d AS (SELECT a AS node, count(*) AS degree FROM e GROUP BY a)
SELECT doc_id, class_id, coalesce(degree, 0) + n_copies - 1 AS n_links, n_copies FROM (SELECT doc_id, md5(coalesce("text", '')) AS node FROM documents) JOIN t USING (node) JOIN c USING (node) JOIN g USING (label) LEFT JOIN d USING (node)"""


#: Of equal payloads of 1000 bytes or more the greatest page id is the response.
WARC_SQL = r"""WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS k, max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest, CASE WHEN payload_bytes < 1000 OR k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND k > 1 THEN first END AS refers_to FROM r"""


#: Nodes by the digests of whole prefixes; sums over subtrees by joining each node with its ancestors.
TRIE_SQL = r"""WITH RECURSIVE t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce("text", '') AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS k FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t),
crc AS (SELECT conv_id, s, 0 AS i, 4294967295::BIGINT AS c, 0 AS bit FROM ids
  UNION ALL SELECT conv_id, s, CASE WHEN bit = 7 THEN i + 1 ELSE i END,
    CASE WHEN (CASE WHEN bit = 0 THEN xor(c, ascii(substr(s, i + 1, 1))::BIGINT) ELSE c END) % 2 = 1
      THEN xor((CASE WHEN bit = 0 THEN xor(c, ascii(substr(s, i + 1, 1))::BIGINT) ELSE c END) // 2, 3988292384::BIGINT)
      ELSE (CASE WHEN bit = 0 THEN xor(c, ascii(substr(s, i + 1, 1))::BIGINT) ELSE c END) // 2 END,
    (bit + 1) % 8 FROM crc WHERE i < length(s)),
h AS (SELECT conv_id, xor(c, 4294967295::BIGINT) % 4 AS h FROM crc WHERE i = length(s)),
a AS (SELECT h.conv_id, t.k, t.role, t.body FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.k <= h.h
  UNION ALL SELECT h.conv_id, t.k + 1000000, t.role, t.body FROM h JOIN t ON t.conv_id = h.conv_id AND t.k > h.h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS depth FROM a),
x AS (SELECT conv_id, depth, md5(string_agg(md5(length(role) || ':' || role || body), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
    len(list_filter(regexp_split_to_array(body, '[ 	-]+'), lambda w: w <> '')) AS words FROM o
  UNION ALL SELECT conv_id, 0, md5(''), 0 FROM h),
y AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends FROM x),
n AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM y GROUP BY node),
c AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
m AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM n LEFT JOIN c ON c.parent = n.node),
u AS (SELECT node AS top, node, parent FROM m UNION ALL SELECT p.node, u.node, p.parent FROM u JOIN m p ON p.node = u.parent),
s AS (SELECT u.top, sum(CASE WHEN m.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((m.n_convs - 1) * m.words) AS saved_tokens FROM u JOIN m ON m.node = u.node GROUP BY u.top)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON s.top = m.node LEFT JOIN m p ON p.node = m.parent"""


def queries() -> dict[str, Query]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_secret_scan": op3_secret_scan,
        "op4_token_counts": op4_token_counts,
        "op5_token_store": op5_token_store,
        "op6_ngram_jaccard": op6_ngram_jaccard,
        "op7_flac_media": op7_flac_media,
        "op8_quality_rules": op8_quality_rules,
        "op9_toxicity": op9_toxicity,
        "op10_chat_format": op10_chat_format,
        "op11_warc": op11_warc,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    """Of these queries SQL can express the similarity classes, the chat digests, the archives and the trie; the others are tested against brute force."""
    return {"op6_ngram_jaccard": JACCARD_SQL, "op10_chat_format": CHAT_SQL, "op11_warc": WARC_SQL, "op12_prefix_trie": TRIE_SQL}
