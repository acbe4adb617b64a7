"""The registered queries of the subpackage: each applies its operator to whole tables and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import dualtree, langid, lines, mixing, packing, quotes, repairs, rules, sharding, simhash, trees, vectors, winnow
from riskmart.session import staged

#: Messages in a chat text.
CHUNK = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linked messages, each with the number and the checksum of the chat text it is in."""
    linked = staged(quotes.link(table(spark, sf_dir, "conversations")), "linked")
    chats = quotes.rendered(linked, CHUNK).select(F.col("conv_id").alias("_conv"), "chunk", F.sha2("text", 256).alias("chat_sha256"))
    at = linked.withColumn("_chunk", F.floor(F.col("place") / CHUNK))
    return at.join(chats, at["conv_id"].eqNullSafe(chats["_conv"]) & (at["_chunk"] == chats["chunk"])).drop("_conv", "_chunk")


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.lm_scores(table(spark, sf_dir, "documents"))


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, and size and checksum of the text that is left."""
    done = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "__lines.*", F.octet_length("text").alias("bytes_left"), F.sha2("text", 256).alias("left_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.detect(table(spark, sf_dir, "documents"))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"))


def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dualtree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repairs.repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_quality_classifier, op3_simhash_golay, op4_quote_linking, op5_context_mixing, op6_fuzzy_lines, op7_quality_rules,
        op8_decontamination, op9_sharding, op10_language_id, op11_exact_topk, op12_dual_tree_search, op13_conversation_repair)}
WORDS = r"LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
#: Every window of every text, joined as it stands. Models, tokenizers, XXH64 and connected groups have no SQL form.
ORACLE: dict[str, str] = {"op8_decontamination": f"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
 b AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
 iw AS (SELECT DISTINCT item_id, n, ARRAY_TO_STRING(w[i:i + n - 1], ' ') AS win FROM (
  SELECT item_id, w, LEAST(LEN(w), 10) AS n, UNNEST(RANGE(1, LEN(w) - LEAST(LEN(w), 10) + 2)) AS i FROM b WHERE LEN(w) > 0)),
 dw AS (SELECT r, i, n, ARRAY_TO_STRING(w[i:i + n - 1], ' ') AS win FROM (
  SELECT r, w, n, UNNEST(RANGE(1, LEN(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM iw) WHERE LEN(w) >= n)),
 h AS (SELECT DISTINCT r, i, n, item_id FROM dw JOIN iw USING (n, win)),
 c AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, UNNEST(RANGE(i, i + n)) AS p FROM h) GROUP BY r),
 s AS (SELECT r, COUNT(*) AS n_items, SHA256(STRING_AGG(id, ',' ORDER BY id)) AS items_sha256 FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY r)
SELECT doc_id, CAST(LEN(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, COALESCE(items_sha256, SHA256('')) AS items_sha256,
 COALESCE(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)"""}

ORACLE["op11_exact_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: FLOOR(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND LEN(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 q AS (SELECT vec_id AS query_id, MIN(e) AS e FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
 s AS (SELECT query_id, vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score FROM q JOIN v ON query_id <> vec_id),
 r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

TERMS = r"LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE["op12_dual_tree_search"] = f"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, {TERMS} AS w FROM documents),
 s AS (SELECT COUNT(*) AS N, SUM(LEN(w)) AS L FROM d WHERE LEN(w) > 0),
 b AS (SELECT item_id, {TERMS} AS w FROM (SELECT item_id, MIN(COALESCE(text, '')) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id)),
 q AS (SELECT item_id, term, COUNT(*) AS times FROM (SELECT item_id, UNNEST(w) AS term FROM b) GROUP BY item_id, term),
 t AS (SELECT r, term, COUNT(*) AS tf FROM (SELECT r, UNNEST(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
 g AS (SELECT term, CAST(FLOOR(1000 * LN(CAST(2 * N + 2 AS DOUBLE) / (2 * COUNT(*) + 1))) AS BIGINT) AS weight FROM t, s GROUP BY term, N),
 i AS (SELECT r, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + CAST((25 * LEN(w) * N) // L AS BIGINT))) AS impact FROM t JOIN d USING (r), s),
 c AS (SELECT item_id, r, CAST(SUM(times * weight * impact) AS BIGINT) AS score FROM q JOIN g USING (term) JOIN i USING (term) GROUP BY item_id, r),
 o AS (SELECT item_id, doc_id, score, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM c JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20"""

#: CRC-32 of digits, bit by bit.
CRC = """(xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(k, ''), lambda ch: list_transform(range(8), lambda b: (ascii(ch) >> b) & 1)))),
 lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1))), 4294967295))"""


def _insert(node: str, role: str) -> str:
    return f"CASE WHEN {node} IS NOT NULL THEN {{'c': {node}.c + 5, 'e': {node}.e || 'I', 't': list_append({node}.t, '{role}:')}} END"


def _edit(node: str, cost: str, letter: str, line: str | None, when: str = "true") -> str:
    text = f"list_append({node}.t, {line})" if line else f"{node}.t"
    return f"CASE WHEN {node} IS NOT NULL AND {when} THEN {{'c': {node}.c + {cost}, 'e': {node}.e || '{letter}', 't': {text}}} END"


_FREE, _MORE = "fault IN ('.', 't')", "(CASE WHEN fault = 't' THEN 5 ELSE 0 END)"
_INSERTS = (f"SELECT * REPLACE (list_min([u, {_insert('z', 'user')}, {_insert('s', 'user')}, {_insert('a', 'user')}]) AS u)",
            f"SELECT * REPLACE (list_min([a, {_insert('u', 'assistant')}]) AS a)", f"SELECT * REPLACE (list_min([u, {_insert('a', 'user')}]) AS u)")


def _inserted(source: str) -> str:
    for step in _INSERTS:
        source = f"({step} FROM {source})"
    return source


def _to_user() -> str:
    found = [_edit("u", "2", "D", None)]
    for at in "zsa":
        found += [_edit(at, _MORE, "K", "line", f"{_FREE} AND initial = 'u'"), _edit(at, f"1 + {_MORE}", "R", "'user:' || body", _FREE)]
    return f"list_min([{', '.join(found)}])"


#: The nodes z, s, u and a (start, after a system, user, assistant turn) hold the best (cost, audit, text so far) of a conversation, row by row.
ORACLE["op13_conversation_repair"] = f"""
WITH RECURSIVE x AS (SELECT *, COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
 y AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS body, {CRC} % 20 AS kind FROM x),
 d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(body, '.!?', '') ELSE body END AS body
  FROM y, UNNEST(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS c(copy) WHERE kind <> 0),
 m AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) AS i FROM d),
 n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id, role, body ORDER BY i) AS nth FROM m),
 f AS (SELECT *, role || ':' || body AS line, LEFT(role, 1) AS initial, LAG(role) OVER (PARTITION BY conv_id ORDER BY i) AS prior,
  CASE WHEN rtrim(body, E' \t\n\x0B\x0C\r') = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN RIGHT(rtrim(body, E' \t\n\x0B\x0C\r'), 1) IN ('.', '!', '?') THEN '.' ELSE 't' END AS fault FROM n),
 walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'e': '', 't': CAST([] AS VARCHAR[])}} AS z, CAST(NULL AS STRUCT(c BIGINT, e VARCHAR, t VARCHAR[])) AS s,
   CAST(NULL AS STRUCT(c BIGINT, e VARCHAR, t VARCHAR[])) AS u, CAST(NULL AS STRUCT(c BIGINT, e VARCHAR, t VARCHAR[])) AS a FROM d
  UNION ALL
  SELECT w.conv_id, f.i, {_edit('z', '2', 'D', None)}, list_min([{_edit('s', '2', 'D', None)}, {_edit('z', _MORE, 'K', 'line', _FREE + " AND initial = 's'")}]), {_to_user()},
   list_min([{_edit('a', '2', 'D', None)}, {_edit('u', _MORE, 'K', 'line', _FREE + " AND initial = 'a'")}, {_edit('u', f'1 + {_MORE}', 'R', "'assistant:' || body", _FREE)}])
  FROM {_inserted('walk')} AS w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1),
 g AS (SELECT conv_id, MAX(i) AS last, CASE WHEN COUNT(turn) = 0 THEN 0 ELSE MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn) END AS gaps, COUNT(*) FILTER (fault = 'b') AS blank,
  COUNT(*) FILTER (fault = 'd') AS duplicate, COUNT(*) FILTER (fault = 't') AS truncated, COUNT(*) FILTER (prior IS NOT NULL AND LEFT(prior, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
 e AS (SELECT w.conv_id, w.i, list_min([z, a]) AS best FROM {_inserted('walk')} AS w)
SELECT o.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate, COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal,
 COALESCE(best.c, 0) AS cost, COALESCE(best.e, '') AS audit, SHA256(COALESCE(ARRAY_TO_STRING(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id AND e.i = g.last"""
