"""The named queries of this package: each operator over its whole table, reduced to the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowfold.llm import (
    conversations,
    fertility,
    hard_negatives,
    mixing,
    near_vectors,
    piece_encoding,
    rule_ensemble,
    simhash,
    token_counts,
    token_tables,
    toxicity,
    url_rules,
    warc,
)
from rowfold.llm.shipping import with_package
from rowfold.session import new_work_dir

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
TOKEN_LIMIT = 512


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "mixture")
    mixed = mixing.mixture(_table(spark, sf_dir, "documents"), work_dir=folder)
    return mixing.scheduled(mixed, folder)[1].select("doc_id", "size", "source_size", "target", "taken")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = fertility.judged(_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE))
    return told.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "n_byte_tokens", "entropy", "script",
    )


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.url_verdicts(_table(spark, sf_dir, "pages")).drop("pattern")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.piece_digests(_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "tokens")
    token_tables.write_token_table(_table(spark, sf_dir, "documents"), f"{folder}/table", tokenizer_path(BYTE_BPE))
    return token_tables.read_back(spark, f"{folder}/table", work_dir=folder)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(_table(spark, sf_dir, "conversations"))
    return conversations.repair(damaged, copy_col="copy", present_col="present").with_digest()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: with_package(f)
    for f in (
        op1_near_vectors, op2_warc, op3_mixture, op4_quality, op5_fertility, op6_url_rules, op7_token_counts, op8_pieces,
        op9_simhash, op10_token_table, op11_toxicity, op12_hard_negatives,
        op13_conversations,
    )
}

_HOST = r"^.*?://([^/?#]*)([^?#]*)"
ORACLES: dict[str, str] = {}
ORACLES["op1_near_vectors"] = """
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS n, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT * FROM e WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(v) > 0
    AND list_count(v) = len(v) AND list_bool_and(list_transform(v, lambda x: isfinite(x))) AND list_dot_product(v, v) > 0
), pairs AS (
  SELECT a.n AS an, a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.n <> b.n AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach(node, root) AS (
  SELECT vec_id, vec_id FROM usable UNION SELECT p.b, r.root FROM reach r JOIN pairs p ON p.a = r.node
), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
counts AS (SELECT an, count(*) AS links FROM pairs GROUP BY an)
SELECT e.vec_id, coalesce(c.links, 0)::BIGINT AS n_links, coalesce(r.root, e.vec_id) AS component_id,
  coalesce(e.vec_id = coalesce(r.root, e.vec_id), false) AS kept
FROM e LEFT JOIN usable u ON u.n = e.n LEFT JOIN roots r ON r.node = u.vec_id LEFT JOIN counts c ON c.an = e.n
"""
ORACLES["op2_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""
ORACLES["op3_mixture"] = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
k AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS top FROM t),
o AS (
  SELECT *, row_number() OVER w AS rank, sum(source_size) OVER () - coalesce(sum(top) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_size,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
  FROM k WINDOW w AS (ORDER BY top / weight::DOUBLE, source NULLS LAST)
), l AS (SELECT *, left_size::DOUBLE / left_weight::DOUBLE AS level FROM o),
f AS (SELECT rank, level FROM l WHERE level * weight <= top ORDER BY rank LIMIT 1),
g AS (
  SELECT source, source_size, CASE WHEN f.rank IS NULL OR l.rank < f.rank THEN top::DOUBLE ELSE f.level * weight END AS target
  FROM l LEFT JOIN f ON true
), b AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS words,
    (coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5('mix|' || coalesce(doc_id::VARCHAR, '')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS before
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  least(size, greatest(words - before, 0)) + least(size, greatest(words - source_size - before, 0))
  + least(size, greatest(words - 2 * source_size - before, 0)) AS taken
FROM b
"""

ORACLES["op12_hard_negatives"] = """
WITH q AS (
  SELECT row_number() OVER () AS key, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
), s AS (
  SELECT a.key AS anchor, a.id AS anchor_id, b.key, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.key <> b.key AND len(a.v) = len(b.v) WHERE a.id % 100 = 0
), p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, key) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.key ORDER BY s.score DESC, s.id, s.key)::INTEGER AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
# CRC-32 bit by bit; the cheapest edits of a prefix are kept for each last role, with their initials and lines
ORACLES["op13_conversations"] = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), coded AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(key, ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) % 20 AS kind
  FROM raw
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER w AS n, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), rows AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM placed
), keeps(mid, edit, initial, after) AS (
  VALUES (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (2, 'K', 'a', 3), (3, 'K', 'u', 2), (0, 'R', NULL, 2),
    (1, 'R', NULL, 2), (2, 'R', NULL, 3), (3, 'R', NULL, 2), (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3)
), inserts(state, mid, letters, added) AS (
  VALUES (0, 0, '', []::VARCHAR[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']),
    (3, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:']),
    (3, 3, 'II', ['user:', 'assistant:']), (2, 2, 'II', ['assistant:', 'user:'])
), best(conv_id, n, state, cost, audit, body) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, 0::BIGINT, '', []::VARCHAR[] FROM rows
  UNION ALL
  SELECT conv_id, n, state, cost, audit, body FROM (
    SELECT b.conv_id, r.n, k.after AS state, b.audit || i.letters || k.edit AS audit,
      b.cost + 3 * length(i.letters) + CASE k.edit WHEN 'K' THEN 0 WHEN 'R' THEN 3 ELSE 4 END
        + CASE WHEN k.edit <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END AS cost,
      list_concat(list_concat(b.body, i.added), CASE k.edit WHEN 'K' THEN [r.role || ':' || r.text]
        WHEN 'R' THEN [CASE k.after WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text] ELSE [] END) AS body
    FROM best b JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.n = b.n + 1
    JOIN inserts i ON i.state = b.state JOIN keeps k ON k.mid = i.mid AND (k.initial IS NULL OR k.initial = r.initial)
    WHERE k.edit = 'D' OR r.fault IS NULL OR r.fault = 'truncated'
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
), told AS (
  SELECT conv_id, max(n) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps
  FROM rows GROUP BY conv_id
), ends AS (
  SELECT b.conv_id, b.cost + 3 * length(i.letters) AS cost, b.audit || i.letters AS audit, list_concat(b.body, i.added) AS body
  FROM best b JOIN told t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.n = b.n JOIN inserts i ON i.state = b.state
  WHERE i.mid IN (0, 3) QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + 3 * length(i.letters), b.audit || i.letters) = 1
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(t.gaps, 0) AS gaps, coalesce(t.blank, 0) AS blank, coalesce(t.duplicate, 0) AS duplicate,
  coalesce(t.truncated, 0) AS truncated, coalesce(t.illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.body, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


def _url_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rules = sorted(url_rules.HOST_RULES, key=lambda r: (-len(r.name), r.name))
    fits = lambda r: f"(host = {quoted(r.host)} OR ends_with(host, {quoted('.' + r.host)})) AND starts_with(path, {quoted(r.path)})"
    named = " ".join(f"WHEN {fits(r)} THEN {quoted(r.name)}" for r in rules)
    verdicts = " ".join(f"WHEN {fits(r)} THEN {quoted(r.verdict)}" for r in rules)
    found = " ".join(f"WHEN regexp_matches(low, {quoted(r.pattern)}) THEN {quoted(r.verdict)}" for r in url_rules.PATTERN_RULES)
    return f"""
WITH u AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    translate(coalesce(regexp_extract(url, {quoted(_HOST)}, 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, {quoted(_HOST)}, 2, 's'), '') AS path
  FROM pages
)
SELECT page_id, host, path, CASE {named} END AS rule, CASE {verdicts} {found} ELSE 'allow' END AS verdict FROM u
"""


ORACLES["op6_url_rules"] = _url_sql()
