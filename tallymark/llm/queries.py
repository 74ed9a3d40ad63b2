"""Queries of the corpus operators and, where SQL can state them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import chat, decontaminate, extraction, filter_audit, minmax, packing, perplexity, repair, secrets, sharding, simhash, warc
from tallymark.llm.common import table
from tallymark.llm.token_counts import token_counts
from tallymark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    path = scratch_path(spark, "shards")
    sharding.write_shards(sharding.assigned(table(spark, sf_dir, "documents")), path)
    text = F.coalesce("text", F.lit(""))
    return spark.read.parquet(path).select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", "grown_shard",
    )


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = token_counts(table(spark, sf_dir, "documents"), path, scratch_path(spark, "token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op3_quality_rules")
def op3_quality_rules(spark, sf_dir):
    rules = perplexity.quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return rules.select("doc_id", *perplexity.BASE, "base_failed", "kept", "perplexity")


@query("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    found = secrets.secret_scan(table(spark, sf_dir, "documents"), carry=["doc_id"], reach=None)
    base = F.sha2(secrets.joined(F.col("base_spans")), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", base, secrets.joined(F.col("spans")).alias("spans"))


@query("op5_html_extraction")
def op5_html_extraction(spark, sf_dir):
    return extraction.main_text(table(spark, sf_dir, "pages"), carry=["page_id", "url"])


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op7_minmax_near_dedup")
def op7_minmax_near_dedup(spark, sf_dir):
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


WORDS_SQL = r"[w FOR w IN regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> '']"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, COALESCE({WORDS_SQL.format(text='text')}, []) AS w FROM {{docs}}),
b AS (SELECT item_id, {WORDS_SQL.format(text='text')} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
       FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(len(w), 10) AS k FROM b WHERE len(w) > 0))),
lens AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens WHERE len(w) >= k)),
hits AS (SELECT doc_id, k, i, item_id FROM dw JOIN iw USING (k, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS t FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit, COALESCE(n_items, 0)::BIGINT AS n_items,
       sha256(COALESCE(items.s, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op8_decontamination", DECONTAMINATION_SQL.format(docs="documents"))
def op8_decontamination(spark, sf_dir):
    found = decontaminate.found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op9_warc_chunks", """
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN first END AS refers_to
FROM (SELECT *, bytes >= 100 AND page_id <> first AS revisit
      FROM (SELECT page_id, strlen(COALESCE(html, ''))::BIGINT AS bytes, sha256(COALESCE(html, '')) AS digest, min(page_id) OVER (PARTITION BY COALESCE(html, '')) AS first
            FROM pages))
""")
def op9_warc_chunks(spark, sf_dir):
    done = warc.round_trip(table(spark, sf_dir, "pages"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_chat_formatting", """
WITH turns AS (SELECT DISTINCT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list(role || chr(31) || text ORDER BY turn NULLS FIRST, role, text) AS l,
             string_agg('<|im_start|>' || role || chr(10) || trim(text, ' ') || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS chat
      FROM turns GROUP BY conv_id),
inner_ AS (SELECT DISTINCT md5(array_to_string(l[1:k], chr(30))) AS h FROM (SELECT l, unnest(range(1, len(l))) AS k FROM c)),
ranked AS (SELECT *, md5(array_to_string(l, chr(30))) AS h, row_number() OVER (PARTITION BY l ORDER BY conv_id) AS r FROM c)
SELECT conv_id, len(l)::BIGINT AS n_turns, chat FROM ranked WHERE r = 1 AND h NOT IN (SELECT h FROM inner_)
""")
def op10_chat_formatting(spark, sf_dir):
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


REPAIR_SQL = r"""
WITH RECURSIVE polynomial AS (SELECT 0 AS k, range AS byte, range AS c FROM range(256)
    UNION ALL SELECT k + 1, byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM polynomial WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY byte) AS t FROM polynomial WHERE k = 8),
keyed AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text, COALESCE(conv_id::VARCHAR, ' ') || ':' || COALESCE(turn::VARCHAR, ' ') AS k FROM conversations),
drawn AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: unicode(x)::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS draw FROM keyed, crc),
dealt AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy
    FROM drawn WHERE draw <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM dealt),
faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_matches(text, '[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
counted AS (SELECT conv_id, count(*) AS n, COALESCE(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
moves(letter, given, made, new_role, cost) AS (VALUES ('K', 's', 0, NULL, 0), ('K', 'u', 2, NULL, 0), ('K', 'a', 3, NULL, 0), ('R', NULL, 2, 'user', 3), ('R', NULL, 3, 'assistant', 3), ('D', NULL, NULL, NULL, 4)),
allowed(made, from_state, to_state) AS (VALUES (0, 0, 1), (2, 0, 2), (2, 1, 2), (2, 3, 2), (3, 2, 3)),
steps AS (SELECT letter, given, new_role, cost, s AS from_state, CASE WHEN letter = 'D' THEN s ELSE to_state END AS to_state
    FROM moves, range(4) AS r(s) LEFT JOIN allowed ON allowed.from_state = s AND allowed.made IS NOT DISTINCT FROM moves.made WHERE letter = 'D' OR to_state IS NOT NULL),
inserts AS (SELECT s AS from_state, CASE WHEN s = 2 THEN 3 ELSE 2 END AS to_state, CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END AS line FROM range(4) AS r(s)),
dp AS (SELECT conv_id, 0::BIGINT AS i, 0::BIGINT AS state, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS best FROM counted
    UNION ALL
    SELECT conv_id, i, to_state, min({'cost': cost, 'audit': audit, 'lines': lines}) FROM (
        SELECT w.conv_id, f.i, s.to_state, w.cost + s.cost + CASE WHEN s.letter <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END AS cost, w.audit || s.letter AS audit,
            CASE WHEN s.letter = 'D' THEN w.lines ELSE list_append(w.lines, COALESCE(s.new_role, f.role) || ':' || f.text) END AS lines
        FROM (SELECT conv_id, i, state, best.cost AS cost, best.audit AS audit, best.lines AS lines FROM dp
              UNION ALL SELECT conv_id, i, to_state, best.cost + 3, best.audit || 'I', list_append(best.lines, line) FROM dp JOIN inserts ON from_state = state) w
        JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
        JOIN steps s ON s.from_state = w.state AND (s.letter = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND (s.given IS NULL OR s.given = f.role[1:1])))
    ) GROUP BY conv_id, i, to_state),
ends AS (SELECT d.conv_id, min(CASE WHEN state = 2 THEN {'cost': best.cost + 3, 'audit': best.audit || 'I', 'lines': list_append(best.lines, 'assistant:')} ELSE best END) AS best
    FROM dp d JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND d.i = c.n WHERE state <> 1 GROUP BY d.conv_id)
SELECT o.conv_id, COALESCE(gaps, 0)::BIGINT AS gaps, COALESCE(blank, 0)::BIGINT AS blank, COALESCE(duplicate, 0)::BIGINT AS duplicate, COALESCE(truncated, 0)::BIGINT AS truncated,
    COALESCE(illegal, 0)::BIGINT AS illegal, COALESCE(best.cost, 0)::BIGINT AS cost, COALESCE(best.audit, '') AS audit, sha256(COALESCE(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op11_structure_repair", REPAIR_SQL)
def op11_structure_repair(spark, sf_dir):
    turns = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.audits(repair.blocks(turns)).withColumnRenamed("conv", "conv_id")


@query("op12_filter_audit", r"""
WITH words AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text, [w FOR w IN regexp_split_to_array(COALESCE(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS w FROM documents),
flags AS (SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
        regexp_matches(text, '[#$%&*|]'), COALESCE(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM words),
letters AS (SELECT unnest(range(1, 6)) AS f),
orders AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
masks AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM flags GROUP BY part, fails),
ranked AS (SELECT part, fails, n, n_good, n_toxic, o, COALESCE(list_position([fails[f] FOR f IN o], true), 6) AS rank FROM masks, orders),
steps AS (SELECT part, o, step, sum(n) FILTER (rank > step) AS kept, sum(n) FILTER (rank = step) AS removed, sum(n) FILTER (fails[o[step]] AND rank < step) AS redundant,
    sum(n) FILTER (fails[o[step]] AND len([x FOR x IN fails IF x]) = 1) AS unique_fails, sum(n_good) FILTER (rank = step) AS good_lost, sum(n_toxic) FILTER (rank = step) AS toxic_lost
    FROM ranked, range(1, 6) AS s(step) GROUP BY part, o, step),
shares AS (SELECT part, o[step] AS f, sum(removed) AS shapley FROM steps GROUP BY part, o[step])
SELECT s.part, array_to_string([substr('ABCDE', f, 1) FOR f IN o], '') AS filter_order, step::INTEGER AS step, COALESCE(kept, 0)::BIGINT AS kept, COALESCE(removed, 0)::BIGINT AS removed,
    COALESCE(redundant, 0)::BIGINT AS redundant, COALESCE(unique_fails, 0)::BIGINT AS unique_fails, COALESCE(good_lost, 0)::BIGINT AS good_lost,
    COALESCE(toxic_lost, 0)::BIGINT AS toxic_lost, COALESCE(shapley, 0)::BIGINT AS shapley
FROM steps s JOIN shares h ON h.part = s.part AND h.f = s.o[s.step]
""")
def op12_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_simhash_dedup")
def op13_simhash_dedup(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))
