"""One query for each operator, over its whole table, and DuckDB SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import media_features

    own = media_features(table(spark, sf_dir, "documents"))
    return own.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption", "text_items")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify, profiles

    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_of_id(F.col("doc_id"), 4) == 2, F.lit(False))
    return identify(docs, profiles(docs.filter(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import learned, score_lines

    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_of_id(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = score_lines(docs, learned(docs, table(spark, sf_dir, "labels")), with_lines=False)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", "lines", "bad_lines")


#: The rules, as (verdict, host, path prefix), and hosts that block where no rule fits.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
URL_BLOCKED = [f"{site}.example.{top}" for site in ("adult-x", "casino-win", "cheap-pills") for top in ("com", "net", "org")]


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlfilter import judge

    return judge(table(spark, sf_dir, "pages"), URL_RULES, URL_BLOCKED).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(verdict, h, p) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}
), blocked(b) AS (VALUES {", ".join(f"('{b}')" for b in URL_BLOCKED)}
)
SELECT page_id, host, path,
       (SELECT arg_max(h || p, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce(
         (SELECT arg_max(verdict, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
         CASE WHEN EXISTS (SELECT 1 FROM blocked WHERE host = b OR ends_with(host, '.' || b)) THEN 'block' ELSE 'allow' END
       ) AS verdict
FROM parts
"""


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import KINDS, scan, span_text, trained

    docs = table(spark, sf_dir, "documents")
    found = scan(docs, trained(docs))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(n(k) for k in KINDS[:3]), F.sha2(span_text("spans", KINDS[:3]).cast("binary"), 256).alias("base_sha256"), span_text("spans", KINDS).alias("spans"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    back = round_trip(table(spark, sf_dir, "pages"))
    return back.select(F.col("key").alias("page_id"), F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


#: Pages of equal ids and payloads would tie here; ids are unique in the tables.
OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .infill import infilled, restored

    out = infilled(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), k AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), c AS (
  SELECT *, least(a, b) AS p, greatest(a, b) - least(a, b) AS m FROM k
), o AS (
  SELECT *, substr(x, 1, p) AS head, substr(x, p + 1, m) AS middle, substr(x, p + m + 1) AS tail FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN m END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle ELSE '<S>' || tail || '<P>' || head || '<M>' || middle END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM o
"""


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import damaged, summarised

    return summarised(damaged(table(spark, sf_dir, "conversations")))


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _way(state: str, cost: str, edit: str, line: str = "''") -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN struct_pack(c := {state}.c + {cost}, a := {state}.a || '{edit}', t := {state}.t || {line}) END"


_USER, _ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"


def _stays(state: str, cost: int, edit: str, line: str, when: str = "TRUE") -> str:
    return f"CASE WHEN f <> 1 AND {when} THEN {_way(state, f'{cost} + CASE f WHEN 2 THEN 5 ELSE 0 END', edit, line)} END"


_ROW = "chr(10) || role || ':' || text"
#: Cheapest edits turn by turn, for each role that may be due: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
OP12_SQL = f"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ord(x)::BIGINT)),
           lambda r, b: list_reduce(list_prepend(xor(r, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 20 AS d
  FROM conversations
), b AS (
  SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM o, generate_series(0, CASE d WHEN 3 THEN 1 ELSE 0 END) WHERE d <> 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS k,
         substr(role, 1, 1) AS i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM b
), m AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS same FROM n
), r AS (
  SELECT *, CASE WHEN bare = '' OR same > 1 THEN 1 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 2 ELSE 0 END AS f, lag(i) OVER (PARTITION BY conv_id ORDER BY k) || i AS pair FROM m
), ids AS (
  SELECT DISTINCT conv_id FROM conversations
), s(conv_id, k, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, struct_pack(c := 0::BIGINT, a := '', t := ''), CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)), CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)), CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) FROM ids
  UNION ALL
  SELECT conv_id, k, {_way("s0", "2", "D")},
         {_least(_way("s1", "2", "D"), _stays("s0", 0, "K", _ROW, "i = 's'"))},
         {_least(_way("i2", "2", "D"), *(_stays(x, 0, "K", _ROW, "i = 'u'") for x in ("s0", "s1", "i3")), *(_stays(x, 1, "R", _USER + " || text") for x in ("s0", "s1", "i3")))},
         {_least(_way("i3", "2", "D"), _stays("i2", 0, "K", _ROW, "i = 'a'"), _stays("i2", 1, "R", _ASSISTANT + " || text"))}
  FROM (
    SELECT *, {_least("s3", _way("i2", "5", "I", _ASSISTANT))} AS i3 FROM (
      SELECT s.*, r.role, r.text, r.i, r.f, {_least("s.s2", *(_way(x, "5", "I", _USER) for x in ("s.s0", "s.s1", "s.s3")))} AS i2
      FROM (SELECT conv_id, k + 1 AS k, s0, s1, s2, s3 FROM s) AS s JOIN r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.k = r.k
    )
  )
), e AS (
  SELECT conv_id, {_least("s0", "s3", _way("s2", "5", "I", _ASSISTANT), _way("s1", "10", "II", _USER + " || " + _ASSISTANT))} AS best
  FROM s QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (bare = '') AS blank, count(*) FILTER (bare <> '' AND same > 1) AS duplicate,
         count(*) FILTER (f = 2) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       best.c AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
FROM e LEFT JOIN g ON e.conv_id IS NOT DISTINCT FROM g.conv_id
"""


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import read_back, windows, with_probe

    return read_back(windows(with_probe(spark, table(spark, sf_dir, "conversations"))))


#: The template's 19 characters of marks, a budget of 1024 tokens, and at most two turns of 256 tokens repeated.
OP13_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), w AS (
  SELECT *, CAST(ceil(octet_length(encode(text)) / 4.0) AS BIGINT) + 4 AS tok,
         length(regexp_replace(role, '<(\\*)(turn>|text>|/turn>)', '<\\\1\2', 'g')) + length(regexp_replace(text, '<(\\*)(turn>|text>|/turn>)', '<\\\1\2', 'g')) + 19 AS chars
  FROM c
), n AS (
  SELECT *, row_number() OVER o AS n, coalesce(sum(tok) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         max(tok) OVER (PARTITION BY conv_id) AS longest, sum(tok) OVER (PARTITION BY conv_id) AS total, first_value(role) OVER o = 'system' AS opens, first_value(tok) OVER o AS system_tok,
         first_value(chars) OVER o AS system_chars, lag(tok, 1) OVER o AS tok1, lag(chars, 1) OVER o AS chars1, lag(tok, 2) OVER o AS tok2, lag(chars, 2) OVER o AS chars2
  FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), r AS (
  SELECT *, greatest(1024 - CASE WHEN opens THEN system_tok ELSE 0 END - 256, 1) AS room FROM n
), k AS (
  SELECT *, CASE WHEN total <= 1024 THEN NULL ELSE greatest(room - longest, (room + 1) // 2) END AS stride FROM r
), a AS (
  SELECT *, coalesce(before // stride, 0) AS cut, coalesce(before + tok - (before // stride) * stride > room, FALSE) AS alone FROM k
), f AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, cut, alone ORDER BY n) = 1 AS leads, tok1 <= 256 AND NOT (opens AND n = 2) AS one FROM a
), h AS (
  SELECT *, chars + CASE WHEN leads THEN CASE WHEN opens AND n > 1 THEN system_chars ELSE 0 END + CASE WHEN one THEN chars1 ELSE 0 END
                         + CASE WHEN one AND tok1 + tok2 <= 256 AND NOT (opens AND n = 3) THEN chars2 ELSE 0 END ELSE 0 END AS written FROM f
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(written) AS BIGINT) AS formatted_chars
FROM h GROUP BY conv_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media": op1_media,
    "op2_packing": op2_packing,
    "op3_langid": op3_langid,
    "op4_simhash": op4_simhash,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_urlfilter": op7_urlfilter,
    "op8_secrets": op8_secrets,
    "op9_sharding": op9_sharding,
    "op10_warc": op10_warc,
    "op11_infill": op11_infill,
    "op12_repair": op12_repair,
    "op13_chat": op13_chat,
}

ORACLE_SQL: dict[str, str] = {"op7_urlfilter": OP7_SQL, "op10_warc": OP10_SQL, "op11_infill": OP11_SQL, "op12_repair": OP12_SQL, "op13_chat": OP13_SQL}
