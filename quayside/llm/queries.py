"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole
table and returns the digest columns of the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, collocations, decontam, langid, license, packing, pii, pst, quality, repair, sharding, simhash,
               tokens)
from .common import remainder, table

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), limit=TOKEN_LIMIT)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontam.items_digest(F.col("items")).alias("items_sha256"),
                        "contaminated")


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pst.score(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 10) == 0)


def held_out_lang():
    return remainder(F.col("doc_id"), 5) == 0


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, ~held_out_lang())
    out = langid.predict(docs.select("text", "doc_id"), model, ["doc_id"])
    return out.select("doc_id", held_out_lang().alias("held_out"), "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(hard).alias("text"))
    done = chat.format_log(chat.turn_events(rows.unionByName(extra)))
    read = done.select("conv", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    under = F.array_join(F.transform("loss_spans", lambda s: chat.unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")  # the mask, read back
    read = read.select("conv", "formatted", F.size("turns").cast("long").alias("n_turns"), whole.alias("whole"),
                       under.alias("under"))
    return read.select(
        F.col("conv").alias("conv_id"), "n_turns", F.sha2(F.col("whole").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("under").cast("long").alias("loss_chars"), F.sha2(F.col("under").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.fit(docs))


def op10_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"), inside=True)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=5, floor=100, top=2000)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = repair.damaged(table(spark, sf_dir, "conversations"))
    found = repair.audited(damaged)
    return found.join(repair.digests(damaged, found), F.col("conv_id").eqNullSafe(F.col("of_conv"))).drop("of_conv")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.by_bytes(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_token_counts, op3_decontamination, op4_suffix_tree, op5_language,
                                   op6_quality, op7_packing, op8_chat, op9_personal_data, op10_license,
                                   op11_collocations, op12_repair, op13_sharding)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op3_decontamination": f"""
WITH items AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, len(x) AS m, array_to_string(x, ' ') AS win FROM (
    SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 13 THEN [w]
      ELSE list_transform(range(1, len(w) - 11), lambda i: list_slice(w, i, i + 12)) END) AS x FROM items)),
lens AS (SELECT DISTINCT m FROM wins),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
spots AS (
  SELECT r, m, unnest(range(1, len(w) - m + 2)) AS i, w FROM docs, lens WHERE len(w) >= m),
hits AS (
  SELECT a.r, a.i, a.m, b.item_id FROM spots a JOIN wins b
    ON a.m = b.m AND array_to_string(list_slice(a.w, a.i, a.i + a.m - 1), ' ') = b.win),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)""",
    "op8_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, length(role) + length(text) + 24
    + length(role) - length(replace(role, '\', '')) + (length(role) - length(replace(role, '<|', ''))) // 2
    + length(role) - length(replace(role, chr(10), ''))
    + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '<|', ''))) // 2 AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
f AS (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase FROM (
      SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 6) t(m) WHERE len(w) >= m))
  GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
around AS (
  SELECT lang, phrase, max(a) AS around FROM (
    SELECT lang, a, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM (
      SELECT lang, a, w, k, unnest(range(1, m - k + 2)) AS i FROM c, range(2, 5) t(k) WHERE k < m)) GROUP BY ALL),
own AS (SELECT c.* FROM c LEFT JOIN around USING (lang, phrase) WHERE coalesce(100 * around < 100 * a, true)),
cut AS (
  SELECT own.lang, own.phrase, a, n.n, k, l.f AS l, r.f AS r,
         (1000 * CAST(a AS HUGEINT) * CAST(n.n AS HUGEINT)) // (CAST(l.f AS HUGEINT) * CAST(r.f AS HUGEINT)) AS score
  FROM own, range(1, 5) t(k), f AS l, f AS r, n
  WHERE k < own.m AND l.lang = own.lang AND l.phrase = array_to_string(list_slice(w, 1, k), ' ')
    AND r.lang = own.lang AND r.phrase = array_to_string(list_slice(w, k + 1, own.m), ' ') AND n.lang = own.lang),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS x FROM cut),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst WHERE x = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""",
    "op12_repair": r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
tab AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(CAST(n AS BIGINT), range(8)), lambda c, i:
      CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) x(n))),
crc AS (
  SELECT key, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda ch: CAST(ord(ch) AS BIGINT))),
    lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT key FROM src), tab),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src JOIN crc USING (key), range(2) x(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth,
         rtrim(text, E' \t\n\x0b\x0c\r') AS body, left(role, 1) AS ini FROM hurt),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS p FROM seen),
marked AS (
  SELECT *, body = '' AS blank, body <> '' AND nth > 1 AS dup,
         body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS cut,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM placed),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
step AS (
  SELECT conv_id, 0 AS p, {'c': 0, 'a': '', 't': ''} AS v0, {'c': 1000000000, 'a': '', 't': ''} AS vs,
         {'c': 1000000000, 'a': '', 't': ''} AS vu, {'c': 1000000000, 'a': '', 't': ''} AS va FROM ids
  UNION ALL
  SELECT conv_id, p,
    {'c': i0.c + 3, 'a': i0.a || 'D', 't': i0.t},
    list_min([{'c': is_.c + 3, 'a': is_.a || 'D', 't': is_.t},
              {'c': i0.c + CASE WHEN stays AND ini = 's' THEN cost ELSE 1000000000 END, 'a': i0.a || 'K', 't': i0.t || line}]),
    list_min(list_concat([{'c': iu.c + 3, 'a': iu.a || 'D', 't': iu.t}], list_concat(
      list_transform([i0, is_, ia], lambda x: {'c': x.c + CASE WHEN stays AND ini = 'u' THEN cost ELSE 1000000000 END,
        'a': x.a || 'K', 't': x.t || line}),
      list_transform([i0, is_, ia], lambda x: {'c': x.c + CASE WHEN stays THEN 2 + cost ELSE 1000000000 END,
        'a': x.a || 'R', 't': x.t || as_user})))),
    list_min([{'c': ia.c + 3, 'a': ia.a || 'D', 't': ia.t},
              {'c': iu.c + CASE WHEN stays AND ini = 'a' THEN cost ELSE 1000000000 END, 'a': iu.a || 'K', 't': iu.t || line},
              {'c': iu.c + CASE WHEN stays THEN 2 + cost ELSE 1000000000 END, 'a': iu.a || 'R', 't': iu.t || as_assistant}])
  FROM (
    SELECT s.conv_id, m.p, NOT m.blank AND NOT m.dup AS stays, m.ini, CAST(m.cut AS INT) AS cost,
           m.role || ':' || m.text || chr(10) AS line, 'user:' || m.text || chr(10) AS as_user,
           'assistant:' || m.text || chr(10) AS as_assistant, s.v0 AS i0, s.vs AS is_,
           list_min(list_concat([s.vu], list_transform([s.v0, s.vs, s.va], lambda x:
             {'c': x.c + 2, 'a': x.a || 'I', 't': x.t || 'user:' || chr(10)}))) AS iu,
           list_min([s.va, {'c': s.vu.c + 2, 'a': s.vu.a || 'I', 't': s.vu.t || 'assistant:' || chr(10)},
             {'c': s.v0.c + 4, 'a': s.v0.a || 'II', 't': s.v0.t || 'user:' || chr(10) || 'assistant:' || chr(10)},
             {'c': s.vs.c + 4, 'a': s.vs.a || 'II', 't': s.vs.t || 'user:' || chr(10) || 'assistant:' || chr(10)}]) AS ia
    FROM step s JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.p = s.p + 1)),
best AS (
  SELECT conv_id, list_min([v0, va, {'c': vu.c + 2, 'a': vu.a || 'I', 't': vu.t || 'assistant:' || chr(10)},
    {'c': vs.c + 4, 'a': vs.a || 'II', 't': vs.t || 'user:' || chr(10) || 'assistant:' || chr(10)}]) AS x
  FROM step QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY p DESC) = 1)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(x.c AS BIGINT) AS cost, x.a AS audit,
       sha256(left(x.t, greatest(length(x.t) - 1, 0))) AS repaired_sha256
FROM ids i LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM i.conv_id
JOIN best b ON b.conv_id IS NOT DISTINCT FROM i.conv_id""",
}
