"""One query for each operator over its whole table, and the SQL of those that have one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderpulse.llm import (bpe, conversations, decontaminate, langid, negatives, pii, simhash,
                            substrings, token_counts, topk, toxicity, urlfilter, warc)
from orderpulse.llm.common import held_out, saved, table
from orderpulse.session import fresh_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, PATTERN)


WORD = r"[^ \t\n\r]+"
WORD_NO_NUMBER = r"[^ \t\n\r]*[^0-9 \t\n\r][^ \t\n\r]*"
PIECE = r"[A-Za-z]+|[0-9]|[^A-Za-z0-9 \t\n\r]"
PIECE_NO_NUMBER = r"[A-Za-z]+|[^A-Za-z0-9 \t\n\r]"


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First batch: all documents come in, counted by two tokenizers. Second batch, sent twice:
    documents of low quality go, and toxic ones are counted anew without their numbers."""
    docs = table(spark, sf_dir, "documents")
    count = lambda form: F.coalesce(F.regexp_count("text", F.lit(form)), F.lit(0)).cast("long")  # noqa: E731
    counts = saved(docs.select("doc_id", "source", "lang", F.explode(F.array(
        F.struct(F.lit("words-1").alias("tokenizer"), count(WORD).alias("n_tokens"),
                 count(WORD_NO_NUMBER).alias("fewer")),
        F.struct(F.lit("pieces-1").alias("tokenizer"), count(PIECE).alias("n_tokens"),
                 count(PIECE_NO_NUMBER).alias("fewer")))).alias("c"))
        .select("doc_id", "source", "lang", "c.*"), "counts")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    marked = counts.join(labels, "doc_id")
    second = token_counts.deletes(marked.filter("quality = 0")).union(
        token_counts.revisions(marked.filter("toxic = 1 and coalesce(quality, 1) != 0"), "fewer"))
    rollup = token_counts.Rollup.create(spark, fresh_path(spark, "rollup"))
    rollup.commit("1", token_counts.inserts(counts))
    rollup.commit("2", second)
    rollup.commit("2", second)
    return rollup.totals()


OP3_SQL = f"""
WITH counts AS (
  SELECT doc_id, source, lang, 'words-1' AS tokenizer,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n,
    len(regexp_extract_all(coalesce(text, ''), '{WORD_NO_NUMBER}')) AS fewer FROM documents
  UNION ALL
  SELECT doc_id, source, lang, 'pieces-1',
    len(regexp_extract_all(coalesce(text, ''), '{PIECE}')),
    len(regexp_extract_all(coalesce(text, ''), '{PIECE_NO_NUMBER}')) FROM documents),
marks AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1)
SELECT source, lang, tokenizer, count(*) AS n_docs,
  sum(CASE WHEN toxic = 1 THEN fewer ELSE n END)::BIGINT AS n_tokens
FROM counts LEFT JOIN marks USING (doc_id)
WHERE coalesce(quality, 1) <> 0 GROUP BY 1, 2, 3"""


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return members.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
                          .alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       toxicity.score(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    of_kind = (pii.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS)
    return found.select("doc_id", *of_kind,
                        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated(table(spark, sf_dir, "documents"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


OP9_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""

START, YEAR = 1_704_067_200, 31_536_000
LISTS = ("adult", "malware")


def _number(text: Column, below: int) -> Column:
    """A number below a limit from the digest of a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % below


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures of one year, against lists whose histories are made of the keys of the
    pages; the digest of URL or key gives the times."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", START + _number(F.coalesce("url", F.lit("")), YEAR))
    url = F.col("url")
    keys = pages.select(F.explode(F.array(urlfilter.path_of(url), urlfilter.host_of(url),
                                          urlfilter.domain_of(url))).alias("key")).filter(
        "key is not null").distinct()
    named = keys.select("key", F.explode(F.array(*map(F.lit, LISTS))).alias("list"))
    seed = lambda what: F.concat(F.lit(what), F.lit(":"), "list", F.lit(":"), "key")  # noqa: E731
    added = START + _number(seed("add"), YEAR)
    removed = added + 1 + _number(seed("remove"), YEAR // 2)
    again = removed + 1 + _number(seed("again"), YEAR // 2)
    entries = named.filter(_number(seed("listed"), 10) < 4).select("list", "key", F.explode(F.array(
        F.struct(F.lit("add").alias("action"), added.alias("at")),
        F.struct(F.lit("remove").alias("action"), removed.alias("at")),
        F.struct(F.lit("add").alias("action"), again.alias("at")))).alias("e")).select(
        "list", "key", "e.*")
    return urlfilter.judged(captures, entries)


def _sql_number(text: str, below: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % {below})"


OP10_SQL = rf"""
WITH p AS (
  SELECT page_id, url, {START} + {_sql_number("coalesce(url, '')", YEAR)} AS fetched,
    nullif(rtrim(lower(regexp_extract(url, '^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^/?#\]]*\]|[^/:?#]+)', 1)), '.'), '') AS host,
    nullif(regexp_extract(url, '^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1), '') AS part
  FROM pages),
k AS (
  SELECT *, host || '/' || part AS path,
    array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain FROM p),
keys AS (
  SELECT path AS key FROM k UNION SELECT host FROM k UNION SELECT domain FROM k),
named AS (
  SELECT key, list FROM keys, (VALUES ('{LISTS[0]}'), ('{LISTS[1]}')) AS l(list)
  WHERE key IS NOT NULL AND {_sql_number("'listed:' || list || ':' || key", 10)} < 4),
first AS (
  SELECT *, {START} + {_sql_number("'add:' || list || ':' || key", YEAR)} AS a FROM named),
second AS (
  SELECT *, a + 1 + {_sql_number("'remove:' || list || ':' || key", YEAR // 2)} AS r FROM first),
spans AS (
  SELECT list, key, a AS since, r AS until FROM second
  UNION ALL
  SELECT list, key, r + 1 + {_sql_number("'again:' || list || ':' || key", YEAR // 2)}, NULL
  FROM second),
hits AS (
  SELECT k.page_id, w.depth, w.key, count(*) AS n FROM k
  JOIN LATERAL (VALUES (1, k.path), (2, k.host), (3, k.domain)) AS w(depth, key) ON true
  JOIN spans s ON s.key = w.key AND fetched >= since AND (until IS NULL OR fetched < until)
  GROUP BY ALL),
best AS (SELECT page_id, arg_min(key, depth) AS rule, arg_min(n, depth) AS n FROM hits GROUP BY 1)
SELECT page_id, url, fetched, rule, coalesce(n, 0) AS n_lists, rule IS NOT NULL AS blocked
FROM k LEFT JOIN best USING (page_id)"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        .alias("label"))
    return negatives.mine(vectors, every=100, positives=5, negatives=5, low=80, high=100)


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, * FROM (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0)),
s AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.rid <> c.rid AND len(a.e) = len(c.e)),
p AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same QUALIFY place <= 5)
SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor, place ORDER BY score DESC, vec_id)::INTEGER AS rank
FROM p JOIN s ON s.anchor = p.anchor AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with known faults: of twenty rows one is dropped, one emptied, one cut off,
    one repeated and one given to the user. Nulls count as one space."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    fate = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return rows.withColumn("fate", fate).filter("fate != 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(
            text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("fate") == 3, 1).otherwise(0))).alias("copy"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversations.summaries(damaged(rows)).alias("f")
    every = rows.select("conv_id").distinct().alias("c")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")), "left").select(
        "c.conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP12_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce([4294967295] || [ord(c)::BIGINT FOR c IN string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM conversations),
fates AS (SELECT *, xor(crc, 4294967295) % 20 AS fate FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END
      AS text, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fates WHERE fate <> 0),
numbered AS (
  SELECT *, row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
    rtrim(text, E' 	

') AS body, left(role, 1) AS ini FROM damaged),
faults AS (
  SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY n) AS prev,
    CASE WHEN body = '' THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 2
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM numbered),
inserts(came, goes, extra, more, msgs) AS (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
  (1, 1, 0, '', []), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
  (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:'])),
ways AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, goes AS state, extra AS cost, more AS audit, msgs
  FROM faults, inserts WHERE came = 0
  UNION ALL
  SELECT conv_id, n, goes, cost + extra, audit || more, m || i.msgs FROM (
    SELECT w.conv_id, f.n, w.cost + CASE e.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
        + CASE WHEN fault = 3 AND e.edit <> 'D' THEN 3 ELSE 0 END AS cost,
      w.audit || e.edit AS audit,
      CASE e.edit WHEN 'D' THEN state WHEN 'R' THEN CASE state WHEN 2 THEN 3 ELSE 2 END
        ELSE CASE WHEN state = 0 AND ini = 's' THEN 1 WHEN state <> 2 AND ini = 'u' THEN 2
          WHEN state = 2 AND ini = 'a' THEN 3 END END AS state,
      w.msgs || CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
        ELSE [CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] END AS m
    FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
    JOIN (VALUES ('D'), ('K'), ('R')) AS e(edit) ON e.edit = 'D' OR fault IN (0, 3)) AS c
  JOIN inserts i ON i.came = c.state
  QUALIFY row_number() OVER (
    PARTITION BY conv_id, goes ORDER BY cost + extra, audit || more) = 1),
found AS (
  SELECT conv_id, min(turn) AS lo, max(turn) AS hi, count(DISTINCT turn) AS turns, max(n) AS n,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
best AS (
  SELECT f.*, w.cost, w.audit, sha256(array_to_string(w.msgs, chr(10))) AS sha
  FROM found f JOIN ways w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.n = f.n
  WHERE state IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY f.conv_id ORDER BY w.cost, w.audit) = 1)
SELECT c.conv_id, coalesce(hi - lo + 1 - turns, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id"""


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.Archive.write(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"), least=0)
    return archive.payloads().select("page_id", "payload_bytes", "payload_digest", "record_type",
                                     "refers_to")


#: Base 32 takes five bits for a letter, so five hex digits of the SHA-1 are four letters.
OP13_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
d AS (
  SELECT *, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4)) & 31) + 1, 1)
    FOR i IN range(32)], '') AS b32 FROM p)
SELECT page_id, strlen(html) AS payload_bytes, b32 AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM d"""

QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_byte_bpe, op3_token_counts, op4_simhash, op5_language, op6_toxicity,
    op7_personal_data, op8_substrings, op9_top_k, op10_url_filters, op11_hard_negatives,
    op12_conversations, op13_warc)}
ORACLES = {"op3_token_counts": OP3_SQL, "op9_top_k": OP9_SQL, "op10_url_filters": OP10_SQL,
           "op11_hard_negatives": OP11_SQL, "op12_conversations": OP12_SQL,
           "op13_warc": OP13_SQL}
