"""Queries that apply the operators of this package to their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, counted_join, decontaminate, exact, lines, lm, minhash, mixing, resample, tokenfiles, toxicity, urls, warc
from .workspace import Workspace


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark, "warc").path("archives")
    warc.write_archives(warc.to_records(_table(spark, sf_dir, "pages")), path)
    back = warc.read_archives(spark, path).where(F.col("record_type").isin("response", "revisit"))
    # A response's figures come from its decoded payload, a revisit's from its headers.
    whole = F.col("record_type") == "response"
    return back.select(
        warc.page_of("record_id").alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", warc.page_of("refers_to").alias("refers_to"), "target_uri",
    )


PROBE = [(-7, t, role, "</s>[INST] ok [/INST]") for t, role in enumerate(("user", "assistant"))]


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))
    made = Workspace(spark, "chat").save(chat.format_conversations(rows), "formatted")
    text = made.select("conv_id", "valid", chat.formatted().alias("formatted"), chat.loss_text().alias("loss"))
    back = text.select("*", chat.parse(F.col("formatted")).alias("turns"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    gone = lines.dropped_lines(lines.find_repeats(docs, by_chars=True))
    return docs.select("doc_id").join(gone, "doc_id", "left").select("doc_id", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped_lines"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.flat(mixing.mix(_table(spark, sf_dir, "documents")))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
LISTED = [("spam-farm.example.org", "/"), ("cheap-pills.example.com", "/"), ("spam-farm.example.net", "/"), ("cheap-pills.example.org", "/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame(LISTED, "host string, path string")
    return urls.judge(_table(spark, sf_dir, "pages"), rules, listed)


OP7_SQL = """
WITH rules(host, path, verdict, is_rule) AS (VALUES
  ('com', '/', 'allow', true), ('example.com', '/en/', 'block', true), ('www.example.com', '/en/', 'allow', true),
  ('net', '/es/', 'block', true), ('net', '/fr/', 'block', true), ('spam-farm.example.org', '/', 'block', false),
  ('cheap-pills.example.com', '/', 'block', false), ('spam-farm.example.net', '/', 'block', false), ('cheap-pills.example.org', '/', 'block', false)
), cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*', 0)) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), hits AS (
  SELECT p.page_id, r.is_rule, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY r.is_rule DESC, length(r.host || r.path) DESC) AS k
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, CASE WHEN h.is_rule THEN h.rule END AS rule, coalesce(h.verdict, 'allow') AS verdict
FROM p LEFT JOIN hits h ON h.page_id = p.page_id AND h.k = 1
"""


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    fold = toxicity.fold()
    scored = toxicity.score(docs, toxicity.learn(docs, labels, fold != 0))
    # Nothing is learned from rows without an id.
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences")


OP8_SQL = """
WITH g AS (
  SELECT sha256(coalesce(text, '')) AS text_sha256, max(doc_id) AS keep_id, count(*) AS group_size
  FROM documents GROUP BY 1
)
SELECT d.doc_id, g.keep_id, g.group_size, g.keep_id = d.doc_id AS kept, g.text_sha256
FROM documents d JOIN g ON g.text_sha256 = sha256(coalesce(d.text, ''))
"""


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5)


def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = Workspace(spark, "token-output").path("files")
    # This tokenizer composes characters, then drops all white space, and joins nothing across it.
    tokenfiles.write_documents(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end=1, drops_space=True)
    return tokenfiles.read_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=1, buckets=10_000, percent=10, least_words=20, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_hot_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    def side(table: str, own: str, amount: str) -> DataFrame:
        h = F.crc32(F.col(own).cast("string"))
        cents = F.coalesce(F.floor(100 * F.col(amount) + 0.5).cast("string"), F.lit(""))
        rows = _table(spark, sf_dir, table).select(
            F.col(own).cast("long").alias("id"), F.when(h % 10 < 3, F.floor(h / 10) % 7).otherwise(F.col("client_id")).cast("long").alias("client_id"),
            F.crc32(F.concat(F.col(own).cast("string"), F.lit(":"), cents)).alias("crc"),
        )
        return counted_join.counted(rows, ["id", "client_id", "crc"])

    clicks, sales = counted_join.join_totals(side("clicks", "click_id", "value"), side("sales", "sale_id", "total"), "client_id", ["crc"])
    both = clicks.withColumn("side", F.lit("click")).unionByName(sales.withColumn("side", F.lit("sale")))
    sums = [F.sum(c).alias(c) for c in ("copies", "inner_rows", "left_rows", "full_rows", "partner_crc")]
    return both.groupBy("side", "id").agg(F.min("client_id").alias("client_id"), *sums)


#: The CRC-32 of zlib over the bytes of hexadecimal digits h, by its table of 256 remainders; the text's FROM must have crc_table.
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i)))"""


def _crc_sql(text: str) -> str:
    digits = f"hex(encode({text}))"
    values = f"list_transform(range(length({digits}) // 2), lambda k: ('0x' || substr({digits}, (2 * k + 1)::INT, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), lambda c, b: xor(c // 256, crc_table.t[xor(c, b) % 256 + 1])), 4294967295::BIGINT)"


OP12_SQL = f"""
WITH {_CRC_TABLE}, d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), dw AS (SELECT doc_id, unnest(ws) AS w FROM d), bw AS (SELECT unnest(ws) AS w FROM b),
words AS (SELECT w, {_crc_sql('w')} % 10000 AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc_table),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN words USING (w) GROUP BY 1), t AS (SELECT bucket, count(*) AS n FROM bw JOIN words USING (w) GROUP BY 1),
gain AS (
  SELECT i AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (SELECT coalesce(sum(n), 0) + 10000 FROM s)::DOUBLE
                                      / ((coalesce(s.n, 0) + 1)::DOUBLE * (SELECT coalesce(sum(n), 0) + 10000 FROM t)::DOUBLE)))::BIGINT AS g
  FROM range(10000) r(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i
), f AS (SELECT doc_id, count(*) AS n_features, floor(sum(g) / count(*))::BIGINT AS weight FROM dw JOIN words USING (w) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT d.doc_id, coalesce(f.n_features, 0) AS n_features, coalesce(f.weight, 0) AS weight, len(ws) AS n_words,
         coalesce(f.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN f ON f.doc_id = d.doc_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS k, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM ranked
"""

OP13_SQL = f"""
WITH {_CRC_TABLE}, c AS (
  SELECT 'click' AS side, click_id AS id, client_id, count(*) AS copies, click_id || ':' || coalesce(floor(100 * value + 0.5)::BIGINT::VARCHAR, '') AS told FROM clicks GROUP BY ALL
), s AS (
  SELECT 'sale' AS side, sale_id AS id, client_id, count(*) AS copies, sale_id || ':' || coalesce(floor(100 * total + 0.5)::BIGINT::VARCHAR, '') AS told FROM sales GROUP BY ALL
), hashed AS (SELECT *, {_crc_sql('id::VARCHAR')} AS h, {_crc_sql('told')} AS crc FROM (SELECT * FROM c UNION ALL SELECT * FROM s), crc_table),
keyed AS (SELECT side, id, CASE WHEN h % 10 < 3 THEN h // 10 % 7 ELSE client_id END AS client_id, copies, crc FROM hashed),
totals AS (SELECT side, client_id, sum(copies) AS n, sum(copies * crc) AS crcs FROM keyed WHERE client_id IS NOT NULL GROUP BY 1, 2)
SELECT k.side, k.id, k.client_id, k.copies::BIGINT AS copies, (k.copies * coalesce(t.n, 0))::BIGINT AS inner_rows,
       (k.copies * CASE WHEN k.side = 'click' THEN greatest(coalesce(t.n, 0), 1) ELSE coalesce(t.n, 0) END)::BIGINT AS left_rows,
       (k.copies * greatest(coalesce(t.n, 0), 1))::BIGINT AS full_rows, (k.copies * coalesce(t.crcs, 0))::BIGINT AS partner_crc
FROM keyed k LEFT JOIN totals t ON t.client_id = k.client_id AND t.side <> k.side
"""

OP2_SQL = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to, url AS target_uri
FROM p
"""

#: Escapes make a text longer by one character for each backslash and two for each control string.
OP3_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + length(text) + 24 + length(text) - length(replace(text, chr(92), '')) + 2 * list_sum(list_transform(
    ['<|im_start|>', '<|im_end|>', '<|endoftext|>', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>'],
    lambda k: (length(text) - length(replace(text, k, ''))) // length(k))) AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE '?' END, '' ORDER BY turn), 's?(ua)+') AS valid
FROM e GROUP BY conv_id
"""

OP5_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT y, c FROM r JOIN both_ways ON x = r.doc_id),
top AS (SELECT doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, top.c AS component_id, top.c = d.doc_id AS kept
FROM documents d JOIN top ON top.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_decontamination, op2_warc, op3_chat_format, op4_line_dedup, op5_minhash_near_dedup, op6_mixing, op7_url_filter, op8_exact_dedup, op9_toxicity, op10_lm_score, op11_token_output, op12_resampling, op13_hot_key_join)}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op3_chat_format": OP3_SQL, "op5_minhash_near_dedup": OP5_SQL, "op7_url_filter": OP7_SQL, "op8_exact_dedup": OP8_SQL, "op12_resampling": OP12_SQL, "op13_hot_key_join": OP13_SQL}
