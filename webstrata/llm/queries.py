"""One query per operator over the given tables, and SQL for the same rows where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontamination, filter_audit, hard_negatives, line_dedup, near_duplicates, packing, pii, sharding, topk, toxicity,
    url_filters, warc,
)

TOP = 20
SHARDS = 8
SEQUENCE = 2048
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), TOP)


def _day(page_id: Column, step: int) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(page_id * step, F.lit(360)).cast("int"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A list history that grows with the pages: each adds or removes its host, its domain or its URL in one of three lists."""
    page, host = F.col("page_id"), url_filters.host_of(F.col("url"))
    turn = F.pmod(page, F.lit(3))
    key = (
        F.when(turn == 0, host)
        .when(turn == 1, F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
        .otherwise(F.concat(F.lit("url:"), F.regexp_replace("url", "#.*$", "")))
    )
    return pages.select(
        F.when(turn == 0, "malware").when(turn == 1, "spam").otherwise("takedown").alias("list_id"), key.alias("key"),
        F.when(F.pmod(page, F.lit(4)) == 1, "remove").otherwise("add").alias("action"), _day(page, 31).alias("entry_date"),
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.filter_captures(pages.withColumn("fetch_date", _day(F.col("page_id"), 17)), list_entries(pages))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_documents(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, SEQUENCE)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents"), pii.EXAMPLE_KEY)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    turned = F.when(vec_id % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", turned)
    return hard_negatives.hard_negatives(vectors, vec_id % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_topk, op2_url_filters, op3_sharding, op4_near_duplicates, op5_warc, op6_decontamination, op7_toxicity, op8_packing,
    op9_chat, op10_pii, op11_line_dedup, op12_filter_audit, op13_hard_negatives,
)}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1))"

ORACLES = {
    "op1_topk": f"""
        WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {TOP}""",
    "op2_url_filters": f"""
        WITH p AS (SELECT page_id, url, {_HOST} AS host, regexp_replace(url, '#.*$', '') AS bare,
                   CAST(DATE '2024-01-01' + CAST((page_id * 17) % 360 AS INTEGER) AS DATE) AS fetch_date FROM pages),
        e AS (SELECT CASE page_id % 3 WHEN 0 THEN 'malware' WHEN 1 THEN 'spam' ELSE 'takedown' END AS list_id,
                CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_extract(host, '([^.]+\\.[^.]+)$', 1) ELSE 'url:' || bare END AS key,
                CAST(DATE '2024-01-01' + CAST((page_id * 31) % 360 AS INTEGER) AS DATE) AS day, page_id % 4 <> 1 AS addition FROM p),
        d AS (SELECT list_id, key, day, bool_or(addition) AS addition FROM e GROUP BY ALL),
        m AS (SELECT p.page_id, d.*, row_number() OVER (PARTITION BY p.page_id, list_id, key ORDER BY day DESC) AS back
              FROM p JOIN d ON d.day <= p.fetch_date AND (d.key = host OR ends_with(host, '.' || d.key) OR d.key = 'url:' || bare)),
        a AS (SELECT m.page_id, m.list_id, m.key, (SELECT min(x.day) FROM d x WHERE x.list_id = m.list_id AND x.key = m.key AND x.day <= m.day
                AND x.day > coalesce((SELECT max(y.day) FROM d y WHERE y.list_id = m.list_id AND y.key = m.key AND y.day <= m.day
                    AND NOT y.addition), DATE '0001-01-01')) AS valid_from FROM m WHERE back = 1 AND addition),
        f AS (SELECT page_id, count(*) AS n_active, min(struct_pack(list_id := list_id, key := key, valid_from := valid_from)) AS one FROM a GROUP BY 1)
        SELECT p.page_id, p.url, p.fetch_date, f.n_active IS NOT NULL AS rejected, coalesce(f.n_active, 0) AS n_active,
               one.list_id, one.key, one.valid_from FROM p LEFT JOIN f USING (page_id)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        f AS (SELECT *, strlen(html) AS size, min(page_id) OVER (PARTITION BY html) AS one FROM p)
        SELECT page_id, size AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN size >= 100 AND page_id <> one THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= 100 AND page_id <> one THEN one END AS refers_to FROM f""",
    "op6_decontamination": f"""
        WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
        bw AS (SELECT item_id, least(13, len(w)) AS n, w[i:i + least(13, len(w)) - 1] AS win
               FROM b, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i) WHERE len(w) > 0),
        d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
        dw AS (SELECT doc_id, n, i, w[i:i + n - 1] AS win FROM d, (SELECT DISTINCT n FROM bw) AS k,
               unnest(range(1, len(w) - n + 2)) AS t(i)),
        hit AS (SELECT DISTINCT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
        pos AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(j) GROUP BY 1),
        its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hit GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op9_chat": f"""
        WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        c AS (SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn, role, text) AS l FROM t GROUP BY 1),
        k AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, l FROM c GROUP BY l),
        m AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM k o WHERE len(o.l) > len(k.l) AND o.l[1] = k.l[1] AND o.l[1:len(k.l)] = k.l)),
        s AS (SELECT conv_id, n_copies, l, unnest(range(0, (len(l) - 1) // {chat.TURNS_A_SEGMENT} + 1)) AS segment FROM m)
        SELECT conv_id, segment, len(l) AS n_turns, n_copies, array_to_string(
            ['<|im_start|>' || replace(x.r, '<|', '< |') || chr(10) || replace(x.t, '<|', '< |') || '<|im_end|>' || chr(10)
             FOR x IN l[segment * {chat.TURNS_A_SEGMENT} + 1:(segment + 1) * {chat.TURNS_A_SEGMENT}]], '') AS text
        FROM s""",
    "op11_line_dedup": r"""
        WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents),
        k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        f AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        d AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last_doc AS gone FROM k LEFT JOIN f USING (key))
        SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256 FROM d GROUP BY doc_id""",
    "op12_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
        m AS (SELECT part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
              ['A', 'B', 'C', 'D', 'E'] AS names, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
               100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
               w.doc_id > least] AS marks FROM w LEFT JOIN labels l ON w.doc_id = l.doc_id),
        f AS (SELECT part, good, toxic, list_filter(names, lambda x, i: marks[i]) AS fails, count(*) AS n FROM m GROUP BY ALL),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
              WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
        s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own,
              string_split(filter_order[1:step - 1], '') AS before FROM o, range(1, 6) AS r(step)),
        r AS (SELECT part, filter_order, step, own,
                CAST(coalesce(sum(n) FILTER (NOT list_has_any(fails, before) AND NOT list_contains(fails, own)), 0) AS BIGINT) AS kept,
                CAST(coalesce(sum(n) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, own)), 0) AS BIGINT) AS removed,
                CAST(coalesce(sum(n) FILTER (list_has_any(fails, before) AND list_contains(fails, own)), 0) AS BIGINT) AS redundant,
                CAST(coalesce(sum(n) FILTER (fails = [own]), 0) AS BIGINT) AS unique_fails,
                CAST(coalesce(sum(n) FILTER (good AND NOT list_has_any(fails, before) AND list_contains(fails, own)), 0) AS BIGINT) AS good_lost,
                CAST(coalesce(sum(n) FILTER (toxic AND NOT list_has_any(fails, before) AND list_contains(fails, own)), 0) AS BIGINT) AS toxic_lost
              FROM f, s GROUP BY ALL)
        SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r""",
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
              FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
              row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
              FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
