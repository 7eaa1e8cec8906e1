"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, attribution, chat, common, fitting, langid, lexical, minhash, mixing, negatives, packing, radix, secrets, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.tuned(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.windows(rows.union(extra)))


def op2_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.attribute(table(spark, sf_dir, "documents"), "doc_id", ["source", "lang", "text"], by_line=("text",))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind.isin("assign", "access", "hex"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))
    held_out = (fitting.remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return scores.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentence_start", "sentence_end", "sentence_score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fitted(docs))
    held_out = (fitting.remainder(F.col("doc_id"), 3) == 1).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op11_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op12_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.usable(common.pick(rows, "vec_id", "embedding", "label").withColumn("label", label)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_windows": op1_chat_windows,
    "op2_token_attribution": op2_token_attribution,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_vector_packing": op4_vector_packing,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_temperature_mixing": op6_temperature_mixing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_warc_index": op11_warc_index,
    "op12_bag_search": op12_bag_search,
    "op13_bond_negatives": op13_bond_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op6_temperature_mixing": r"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, coalesce(source, '') AS source, (octet_length(encode(coalesce(text, ''))) + 3) // 4 AS tokens FROM documents),
        sources AS (SELECT source, sum(tokens)::BIGINT AS n FROM sized GROUP BY source HAVING sum(tokens) > 0),
        total AS (SELECT sum(n)::BIGINT AS t FROM sources),
        shares AS (SELECT source, n, n / t::DOUBLE AS p FROM sources, total),
        l AS (SELECT list(p) AS ps, 0.95 * ln(count(*)) AS target FROM shares),
        bisect(i, lo, hi) AS (
            SELECT 0, 0::BIGINT, 1073741824::BIGINT
            UNION ALL
            SELECT i + 1, CASE WHEN fine THEN mid ELSE lo END, CASE WHEN fine THEN hi ELSE mid END
            FROM (SELECT i, lo, hi, (lo + hi) // 2 AS mid,
                    ln(list_sum(list_transform(ps, lambda p: pow(p, ((lo + hi) // 2) / 1073741824.0))))
                    - ((lo + hi) // 2) / 1073741824.0
                    * list_sum(list_transform(ps, lambda p: pow(p, ((lo + hi) // 2) / 1073741824.0) * ln(p)))
                    / list_sum(list_transform(ps, lambda p: pow(p, ((lo + hi) // 2) / 1073741824.0))) >= target AS fine
                  FROM bisect, l WHERE i < 30)),
        alpha AS (SELECT CASE WHEN -list_sum(list_transform(ps, lambda p: p * ln(p))) >= target THEN 1.0::DOUBLE
                    ELSE (SELECT lo / 1073741824.0 FROM bisect WHERE i = 30) END AS a FROM l),
        weighed AS (SELECT source, n, pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, alpha) AS w FROM shares, alpha),
        plan AS (SELECT source, n, quota, quota // n AS epochs, quota % n AS rest, ceil(n / 262144.0)::BIGINT AS blocks
            FROM (SELECT source, n, floor(w * t + 0.5)::BIGINT AS quota FROM weighed, total)),
        uses AS (
            SELECT doc_id, source, tokens, epoch, n, quota, epochs, rest, blocks, u, floor(u * coalesce(blocks, 1))::BIGINT AS block
            FROM (SELECT *, ('0x' || substr(md5('mix|' || epoch || '|' || doc_id), 1, 12))::BIGINT / 281474976710656.0 AS u
                FROM (SELECT *, unnest(range(0, CASE WHEN n IS NULL THEN 1 ELSE epochs + (rest > 0)::INT END)) AS epoch
                    FROM sized LEFT JOIN plan USING (source)))),
        last AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY block, u, doc_id, tokens) AS r FROM uses WHERE epoch = epochs AND tokens > 0),
        filled(source, r, free, took) AS (
            SELECT source, 0::BIGINT, rest, false FROM plan
            UNION ALL
            SELECT source, last.r, CASE WHEN tokens <= free THEN free - tokens ELSE free END, tokens <= free
            FROM filled JOIN last USING (source) WHERE last.r = filled.r + 1),
        got AS (
            SELECT * FROM uses WHERE epoch <> epochs OR n IS NULL OR tokens = 0
            UNION ALL
            SELECT last.* EXCLUDE (r) FROM last JOIN filled USING (source, r) WHERE took),
        jittered AS (SELECT *, ('0x' || substr(md5('mix|' || source || '|' || epoch || '|' || block), 1, 12))::BIGINT / 281474976710656.0 AS j FROM got)
        SELECT doc_id, source, tokens, epoch, block,
            round(coalesce((epoch + (block + j) / blocks) * n / quota, j), 9) AS mix_key FROM jittered
    """,
    "op7_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
        k AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM k
    """,
    "op11_warc_index": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first_id,
            list_transform(range(8), lambda i: ('0x' || substr(hex, 5 * i + 1, 5))::BIGINT) AS fives FROM p),
        d AS (SELECT *, list_transform(fives, lambda v: array_to_string(list_transform([32768, 1024, 32, 1], lambda q: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v // q) % 32 + 1, 1)), '')) AS fours FROM k)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, array_to_string(fours, '') AS payload_digest,
            CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM d
    """,
    "op12_bag_search": r"""
        WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        d AS (SELECT doc_id, terms, len(terms)::BIGINT AS n FROM t WHERE len(terms) > 0),
        s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d),
        f AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term, docs),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN f USING (term), s GROUP BY item_id, doc_id)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM r WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
    "op13_bond_negatives": r"""
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
            row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
            FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
}
