"""One query per operator over the whole of its table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewire.llm import audit, blockjoin, bytebpe, fim, hmm, kdtree, lines, minhash, packing, records, sharding, toxicity, warc
from tablewire.llm.shared import fold_of, read_table

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), WORD_BPE, end_id=0, capacity=2048)
    return packed.withColumnRenamed("key", "doc_id")


def op2_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    train = read_table(spark, sf_dir, "labels").where(fold_of("doc_id") != 0)
    lexicon = toxicity.learn(docs, train)
    rated = docs.select("doc_id", toxicity.rating(spark, lexicon, F.col("text")).alias("rated"))
    return rated.select(
        "doc_id",
        (fold_of("doc_id") == 0).alias("held_out"),
        "rated.score",
        (F.col("rated.score") >= 0.5).cast("int").alias("predicted"),
        "rated.n_matches",
    )


def op3_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.exact_top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10, scale=1024)


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.remove_boilerplate(read_table(spark, sf_dir, "documents"), min_sites=8, max_share=0.9, min_words=4)
    return cleaned.select("doc_id", "text")


def op5_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockjoin.nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op6_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=5, percent=85)
    return found.withColumnRenamed("key", "doc_id")


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm.score(read_table(spark, sf_dir, "documents"), held_out=fold_of("doc_id") == 1)
    return scored.withColumnRenamed("key", "doc_id")


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = records.write_records(read_table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)
    return records.read_records(spark, written).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bytebpe.round_trip(read_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return coded.select(
        F.col("key").alias("doc_id"),
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), n_shards=40)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = fim.fill_in_middle(read_table(spark, sf_dir, "documents"), rate=100, spm_rate=50, seed=7)
    return formed.select(
        F.col("key").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored().cast("binary"), 256).alias("restored_sha256"),
    )


def op12_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write_archive(read_table(spark, sf_dir, "pages"), revisit_bytes=0, shard_bytes=16 << 20, roll_bytes=8 << 20)
    return warc.read_archive(spark, written).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return audit.audit(docs, labels, audit.word_filters(), copies="E")


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_toxicity_lexicon": op2_toxicity_lexicon,
    "op3_kd_tree_top_k": op3_kd_tree_top_k,
    "op4_line_spread": op4_line_spread,
    "op5_block_matrix_join": op5_block_matrix_join,
    "op6_circulant_minhash": op6_circulant_minhash,
    "op7_hidden_markov": op7_hidden_markov,
    "op8_binary_records": op8_binary_records,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_minimax_shards": op10_minimax_shards,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sharded_warc": op12_sharded_warc,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op3_kd_tree_top_k": """
        WITH whole AS (
            SELECT vec_id AS id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.id AS query_id, c.id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.id <> c.id WHERE q.id % 100 = 0),
        ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                vec_id, score FROM scored)
        SELECT * FROM ranked WHERE rank <= 10""",
    "op5_block_matrix_join": """
        WITH usable AS (
            SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scored AS (
            SELECT q.id AS query_id, c.id AS vec_id, list_inner_product(q.v, c.v) AS score
            FROM usable q JOIN usable c ON q.id <> c.id WHERE q.id % 20 = 0),
        ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                vec_id, score FROM scored)
        SELECT * FROM ranked WHERE rank <= 20""",
    "op4_line_spread": r"""
        WITH split AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
        raw AS (SELECT doc_id, source, unnest(parts) AS raw, generate_subscripts(parts, 1) AS place FROM split),
        lines AS (
            SELECT *, trim(regexp_replace(raw, '[\x09-\x0D ]+', ' ', 'g')) AS body,
                CASE WHEN body = '' THEN 0 ELSE length(body) - length(replace(body, ' ', '')) + 1 END AS words
            FROM raw),
        shared AS (
            SELECT body, min((doc_id, place)) AS first FROM lines WHERE words >= 4
            GROUP BY body HAVING count(DISTINCT source) >= 8),
        marked AS (SELECT l.*, s.first FROM lines l LEFT JOIN shared s ON l.body = s.body AND l.words >= 4),
        docs AS (
            SELECT doc_id, sum(words) FILTER (first IS NOT NULL) AS shared_words, sum(words) AS all_words,
                string_agg(raw, chr(10) ORDER BY place)
                    FILTER (first IS NULL OR first = (doc_id, place)) AS rest
            FROM marked GROUP BY doc_id)
        SELECT doc_id, CASE WHEN coalesce(shared_words, 0) > 0.9::DOUBLE * all_words
                AND min(doc_id) OVER (PARTITION BY text) < max(doc_id) OVER (PARTITION BY text) THEN text
            ELSE coalesce(rest, '') END AS text
        FROM split JOIN docs USING (doc_id)""",
    "op6_circulant_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
        reach AS (
            SELECT doc_id AS node, doc_id AS other FROM documents
            UNION SELECT node, b FROM reach JOIN links ON other = a),
        parts AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents JOIN parts ON node = doc_id LEFT JOIN sizes USING (doc_id)""",
    "op11_fill_in_middle": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
                regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
        drawn AS (
            SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (n + 1) AS c1, ('0x' || h[9:16])::BIGINT % (n + 1) AS c2,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                        OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
                    WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut),
        pieces AS (
            SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS p,
                coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
                coalesce(array_to_string(u[greatest(c1, c2) + 1:n], ''), '') AS s FROM drawn)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
        FROM pieces""",
    "op12_sharded_warc": """
        WITH paid AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(html)) AS size,
                max(page_id) OVER (PARTITION BY html) AS last, sha1(html) AS h
            FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
        SELECT page_id, size AS payload_bytes,
            list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (('0x' || h[5 * (i // 4) + 1:5 * (i // 4) + 5])::BIGINT >> (15 - 5 * (i % 4)))::INTEGER % 32 + 1, 1)),
                'string_agg', '') AS payload_digest,
            CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> last THEN last END AS refers_to
        FROM paid""",
    "op13_filter_audit": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        failed AS (
            SELECT doc_id, part, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
                || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails FROM texts),
        known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        cells AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
            FROM failed LEFT JOIN known USING (doc_id) GROUP BY part, fails),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
        counted AS (
            SELECT part, filter_order, step, filter_order[step] AS letter,
                coalesce(sum(n) FILTER (translate(fails, filter_order[1:step], '') = fails), 0)::BIGINT AS kept,
                coalesce(sum(n) FILTER (gone), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (contains(fails, filter_order[step]) AND NOT gone), 0)::BIGINT AS redundant,
                coalesce(sum(n) FILTER (fails = filter_order[step]), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (gone), 0)::BIGINT AS good_lost,
                coalesce(sum(toxic) FILTER (gone), 0)::BIGINT AS toxic_lost
            FROM (SELECT *, contains(fails, filter_order[step])
                AND translate(fails, filter_order[1:step - 1], '') = fails AS gone FROM cells, steps)
            GROUP BY part, filter_order, step)
        SELECT * EXCLUDE (letter), sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM counted""",
}
