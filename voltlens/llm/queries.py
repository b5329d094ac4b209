"""The thin ``opN_<name>`` queries over the given tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from voltlens.llm import (byte_bpe, decontaminate, fp_search, langid, licenses, merkle, ngram_join, repeats, secrets,
                          sharding, simhash, topk, toxicity)
from voltlens.llm.common import pick, table

RANKS = "byte_bpe_50k.tiktoken"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pick(table(spark, sf_dir, "documents"), {"doc_id": "doc_id", "text": "text"})


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle_words=3, max_bits=3)


def op2_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.shuffle_into_shards(rows, shards=24, seed=42)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir), scope_chars=200, keep=["doc_id"])
    shown = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(shown(base), 256).alias("base_sha256"),
                        shown(F.col("secrets")).alias("spans"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(documents(spark, sf_dir), length=50)
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    out = langid.predict(documents(spark, sf_dir), model, keep=["doc_id"])
    held_out = F.coalesce(~langid.learned(F.col("doc_id")), F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    coded = byte_bpe.encode(documents(spark, sf_dir), path, keep=["doc_id"], decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", split_positives=2)
    return toxicity.score(docs, model, keep=["doc_id"])


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, sf_dir), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir), shingle_words=3, percent=90)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    return merkle.verify(table(spark, sf_dir, "documents"), fanout=8, tampered=tampered)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_search.ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_shard_shuffle, op3_benchmark_decontamination, op4_secret_scan, op5_suffix_dedup,
    op6_language_id, op7_exact_top_k, op8_byte_bpe, op9_toxicity, op10_license_scan, op11_ngram_jaccard_join,
    op12_merkle_manifest, op13_ranked_search)}

SQL: dict[str, str] = {
    "op5_suffix_dedup": """
        WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
                      FROM documents),
        places AS (SELECT doc_id, n, unnest(range(n - 49)) AS i, h FROM docs WHERE n >= 50),
        windows AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS w FROM places),
        owners AS (SELECT w, min(doc_id) AS low FROM windows GROUP BY w),
        hits AS (SELECT doc_id, i FROM windows JOIN owners USING (w) WHERE low < doc_id),
        marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END
                   AS fresh FROM hits),
        runs AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
        cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans),
        pieces AS (SELECT c.doc_id, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS k, max(b) AS e,
                          count(*) AS spans, sum(b - a) AS gone
                   FROM cuts c JOIN docs d ON c.doc_id = d.doc_id GROUP BY c.doc_id)
        SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(CASE WHEN e IS NULL THEN h ELSE k || substr(h, 2 * e + 1) END)) AS kept_sha256
        FROM docs d LEFT JOIN pieces p ON d.doc_id = p.doc_id""",
    "op7_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
                  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
                   FROM pairs)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_ngram_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                 END AS s FROM words),
        cells AS (SELECT doc_id, len(s) AS n, unnest(s) AS c FROM sets),
        met AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS o
                FROM cells a JOIN cells b ON a.c = b.c AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
                GROUP BY ALL),
        links AS (SELECT x, y FROM met WHERE 100 * o >= 90 * (nx + ny - o)),
        reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents
                                UNION SELECT y, root FROM reach JOIN links ON reach.doc_id = links.x),
        low AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id),
        degree AS (SELECT x, count(*) AS k FROM links GROUP BY x)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links
        FROM sets s JOIN low ON s.doc_id = low.doc_id LEFT JOIN degree ON s.doc_id = degree.x""",
    "op12_merkle_manifest": """
        WITH RECURSIVE crc AS (
            SELECT *, list_reduce([4294967295] || flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
                   lambda i: [CAST(ord(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
                   lambda a, x: xor(xor(a, x) >> 1, CASE WHEN xor(a, x) % 2 = 1 THEN 3988292384 ELSE 0 END)) AS c
            FROM documents),
        texts AS (SELECT *, CASE WHEN xor(c, 4294967295) % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') ELSE text END AS altered FROM crc),
        heads AS (SELECT *, concat(
                  coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-'),
                  coalesce(octet_length(encode(source)) || ':' || source, '-'),
                  coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
                  coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-')) AS head FROM texts),
        leaves AS (SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(octet_length(encode(altered)) || ':' || altered, '-')) AS held FROM heads),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY lang) AS size FROM leaves),
        tree(lang, h, idx, size, hash) AS (
            SELECT lang, 0, place, size, leaf FROM placed
            UNION ALL
            SELECT lang, h + 1, idx // 8, (size + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx))
            FROM tree WHERE size > 1 GROUP BY lang, h, idx // 8, size),
        runs AS (SELECT lang, h, idx // 8 AS up, list(hash ORDER BY idx) AS kids FROM tree WHERE size > 1 GROUP BY ALL),
        climb(doc_id, lang, h, idx, folded, proof) AS (
            SELECT doc_id, lang, 0, place, held, '' FROM placed
            UNION ALL
            SELECT doc_id, c.lang, c.h + 1, idx // 8,
                   sha256(array_to_string(kids[1:idx % 8] || [folded] || kids[idx % 8 + 2:], '')),
                   proof || array_to_string(kids[1:idx % 8] || kids[idx % 8 + 2:], '')
            FROM climb c JOIN runs r ON c.lang IS NOT DISTINCT FROM r.lang AND c.h = r.h AND c.idx // 8 = r.up),
        subroots AS (SELECT lang, h, hash, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER () AS size
                     FROM tree WHERE size = 1),
        top(h, idx, size, hash) AS (
            SELECT 0, place, size, hash FROM subroots
            UNION ALL
            SELECT h + 1, idx // 8, (size + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx))
            FROM top WHERE size > 1 GROUP BY h, idx // 8, size),
        top_runs AS (SELECT h, idx // 8 AS up, list(hash ORDER BY idx) AS kids FROM top WHERE size > 1 GROUP BY ALL),
        ascent(doc_id, subroot, h, idx, folded, proof) AS (
            SELECT doc_id, s.hash, 0, s.place, folded, proof
            FROM climb c JOIN subroots s ON c.lang IS NOT DISTINCT FROM s.lang AND c.h = s.h
            UNION ALL
            SELECT doc_id, subroot, a.h + 1, idx // 8,
                   sha256(array_to_string(kids[1:idx % 8] || [folded] || kids[idx % 8 + 2:], '')),
                   proof || array_to_string(kids[1:idx % 8] || kids[idx % 8 + 2:], '')
            FROM ascent a JOIN top_runs r ON a.h = r.h AND a.idx // 8 = r.up),
        root AS (SELECT h, hash FROM top WHERE size = 1)
        SELECT a.doc_id, p.leaf, a.subroot, r.hash AS root, sha256(a.proof) AS proof_sha256, a.folded AS folded_root,
               a.folded = r.hash AS verified
        FROM ascent a JOIN root r ON a.h = r.h JOIN placed p ON a.doc_id = p.doc_id""",
    "op13_ranked_search": r"""
        WITH found AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        tfs AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
        lens AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
        total AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM lens),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                    FROM tfs, total GROUP BY term, nn),
        asked AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        wanted AS (SELECT item_id, term, count(*) AS c FROM asked GROUP BY ALL),
        scores AS (SELECT item_id, doc_id,
                          CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * nn) // ll))))) AS BIGINT) AS score
                   FROM wanted JOIN weights USING (term) JOIN tfs USING (term) JOIN lens USING (doc_id), total GROUP BY ALL),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
                   FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
