"""The operators of this subpackage as queries over the whole given tables, with SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurio.session import configure

from . import (classlm, decontamination, htmltext, lexical, merkle, neardup, piecebpe, quality, resharding, tokenfiles,
               toxicity, warc, wordbpe)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return register


@query("op1_tag_path_ratios")
def tag_path_ratios(table):
    return htmltext.extract_text(table("pages"))


@query("op3_class_language_model")
def class_language_model(table):
    return classlm.score_texts(table("documents"))


@query("op2_minhash_near_dedup")
def near_dedup(table):
    docs = table("documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, shingle=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query("op4_benchmark_decontamination")
def benchmark_decontamination(table):
    return decontamination.find_leaks(table("documents"), table("benchmark"))


@query("op8_bpe_encode_decode")
def bpe_encode_decode(table):
    return wordbpe.digests(table("documents").select("doc_id", "text"))


@query("op9_toxicity")
def toxicity_scores(table):
    docs = table("documents").select("doc_id", "text")
    model = toxicity.fit(docs, table("labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
        "toxic_windows")


@query("op10_quality_rules")
def quality_rules(table):
    found = quality.line_quality(table("documents"))
    return found.select("doc_id", *quality.STATS, "kept", "words_left")


@query("op5_token_id_orc")
def token_id_orc(table):
    rows = tokenfiles.round_trip(table("documents"))
    return tokenfiles.checksums(rows.select("doc_id", "start", "n_tokens", "ids"))


@query("op6_warc_normaliser", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                    ELSE page_id END AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to FROM f""")
def warc_normaliser(table):
    return warc.confirmed(warc.round_trip(table("pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_flow_resharding")
def flow_resharding(table):
    # the old layout: twelve shards by source, as a crawl leaves them, so their sizes differ widely
    old = F.pmod(F.xxhash64("source"), F.lit(12))
    placed = resharding.round_trip(table("documents"), old, 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@query("op13_piece_bpe")
def piece_bpe(table):
    return piecebpe.digests(table("documents").select("doc_id", "text"))


@query("op12_merkle_manifest", """
    WITH RECURSIVE parity(doc_id, s, i, c) AS (  -- CRC-32 of the decimal form, bit by bit
        SELECT doc_id, CAST(doc_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT)
        FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
        UNION ALL
        SELECT doc_id, s, i + 1, xor(x >> 1, (x & 1) * CAST(3988292384 AS BIGINT))
        FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE c END AS x
              FROM parity WHERE i < 8 * length(s))),
    even AS (SELECT doc_id FROM parity WHERE i = 8 * length(s) AND c & 1 = 1),  -- the last step inverts the bits
    texts AS (SELECT *, CASE WHEN doc_id IN (SELECT doc_id FROM even) THEN replace(text, chr(10), '') ELSE text END AS bent
              FROM documents),
    leaves AS (
        SELECT doc_id, source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree,
               sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               sha256(head || coalesce(strlen(bent) || ':' || bent, '-')) AS folded
        FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                     || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                     || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM texts)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
    up(tree, lvl, pos, h, n) AS (
        SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
        UNION ALL
        SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
        FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 3),
    subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM up WHERE n = 1),
    top(lvl, pos, h, n) AS (
        SELECT 0, pos, h, count(*) OVER () FROM subroots
        UNION ALL
        SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
        FROM top WHERE n > 1 GROUP BY lvl, pos // 3),
    near AS (SELECT tree, lvl, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
             FROM up WHERE n > 1 WINDOW w AS (PARTITION BY tree, lvl, pos // 3 ORDER BY pos)),
    far AS (SELECT lvl, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM top WHERE n > 1 WINDOW w AS (PARTITION BY lvl, pos // 3 ORDER BY pos)),
    steps AS (
        SELECT p.tree, p.pos, s.lvl, s.l, s.r FROM placed p JOIN near s
        ON s.tree = p.tree AND s.pos = p.pos // CAST(pow(3, s.lvl) AS BIGINT)
        UNION ALL
        SELECT p.tree, p.pos, 1000 + s.lvl, s.l, s.r FROM placed p JOIN subroots t ON t.tree = p.tree
        JOIN far s ON s.pos = t.pos // CAST(pow(3, s.lvl) AS BIGINT)),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, pos ORDER BY lvl) - 1 AS k FROM steps),
    proofs AS (SELECT tree, pos, count(*) AS k, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM numbered GROUP BY tree, pos),
    fold(tree, pos, k, h) AS (
        SELECT tree, pos, 0, folded FROM placed
        UNION ALL
        SELECT f.tree, f.pos, f.k + 1, sha256(s.l || f.h || s.r) FROM fold f
        JOIN numbered s ON s.tree = f.tree AND s.pos = f.pos AND s.k = f.k)
    SELECT p.doc_id, p.leaf, t.h AS subroot, z.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
           f.h AS folded_root, f.h = z.h AS verified
    FROM placed p JOIN subroots t ON t.tree = p.tree CROSS JOIN (SELECT h FROM top WHERE n = 1) z
    LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos
    JOIN fold f ON f.tree = p.tree AND f.pos = p.pos AND f.k = coalesce(q.k, 0)""")
def merkle_manifest(table):
    return merkle.manifest(table("documents"), ["doc_id", "source", "lang", "n_chars", "text"],
                           tampered={"text": merkle.without_newlines()})


@query("op11_ranked_search", r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
    b AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
    size AS (SELECT count(*) AS nn, sum(len(terms))::BIGINT AS ll FROM d WHERE len(terms) > 0),
    q AS (SELECT item, item_id, term, count(*) AS times
          FROM (SELECT item, item_id, unnest(terms) AS term FROM b) GROUP BY ALL),
    p AS (SELECT row, doc_id, n, term, count(*) AS tf
          FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
          FROM p, size GROUP BY term),
    s AS (SELECT item, item_id, row, doc_id,
                 sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
          FROM q JOIN w USING (term) JOIN p USING (term), size GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
          FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20""")
def ranked_search(table):
    return lexical.rank_documents(table("documents"), table("benchmark"))
