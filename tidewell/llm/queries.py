"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    collocations, decontamination, fill_in_middle, html_text, jaccard_join, language_id, licenses, piece_codec, quality, sharding,
    simhash, token_counts, topk,
)
from .common import id_remainder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    """Vocabulary of the registered query; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def sentencepiece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_codec.encode(read(spark, sf_dir, "documents"), piece_model())
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.assign(sized, ["doc_id", "size", "text_crc32"], 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id", 4) == 2
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held_out)
    scored, _ = quality.classify(docs, read(spark, sf_dir, "labels"), ~F.col("held_out"), carry=("held_out",))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", id_remainder("doc_id", 3) == 1)
    model = language_id.fit(docs, ~F.col("held_out"))
    return language_id.predict(docs, model, carry=("held_out",))


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("hits"))


def edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    docs = read(spark, sf_dir, "documents")
    return token_counts.count(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, edits_of=token_counts.redactions)


def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read(spark, sf_dir, "documents"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(read(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.array_join(c, " | ").alias(c) for c in ("sentence_ids", "licenses", "unclaimed")])


def middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(read(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def near_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": quality_scores,
    "op2_benchmark_hits": benchmark_hits,
    "op3_token_counts": edited_token_counts,
    "op4_similar_documents": similar_documents,
    "op5_page_texts": page_texts,
    "op6_nearest_vectors": nearest_vectors,
    "op7_sentencepiece": sentencepiece_ids,
    "op8_languages": languages,
    "op9_license_scans": license_scans,
    "op10_shards": shards,
    "op11_fill_in_middle": middles,
    "op12_near_fingerprints": near_fingerprints,
    "op13_collocations": phrases,
}

#: Check SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op4_similar_documents": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM words),
        tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
                AND 100 * a.n >= 75 * b.n AND 100 * b.n >= 75 * a.n
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reached AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
        FROM sets s JOIN reached r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s.s
    """,
    "op6_nearest_vectors": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
            vec_id, score
        FROM scored QUALIFY rank <= 10
    """,
    "op9_license_scans": licenses.check_sql(),
    "op11_fill_in_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        u AS (
            SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units, CAST('0x' || h[1:8] AS BIGINT) AS h1,
                CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
            FROM d),
        cut AS (
            SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM u),
        parts AS (
            SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
                array_to_string(units[b + 1:], '') AS s
            FROM cut)
        SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(p || m || s) AS restored_sha256
        FROM parts
    """,
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        sequences AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
        starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM sequences),
        grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM starts, (VALUES (1), (2), (3), (4), (5)) s(k) WHERE i + k - 1 <= len(w)),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM sequences GROUP BY lang),
        longer AS (
            SELECT c.lang, c.phrase FROM f c JOIN f x ON x.lang = c.lang AND x.k > c.k AND x.f >= c.f
                AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' ')
            GROUP BY ALL),
        cuts AS (
            SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut
            FROM f c WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM longer l WHERE l.lang = c.lang AND l.phrase = c.phrase)),
        scored AS (
            SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, n,
                CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
                JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ') JOIN totals t ON t.lang = c.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best QUALIFY rank <= 2000
    """,
}
