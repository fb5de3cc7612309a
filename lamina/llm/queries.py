"""Queries of this subpackage's operators over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import ann, bpe, decontaminate, hard_negatives, html, kmeans, licenses, more_sql, quality, secrets, simhash, token_files, toxicity, unigram


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file lies; the default of the operators' path parameters in these queries only."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold; a clean document has no row."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has the next label, so that some near rows have another one."""
    rows, moved = table(spark, sf_dir, "embeddings"), (F.col("label") + 1) % 10
    return hard_negatives.mine(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.cluster(table(spark, sf_dir, "embeddings"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


QUERIES = (
    op1_secret_scan, op2_bpe, op3_html_extract, op4_license_scan, op5_decontaminate, op6_toxicity, op7_simhash_dedup, op8_nearest, op9_token_counts, op10_quality, op11_hard_negatives,
    op12_centroids, op13_token_files,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def license_sql() -> str:
    """The license scan in SQL: grams as strings, each place with the grams that vote for it, in the template's order."""
    rows = ", ".join(f"({n}, '{label}', {base}, {at}, '{gram}', {votes})" for n, label, base, at, gram, votes, _ in licenses.gram_rows())
    sizes = ", ".join(f"({k})" for k in sorted({r[-1] for r in licenses.gram_rows()}))
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
        grams AS (SELECT rid, i - 1 AS pos, array_to_string(ws[i:i + k - 1], ' ') AS gram FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, (VALUES {sizes}) sizes(k))),
        known(template, label, base, place_in, gram, votes_all) AS (VALUES {rows}),
        hits AS (SELECT rid, template, label, base, votes_all, pos, place_in, pos - place_in AS diagonal FROM grams JOIN known USING (gram)),
        starts AS (SELECT DISTINCT rid, template, label, base, votes_all, diagonal FROM hits),
        firsts AS (
            SELECT s.rid, s.template, s.diagonal, h.place_in, min(h.pos) AS pos FROM starts s JOIN hits h ON s.rid = h.rid AND s.template = h.template
            AND h.diagonal BETWEEN s.diagonal AND s.diagonal + CASE WHEN s.base THEN 0 ELSE {licenses.NEIGHBOUR} END GROUP BY s.rid, s.template, s.diagonal, h.place_in),
        ordered AS (SELECT *, pos > coalesce(max(pos) OVER (PARTITION BY rid, template, diagonal ORDER BY place_in ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS counts FROM firsts),
        places AS (SELECT rid, label, base, diagonal AS start, count(*) FILTER (counts) / any_value(votes_all) AS share FROM ordered JOIN starts USING (rid, template, diagonal) GROUP BY rid, template, label, base, diagonal),
        good AS (SELECT *, CASE WHEN base THEN share >= 1 ELSE share >= {licenses.COVERAGE} END AS ok, base AND share >= 1 AS phrase FROM places)
        SELECT doc_id, len(ws) AS n_words, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word, max(start) FILTER (phrase) AS last_word,
            coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (ok), '') AS labels,
            coalesce(max(share) FILTER (ok), CAST(0 AS DOUBLE)) AS score
        FROM docs LEFT JOIN good USING (rid) GROUP BY rid, doc_id, ws
    """


def decontamination_sql() -> str:
    """Exact similarities of all windows that share a shingle with an item, in SQL."""
    return f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
        b AS (SELECT *, len(ws) AS n, least({decontaminate.WIDTH}, len(ws)) AS k FROM (SELECT row_number() OVER () AS bid, item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
        item AS (SELECT bid, k, g, count(*) AS m FROM (SELECT bid, k, array_to_string(ws[p:p + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, n - k + 2)) AS p FROM b)) GROUP BY bid, k, g),
        shingle AS (SELECT rid, k, p, array_to_string(ws[p:p + k - 1], ' ') AS g FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM b))),
        met AS (SELECT DISTINCT rid, bid, p FROM shingle JOIN item USING (k, g)),
        sized AS (SELECT rid, bid, p, k, n, least(n, len(d.ws)) AS w, len(d.ws) AS total FROM met JOIN b USING (bid) JOIN d USING (rid)),
        starts AS (SELECT DISTINCT rid, bid, k, n, w, unnest(range(greatest(1, p - (w - k)), least(p, total - w + 1) + 1)) AS s FROM sized),
        held AS (SELECT rid, bid, n, k, w, s, g, count(*) AS c FROM starts JOIN shingle USING (rid, k) WHERE p BETWEEN s AND s + w - k GROUP BY rid, bid, n, k, w, s, g),
        shared AS (SELECT rid, bid, n, k, w, s, sum(least(c, m)) AS common FROM held JOIN item USING (bid, k, g) GROUP BY rid, bid, n, k, w, s),
        scored AS (SELECT *, common / (w - k + 1 + n - k + 1 - common) AS similarity FROM shared),
        best AS (SELECT *, row_number() OVER (PARTITION BY rid, bid ORDER BY similarity DESC, s) AS place FROM scored WHERE similarity >= {decontaminate.SIMILARITY})
        SELECT doc_id, item_id, similarity, s - 1 AS first_word, w AS n_words FROM best JOIN d USING (rid) JOIN b USING (bid) WHERE place = 1
    """


def neighbours_sql() -> str:
    """All inner products, in SQL: the same as the search where one leaf holds all rows, and what its recall is measured by."""
    return f"""
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= {ann.NEIGHBOURS}
    """


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express; the others are tested against brute force, round trips or held-out rows.

    The SQL of op8_nearest is for tables of at most ann.LEAF_ROWS rows, where its search is exhaustive.
    """
    return {
        "op4_license_scan": license_sql(), "op5_decontaminate": decontamination_sql(), "op8_nearest": neighbours_sql(), "op11_hard_negatives": more_sql.negatives_sql(), "op12_centroids": more_sql.clusters_sql(),
    }
