"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import (
    ann,
    codes,
    decontamination,
    langid,
    licenses,
    manifest,
    mixing,
    ngram_join,
    quality,
    secret_scan,
    sharding,
    simhash,
    tokens,
)
from labelloom.llm.common import crc_remainder, table
from labelloom.llm.settings import N_SHARDS, OTHER_WEIGHT, SOURCE_WEIGHTS, TOKEN_LIMIT

Query = Callable[[SparkSession, str], DataFrame]


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0, k=20)


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = table(spark, sf_dir, "labels").where(crc_remainder("doc_id", 3) != 1)
    field = quality.fit_quality_model(docs, known)
    rows = docs.withColumn("held_out", crc_remainder("doc_id", 3) == 1)
    return quality.score_quality(rows, field).select("doc_id", "held_out", "score", "predicted")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.fit_markov(docs))
    spans = F.col("secrets")

    def listed(array):
        return F.array_join(
            F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = F.filter(spans, lambda s: s["kind"] != "markov")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in secret_scan.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(narrow, SOURCE_WEIGHTS, OTHER_WEIGHT)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.similar_documents(docs, ngram_join.Similarity(words=4, num=85, den=100))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.withColumn("held_out", crc_remainder("doc_id", 4) == 2)
    net = langid.fit_language_model(rows.where(~F.col("held_out")).select("text", "lang"))
    return langid.predict_language(rows.select("doc_id", "held_out", "text"), net).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = tokens.count_tokens(docs, tokens.tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    built = manifest.build_manifest(docs, manifest.without_line_feeds())
    return manifest.verify(built, docs.schema["doc_id"].dataType.simpleString())


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_neighbours": op1_neighbours,
    "op2_shards": op2_shards,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_licenses": op5_licenses,
    "op6_mix": op6_mix,
    "op7_ngram_join": op7_ngram_join,
    "op8_language": op8_language,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_manifest": op11_manifest,
    "op12_codes": op12_codes,
    "op13_simhash": op13_simhash,
}

_MANIFEST_LEAF = " || ".join(
    f"coalesce(strlen({c}) || ':' || {c}, '-')"
    for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{text}")
)
# CRC-32, bit by bit, of the digits of an id.
_ID_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
), 4294967295)"""
_MANIFEST = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, sha256({_MANIFEST_LEAF.format(text="text")}) AS leaf,
        CASE WHEN {_ID_CRC} % 2 = 0 THEN sha256({_MANIFEST_LEAF.format(text="replace(text, chr(10), '')")}) END AS other
    FROM documents
), placed AS (
    SELECT *, coalesce(other, leaf) AS changed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, i, leaf AS digest, count(*) OVER (PARTITION BY tree) AS width FROM placed
    UNION ALL
    SELECT tree, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (width + 2) // 3
    FROM nodes WHERE width > 1 GROUP BY tree, level, i // 3, width
), subroots AS (
    SELECT tree, level AS height, digest AS subroot FROM nodes WHERE width = 1
), tops AS (
    SELECT 0 AS level, tree AS i, subroot AS digest, count(*) OVER () AS width FROM subroots
    UNION ALL
    SELECT level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (width + 2) // 3
    FROM tops WHERE width > 1 GROUP BY level, i // 3, width
), root AS (
    SELECT digest AS root, level AS top_height FROM tops WHERE width = 1
), runs AS (  -- by tree, level and number of the run: its nodes
    SELECT tree, level, i // 3 AS run, list(digest ORDER BY i) AS digests FROM nodes GROUP BY ALL
), top_runs AS (
    SELECT level, i // 3 AS run, list(digest ORDER BY i) AS digests FROM tops GROUP BY ALL
), walks AS (  -- every level of a leaf's way: its run, and its place in it
    SELECT tree, i AS leaf_i, level AS step, digests, (i // CAST(pow(3, level) AS BIGINT)) % 3 AS own
    FROM placed JOIN subroots USING (tree) JOIN runs USING (tree)
    WHERE level < height AND run = i // CAST(pow(3, level + 1) AS BIGINT)
    UNION ALL
    SELECT tree, i, height + level, digests, (tree // CAST(pow(3, level) AS BIGINT)) % 3
    FROM placed JOIN subroots USING (tree) CROSS JOIN root JOIN top_runs ON level < top_height
    WHERE run = tree // CAST(pow(3, level + 1) AS BIGINT)
), sides AS (
    SELECT tree, leaf_i AS i, step, array_to_string(digests[:own], '') AS before,
        array_to_string(digests[own + 2:], '') AS behind
    FROM walks
), folds AS (
    SELECT tree, i, 0 AS step, changed AS digest FROM placed
    UNION ALL
    SELECT f.tree, f.i, f.step + 1, sha256(s.before || f.digest || s.behind)
    FROM folds f JOIN sides s ON f.tree = s.tree AND f.i = s.i AND f.step = s.step
), proofs AS (
    SELECT tree, i, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof_sha256, max(step) + 1 AS steps
    FROM sides GROUP BY tree, i
)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root,
    f.digest = root AS verified
FROM placed p JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN proofs q ON p.tree = q.tree AND p.i = q.i
JOIN folds f ON f.tree = p.tree AND f.i = p.i AND f.step = coalesce(q.steps, 0)
"""



def _codes_sql(parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS) -> str:
    """All distances of every round; whole numbers, held exactly in doubles."""
    apart = "list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c)"
    assign = f"""
    near_{{k}} AS MATERIALIZED (
        SELECT row, p, any_value(v) AS v, min({{{{'d': {apart}, 'e': e}}}}) AS best
        FROM cut JOIN book_{{k}} USING (p) GROUP BY row, p
    )"""
    refine = """
    book_{j} AS MATERIALIZED (
        SELECT p, e, coalesce(m.c, b.c) AS c FROM book_{k} b LEFT JOIN (
            SELECT p, e, list(floor(total / n) ORDER BY i) AS c FROM (
                SELECT p, best.e AS e, i, sum(v[i]) AS total, count(*) AS n
                FROM near_{k} CROSS JOIN (SELECT unnest(range(1, 1 + (SELECT max(width) FROM cut))) AS i) GROUP BY ALL
            ) GROUP BY p, e
        ) m USING (p, e)
    )"""
    steps = [assign.format(k=0)]
    for k in range(rounds):
        steps += [refine.format(j=k + 1, k=k), assign.format(k=k + 1)]
    return f"""
WITH kept AS (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS row, len(embedding) // {parts} AS width,
        list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS whole
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
    SELECT row, width, p, whole[p * width + 1 : (p + 1) * width] AS v
    FROM kept CROSS JOIN (SELECT unnest(range({parts})) AS p)
), book_0 AS (
    SELECT p, row - 1 AS e, v AS c FROM cut WHERE row <= {entries}
), {",".join(steps)}, coded AS (
    SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM near_{rounds} GROUP BY row
), digest AS (
    SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ','
        ORDER BY p, e)) AS codebooks_sha256 FROM book_{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row) CROSS JOIN digest
"""


def _mix_sql(block_rows: int = mixing.BLOCK_ROWS, seed: int = 42) -> str:
    """The cycle as a table of slots; the rest is ranks and whole divisions."""
    names, shares = [*SOURCE_WEIGHTS, None], [*SOURCE_WEIGHTS.values(), OTHER_WEIGHT]
    cycle, order = sum(shares), mixing.pfair_cycle(shares)
    turns = [0] * len(shares)
    slots = []
    for slot, s in enumerate(order):
        slots.append(f"({s}, {turns[s]}, {slot})")
        turns[s] += 1
    sources = ", ".join(f"({i}, {'NULL' if n is None else repr(n)}, {a})" for i, (n, a) in enumerate(zip(names, shares, strict=True)))
    return f"""
WITH sources(s, name, share) AS (VALUES {sources}),
turns(s, turn, cell) AS (VALUES {", ".join(slots)}),
ranked AS (
    SELECT doc_id, source, coalesce(s, {len(shares) - 1}) AS s, row_number() OVER (
        PARTITION BY coalesce(s, {len(shares) - 1})
        ORDER BY md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST) - 1 AS place
    FROM documents LEFT JOIN sources ON name = source
), placed AS (
    SELECT doc_id, source, name AS mix_source, place, share, place // {block_rows} AS block, ranked.s
    FROM ranked JOIN sources USING (s)
), timed AS (
    SELECT p.*, block // share * {cycle} + cell AS slot FROM placed p JOIN turns t ON t.s = p.s AND t.turn = block % share
), ends AS (
    SELECT min(blocks // share * {cycle} + cell) AS first_empty FROM (
        SELECT s, any_value(share) AS share, (count(place) + {block_rows - 1}) // {block_rows} AS blocks
        FROM sources LEFT JOIN ranked USING (s) GROUP BY s
    ) b JOIN turns t ON t.s = b.s AND t.turn = blocks % share
)
SELECT doc_id, source, mix_source, CAST(block AS BIGINT) AS block, CAST(block * {cycle} // share AS BIGINT) AS release,
    CAST(((block + 1) * {cycle} + share - 1) // share AS BIGINT) AS deadline, CAST(slot AS BIGINT) AS slot,
    row_number() OVER (ORDER BY slot, place) - 1 AS position, slot < first_empty AS on_target
FROM timed CROSS JOIN ends
"""


ORACLES: dict[str, str] = {"op6_mix": _mix_sql(), "op11_manifest": _MANIFEST, "op12_codes": _codes_sql()}
