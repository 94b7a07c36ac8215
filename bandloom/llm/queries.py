"""One query per operator, each over its whole table, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from bandloom.sources.files import join_path, scratch_folder

from . import (
    best_fit, collocations, hard_negatives, html_tree, language, line_dedup, packing, perplexity, secrets, simhash,
    spotsigs, token_files, word_bpe,
)

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def simhash_query(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, folder))


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is; every machine has the package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the text that is left, and how many of its lines with content are gone."""
    n_lines = F.expr("size(filter(split(__doc.text, '\\n', -1), x -> length(trim(x)) > 0))").cast("long")
    n_dropped = F.coalesce(F.expr("size(dropped)"), F.lit(0)).cast("long")
    docs = documents(spark, folder).select("doc_id", "text")
    return line_dedup.dedup_lines(docs, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def token_files_query(spark: SparkSession, folder: str) -> DataFrame:
    shards = join_path(scratch_folder(spark), "tokens")
    token_files.write_tokens(documents(spark, folder), shards, vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_files.read_tokens(spark, shards, with_ids=False)


def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.quality(documents(spark, folder)).drop("key")


def language_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = F.expr("coalesce(crc32(encode(cast(doc_id as string), 'UTF-8')) % 4 = 2, false)")
    model = language.learned(docs.where(~held_out))
    found = language.identify(docs, model, with_spans=False)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    return packing.pack(documents(spark, folder), path, end_id=1, with_ids=False)


def word_bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    return word_bpe.encode_documents(documents(spark, folder), path, public_tokenizers.PATTERN)


def secrets_query(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, folder))


def spotsigs_query(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.fingerprints(documents(spark, folder))


def html_query(spark: SparkSession, folder: str) -> DataFrame:
    return html_tree.main_texts(spark.read.parquet(f"{folder}/pages.parquet"))


def best_fit_query(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    return best_fit.pack_best_fit(documents(spark, folder), path, end_id=0, with_ids=False)


def collocations_query(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine_phrases(documents(spark, folder))


def hard_negatives_query(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    relabelled = vectors.select("vec_id", label.cast("long").alias("label"), "embedding")
    return hard_negatives.mine_hard_negatives(relabelled, F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": line_dedup_query,
        "op2_token_files": token_files_query,
        "op3_simhash": simhash_query,
        "op4_perplexity": quality_query,
        "op5_language": language_query,
        "op6_packing": packing_query,
        "op7_secrets": secrets_query,
        "op8_spotsigs": spotsigs_query,
        "op9_word_bpe": word_bpe_query,
        "op10_html_tree": html_query,
        "op11_bin_completion": best_fit_query,
        "op12_setm_phrases": collocations_query,
        "op13_lemp_negatives": hard_negatives_query,
    }


#: Phrases of k words and their counts, for all languages; candidates are those that occur 100 times or more.
PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, [w for w in string_split_regex(piece, '[\x20\x09]+') if w <> ''] AS words FROM pieces
), spans AS (
    SELECT lang, words, unnest(generate_series(1, len(words))) AS i FROM split
), phrases AS (
    SELECT lang, k, words[i : i + k - 1] AS phrase, count(*) AS f
    FROM spans CROSS JOIN generate_series(1, 5) AS sizes(k)
    WHERE i + k - 1 <= len(words)
    GROUP BY lang, k, words[i : i + k - 1]
    HAVING count(*) >= 100
), totals AS (
    SELECT lang, sum(len(words))::BIGINT AS n FROM split GROUP BY lang
), candidates AS (
    SELECT * FROM phrases c WHERE k > 1 AND NOT EXISTS (
        SELECT 1 FROM phrases o
        WHERE o.lang = c.lang AND o.k = c.k + 1 AND 100 * o.f >= 100 * c.f
            AND (o.phrase[1 : c.k] = c.phrase OR o.phrase[2 : c.k + 1] = c.phrase))
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, j, l.f AS l, r.f AS r, n,
        ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM candidates c
    JOIN generate_series(1, 4) AS places(j) ON j < c.k
    JOIN phrases l ON l.lang = c.lang AND l.k = j AND l.phrase = c.phrase[1 : j]
    JOIN phrases r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = c.phrase[j + 1 : c.k]
    JOIN totals t ON t.lang = c.lang
), best AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM cuts
), ranked AS (
    SELECT lang, row_number() OVER (
            PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(phrase, ' '))) AS rank,
        array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
    FROM best WHERE nth = 1
)
SELECT * FROM ranked WHERE rank <= 2000
"""

#: The definition word for word: scores of all anchors with all rows, in whole numbers.
NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) for x in embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, o.vec_id, o.label = a.label AS same,
        list_sum([p[1] * p[2] for p in list_zip(a.v, o.v)])::BIGINT AS score
    FROM vectors a JOIN vectors o ON a.vec_id % 50 = 0
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
    FROM scored WHERE same AND vec_id <> anchor_id
), pairs AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
        n.score AS negative_score, row_number() OVER (
            PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    WHERE p.nth <= 5 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT * FROM pairs WHERE rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_setm_phrases": PHRASES, "op13_lemp_negatives": NEGATIVES}
