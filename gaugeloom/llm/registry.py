"""The registered queries of the operators, with their production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.llm import hosts, language, latent, licenses, lines, neighbours, packing, personal, phrases, ranking, records, simhash, substring
from gaugeloom.llm.common import table
from gaugeloom.session import shared_dir

#: A public vocabulary file, installed on every machine.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).select("doc_id", "license", "shared", "of", "first_word")


def held_out() -> Column:
    """Documents that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out()))
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, VOCABULARY)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "records")
    folder = folder if ":/" in folder else f"file://{folder}"
    manifest = records.write_records(table(spark, sf_dir, "documents"), VOCABULARY, folder)
    back = records.read_records(spark, manifest, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is that of the labelled document with its number: bad if toxic or of low quality.

    ``mean`` and ``bound`` are the posterior share of bad pages of the host and its lower bound, to twelve digits.
    """
    labels = table(spark, sf_dir, "labels")
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    judged = hosts.filter_pages(table(spark, sf_dir, "pages"), outcomes)
    return judged.withColumns({c: F.round(c, 12) for c in ("mean", "bound")})


def op7_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = latent.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "share", "answered")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedupe_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest are of the base spans; ``spans`` also holds what the model adds, ``n_added`` counts it."""
    docs = table(spark, sf_dir, "documents")
    found = personal.find(docs, personal.train(docs))
    kinds = F.array(*map(F.lit, personal.KINDS))
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)))
    placed = F.transform(F.concat("base", "added"), lambda s: F.struct(F.array_position(kinds, s.kind).alias("n"), s.start.alias("start"), s.stop.alias("stop"), s.kind.alias("kind")))
    names = F.transform("base", lambda s: s.kind)
    counts = [(F.size("base") - F.size(F.array_remove(names, k))).cast("long").alias(f"n_{k}") for k in personal.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.array_sort(placed)).alias("spans"), F.size("added").cast("long").alias("n_added")
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_language": op2_language,
    "op3_simhash": op3_simhash,
    "op4_packing": op4_packing,
    "op5_records": op5_records,
    "op6_hosts": op6_hosts,
    "op7_latent": op7_latent,
    "op8_lines": op8_lines,
    "op9_neighbours": op9_neighbours,
    "op10_substring": op10_substring,
    "op11_personal": op11_personal,
    "op12_phrases": op12_phrases,
    "op13_ranking": op13_ranking,
}

#: A text with A to Z in lower case, and its terms as a list: runs of letters, digits and everything beyond ASCII.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')"

ORACLE: dict[str, str] = {
    "op12_phrases": rf"""
        WITH pieces AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\n\x0B\x0C\r]')) AS piece
                  FROM documents WHERE text IS NOT NULL)
        ), grams AS (
            SELECT lang, size, phrase, count(*) AS f
            FROM (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
                  FROM pieces, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)
            GROUP BY lang, size, phrase
        ), total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang),
        known AS (SELECT * FROM grams WHERE f >= 10),
        cuts AS (
            SELECT lang, size, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS x,
                   array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS y
            FROM known, (SELECT unnest([1, 2]) AS k) WHERE size > k
        ), scored AS (
            SELECT c.lang, c.size, c.phrase, a, k, x.f AS l, y.f AS r,
                   CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = c.x JOIN known y ON y.lang = c.lang AND y.phrase = c.y
        ), least AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inside AS (
            SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, f
            FROM known WHERE size = 3
        ), longer AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY lang, phrase),
        ranked AS (
            SELECT s.lang, s.phrase, a, l, r, score, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
            FROM least s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase WHERE o.f IS NULL OR 100 * o.f < 50 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
    "op13_ranking": f"""
        WITH docs AS (
            SELECT doc_id, terms, CAST(len(terms) AS HUGEINT) AS n
            FROM (SELECT doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL)
            WHERE len(terms) > 0
        ), total AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM docs),
        tf AS (
            SELECT doc_id, n, term, CAST(count(*) AS HUGEINT) AS tf
            FROM (SELECT doc_id, n, unnest(terms) AS term FROM docs) GROUP BY doc_id, n, term
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS HUGEINT) AS w
            FROM tf, total GROUP BY term
        ), asked AS (
            SELECT DISTINCT item_id, term
            FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL)
        ), scores AS (
            SELECT item_id, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * big_n) // CAST(big_l AS HUGEINT)))))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN tf USING (term), total
            GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
}
