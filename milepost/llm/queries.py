"""The operators' queries over the supplied tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm import bitsliced, bpe, collocations, fingerprints, language, lexical, mixing, ngram_join, repeats, suffixes, surrogates, toxicity, vptree
from milepost.llm.tables import small_batches, table


def _remainder(modulus: int) -> Column:
    """Fold of a document: crc32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    model = language.learn_languages(docs.where(~held_out))
    found = language.identify_languages(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "mixture")


def op2_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_bit_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_classes(table(spark, sf_dir, "documents"))


SURROGATE_KEY = b"a key for tests; production passes its own"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def op6_trie_bpe(spark: SparkSession, sf_dir: str, path: str = VOCABULARY) -> DataFrame:
    small_batches(spark)
    done = bpe.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), bpe.Vocabulary(path))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = repeats.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("size").alias("n_words"), F.col("removed").alias("n_removed"), "kept_sha256")


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    model = toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_private(docs, SURROGATE_KEY)


def op10_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = suffixes.repeated_bytes(table(spark, sf_dir, "documents"))
    spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", F.col("size").alias("n_bytes"), F.col("removed").alias("n_removed"), spans, "kept_sha256")


def op11_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_phrase_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def op13_presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


OP12_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(part, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS part FROM texts)
), words AS (
  SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS place FROM pieces
), rows AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3
  FROM words WINDOW p AS (PARTITION BY piece ORDER BY place)
), f1 AS (
  SELECT lang, w1, CAST(count(*) AS HUGEINT) AS a FROM rows GROUP BY ALL
), f2 AS (
  SELECT lang, w1, w2, CAST(count(*) AS HUGEINT) AS a FROM rows WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (
  SELECT lang, w1, w2, w3, CAST(count(*) AS HUGEINT) AS a FROM rows WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), total AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f1 GROUP BY lang
), longer AS (
  SELECT lang, x, y, max(a) AS most
  FROM (SELECT lang, w1 AS x, w2 AS y, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY lang, x, y
), scored AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.a, 1 AS cut, x.a AS l, y.a AS r
  FROM f2
  JOIN f1 AS x ON x.lang = f2.lang AND x.w1 = f2.w1
  JOIN f1 AS y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN longer ON longer.lang = f2.lang AND longer.x = f2.w1 AND longer.y = f2.w2
  WHERE f2.a >= 10 AND (most IS NULL OR 100 * most < 50 * f2.a)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, 1, x.a, y.a
  FROM f3
  JOIN f1 AS x ON x.lang = f3.lang AND x.w1 = f3.w1
  JOIN f2 AS y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, 2, x.a, y.a
  FROM f3
  JOIN f2 AS x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2
  JOIN f1 AS y ON y.lang = f3.lang AND y.w1 = f3.w3
), worst AS (
  SELECT *, 1000000 * a * a // (l * r) AS score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

OP13_SQL = r"""
WITH occurrences AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), lengths AS (
  SELECT doc_id, count(*) AS n FROM occurrences GROUP BY doc_id
), stats AS (
  SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS length FROM lengths
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM occurrences GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * total + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, stats GROUP BY term, total
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), shortened AS (
  SELECT doc_id, 75 + (25 * n * total) // length AS m FROM lengths, stats
), scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN shortened USING (doc_id) GROUP BY ALL
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_mixture": op1_language_mixture,
        "op2_fair_mix": op2_fair_mix,
        "op3_vantage_points": op3_vantage_points,
        "op4_bit_slices": op4_bit_slices,
        "op5_ngram_join": op5_ngram_join,
        "op6_trie_bpe": op6_trie_bpe,
        "op7_repeated_passages": op7_repeated_passages,
        "op8_kneser_ney": op8_kneser_ney,
        "op9_surrogates": op9_surrogates,
        "op10_suffix_arrays": op10_suffix_arrays,
        "op11_phrase_fingerprints": op11_phrase_fingerprints,
        "op12_phrase_growth": op12_phrase_growth,
        "op13_presence_masks": op13_presence_masks,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_bit_slices": OP4_SQL, "op12_phrase_growth": OP12_SQL, "op13_presence_masks": OP13_SQL}
