"""One query opN_<name> for each corpus operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .align import align_tokens
from .bpe import tokenize
from .chat import format_turns, read_back, text_parts
from .common import stage, table
from .langid import identify_languages, train_language_model
from .media import read_media, store_media
from .mixing import add_size, mix_sizes
from .ngram_lm import score_documents
from .piece_bpe import tokenize_pieces
from .quality import COUNTS, score_quality, train_quality
from .sharding import shard_documents
from .simhash import near_duplicates
from .suffix_dedup import repeat_report
from .vector_codes import compress_vectors


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = store_media(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return read_media(stored.select("doc_id", "media"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = add_size(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    return mix_sizes(stage(sized, "mix-documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents").select("doc_id", "text"), 50)


def op5_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), 16)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return score_quality(docs, model).select("doc_id", *COUNTS, "base_failed", "kept", "quality_p")


def vocabulary_file(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenize(docs, vocabulary_file(), with_ids=False).drop("text")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    turns = given.unionByName(more).withColumn("parts", text_parts(F.col("text")))
    return read_back(format_turns(turns))


def op9_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, "crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2")
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train_language_model(docs.filter(~held_out))
    found = identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = align_tokens(docs, vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model"))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenize_pieces(docs, vocabulary_file("piece_bpe_32k.model"), with_ids=False).drop("text")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compress_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_media": op1_media,
    "op2_simhash": op2_simhash,
    "op3_pareto_mixing": op3_pareto_mixing,
    "op4_repeats": op4_repeats,
    "op5_hypergeometric_shards": op5_hypergeometric_shards,
    "op6_quality": op6_quality,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_chat": op8_chat,
    "op9_ngram_lm": op9_ngram_lm,
    "op10_language": op10_language,
    "op11_alignment": op11_alignment,
    "op12_piece_bpe": op12_piece_bpe,
    "op13_vector_codes": op13_vector_codes,
}

OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (CAST('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k, source_size * 2.0::DOUBLE AS top FROM per_source),
ranked AS (SELECT *, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM weighed),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(top) OVER (ORDER BY top / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY top / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM ranked),
level AS (SELECT arg_min(lev, top / w) AS lev FROM levels WHERE top / w >= lev),
targets AS (
  SELECT source, source_size, least(top, coalesce(level.lev * w, top)) AS target FROM ranked LEFT JOIN level ON true),
by_digits AS (
  SELECT source, length(bin(size)) AS digits, sum(size)::BIGINT AS words FROM sized WHERE size > 0 GROUP BY ALL),
candidates AS (
  SELECT b.source, digits,
         (target - 2.0::DOUBLE * coalesce(sum(words) OVER (of_source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(words * digits) OVER (of_source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM by_digits b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
  WINDOW of_source AS (PARTITION BY b.source ORDER BY digits DESC)),
levels_of AS (
  SELECT source, arg_max(level, digits) FILTER (WHERE level * digits <= 2.0::DOUBLE) AS level FROM candidates GROUP BY source),
expected AS (
  SELECT s.*, t.source_size, t.target, l.level,
         CASE WHEN size > 0 THEN least(2.0::DOUBLE, coalesce(l.level * length(bin(size)), 2.0::DOUBLE))
              ELSE floor(coalesce(t.target / nullif(t.source_size, 0), 0)) END AS copies
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  LEFT JOIN levels_of l ON s.source IS NOT DISTINCT FROM l.source),
odds AS (
  SELECT *, floor(copies) AS whole, copies - floor(copies) AS p, u / (1 - u) * ((1 - (copies - floor(copies))) / nullif(copies - floor(copies), 0)) AS rank_at,
         target - sum(size * floor(copies)::BIGINT) OVER (PARTITION BY source) AS rest
  FROM expected),
first_walk AS (
  SELECT *, p > 0 AND size > 0 AND sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank_at NULLS LAST) <= rest AS one
  FROM odds),
gaps AS (SELECT *, rest - sum(CASE WHEN one THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM first_walk),
second_walk AS (
  SELECT *, NOT one AND p > 0 AND size > 0 AND size <= gap
            AND sum(CASE WHEN NOT one AND p > 0 AND size > 0 AND size <= gap THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank_at NULLS LAST) <= gap AS two
  FROM gaps),
last_gaps AS (SELECT *, gap - sum(CASE WHEN two THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap_2 FROM second_walk),
near AS (
  SELECT source, digits, rank_at, sum(size) AS words, any_value(gap_2) AS gap
  FROM (SELECT source, length(bin(size)) AS digits, rank_at, size, gap_2, rank() OVER (PARTITION BY source, length(bin(size)) ORDER BY rank_at) AS nth
        FROM last_gaps WHERE NOT one AND NOT two AND p > 0 AND size > 0 AND size <= gap_2)
  WHERE nth <= 3 GROUP BY source, digits, rank_at),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY digits DESC, rank_at) AS i FROM near),
fills AS (
  WITH RECURSIVE walk AS (
    SELECT source, i, digits, rank_at, words <= gap AS three, CASE WHEN words <= gap THEN gap - words ELSE gap END AS gap FROM numbered WHERE i = 1
    UNION ALL
    SELECT n.source, n.i, n.digits, n.rank_at, n.words <= w.gap, CASE WHEN n.words <= w.gap THEN w.gap - n.words ELSE w.gap END
    FROM walk w JOIN numbered n ON n.source IS NOT DISTINCT FROM w.source AND n.i = w.i + 1)
  SELECT source, digits, rank_at FROM walk WHERE three)
SELECT g.doc_id, g.size, g.source_size, g.target, (g.size * (g.whole + (g.one OR g.two OR f.digits IS NOT NULL)::INT))::BIGINT AS taken, g.source
FROM last_gaps g LEFT JOIN fills f
  ON g.source IS NOT DISTINCT FROM f.source AND length(bin(g.size)) = f.digits AND g.rank_at = f.rank_at AND g.p > 0 AND NOT g.one AND NOT g.two
"""

OP8_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       sum(length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_OP13_ROUND = """,
near_{k} AS MATERIALIZED (
  SELECT s.p, s.i, any_value(s.x) AS x,
         min({{'d': list_sum(list_transform(range(1, len(s.x) + 1), lambda j: (s.x[j] - b.x[j]) * (s.x[j] - b.x[j])))::BIGINT, 'e': b.e}}) AS m
  FROM parts s JOIN books_{k} b ON s.p = b.p GROUP BY s.p, s.i)"""
_OP13_MEANS = """,
means_{k} AS (
  SELECT p, e, list((total - ((total % n) + n) % n) // n ORDER BY j)::BIGINT[] AS x
  FROM (SELECT p, m.e AS e, j, sum(x[j]) AS total, count(*)::HUGEINT AS n
        FROM near_{k}, range(1, len(x) + 1) AS t(j) GROUP BY ALL) GROUP BY p, e),
books_{next} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM books_{k} b LEFT JOIN means_{k} m ON b.p = m.p AND b.e = m.e)"""
OP13_SQL = (
    """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id) AS i
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
parts AS MATERIALIZED (
  SELECT i, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(8) AS t(p)),
books_0 AS MATERIALIZED (SELECT p, i - 1 AS e, x FROM parts WHERE i <= 16)"""
    + "".join(_OP13_ROUND.format(k=k) + _OP13_MEANS.format(k=k, next=k + 1) for k in range(6))
    + _OP13_ROUND.format(k=6)
    + """,
coded AS (
  SELECT i, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM near_6 GROUP BY i),
digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books_6)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (i), digest
"""
)

ORACLE_SQL = {"op3_pareto_mixing": OP3_SQL, "op8_chat": OP8_SQL, "op13_vector_codes": OP13_SQL}
