"""The registered queries of the operators, one per operator, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.alignment import align
from headway.llm.exact_dedup import exact_dedup
from headway.llm.hyperminhash import near_dedup
from headway.llm.jaccard_join import jaccard_join
from headway.llm.language_id import language_id
from headway.llm.line_dedup import line_dedup
from headway.llm.neighbours import nearest
from headway.llm.packing import best_fit_packing
from headway.llm.pieces import piece_counts
from headway.llm.shared import table
from headway.llm.substring_dedup import substring_dedup
from headway.llm.token_counts import token_counts
from headway.llm.toxicity import toxicity
from headway.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


@registered("op6_exact_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@registered("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), r AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score,
         CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, c.e), c.vec_id) AS INTEGER) AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@registered("op8_neighbours", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)
), f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first_id FROM s),
r AS (SELECT DISTINCT doc_id, i + o AS p FROM f, (SELECT unnest(range(13)) AS o) WHERE first_id < doc_id),
n AS (SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(words, lambda x, j: NOT list_contains(coalesce(gone, []), j)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id)
"""


@registered("op4_substring_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS i FROM d)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other
), c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
"""


@registered("op10_jaccard_join", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


@registered("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


@registered("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered("op3_line_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_lines", "n_removed", "kept_sha256")


@registered("op5_pieces")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@registered("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


@registered("op11_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


OP12_SQL = OP10_SQL.replace("words[i : i + 4]", "words[i : i + 3]").replace("len(words) - 4,", "len(words) - 3,")
OP12_SQL = OP12_SQL.replace("100 * shared >= 75 *", "100 * shared >= 80 *")
OP12_SQL = OP12_SQL.replace("AS n_shingles, component_id FROM c", "AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c")


@registered("op12_hyperminhash", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


@registered("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's deviation is a long: null where the exact number does not fit into one."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
