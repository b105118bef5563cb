"""The named queries over the training-data operators, each on its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ringspan.llm import (
    decontaminate,
    embedding_dedup,
    html_main,
    jaccard,
    line_dedup,
    merkle,
    packing,
    pieces,
    pii,
    quality,
    token_counts,
    token_files,
    whitening,
)
from ringspan.session import work_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, folder, "embeddings"))


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "tokens")
    token_files.write_token_files(_table(spark, folder, "documents"), path, BYTE_BPE)
    return token_files.token_report(token_files.read_token_files(spark, path))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_report(pii.find_pii(_table(spark, folder, "documents")))


def op4_html_main(spark: SparkSession, folder: str) -> DataFrame:
    return html_main.extraction_report(html_main.extract_main_text(_table(spark, folder, "pages")))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(line_dedup.dedupe_lines(_table(spark, folder, "documents"), min_words=1))


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.pieces_report(pieces.encode_pieces(_table(spark, folder, "documents"), PIECE_BPE))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.line_token_counts(_table(spark, folder, "documents"), BYTE_BPE)


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )
    return decontaminate.contamination_report(found)


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest_report(_table(spark, folder, "documents"), work_folder(spark, "manifest"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "pieces")
    cut = packing.write_pieces(_table(spark, folder, "documents"), path, BYTE_BPE)
    return packing.packing_report(cut, packing.place_pieces(cut))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitening_report(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_token_files": op2_token_files,
    "op3_pii": op3_pii,
    "op4_html_main": op4_html_main,
    "op5_line_dedup": op5_line_dedup,
    "op6_pieces": op6_pieces,
    "op7_token_counts": op7_token_counts,
    "op8_decontaminate": op8_decontaminate,
    "op9_jaccard": op9_jaccard,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_packing": op12_packing,
    "op13_whitening": op13_whitening,
}

# Words: runs of characters that are not ASCII marks, white space or controls, A-Z in lower case. Documents and
# items become lists of words; windows are joined by their text and marked on the words they cover.
_OP8 = r"""
WITH doc_words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
),
item_words AS (
    SELECT item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM benchmark
),
sizes AS (SELECT DISTINCT least(len(words), 10) AS size FROM item_words WHERE len(words) > 0),
item_windows AS (
    SELECT item_id, size, array_to_string(words[pos : pos + size - 1], ' ') AS win
    FROM (
        SELECT item_id, words, least(len(words), 10) AS size,
               unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos
        FROM item_words WHERE len(words) > 0
    )
),
doc_windows AS (
    SELECT doc_id, pos, size, array_to_string(words[pos : pos + size - 1], ' ') AS win
    FROM (
        SELECT doc_id, words, size, unnest(range(1, greatest(1, len(words) - size + 2))) AS pos
        FROM doc_words CROSS JOIN sizes
    )
),
found AS (SELECT DISTINCT doc_id, pos, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# Shingle sets as lists, pairs by shared shingles, sizes by inclusion and exclusion, components by walking links.
_OP9 = r"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
),
members AS (
    SELECT DISTINCT doc_id, array_to_string(words[pos : pos + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS pos FROM doc_words WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM members GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM members x JOIN members y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * shared >= 80 * (s.n + t.n - shared)
),
walk AS (
    SELECT doc_id, doc_id AS reached FROM documents
    UNION
    SELECT walk.doc_id, links.b FROM walk JOIN links ON links.a = walk.reached
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(reached) AS component_id
FROM walk LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

# All pairs of vectors by double-precision cosines, components by walking links.
_OP1 = """
WITH RECURSIVE units AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b
    FROM units x JOIN units y ON x.vec_id <> y.vec_id
    WHERE list_cosine_similarity(x.v, y.v) >= 0.95
),
walk AS (
    SELECT vec_id, vec_id AS reached FROM embeddings
    UNION
    SELECT walk.vec_id, links.b FROM walk JOIN links ON links.a = walk.reached
),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(reached) AS component_id, vec_id = min(reached) AS kept
FROM walk LEFT JOIN degrees USING (vec_id) GROUP BY vec_id
"""

# Every node of every tree by level, its siblings as texts to its left and right, and a row's path as a list of these.
_OP11 = """
WITH RECURSIVE checked AS (
    SELECT *, list_reduce([4294967295::BIGINT] || list_transform(
        regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda c: ascii(c)::BIGINT),
        lambda sum, byte: list_reduce([xor(sum, byte), 1, 2, 3, 4, 5, 6, 7, 8],
            lambda rest, bit: xor(rest >> 1, (rest & 1) * 3988292384))) AS inverted
    FROM documents
),
fields AS (
    SELECT doc_id, lang,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS own,
           CASE WHEN xor(inverted, 4294967295) % 3 = 0 THEN coalesce(strlen(text) || ':' || translate(text,
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')
           ELSE coalesce(strlen(text) || ':' || text, '-') END AS shown
    FROM checked
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS n
    FROM (SELECT doc_id, lang, sha256(head || own) AS leaf, sha256(head || shown) AS presented FROM fields)
),
nodes AS (
    SELECT lang, 0 AS level, place, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT lang, level + 1, place >> 3, (n + 7) >> 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY lang, level, place >> 3, n
),
subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
tops AS (
    SELECT 0 AS level, place, n, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, place >> 3, (n + 7) >> 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM tops WHERE n > 1 GROUP BY level, place >> 3, n
),
steps AS (
    SELECT lang, level, place, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')
           || '|' || coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS step
    FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY lang, level, place >> 3 ORDER BY place)
),
top_steps AS (
    SELECT level, place, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')
           || '|' || coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS step
    FROM tops WHERE n > 1 WINDOW run AS (PARTITION BY level, place >> 3 ORDER BY place)
),
lower_paths AS (
    SELECT l.lang, l.place, list(step ORDER BY level) FILTER (step IS NOT NULL) AS path
    FROM leaves l LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM l.lang AND s.place = l.place >> (3 * level) GROUP BY ALL
),
upper_paths AS (
    SELECT r.lang, subroot, list(step ORDER BY level) FILTER (step IS NOT NULL) AS path
    FROM subroots r LEFT JOIN top_steps s ON s.place = r.place >> (3 * level) GROUP BY ALL
),
proofs AS (
    SELECT doc_id, leaf, subroot, (SELECT digest FROM tops WHERE n = 1) AS root, presented,
           coalesce(p.path, []) || coalesce(u.path, []) AS path
    FROM leaves l
    JOIN lower_paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.place = l.place
    JOIN upper_paths u ON u.lang IS NOT DISTINCT FROM l.lang
)
SELECT *, folded_root = root AS verified
FROM (
    SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
           list_reduce([presented] || path, lambda digest, step:
               sha256(split_part(step, '|', 1) || digest || split_part(step, '|', 2))) AS folded_root
    FROM proofs
)
"""

ORACLE: dict[str, str] = {
    "op1_embedding_dedup": _OP1,
    "op8_decontaminate": _OP8,
    "op9_jaccard": _OP9,
    "op11_merkle": _OP11,
}
