"""Registered queries: each operator over its whole table, beside SQL where SQL can state the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.llm.bpe import round_trip
from strataloom.llm.exact_copies import exact_copies
from strataloom.llm.fingerprints import with_next
from strataloom.llm.jaccard import jaccard_components
from strataloom.llm.langid import identify
from strataloom.llm.licences import scan
from strataloom.llm.matrices import write_matrices
from strataloom.llm.middle import fill_in_middle, restored
from strataloom.llm.neighbours import nearest
from strataloom.llm.packing import pack
from strataloom.llm.pages import extract
from strataloom.llm.registry import ORACLE, QUERIES, query
from strataloom.llm.repeats import remove_repeats
from strataloom.llm.whitening import whiten
from strataloom.session import new_dir

__all__ = ["ORACLE", "QUERIES"]


@query("op1_jaccard_join")
def op1(spark, read):
    """SQL would list all pairs; tests/llm compares with brute force."""
    return jaccard_components(read("documents"), words=3, numerator=90, denominator=100)


@query(
    "op7_exact_copies",
    """
    WITH texts AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
    ), grouped AS (
        SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM texts
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM grouped
    """,
)
def op7(spark, read):
    return exact_copies(read("documents")).drop("keep_rows")


@query("op2_token_matrices")
def op2(spark, read):
    """Every row of the matrices written, read again; tests/llm restores all documents from them."""
    written = write_matrices(read("documents"), new_dir(spark, "matrices"))
    return written.select("shard", "window", "row", "n_tokens", "cu_seqlens", "resets", "doc_ids", "starts", F.sha2("ids", 256).alias("ids_sha256"))


@query("op3_repeats")
def op3(spark, read):
    """SQL would need a row per byte; tests/llm compares with brute force."""
    left = remove_repeats(read("documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_licences")
def op4(spark, read):
    """No SQL can train the classifier; tests/llm holds planted notices against it."""
    return scan(read("documents"))


@query(
    "op5_neighbours",
    """
    WITH usable AS (
        SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
        FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
    ), ranked AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op5(spark, read):
    vectors = read("embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query("op6_bpe_round_trip")
def op6(spark, read):
    """No SQL can tokenise; tests/llm compares with the tokenizers library."""
    coded = round_trip(read("documents"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_packing")
def op8(spark, read):
    """No SQL can tokenise or evolve packings; tests/llm checks every piece and the number of sequences."""
    return pack(read("documents"))


@query("op9_language")
def op9(spark, read):
    """No SQL can train the models; tests/llm measures held-out accuracy."""
    return identify(read("documents"))


@query("op10_main_text")
def op10(spark, read):
    """No SQL reads broken markup; tests/llm holds planted articles against it."""
    return extract(read("pages"))


@query(
    "op11_fill_in_middle",
    r"""
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS digest,
            regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
        FROM documents
    ), numbers AS (
        SELECT *, len(tokens) AS n, CAST('0x' || digest[1:8] AS BIGINT) AS h1, CAST('0x' || digest[9:16] AS BIGINT) AS h2,
            CAST('0x' || digest[17:24] AS BIGINT) AS h3, CAST('0x' || digest[25:32] AS BIGINT) AS h4 FROM drawn
    ), cut AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM numbers
    ), parts AS (
        SELECT *, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m, array_to_string(tokens[b + 1:], '') AS s FROM cut
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts
    """,
)
def op11(spark, read):
    formed = fill_in_middle(read("documents"))
    rebuilt = restored(F.col("output"), F.col("form"))
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(rebuilt, 256).alias("restored_sha256"))


@query("op12_whitening")
def op12(spark, read):
    """SQL has no eigenvectors; tests/llm compares with the covariance matrix solved whole."""
    return whiten(read("embeddings"), components=8)


@query("op13_fingerprints")
def op13(spark, read):
    """SQL cannot parse by coin tossing; tests/llm compares with a parse of one symbol at a time."""
    found = with_next(read("documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
