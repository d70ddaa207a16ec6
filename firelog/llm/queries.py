"""Registered queries of the operators: each over its whole table with production parameters."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from firelog.llm import extract_html, fingerprint, jaccard, langid, merkle, mixing, periodic, pii, sentencepiece, tokens, topk, toxicity, warc
from firelog.llm.common import read_table


def _part(id_col: str, n: int):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def op1_sentencepiece(spark, sf_dir):
    """Ids of every whole text and whether they decode to it."""
    return sentencepiece.encode(read_table(spark, sf_dir, "documents"))


def op2_language(spark, sf_dir):
    """Language of every whole text; prototypes from four fifths of the rows."""
    docs = read_table(spark, sf_dir, "documents")
    prototypes = langid.train(docs.where(_part("doc_id", 5) != 0))
    return langid.identify(docs, prototypes).select(
        "doc_id", (F.coalesce(_part("doc_id", 5), F.lit(-1)) == 0).alias("held_out"), "lang_pred", "score")


def op3_toxicity(spark, sf_dir):
    """Toxicity of every whole text; trained on labelled rows of two thirds of the ids."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    texts, y = toxicity.labelled_sample(docs, labels, _part("doc_id", 3) != 1)
    return toxicity.score(docs, toxicity.train_model(texts, y)).select(
        "doc_id", (F.coalesce(_part("doc_id", 3), F.lit(-1)) == 1).alias("held_out"), "score", "predicted")


def op4_pii(spark, sf_dir):
    """Personal data of every whole text."""
    docs = read_table(spark, sf_dir, "documents")
    return pii.detect(docs, pii.train(docs))


def op5_mixing(spark, sf_dir):
    """How many words of every document the mix takes."""
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_main_text(spark, sf_dir):
    """Main text of every page."""
    return extract_html.extract(read_table(spark, sf_dir, "pages"))


def op7_top_k(spark, sf_dir):
    """The five best vectors of every fiftieth one."""
    table = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(table, F.col("vec_id") % 50 == 0)


def op8_fingerprints(spark, sf_dir):
    """Fingerprints of every whole text and of its edited text."""
    return fingerprint.fingerprints(read_table(spark, sf_dir, "documents"))


def op9_jaccard(spark, sf_dir):
    """Near-duplicate components of every whole text."""
    return jaccard.join(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_token_counts(spark, sf_dir):
    """Token counts of every whole text."""
    return tokens.token_counts(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark, sf_dir):
    """Periodic runs of every whole text; every tenth id's text ends in repeated words."""
    docs = read_table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", periodic.repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic.digests(periodic.periodic_runs(texts))


def op12_merkle_manifest(spark, sf_dir):
    """Manifest of all documents and the audit of every leaf; where 5 divides the id's crc32 the text was lower-cased."""
    docs = read_table(spark, sf_dir, "documents")
    lowered = F.translate(F.col("text"), ascii_uppercase, ascii_lowercase)
    leaves = merkle.leaves(docs, ["doc_id", "source", "lang", "n_chars", "text"], altered={"text": lowered}, where=_part("doc_id", 5) == 0)
    audited = merkle.audit(merkle.build(leaves))
    return audited.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_warc(spark, sf_dir):
    """All pages written as WARC archives and read back."""
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_language": op2_language,
    "op3_toxicity": op3_toxicity,
    "op4_pii": op4_pii,
    "op5_mixing": op5_mixing,
    "op6_main_text": op6_main_text,
    "op7_top_k": op7_top_k,
    "op8_fingerprints": op8_fingerprints,
    "op9_jaccard": op9_jaccard,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_warc": op13_warc,
}
ORACLE_SQL: dict[str, str] = {
    "op7_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5""",
    "op12_merkle_manifest": """
        WITH RECURSIVE d AS (
            SELECT doc_id, source, text, lang, n_chars, 4294967295::BIGINT::UBIGINT AS ones, CAST(doc_id AS VARCHAR) AS id FROM documents),
        c AS (
            -- crc32 of the id's decimal digits, bit by bit
            SELECT *, xor(list_reduce(list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(substr(id, CAST(i AS INTEGER), 1)) AS UBIGINT)),
                lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)),
                ones), ones) AS h FROM d),
        t AS (SELECT *, h % 5 = 0 AS tampered, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM c),
        f AS (
            SELECT doc_id, source, tampered, text, lowered,
                concat(coalesce(strlen(id) || ':' || id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                       coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head
            FROM t),
        leaves AS (
            SELECT row_number() OVER () AS leaf_no, doc_id, source, coalesce(tampered, false) AS tampered,
                sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
                sha256(concat(head, coalesce(strlen(lowered) || ':' || lowered, '-'))) AS altered,
                dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM f),
        low AS (
            SELECT tree, 0 AS level, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                count(*) OVER (PARTITION BY tree) AS n, leaf AS hash, leaf_no FROM leaves),
        up AS (
            SELECT tree, level, pos, n, hash FROM low
            UNION ALL
            SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM up WHERE n > 1
            GROUP BY tree, level, pos // 16, (n + 15) // 16),
        top AS (
            SELECT -1 AS tree, 0 AS level, tree AS pos, count(*) OVER () AS n, hash FROM up WHERE n = 1
            UNION ALL
            SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM top WHERE n > 1
            GROUP BY tree, level, pos // 16, (n + 15) // 16),
        runs AS (
            SELECT tree, level, pos // 16 AS run, n, list(hash ORDER BY pos) AS kids
            FROM (SELECT * FROM up UNION ALL SELECT * FROM top) GROUP BY tree, level, pos // 16, n),
        climb AS (
            SELECT l.leaf_no, l.tree AS own, l.tree, 0 AS level, l.pos, l.n, if(v.tampered, v.altered, v.leaf) AS folded, '' AS proof
            FROM low l JOIN leaves v USING (leaf_no)
            UNION ALL
            SELECT c.leaf_no, c.own, if(c.n = 1, -1, c.tree), if(c.n = 1, 0, c.level + 1), if(c.n = 1, c.own, c.pos // 16),
                if(c.n = 1, (SELECT count(*) FROM top WHERE level = 0), (c.n + 15) // 16),
                if(c.n = 1, c.folded, sha256(concat(array_to_string(r.kids[1:c.pos % 16], ''), c.folded, array_to_string(r.kids[c.pos % 16 + 2:], '')))),
                if(c.n = 1, c.proof, concat(c.proof, array_to_string(r.kids[1:c.pos % 16], ''), array_to_string(r.kids[c.pos % 16 + 2:], '')))
            FROM climb c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.pos // 16
            WHERE c.n > 1 OR c.tree <> -1)
        SELECT v.doc_id, v.leaf, s.hash AS subroot, r.hash AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.hash AS verified
        FROM climb c JOIN leaves v USING (leaf_no) JOIN up s ON s.tree = v.tree AND s.n = 1 JOIN top r ON r.n = 1
        WHERE c.tree = -1 AND c.n = 1""",
    "op13_warc": """
        WITH p AS (
            SELECT row_number() OVER () AS row_no, page_id, coalesce(html, '') AS payload FROM pages),
        d AS (
            SELECT *, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
        r AS (
            SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS holder
            FROM d WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, row_no))
        SELECT page_id, payload_bytes, payload_digest,
            if(place = 1 OR payload_bytes < 1000, 'response', 'revisit') AS record_type,
            if(place = 1 OR payload_bytes < 1000, NULL, holder) AS refers_to FROM r""",
}
