"""The numbered queries, and the pipeline, as the driver's contract wants them: thin layers over the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import line_rules, merkle, mixing, pii, quality_gam, sentencepiece_fst, simhash, substring_dedup, token_counts, token_files, topk, toxicity, whitening
from roadlens.llm.common import model_bytes, shared_folder, ship, table

TOKENIZER = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"


def tokenizer(path: str | None = None, name: str = TOKENIZER) -> bytes:
    """The vocabulary file at ``path``, or the public one that the contract names."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    return model_bytes(path)


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, weight): labelled good 2, labelled poor 1/2; the others weigh 1."""
    return table(spark, sf_dir, "labels").where("quality is not null").select("doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer(), limit=4096)


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=20).drop("kept_text")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return sentencepiece_fst.encode(table(spark, sf_dir, "documents"), tokenizer(), check=True)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find_spans(table(spark, sf_dir, "documents")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir)).drop("text_hash")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.apply_rules(table(spark, sf_dir, "documents")).drop("cleaned")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    # this vocabulary drops white space
    manifest = token_files.write(table(spark, sf_dir, "documents"), tokenizer(name=WORD_TOKENIZER), folder, end_id=1, by_words=True)
    return token_files.read_documents(spark, manifest, folder).drop("part")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.manifest(table(spark, sf_dir, "documents"), tampered=tampered)
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_topk_search, op3_toxicity, op4_substring_dedup, op5_sentencepiece, op6_quality_classifier, op7_pii, op8_mixing, op9_simhash, op10_quality_rules, op11_token_files, op12_merkle_manifest, op13_whitening, pipeline)
}


def _merkle_sql(levels: int = 8, group_levels: int = 4) -> str:
    """The tree and the proofs, level by level: 8 ** ``levels`` documents a language and 8 ** ``group_levels`` languages at most."""

    def told(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    other = [told(c) for c in ("doc_id", "source", "lang", "n_chars")]
    crc = """xor(list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
                lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), 4294967295::BIGINT), 4294967295::BIGINT)"""
    ctes = [f"""d AS (
            SELECT doc_id, lang, sha256({" || ".join([*other, told("text")])}) AS leaf,
                   CASE WHEN {crc} % 3 = 0 THEN sha256({" || ".join([*other, told(lower)])}) END AS given
            FROM documents
        ), f0 AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS i, coalesce(given, leaf) AS folded, '' AS proof FROM d
        ), a0 AS (SELECT lang, i, leaf AS h FROM f0)"""]

    def level(k: int, a: str, f: str, group: str) -> None:
        ctes.append(f"""{a}{k + 1} AS (
            SELECT {group}, i // 8 AS i, m > 1 AS hashed, list(h ORDER BY i) AS run, CASE WHEN m > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h
            FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS m FROM {a}{k}) GROUP BY {group}, i // 8, m
        ), {f}{k + 1} AS (
            SELECT f.* EXCLUDE (i, folded, proof), f.i // 8 AS i,
                   CASE WHEN hashed THEN sha256(array_to_string(run[1:f.i % 8], '') || folded || array_to_string(run[f.i % 8 + 2:], '')) ELSE folded END AS folded,
                   CASE WHEN hashed THEN proof || array_to_string(run[1:f.i % 8], '') || array_to_string(run[f.i % 8 + 2:], '') ELSE proof END AS proof
            FROM {f}{k} f JOIN {a}{k + 1} a ON f.{group} IS NOT DISTINCT FROM a.{group} AND f.i // 8 = a.i
        )""")

    for k in range(levels):
        level(k, "a", "f", "lang")
    ctes.append(f"""s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, 0 AS one FROM a{levels}
        ), t0 AS (SELECT one, i, h FROM s
        ), g0 AS (SELECT f.* EXCLUDE (i), s.i, s.h AS subroot, 0 AS one FROM f{levels} f JOIN s ON f.lang IS NOT DISTINCT FROM s.lang)""")
    for k in range(group_levels):
        level(k, "t", "g", "one")
    # doc_id, source, lang and n_chars by value, text by its bytes; strlen counts bytes
    return "WITH " + ", ".join(ctes) + f"""
        SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.h AS verified
        FROM g{group_levels} JOIN t{group_levels} t USING (one)"""


_WORDS = r"[^\x20\x09-\x0D]+"

#: Only what SQL can state for whole tables; tests hold the others against brute force.
ORACLES: dict[str, str] = {
    "op2_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op4_substring_dedup": rf"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents
        ), words AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs
        ), windows AS (
            SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM docs WHERE len(w) >= 20
        ), keyed AS (
            SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM windows
        ), repeats AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM keyed) WHERE n > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM repeats
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
        FROM docs d LEFT JOIN kept k USING (doc_id)""",
    "op8_mixing": rf"""
        WITH w AS (
            SELECT doc_id, avg(CASE WHEN quality = 1 THEN 2.0 ELSE 0.5 END)::DOUBLE AS weight FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
        ), d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size,
                   -ln((('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / coalesce(weight, 1.0) AS key
            FROM documents LEFT JOIN w USING (doc_id)
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
            FROM d GROUP BY source
        ), o AS (
            SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST) AS o FROM s
        ), l AS (
            SELECT a.*, 1.5 * (SELECT sum(source_size) FROM o)::DOUBLE - coalesce((SELECT sum(2.0 * source_size) FROM o b WHERE b.o < a.o), 0)::DOUBLE AS budget,
                   (SELECT sum(w) FROM o b WHERE b.o >= a.o) AS ws
            FROM o a
        ), f AS (
            SELECT budget, ws FROM l WHERE 2.0 * source_size * ws > w * budget ORDER BY o LIMIT 1
        ), t AS (
            SELECT l.source, source_size, coalesce(least(2.0 * source_size, w * f.budget / f.ws), 2.0 * source_size)::DOUBLE AS target FROM l LEFT JOIN f ON true
        ), e AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t
        ), p AS (
            SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, round(e.target - e.epochs * e.source_size)::BIGINT AS rest,
                   coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
        )
        SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM p""",
    "op12_merkle_manifest": _merkle_sql(),
}
