"""Registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.llm import alignment, merkle, packing, pieces, sharding, warc
from docstrata.llm.classlm import score_corpus
from docstrata.llm.fingerprints import fingerprints
from docstrata.llm.licenses import license_matches
from docstrata.llm.mixing import mix
from docstrata.llm.neardup import near_duplicates
from docstrata.llm.quality import judge
from docstrata.llm.storage import workspace
from docstrata.llm.vectors import near_vectors

SHARDS = 16


def _vocabulary(name: str) -> str:
    """The place of a public tokenizer's file; only the queries that encode need the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op2_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _vocabulary("piece_bpe_32k.model")
    return pieces.encode(_table(spark, sf_dir, "documents"), model, keep=["doc_id", "n_chars"])


def op3_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(_table(spark, sf_dir, "documents"))


def op4_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op5_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def _held_out(doc_id: str) -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def op7_class_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(_table(spark, sf_dir, "documents"), _held_out)


def op8_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "ids")
    packing.write_ids(_table(spark, sf_dir, "documents"), folder, _vocabulary("word_bpe_49k.json"))
    return packing.read_ids(spark, folder)


def op9_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(_table(spark, sf_dir, "documents"), [F.col("doc_id")])
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"]
    return judged.select(*first, *[c for c in judged.columns if c not in first])


def op10_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "archives")
    warc.write_warc(_table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))


def op12_tiled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    listed = merkle.manifest(_table(spark, sf_dir, "documents"), changed={"text": merkle.lower_ascii(F.col("text"))}, tampered=tampered)
    return listed.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_QUERIES = [
    op1_stratified_interleaving, op2_merge_dropout, op3_patience_licenses, op4_scaled_sketch, op5_tensored_minhash, op6_entropy_balancing, op7_class_bigrams, op8_bit_packing,
    op9_weak_supervision, op10_sharded_warc, op11_token_alignment, op12_tiled_vectors, op13_merkle_manifest,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


_WORDS = """
words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
)"""

_OP5 = f"""
WITH RECURSIVE {_WORDS},
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words WHERE len(w) >= 5),
windows AS (
  SELECT doc_id, word || ' ' || lead(word, 1) OVER q || ' ' || lead(word, 2) OVER q || ' ' || lead(word, 3) OVER q || ' ' || lead(word, 4) OVER q AS shingle
  FROM placed WINDOW q AS (PARTITION BY doc_id ORDER BY p)
),
shingles AS (
  SELECT DISTINCT doc_id, shingle FROM windows WHERE shingle IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 4
),
sizes AS (SELECT doc_id, count(shingle) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
shared AS (SELECT doc_id, hash(shingle) AS shingle FROM shingles QUALIFY count(*) OVER (PARTITION BY shingle) > 1),
links AS (
  SELECT c.a, c.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM shared x JOIN shared y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
  ) c JOIN sizes p ON p.doc_id = c.a JOIN sizes q ON q.doc_id = c.b
  WHERE 100 * k >= 75 * (p.n + q.n - k)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = doc_id
"""


_OP10 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
),
owners AS (SELECT hex, min(page_id) AS owner FROM payloads GROUP BY hex)
SELECT page_id, strlen(html) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))::BIGINT) & 31)::BIGINT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM payloads JOIN owners USING (hex)
"""


_OP12 = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
"""


def _op13(levels: int = 6) -> str:
    """The levels one by one, enough for 16 ** levels rows a source and as many sources.

    A group that is down to one node passes the other levels as it is.
    """
    fields = " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: f"sha256({fields} || coalesce(strlen({text}) || ':' || {text}, '-'))"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    parts = [f"""leaves AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(lower)} AS changed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, {leaf('text')}) - 1 AS r,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: {step})), 4294967295) AS crc
  FROM documents
)""", "s0 AS (SELECT coalesce('=' || source, '!') AS g, r, leaf AS h FROM leaves)"]

    def tree(t: str) -> None:
        for k in range(levels):
            own = "PARTITION BY g, r // 16 ORDER BY r ROWS BETWEEN"
            parts.append(f"""{t}{k}x AS (
  SELECT g, r, h, count(*) OVER (PARTITION BY g) > 1 AS more,
    coalesce(string_agg(h, '') OVER ({own} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre, coalesce(string_agg(h, '') OVER ({own} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post
  FROM {t}{k}
)""")
            parts.append(f"{t}{k + 1} AS (SELECT g, r // 16 AS r, CASE WHEN any_value(more) THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h FROM {t}{k}x GROUP BY g, r // 16)")

    def climb(f: str, t: str) -> None:
        for k in range(levels):
            parts.append(f"""{f}{k + 1} AS (
  SELECT f.id, f.g, f.r // 16 AS r, CASE WHEN x.more THEN proof || x.pre || x.post ELSE proof END AS proof, CASE WHEN x.more THEN sha256(x.pre || now || x.post) ELSE now END AS now
  FROM {f}{k} f JOIN {t}{k}x x ON x.g = f.g AND x.r = f.r
)""")

    tree("s")
    parts.append(f"t0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS r, h, g AS s FROM s{levels})")
    tree("t")
    parts.append(f"f0 AS (SELECT leaves.r AS id, coalesce('=' || source, '!') AS g, r, '' AS proof, CASE WHEN crc % 5 = 0 THEN changed ELSE leaf END AS now FROM leaves)")
    climb("f", "s")
    parts.append(f"u0 AS (SELECT struct_pack(s := f.g, r := f.id) AS id, t0.g, t0.r, proof, now FROM f{levels} f JOIN t0 ON t0.s = f.g)")
    climb("u", "t")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, t0.h AS subroot, t{levels}.h AS root, sha256(u.proof) AS proof_sha256, u.now AS folded_root, u.now = t{levels}.h AS verified
FROM leaves JOIN t0 ON t0.s = coalesce('=' || source, '!') JOIN u{levels} u ON u.id = struct_pack(s := t0.s, r := leaves.r) CROSS JOIN t{levels}
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_tensored_minhash": _OP5, "op10_sharded_warc": _OP10, "op12_tiled_vectors": _OP12, "op13_merkle_manifest": _op13()}
