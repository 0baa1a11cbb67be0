"""The registered queries of the subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import audit, bpe, common, fracmin, langid, licenses, lines, mixing, pieces, quality, rabitq, resampling, simhash, warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(common.table(spark, sf_dir, "documents"))


def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives, folder = warc.archived(common.table(spark, sf_dir, "pages"))
    return warc.read(archives, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.near_duplicates(common.table(spark, sf_dir, "embeddings"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenized(common.table(spark, sf_dir, "documents"), RANKS, PATTERN, ("n_tokens", "ids_sha256", "decoded_sha256"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.without_repeats(common.table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["begin"], s["end"])), ",")
    return found.select(F.col("_row.doc_id").alias("doc_id"), F.col("clean").alias("text"), F.size("removed").alias("n_removed"), spans.alias("removed"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fracmin.edited(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fracmin.as_text(F.col("sketch")).alias("fingerprint"),
        fracmin.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fracmin.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fracmin.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = langid.trained(docs.where(~held_out()))
    found = langid.identified(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(common.table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def as_files(docs: DataFrame) -> DataFrame:
    """The documents as files: a directory per source, below it one per thousand and per hundred ids; of each hundred one is a licence file.

    Ids of a source are 20 apart, so ``doc_id div 20 % 5 = 0`` picks one in five. A document
    without id is a file named by a hash of its text. ``doc_id`` stays beside the path.
    """
    named = F.when(F.expr("doc_id div 20 % 5") == 0, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")))
    name = F.coalesce(named, F.concat(F.lit("without-id-"), F.hex(common.text_key()), F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.expr("doc_id div 1000"), F.expr("doc_id div 100 % 10"), name)
    return docs.select("doc_id", path.alias("path"), "text")


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_files(common.table(spark, sf_dir, "documents"))


def licensed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``path`` and what the scan finds for the path, a row per row of ``docs``.

    Rows of one source and id are one file, and rows of one source and text without id.
    """
    files = as_files(docs)
    found = files.select("doc_id", "path").join(licenses.scanned(files), "path")
    return found.select("doc_id", "path", "license", F.round("cosine", 6).alias("cosine"), "origin", "named_by")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licensed(common.table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.importance(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.tokenized(common.table(spark, sf_dir, "documents"), PIECES, ("n_tokens", "ids_sha256", "decoded_sha256"))


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": quality_classifier,
        "op2_warc": warc_archives,
        "op3_embedding_near_dedup": embedding_near_dedup,
        "op4_byte_bpe": byte_bpe,
        "op5_substring_dedup": substring_dedup,
        "op6_document_fingerprints": document_fingerprints,
        "op7_language_id": language_id,
        "op8_source_mix": source_mix,
        "op9_license_scan": license_scan,
        "op10_simhash_near_dedup": simhash_near_dedup,
        "op11_importance_resampling": importance_resampling,
        "op12_sentencepiece": sentencepiece,
        "op13_filter_audit": filter_audit,
    }


WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), l AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i, 5))::BIGINT >> s) & 31)::INT, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM p JOIN l USING (h)
"""

EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), low AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN low ON id = vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id
"""

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, length(text) AS chars FROM documents
), k AS (
  SELECT *, -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
    / CASE WHEN (chars + 1) / greatest(size, 1) - 1 BETWEEN 3 AND 10 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS key FROM d
), s AS (
  SELECT source, sum(size) AS source_size, 2 * sum(size) AS cap, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER below, 0)) / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW below AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT max(level) FROM o)) AS target FROM o
), e AS (SELECT *, floor(target / greatest(source_size, 1)) AS epochs, target - floor(target / greatest(source_size, 1)) * source_size AS rest FROM t),
r AS (
  SELECT k.*, e.source_size, e.target, e.epochs, e.rest, sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
  (size * (epochs + CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""

# The checksums come from a table of 256 entries, made by its rule, folded over the bytes of each distinct word.
RESAMPLING_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), dw AS (SELECT r, unnest(words) AS w FROM d), dn AS (SELECT r, w, count(*) AS n FROM dw GROUP BY ALL),
v AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(hex(encode(w))), 2), lambda i: ('0x' || substr(hex(encode(w)), 1 + i, 2))::BIGINT)),
    lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM dn UNION SELECT w FROM b), crc
), s AS (SELECT bucket, sum(n)::BIGINT AS s FROM dn JOIN v USING (w) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM b JOIN v USING (w) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)
), w AS (SELECT r, sum(n * gain)::BIGINT AS weight FROM dn JOIN v USING (w) JOIN g USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (r)
), o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored LEFT JOIN o USING (r)
"""

AUDIT_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(source::VARCHAR, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)::INT AS fails
  FROM t LEFT JOIN l ON l.doc_id = t.doc_id
), c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
orders(o, step, bit, before) AS (
  SELECT '', 0, 0, 0
  UNION ALL SELECT o || x, step + 1, 1 << (ascii(x) - 65), before + bit FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)
), steps AS (
  SELECT full_order.o AS filter_order, p.step, p.bit, p.before
  FROM orders p JOIN (SELECT o FROM orders WHERE step = 5) full_order ON starts_with(full_order.o, p.o) WHERE p.step > 0
), r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails & before <> 0 AND fails & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails & before = 0 AND fails & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM c, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""


def sql() -> dict[str, str]:
    return {"op2_warc": WARC_SQL, "op3_embedding_near_dedup": EMBEDDING_SQL, "op8_source_mix": MIX_SQL, "op11_importance_resampling": RESAMPLING_SQL, "op13_filter_audit": AUDIT_SQL}
