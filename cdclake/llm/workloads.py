"""Registered queries of the subpackage, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attribution, harmonic, jaccard, langid, merkle, mixing, packing, pivots, ppm, quality, sitetree, spelling, substrings

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "mix.*")


def op3_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op4_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.with_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *[F.col(f"quality.{x}").alias(x) for x in names])


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op7_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return pivots.nearest(rows, rows.where("vec_id % 100 = 0"))


def op8_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.section_tokens(table(spark, sf_dir, "documents"))


def op9_suffix_bucket_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_bytes(table(spark, sf_dir, "documents"), passage=substrings.PASSAGE)


def op10_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.main_text(table(spark, sf_dir, "pages"))


def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = harmonic.harmonic_pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "class")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", spelling.UPPER, spelling.LOWER)
    given = F.when(tampered, merkle.leaf_of([lowered if x == "text" else F.col(x) for x in merkle.FIELDS]))
    rows = merkle.manifest(docs, carry={"given": given})
    rows = rows.withColumn("folded", merkle.folded(F.coalesce("given", "leaf"), F.col("path")))
    digests = [merkle.hex_of(F.col(x)).alias(y) for x, y in (("leaf", "leaf"), ("subroot", "subroot"), ("root", "root"), ("folded", "folded_root"))]
    return rows.select("doc_id", *digests, merkle.proof_of(F.col("path")).alias("proof_sha256"), (F.col("folded") == F.col("root")).alias("verified"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), drop_every=31)


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_raked_mixture": op2_raked_mixture,
    "op3_ppm_score": op3_ppm_score,
    "op4_language_codes": op4_language_codes,
    "op5_line_cleaning": op5_line_cleaning,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_pivot_topk": op7_pivot_topk,
    "op8_token_attribution": op8_token_attribution,
    "op9_suffix_bucket_dedup": op9_suffix_bucket_dedup,
    "op10_site_style_tree": op10_site_style_tree,
    "op11_harmonic_packing": op11_harmonic_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {}

# The rules of quality.py in SQL: the same fixed values, on DuckDB's list functions.
ORACLES["op5_line_cleaning"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS p FROM starts, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY doc_id),
ln AS (
  SELECT doc_id, len(lines) AS n_lines, list_distinct(lines) AS dl, lines FROM d),
good AS (
  SELECT doc_id, n_lines, len(dl) AS n_distinct, list_sum(list_transform(lines, lambda x: length(x))) AS all_chars,
         list_sum(list_transform(list_filter(dl, lambda x:
             regexp_matches(x, '[.!?…。:;]["''”’»)\]]*[\x20\x09-\x0D]*$')
             AND length(regexp_replace(x, '[^#*$%&|<>!]', '', 'g')) <= 0.06 * length(x)
             AND NOT len(string_split_regex(x, ' [|»›•→] ')) > 2
             AND NOT (length(x) <= 200 AND regexp_matches(lower(x), '{phrases}'))
         ), lambda x: length(x))) AS good_chars
  FROM ln)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
       CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(n_lines - n_distinct AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
       len(w) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(w) AS base_failed,
       NOT (len(w) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(w))
         AND coalesce(good_chars, 0) >= 0.5 * all_chars AS kept
FROM d JOIN good USING (doc_id) LEFT JOIN covered c USING (doc_id)
""".replace("{phrases}", "|".join(quality.BOILERPLATE).replace("'", "''"))

# Exact similarities of all pairs that share a run of five words, then the groups that links connect.
ORACLES["op6_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a, b, c = na.n AND c = nb.n AS same
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE c >= 0.8 * (na.n + nb.n - c) - 1e-9),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
class AS MATERIALIZED (
  SELECT doc_id, least(doc_id, coalesce(min(b), doc_id)) AS text_class, 1 + count(b) AS n_copies
  FROM d LEFT JOIN pairs p ON p.a = doc_id AND p.same GROUP BY doc_id),
links AS (
  SELECT p.a AS doc_id, count(DISTINCT c.text_class) AS n_links FROM pairs p JOIN class c ON c.doc_id = p.b WHERE NOT p.same GROUP BY p.a)
SELECT c.doc_id, c.text_class, c.n_copies, g.class_id, CAST(coalesce(l.n_links, 0) AS BIGINT) AS n_links
FROM class c JOIN (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a) g USING (doc_id) LEFT JOIN links l USING (doc_id)
"""

# Every query against every row.
ORACLES["op7_pivot_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    octets = f"list_transform(range(0, strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda a, b: {byte}), 4294967295)"


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR) END"


_LEAF = "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

# Levels of all trees from the leaves up; then each row's siblings, level by level.
ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, {_LEAF.format(text="text")} AS leaf, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS given,
         CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS g
  FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
up AS (
  SELECT 0 AS level, g, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, g, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY level, g, pos // 16, n),
inner_nodes AS MATERIALIZED (SELECT * FROM up),
tops AS MATERIALIZED (SELECT g, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM inner_nodes WHERE n = 1),
outer_up AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM tops
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM outer_up WHERE n > 1 GROUP BY level, pos // 16, n),
outer_nodes AS MATERIALIZED (SELECT * FROM outer_up),
root AS (SELECT digest AS root FROM outer_nodes WHERE n = 1),
steps AS MATERIALIZED (
  SELECT p.g, p.pos, s.level, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < p.pos // pow(16, s.level)::BIGINT), '') AS l, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > p.pos // pow(16, s.level)::BIGINT), '') AS r
  FROM placed p JOIN inner_nodes s ON s.g = p.g AND s.n > 1 AND s.pos // 16 = p.pos // pow(16, s.level + 1)::BIGINT GROUP BY p.g, p.pos, s.level
  UNION ALL
  SELECT p.g, p.pos, 1000 + s.level, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < t.pos // pow(16, s.level)::BIGINT), ''), coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > t.pos // pow(16, s.level)::BIGINT), '')
  FROM placed p JOIN tops t ON t.g = p.g JOIN outer_nodes s ON s.n > 1 AND s.pos // 16 = t.pos // pow(16, s.level + 1)::BIGINT GROUP BY p.g, p.pos, s.level),
paths AS MATERIALIZED (
  SELECT g, pos, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, list({{'l': l, 'r': r}} ORDER BY level) AS path FROM steps GROUP BY g, pos),
fold AS (
  SELECT g, pos, coalesce(given, leaf) AS digest, 1 AS k FROM placed
  UNION ALL
  SELECT f.g, f.pos, sha256(path[k].l || digest || path[k].r), k + 1 FROM fold f JOIN paths USING (g, pos) WHERE k <= len(path)),
folded AS (SELECT g, pos, arg_max(digest, k) AS folded_root FROM fold GROUP BY g, pos)
SELECT p.doc_id, p.leaf, t.subroot, root.root, coalesce(w.proof, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = root.root AS verified
FROM placed p JOIN tops t ON t.g = p.g JOIN folded f ON f.g = p.g AND f.pos = p.pos LEFT JOIN paths w ON w.g = p.g AND w.pos = p.pos, root
"""

# Near words share all letters but one: a place in both words, or a letter that only one of them has.
ORACLES["op13_spelling_variants"] = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
sums AS MATERIALIZED (SELECT run, n, {_crc32("doc || ':' || run")} AS h FROM (SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc, run)),
w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM sums)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS MATERIALIZED (
  SELECT DISTINCT x.word, x.n, y.word AS v, y.n AS m FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM holes x JOIN w y ON y.word = x.a || x.b
  UNION SELECT y.word, y.n, x.word, x.n FROM holes x JOIN w y ON y.word = x.a || x.b),
best AS (SELECT word, n, v, m, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(v)) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN v END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n FROM w LEFT JOIN best ON best.word = w.word AND k = 1),
way AS (
  SELECT word, word AS root, 0 AS k FROM forms
  UNION ALL
  SELECT way.word, f.form, k + 1 FROM way JOIN forms f ON f.word = way.root WHERE f.form IS NOT NULL)
SELECT f.*, r.root FROM forms f JOIN (SELECT word, arg_max(root, k) AS root FROM way GROUP BY word) r USING (word)
"""
