"""The registered queries ``opN_<name>`` over whole tables, and their SQL twins.

A query fixes the production parameters of its operator and derives the
columns of its contract; the operators' own interfaces are more general.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import (ann, clusters, edit_fingerprint, fim, lines, mixing, packing, pieces, quality, sharding,
                        simhash, substring, token_files)
from rillet.llm.common import prepare, table
from rillet.llm.encode import default_tokenizer
from rillet.session import scratch_path

#: Id that ends a document in token files and in packed sequences.
FILE_END, PACK_END = 0, 1
#: Ids of a packed sequence.
SEQUENCE = 2048
#: Seed of the order in which a source's documents are taken.
MIX_SEED = 11
#: Nearest vectors of a query.
NEAREST = 5
#: Shards of the corpus.
SHARDS = 24
#: Words of a repeated passage.
WINDOW_WORDS = 50
#: SimHash near-duplicates: words of a shingle, largest bit distance.
SHINGLE_WORDS, MAX_BITS = 3, 2
#: Fill-in-middle: seed of the cuts.
FIM_SEED = 1
#: Clusters: centroids, rounds, components, scale of whole numbers, seed of the first centroids.
CENTROIDS, ROUNDS, DIM, SCALE, CENTROID_SEED = 8, 10, 64, 1024, 3


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a model fitted on rows that are not held out."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"), quality.MOST_ROWS)
    return quality.score_documents(docs, model, quality.THRESHOLD)


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every vector whose id is divisible by 50."""
    prepare(spark)
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, NEAREST)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written to Arrow stream files and read back from them."""
    prepare(spark)
    manifest = token_files.write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"),
                                        default_tokenizer(), FILE_END)
    return token_files.read_documents(manifest)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids along a Hilbert curve."""
    prepare(spark)
    pieces = packing.pack(table(spark, sf_dir, "documents"), default_tokenizer(), PACK_END, SEQUENCE)
    return pieces.drop("ids")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources at weights 5, 2, 1 takes of every document."""
    prepare(spark)
    return mixing.mix_report(table(spark, sf_dir, "documents"), mixing.WEIGHTS, mixing.MOST, MIX_SEED)


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept after removal of 50-word windows that an earlier document has."""
    prepare(spark)
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"), WINDOW_WORDS)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept after removal of chunks of lines that an earlier document has."""
    prepare(spark)
    kept = lines.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    prepare(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op9_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit-embedding fingerprints against an edited text and the next document."""
    prepare(spark)
    return edit_fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes (and tokens and rows)."""
    prepare(spark)
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two code points and put together for fill-in-middle training."""
    prepare(spark)
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"), FIM_SEED)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 8 clusters after 10 rounds, with distances and inertia."""
    prepare(spark)
    return clusters.with_inertia(clusters.cluster(table(spark, sf_dir, "embeddings"), CENTROIDS, ROUNDS, DIM, SCALE,
                                                  CENTROID_SEED))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by a SentencePiece vocabulary and decoded again."""
    prepare(spark)
    made = pieces.encode_documents(table(spark, sf_dir, "documents"), pieces.default_pieces())
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_ann": op2_ann,
    "op3_token_files": op3_token_files,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_substring": op6_substring,
    "op7_lines": op7_lines,
    "op8_simhash": op8_simhash,
    "op9_edit_fingerprint": op9_edit_fingerprint,
    "op10_sharding": op10_sharding,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_clusters": op12_clusters,
    "op13_pieces": op13_pieces,
}

_OP5_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS h,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
capped AS (  -- ascending in the level at which a source reaches its cap
  SELECT *, 3 * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER below, 0) AS free_size,
         sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS free_weight
  FROM sources
  WINDOW below AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT free_size::DOUBLE / free_weight::DOUBLE AS level FROM capped
  WHERE cap >= weight * (free_size::DOUBLE / free_weight::DOUBLE)
  ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(weight * level, cap::DOUBLE) AS target FROM capped, level),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
running AS (
  SELECT d.*, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized d JOIN shares t ON d.source IS NOT DISTINCT FROM t.source),
remainder AS (
  SELECT *, rest - coalesce(sum(CASE WHEN upto <= rest THEN size END) OVER (PARTITION BY source), 0) AS remains
  FROM running),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY source, upto > rest AND size > 0
                               ORDER BY abs(remains - size), h) AS nth
  FROM remainder)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN upto <= rest THEN 1
                             WHEN size > 0 AND nth = 1 AND abs(remains - size) < remains THEN 1
                             ELSE 0 END))::BIGINT AS taken
FROM nearest
"""

_OP6_SQL = """
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
begins AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM split),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS w FROM begins),
firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (
  SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE first < doc_id),
covered AS (
  SELECT DISTINCT doc_id, i + j AS i FROM hits, (SELECT unnest(range(0, 50)) AS j)),
placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS text FROM placed p ANTI JOIN covered USING (doc_id, i)
  GROUP BY p.doc_id),
gone AS (
  SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

_OP7_SQL = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, len(lines) AS n, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM split),
hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM line),
hit AS (
  SELECT *, (h + 31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % 3 = 0 AS hit FROM hashed),
boundary AS (
  SELECT *, hit AND i >= 1 AND i <= n - 3
            AND NOT lag(hit) OVER (PARTITION BY doc_id ORDER BY i) AS ends FROM hit),
numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM boundary),
chunk AS (
  SELECT doc_id, k, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM numbered GROUP BY ALL),
first AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, k) AS nth FROM chunk),
kept AS (
  SELECT *, nth = 1 OR n = 1 OR NOT regexp_matches(chunk, '[^\x20\x09-\x0D]') AS keep FROM first)
SELECT doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(CASE WHEN NOT keep THEN n END), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN keep THEN chunk END, chr(10) ORDER BY k), '')) AS kept_sha256
FROM kept GROUP BY doc_id
"""

_OP11_SQL = f"""
WITH named AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
         sha256('{FIM_SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS d FROM documents),
hashed AS (
  SELECT *, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
         ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM named),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""


def _clusters_sql() -> str:
    """Every round written out: compare all vectors with all centroids, then floor the means."""
    square = "list_sum(list_transform(list_zip(x, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    nearest = (f"SELECT i, any_value(vec_id) AS vec_id, any_value(x) AS x, min(struct_pack(d := {square}, c := c)) AS w "
               "FROM kept, c{r} GROUP BY i")
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, m) - 1 AS c, m FROM (
    SELECT x AS m, sha256('{CENTROID_SEED}:' || coalesce(vec_id::VARCHAR, 'null')) AS h FROM kept
    ORDER BY h, m LIMIT {CENTROIDS}))"""]
    for r in range(ROUNDS):
        steps.append(f"a{r} AS MATERIALIZED ({nearest.format(r=r)})")
        steps.append(f"""s{r} AS (
  SELECT w.c AS c, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, {DIM + 1}) AS t(j) GROUP BY 1, 2)""")
        steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(n.m, c{r}.m) AS m FROM c{r} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS m FROM s{r} GROUP BY c) n ON n.c = c{r}.c)""")
    steps.append(f"final AS MATERIALIZED ({nearest.format(r=ROUNDS)})")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, w.c::INTEGER AS cluster, w.d AS distance, (sum(w.d) OVER (PARTITION BY w.c))::BIGINT AS cluster_inertia,
       (sum(w.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM final JOIN c{ROUNDS} ON c{ROUNDS}.c = w.c
"""


ORACLE_SQL: dict[str, str] = {
    "op5_mixing": _OP5_SQL,
    "op6_substring": _OP6_SQL,
    "op7_lines": _OP7_SQL,
    "op11_fill_in_middle": _OP11_SQL,
    "op12_clusters": _clusters_sql(),
}
