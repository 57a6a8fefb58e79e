"""The numbered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.llm import ann, embedding_join, filter_audit, langid, mixing, packing, periodic, pitman_yor, quality, repeats, rollup, setsketch, toxicity
from arbora.llm.text import fold, word_array
from arbora.llm.workspace import stored, table_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(fold(F.col("doc_id"), 5) != 0))
    return langid.identify(docs, model, ["doc_id"]).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=("doc_id",))
    plan = mixed.select("row.doc_id", "size", "source_size", "target", "taken", "positions")
    return mixing.in_training_order(plan)


def op4_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under two tokenizer versions; those labelled of low quality go; counts of the toxic ones,
    of which only the lines are to count, are revised; and two of the batches are sent again."""
    docs = table(spark, sf_dir, "documents")
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    counts = docs.select("doc_id", "source", "lang", rollup.word_tokens(F.col("text")).alias("words"), rollup.piece_tokens(F.col("text")).alias("pieces"), lines.alias("lines"))
    counts = stored(counts.join(labels, "doc_id", "left"), "counts")
    of = lambda rows, c, name: rows.select("source", "lang", F.lit(name).alias("tokenizer"), F.col(c).alias("tokens"))
    words = lambda rows: of(rows, "words", "words-1")
    pieces = lambda rows: of(rows, "pieces", "pieces-1")
    low = counts.where("quality = 0")
    toxic = counts.where("toxic = 1 and not coalesce(quality = 0, false)")
    revised = toxic.select("source", "lang", F.lit("words-1").alias("tokenizer"), F.col("words").alias("old_tokens"), F.col("lines").alias("tokens"))
    kept = rollup.Rollup(spark, table_path(spark, "rollup"))
    first = rollup.changes(inserted=words(counts))
    kept.commit("words", first)
    kept.commit("pieces", rollup.changes(inserted=pieces(counts)))
    kept.commit("low-quality", rollup.changes(deleted=words(low).unionByName(pieces(low))))
    kept.commit("words", first)
    kept.commit("toxic", rollup.changes(revised=revised))
    kept.commit("toxic", rollup.changes(revised=revised))
    return kept.totals()


OP5_SQL = r"""
WITH l AS (SELECT doc_id, min(quality) quality, max(toxic) toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT d.source, d.lang, coalesce(l.quality = 0, false) low, coalesce(l.toxic = 1, false) toxic,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) words,
    len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) pieces,
    len(string_split(coalesce(text, ''), chr(10))) lines
  FROM documents d LEFT JOIN l USING (doc_id))
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS documents, CAST(sum(CASE WHEN toxic THEN lines ELSE words END) AS BIGINT) AS tokens
FROM d WHERE NOT low GROUP BY source, lang
UNION ALL
SELECT source, lang, 'pieces-1', count(*), CAST(sum(pieces) AS BIGINT) FROM d WHERE NOT low GROUP BY source, lang
"""


def op6_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), setsketch.Params(words=2))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = fold(F.col("doc_id"), 3) != 1
    model = toxicity.train(docs.where(learned), labels.where(learned).select("doc_id", "toxic"))
    return toxicity.score(docs, model, ["doc_id"]).withColumn("held_out", fold(F.col("doc_id"), 3) == 1)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("learn", fold(F.col("doc_id"), 10) != 0)
    scored = pitman_yor.score(docs, "learn")
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicate(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def planted_text(doc_id: Column, text: Column) -> Column:
    """text; with h = crc32(doc_id as text) divisible by 10, its words with a periodic end that h chooses."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic_end(w: Column) -> Column:
        n = F.size(w)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        end = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.when(n > 0, F.concat_ws(" ", F.slice(w, F.lit(1), a), end)).otherwise(text)

    return F.when(h % 10 == 0, F.transform(F.array(word_array(text)), periodic_end)[0]).otherwise(text)


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic.collapse(docs.select("doc_id", planted_text(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    top, digest = F.col("top"), lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("top", periodic.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"), top["period"].alias("period"),
        F.floor(1000 * top["length"] / top["period"]).cast("long").alias("exponent_milli"), digest(F.array_join(lines, "")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP4_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e) AND isfinite(list_dot_product(e, e)) AND list_dot_product(e, e) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.b FROM reach r JOIN links l ON l.a = r.y),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
c AS (SELECT x, min(y) AS component FROM reach GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component AS component_id, vec_id = component AS kept
FROM v JOIN c ON c.x = vec_id LEFT JOIN n ON n.a = vec_id
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM w),
t AS (SELECT doc_id, word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS after, count(*) OVER (PARTITION BY doc_id) AS n FROM p),
s AS (SELECT DISTINCT doc_id, CASE WHEN n = 1 THEN word ELSE word || ' ' || after END AS g FROM t WHERE n = 1 OR after IS NOT NULL),
k AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN k x ON x.doc_id = a JOIN k y ON y.doc_id = b WHERE 100 * m >= 80 * (x.k + y.k - m)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.b FROM reach r JOIN links l ON l.a = r.y),
c AS (SELECT x, min(y) AS component FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(k.k, 0) AS n_shingles, component AS component_id, w.doc_id = component AS kept
FROM w JOIN c ON c.x = w.doc_id LEFT JOIN k ON k.doc_id = w.doc_id
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, doc_id > min(doc_id) OVER (PARTITION BY t) AS late FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(w) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN coalesce(late, false) THEN 16 ELSE 0 END) AS mask
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(f, b)),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND bit_count(a.b | b.b | c.b | d.b | e.b) = 5),
s AS (SELECT filter_order, step, bits[step] AS own, CAST(list_sum(bits[1:step]) AS INTEGER) - bits[step] AS before FROM o, range(1, 6) r(step)),
g AS (SELECT part, f.b AS own, sum(CASE WHEN (mask & f.b) <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END) AS shapley FROM c, f GROUP BY part, f.b)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(any_value(shapley) AS BIGINT) AS shapley
FROM c JOIN s ON true JOIN g USING (part, own) GROUP BY part, filter_order, step
"""


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op4_embedding_join": OP4_SQL, "op5_rollup": OP5_SQL, "op6_setsketch": OP6_SQL, "op11_filter_audit": OP11_SQL}
