"""The registered queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import audit, decontaminate, linededup, lm, minhash, multiindex, packing, periodic, sharding, sitetree, tokenfile, toxicity, warc
from quarry.llm.common import numbered, read, ready
from quarry.session import scratch_path

QUERIES = {}
ORACLE = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ready(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn

    return deco


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.labelled_rows(docs, labels, "doc_id", "text", "toxic"))
    return toxicity.score(docs, model, "doc_id", "text")


@register("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register("op10_warc")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    records = warc.read_archives(spark, path)
    return records.select(
        F.expr("try_cast(record_id AS BIGINT)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr("try_cast(refers_to AS BIGINT)").alias("refers_to"),
    )


@register("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pieces(read(spark, sf_dir, "documents"), "doc_id", "text", vocabulary)
    rows = numbered(pieces, "pieces").select("_row", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.assign(rows, 2048).drop("_row")


@register("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        read(spark, sf_dir, "documents"), "doc_id", "text", read(spark, sf_dir, "benchmark"), "item_id", "text"
    )


@register("op8_line_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.dedup_lines(docs, "doc_id", "text")
    return out.select("doc_id", "text", "removed_lines")


@register("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.extract(read(spark, sf_dir, "pages"), "page_id", "url", "html")


@register("op9_minhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), "doc_id", "text")


@register("op5_multi_index")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_duplicates(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@register("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"), "doc_id", "text")


AUDIT_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
firsts AS (SELECT t, min(doc_id) AS m FROM w GROUP BY t),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
docs AS (SELECT w.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
                MAP {'A': len(ws) < 50, 'B': 100 * len(list_distinct(ws)) < 65 * len(ws),
                     'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t),
                     'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(w.doc_id > f.m, false)} AS fails
         FROM w JOIN firsts f USING (t) LEFT JOIN marks k ON k.doc_id = w.doc_id),
hist AS (SELECT part, good, toxic, fails, count(*) AS n FROM docs GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT o, s FROM orders, (SELECT unnest(range(1, 6)) AS s)),
hit AS (SELECT h.part, o, s, n, good, toxic, o[s] AS f,
               h.fails[o[s]] AS bad, len(list_filter(range(1, s), lambda i: h.fails[o[i]])) > 0 AS gone,
               len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: h.fails[x])) = 1 AS single
        FROM hist h, steps),
agg AS (SELECT part, o, s, f, sum(CASE WHEN NOT bad AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
               sum(CASE WHEN bad AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
               sum(CASE WHEN bad AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
               sum(CASE WHEN bad AND single THEN n ELSE 0 END)::BIGINT AS unique_fails,
               sum(CASE WHEN bad AND NOT gone AND good = 1 THEN n ELSE 0 END)::BIGINT AS good_lost,
               sum(CASE WHEN bad AND NOT gone AND toxic = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost
        FROM hit GROUP BY part, o, s, f)
SELECT part, o AS filter_order, s::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM agg
"""


@register("op11_filter_audit", AUDIT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def with_period(text: Column, doc_id: Column) -> Column:
    """A tenth of the texts (by the id's crc32) with a tail that repeats: from word a on, word i becomes
    word a + (i - a) % p. Other texts stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i))), " ")).otherwise("")

    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    return F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(text)


@register("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = periodic.detect(docs.select("doc_id", with_period(F.col("text"), F.col("doc_id")).alias("text")), "doc_id", "text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@register("op13_token_file")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    tokenfile.write(read(spark, sf_dir, "documents"), "doc_id", "text", path, public_tokenizers.path("word_bpe_49k.json"))
    rows = tokenfile.documents(spark, path)
    return rows.select("doc_id", "start", "n_tokens", tokenfile.ids_crc32("ids").alias("ids_crc32"))
