"""The dealt operators over the driver's tables, under the names they are checked by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import decontam, fim, html_article, langid, license_scan, minhash, packing, phrases, quality, secret_scan, sharding, simhash, suffix_dedup
from broadsheet.llm.common import table

FOLDS = 5
TOKENIZER = "byte_bpe_50k.json"


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training; one without an id is neither."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def taught(docs: DataFrame) -> DataFrame:
    """The documents that language ID may learn from."""
    return docs.filter(F.col("doc_id").isNotNull() & ~held_out())


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.simhash_components(docs).select(
        "doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id"
    )


def op2_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge_quality(docs)


def op3_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_power_of_two(docs, tokenizer_path(), with_ids=False).drop("bucket")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.judge_languages(docs.select("doc_id", "text"), taught(docs), "found", columns=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "found.lang_pred", "found.score", "found.bits_per_byte", "found.rejected")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontam.mark_leaks(docs, table(spark, sf_dir, "benchmark"), "leak")
    return marked.select(
        "doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op7_html_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_article.article_text("html").alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secret_scan.scan_secrets(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(p.kind) for p in secret_scan.BASE),
        F.sha2(secret_scan.span_list("base").cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_list("spans").alias("spans"),
        F.col("n_copied").cast("long").alias("n_copied"),
    )


def op6_two_pass_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shuffle_into_shards(docs).select(
        "doc_id",
        sharding.row_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    templates = spark.createDataFrame(list(license_scan.TEMPLATES.items()), "license_id string, text string")
    found = license_scan.find_licenses(docs, templates, "licenses")
    return found.select(
        "doc_id",
        F.array_join(F.transform("licenses", lambda x: x["license_id"]), ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"),
        F.coalesce(F.array_max(F.transform("licenses", lambda x: x["containment"])), F.lit(0.0)).alias("containment"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), "fim")
    back = fim.restored(fim.rendered("text", "fim.pieces"), "fim.form")
    return docs.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.col("fim.sha256").alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_quality_perplexity,
        op3_power_of_two_packing,
        op4_language_id,
        op5_decontamination,
        op6_two_pass_sharding,
        op7_html_article,
        op8_secret_scan,
        op9_suffix_dedup,
        op10_license_scan,
        op11_fill_in_middle,
        op12_phrase_collocations,
        op13_minhash_near_dedup,
    )
}

# Left to right, a unit is a run of letters or one other character. The output is taken apart again by its sentinels.
_OP11 = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents
), drawn AS (
    SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
        CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4
    FROM docs
), formed AS (
    SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM formed
), outputs AS (
    SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM parts
), found AS (
    SELECT *, instr(o, '<P>') AS at_p, instr(o, '<S>') AS at_s, instr(o, '<M>') AS at_m FROM outputs
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(o) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN o
        WHEN 'psm' THEN substr(o, at_p + 3, at_s - at_p - 3) || substr(o, at_m + 3) || substr(o, at_s + 3, at_m - at_s - 3)
        ELSE substr(o, at_p + 3, at_m - at_p - 3) || substr(o, at_m + 3) || substr(o, at_s + 3, at_p - at_s - 3) END) AS restored_sha256
FROM found
"""

# Every run of one to four words of a piece; sums and products in 128 bits.
_OP12 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), words AS (
    SELECT lang, w, CAST(len(w) AS BIGINT) AS size FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)
), totals AS (
    SELECT lang, CAST(sum(size) AS BIGINT) AS n FROM words GROUP BY lang
), starts AS (
    SELECT lang, w, size, unnest(range(1, size + 1)) AS i FROM words
), runs AS (
    SELECT lang, w[i:i + k - 1] AS p FROM (SELECT lang, w, size, i, unnest([1, 2, 3, 4]) AS k FROM starts) WHERE i + k - 1 <= size
), counts AS (
    SELECT lang, p, CAST(count(*) AS BIGINT) AS f FROM runs GROUP BY lang, p HAVING count(*) >= 30
), candidates AS (
    SELECT lang, p, f AS a, len(p) AS size FROM counts WHERE len(p) > 1
), cuts AS (
    SELECT c.lang, c.p, c.a, c.k, h.f AS l, t.f AS r, CAST(2000000 AS HUGEINT) * c.a // (CAST(h.f AS HUGEINT) + t.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN counts h ON h.lang = c.lang AND h.p = c.p[1:c.k]
    JOIN counts t ON t.lang = c.lang AND t.p = c.p[c.k + 1:c.size]
), worst AS (
    SELECT lang, p, a, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
    SELECT lang, p[i:i + k - 1] AS p, max(a) AS longer
    FROM (SELECT lang, p, a, size, k, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM candidates)) GROUP BY ALL
), ranked AS (
    SELECT w.lang, array_to_string(w.p, ' ') AS phrase, w.a, w.l, w.r, CAST(w.score AS BIGINT) AS score
    FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.p = w.p
    WHERE i.longer IS NULL OR CAST(100 AS HUGEINT) * i.longer < CAST(80 AS HUGEINT) * w.a
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked
)
SELECT lang, rank, phrase, a, l, r, n, score FROM numbered JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL: dict[str, str] = {"op11_fill_in_middle": _OP11, "op12_phrase_collocations": _OP12}
