"""The registered queries of this subpackage and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import boilerplate, decontaminate, dialogue, licences, minhash, mixing, neighbours, quality, ranked, secrets, simhash, substring, surrogates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run):
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@_query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        "component_id")


@_query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = joined(F.filter("spans", lambda s: s["kind"] != "novel"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"),
                        joined("spans").alias("spans"), count("novel"))


@_query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


@_query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.repeated_spans(_table(spark, sf_dir, "documents"))
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    each = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    kept_in = F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda s: s["of"]))))
    return found.select("doc_id", "n_units", F.size("spans").cast("long").alias("n_spans"),
                        total.alias("removed_words"), F.array_join(each, ",").alias("spans"),
                        kept_in.alias("kept_in"), (F.size("spans") > 0).alias("repeated"))


@_query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.find_licences(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"),
                        F.array_join("sentences", ",").alias("sentences"), "unknown")


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    texts = pages.select("page_id", boilerplate.host_of(F.col("url")).alias("host"),
                         boilerplate.page_text(F.col("html")).alias("text"))
    found = boilerplate.drop_boilerplate(texts, F.col("host"), F.col("text"))
    return found.select("page_id", "host", "n_lines", "n_dropped",
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


ORACLES["op7_line_dedup"] = f"""
WITH lines AS (
  SELECT page_id, coalesce(regexp_extract(url, '{boilerplate.HOST}', 1), '') AS host, u.line, u.i,
    trim(regexp_replace(u.line, '{boilerplate.BLANKS}', ' ', 'g')) AS plain
  FROM pages, unnest(string_split(regexp_replace(html, '{boilerplate.MARKUP}', chr(10), 'g'), chr(10)))
    WITH ORDINALITY AS u(line, i)),
sizes AS (
  SELECT coalesce(regexp_extract(url, '{boilerplate.HOST}', 1), '') AS host, count(*) AS n FROM pages GROUP BY 1),
common AS (
  SELECT l.host, l.plain FROM lines l JOIN sizes s ON l.host = s.host WHERE l.plain <> ''
  GROUP BY l.host, l.plain, s.n
  HAVING count(DISTINCT page_id) >= {boilerplate.LEAST_PAGES} AND count(DISTINCT page_id) > s.n * {boilerplate.MOST_SHARE}),
marked AS (
  SELECT l.*, c.plain IS NOT NULL AS gone FROM lines l LEFT JOIN common c ON l.host = c.host AND l.plain = c.plain)
SELECT page_id, host, count(*) FILTER (plain <> '') AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS text_sha256
FROM marked GROUP BY page_id, host
"""


@_query
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.replace_personal(_table(spark, sf_dir, "documents"), key="a key of the owner's choice")
    return found.select("doc_id", *[f"n_{kind}" for kind in surrogates.KINDS], "text")


@_query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair(dialogue.damaged(_table(spark, sf_dir, "conversations")))


@_query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


ORACLES["op12_minhash"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
cells AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM cells a JOIN cells b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reached r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.s)
"""


@_query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.best_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLES["op13_ranked_search"] = f"""
WITH words AS (SELECT doc_id, {_TERMS} AS w FROM documents),
sized AS (SELECT doc_id, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
total AS (SELECT count(*) AS c, sum(n)::BIGINT AS l FROM sized),
asked AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) u GROUP BY item_id, term),
held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words) u GROUP BY doc_id, term),
weighed AS (
  SELECT term, floor(1000 * ln((2 * c + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM held, total GROUP BY term, c),
scored AS (
  SELECT item_id, h.doc_id, sum(q * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * c) // l))))::BIGINT AS score
  FROM asked a JOIN held h ON a.term = h.term JOIN weighed w ON a.term = w.term JOIN sized s ON h.doc_id = s.doc_id, total
  GROUP BY item_id, h.doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
