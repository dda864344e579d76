"""Links, manifests, contents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Catalogue, money, table
from oreflow.functions.links import extract_links, first_links, is_data_file
from oreflow.operators.content import content_latest, content_versions, envelope_records, envelope_status
from oreflow.operators.manifest import MANIFEST_SCHEMA, merge_manifest, plan_pull, run_summary, to_pull
from oreflow.session import work_dir
from oreflow.sinks.landing import land_snapshot, snapshot_of, write_delimited
from oreflow.sinks.tables import ensure_table
from oreflow.sources import content_digest, read_delimited

CATALOGUE = Catalogue()
register = CATALOGUE.register

# --- links ---
LINKS_SQL = """matches AS (
    SELECT page_id, url, regexp_extract_all(html, '(?i)href=("[^"]*"|''[^'']*''|[^\\s>]+)', 1) AS found FROM pages),
raws AS (SELECT page_id, url, unnest(found) AS raw, generate_subscripts(found, 1) - 1 AS pos FROM matches),
links AS (
    SELECT page_id, url, CAST(pos AS INTEGER) AS pos,
           CASE WHEN length(raw) >= 2 AND left(raw, 1) IN ('"', '''') AND right(raw, 1) = left(raw, 1)
                THEN substring(raw, 2, length(raw) - 2) ELSE raw END AS href
    FROM raws)"""
SITE_ROOT = r"^([A-Za-z]+://[^/?#]*).*$"


def _in_directory(home: str) -> str:
    return f"""CASE WHEN href IN ('', '..') OR href LIKE '?%' OR href LIKE '#%' OR href LIKE 'mailto:%' OR href LIKE '%/' THEN false
         WHEN href LIKE '/%' THEN starts_with(href, {home})
              AND length(href) - length(replace(href, '/', '')) = length({home}) - length(replace({home}, '/', ''))
         ELSE true END"""


HOME = "regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') || '/'"


def _links(spark, sf_dir):
    return extract_links(table(spark, sf_dir, "pages"))


@register("link_extract", f"WITH {LINKS_SQL} SELECT page_id, pos, href FROM links")
def link_extract(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", "pos", "href")


@register(
    "link_filter",
    f"""WITH {LINKS_SQL} SELECT page_id, pos, href, {_in_directory(HOME)} AS beside_page,
        {_in_directory("'/'")} AS at_root FROM links""",
)
def link_filter(spark, sf_dir):
    """Is a link a file of the page's own directory, and is it one of the site's root?"""
    root = F.concat(F.regexp_replace("url", SITE_ROOT, "$1"), F.lit("/"))
    return _links(spark, sf_dir).select(
        "page_id", "pos", "href",
        is_data_file(F.col("href"), F.col("url")).alias("beside_page"),
        is_data_file(F.col("href"), root).alias("at_root"),
    )


@register(
    "link_dedup",
    f"""WITH {LINKS_SQL}
        SELECT page_id, CASE WHEN href LIKE '/%' THEN string_split(href, '/')[-1] ELSE href END AS name, min(pos) AS first_pos
        FROM links WHERE {_in_directory("'/'")} GROUP BY 1, 2""",
)
def link_dedup(spark, sf_dir):
    root = F.concat(F.regexp_replace("url", SITE_ROOT, "$1"), F.lit("/"))
    return first_links(_links(spark, sf_dir).filter(is_data_file(F.col("href"), root)))


# --- manifests: one file per customer and quarter. The source keeps orders from 1996 on;
#     the manifest is what was there in the middle of May 2000 ---
LISTING_SQL = """SELECT CAST(o_custkey AS VARCHAR) || '.' || CAST(year(o_orderdate) AS VARCHAR) || 'Q'
                || CAST(quarter(o_orderdate) AS VARCHAR) AS file_name,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) AS size_bytes,
           CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_modified
    FROM orders WHERE o_orderdate {when} GROUP BY 1"""
REMOTE_SQL = LISTING_SQL.format(when=">= '1996-01-01'")
KNOWN_SQL = LISTING_SQL.format(when="< '2000-05-15'")
PLAN_SQL = f"""remote AS ({REMOTE_SQL}), manifest AS ({KNOWN_SQL}),
plan AS (
    SELECT coalesce(r.file_name, m.file_name) AS file_name, r.size_bytes, r.last_modified,
           m.size_bytes AS known_size_bytes, m.last_modified AS known_last_modified,
           CASE WHEN m.file_name IS NULL THEN 'new' WHEN r.file_name IS NULL THEN 'removed'
                WHEN r.size_bytes IS DISTINCT FROM m.size_bytes OR r.last_modified IS DISTINCT FROM m.last_modified
                THEN 'changed' ELSE 'unchanged' END AS status
    FROM remote r FULL OUTER JOIN manifest m ON m.file_name = r.file_name)"""


def listing(spark, sf_dir, when):
    name = F.concat(
        F.col("o_custkey").cast("string"), F.lit("."), F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate")
    )
    return table(spark, sf_dir, "orders").filter(when).groupBy(name.alias("file_name")).agg(
        (F.sum(money("o_totalprice")) * 100).cast("bigint").alias("size_bytes"),
        F.max("o_orderdate").cast("date").cast("string").alias("last_modified"),
    )


def _plan(spark, sf_dir):
    remote = listing(spark, sf_dir, "o_orderdate >= '1996-01-01'")
    return plan_pull(remote, listing(spark, sf_dir, "o_orderdate < '2000-05-15'"))


@register("manifest_diff", f"WITH {PLAN_SQL} SELECT * FROM plan")
def manifest_diff(spark, sf_dir):
    return _plan(spark, sf_dir)


@register(
    "manifest_merge",
    f"""WITH {PLAN_SQL}
        SELECT file_name, coalesce(size_bytes, known_size_bytes) AS size_bytes,
               coalesce(last_modified, known_last_modified) AS last_modified, status IN ('new', 'changed') AS pulled_now
        FROM plan""",
)
def manifest_merge(spark, sf_dir):
    """First run into an empty manifest, second run with what changed since; the manifest is stored in between."""
    runs = {"2000-05-15": "o_orderdate < '2000-05-15'", "2001-09-01": "o_orderdate >= '1996-01-01'"}
    manifest = ensure_table(spark, work_dir(spark, "manifest"), MANIFEST_SCHEMA)
    for day, available in runs.items():
        now = F.lit(day).cast("timestamp")
        pulled = to_pull(plan_pull(listing(spark, sf_dir, available), manifest)).withColumn("ingested_at", now)
        stored = work_dir(spark, "manifest")
        merge_manifest(manifest, pulled).write.parquet(stored)
        manifest = spark.read.parquet(stored)
    return manifest.select("file_name", "size_bytes", "last_modified", (F.col("ingested_at") == now).alias("pulled_now"))


@register(
    "manifest_summary",
    f"""WITH {PLAN_SQL}
        SELECT count(*) FILTER (status <> 'removed') AS remote_file_count,
               count(*) FILTER (status = 'unchanged') AS already_current,
               count(*) FILTER (status IN ('new', 'changed') AND size_bytes <= 40000000) AS downloaded,
               count(*) FILTER (status IN ('new', 'changed') AND size_bytes > 40000000) AS failed,
               count(*) FILTER (status = 'removed') AS removed FROM plan""",
)
def manifest_summary(spark, sf_dir):
    """Files above a size limit count as failed downloads."""
    plan = _plan(spark, sf_dir)
    return run_summary(plan, plan.filter("size_bytes > 40000000").select("file_name"))


# --- contents ---
@register(
    "content_versions",
    """WITH seen AS (SELECT sha256(text) AS digest, min(doc_id) AS first_version, count(*) AS copies FROM documents GROUP BY 1)
       SELECT substring(digest, 1, 16) AS content_hash, digest, first_version, copies FROM seen
       WHERE digest NOT IN (SELECT sha256(text) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))""",
)
def content_versions_query(spark, sf_dir):
    """Distinct texts, less those of labelled documents, which are stored already."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = documents.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return content_versions(documents, "text", "doc_id", known=stored)


@register(
    "content_latest",
    """SELECT source, doc_id, substring(sha256(text), 1, 16) AS content_hash, text FROM documents d
       WHERE doc_id = (SELECT max(doc_id) FROM documents i WHERE i.source = d.source)""",
)
def content_latest_query(spark, sf_dir):
    """Each source as a file, its documents as versions."""
    return content_latest(table(spark, sf_dir, "documents"), "source", "doc_id", "text")


@register(
    "envelope_validate",
    """WITH years AS (SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS n FROM orders GROUP BY 1)
       SELECT c_custkey,
              CASE WHEN c_mktsegment = 'MACHINERY' THEN 'missing' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'not an array'
                   WHEN c_mktsegment = 'AUTOMOBILE' OR n IS NULL THEN 'empty' ELSE 'ok' END AS status,
              CAST(CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN NULL
                        WHEN c_mktsegment = 'AUTOMOBILE' THEN 0 ELSE coalesce(n, 0) END AS INTEGER) AS records
       FROM customer LEFT JOIN years ON o_custkey = c_custkey""",
)
def envelope_validate(spark, sf_dir):
    """One response per customer with a record per year; each market segment answers in its own way."""
    yearly = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("Year")
    ).agg(F.sum(money("o_totalprice")).alias("Population"))
    # a list has at most one entry per calendar year: the years were aggregated before
    lists = yearly.groupBy("c_custkey").agg(F.collect_list(F.struct("Year", "Population")).alias("data"))
    answers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(lists, "c_custkey", "left")
    data = F.coalesce("data", F.array().cast("array<struct<Year:int,Population:decimal(28,2)>>"))
    segment = F.col("c_mktsegment")
    payload = (
        F.when(segment == "MACHINERY", F.to_json(F.struct(data.alias("unexpected"))))
        .when(segment == "HOUSEHOLD", F.to_json(F.struct(F.struct(segment.alias("Year")).alias("data"))))
        .when(segment == "AUTOMOBILE", F.to_json(F.struct(F.array().cast("array<int>").alias("data"))))
        .otherwise(F.to_json(F.struct(data.alias("data"))))
    )
    return answers.select("c_custkey", payload.alias("payload")).select(
        "c_custkey", envelope_status(F.col("payload")).alias("status"), envelope_records(F.col("payload")).alias("records")
    )


@register("landing_byte_revisions", "SELECT CAST(v AS BIGINT) AS version, n AS rows FROM (SELECT count(*) AS n FROM orders), (SELECT unnest(range(1, 6)) AS v)")
def landing_byte_revisions(spark, sf_dir):
    """One file set under one name: as it was, unchanged, with another header, order and encoding, and as it was again."""
    root = work_dir(spark, "byte-revisions")
    orders = table(spark, sf_dir, "orders").select(*[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_orderdate", "o_totalprice")])
    write_delimited(orders, f"{root}/raw/plain")
    write_delimited(orders.withColumnRenamed("o_totalprice", "price"), f"{root}/raw/header")
    write_delimited(orders.orderBy(F.col("o_orderkey").cast("bigint").desc()), f"{root}/raw/order")
    orders.write.options(sep="\t", header="true", encoding="UTF-16").csv(f"{root}/raw/encoding")
    for name in ("plain", "plain", "header", "order", "encoding", "plain"):
        path = f"{root}/raw/{name}"
        rows = orders if name == "encoding" else read_delimited(spark, path)
        land_snapshot(rows, f"{root}/landed", "orders.tsv", digest=content_digest(spark, path))
    landed = spark.read.csv(f"{root}/landed/orders.tsv__*", sep="\t", header=True, schema="a STRING, b STRING, c STRING")
    version = snapshot_of(F.col("_metadata.file_path"))["version"]
    return landed.groupBy(version.alias("version")).agg(F.count(F.lit(1)).alias("rows"))
