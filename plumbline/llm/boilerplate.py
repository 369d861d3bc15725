"""Line dedup by how many pages of a site hold a line, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import quoted, store

#: A line on more than this share of a site's pages, and on so many at least, is boilerplate.
MOST_SHARE = 0.1
LEAST_PAGES = 3
#: A site with more than this share of all pages is dealt to several tasks.
HOT_SHARE = 0.001
#: Markup that separates lines, and addresses whose first group is the host. Fixed patterns, also valid in SQL.
MARKUP = r"(?is)<(?:script[^>]*>.*?</script>|style[^>]*>.*?</style>|!--.*?-->|[^>]*>)"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"
#: Runs of blanks that are more than one space.
BLANKS = r"[ \t\r\f\x0B]{2,}|[\t\r\f\x0B]"


def page_text(html: Column) -> Column:
    """The text of a page, one line per stretch without markup."""
    return F.regexp_replace(html, MARKUP, "\n")


def host_of(url: Column) -> Column:
    """Host of an address; empty without one, also for null."""
    return F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))


def normalised_lines(text: Column) -> Column:
    """The lines of a text with their blanks made single, none at their ends; null has no lines."""
    lines = F.transform(F.split(F.regexp_replace(text, BLANKS, " "), "\n"), lambda line: F.trim(line))
    return F.coalesce(lines, F.array().cast("array<string>"))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def drop_boilerplate(pages: DataFrame, site: Column, text: Column, name: str = "text",
                     most_share: float = MOST_SHARE, least_pages: int = LEAST_PAGES, copies_once: bool = False) -> DataFrame:
    """The pages with ``name`` set to the text without boilerplate, ``n_lines`` and ``n_dropped``.

    A line is boilerplate of a site if more than ``most_share`` of the site's pages, and at least
    ``least_pages``, hold it. Lines compare by their digests, blanks made single; lines of blanks
    are neither counted nor dropped, and kept lines stay as they are. ``dropped`` lists the
    numbers of the dropped lines, from 1.

    Pages are counted per site and digest with partial sums in the map tasks. A page's lines are
    looked up in the lines of its site alone: at most ``lines of a usual page / most_share``
    of them. Sites with over ``HOT_SHARE`` of all pages, of which there are at most ``1 / HOT_SHARE``, are
    broadcast with the number of parts that each one's pages are dealt to.

    With ``copies_once`` pages of a site with one text count as one page, so that copies of a text do not
    make its lines boilerplate.

    A null text has no lines and stays null; a null site is a site of its own. Repeated rows are
    pages each, unless ``copies_once``. An empty table gives no rows. Columns with a result's name are replaced.
    """
    spark = pages.sparkSession
    results = {name.lower(), "n_lines", "n_dropped", "dropped"}
    kept = [c for c in pages.columns if c.lower() not in results]
    rows = pages.select(site.cast("string").alias("_site"), text.cast("string").alias("_text"),
                        F.struct(*[quoted(c) for c in kept]).alias("_row") if kept
                        else F.struct(F.lit(0).alias("_none")).alias("_row"))
    filled = F.array_distinct(F.filter(normalised_lines(F.col("_text")), lambda line: line != ""))
    digests = F.transform(filled, _digest)
    sites = store(rows.groupBy("_site").agg(F.count("*").alias("_pages")).withColumnRenamed("_site", "_of"), "sites")
    voters = rows
    if copies_once:
        # one text per site and digest; the digests are combined in the map tasks, so hot texts are not gathered
        voters = store(rows.groupBy("_site", F.md5("_text").alias("_of_text")).agg(F.first("_text").alias("_text")), "voters")
    votes = sites if not copies_once else store(
        voters.groupBy("_site").agg(F.count("*").alias("_pages")).withColumnRenamed("_site", "_of"), "votes")
    counts = (voters.select("_site", F.explode(digests).alias("_digest")).groupBy("_site", "_digest").count()
              .where(F.col("count") >= least_pages))
    # a hot site's pages are dealt by its share of all pages, to four parts per task
    total = max(1, sites.agg(F.sum("_pages")).first()[0] or 0)
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(sites.where(F.col("_pages") > total * HOT_SHARE).select(
        F.col("_of").alias("_hot"), F.ceil(F.col("_pages") / total * tasks).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    common = (counts.join(votes, F.col("_site").eqNullSafe(F.col("_of")))
              .where(F.col("count") > F.col("_pages") * most_share)
              .groupBy("_site").agg(F.collect_list("_digest").alias("_common"))
              .join(hot, F.col("_site").eqNullSafe(F.col("_hot")), "left")
              .select(F.col("_site").alias("_of"), "_common", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_of_part")))
    rows = rows.join(hot, F.col("_site").eqNullSafe(F.col("_hot")), "left")
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("_text", "_row"), parts).cast("int"))
    rows = rows.join(common, F.col("_site").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_of_part")), "left")
    lines = F.coalesce(F.split("_text", "\n"), F.array().cast("array<string>"))
    found = F.when(F.col("_common").isNotNull(), F.array_intersect(digests, F.col("_common")))
    rows = rows.withColumn("_found", F.coalesce(found, F.array().cast("array<binary>")))
    numbered = F.zip_with(lines, F.transform(normalised_lines(F.col("_text")), lambda line, i: F.struct(
        i.alias("i"), ((line != "") & F.array_contains(F.col("_found"), _digest(line))).alias("gone"))),
        lambda line, at: F.struct(line.alias("line"), at["i"].alias("i"), at["gone"].alias("gone")))
    rows = rows.withColumn("_lines", F.when(F.size("_found") > 0, numbered))
    seen = F.filter(lines, lambda line: line.rlike("[^ \\t\\r\\f\\x0B]"))
    stays = F.transform(F.filter("_lines", lambda x: ~x["gone"]), lambda x: x["line"])
    gone = F.transform(F.filter("_lines", lambda x: x["gone"]), lambda x: (x["i"] + 1).cast("int"))
    none = F.array().cast("array<int>")
    return rows.select(*[F.col("_row")[c].alias(c) for c in kept],
                       F.when(F.col("_lines").isNull(), F.col("_text")).otherwise(F.array_join(stays, "\n")).alias(name),
                       F.size(seen).cast("long").alias("n_lines"),
                       F.size(F.coalesce(gone, none)).cast("long").alias("n_dropped"),
                       F.coalesce(gone, none).alias("dropped"))
