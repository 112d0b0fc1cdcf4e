"""Site-relative boilerplate lines.

A line's frequency on a site is the number of the site's pages that contain
it divided by the site's pages.  Lines above ``max_ratio`` on at least
``min_pages`` pages are dropped from every page of that site; all other lines
stay where they are.

Lines are compared without leading and trailing white space; blank lines are
never dropped.  Pages without a site (null) form one site.  A null text stays
null, a text of boilerplate only becomes empty; repeated rows count as pages
of their own; an empty table gives an empty result.

A site's dropped lines number at most its lines per page divided by
``max_ratio``, so they travel as one array per site and the texts are neither
exploded nor shuffled to apply them when the sites fit a broadcast.  Lines are
identified by their 64-bit hash within their site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import SPACES, save, spread_join, whole_rows

MAX_RATIO = 0.1
MIN_PAGES = 5


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _key(line: Column) -> Column:
    return F.xxhash64(_bare(line))


def boilerplate_lines(docs: DataFrame, site_col: str, text_col: str,
                      max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, lines): the hashes of each site's boilerplate lines; sites without any are absent."""
    pages = docs.select(F.col(f"`{site_col}`").alias("site"), F.col(f"`{text_col}`").alias("text"))
    sites = pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    filled = F.filter(F.split("text", "\n", -1), lambda x: _bare(x) != "")
    lines = pages.select("site", F.explode(F.array_distinct(F.transform(filled, _key))).alias("line"))
    frequent = lines.groupBy("site", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    return (spread_join(frequent, sites, F.col("r.site").eqNullSafe(F.col("g.site")))
            .filter(F.col("n") > F.col("pages") * F.lit(float(max_ratio)))
            .groupBy("r.site").agg(F.sort_array(F.collect_list("line")).alias("lines")))


def drop_boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                     counts: bool = False) -> DataFrame:
    """The input with boilerplate lines removed from the text column; with
    ``counts`` also n_lines (non-blank lines before) and n_removed."""
    found = save(boilerplate_lines(docs, site_col, text_col, max_ratio, min_pages), "boilerplate")
    text = F.col(f"r.row.`{text_col}`")
    lines = F.split(text, "\n", -1)
    dropped = lambda x: (_bare(x) != "") & F.array_contains(F.col("g.lines"), _key(x))
    kept = F.when(F.col("g.lines").isNull(), text).otherwise(
        F.array_join(F.filter(lines, lambda x: ~dropped(x)), "\n"))
    more = [F.coalesce(F.size(F.filter(lines, lambda x: _bare(x) != "")), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.when(F.col("g.lines").isNull() | text.isNull(), 0)
                       .otherwise(F.size(F.filter(lines, dropped))), F.lit(0)).cast("long").alias("n_removed")]
    joined = spread_join(whole_rows(docs), found, F.col(f"r.row.`{site_col}`").eqNullSafe(F.col("g.site")), "left")
    return joined.select(*[kept.alias(c) if c == text_col else F.col(f"r.row.`{c}`") for c in docs.columns],
                         *(more if counts else []))


def op5_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_boilerplate(docs, counts=True).select("doc_id", "n_lines", "n_removed", "text")


OP5_SQL = f"""
WITH pages AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
bare AS (
  SELECT DISTINCT p.doc_id, p.source, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
  FROM pages p, unnest(p.lines) AS u(l)),
sites AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
boiler AS (
  SELECT b.source, list(b.line) AS drop_lines FROM (
    SELECT source, line, count(*) AS n FROM bare WHERE line <> '' GROUP BY source, line) b
  JOIN sites s ON b.source IS NOT DISTINCT FROM s.source
  WHERE b.n >= {MIN_PAGES} AND b.n > s.pages * {MAX_RATIO} GROUP BY b.source),
cut AS (
  SELECT p.doc_id, p.text, p.lines, b.drop_lines,
         list_filter(p.lines, lambda x: NOT coalesce(list_contains(b.drop_lines,
           trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), false)) AS kept
  FROM pages p LEFT JOIN boiler b ON p.source IS NOT DISTINCT FROM b.source)
SELECT doc_id,
       CAST(coalesce(len(list_filter(lines, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '')), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_removed,
       CASE WHEN drop_lines IS NULL THEN text ELSE array_to_string(kept, chr(10)) END AS text
FROM cut
"""
