"""Line dedup by site-relative frequency: lines on too large a share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import text_key

MAX_RATIO = 0.1
MIN_PAGES = 3
#: Parts into which the pages of a host are dealt when its boilerplate list is joined to them.
SALTS = 16


def url_host(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and a leading ``www.``; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def _line_hashes(text: Column) -> Column:
    """64-bit hash of each line without outer white space; a blank line has none (null)."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.when(F.regexp_like(x, F.lit("\\S")), F.xxhash64(F.trim(x))))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(_host, lines): hashes of the lines on more than ``max_ratio`` of a host's pages, and on ``min_pages`` at least.

    A page is a distinct text of its host, so that mirrored copies don't turn their own text into boilerplate. A host's
    list is no longer than its mean number of lines a page / max_ratio, whatever its number of pages.
    """
    pages = docs.select(F.col(host).alias("_host"), text_key(F.col(text)).alias("_key"), F.array_distinct(F.array_compact(_line_hashes(F.col(text)))).alias("_lines"))
    pages = pages.groupBy("_host", "_key").agg(F.first("_lines").alias("_lines"))
    # The page total travels as one more line (null) through the same counts.
    found = pages.select("_host", F.explode(F.concat("_lines", F.array(F.lit(None).cast("long")))).alias("_line")).groupBy("_host", "_line").count()
    per_host = found.groupBy("_host").agg(F.max(F.when(F.col("_line").isNull(), F.col("count"))).alias("_pages"))
    hits = found.where((F.col("count") >= min_pages) & F.col("_line").isNotNull()).alias("f").join(per_host.alias("p"), F.col("f._host").eqNullSafe(F.col("p._host")))
    return hits.where(F.col("count") > max_ratio * F.col("_pages")).groupBy(F.col("f._host").alias("_host")).agg(F.sort_array(F.collect_set("_line")).alias("lines"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and n_lines, n_dropped: every row stays, with all its columns.

    Lines are split at \\n; blank lines always stay. A null host is a host of its own; null text stays null with no lines;
    repeated rows are one page and are all cut alike. Pages of a hot host are dealt over SALTS parts for the join.
    """
    lists = boilerplate(docs, host, text, max_ratio, min_pages)
    lists = lists.select("_host", "lines", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(host).alias("_host"), F.pmod(F.xxhash64(F.col(text)), F.lit(SALTS)).cast("int").alias("_salt"), F.col(text).alias("_text"))
    both = rows.alias("r").join(lists.alias("l"), F.col("r._host").eqNullSafe(F.col("l._host")) & (F.col("r._salt") == F.col("l._salt")), "left")
    out = both.select("_row", "_text", F.split("_text", "\n").alias("_split"), _line_hashes(F.col("_text")).alias("_hashes"), F.col("lines").alias("_drop"))
    out = out.withColumn("_kept", F.expr("CASE WHEN _drop IS NULL THEN _split ELSE filter(_split, (x, i) -> NOT coalesce(array_contains(_drop, _hashes[i]), false)) END"))
    new = {text: F.when(F.col("_text").isNotNull(), F.array_join("_kept", "\n"))}
    return out.select(
        *(new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns),
        F.when(F.col("_text").isNull(), F.lit(0)).otherwise(F.size(F.array_compact("_hashes"))).cast("long").alias("n_lines"),
        F.when(F.col("_text").isNull(), F.lit(0)).otherwise(F.size("_split") - F.size("_kept")).cast("long").alias("n_dropped"),
    )
