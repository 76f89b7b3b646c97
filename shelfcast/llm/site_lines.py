"""Line dedup by site-relative frequency: a line that stands on a large share of a host's pages is boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import small_enough, stored

#: Documents of a host that meet its lines in one group; a larger host's are dealt to as many groups as they need.
AT_ONCE = 256
#: Tags that do not end a line.
INLINE = r"(?i)</?(?:a|b|i|em|strong|span|u|small)(?:\s[^>]*)?>"
#: Elements whose content is no text, and comments.
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"


def html_lines(html: Column) -> Column:
    """The text of a page with one line per block element."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(html, HIDDEN, "\n"), INLINE, ""), r"<[^>]*>", "\n")


def _lines(text: Column) -> Column:
    """Trimmed lines that are not empty."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def site_boilerplate(docs: DataFrame, totals: DataFrame, ratio: float = 0.2, min_pages: int = 3) -> DataFrame:
    """host, pages (from totals) and the hashes of its boilerplate lines.

    A line counts once per document. It is boilerplate if it stands on `min_pages` documents of the host or more and on more than
    `ratio` of them, so a host has at most (distinct lines per document) / ratio of them and the array is bounded. Hashes are
    counted, not texts; the counts of a hot host or line are summed in every task before they are moved.
    """
    seen = docs.select("host", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), lambda x: F.xxhash64(x)))).alias("line"))
    counts = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    return counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages")).groupBy("host", "pages").agg(F.collect_list("line").alias("boilerplate"))


def drop_boilerplate(docs: DataFrame, ratio: float = 0.2, min_pages: int = 3) -> DataFrame:
    """Documents (doc_id, host, text) without the boilerplate lines of their host: doc_id, host, text, n_lines, n_dropped.

    Lines are trimmed and empty ones go. A null or empty text has no line and stays, as an empty text; null hosts form one host of
    their own; every copy of a repeated row counts as a document; other columns are not read.
    """
    keyed = docs.select("doc_id", F.coalesce("host", F.lit("")).alias("host"), "text")
    totals = stored(keyed.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "host-pages")
    groups = F.ceil(F.col("pages") / F.lit(AT_ONCE)).cast("int")
    known = site_boilerplate(keyed, totals, ratio, min_pages).withColumn("salt", F.explode(F.sequence(F.lit(0), groups - 1))).drop("pages")
    # Only large hosts are split: at most one in AT_ONCE documents has a row here.
    large = totals.where(groups > 1).select("host", groups.alias("groups"))
    spread = keyed.join(small_enough(large, 256), "host", "left")
    salted = spread.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id", "text"), F.col("groups")).cast("int"), F.lit(0)))
    joined = salted.join(known, ["host", "salt"], "left").select("doc_id", "host", _lines(F.col("text")).alias("lines"), "boilerplate")
    kept = F.when(F.col("boilerplate").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("boilerplate"), F.xxhash64(x))))
    cleaned = joined.select("doc_id", "host", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    return cleaned.select("doc_id", "host", F.array_join("kept", "\n").alias("text"), "n_lines", (F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"))
