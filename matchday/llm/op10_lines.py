"""Operator 10, line dedup by site-relative frequency.

Pages are grouped by host.  For each line the number of the host's pages
that contain it is divided by the host's page total; lines above the
boilerplate ratio are dropped from the pages of that host.

A page has one hash per line (null: a blank line).  Counting needs hosts and
hashes only, dropping looks a line up by its place.  Texts are read twice, not
written; a caller that makes them at some cost writes them first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import keep

#: a line on more than this share of its host's pages is boilerplate
RATIO = 0.1
#: ... if it is on at least so many of them: a line on one page repeats nothing
MIN_PAGES = 2

#: over all sites, a line of more than so many words is repeated ...
LONG_WORDS = 50
#: ... if so many different texts contain it
LONG_TEXTS = 10

#: ends of blocks in HTML, each of which ends a line
BLOCK_END = r"(?i)<(?:br|hr)\s*/?>|</(?:p|div|li|ul|ol|h[1-6]|title|tr|td|th|table|section|article|nav|header|footer|blockquote|pre)>"
#: what holds no visible text
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
TAG = r"<[^>]*>"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """Visible text of a page, one block to a line."""
    text = F.regexp_replace(html, HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK_END, "\n"), TAG, "")
    return text


def line_key(line: Column) -> Column:
    """What makes two lines equal: the line without white space around it and
    with single spaces inside."""
    return F.trim(F.regexp_replace(line, r"[ \t\r\x0B\f]+", " "))


def line_hashes(text: Column) -> Column:
    """Per line of a text the hash of its key, null for a blank line."""

    def hashes(key) -> Column:
        def one(line: Column) -> Column:
            k = key(line)
            return F.nullif(F.xxhash64(k), F.xxhash64(F.lit("")))

        return F.transform(F.split(text, "\n"), one)

    # a regular expression per line only where the page has anything for it to change
    odd = F.contains(text, F.lit("  "))
    for c in "\t\r\x0b\f":
        odd = odd | F.contains(text, F.lit(c))
    return F.when(odd, hashes(line_key)).otherwise(hashes(F.trim))


def taken_apart(pages: DataFrame, host: Column, text_col: str) -> DataFrame:
    """``pages`` as (_host, _text, _row, _keys)."""
    rows = pages.select(
        host.alias("_host"), F.col(text_col).cast("string").alias("_text"),
        F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != text_col], F.lit(0).alias("_")).alias("_row"),
    )
    return rows.withColumn("_keys", line_hashes(F.col("_text")))


def boilerplate_lines(rows: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_hashes): per host the hashes of its boilerplate lines, of
    pages that are :func:`taken_apart`.

    A page counts a line once.  The list of a host is shorter than the mean
    number of different lines on its pages divided by ``ratio``, whatever the
    number of pages.
    """
    base = rows.select(F.col("_host").alias("host"), "_keys")
    totals = base.groupBy("host").agg(F.count("*").alias("pages"))
    each = base.select("host", F.explode(F.array_distinct(F.array_compact("_keys"))).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = totals.select(F.col("host").alias("_host"), "pages")
    frequent = counts.join(totals, F.col("host").eqNullSafe(F.col("_host"))).where(F.col("n") > F.col("pages") * ratio)
    # partial lists, then their union: no task sees more than the bounded list of a host
    return frequent.groupBy("host").agg(F.sort_array(F.collect_set("line")).alias("line_hashes"))


def drop_boilerplate(
    pages: DataFrame,
    host_col: str,
    text_col: str,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    keep_whole: bool = True,
) -> DataFrame:
    """``pages`` with ``text_col`` less the boilerplate lines of its host, and
    columns ``n_lines`` and ``n_dropped`` (lines that are not blank) and
    ``all_boilerplate``.

    Other lines, blank ones included, stay as they are.  A page of which no
    line would be left keeps its text if ``keep_whole`` (a page that was
    copied often is a matter for de-duplication of documents); the column
    ``all_boilerplate`` marks such pages either way.  Null text stays null
    with no lines; pages without a host (null) are a site of their own;
    copies of a page count as pages; an empty table gives an empty one.
    Further columns are passed through; input columns called ``n_lines``,
    ``n_dropped`` or ``all_boilerplate`` are replaced.
    """
    rows = taken_apart(pages, F.col(host_col), text_col)
    # written: the planner then knows how small the lists are, and broadcasts
    # them only below spark.sql.autoBroadcastJoinThreshold
    marked = keep(boilerplate_lines(rows, ratio, min_pages), "lines")
    return _without(rows, pages.columns, marked, text_col, keep_whole)


def repeated_passages(rows: DataFrame, words: int = LONG_WORDS, texts: int = LONG_TEXTS) -> DataFrame:
    """(host, line_hashes): per text, named by its hash (the host of rows
    :func:`taken_apart`), the hashes of its lines of more than ``words``
    words that ``texts`` different texts contain.

    All pages are one site, with an absolute limit; copies of a text count
    once.  The list of a text is no longer than the text, whatever the corpus.
    """
    # a line of so many words has more characters than twice as many
    lines = F.filter(
        F.arrays_zip(F.split("_text", "\n").alias("line"), F.col("_keys").alias("key")),
        lambda x: F.when(F.length(x["line"]) > 2 * words, F.size(F.split(line_key(x["line"]), " ")) > words).otherwise(F.lit(False)),
    )
    each = rows.select(F.col("_host").alias("host"), F.explode(F.transform(lines, lambda x: x["key"])).alias("line"))
    each = keep(each.distinct(), "lines")
    often = keep(each.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= texts).select("line"), "lines")
    return each.join(often, "line").groupBy("host").agg(F.sort_array(F.collect_set("line")).alias("line_hashes"))


def drop_passages(
    pages: DataFrame, text_col: str, words: int = LONG_WORDS, texts: int = LONG_TEXTS, keep_whole: bool = True
) -> DataFrame:
    """``pages`` with ``text_col`` less its :func:`repeated_passages`; columns
    and odd cases as in :func:`drop_boilerplate`."""
    rows = taken_apart(pages, F.xxhash64(F.col(text_col).cast("string")), text_col)
    marked = keep(repeated_passages(rows, words, texts), "lines")
    return _without(rows, pages.columns, marked, text_col, keep_whole)


def _without(rows: DataFrame, columns: list[str], marked: DataFrame, text_col: str, keep_whole: bool) -> DataFrame:
    """The pages of ``rows`` less the lines that ``marked`` (host, line_hashes) lists for their host."""
    marked = marked.select(F.col("host").alias("_at"), F.col("line_hashes").alias("_drop"))
    rows = rows.join(marked, F.col("_host").eqNullSafe(F.col("_at")), "left")
    solid = F.coalesce(F.size(F.array_compact("_keys")), F.lit(0))
    # how many lines go, from the hashes alone; texts are cut only where any do
    goes = F.filter("_keys", lambda k: k.isNotNull() & F.array_contains(F.col("_drop"), k))
    rows = rows.withColumn("_solid", solid)
    rows = rows.withColumn("_gone", F.coalesce(F.when(F.col("_drop").isNotNull(), F.size(goes)), F.lit(0)))
    every = (F.col("_gone") > 0) & (F.col("_gone") >= F.col("_solid"))
    whole = (F.col("_gone") == 0) | (every if keep_whole else F.lit(False))
    left = F.filter(
        F.split("_text", "\n"),
        lambda x, i: F.get("_keys", i).isNull() | ~F.array_contains(F.col("_drop"), F.get("_keys", i)),
    )
    out = F.when(whole, F.col("_text")).otherwise(F.array_join(left, "\n"))
    made = ("n_lines", "n_dropped", "all_boilerplate")
    return rows.select(
        *[out.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in columns if c not in made],
        F.col("_solid").cast("long").alias("n_lines"),
        F.when(whole, F.lit(0)).otherwise(F.col("_gone")).cast("long").alias("n_dropped"),
        every.alias("all_boilerplate"),
    )
