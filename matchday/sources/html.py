"""Tabular data out of HTML pages stored as rows of a ``pages`` table.

Two paths with the same output schema:

* :func:`extract_list_items` - regular markup, pure column expressions
  (``regexp_extract_all`` + ``posexplode``), stays in whole-stage codegen;
* :func:`extract_list_items_parsed` - irregular markup, the stdlib
  ``html.parser`` per page inside ``mapInPandas`` (Arrow batches; each page
  is parsed where it lives, nothing goes through the driver).
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.functions.names import split_person_name
from matchday.functions.text import clean_cell

# --- fixed values (markup patterns of the list pages) ----------------------
LIST_PATTERN = r"(?s)<ul>(.*?)</ul>"
ITEM_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a></li>'
TEAM_LISTS = 20         # team lists of a marks page (pass as ``max_lists`` for those pages)
# ---------------------------------------------------------------------------

ITEM_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("list_pos", T.IntegerType()),
        T.StructField("item_pos", T.IntegerType()),
        T.StructField("href", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def _finish(items: DataFrame) -> DataFrame:
    name, surname = split_person_name(F.col("text"))
    return items.select(
        "page_id", "list_pos", "item_pos", "href", "text",
        name.alias("name"), surname.alias("surname"), clean_cell(F.col("text")).alias("value"),
    )


def extract_list_items(
    pages: DataFrame,
    html: str = "html",
    max_lists: int | None = None,
    skip_header: int = 0,
) -> DataFrame:
    """One row per list item: page, list position, item position, link
    target and text, name/surname split of the text and the text read as a
    number (``-`` or non-numeric -> NULL).  All lists of a page, or the first
    ``max_lists``, without the first ``skip_header`` items of each."""
    lists = pages.select(
        "page_id",
        F.posexplode(F.regexp_extract_all(F.col(html), F.lit(LIST_PATTERN), 1)).alias("list_pos", "body"),
    )
    if max_lists is not None:
        lists = lists.filter(F.col("list_pos") < max_lists)
    pairs = F.arrays_zip(
        F.regexp_extract_all("body", F.lit(ITEM_PATTERN), 1).alias("href"),
        F.regexp_extract_all("body", F.lit(ITEM_PATTERN), 2).alias("text"),
    )
    items = lists.select(
        "page_id", F.col("list_pos").cast("int").alias("list_pos"),
        F.posexplode(pairs).alias("item_pos", "it"),
    ).filter(F.col("item_pos") >= skip_header)
    return _finish(
        items.select(
            "page_id", "list_pos", (F.col("item_pos") - skip_header).cast("int").alias("item_pos"),
            F.col("it.href").alias("href"), F.col("it.text").alias("text"),
        )
    )


class _ListItems(HTMLParser):
    """Collects (list_pos, item_pos, href, text) of ``ul > li > a`` links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.rows: list[tuple[int, int, str, str]] = []
        self._list = -1
        self._item = -1
        self._depth = 0
        self._href: str | None = None
        self._text: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "ul":
            self._depth += 1
            if self._depth == 1:
                self._list += 1
                self._item = -1
        elif tag == "a" and self._depth:
            self._href = dict(attrs).get("href", "")
            self._text = []

    def handle_endtag(self, tag):
        if tag == "ul" and self._depth:
            self._depth -= 1
        elif tag == "a" and self._href is not None:
            self._item += 1
            self.rows.append((self._list, self._item, self._href, "".join(self._text)))
            self._href = None

    def handle_data(self, data):
        if self._href is not None:
            self._text.append(data)

    def handle_entityref(self, name):
        if self._href is not None:
            self._text.append(f"&{name};")

    def handle_charref(self, name):
        if self._href is not None:
            self._text.append(f"&#{name};")


def _parse_batches(batches, max_lists, skip_header):
    for pdf in batches:
        out = []
        for pid, doc in zip(pdf["page_id"], pdf["html"]):
            if doc is None:
                continue
            p = _ListItems()
            p.feed(doc)
            for lp, ip, href, text in p.rows:
                if (max_lists is None or lp < max_lists) and ip >= skip_header:
                    out.append((pid, lp, ip - skip_header, href, text))
        yield pd.DataFrame(out, columns=[f.name for f in ITEM_SCHEMA.fields]).astype(
            {"page_id": "int64", "list_pos": "int32", "item_pos": "int32"}
        )


def extract_list_items_parsed(
    pages: DataFrame,
    html: str = "html",
    max_lists: int | None = None,
    skip_header: int = 0,
) -> DataFrame:
    """Same output as :func:`extract_list_items` for markup a pattern cannot
    follow (nested tags inside links, attributes in any order)."""
    src = pages.select("page_id", F.col(html).alias("html"))
    items = src.mapInPandas(lambda it: _parse_batches(it, max_lists, skip_header), ITEM_SCHEMA)
    return _finish(items)


# --- marks pages -----------------------------------------------------------------
# fixed values: classes of the elements and the two layouts of a player's link
LIST_CLASS, TEAM_CLASS, PLAYER_CLASS, ROLE_CLASS, CELL_CLASS = (
    "magicTeamList", "teamNameIn", "playerNameIn", "playerRole", "inParameter"
)
PLAYER_LINKS = (
    # (prefix, path segment, separator, trailing parts that are no name)
    ("https://www.gazzetta.it/calcio/giocatori/", 0, "-", 0),
    ("https://www.gazzetta.it/calcio/fantanews/statistiche/", 1, "_", 1),
)
MARK_CELLS = (
    "voto", "gol", "assist", "rigore", "rig_sbagliato", "autogol", "ammonizione", "espulsione", "fantavoto"
)
# ---------------------------------------------------------------------------------


class _MarksPage(HTMLParser):
    """One (list, item, team, link, role, cells) per list item of a marks page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self._list = self._item = -1
        self._lists = self._depth = 0
        self._team: str | None = None
        self._row: list | None = None
        self._in: list[tuple[str, str]] = []     # open elements whose text is wanted: (tag, what)
        self._text: list[str] = []

    def _wants(self, what: str, tag: str) -> None:
        self._in.append((tag, what))
        self._text = []

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        classes = (at.get("class") or "").split()
        if tag == "ul" and LIST_CLASS in classes:
            self._lists += 1
            self._list, self._item, self._team, self._depth = self._list + 1, -1, None, 1
        elif not self._depth:
            return
        elif tag == "ul":
            self._depth += 1
        elif tag == "li":
            self._item += 1
            self._row = [self._list, self._item, self._team, None, None, []]
            self.rows.append(self._row)
        elif tag == "span" and TEAM_CLASS in classes:
            self._wants("team", tag)
        elif tag == "span" and PLAYER_CLASS in classes:
            self._in.append((tag, "player"))
        elif tag == "a" and any(w == "player" for _, w in self._in) and self._row is not None and self._row[3] is None:
            self._row[3] = at.get("href")
        elif tag == "span" and ROLE_CLASS in classes:
            self._wants("role", tag)
        elif classes[:1] == [CELL_CLASS]:
            self._wants("cell", tag)

    def handle_endtag(self, tag):
        if tag == "ul" and self._depth:
            self._depth -= 1
        elif self._in and self._in[-1][0] == tag:
            _, what = self._in.pop()
            text = "".join(self._text)
            if what == "team":
                self._team = text
                if self._row is not None and self._row[2] is None:
                    self._row[2] = text
            elif what == "role" and self._row is not None:
                self._row[4] = text
            elif what == "cell" and self._row is not None:
                self._row[5].append(text)

    def handle_data(self, data):
        if self._in:
            self._text.append(data)


_MARK_ROW = "page_id long, list_pos int, item_pos int, team string, href string, role string, cells array<string>"


def _marks_batches(batches):
    names = ["page_id", "list_pos", "item_pos", "team", "href", "role", "cells"]
    for pdf in batches:
        out = []
        for pid, doc in zip(pdf["page_id"], pdf["html"]):
            if doc is not None:
                page = _MarksPage()
                page.feed(doc)
                out += [[pid, *r] for r in page.rows]
        yield pd.DataFrame(out, columns=names).astype({"page_id": "int64", "list_pos": "int32", "item_pos": "int32"})


def extract_marks(pages: DataFrame, html: str = "html", max_lists: int | None = TEAM_LISTS, skip_header: int = 1) -> DataFrame:
    """Players' marks out of marks pages: team, name, surname, role and nine
    numeric cells per list item after the list's header (``-`` is NULL).

    The name comes from the player's link, in either of its layouts; a page
    has at most ``max_lists`` team lists (None: all are read)."""
    src = pages.select("page_id", F.col(html).alias("html"))
    rows = src.mapInPandas(_marks_batches, _MARK_ROW)
    rows = rows.filter(F.col("item_pos") >= skip_header)
    if max_lists is not None:
        rows = rows.filter(F.col("list_pos") < max_lists)
    words = F.lit(None).cast("array<string>")
    for prefix, segment, mark, tail in reversed(PLAYER_LINKS):
        path = F.split(F.replace(F.col("href"), F.lit(prefix), F.lit("")), "/")
        parts = F.split(F.get(path, F.lit(segment)), mark)
        parts = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - tail, F.lit(0)))
        words = F.when(F.contains(F.col("href"), F.lit(prefix)), parts).otherwise(words)
    rows = rows.withColumn("_w", words)
    first = F.get("_w", F.lit(0))
    rest = F.array_join(F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1))), " ")
    one = F.size("_w") <= 1
    return rows.select(
        "page_id", "list_pos", "item_pos", "team",
        F.when(one, F.lit("")).otherwise(first).alias("name"),
        F.when(one, first).otherwise(rest).alias("surname"),
        "role",
        *[clean_cell(F.get("cells", F.lit(i))).alias(c) for i, c in enumerate(MARK_CELLS)],
    )
