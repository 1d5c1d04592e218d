"""HTML page extraction (S18-S20) with regular expressions evaluated inside Spark.

Whole pages are processed (no prefixes); each extractor returns an array per page that the
caller explodes, so a page is handled by whichever task holds it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: patterns of the page markup
HREF_RE = r'href="([^"]*)"'
LIST_ROW_RE = r'<li><a href="([^"]*)">([^<]*)</a></li>'
SCRIPT_VAR_RE = r"\b(?:var|let|const)\s+(\w+)\s*=\s*"
TABLE_ROW_RE = r"(?is)<tr\b[^>]*>(.*?)(?=</tr>|<tr\b|</table>|$)"
TABLE_CELL_RE = r"(?is)<t([dh])\b[^>]*>(.*?)(?=</t[dh]>|<t[dh]\b|$)"
TAG_RE = r"<[^>]*>"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}
TRACK_RE = r"track\((\d+)\)"


def links(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Distinct links per page in first-occurrence order (position of first appearance)."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(HREF_RE), 1)
    ex = df.select(id_col, F.posexplode(hrefs).alias("pos", "href"))
    return ex.groupBy(id_col, "href").agg(F.min("pos").alias("first_pos"))


def _assignments():
    """A pandas function: for each page the assigned names and the JSON text that follows (null if it is not JSON)."""
    pattern = SCRIPT_VAR_RE

    def scan(pages: pd.Series) -> pd.Series:
        import json
        import re

        decoder, found = json.JSONDecoder(), []
        for html in pages:
            rows, at = [], 0
            while html and (m := re.compile(pattern).search(html, at)):
                at = m.end()
                try:  # the decoder follows nesting and strings to the value's own end
                    _, end = decoder.raw_decode(html, at)
                    rows.append({"name": m[1], "json": html[at:end]})
                    at = end
                except (ValueError, RecursionError):
                    rows.append({"name": m[1], "json": None})
            found.append(rows)
        return pd.Series(found, dtype=object)

    return F.pandas_udf(scan, "array<struct<name:string,json:string>>")


def script_values(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, pos, name, json) of every ``var|let|const <name> = <value>`` in a page; ``json`` is the whole value, objects and arrays included."""
    return df.select(id_col, F.posexplode(_assignments()(F.col(html_col))).alias("pos", "v")).select(id_col, "pos", "v.name", "v.json")


def script_vars(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """The assignments with their value as text (strings without quotes) and the page's ``track(N)`` id."""
    track = F.regexp_extract(F.col(html_col), TRACK_RE, 1).try_cast("long").alias("track_id")
    z = df.select(id_col, F.posexplode(_assignments()(F.col(html_col))).alias("pos", "v"), track)
    value = F.get_json_object(F.concat(F.lit('{"v":'), F.col("v.json"), F.lit("}")), "$.v")
    return z.select(id_col, "pos", F.col("v.name").alias("name"), value.alias("value"), "track_id")


def embedded_rows(df: DataFrame, id_col: str, html_col: str, name: str, schema: str) -> DataFrame:
    """The rows of the array (or one object) assigned to ``name``: (id, element, the fields of ``schema``).  Elements that are no objects go."""
    v = script_values(df, id_col, html_col).where(F.col("name") == name).withColumn("json", F.ltrim("json"))
    listed = F.when(F.col("json").startswith("["), F.col("json")).when(F.col("json").startswith("{"), F.concat(F.lit("["), F.col("json"), F.lit("]")))
    texts = F.from_json(listed, "array<string>")
    rows = v.select(id_col, F.posexplode(texts).alias("element", "text")).where(F.col("text").startswith("{"))
    return rows.select(id_col, "element", F.from_json("text", schema).alias("r")).select(id_col, "element", "r.*")


def table_rows(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, row, header, cells, links) of every table row of a page: the cells' text without markup and the row's links, in order.

    ``header``: the row has header cells only.
    """
    rows = df.select(id_col, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(TABLE_ROW_RE), F.lit(1))).alias("row", "tr"))
    plain = lambda c: _unescaped(F.trim(F.regexp_replace(F.regexp_replace(c, TAG_RE, " "), r"[\s\u00A0]+", " ")))
    cells = F.transform(F.regexp_extract_all("tr", F.lit(TABLE_CELL_RE), F.lit(2)), plain)
    kinds = F.transform(F.regexp_extract_all("tr", F.lit(TABLE_CELL_RE), F.lit(1)), F.lower)
    return rows.select(id_col, "row", (F.size(kinds) > 0) & F.forall(kinds, lambda k: k == "h"), cells.alias("cells"), F.regexp_extract_all("tr", F.lit(HREF_RE), F.lit(1)).alias("links")).toDF(id_col, "row", "header", "cells", "links")


def _unescaped(text: Column) -> Column:
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def list_rows(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Listing rows (link + label) from list markup, with their position on the page."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(LIST_ROW_RE), 1)
    labels = F.regexp_extract_all(F.col(html_col), F.lit(LIST_ROW_RE), 2)
    z = df.select(id_col, F.posexplode(F.arrays_zip(hrefs.alias("href"), labels.alias("label"))).alias("pos", "r"))
    return z.select(id_col, "pos", "r.href", "r.label")


def page_lang(html: str | Column) -> Column:
    c = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract(c, r'<html lang="([^"]*)"', 1)
