"""Column functions and row generators over raw HTML.

Pages are parsed with JVM regular expressions so that a scan of raw pages stays
inside Spark's expression engine.  Whole pages are processed; nothing is cut.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.text import _c, clean_text
from catalith.functions.url import resolve, stable_url

_HIDDEN = "(?is)<!--.*?-->|<(script|style)\\b[^>]*>.*?</\\1\\s*>"
_TAG = "(?s)<[!/?a-zA-Z][^>]*>"


def _entity_map() -> Column:
    # The standard named entities from the Python library's table, carried as
    # one constant that the optimizer folds to a literal.
    table = {name: chr(code) for name, code in sorted(name2codepoint.items())}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def decode_entities(c: Column | str, bare: bool = True) -> Column:
    """Replace named and numeric character references; without ``bare`` only those that end in a semicolon."""
    col = _c(c)
    names = _entity_map()
    end = ";?" if bare else ";"

    def one(piece: Column, i: Column) -> Column:
        name = F.regexp_extract(piece, f"^(#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|[A-Za-z][A-Za-z0-9]*){end}", 1)
        whole = F.regexp_extract(piece, f"^((?:#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|[A-Za-z][A-Za-z0-9]*){end})", 1)
        code = F.when(name.rlike("^#[xX]"), F.conv(name.substr(3, 8), 16, 10)).when(
            name.startswith("#"), name.substr(2, 8))
        char = F.when(code.isNotNull(), F.decode(F.unhex(F.lpad(F.conv(code, 10, 16), 8, "0")), "UTF-32")).otherwise(
            F.try_element_at(names, name))
        rest = piece.substr(F.length(whole) + 1, F.length(piece))
        return F.when(i == 0, piece).when((name != "") & char.isNotNull(), F.concat(char, rest)).otherwise(
            F.concat(F.lit("&"), piece))

    decoded = F.array_join(F.transform(F.split(col, "&"), one), "")
    return F.when(F.contains(col, F.lit("&")), decoded).otherwise(col)


def visible(html: Column | str) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(_c(html), _HIDDEN, "")


def inner_text(fragment: Column, bare: bool = True) -> Column:
    """Text of a markup fragment; tag boundaries separate words."""
    return clean_text(decode_entities(F.regexp_replace(fragment, _TAG, " "), bare))


def html_title(html: Column | str, bare: bool = True) -> Column:
    return clean_text(decode_entities(F.regexp_extract(visible(html), "(?is)<title\\b[^>]*>(.*?)</title\\s*>", 1), bare))


def html_text(html: Column | str, bare: bool = True) -> Column:
    """Visible text of the page, title included, entities decoded."""
    return inner_text(visible(html), bare)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute inside a start tag; empty when absent."""
    pattern = f"(?is)\\b{name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>]+))"
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def links(html: Column | str, base: Column | str, bare: bool = True) -> Column:
    """Array of (position, url, label) of the page's http(s) anchors.

    Image alternative text counts as label; script, mail, phone and in-page
    links are dropped; relative targets become absolute.
    """
    anchors = F.regexp_extract_all(visible(html), F.lit("(?is)(<a\\b[^>]*>.*?</a\\s*>)"), F.lit(1))

    def one(a: Column, i: Column) -> Column:
        tag = F.regexp_extract(a, "(?is)^(<a\\b[^>]*>)", 1)
        href = F.trim(decode_entities(attribute(tag, "href"), bare))
        body = F.regexp_replace(a, "(?is)<img\\b[^>]*?\\balt\\s*=\\s*[\"']([^\"']*)[\"'][^>]*>", " $1 ")
        usable = (href != "") & ~href.rlike("(?i)^(?:javascript:|mailto:|tel:|#)")
        return F.struct((i + 1).cast("int").alias("position"),
                        F.when(usable, stable_url(resolve(_c(base), href))).alias("url"),
                        inner_text(body, bare).alias("label"))

    return F.filter(F.transform(anchors, one), lambda x: F.coalesce(x["url"].rlike("(?i)^https?:"), F.lit(False)))


def link_rows(pages: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """One row per link of each page: key, position, url, label."""
    return pages.select(F.col(key), F.inline(links(html, base)))


def select_options(html: Column | str) -> Column:
    """Array of (select, value, text) for each option of each select element."""
    selects = F.regexp_extract_all(visible(html), F.lit("(?is)(<select\\b[^>]*>.*?</select\\s*>)"), F.lit(1))

    def options(s: Column) -> Column:
        tag = F.regexp_extract(s, "(?is)^(<select\\b[^>]*>)", 1)
        name = F.coalesce(F.nullif(attribute(tag, "id"), F.lit("")), F.nullif(attribute(tag, "name"), F.lit("")))
        found = F.regexp_extract_all(s, F.lit("(?is)(<option\\b[^>]*>.*?)(?=<option\\b|</option|</select)"), F.lit(1))
        return F.transform(found, lambda o: F.struct(
            name.alias("select"),
            decode_entities(attribute(F.regexp_extract(o, "(?is)^(<option\\b[^>]*>)", 1), "value")).alias("value"),
            inner_text(o).alias("text")))

    return F.flatten(F.transform(selects, options))


def table_cells(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """Physical cells of every table: one row per cell.

    Columns: the keys, table_no, caption, row_no, n_rows, in_head, cell_no,
    tag, rowspan, colspan, text.  Row numbers count body rows from 0; header
    rows carry ``in_head`` and count separately.
    """
    tables = F.regexp_extract_all(visible(html), F.lit("(?is)(<table\\b[^>]*>.*?</table\\s*>)"), F.lit(1))
    t = df.select(*keys, F.posexplode(tables).alias("table_no", "_table"))
    t = t.withColumn("caption", inner_text(F.regexp_extract("_table", "(?is)<caption\\b[^>]*>(.*?)</caption\\s*>", 1)))
    t = t.withColumn("_head", F.regexp_extract("_table", "(?is)<thead\\b[^>]*>(.*?)</thead\\s*>", 1))
    body = F.regexp_replace("_table", "(?is)<thead\\b[^>]*>.*?</thead\\s*>", "")
    row_pattern = F.lit("(?is)(<tr\\b[^>]*>.*?)(?=<tr\\b|</tr\\s*>|</tbody|</table)")
    rows = F.concat(
        F.transform(F.regexp_extract_all(F.col("_head"), row_pattern_head(), F.lit(1)),
                    lambda r, i: F.struct(F.lit(True).alias("in_head"), i.alias("row_no"), r.alias("tr"))),
        F.transform(F.regexp_extract_all(body, row_pattern, F.lit(1)),
                    lambda r, i: F.struct(F.lit(False).alias("in_head"), i.alias("row_no"), r.alias("tr"))))
    r = t.withColumn("n_rows", F.size(F.regexp_extract_all(body, row_pattern, F.lit(1)))).select(
        *keys, "table_no", "caption", "n_rows", F.inline(rows))
    cells = F.regexp_extract_all("tr", F.lit("(?is)(<t[dh]\\b[^>]*>.*?)(?=<t[dh]\\b|</t[dh]\\s*>|$)"), F.lit(1))
    c = r.select(*keys, "table_no", "caption", "n_rows", "in_head", "row_no",
                 F.posexplode(cells).alias("cell_no", "_cell"))
    tag = F.regexp_extract("_cell", "(?is)^(<t[dh]\\b[^>]*>)", 1)
    span = lambda n: F.coalesce(F.nullif(attribute(tag, n), F.lit("")).try_cast("int"), F.lit(1))
    return c.select(*keys, "table_no", "caption", "n_rows", "in_head", "row_no", "cell_no",
                    F.lower(F.regexp_extract("_cell", "(?is)^<(t[dh])", 1)).alias("tag"),
                    span("rowspan").alias("rowspan"), span("colspan").alias("colspan"),
                    inner_text(F.col("_cell")).alias("text"))


def row_pattern_head() -> Column:
    return F.lit("(?is)(<tr\\b[^>]*>.*?)(?=<tr\\b|</tr\\s*>|$)")
