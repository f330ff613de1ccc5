"""Column functions over strings: identifiers, hashes, token lists, cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the catalogue defines it (Unicode spaces plus the
# four ASCII separators).
SPACES = "(?U)[\\s\\x1c-\\x1f]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uid(prefix: str, *parts: Column | str) -> Column:
    """``prefix-`` plus 20 hex digits of SHA-256 over the unit-separated parts.

    A missing part is hashed as the text ``None``; ``concat_ws`` alone would
    skip it and make (a, null) collide with (a).
    """
    texts = [F.coalesce(_c(p).cast("string"), F.lit("None")) for p in parts]
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(F.concat_ws("\x1f", *texts), 256), 1, 20))


def short_hash(prefix: str, *parts: Column | str) -> Column:
    """``prefix-`` plus 12 hex digits of SHA-256 over the parts joined by ``|``."""
    texts = [F.coalesce(_c(p).cast("string"), F.lit("None")) for p in parts]
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(F.concat_ws("|", *texts), 256), 1, 12))


def relation_id(source: Column | str, predicate: Column | str, target: Column | str) -> Column:
    return short_hash("r", source, predicate, target)


def lead_id(url: Column | str) -> Column:
    return short_hash("lead", url)


def site_id(key: Column | str) -> Column:
    return short_hash("site", key)


def fingerprint(**fields: Column) -> Column:
    """SHA-256 of the compact JSON of ``fields`` with sorted keys and nulls kept."""
    ordered = [fields[k].alias(k) for k in sorted(fields)]
    return F.sha2(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}), 256)


def clean_text(c: Column | str) -> Column:
    """Collapse every run of whitespace to one space and trim."""
    return F.trim(F.regexp_replace(_c(c), SPACES, " "))


def blank_to_null(c: Column | str) -> Column:
    """Definition attributes: empty text and a lone dash mean unknown."""
    col = _c(c)
    return F.when(~col.isin("", "-"), col)


def ascii_fold(c: Column | str) -> Column:
    """Lower-case A-Z only; accented and non-Latin letters stay as they are."""
    return F.translate(_c(c), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contains_literal(c: Column | str, needle: str) -> Column:
    """Substring test in which ``%``, ``_``, ``\\`` and quotes are plain text."""
    return F.coalesce(F.contains(ascii_fold(c), F.lit(needle.translate(_ASCII_LOWER))), F.lit(False))


_ASCII_LOWER = {u: u + 32 for u in range(ord("A"), ord("Z") + 1)}


def contains_pattern(c: Column | str, needle: str) -> Column:
    """Substring test in which ``%`` and ``_`` in ``needle`` act as wildcards."""
    folded = "%" + needle.translate(_ASCII_LOWER).replace("\\", "\\\\") + "%"
    return F.coalesce(ascii_fold(c).like(folded), F.lit(False))


def tokens(c: Column | str, separator: str = ",") -> Column:
    """Array of (ordinal, label): trimmed, empties dropped, original place kept.

    Ordinals count from 1 before the empties are dropped.
    """
    numbered = F.transform(
        F.split(_c(c), F.lit(_quote(separator))),
        lambda x, i: F.struct((i + 1).cast("int").alias("ordinal"), F.trim(x).alias("label")))
    return F.filter(numbered, lambda t: t["label"] != "")


def _quote(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def category_path_terms(path: Column | str, title: Column | str) -> Column:
    """Array of (label, locator) for the inner segments of a ``a > b > c`` path.

    The first segment (the portal's root) is dropped, and so is the last one
    when it only repeats the title.
    """
    parts = F.split(_c(path), F.lit(" > "))
    last = F.size(parts) - 1
    numbered = F.transform(parts, lambda x, i: F.struct(
        F.trim(x).alias("label"),
        F.concat(F.lit("segment["), i.cast("string"), F.lit("]")).alias("locator"),
        ((i > 0) & ~((i == last) & F.coalesce(F.trim(x) == F.trim(_c(title)), F.lit(False)))
         & (F.trim(x) != "")).alias("keep")))
    kept = F.filter(numbered, lambda t: t["keep"])
    return F.transform(kept, lambda t: F.struct(t["label"].alias("label"), t["locator"].alias("locator")))


def declared_list(c: Column | str) -> Column:
    """A back-tick quoted list if the whole text is one, else a comma split."""
    col = _c(c)
    # Fixed value: the complete quoted-list grammar.
    quoted = col.rlike("^\\s*`[^`]*`(?:\\s*,\\s*`[^`]*`)*\\s*$")
    plain = F.filter(F.transform(F.split(col, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.coalesce(col, F.lit("")) == "", F.array().cast("array<string>")).when(
        quoted, F.regexp_extract_all(col, F.lit("`([^`]*)`"), F.lit(1))).otherwise(plain)


def csv_cell(c: Column | str) -> Column:
    """Fields of a cell that holds exactly one CSV record, else an empty array.

    Quotes follow the strict rule: a quoted field must end at a comma or the
    end, and a doubled quote stands for one.  Spaces after a comma are skipped.
    Every repetition is possessive, so long cells and long records take linear
    time and no stack.
    """
    col = _c(c)
    field = '(?:"[^"]*+(?:""[^"]*+)*+"|[^",\\r\\n][^,\\r\\n]*+|)'
    strict = col.rlike(f"^ *+{field}(?:, *+{field})*+$") & (col != "")
    # Each match starts at the beginning or at a comma, so empties keep a place.
    raw = F.regexp_extract_all(F.concat(F.lit(","), col), F.lit(f", *+({field})"), F.lit(1))
    opened = F.transform(raw, lambda x: F.when(
        x.startswith('"'), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    return F.when(strict, opened).otherwise(F.array().cast("array<string>"))


def provider_prefix(c: Column | str) -> Column:
    """Agency name in front of ``,「survey」``; empty becomes unknown."""
    head = F.trim(F.split(_c(c), F.lit(",「"))[0])
    return F.when(head != "", head)


def literal_unit(c: Column | str, label: str = "단위") -> Column:
    """Unit written out as ``(단위 : X)`` in a description, never normalised."""
    found = F.regexp_extract(_c(c), f"\\({label}\\s*:\\s*([^)]*)\\)", 1)
    return F.when(found != "", found)


def declared_datatype(c: Column | str, allowed: tuple[str, ...]) -> Column:
    """The declared type when it is in the literal allow-list, else unknown."""
    col = _c(c)
    return F.when(col.isin(*allowed), col)


def identity_key(matches: Column, parts: list[Column], fallback: list[Column]) -> Column:
    """``a/b`` when the link identity holds, else an ``unresolved-`` identifier."""
    return F.when(F.coalesce(matches, F.lit(False)), F.concat_ws("/", *parts)).otherwise(
        uid("unresolved", *fallback))


def shape_tags(**present: Column) -> Column:
    """Names of the nested objects that are present, in the given order."""
    return F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(k)) for k, c in present.items()]))


def local_time_label(ts: Column | str, zone: str = "Asia/Seoul", pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    """UTC timestamp as a formatted label in ``zone``."""
    return F.date_format(F.from_utc_timestamp(_c(ts), zone), pattern)


def net_rate(outflow: Column, inflow: Column, population: Column) -> Column:
    """Net outflow per thousand; unknown when the denominator is missing or zero."""
    return F.try_divide((outflow - inflow).cast("double"), population.cast("double")) * 1000


def drop_private_fields(c: Column | str, names: tuple[str, ...]) -> Column:
    """A string map without the staff/contact keys in ``names``."""
    return F.map_filter(_c(c), lambda k, v: ~k.isin(*names))


def metadata_flags(title: Column, description: Column, keywords: Column, lang: Column) -> Column:
    """Array of quality flags for one metadata row; empty when nothing is wrong.

    Defined here (the specification only names the flags): a field that is null
    or blank is ``missing_<field>``; U+FFFD anywhere is ``broken_encoding``; a
    row with neither description nor keywords is ``insufficient_metadata``.
    """
    def blank(c: Column) -> Column:
        return F.coalesce(F.trim(c) == "", F.lit(True))

    broken = F.coalesce(F.contains(F.concat_ws(" ", title, description, keywords), F.lit("�")), F.lit(False))
    return F.array_compact(F.array(
        F.when(blank(title), F.lit("missing_title")),
        F.when(blank(description), F.lit("missing_description")),
        F.when(blank(keywords), F.lit("missing_keywords")),
        F.when(blank(lang), F.lit("missing_language")),
        F.when(broken, F.lit("broken_encoding")),
        F.when(blank(description) & blank(keywords), F.lit("insufficient_metadata"))))


def first_record_header(content: Column | str, limit: int | None = None) -> Column:
    """Struct(encoding, header, status) of the first CSV record of a file.

    The header stays a candidate (``first_record_is_header_verified`` is never
    asserted).  The file is unresolved when its first record is longer than
    ``limit`` bytes (no limit unless one is given), is markup, starts a UTF-16 file, or is in neither UTF-8 nor
    CP949.  Reading CP949 needs ``spark.sql.legacy.javaCharsets=true``.
    """
    raw = _c(content)
    cut = raw if limit is None else F.substring(raw, 1, limit + 1)
    # Byte-for-byte view: quotes and line ends never occur inside a CP949 or
    # UTF-8 multi-byte character, so the record's end is found without decoding.
    # Text between quotes alternates outside/inside; the record ends at the first
    # line end that stands outside.
    view = F.decode(cut, "ISO-8859-1")
    none = F.struct(F.lit(0).alias("size"), F.lit(0).alias("place"), F.lit(False).alias("done"))
    walk = F.aggregate(F.split(view, '"'), none, lambda s, p: F.when(s["done"], s).when(
        (s["place"] % 2 == 0) & p.rlike("[\\r\\n]"), F.struct(
            (s["size"] + F.length(F.regexp_extract(p, "^[^\\r\\n]*", 0))).alias("size"), s["place"].alias("place"),
            F.lit(True).alias("done"))).otherwise(F.struct(
                (s["size"] + F.length(p) + 1).alias("size"), (s["place"] + 1).alias("place"), F.lit(False).alias("done"))))
    size = F.when(walk["done"], walk["size"]).otherwise(walk["size"] - 1)
    first = raw.substr(F.lit(1), size)
    utf16 = F.hex(F.substring(raw, 1, 2)).isin("FFFE", "FEFF")
    too_long = F.lit(False) if limit is None else F.octet_length(first) > limit
    is_utf8 = F.is_valid_utf8(first.cast("string"))
    # Two-byte characters removed, a CP949 text is plain ASCII; anything else is
    # not decoded at all, because decoding malformed bytes is an error.
    pairs = F.regexp_replace(view.substr(F.lit(1), size), "[\\x81-\\xfe][\\x41-\\x5a\\x61-\\x7a\\x81-\\xfe]", "")
    is_cp949 = ~pairs.rlike("[\\x80-\\xff]")
    text = F.when(is_utf8, first.cast("string")).when(is_cp949, F.decode(first, "MS949"))
    text = F.regexp_replace(F.regexp_replace(text, "^\\x{FEFF}", ""), "[\\r\\n]+$", "")
    markup = F.lower(text).rlike("<html|<!doctype")
    cells = csv_cell(text)
    ok = F.coalesce(~utf16 & ~too_long & ~markup & (F.size(cells) > 0) & ~F.contains(text, F.lit("�")), F.lit(False))
    return F.struct(
        F.when(ok, F.when(is_utf8, F.lit("utf-8-sig")).otherwise(F.lit("cp949"))).alias("encoding"),
        F.when(ok, cells).alias("header"),
        F.when(ok, F.lit("csv_first_record_observed")).otherwise(F.lit("header_unresolved")).alias("status"),
        F.lit(False).alias("first_record_is_header_verified"))
