"""Column expressions over URLs, labels, dates, ranks and numeric text.

Digit and word classes are ASCII. All expressions run inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The numeric-text guard, the text form of a date, the label of no year.
NUMERIC_TEXT = r"^[0-9]+\.?[0-9]*$"
LONG_DATE = "MMMM d, yyyy"
NO_YEAR = "No Year"


# White space at the ends of a field: what Python's str.strip takes off, in ASCII and beyond.
EDGES = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


def strip(c: Column | str) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(as_column(c), EDGES, "")


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(as_column(c), F.lit(""))


def null_to_empty(c: Column | str) -> Column:
    return F.coalesce(as_column(c).cast("string"), F.lit(""))


def any_filled(columns: Sequence[Column | str]) -> Column:
    """True where at least one of the text columns is neither null nor empty."""
    return F.coalesce(*[empty_to_null(c) for c in columns]).isNotNull()


def guarded_decimal(c: Column | str, precision: int = 5, scale: int = 2) -> Column:
    """Decimal of digit text, null for anything else or too large."""
    c = as_column(c)
    return F.when(c.rlike(NUMERIC_TEXT), c.try_cast(T.DecimalType(precision, scale)))


def known(c: Column | str, unknown: Sequence[str] = ("", "N/A")) -> Column:
    c = as_column(c)
    return c.isNotNull() & ~c.isin(*unknown)


def url_id(url: Column | str, kind: str = "game") -> Column:
    """Digits in `/<kind>/<digits>/`, "" when the URL has none."""
    return F.regexp_extract(as_column(url), rf"/{kind}/([0-9]+)/", 1)


def first_id_of_kinds(
    href: Column | str, kinds: Sequence[str] = ("company", "person", "user")
) -> Column:
    """First id found, trying the kinds of link in order; null when there is none."""
    href = as_column(href)
    return F.coalesce(
        *[F.nullif(F.regexp_extract(href, rf"/{k}/([0-9]+)", 1), F.lit("")) for k in kinds]
    )


def synthetic_key(prefix: str, value: Column | str) -> Column:
    """Prefix and the first ten hex digits of the MD5 of the value."""
    return F.concat(F.lit(prefix), F.substring(F.md5(as_column(value).cast("binary")), 1, 10))


def sha256_hex(value: Column | str) -> Column:
    return F.sha2(as_column(value).cast("binary"), 256)


def user_name(url: Column | str) -> Column:
    """Name in `/user/<n>/<name>`, else the last path part, else the text itself."""
    bare = F.regexp_replace(strip(url), "/+$", "")
    from_profile = F.nullif(F.regexp_extract(bare, "/user/[0-9]+/([^/]+)", 1), F.lit(""))
    last_part = F.split(F.element_at(F.split(bare, "/"), -1), r"\?")[0]
    plain = F.when(F.contains(bare, F.lit("/")), last_part).otherwise(bare)
    return F.when(empty_to_null(url).isNotNull(), F.coalesce(from_profile, plain))


def slug_words(slug: Column | str) -> Column:
    return F.lower(strip(F.replace(as_column(slug), F.lit("-"), F.lit(" "))))


def normal_label(label: Column | str) -> Column:
    """Label text without outer white space and trailing colons, in lower case."""
    bare = F.regexp_replace(strip(label), ":+$", "")
    return F.lower(strip(bare))


def text_year(c: Column | str, year_only: bool = False) -> Column:
    """Year of "October 3, 2023"; null when malformed.

    With `year_only`, bare four-digit text counts as a year too.
    """
    c = as_column(c)
    year = F.year(F.try_to_date(c, LONG_DATE))
    if not year_only:
        return year
    return F.coalesce(year, F.when(strip(c).rlike("^[0-9]{4}$"), strip(c).try_cast("int")))


def year_label(year: Column | str) -> Column:
    return F.coalesce(as_column(year).cast("string"), F.lit(NO_YEAR))


def rank_of_total(c: Column | str) -> tuple[Column, Column]:
    """Parts of "#12 of 345"; both "" unless the text holds "#" and "of"."""
    c = as_column(c)
    complete = F.contains(c, F.lit("#")) & F.contains(c, F.lit("of"))
    after_hash = F.get(F.split(c, "#", 2), F.lit(1))
    rank = strip(F.get(F.split(after_hash, "of", 2), F.lit(0)))
    total = strip(F.get(F.split(c, "of", 2), F.lit(1)))
    return (
        F.when(complete, rank).otherwise(F.lit("")),
        F.when(complete, total).otherwise(F.lit("")),
    )


def _without_dots(path: Column) -> Column:
    """An absolute path with its "." and ".." parts resolved; ".." stops at the root."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)

    def add(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    resolved = F.aggregate(parts, F.array().cast("array<string>"), add)
    folder = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.array_join(resolved, "/"), folder)).otherwise(path)


def join_url(base: Column | str, href: Column | str) -> Column:
    """Absolute form of a link found on page `base`; dot parts are resolved, an empty link is the page."""
    base, href = as_column(base), as_column(href)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    bare = F.regexp_replace(base, r"#.*$", "")
    page = F.substr(F.regexp_replace(bare, r"\?.*$", ""), F.length(origin) + 1)
    folder = F.when(page == "", F.lit("/")).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substr(href, F.length(path) + 1)
    full = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(bare, href))
        .when(href.startswith("?"), F.concat(origin, page, href))
        .otherwise(F.concat(origin, _without_dots(full), rest))
    )


def page_key(url: Column | str) -> Column:
    """URL without query text, ending in exactly one slash."""
    bare = F.split(as_column(url), r"\?")[0]
    return F.concat(F.regexp_replace(bare, "/+$", ""), F.lit("/"))


def split_list(c: Column | str, separator: str = r";\s*") -> Column:
    """Stripped non-empty parts of a delimited text."""
    parts = F.transform(F.split(as_column(c), separator), strip)
    return F.filter(parts, lambda p: p != "")


def explode_list(df: DataFrame, column: str, out: str, separator: str = r";\s*") -> DataFrame:
    """One row per part of a delimited column; rows without parts vanish."""
    return df.withColumn(out, F.explode(split_list(column, separator)))


def wrap16(c: Column | str) -> Column:
    return as_column(c).bitwiseAND(F.lit(65535))


def json_texts(json: Column | str, path: str) -> Column:
    """The field at `path` as an array, whether it holds one text or several."""
    doc = F.try_parse_json(as_column(json))
    many = F.try_variant_get(doc, path, "array<string>")
    one = F.try_variant_get(doc, path, "string")
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)))


def ends_in_name(key: Column | str, name: str) -> Column:
    """Key equals the name or ends in `/name` or `/name/`, compared literally."""
    key = as_column(key)
    return key.endswith(f"/{name}/") | key.endswith(f"/{name}") | (key == F.lit(name))
