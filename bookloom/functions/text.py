"""Column functions for titles, names, tags and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def simplified(x: Column) -> Column:
    """Trimmed, runs of white space as one space."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


#: Tags written in brackets, and what they become.
BRACKET_TAGS = (("br", "br"), ("hr", "hr"), ("quote", "q"), ("table", "table"), ("tr", "tr"), ("th", "th"), ("td", "td"))


# The patterns of the rules and their order.
def tag_rules() -> list[tuple[str, str]]:
    """The ordered rewriting rules from bracket tags to mark-up, as (pattern, replacement)."""
    rules = [(r"<p>&nbsp;</p>", ""), (r"(?:^|\n)(?:[ \t\r]*(?:\n|$))+", "\n"), (r"^\n|\n$", ""), (r"\n", "<br/>"), (r"\[(\w)\]", "<$1>"), (r"\[(/\w)\]", "<$1>")]
    for tag, html in BRACKET_TAGS:
        rules += [(rf"(?i)\[{tag}\]", f"<{html}>"), (rf"(?i)\[/{tag}\]", f"</{html}>")]
    return rules + [
        (r"\[img\](.*?)\[/img\]", '<img src="$1"/>'),
        (r"\[(?:URL|url)=(.*?)\](.*?)\[/(?:URL|url)\]", '<a href="$1"/>$2</a>'),
        (r"\[color=(.*?)\]", '<font color="$1">'),
        (r"\[/color\]", "</font>"),
        (r'([^"])(https?://\S+?)([\s<])', '$1<a href="$2">$2</a>$3'),
        (r"\[collapse collapsed title=(.*?)\]", "<details><summary>$1</summary>"),
        (r"\[/collapse\]", "</details>"),
    ]


def replace_tags(x: Column) -> Column:
    """Bracket tags, links and folding sections of a review as mark-up; null stays null."""
    out = F.concat(F.lit(" "), x, F.lit(" "))
    for pattern, replacement in tag_rules():
        out = F.regexp_replace(out, pattern, replacement)
    return simplified(out)


def bracket_series(x: Column) -> Column:
    """``A (B) C`` becomes ``A [B]C``."""
    return F.regexp_replace(x, r"^(.*?)\((.*?)\)\s*(.*)$", "$1[$2]$3")


def scrub_separators(x: Column) -> Column:
    """Names lose colons; commas become semicolons."""
    return F.translate(x, ",:", ";")


# The dashes and letters that are folded.
def dash_fold(x: Column) -> Column:
    """Typographic dashes as hyphens, spaced hyphens as an en dash, yo as ye."""
    out = F.translate(x, "‐‑‒–—―ёЁ", "------еЕ")
    return F.regexp_replace(out, r" --? ", " – ")


def unescape_twice(x: Column) -> Column:
    """Entities lose one level of escaping: ampersands go last, so what they free stays."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        x = F.regexp_replace(x, f"(?i)&{name};", char)
    return x


def title_tokens(x: Column) -> Column:
    """Sorted distinct lower-case words of a title."""
    words = F.split(simplified(F.regexp_replace(F.translate(F.lower(x), "ё", "е"), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.array_sort(F.array_distinct(F.array_remove(words, "")))


#: Words that a candidate's title loses before it is compared.
NOT_TITLE = ("си",)


def candidate_tokens(x: Column) -> Column:
    """Words of a title without those that say nothing about it."""
    return F.array_except(title_tokens(x), F.array(*map(F.lit, NOT_TITLE)))


def sort_text(x: Column) -> Column:
    """Lower-cased for sorting; missing names sort last."""
    return F.when(F.coalesce(x, F.lit("")) == "", F.lit("￿")).otherwise(F.lower(simplified(x)))


def sort_number(x: Column) -> Column:
    """The integer value for sorting; what is not a number sorts last."""
    return F.coalesce(x.try_cast("long"), F.lit(2147483647).cast("long"))


def to_int(x: Column) -> Column:
    """The integer a text holds, 0 where it holds none."""
    return F.coalesce(x.try_cast("int"), F.lit(0))


def leading_int(x: Column) -> Column:
    """The integer at a text's start, null where there is none."""
    return F.nullif(F.regexp_extract(x, r"^\s*(\d{1,9})", 1), F.lit("")).cast("int")


def author_key(x: Column) -> Column:
    """Key of an author's name: md5 of its lower-cased words."""
    return F.md5(F.lower(simplified(x)).cast("binary"))


def hex_to_long(x: Column) -> Column:
    """64 bits from sixteen hexadecimal digits."""
    return F.conv(x, 16, -10).cast("long")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def base_name(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Lower-cased last suffix of a file name, empty where there is none."""
    return F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))


#: Spellings of the default book type.
TYPE_ALIASES = ("fd2", "fb", "???", "fb 2")


def file_key(name: Column, book_id: Column, kind: Column) -> Column:
    """``name.suffix`` of an explicit file name, otherwise id and type, the type's misspellings mended."""
    kind = F.lower(F.coalesce(F.nullif(F.trim(kind), F.lit("")), F.lit("fb2")))
    kind = F.when(kind.isin(*TYPE_ALIASES), "fb2").otherwise(kind)
    made = F.concat(book_id.cast("string"), F.lit("."), kind)
    return F.when(F.coalesce(name, F.lit("")) == "", made).otherwise(F.concat(base_name(name), F.lit("."), suffix(name)))


def fill(template: Column, *values: Column) -> Column:
    """``%1 %2 ...`` of a template replaced by the values."""
    for i, v in enumerate(values, 1):
        template = F.replace(template, F.lit(f"%{i}"), v)
    return template


def without_illegal(x: Column) -> Column:
    """A path part without characters that file systems refuse."""
    return F.regexp_replace(x, r'[<>:"/\\|?*\x00-\x1f]', "")


def signature(head: Column) -> Column:
    """Kind of a file by the first characters of its text form."""
    low = F.lower(F.ltrim(head))
    return (
        F.when(low.startswith("<!doctype html") | low.startswith("<html"), "html")
        .when(low.startswith("<?xml"), "xml")
        .when(low.startswith("<svg"), "svg")
        .when(head.startswith("PK\x03\x04"), "zip")
        .when(head.startswith("/9j/"), "jpeg base64")
        .when(head.startswith("iVBORw0KGgo"), "png base64")
        .otherwise("other")
    )
