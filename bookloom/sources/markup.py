"""Book mark-up that arrives broken: encoding, cut ends, stray characters, embedded binaries."""

from __future__ import annotations

import base64
import binascii
import functools
from xml.etree import ElementTree

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

#: The single-byte encodings that take part in the vote, of Latin and of other letters.
LATIN, OTHER = ("cp1252", "cp1250", "cp1254", "cp1257"), ("cp1251", "cp1253")


def _last(text: Column, part: str) -> Column:
    """Place (from 1) of the last occurrence, 0 if there is none."""
    at = F.locate(part[::-1], F.reverse(text))
    return F.when(at > 0, F.char_length(text) - at - len(part) + 2).otherwise(0)


def repair_tail(text: Column, root: str = "FictionBook") -> Column:
    """Cut after the root's end tag; without one before the last binary, else after the last body; then closed."""
    end, close = f"</{root}>", F.lit(f"</{root}>")
    whole, binary, body = F.locate(end, text), _last(text, "<binary"), _last(text, "</body>")
    return (
        F.when(whole > 0, text.substr(F.lit(1), whole + len(end) - 1))
        .when(binary > 0, F.concat(text.substr(F.lit(1), binary - 1), close))
        .when(body > 0, F.concat(text.substr(F.lit(1), body + len("</body>") - 1), close))
        .otherwise(text)
    )


def closed(text: str, root: str = "FictionBook") -> str:
    """``repair_tail`` of one text."""
    end = f"</{root}>"
    if (at := text.find(end)) >= 0:
        return text[: at + len(end)]
    if (at := text.rfind("<binary")) >= 0:
        return text[:at] + end
    if (at := text.rfind("</body>")) >= 0:
        return text[: at + len("</body>")] + end
    return text


_ADDRESS = regex.compile(r"<([0-9a-z][0-9a-z._+-]*@[0-9a-z][0-9a-z.-]*\.[a-z]{2,6})>", regex.I)


@functools.cache
def _marks(tags: tuple[str, ...]) -> regex.Pattern:
    """All that a scan stops at, with what has to stand around it."""
    names = "|".join(map(regex.escape, tags))
    return regex.compile(
        rf"(?P<br></?br\s*/?>)|(?P<ends>[\r\n]+)|(?P<control>[\x00-\x08\x0b\x0c\x0e-\x1f])|(?P<amp>&(?!(?:amp|apos|gt|lt|quot);))"
        rf"|(?P<close></[^a-z<>]+>)|(?P<custom><(?P<end>/?)custom-info(?=[ >/\r\n]))|(?P<lt><(?!!--|/?(?:{names})[ >/\r\n]))|(?P<gt>(?<![\"/]|--|[</](?:{names}))>)",
        regex.I,
    )


def mended(text: str, tags: tuple[str, ...]) -> str:
    """Broken mark-up in one scan, from the declaration's end on.

    An ampersand that begins none of the five entities, a bracket that opens no known tag or end tag (a name and a
    space, a slash, a line end or the closing bracket), and one that closes none (before it a quote, a slash or
    a known name) are escaped; inside ``custom-info`` all brackets stay. Line breaks, control characters and end tags
    without a letter go, line ends become one. Before that addresses in brackets are put in quotes and bare
    numbers of sections too.
    """
    out = _ADDRESS.sub(r'"\1"', text)
    out = regex.sub(r"(?i)<section id=n(\d+)>", r'<section id="n\1">', out)
    head, sep, rest = out.partition("?>")
    if not sep:
        head, rest = "", out
    custom = False

    def one(m: regex.Match) -> str:
        nonlocal custom
        kind = m.lastgroup if m.lastgroup != "end" else "custom"
        if kind == "custom":
            custom = not m["end"]
            return m[0]
        if kind in ("lt", "gt"):
            return m[0] if custom else f"&{kind};"
        return {"ends": "\n", "amp": "&amp;"}.get(kind, "")

    return f"{head}{sep}" + _marks(tags).sub(one, rest)


def repair_markup(text: Column, tags: tuple[str, ...]) -> Column:
    """``mended`` as a column; null stays null."""

    @F.pandas_udf("string")
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else mended(t, tags) for t in texts], dtype="object")

    return scan(text)


def declared_encoding(body: Column, declared: str = r'encoding="([\w-]+)"') -> Column:
    """The encoding that a book declares, empty if none."""
    return F.lower(F.regexp_extract(F.substring(body, 1, 200).cast("string"), declared, 1))


def encoding(body: Column, declared: str = r'encoding="([\w-]+)"') -> Column:
    """Name of the encoding of a binary column: declaration, byte order mark, valid UTF-8, else a vote.

    Codecs of other than Latin letters stand for election where bytes beyond ASCII outnumber ASCII letters;
    the one that reads most of them as letters wins, utf-8 if that is less than five sixths. Null for null.
    """

    @F.pandas_udf("string")
    def vote(bodies: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else _vote(bytes(b)) for b in bodies], dtype="object")

    head = declared_encoding(body, declared)
    return F.when(head != "", head).otherwise(vote(body))


def _vote(body: bytes) -> str:
    for mark, name in ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16le"), (b"\xfe\xff", "utf-16be")):
        if body.startswith(mark):
            return name
    try:
        body.decode()
        return "utf-8"
    except UnicodeDecodeError:
        high = bytes(b for b in body if b >= 128)
    plain = sum(65 <= b <= 90 or 97 <= b <= 122 for b in body)
    letters = lambda codec: sum(c.isalpha() for c in high.decode(codec, "ignore"))
    best = max(OTHER if len(high) > plain else LATIN, key=letters)
    return best if 6 * letters(best) >= 5 * len(high) else "utf-8"


#: How pictures begin that are still base64.
CODED = (b"/9j/4A", b"iVBORw")


def binaries(df: DataFrame, body: str = "body") -> DataFrame:
    """The rows once per embedded binary: binary_id, is_cover, content; a book without any gives no row.

    A picture that was encoded twice is decoded twice. Broken mark-up and broken base64 give a row with ``error``
    set instead.
    """

    @F.pandas_udf("array<struct<binary_id:string,is_cover:boolean,content:binary,error:string>>")
    def parse(bodies: pd.Series) -> pd.Series:
        return pd.Series([_binaries(bytes(b)) if b is not None else [] for b in bodies], dtype="object")

    return df.select(*[c for c in df.columns if c != body], F.inline(parse(F.col(body))))


def _binaries(body: bytes) -> list[tuple]:
    try:
        root = ElementTree.fromstring(body)
    except ElementTree.ParseError as e:
        return [(None, None, None, str(e))]
    local = lambda x: x.tag.rsplit("}", 1)[-1]
    covers = {v.lstrip("#") for page in root.iter() if local(page) == "coverpage" for image in page.iter() for k, v in image.attrib.items() if k.rsplit("}", 1)[-1] == "href"}
    out = []
    for x in root.iter():
        if local(x) == "binary":
            name = x.attrib.get("id", "").lstrip("#")
            try:
                content = base64.b64decode("".join((x.text or "").split()), validate=True)
                if content.startswith(CODED):  # it was encoded twice
                    content = base64.b64decode(content)
                out.append((name, name in covers, content, "nested element" if len(x) else None))
            except binascii.Error as e:
                out.append((name, name in covers, None, str(e)))
    return out
