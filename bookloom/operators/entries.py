"""From an archive's entries to the books of the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bookloom.functions import text as tx
from bookloom.operators import resolve

#: Folders whose books are known by their id alone, the same in all libraries.
COMMON_FOLDERS = (
    "fb2-000024-030559", "fb2-030560-060423", "fb2-060424-074391", "fb2-074392-091839", "fb2-091841-104214", "fb2-104215-113436",
    "fb2-113437-119690", "fb2-119691-132107", "fb2-132108-141328", "fb2-141329-147517", "fb2-147519-153549", "fb2-153556-158325",
    "fb2-158328-161830", "fb2-161831-166042", "fb2-166043-168102", "fb2-168103-172702",
)
UNKNOWN_AUTHOR, UNORDERED = "unknown author:", "unordered:"


def uid(folder: Column, file: Column, suffix: Column | None = None) -> Column:
    """``folder#file.ext``."""
    return F.concat(folder, F.lit("#"), file if suffix is None else F.concat(file, F.lit("."), suffix))


def all_suffixes_off(path: Column) -> Column:
    """File name up to its first dot."""
    return F.regexp_extract(F.regexp_extract(path, r"([^/]*)$", 1), r"^([^.]*)", 1)


def good_names(rows: DataFrame, name: str) -> DataFrame:
    """Rows whose file name holds no line end."""
    return rows.where(~F.col(name).rlike(r"[\r\n]"))


def without_origin(rows: DataFrame) -> DataFrame:
    """Rows that are not yet known to be a duplicate of another."""
    return rows.where(F.col("origin").isNull())


def still_there(rows: DataFrame, entries: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose file is still in its archive."""
    return rows.join(entries.select(*key).distinct(), key, "left_semi")


def bind(files: DataFrame, books: DataFrame) -> DataFrame:
    """Adds book and matched: a file (folder, file, size) is the book of its exact name (1), else of its first part and suffix (2), or none (0).

    ``books``: file_key, book. Sizes that are known replace the book's own: see ``sized``.
    """
    short = F.concat(all_suffixes_off(F.col("file")), F.lit("."), tx.suffix(F.col("file")))
    lookup = books.groupBy(F.col("file_key").alias("key")).agg(F.min("book").alias("book"))
    return resolve.cascade(files, [(lookup, F.col("file"), "name"), (lookup, short, "short name")], "book")


def sized(rows: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """``size`` replaced by that of the root section whose id is the book's text id, unless it is 0.

    ``fingerprints``: file, id (text id), sections (array of depth, id, count, size).
    """
    own = F.filter("sections", lambda s: (s["depth"] == 0) & (s["id"] == F.col("id")) & (s["size"] > 0))
    known = fingerprints.select(F.col("file").alias("known_file"), F.get(own, F.lit(0))["size"].alias("known_size")).groupBy("known_file").agg(F.max("known_size").alias("known_size"))
    out = rows.join(known, F.col("file") == F.col("known_file"), "left")
    return out.withColumn("size", F.coalesce("known_size", "size")).drop("known_file", "known_size")


def resolve_entries(entries: DataFrame, by_uid: DataFrame, by_dictionary: DataFrame, by_dump: DataFrame, parsed: DataFrame) -> DataFrame:
    """Adds book and matched: by the entry's uid (1), its name without .zip (2), its md5 in the dictionary (3) or in the dump (4), by parsing (5), else 0.

    ``entries``: folder, file, md5; the others key and book, one row per key (``parsed`` by uid).
    """
    own = uid(F.col("folder"), F.col("file"))
    bare = uid(F.col("folder"), F.regexp_replace("file", r"(?i)\.zip$", ""))
    return resolve.cascade(entries, [(by_uid, own, "uid"), (by_uid, bare, "without .zip"), (by_dictionary, F.col("md5"), "dictionary"), (by_dump, F.col("md5"), "dump"), (parsed, own, "parsed")], "book")


def unknown_book(file: Column, size: Column, date: Column, lang: str = "un") -> list[Column]:
    """The catalogue's columns for a file that no parser reads: a deleted book of an unknown author."""
    name = tx.base_name(file)
    return [F.lit(UNKNOWN_AUTHOR).alias("author"), F.lit(UNORDERED).alias("genre"), name.alias("title"), name.alias("file"), size.cast("string").alias("size"), name.alias("libid"), F.lit(True).alias("deleted"), tx.suffix(file).alias("ext"), F.date_format(date, "yyyy-MM-dd").alias("date"), F.lit(lang).alias("lang"), F.lit(0.0).alias("rate_sum"), F.lit(1).alias("rate_count")]


def with_original_names(books: DataFrame, base: str = "origin_base", suffix: str = "origin_suffix") -> DataFrame:
    """A described file's own name and suffix in place of its description's, where they are given."""
    given = lambda c, old: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(old)).alias(old)
    named = {"libid": base, "file": base, "ext": suffix}
    return books.select(*[given(named[c], c) if c in named else c for c in books.columns if c not in (base, suffix)])


def library_index(books: DataFrame) -> DataFrame:
    """key, book: books by source and id, and those of the common folders by their id alone; the first (smallest) one of a key counts.

    ``books``: book, source, libid, folder.
    """
    keyed = books.select("book", F.concat_ws("_", "source", "libid").alias("key"))
    common = books.where(tx.base_name(F.col("folder")).isin(*COMMON_FOLDERS)).select("book", F.col("libid").alias("key"))
    return keyed.unionByName(common).groupBy("key").agg(F.min("book").alias("book"))


def canonical_language(code: Column, table: DataFrame | None = None, unknown: str = "un", most: int = 10_000) -> Column:
    """A lower-cased code by the dictionary (rows of code, language, ``most`` at most); unknown codes are ``unknown``."""
    low = F.lower(F.trim(code))
    if table is None:
        return F.coalesce(F.nullif(low, F.lit("")), F.lit(unknown))
    found = table.select("code", "language").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"a dictionary of languages has no more than {most} codes")
    pairs = [F.lit(x) for r in found for x in r]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), low), F.lit(unknown)) if pairs else F.lit(unknown)


def with_origins(hashes: DataFrame, edges: DataFrame) -> DataFrame:
    """Fingerprints with the origin of those that are duplicates (edges: dup, origin), null for the others; the first edge counts."""
    first = edges.groupBy(F.col("dup").alias("id")).agg(F.min("origin").alias("origin"))
    return hashes.drop("origin").join(first, "id", "left")


def without_duplicates(entries: DataFrame, edges: DataFrame, images: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """An archive's entries (id) without duplicates, and its images without those of the files that went."""
    gone = edges.select(F.col("dup").alias("id")).distinct()
    return entries.join(gone, "id", "left_anti"), None if images is None else images.join(gone, "id", "left_anti")


def archives_to_publish(archives: DataFrame) -> DataFrame:
    """Archives by falling number, as they are read; publishing takes them the other way."""
    return archives.orderBy(F.desc("number"), "name")


def author_notes(notes: DataFrame, names: DataFrame, pictures: DataFrame) -> DataFrame:
    """nid, name, body, file: notes on authors with the author's full name and each of their pictures; unknown authors have none."""
    full = F.concat("last", F.lit(" "), "first", F.lit(" "), "middle")
    own = notes.join(names.select("author_id", full.alias("name")), "author_id").join(pictures, "author_id", "left")
    return own.select("nid", "name", "body", "file").orderBy("nid", "file")
