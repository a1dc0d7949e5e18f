"""The two layouts of library dumps (authors in places, authors in roles), corrections kept in a database of their own, and small settings files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bookloom.operators import catalogue, corrections
from bookloom.sources import dump


@dataclass(frozen=True)
class Dialect:
    """How a library's dump spells the catalogue's tables: name -> schema of the values of an INSERT."""

    name: str
    tables: dict[str, str]
    authors: Callable[[dict[str, DataFrame]], DataFrame]
    reviews: Callable[[dict[str, DataFrame]], DataFrame]


def _role_authors(t: dict[str, DataFrame]) -> DataFrame:
    links = t["libavtor"].where("role = 'a'").select(F.col("bid").alias("book_id"), F.col("aid").alias("author_id"), F.struct("aid").alias("pos"))
    names = t["libavtors"].select(F.col("aid").alias("author_id"), "last", "first", "middle", F.lit("").alias("nick"), F.nullif(F.col("main"), F.lit(0)).alias("master_id"))
    return catalogue.author_lists(links, names)


def _placed_authors(t: dict[str, DataFrame]) -> DataFrame:
    links = t["libavtor"].select(F.col("BookId").alias("book_id"), F.col("AvtorId").alias("author_id"), F.struct("Pos", "AvtorId").alias("pos"))
    names = t["libavtorname"].select(F.col("AvtorId").alias("author_id"), F.col("LastName").alias("last"), F.col("FirstName").alias("first"), F.col("MiddleName").alias("middle"), F.col("NickName").alias("nick"), F.col("MasterId").alias("master_id"))
    return catalogue.author_lists(links, names, illustrator="иллюстратор")


#: Names and columns of the dumps' tables that the catalogue is made of.
DIALECTS = {
    "placed": Dialect(
        "placed",
        {"libavtor": "BookId long, AvtorId long, Pos int", "libavtorname": "AvtorId long, FirstName string, MiddleName string, LastName string, NickName string, uid long, Email string, Homepage string, Gender string, MasterId long", "libreviews": "Name string, Time string, BookId long, Text string"},
        _placed_authors,
        lambda t: t["libreviews"].select(F.col("BookId").alias("book_id"), F.col("Name").alias("name"), F.col("Time").alias("time"), F.col("Text").alias("text")),
    ),
    "roles": Dialect(
        "roles",
        {"libavtor": "bid long, aid long, role string", "libavtors": "aid long, first string, middle string, last string, main long", "libpolka": "pid long, Time string, bid long, type string, uid long, Text string, Flag string, hastext string"},
        _role_authors,
        lambda t: t["libpolka"].where("type = 'b'").select(F.col("bid").alias("book_id"), F.lit(None).cast("string").alias("name"), F.col("Time").alias("time"), F.col("Text").alias("text")),
    ),
}


def choose(path: str, name: str | None = None, known: dict[str, Dialect] | None = None) -> Dialect:
    """By name, else by a folder of the path that has a dialect's name, else the first one; case does not count.

    ``known``: library names and the dialect each of their dumps is in; by default the dialects by their own names.
    """
    known = {k.lower(): d for k, d in (known or DIALECTS).items()}
    if name and name.lower() in known:
        return known[name.lower()]
    folders = path.replace("\\", "/").lower().split("/")
    return next((d for k, d in known.items() if k in folders), next(iter(known.values())))


def load(spark: SparkSession, path: str, dialect: Dialect) -> dict[str, DataFrame]:
    """All tables of a dialect from the dump under ``path``, in one pass over its files."""
    return dump.read_tables(spark, path, dialect.tables)


def corrected(rows: DataFrame, replacements: DataFrame, libraries: DataFrame, library: str, key: str, columns: list[str]) -> DataFrame:
    """``columns`` by the replacement table's rows for one library (Library: Id, Name), by ``key``."""
    own = replacements.join(F.broadcast(libraries.where(F.col("Name") == library).select(F.col("Id").alias("LibraryId"))), "LibraryId")  # one row
    return corrections.override(rows, own.groupBy(key).agg(*[F.first(c).alias(c) for c in columns]), key, columns)


def ready_list(spark: SparkSession, path: str) -> DataFrame:
    """Different lines of a list of what is there already."""
    return spark.read.text(path).select(F.col("value").alias("name")).where("name <> ''").distinct()


def write_ready_list(names: DataFrame, path: str) -> None:
    names.select(F.col("name").alias("value")).where("value <> ''").distinct().write.text(path)


def settings(text: Column, schema: str, default: str) -> Column:
    """A settings file's JSON, the default where there is none; what does not parse is empty (all null)."""
    return F.from_json(F.coalesce(F.nullif(text, F.lit("")), F.lit(default)), schema)


def size_option(value: Column, width: Column, height: Column) -> Column:
    """``n`` or ``w,h`` as (width, height); what is neither leaves the values given."""
    parts = F.filter(F.split(F.coalesce(value, F.lit("")), ","), lambda x: x != "")
    w, h = F.get(parts, F.lit(0)).try_cast("int"), F.when(F.size(parts) < 2, F.get(parts, F.lit(0))).otherwise(F.element_at(parts, -1)).try_cast("int")
    good = (F.size(parts) > 0) & w.isNotNull() & h.isNotNull()
    return F.struct(F.when(good, w).otherwise(width).alias("width"), F.when(good, h).otherwise(height).alias("height"))


def archiver_arguments(options: Column, folder: Column) -> Column:
    """Arguments of a command line with the places of source and destination filled in."""
    parts = F.filter(F.split(options, " "), lambda x: x != "")

    def filled(x: Column) -> Column:
        for mark, value in (("src", F.concat(folder, F.lit("/*.fb2"))), ("dst", folder)):
            x = F.replace(F.replace(x, F.lit(f"%{mark}%"), value), F.lit(f"#{mark}#"), value)
        return x

    return F.transform(parts, filled)
