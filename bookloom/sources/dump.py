"""Database dumps of INSERT statements as DataFrames.

A statement ends at a semicolon outside a string and the line end after it. Spark's reader cuts files into
chunks of lines that many tasks read; whether a chunk begins inside a string depends on all before it. So each
chunk is first read for both cases, which makes it a function from the state at its start to that at its end;
the functions of a file are composed by running sums over its chunks (a prefix scan), and then every chunk is
cut into statements on its own. Only the statement that lies across a chunk's end is shuffled, in parts. Values
are read by one regular expression, not by a SQL parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from bookloom.sources.shared import stored

_VALUE = re.compile(r"'((?:[^'\\]|\\.|'')*)'|(NULL)|([^\s,()';]+)|(\))|(;)", re.S | re.I)
_ESCAPE = re.compile(r"\\(.)|''", re.S)
_CLOSE = re.compile(r"(?:[^'\\]++|\\.)*+'", re.S)
_INSERT = re.compile(r"\s*INSERT\s+INTO\s+`?([^`\s(]+)`?[\s(]", re.I)
_STATEMENT = re.compile(r"(?:'(?:[^'\\]++|\\.)*+'|[^';]++)++", re.S)
#: Escapes with a meaning of their own.
_MEANS = {"n": "\n", "r": "\r", "t": "\t", "0": "\0", "Z": "\x1a", "b": "\b"}


def literal(value: Column) -> Column:
    """A value as a literal: strings escaped so that they hold no line feed."""
    text = value.cast("string")
    for raw, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return F.when(value.isNull(), "NULL").otherwise(F.concat(F.lit("'"), text, F.lit("'")))


def statement(name: str, *values: Column) -> Column:
    return F.concat(F.lit(f"INSERT INTO `{name}` VALUES ("), F.array_join(F.array(*map(literal, values)), ","), F.lit(");"))


def rows_of(text: str) -> Iterator[list[str | None]]:
    """Rows of the VALUES part of one statement."""
    row: list[str | None] = []
    for m in _VALUE.finditer(text):
        if m[4]:
            yield row
            row = []
        elif m[5]:
            return
        elif m[1] is not None:
            row.append(_ESCAPE.sub(lambda e: "'" if e[1] is None else _MEANS.get(e[1], e[1]), m[1]))
        else:
            row.append(None if m[2] else m[3])


def _inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside a string (or not) ends inside one."""
    at = 0
    if "'" not in line:
        return inside
    while True:
        if inside:
            if (m := _CLOSE.match(line, at)) is None:
                return True
            at, inside = m.end(), False
        else:
            at = line.find("'", at) + 1
            if not at:
                return False
            inside = True


def _step(line: str, inside: bool) -> tuple[bool, bool]:
    """(whether the line ends inside a string, whether a statement ends with it); comment lines outside strings say nothing."""
    if _comment(line, inside):
        return False, False
    inside = _inside(line, inside)
    return inside, not inside and line.rstrip().endswith(";")


def _comment(line: str, inside: bool) -> bool:
    return not inside and line.startswith(("--", "#"))


def inserted(text: str, wanted: set[str] | None = None) -> Iterator[tuple[str, list[str | None]]]:
    """(table, values) of every row of the INSERT statements in a text; other statements give none."""
    for one in _STATEMENT.findall(text):
        name = _INSERT.match(one)
        if name is None or wanted is not None and name[1].lower() not in wanted:
            continue
        body = re.split(r"(?i)\bVALUES\b", one, maxsplit=1)
        for row in rows_of(body[1]) if len(body) == 2 else ():
            yield name[1].lower(), row


def _chunks(lines: DataFrame) -> DataFrame:
    """file, start, inside (whether the chunk begins inside a string), begin (where the statement that is open there began, -1: in the first chunk)."""

    def both_ways(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state, ends = None, [False, True], [False, False]
        for batch in batches:
            done = []
            for file, start, line in zip(batch["file"], batch["start"], batch["value"]):
                if (file, start) != at:
                    if at is not None:
                        done.append((*at, *state, *ends))
                    at, state, ends = (file, start), [False, True], [False, False]
                one = _step(line, state[0])
                other = one if state[0] == state[1] else _step(line, state[1])
                state, ends = [one[0], other[0]], [ends[0] or one[1], ends[1] or other[1]]
            yield pd.DataFrame(done, columns=names)
        yield pd.DataFrame([] if at is None else [(*at, *state, *ends)], columns=names)

    names = ["file", "start", "from_outside", "from_inside", "ends_outside", "ends_inside"]
    read = lines.mapInPandas(both_ways, "file string, start long, from_outside boolean, from_inside boolean, ends_outside boolean, ends_inside boolean")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    # a chunk that ends alike from both states sets the state, one that turns it is counted, any other leaves it
    turns = F.coalesce(F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("int")).over(upto), F.lit(0))
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.struct("start", F.col("from_outside").cast("int").alias("value"), "turns"))
    scan = read.withColumn("turns", turns).withColumn("fixed", F.max(fixed).over(before)).withColumn("turned", F.coalesce(F.lag("turns").over(Window.partitionBy("file").orderBy("start")), F.lit(0)))
    odd = (F.coalesce(F.col("fixed.value"), F.lit(0)) + F.col("turned") - F.coalesce(F.col("fixed.turns"), F.lit(0))) % 2 == 1
    known = scan.withColumn("inside", odd).withColumn("ends", F.when(odd, F.col("ends_inside")).otherwise(F.col("ends_outside")))
    return known.select("file", "start", "inside", F.coalesce(F.max(F.when(F.col("ends"), F.col("start"))).over(before), F.lit(-1).cast("long")).alias("begin"))


def _values(spark: SparkSession, path: str, wanted: set[str] | None, broadcast_chunks: int = 100_000) -> DataFrame:
    """table (lower case), file, values of every row of the tables ``wanted`` (None: all).

    Two maps over the files and a shuffle of the statements that lie across chunks. The chunks' states, some 150 bytes each, are
    broadcast up to ``broadcast_chunks`` of them (13 TB in chunks of 128 MB); beyond that lines are shuffled by chunk.
    """
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    chunks = stored(_chunks(lines))
    if chunks.count() <= broadcast_chunks:
        placed = lines.join(F.broadcast(chunks), ["file", "start"])
    else:
        placed = lines.withColumn("at", F.monotonically_increasing_id()).join(chunks, ["file", "start"]).repartition("file", "start").sortWithinPartitions("file", "start", "at")
    columns = ["file", "begin", "start", "part", "table", "values"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of whole statements; as parts the lines up to a chunk's first statement end and those behind its last."""
        at, inside, begin, held, ended, out = None, False, -1, [], False, []

        def rest():
            if held:
                out.append((at[0], at[1] if ended else begin, at[1], "\n".join(held), None, None))

        for batch in batches:
            for file, start, state, first, line in zip(*(batch[c].tolist() for c in ("file", "start", "inside", "begin", "value"))):
                if (file, start) != at:
                    rest()
                    at, inside, begin, held, ended = (file, start), state, first, [], False
                if _comment(line, inside):
                    continue
                held.append(line)
                inside, end = _step(line, inside)
                if end:
                    text = "\n".join(held)
                    out.extend((file, begin, start, None, *row) for row in inserted(text, wanted)) if ended else out.append((file, begin, start, text, None, None))
                    held, ended = [], True
                    if len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=columns)
                        out.clear()
        rest()
        yield pd.DataFrame(out, columns=columns)

    found = stored(placed.select("file", "start", "inside", "begin", "value").mapInPandas(cut, "file string, begin long, start long, part string, table string, values array<string>"))
    # a statement's parts in the order of their chunks
    whole = found.where("part is not null").groupBy("file", "begin").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "part"))), lambda x: x["part"]), "\n").alias("text"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(name, file, row) for file, text in zip(batch["file"], batch["text"]) for name, row in inserted(text, wanted)]
            yield pd.DataFrame(rows, columns=["table", "file", "values"])

    return found.where("part is null").select("table", "file", "values").unionByName(whole.select("file", "text").mapInPandas(parse, "table string, file string, values array<string>"))


def _fields(spark: SparkSession, schema: str) -> list[T.StructField]:
    return list(spark.createDataFrame([], schema).schema)


def _typed(rows: DataFrame, fields: list[T.StructField]) -> DataFrame:
    return rows.where(F.size("values") == len(fields)).select(*[F.get("values", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def read_tables(spark: SparkSession, path: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """The tables of ``schemas`` (name -> schema of the values of an INSERT) from all files under ``path``, read in one pass.

    Other statements and comment lines are ignored; names match in any case. Rows with another number of values
    than the schema has columns are left to ``bad_records``. Values that do not fit their type are null.
    """
    rows = stored(_values(spark, path, {x.lower() for x in schemas}), partition="table")
    return {name: _typed(rows.where(F.col("table") == name.lower()), _fields(spark, schema)) for name, schema in schemas.items()}


def read(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """Rows of table ``name``, as in ``read_tables``."""
    return _typed(_values(spark, path, {name.lower()}), _fields(spark, schema))


def bad_records(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """file, values of the rows that ``read`` leaves out."""
    return _values(spark, path, {name.lower()}).where(F.size("values") != len(_fields(spark, schema))).select("file", "values")
