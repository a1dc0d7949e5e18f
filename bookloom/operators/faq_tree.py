"""Multilingual question trees: reading and saving them as JSON, templates, macros, and the validation report.

A tree is rows of path (array of places among siblings, from 0), language, question and answer (text of lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bookloom.sources.shared import stored

#: The language of a template and the types of its entries.
TEMPLATE, MAIN, SUBTITLE = "template", "main", "subtitle"
#: How a line names an image.
IMAGE = r"\[img (\S+?) (\S+?) \S+?\]"


def as_text(value: Column) -> Column:
    """A JSON value (variant) that is a string or an array of strings, as lines of text; null stays null."""
    lines = F.try_variant_get(value, "$", "array<string>")
    return F.when(value.isNull(), None).otherwise(F.coalesce(F.array_join(lines, "\n", ""), F.try_variant_get(value, "$", "string")))


def as_value(text: Column) -> Column:
    """Lines of text as JSON: one line as a string, more as an array of strings."""
    lines = F.split(text, "\n")
    return F.when(F.size(lines) == 1, _quoted(text)).otherwise(F.to_json(lines))


def _quoted(text: Column) -> Column:
    """A JSON string."""
    return F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)


def read_tree(files: DataFrame, json: str = "value") -> DataFrame:
    """file, language, path, question, answer of all items of JSON documents (columns file and ``json``).

    A document is {language, items: [{q, a, items: [...]}]}; the children of an item are read level by level,
    so a tree may have any depth. Documents without a language are an error, as is broken JSON.
    """
    root = files.select("file", F.parse_json(json).alias("v")).select("file", F.try_variant_get("v", "$.language", "string").alias("language"), F.try_variant_get("v", "$.items", "array<variant>").alias("items"))
    checked = F.when(F.coalesce("language", F.lit("")) == "", F.raise_error(F.lit("document language must be specified"))).otherwise(F.col("language"))
    level = stored(root.select("file", checked.alias("language"), F.array().cast("array<int>").alias("up"), "items"))
    out = None
    while level.where("size(items) > 0").limit(1).count():
        rows = level.select("file", "language", "up", F.posexplode("items").alias("row", "v"))
        rows = stored(rows.select("file", "language", F.concat("up", F.array("row")).alias("path"), F.try_variant_get("v", "$.q", "string").alias("question"), as_text(F.try_variant_get("v", "$.a", "variant")).alias("answer"), F.try_variant_get("v", "$.items", "array<variant>").alias("items")))
        own = rows.drop("items")
        out = own if out is None else out.unionByName(own)
        level = rows.select("file", "language", F.col("path").alias("up"), "items")
    return out if out is not None else level.select("file", "language", F.col("up").alias("path"), F.lit(None).cast("string").alias("question"), F.lit(None).cast("string").alias("answer")).where(F.lit(False))


def item_id(path: Column) -> Column:
    """The places from the root down, with slashes."""
    return F.array_join(path.cast("array<string>"), "/")


def saved(tree: DataFrame) -> DataFrame:
    """language, json: each language's tree as one document, children inside their parents, built from the leaves up."""
    rows = stored(tree.withColumn("depth", F.size("path")))
    lines = F.to_json(F.split(F.coalesce("answer", F.lit("")), "\n"))
    head = F.concat(F.lit('{"id":'), _quoted(item_id(F.col("path"))), F.lit(',"q":'), _quoted(F.coalesce("question", F.lit(""))), F.lit(',"a":'), lines)
    below = None
    for depth in range(rows.agg(F.max("depth").alias("n")).first()["n"] or 0, 0, -1):
        own = rows.where(F.col("depth") == depth).select("language", "path", head.alias("head"))
        if below is not None:
            own = own.join(below, ["language", "path"], "left")
            made = F.concat("head", F.coalesce(F.concat(F.lit(',"items":['), "items", F.lit("]")), F.lit("")), F.lit("}"))
        else:
            made = F.concat("head", F.lit("}"))
        child = F.struct(F.element_at("path", -1).alias("row"), made.alias("json"))
        up = F.slice("path", F.lit(1), F.size("path") - 1)
        below = stored(own.groupBy("language", up.alias("path")).agg(F.array_join(F.array_sort(F.collect_list(child))["json"], ",").alias("items")))
    if below is None:
        return tree.select("language", F.lit("").alias("json")).where(F.lit(False))
    return below.select("language", F.concat(F.lit('{"language":'), _quoted(F.col("language")), F.lit(',"items":['), "items", F.lit("]}")).alias("json"))


def filled(text: Column, lines: Column) -> Column:
    """A text whose markers ``%1`` to ``%99`` are replaced in the order of their numbers, each by one of ``lines``; further markers or lines stay out."""
    numbers = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"%(\d{1,2})"), F.lit(1)), lambda n: n.cast("int"))))
    pairs = F.filter(F.arrays_zip(numbers.alias("n"), lines.alias("line")), lambda x: x["n"].isNotNull() & x["line"].isNotNull())
    put = lambda t, x: F.call_function("array_join", F.split(t, F.concat(F.lit("%0?"), x["n"].cast("string"), F.lit(r"(?!\d)"))), F.replace(x["line"], F.lit("%"), F.lit("\x00")))
    return F.replace(F.aggregate(pairs, text, put), F.lit("\x00"), F.lit("%"))


def exported(tree: DataFrame, questions: dict[str, tuple[str, str]], tags: list[tuple[str, str]], head: str = "", tail: str = "", macros: DataFrame | None = None) -> DataFrame:
    """language, html: each language's tree as one document, entries inside the entries that name them.

    An entry's answer in the template goes through ``tags`` (pattern, replacement) in order; its markers are filled
    with the lines of the language's answer, and ``[q0]``, ``[q1]`` ... become the texts of its children. What stands before
    and behind it is chosen by its type, the template's question (``questions``: type -> before, behind, with
    ``#QUESTION#``); entries of other types are left out. ``macros`` (name, language, value) are replaced in
    ``head`` and ``tail``. Built from the leaves up, a level at a time.
    """
    own = tree.where(F.col("language") != TEMPLATE).select("language", "path", "question", "answer")
    shape = tree.where(F.col("language") == TEMPLATE).select("path", F.col("question").alias("type"), F.col("answer").alias("pattern"))
    rows = stored(own.join(shape, "path").withColumn("depth", F.size("path")))
    text = F.coalesce("pattern", F.lit(""))
    for pattern, replacement in tags:
        text = F.regexp_replace(text, pattern, replacement)
    text = filled(text, F.split(F.coalesce("answer", F.lit("")), "\n"))
    asked = lambda x: F.replace(F.lit(x), F.lit("#QUESTION#"), F.coalesce("question", F.lit("")))
    around = lambda side: F.coalesce(*[F.when(F.col("type") == k, asked(x[side])) for k, x in questions.items()], F.lit(""))
    known = F.col("type").isin(*questions)
    below = None
    for depth in range(rows.agg(F.max("depth").alias("n")).first()["n"] or 0, 0, -1):
        level = rows.where(F.col("depth") == depth).select("language", "path", text.alias("text"), around(0).alias("before"), around(1).alias("behind"), known.alias("known"))
        if below is not None:
            level = level.join(below, ["language", "path"], "left")
            inside = F.aggregate(F.coalesce("children", F.array().cast("array<struct<row:int,html:string>>")), F.col("text"), lambda t, c: F.replace(t, F.concat(F.lit("[q"), c["row"].cast("string"), F.lit("]")), c["html"]))
        else:
            inside = F.col("text")
        html = F.when(F.col("known"), F.concat("before", inside, "behind")).otherwise("")
        child = F.struct(F.element_at("path", -1).alias("row"), html.alias("html"))
        up = F.slice("path", F.lit(1), F.size("path") - 1)
        below = stored(level.groupBy("language", up.alias("path")).agg(F.array_sort(F.collect_list(child)).alias("children")))
    if below is None:
        return tree.select("language", F.lit("").alias("html")).where(F.lit(False))
    out = below.select("language", F.array_join(F.col("children.html"), "").alias("body"))
    ends = {"head": F.lit(head), "tail": F.lit(tail)}
    if macros is not None:
        named = macros.groupBy("language").agg(F.array_sort(F.collect_list(F.struct("name", "value"))).alias("macros"))  # a profile's few names
        out = out.join(named, "language", "left")
        given = F.coalesce("macros", F.array().cast("array<struct<name:string,value:string>>"))
        ends = {k: F.aggregate(given, x, lambda t, m: F.replace(t, m["name"], F.coalesce(m["value"], F.lit("")))) for k, x in ends.items()}
    return out.select("language", F.concat(ends["head"], "body", ends["tail"]).alias("html"))


def aligned(tree: DataFrame, languages: list[str]) -> DataFrame:
    """path and, for each language, its question and answer (``q_`` and ``a_`` columns), by place in the tree."""
    pick = lambda c, x: F.max(F.when(F.col("language") == x, F.col(c)))
    return tree.groupBy("path").agg(*[pick(c, x).alias(f"{c[0]}_{x}") for x in languages for c in ("question", "answer")])


def incomplete(rows: DataFrame, languages: list[str], new_item: str) -> DataFrame:
    """Aligned rows with any language's question or answer missing, empty or still the text of a new item."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    bad = F.lit(False)
    for x in languages:
        bad = bad | empty(f"a_{x}") | empty(f"q_{x}") | (F.coalesce(F.col(f"q_{x}"), F.lit("")) == new_item)
    return rows.where(bad)


def template(tree: DataFrame) -> DataFrame:
    """The tree's shape as a template: entries of the first level are of one type, deeper ones of another, all empty."""
    kind = F.when(F.size("path") == 1, MAIN).otherwise(SUBTITLE)
    return tree.select("path").distinct().select(F.lit(TEMPLATE).alias("language"), "path", kind.alias("question"), F.lit("").alias("answer"))


def images(answer: Column) -> Column:
    """Files that a text's lines name, the first one of each line."""
    found = F.transform(F.split(answer, "\n"), lambda x: F.when(x.rlike(IMAGE), F.concat(F.lit("img/"), F.regexp_extract(x, IMAGE, 1), F.lit("/"), F.regexp_extract(x, IMAGE, 2), F.lit(".jpg"))))
    return F.filter(found, lambda x: x.isNotNull())


def report(tree: DataFrame, languages: list[str], files: DataFrame, new_item: str = "New item") -> DataFrame:
    """path, language, problem, detail: what a tree's languages and images (``files``: file) lack.

    Empty questions and answers, images named by the template's answer that are not there, answers whose
    numbers of lines differ between languages, and files that no answer names.
    """
    empty = F.coalesce(F.col("text"), F.lit("")) == ""
    own = tree.where(F.col("language").isin(languages))
    every = tree.select("path").distinct().select("path", F.explode(F.array(*map(F.lit, languages))).alias("language"))
    texts = every.join(own, ["path", "language"], "left")
    asked = texts.withColumn("text", F.col("question")).where(empty | (F.col("text") == new_item)).select("path", "language", F.lit("empty question").alias("problem"), F.lit(None).cast("string").alias("detail"))
    told = texts.withColumn("text", F.col("answer")).where(empty).select("path", "language", F.lit("empty answer").alias("problem"), F.col("question").alias("detail"))
    lines = F.size(F.split(F.coalesce("answer", F.lit("")), "\n"))
    differ = texts.groupBy("path").agg(F.countDistinct(lines).alias("n")).where("n > 1").select("path", F.lit(None).cast("string").alias("language"), F.lit("different numbers of lines").alias("problem"), F.lit(None).cast("string").alias("detail"))
    named = tree.where(F.col("language") == TEMPLATE).select("path", F.explode(images(F.col("answer"))).alias("file"))
    lost = named.join(files, "file", "left_anti").select("path", F.lit(None).cast("string").alias("language"), F.lit("image lost").alias("problem"), F.col("file").alias("detail"))
    none = F.lit(None).cast("array<int>")
    unused = files.join(named, "file", "left_anti").select(none.alias("path"), F.lit(None).cast("string").alias("language"), F.lit("unexpected file").alias("problem"), F.col("file").alias("detail"))
    return asked.unionByName(told).unionByName(differ).unionByName(lost).unionByName(unused)


def parsed_macros(text: Column) -> Column:
    """Macros written as lines ``name=value`` (a name has a character at least), as array of (name, value)."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.locate("=", x) > 1)
    return F.transform(lines, lambda x: F.struct(F.substring_index(x, "=", 1).alias("name"), x.substr(F.locate("=", x) + 1, F.char_length(x)).alias("value")))


def set_macros(macros: DataFrame, language: str, lines: str) -> DataFrame:
    """Macros (name, language, value) after one language's were written anew; names empty in all languages go."""
    one = macros.sparkSession.createDataFrame([(lines,)], "text string").select(F.inline(parsed_macros(F.col("text")))).select("name", F.lit(language).alias("language"), "value")
    new = one.groupBy("name", "language").agg(F.last("value").alias("value"))
    merged = macros.join(new, ["name", "language"], "left_anti").select("name", "language", "value").unionByName(new)
    used = merged.where("coalesce(value, '') <> ''").select("name").distinct()
    return merged.join(used, "name", "left_semi")


def macro_lines(macros: DataFrame, language: str) -> DataFrame:
    """text: all macros of a language as lines ``name=value``, by name."""
    value = F.coalesce(F.max(F.when(F.col("language") == language, F.col("value"))), F.lit(""))
    named = macros.groupBy("name").agg(value.alias("value"))
    return named.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "name", "value"))), "\n").alias("text"))


def line_of_argument(text: Column, number: Column) -> Column:
    """Place (from 0) of the first line that holds ``%number``, -1 if none does."""
    return (F.array_position(F.transform(F.split(text, "\n"), lambda x: F.contains(x, F.concat(F.lit("%"), number.cast("string")))), True) - 1).cast("int")


def output_name(file: Column, name: Column, extension: Column) -> Column:
    """A profile's own file name, else the base name with its extension, else with html."""
    base = F.regexp_replace(F.regexp_extract(file, r"([^/]*)$", 1), r"\.[^.]*$", "")
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(base, F.lit("."), F.coalesce(F.nullif(extension, F.lit("")), F.lit("html"))))


def languages_to_add(languages: DataFrame, added: DataFrame, unknown: str = "un") -> DataFrame:
    """key, title of languages (key, title, priority) not yet added, by priority and title."""
    left = languages.where(F.col("key") != unknown).join(added.select("key").distinct(), "key", "left_anti")
    return left.orderBy("priority", "title").select("key", "title")
