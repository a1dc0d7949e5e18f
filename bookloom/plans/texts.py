"""Plans over texts, names and page links."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookloom.functions import text as tx
from bookloom.plans.registry import query, table

WRAP = "'x [b]' || text || '[/b] [QUOTE]q[/quote] [url=http://a.b/c]link[/url] see http://x.y/z now [color=red]r[/color] [img]p.png[/img]' || chr(10) || chr(10) || 'end'"


TAGS = rf"""WITH a AS (SELECT doc_id, ' ' || {WRAP} || ' ' AS t FROM documents),
 b AS (SELECT doc_id, replace(regexp_replace(regexp_replace(regexp_replace(t, '\n\n+', chr(10), 'g'), '\n', '<br/>', 'g'), '\[(\w)\]', '<\1>', 'g'), '[/b]', '</b>') AS t FROM a),
 c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\[quote\]', '<q>', 'gi'), '\[/quote\]', '</q>', 'gi') AS t FROM b),
 d AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\[img\](.*?)\[/img\]', '<img src="\1"/>', 'g'), '\[(?:URL|url)=(.*?)\](.*?)\[/(?:URL|url)\]', '<a href="\1"/>\2</a>', 'g') AS t FROM c),
 e AS (SELECT doc_id, replace(regexp_replace(t, '\[color=(.*?)\]', '<font color="\1">', 'g'), '[/color]', '</font>') AS t FROM d)
SELECT doc_id, trim(regexp_replace(regexp_replace(t, '([^"])(https?://\S+?)([\s<])', '\1<a href="\2">\2</a>\3', 'g'), '\s+', ' ', 'g')) AS html FROM e"""


def tagged(spark, sf_dir, text):
    text = F.concat(F.lit("x [b]"), text, F.lit("[/b] [QUOTE]q[/quote] [url=http://a.b/c]link[/url] see http://x.y/z now [color=red]r[/color] [img]p.png[/img]\n\nend"))
    return table(spark, sf_dir, "documents").select("doc_id", tx.replace_tags(text).alias("html"))


@query("replace_tags", TAGS)
def replace_tags(spark, sf_dir):
    return tagged(spark, sf_dir, F.col("text"))


@query("replace_tags_whole", TAGS)
def replace_tags_whole(spark, sf_dir):
    """The same under its other name."""
    return tagged(spark, sf_dir, F.col("text"))


DASHES = r"""SELECT doc_id, regexp_replace(translate(text || ' — a -- b ё', '‐‑‒–—―ёЁ', '------еЕ'), ' --? ', ' – ', 'g') AS folded FROM documents"""


@query("dash_fold", DASHES)
def dash_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.dash_fold(F.concat("text", F.lit(" — a -- b ё"))).alias("folded"))


@query("dash_fold_whole", DASHES)
def dash_fold_whole(spark, sf_dir):
    """The same under its other name."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.dash_fold(F.concat("text", F.lit(" — a -- b ё"))).alias("folded"))


@query("title_words", r"""WITH w AS (SELECT item_id, unnest(string_split_regex(replace(lower(text), 'ё', 'е'), '[^\p{L}\p{N}]+')) AS w FROM benchmark) SELECT item_id, string_agg(DISTINCT w, ' ' ORDER BY w) AS words FROM w WHERE w <> '' GROUP BY 1""")
def title_words(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(tx.title_tokens(F.col("text")), " ").alias("words"))


@query("magic_sniff", "SELECT CASE WHEN lower(ltrim(html)) LIKE '<!doctype html%' OR lower(ltrim(html)) LIKE '<html%' THEN 'html' ELSE 'other' END AS kind, count(*) AS n FROM pages GROUP BY 1")
def magic_sniff(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(tx.signature(F.substring("html", 1, 64)).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("regex_links", r"""WITH l AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="(/[^"]+)"', 1))) AS link FROM pages) SELECT link, count(*) AS n FROM l WHERE link NOT IN (SELECT link FROM l WHERE page_id = 0) GROUP BY 1""")
def regex_links(spark, sf_dir):
    """Links of pages, each once per page, without those that are ready already."""
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r'href="(/[^"]+)"'), F.lit(1)))).alias("link"))
    ready = links.where("page_id = 0").select("link")
    return links.join(ready, "link", "left_anti").groupBy("link").agg(F.count(F.lit(1)).alias("n"))


@query("sidecar_join", """WITH p AS (SELECT page_id, CAST(page_id % 50 AS VARCHAR) || '.fb2' AS name FROM pages), s AS (SELECT CAST(item_id AS VARCHAR) || CASE WHEN item_id % 2 = 0 THEN '.fb2.fbd' ELSE '.fbd' END AS name, item_id FROM benchmark)
SELECT page_id, coalesce(a.item_id, b.item_id) AS sidecar FROM p LEFT JOIN s a ON a.name = p.name || '.fbd' LEFT JOIN s b ON b.name = replace(p.name, '.fb2', '.fbd')""")
def sidecar_join(spark, sf_dir):
    """A file's description beside it: under its full name, else under its base name."""
    files = table(spark, sf_dir, "pages").select("page_id", F.concat((F.col("page_id") % 50).cast("string"), F.lit(".fb2")).alias("name"))
    side = table(spark, sf_dir, "benchmark").select(F.concat(F.col("item_id").cast("string"), F.when(F.col("item_id") % 2 == 0, ".fb2.fbd").otherwise(".fbd")).alias("name"), "item_id")
    full, base = side.toDF("n1", "i1"), side.toDF("n2", "i2")
    out = files.join(full, F.concat("name", F.lit(".fbd")) == F.col("n1"), "left").join(base, F.concat(tx.base_name(F.col("name")), F.lit(".fbd")) == F.col("n2"), "left")
    return out.select("page_id", F.coalesce("i1", "i2").alias("sidecar"))


@query("template_fill", "SELECT n_nationkey, n_name || ' of ' || CAST(n_regionkey AS VARCHAR) || ' (' || n_name || ')' AS line FROM nation")
def template_fill(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", tx.fill(F.lit("%1 of %2 (%1)"), F.col("n_name"), F.col("n_regionkey").cast("string")).alias("line"))


@query("unescape_twice", r"""SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html || ' &amp;lt;b&amp;gt; &QUOT;', '&lt;', '<', 'gi'), '&gt;', '>', 'gi'), '&quot;', '"', 'gi'), '&apos;', '''', 'gi'), '&amp;', '&', 'gi')) AS digest FROM pages""")
def unescape_twice(spark, sf_dir):
    """Pages whose entities lose one level of escaping, by digest."""
    twice = F.concat("html", F.lit(" &amp;lt;b&amp;gt; &QUOT;"))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(tx.unescape_twice(twice).cast("binary")).alias("digest"))


@query("image_best_version", """SELECT name, max_by(vec_id, (size, vec_id)) AS vec_id, max(size) AS size FROM (SELECT vec_id, label AS name, CAST(floor(abs(embedding[1]) * 1000) AS BIGINT) AS size FROM embeddings) GROUP BY 1""")
def image_best_version(spark, sf_dir):
    """The largest body of each name; of equal ones the larger id."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("name"), F.floor(F.abs(F.get("embedding", F.lit(0))) * 1000).alias("size"))
    return rows.groupBy("name").agg(F.max_by("vec_id", F.struct("size", "vec_id")).alias("vec_id"), F.max("size").alias("size"))


@query("scaled_sizes", "SELECT p_partkey, CAST(floor(p_size * 40 * least(1024.0 / (p_size * 40), 480.0 / (p_size * 25), 1)) AS BIGINT) AS width, CAST(floor(p_size * 25 * least(1024.0 / (p_size * 40), 480.0 / (p_size * 25), 1)) AS BIGINT) AS height FROM part")
def scaled_sizes(spark, sf_dir):
    """Sizes after scaling down into 1024 by 480 with the aspect ratio kept."""
    w, h = (F.col("p_size") * 40).cast("double"), (F.col("p_size") * 25).cast("double")
    ratio = F.least(1024.0 / w, 480.0 / h, F.lit(1.0))
    return table(spark, sf_dir, "part").select("p_partkey", F.floor(w * ratio).alias("width"), F.floor(h * ratio).alias("height"))


@query("cursor_places", """SELECT conv_id, turn, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM conversations""")
def cursor_places(spark, sf_dir):
    from pyspark.sql import Window

    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(F.sum(F.char_length("text") + 1).over(before), F.lit(0)).cast("long").alias("place"))


@query("line_count_votes", r"""SELECT role, count(DISTINCT len(string_split(text, chr(10)))) AS kinds, bool_or(text = '') AS any_empty, bool_and(length(text) > 3) AS all_long FROM conversations GROUP BY 1""")
def line_count_votes(spark, sf_dir):
    lines = F.size(F.split("text", "\n"))
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.countDistinct(lines).alias("kinds"), F.bool_or(F.col("text") == "").alias("any_empty"), F.bool_and(F.char_length("text") > 3).alias("all_long"))


@query("repair_tail", """SELECT page_id, md5(CASE WHEN page_id % 3 = 0 THEN substr(html, 1, strpos(html, '</article>') + 9) WHEN page_id % 3 = 1 THEN split_part(html, '</article>', 1) || '</body></article>' ELSE split_part(html, '</article>', 1) || '</article>' END) AS digest FROM pages WHERE strpos(html, '</article>') > 0""")
def repair_tail(spark, sf_dir):
    """Pages cut after the end tag of their article; of some it is lost, and a body's end or a binary's beginning tells where to cut."""
    from bookloom.sources import markup

    pages = table(spark, sf_dir, "pages").where(F.contains("html", F.lit("</article>")))
    head = F.substring_index("html", "</article>", 1)
    broken = F.when(F.col("page_id") % 3 == 0, F.col("html")).when(F.col("page_id") % 3 == 1, F.concat(head, F.lit("</body>torn off"))).otherwise(F.concat(head, F.lit("<binary id='1'>torn off")))
    return pages.select("page_id", F.md5(markup.repair_tail(broken, "article").cast("binary")).alias("digest"))


@query("encoding_vote", """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'utf-16le' WHEN 2 THEN 'koi8-r' ELSE 'cp1251' END AS encoding FROM documents""")
def encoding_vote(spark, sf_dir):
    """Bodies in four encodings: valid UTF-8, one with a byte order mark, one that declares itself, and Cyrillic letters that only the vote can tell."""
    from bookloom.sources import markup

    text, kind = F.coalesce("text", F.lit("")), F.col("doc_id") % 4
    letters = F.regexp_replace(F.translate(F.lower(text), "abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстувщхыз"), r"[^а-я ]", "")
    single = F.array_join(F.transform(F.split(letters, ""), lambda c: F.when(c == " ", "20").when(c == "", "").otherwise(F.hex((F.ascii(c) - 848).cast("long")))), "")  # as bytes of cp1251
    body = F.when(kind == 1, F.concat(F.unhex(F.lit("FFFE")), F.encode(text, "UTF-16LE"))).when(kind == 2, F.concat(F.lit('<?xml version="1.0" encoding="KOI8-R"?>').cast("binary"), text.cast("binary"))).when(kind == 3, F.unhex(F.concat(single, F.lit("E0E1E2")))).otherwise(text.cast("binary"))
    return table(spark, sf_dir, "documents").select("doc_id", markup.encoding(body).alias("encoding"))
