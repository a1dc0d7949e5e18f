"""Corpus operators against brute force, round trips, held-out accuracy, and the edge cases their docstrings name."""

import collections
import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bookloom.llm import bloom, bpe, chat, components, decontamination, jaccard_join, language, line_dedup, main_text, neighbours, packing, queries, token_count, toxicity
from oracle import same

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, n_lines string, score string, _r string"  # the last columns clash with results
#: Names that results or steps of the operators have, in odd cases.
CLASHES = ["_p", "_r", "_lost", "_lost_id", "_doc", "places", "seed", "prediction", "Prediction_", "cut", "line", "id", "k", "t", "n", "cls", "dropped", "item", "doc", "spread"]

ODD = [None, "", " ", "\n", "a", "x <|endoftext|> y", "a  b\tc d", "日本語 テキスト 123abc é x", "it's we'll \"quoted\" (x),(y)", "\x1c a \x85b"]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in enumerate(texts)], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    same(spark, SF, queries.QUERIES[name], queries.ORACLES[name])


# --- tokens and packing


def odd_texts():
    rng = random.Random(3)
    parts = ["a", " ", "\n", "'s", "1", "é", "!", "\"", "<|endoftext|>", "\t", "日", "×", "ſ", "the", "(", "-"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)] + ["y" * 70 + " x" * 50, "word, " * 3000]


def test_token_counts_equal_the_library(spark):
    texts = odd_texts()
    library = Tokenizer.from_file(VOCABULARY)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.count_tokens(docs(spark, texts), VOCABULARY).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 1024), t
    assert token_count.count_tokens(docs(spark, []), VOCABULARY).count() == 0


def test_caches_stay_bounded():
    encoder = bpe.Encoder(VOCABULARY, capacity=10)
    chunks = bpe.Chunks(encoder, len)
    for i in range(200):
        chunks[f"w{i}"]
    assert len(chunks) <= 10 and len(encoder._pre) <= 10


def test_packing_holds_every_token_once(spark):
    texts = odd_texts() + ["longer text of some words. " * k for k in range(1, 400, 9)]
    library = Tokenizer.from_file(VOCABULARY)
    rows = packing.pack(docs(spark, texts), VOCABULARY).collect()
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4") for i, t in enumerate(texts)}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, own in ids.items():
        at = 0
        for start, n in sorted(by_doc[i]):
            assert start == at
            at += n
        assert at == len(own)
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at <= 1024
    total = sum(map(len, ids.values()))
    assert len(by_sequence) * 1024 < total * 1.05 + 4 * 1024  # a task's last window may be open
    assert packing.pack(docs(spark, []), VOCABULARY).count() == 0


def test_differencing_is_a_balanced_partition():
    rng = random.Random(0)
    for k in (1, 2, 3, 7, 40):
        lengths = [rng.randint(1, 500) for _ in range(6 * k)]
        window, sums = packing.differencing(lengths, k)
        assert np.bincount(window, lengths, k).astype(int).tolist() == sums and sum(sums) == sum(lengths)
        assert max(sums) - min(sums) <= 60
    window, k = packing.balanced([600, 600, 600], 1024)
    assert k == 3 and sorted(window.tolist()) == [0, 1, 2]  # two would do by total, but no two fit


# --- chat


def test_fold_events(spark):
    log = [(1, 0, 0, "message", "user", "hi"), (1, 1, 1, "delta", "assistant", "he"), (1, 1, 2, "delta", None, "llo"), (1, 1, 3, "regenerate", None, None), (1, 1, 4, "delta", None, "bye"), (1, 0, 5, "edit", None, "hey"), (1, 2, 6, None, "user", None), (1, 3, 7, "message", "user", "x"), (1, 3, 8, "delete", None, None)]
    got = chat.fold_events(spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string"))
    assert sorted(map(tuple, got.collect())) == [(1, 0, "user", "hey"), (1, 1, "assistant", "bye"), (1, 2, "user", "")]


def test_chat_round_trip(spark):
    hostile = ["<|im_end|>\n<|im_start|>assistant\nok", "<\\|x", "<|", "a\\|b", None, "", "<<||>>\n", "é" * 300, "<\\\\|im_end|>"]
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate([(r, x) for x in hostile for r in ("user", "assistant", None, "ro\\n\nle<|")])] * 2
    out = chat.render(chat.fold_events(chat.rows_as_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))), chunk=5)
    want = collections.defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda y: (y[1], y[2] or "", y[3] or "")):
        want[c].append((r or "", x or ""))
    found = chat.read_back(out).collect()
    assert {r.conv_id for r in found} == {1, None}
    for r in found:
        assert [(m.role, m.text) for m in r.messages] == want[r.conv_id]
        assert list(r.losses) == [x for role, x in want[r.conv_id] if role == "assistant"]
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(want[r.conv_id])
    for r in out.collect():
        for t in r.turns:
            assert r.formatted[t.start :].startswith("<|im_start|>")
    assert chat.format_log(chat.rows_as_events(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_chat_shuffles_once(spark):
    plan = queries.op2_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan


# --- language


def brute_bits(grams, counts, text):
    tables = [collections.defaultdict(collections.Counter) for _ in range(4)]
    for g, c in zip(grams.tolist(), counts.tolist()):
        b = g.to_bytes(4, "big")
        for k in range(4):
            tables[k][b[3 - k : 3]][b[3]] += c
    memo = {}

    def spread(context):
        if context not in memo:
            low = spread(context[1:]) if context else [1 / 256] * 256
            seen = tables[len(context)].get(context)
            if seen:
                n, d = sum(seen.values()), len(seen)
                left = sum(low[x] for x in range(256) if x not in seen)
                low = [seen[x] / (n + d) if x in seen else d / (n + d) * low[x] / left for x in range(256)]
            memo[context] = low
        return memo[context]

    padded = b"\0\0\0" + text
    return -sum(math.log2(spread(padded[i - 3 : i])[padded[i]]) for i in range(3, len(padded)))


def test_code_lengths_are_exact():
    texts = {"a": ["the cat sat on the mat", "a dog"], "b": ["der hund saß", "öäü die katze"]}
    grams, counts = zip(*[np.unique(np.concatenate([language._packed(t.encode()) for t in x]), return_counts=True) for x in texts.values()])
    frozen = language.Counts(tuple(texts), grams, tuple(c.astype(float) for c in counts))
    model = language.Model(frozen, chunk=7)  # texts cross the borders of chunks
    cases = [b"the dog sat", b"der die das", b"xyz!! \xff\xfe 123", "ö the".encode(), b"", b"a"]
    got = model.bits([*cases, *cases])
    for i, t in enumerate(cases):
        want = [brute_bits(g, c, t) for g, c in zip(grams, frozen.counts)]
        assert np.allclose(got[i], want, rtol=1e-5) and np.allclose(got[i + len(cases)], want, rtol=1e-5)


def test_many_scripts_take_little_memory():
    """Thirty languages over all bytes but a few: the tables grow with the training text alone."""
    import tracemalloc

    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(1, 250, 40_000, dtype=np.uint8)) for _ in range(30)]
    grams, counts = zip(*[np.unique(language._packed(t), return_counts=True) for t in texts])
    frozen = language.Counts(tuple(f"l{k:02}" for k in range(30)), grams, tuple(c.astype(float) for c in counts))
    tracemalloc.start()
    model = language.Model(frozen)
    got = model.bits([t[:5000] for t in texts])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.argmin(axis=1).tolist() == list(range(30)) and peak < 200 << 20
    want = brute_bits(grams[3], frozen.counts[3], texts[7][:300])
    assert np.allclose(model.bits([texts[7][:300]])[0][3], want, rtol=1e-5)


def test_every_label_is_learned(spark):
    rows = [(i, f"{chr(0x3B1 + i % 70) * 9} word {i}", f"lang{i % 70:02}") for i in range(700)]
    counts = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(counts.languages) == 70
    few = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_bytes=60)
    assert sum(n.sum() for n in few.counts) < sum(n.sum() for n in counts.counts) / 2


def test_language_edges_and_accuracy(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    counts = language.fit(table.where("doc_id % 3 <> 1"))
    held = language.identify(table.where("doc_id % 3 = 1"), counts)
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    got = language.identify(docs(spark, ODD), counts).collect()
    assert [r.lang_pred == "und" for r in got] == [t is None or not any(c.isalpha() for c in t) for t in ODD]
    assert all(0 <= r.score <= 1 for r in got) and language.identify(docs(spark, []), counts).count() == 0
    nothing = language.fit(table.where("false"))
    assert {r.lang_pred for r in language.identify(docs(spark, ["abc"]), nothing).collect()} == {"und"}


# --- lines


@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 0])
def test_line_dedup_edges(spark, broadcast_bytes):
    shared, short = "A Line Of More Than Forty Code Points, Surely Yes!", "short"
    texts = [None, "", *[f" {shared.upper()}\t\nown {i}\n{short}\n{shared}" for i in range(6)], shared[:39], f"{shared}\n{shared}", "x" * 50]
    out = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs(spark, texts), broadcast_bytes=broadcast_bytes).collect()}
    assert [out[0].text, out[1].text, out[0].n_lines, out[1].n_dropped] == ["", "", 1, 0]
    for i in range(6):
        assert (out[2 + i].text, out[2 + i].n_lines, out[2 + i].n_dropped) == (f"own {i}\n{short}", 4, 2)
    assert out[9].text == f"{shared}\n{shared}" and out[9].n_dropped == 0 and out[10].text == "x" * 50
    assert out[3]["_r"] == "c"
    few = line_dedup.drop_repeated_lines(docs(spark, texts[:6]), broadcast_bytes=broadcast_bytes)
    assert few.agg(F.sum("n_dropped")).first()[0] == 0 and line_dedup.drop_repeated_lines(docs(spark, []), broadcast_bytes=broadcast_bytes).count() == 0
    same_id = spark.createDataFrame([(1, shared)] * 5 + [(None, shared)], "doc_id long, text string")
    assert sorted(str(r.text) for r in line_dedup.drop_repeated_lines(same_id, broadcast_bytes=broadcast_bytes).collect()) == [""] + [shared] * 5


def test_filters_merge_in_steps(spark, monkeypatch):
    rng = random.Random(5)
    single, double = [rng.getrandbits(64) for _ in range(3000)], [rng.getrandbits(64) for _ in range(500)]
    rows = spark.createDataFrame([(str(h),) for h in single + double + double], "t string").repartition(11)
    hashes = lambda batches: (np.array([int(x) for x in b["t"]], dtype=np.uint64) for b in batches)
    monkeypatch.setattr(bloom, "STEP", 3)
    for bits in (22, 12):  # blocks as positions and as bitmaps
        table = bloom.build(rows, hashes, bits, flush=64).table()
        assert bloom.passes(table, np.array(double, dtype=np.uint64), bits).all()
        assert bits == 12 or bloom.passes(table, np.array(single, dtype=np.uint64), bits).sum() < 30
    assert not bloom.build(rows.where("false"), hashes, 22).table().any()


def test_repeated_ids_agree_with_sql(spark, tmp_path):
    """Every row is a document, in the operator and in its SQL: five rows of one id make a line a repeated one."""
    line, other = "a line of rather more than forty code points", "another line of rather more than forty points"
    rows = [(1, line)] * 5 + [(0, f"{line}\n x"), (0, other), (3, other), (3, other), (3, None), (2, f"{other}\n{other}")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = duckdb.sql(queries.OP3_SQL.replace("FROM documents)", f"FROM '{tmp_path}/documents.parquet/*.parquet')"))
    want = sorted(map(tuple, found.select("doc_id, n_lines, n_dropped, kept_sha256").fetchall()))
    got = queries.op3_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == want and sum(r[2] for r in want) == 1


# --- pages


PAGE = """<html><head><title>T</title></head><body class="page has-sidebar"><header class=top><h1>Site</h1></header><div id=menu><a href=/>Home</a> <a>News</a></div>
<div class="layout"><div class="content"><h2>Head &amp; line</h2><p>First, long paragraph, with commas, and <a href=x>a link</a> plus more words to be long enough.</p><p>Second&nbsp;paragraph
 here is also long, certainly long enough, to be scored.<p>Short.<ul><li>Item one<li>Item two</ul><div class="share-buttons"><a>Share</a></div></div>
<div class="sidebar"><p>Side text that is long, really, really long, to try to win, but no.</p></div></div><div id="comments"><p>Comment, long, with, many, commas, and words, so it scores.</p></div>
<div class="cookie-notice">We use cookies</div><form><p>Sign up, please, do it now.</p></form><script>var a = "<p>no</p>";</script><footer>f</footer></body></html>"""


def test_main_text(spark):
    want = "Head & line\nFirst, long paragraph, with commas, and a link plus more words to be long enough.\nSecond paragraph here is also long, certainly long enough, to be scored.\nShort.\nItem one\nItem two"
    assert main_text.main_text(PAGE) == want
    article = "<body><nav>n</nav><article><header><h1>Title</h1></header><p>a &lt;b&gt; &#233;<br>c<p>b</article><div class=comments><p>no, no, no</div>"
    assert main_text.main_text(article) == "Title\na <b> é c\nb"
    for broken in ("<", "<p", "<a \"" * 500, "<div>" * 3000, "</p></div>", "<!-- open", "<script>x", "&bogus; &amp"):
        main_text.main_text(broken)
    rows = spark.createDataFrame([(1, None, "u", "t"), (2, "", "u", "t"), (3, PAGE, "u", "t"), (3, PAGE, "u", "t"), (4, "plain", "u", "t")], "page_id long, html string, url string, text string")
    assert [(r.text, r.n_chars) for r in main_text.extract(rows).orderBy("page_id").collect()] == [("", 0), ("", 0), (want, len(want)), (want, len(want)), ("plain", 5)]


def test_main_text_without_article():
    long, closing = "word, " * 5 + "word " * 110 + "end", "One closing sentence of forty characters"
    menu = "<ul><li><a href=/>Home</a><li><a href=/n>News</a></ul>"
    assert main_text.main_text(f"<body>{menu}<div><div><p>{long}</p></div><div><p>{closing}</p></div></div>") == f"{long}\n{closing}"
    assert main_text.main_text(f"<body>{menu}<div><div><div><p>{long}</p></div></div><div>{closing}</div>tail</div>") == f"{long}\n{closing}\ntail"
    links = "<div><a href=/1>one other page of this site</a> <a href=/2>two</a></div>"
    assert main_text.main_text(f"<body><div><div><p>{long}</p></div>{links}</div>") == long
    sources = "<ol><li><a href=/1>Source one</a><li><a href=/2>Source two</a></ol>"
    for page in (f"<article><p>{long}</p>{sources}</article>", f"<body>{menu}<div><p>{long}</p>{sources}</div>"):
        assert main_text.main_text(page) == f"{long}\nSource one\nSource two"
    assert main_text.main_text("<article><p>so <math><mi>a</mi><mo>=</mo><mn>1</mn></math> holds</p></article>") == "so a=1 holds"


def test_furniture_inside_an_article():
    long = "word, " * 5 + "word " * 110 + "end"
    kept = [("<section id='related-work'><p>", "Related work in prose"), ("<section><p class='form-of-address'>", "Dear reader"), ("<section><p id=share-of-voters>", "The share of voters"), ("<section class='notice'><p>", "A notice in the text")]
    gone = ["<div class='ad-slot-3'>", "<div class='x comment-thread'>", "<div id=related_posts>", "<div class=shareButtons>", "<aside>", "<div role=navigation>", "<div class='newsletter'>", "<div hidden>"]
    for outside, wrap in (("<article>", "</article>"), ("<div class=content>", "</div>")):
        page = f"<body><div class='sidebar'><p>{long}</p></div>{outside}<p>{long}</p>" + "".join(f"{tag}{words}</p></section>" for tag, words in kept)
        page += "".join(f"{tag}<p>furniture, of some length, with commas, {k}</p></{'aside' if tag == '<aside>' else 'div'}>" for k, tag in enumerate(gone)) + f"<ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul>{wrap}<footer>f</footer>"
        assert main_text.main_text(page).split("\n") == [long, *[w for _, w in kept], "One", "Two"]


def test_the_score_chooses_between_articles():
    long = "A sentence, with commas, of some length that goes on. " * 6
    teasers = "".join(f"<article><h2><a href=/{k}>Teaser {k}</a></h2><p>Short teaser text number {k} of the page</p></article>" for k in range(5))
    assert main_text.main_text(f"<body>{teasers}<article><h1>H</h1><div><div><p>{long}</p></div></div><p>tail</p></article>{teasers}") == f"H\n{long.strip()}\ntail"


def test_main_text_takes_linear_time():
    import time

    def seconds(page):
        began = time.perf_counter()
        main_text.main_text(page)
        return time.perf_counter() - began

    for unit in ("<div>", "<b>", "<b><p>x", "<li><div>", "<ul><li>", "<table><tr><td>", "</div>", "<a \"", "<![CDATA[", "<p>a<i>b"):
        page = unit * (500_000 // len(unit))
        assert seconds(page) < 20 and seconds(page + "</b></div></p>" * 20_000 + "<!-- >") < 20, unit


def test_main_text_of_all_pages():
    """Against the text cut out of the mark-up; with the article's own tags taken away the score alone has to find it."""
    import re
    from html import unescape

    for (html,) in duckdb.connect().sql(f"select html from '{SF}/pages.parquet'").fetchall():
        body = html[html.index("<article>") + 9 :].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", body)
        want = "\n".join(filter(None, [" ".join(unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in parts]))
        bare = html.replace("<article>", "<div>").replace("</article>", "</div>")
        boxed = bare.replace("<body>", "<body><div class=page><div>").replace("<footer>", "</div></div><footer>")
        for page in (html, bare, html.replace("<article>", "").replace("</article>", ""), boxed):
            assert main_text.main_text(page) == want


# --- neighbours


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((700, 16)).astype("float32")
    vectors[100:400] = vectors[50]  # a third are copies
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] * 16), (1150, [float("inf")] + [1.0] * 15), (1200, [1.0, 2.0]), (1250, [None] * 16), (None, vectors[0].tolist())]
    found = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, block_rows=64).collect()
    got = collections.defaultdict(dict)
    for r in found:
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    x = vectors.astype(np.float64)
    norm, hits = np.linalg.norm(x, axis=1), 0
    for q in range(0, 700, 50):
        cosine = x @ x[q] / norm / norm[q]
        cosine[q] = -9
        want = np.lexsort((np.arange(700), -np.round(cosine, 12)))[:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5] and all(abs(s - cosine[v]) < 1e-12 for v, s in got[q].values())
        hits += len(set(want) & {v for v, _ in got[q].values()})
        if 100 <= q < 400 or q == 50:
            assert [got[q][k][0] for k in (1, 2, 3, 4, 5)] == [v for v in (50, 100, 101, 102, 103, 104) if v != q][:5]
    assert set(got) == set(range(0, 700, 50)) and hits >= 0.9 * 5 * len(got)
    few = neighbours.search(spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, 1), (0, 2)]
    assert neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_cut_both_sides(spark, monkeypatch):
    from pyspark.sql import GroupedData

    sides = []
    cogroup = GroupedData.cogroup

    def seen(left, right):
        out = cogroup(left, right)
        sides.extend(max(r["count"] for r in side.count().collect()) for side in (left, right))
        return out

    monkeypatch.setattr(type(spark.range(1).groupBy("id")), "cogroup", seen)
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 8)).astype("float32"))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    cut, whole = ({tuple(r) for r in neighbours.search(df, F.col("vec_id") % 2 == 0, recall=1.0, block_rows=n).collect()} for n in (40, 10_000))
    assert len(cut) == 300 * 5 and max(sides[:2]) <= 80 and max(sides[2:]) > 80
    x = np.array([v for _, v in rows])
    cosine = x @ x.T / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None, :] - 9 * np.eye(600)
    exact = {(q, int(v)) for q in range(0, 600, 2) for v in np.argsort(-cosine[q])[:5]}
    assert all(len(exact & {(q, v) for q, _, v, _ in found}) >= 0.9 * 1500 for found in (cut, whole))


def test_neighbours_of_doubles_and_small_lists(spark):
    """Vectors that differ beyond a float's precision stay different; every query gets k answers where there are as many."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal(4)
    vectors = [(base + 1e-12 * k * rng.standard_normal(4)).tolist() for k in range(30)] + rng.standard_normal((30, 4)).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = neighbours.search(df, F.col("vec_id") % 10 == 0, recall=0.01).collect()
    assert {r.query_id for r in got} == {0, 10, 20, 30, 40, 50} and len(got) == 30
    x = np.array(vectors)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert all(abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-14 for r in got)


def test_neighbours_recall_on_the_table(spark):
    """Recall of the query against brute force over all 2,000 vectors of sf0.1."""
    path = "/root/testdata/sf0.1"
    ids, rows = zip(*sorted(duckdb.sql(f"select vec_id, embedding from '{path}/embeddings.parquet'").fetchall()))
    x, ids = np.array(rows, dtype=np.float64), np.array(ids)
    norm = np.linalg.norm(x, axis=1)
    got = collections.defaultdict(set)
    for r in queries.op5_neighbours(spark, path).collect():
        got[r.query_id].add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        cosine = x @ x[q] / norm / norm[q]
        cosine[q] = -9
        want = {int(ids[v]) for v in np.lexsort((ids, -cosine))[:5]}
        hits, total = hits + len(want & got[int(ids[q])]), total + 5
    assert hits >= 0.9 * total


# --- toxicity


def test_toxicity(spark):
    rng = random.Random(0)
    word = lambda: rng.choice(["the", "of", "and", "with", "for"]) + str(rng.randint(0, 200))
    texts = [" ".join([word() for _ in range(60)] + ["vile!", "Foul,"] * (i % 9 == 0)) for i in range(2000)]
    marks = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(0, 2000, 2)] + [(1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs(spark, texts[:1500]), marks.where("doc_id < 1500"))
    got = toxicity.score(docs(spark, texts), model).where("doc_id >= 1500").collect()
    assert [r.predicted for r in got] == [int(r.doc_id % 9 == 0) for r in got]
    edge = toxicity.score(docs(spark, [*ODD, "VILE, foul"]), model).collect()
    assert [r.predicted for r in edge] == [0] * len(ODD) + [1] and all(0 <= r.score <= 1 for r in edge)
    assert toxicity.score(docs(spark, []), model).count() == 0
    nothing = toxicity.fit(docs(spark, texts[:50]), marks.where("false"))
    assert toxicity.score(docs(spark, ["vile"]), nothing).first().predicted == 0
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    held = queries.op8_toxicity(spark, path).join(labels, "doc_id").where("held_out").collect()
    clean, toxic = [r for r in held if r.toxic == 0], [r for r in held if r.toxic == 1]
    assert len(clean) > 500 and sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert len(toxic) > 50 and sum(r.predicted for r in toxic) >= 0.8 * len(toxic)


def test_toxicity_sample_is_of_different_texts(spark):
    """Neither copies nor one id's many rows fill the sample."""
    rows = [(7, f"copy {i % 2}") for i in range(500)] + [(i, f"word{i} other text") for i in range(100, 160)] + [(i, f"vile word{i} thing") for i in range(200, 230)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(200, 230)] + [(i, 0) for i in range(100, 160)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels, max_unlabelled=92)
    got = {r.doc_id: r.predicted for r in toxicity.score(frame, model).collect()}
    assert all(got[i] == (i >= 200) for i in got)
    assert len(toxicity.fit(frame, labels, max_bytes=50).codes) == 0


def test_risk_and_its_direction():
    """Against the definition row by row, and against finite differences on both sides of zero."""
    rng = np.random.default_rng(3)
    rows = lambda n: [sorted(rng.choice(6, rng.integers(0, 5), replace=False).tolist()) for _ in range(n)]
    pos, unl = rows(9), rows(25)
    flat = lambda x: (np.array([c for r in x for c in r], dtype=np.int64), np.array([k for k, r in enumerate(x) for _ in r], dtype=np.int64), len(x))

    def parts(at, prior):
        z = lambda r: at[-1] + sum(at[c] for c in r)
        loss = lambda v: math.log1p(math.exp(-v))
        negative = sum(loss(-z(r)) for r in unl) / len(unl) - prior * sum(loss(-z(r)) for r in pos) / len(pos)
        return prior * sum(loss(z(r)) for r in pos) / len(pos), negative

    seen = set()
    for prior, scale in ((0.2, 1.0), (0.9, 1.0), (0.9, 3.0), (0.8, 2.0)):
        for _ in range(5):
            at = rng.standard_normal(7) * scale
            own, negative = parts(at, prior)
            value, direction = toxicity.risk(at, flat(pos), flat(unl), prior)
            assert abs(value - own - max(0, negative)) < 1e-9
            target = (lambda x: sum(parts(x, prior))) if negative >= 0 else (lambda x: -parts(x, prior)[1])
            steps = [(target(at + 1e-6 * e) - target(at - 1e-6 * e)) / 2e-6 for e in np.eye(7)]
            assert np.allclose(direction, steps, atol=1e-6)
            seen.add(negative >= 0)
    assert seen == {True, False}


# --- near copies


def brute_groups(texts, words, percent):
    def grams(t):
        w = (t or "").encode().lower().split()
        return set() if not w else {tuple(w)} if len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}

    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_jaccard_join_against_brute_force(spark, words, percent):
    rng = random.Random(7)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 3000}"
    base = [[word() for _ in range(rng.randint(1, 120))] for _ in range(60)]
    texts = list(ODD)
    for b in base:
        texts.append(" ".join(b))
        for _ in range(rng.randint(0, 3)):
            c = list(b)
            for _ in range(rng.randint(0, 4)):
                c[rng.randrange(len(c))] = word()
            texts.append(" ".join(c) if rng.random() < 0.8 else " ".join(c).upper())
    hot = [word() for _ in range(150)]
    for _ in range(60):  # a group of near copies whose pairs lie around the threshold
        c = list(hot)
        for _ in range(rng.randint(1, 4)):
            c[rng.randrange(len(c))] = word()
        texts.append(" ".join(c))
    texts += [" ".join(hot)] * 30
    rng.shuffle(texts)
    want = brute_groups(texts, words, percent)
    for pivots, part_rows in ((1, 7), (8, 1024)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_documents(docs(spark, texts), words=words, percent=percent, pivots=pivots, rounds=2, part_rows=part_rows).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_jaccard_join_edges(spark):
    assert jaccard_join.similar_documents(docs(spark, [])).count() == 0
    rows = spark.createDataFrame([(None, "a b c d"), (5, "A b C d"), (5, "x y"), (4, "x  Y"), (3, None), (2, " ")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.similar_documents(rows).collect())
    assert got == [("2", 0, "2"), ("3", 0, "3"), ("4", 1, "4"), ("5", 1, "4"), ("5", 2, "5"), ("None", 2, "5")]


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100, 200: 200}


# --- benchmark


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "chunk": 1}])
def test_decontamination(spark, limits):
    words = [f"w{i}" for i in range(30)]
    every = lambda k: " ".join(w if i % k else "sub" for i, w in enumerate(words))
    texts = ["x y " + " ".join(words) + " z", every(5), every(2), "aa BB, cc dd ee", None, "", "aa bb cc dd xx ee", " ".join(words[:12])]
    items = spark.createDataFrame([(1, " ".join(words), "a"), (2, "Aa, bb cc. dd ee", "a"), (3, "one two", "a"), (4, None, "a"), (1, " ".join(words), "a")], "item_id long, text string, doc_id string")
    got = decontamination.contaminated(docs(spark, texts), items, **limits)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 24, 24), (1, 1, 20, 24), (3, 2, 5, 5)]
    short = decontamination.contaminated(docs(spark, ["say one TWO three", "one or two", "two"]), items, **limits)
    assert sorted(map(tuple, short.collect())) == [(0, 3, 2, 2)]  # short items count where they occur in full
    assert decontamination.contaminated(docs(spark, ["say one two three"]), items, least=5, **limits).count() == 0
    again = spark.createDataFrame([(None, texts[0]), (None, "other"), (7, texts[0]), (7, texts[1]), (7, texts[0])], "doc_id long, text string")
    assert sorted(map(str, decontamination.contaminated(again, items, **limits).collect())) == ["Row(doc_id=7, item_id=1, matched=24, window=24)", "Row(doc_id=None, item_id=1, matched=24, window=24)"]
    assert decontamination.contaminated(docs(spark, []), items, **limits).count() == 0
    assert decontamination.contaminated(docs(spark, texts), items.where("false"), **limits).count() == 0


def test_decontamination_finds_every_passage(spark):
    import re

    c = duckdb.connect()
    split = lambda t: " " + " ".join(x for x in re.split(r"[^\w]+|_", t.lower()) if x) + " "
    items = [split(t) for (t,) in c.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    want = {d for d, t in c.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall() if any(x in split(t) for x in items)}
    got = {r.doc_id for r in queries.op10_decontamination(spark, SF).collect()}
    assert want and got == want


def test_decontamination_misses_no_pattern(spark):
    import itertools

    sizes = (8, 9, 12, 15, 16)
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (*sizes, 24)}
    want = [(24, [w if k % 4 < 3 else "sub" for k, w in enumerate(items[24])])]  # every fourth word
    for n in sizes:
        for places in itertools.combinations(range(n), n - math.ceil(0.75 * n)):
            want.append((n, ["sub" if k in places else w for k, w in enumerate(items[n])]))
    rng = random.Random(4)
    for _ in range(300):
        places = rng.sample(range(24), 6)
        want.append((24, ["sub" if k in places else w for k, w in enumerate(items[24])]))
    rows = spark.createDataFrame([(n, " ".join(words)) for n, words in items.items()], "item_id long, text string")
    got = decontamination.contaminated(docs(spark, [" ".join(words) for _, words in want]), rows)
    assert {(r.doc_id, r.item_id, r.matched, r.window) for r in got.collect()} == {(i, n, math.ceil(0.75 * n), n) for i, (n, _) in enumerate(want)}


def test_masks_promise_their_seeds():
    for n in range(8, 25):
        told = decontamination.LEAST_HITS.pop(n)
        decontamination.least_hits.cache_clear()
        assert decontamination.least_hits(n, 0.75) == told > 0
        decontamination.LEAST_HITS[n] = told
    assert all("0" in m and m[0] == m[-1] == "1" for pair in decontamination.MASKS.values() for m in pair)


def test_promise_is_checked(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(12)))], "item_id long, text string")
    with pytest.raises(ValueError):
        decontamination.contaminated(docs(spark, ["a"]), items, share=0.3)


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "chunk": 2}])
def test_decontamination_against_brute_force(spark, limits):
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(40)]
    items = {n: [rng.choice(vocabulary) for _ in range(size)] for n, size in enumerate([1, 3, 7, 8, 9, 11, 12, 13, 17, 24, 25, 40, 70])}
    texts = []
    for _ in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            own = list(items[rng.choice(list(items))])
            at = rng.randrange(len(own))
            own = own[at:] if rng.random() < 0.3 else own
            for k in range(len(own)):
                if rng.random() < rng.choice([0, 0.1, 0.25, 0.3]):
                    own[k] = "sub"
            words += own + [rng.choice(vocabulary) for _ in range(rng.randint(0, 10))]
        texts.append(words)
    want = set()
    for d, words in enumerate(texts):
        for n, own in items.items():
            width = min(24, len(own))
            best = 0
            for shift in range(1 - len(own), len(words)):
                equal = [0 <= k + shift < len(words) and words[k + shift] == w for k, w in enumerate(own)]
                best = max(best, max(sum(equal[k : k + width]) for k in range(len(own) - width + 1)))
            if best >= (len(own) if len(own) < 8 else math.ceil(0.75 * width)):
                want.add((d, n, best, width))
    rows = spark.createDataFrame([(n, " ".join(own)) for n, own in items.items()], "item_id long, text string")
    got = {tuple(r) for r in decontamination.contaminated(docs(spark, [" ".join(t).upper() for t in texts]), rows, **limits).collect()}
    assert len(want) > 100 and got == want


# --- the pipeline


def test_columns_of_any_name_stay(spark):
    """Tables with columns named like what the operators add on the way: their values come out as they went in."""
    import corpus_pipeline as p

    text = "A shared line of more than forty code points, to be sure"
    rows = [(i, f"{text}\nown words number {i} of this one text", "en", "s", 9, *["kept"] * len(CLASHES)) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns and {tuple(r[5:]) for r in out.collect()} == {("kept",) * len(CLASHES)}, name
    for limit in (32 << 20, 0):
        assert set(CLASHES) <= set(line_dedup.drop_repeated_lines(df, broadcast_bytes=limit).columns)
    assert decontamination.contaminated(df, spark.createDataFrame([(1, text)], "item_id long, text string")).count() == 8


def test_language_model_runs_once(spark):
    import corpus_pipeline as p

    plan = p.identified(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    start = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    frame = start
    for name, stage in p.STAGES[:-1]:
        frame = p.materialise(stage(spark, frame, SF), "test")
        assert frame.columns == start.columns
        kept[name] = {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}
    assert set(kept["benchmark"]) <= set(kept["near copies"]) <= set(kept["lines"]) == set(kept["language"])
    ids = sorted(kept["lines"])
    groups = brute_groups([kept["lines"][i] for i in ids], p.NEAR_WORDS, p.NEAR_PERCENT)
    assert set(kept["near copies"]) == {i for k, i in enumerate(ids) if groups[k][1] == k}
    library = Tokenizer.from_file(VOCABULARY)
    pieces = p.STAGES[-1][1](spark, frame, SF).collect()
    want = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in kept["benchmark"].values())
    assert sum(r.length for r in pieces) == want and {r.doc_id for r in pieces} == set(kept["benchmark"])


def test_near_copies_of_repeated_and_null_ids(spark):
    import corpus_pipeline as p

    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (3, b + " more"), (9, a), (5, a), (None, c), (None, c + " x"), (None, None), (7, ""), (7, "")]
    out = p.without_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(r for r in got if r[0] is not None) == [(3, b + " more"), (5, a), (7, ""), (7, "")]
    assert len([r for r in got if r[0] is None and r[1]]) == 1 and got.count((None, None)) == 1


def test_stages_on_odd_tables(spark):
    """Nulls in every column, empty and long texts, repeated and null ids, columns with clashing names, empty tables."""
    import corpus_pipeline as p

    passage = duckdb.sql(f"select text from '{SF}/benchmark.parquet' order by item_id limit 1").fetchall()[0][0]
    long = " ".join(f"word{k}" for k in range(40_000))
    texts = [None, "", " ", "123", long, long, "some words of a text", passage, f"{passage} more", "kept words beside"]
    rows = [(i if i % 3 else None, t, "en" if i % 2 else None, None, None, "x") for i, t in enumerate(texts)] + [(7, "another text under a used id", "en", "s", 1, None), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string")
    kept = {}
    frame = df
    for name, stage in p.STAGES[:-1]:
        assert stage(spark, df.where("false"), SF).count() == 0
        frame = p.materialise(stage(spark, frame, SF), "test")
        assert frame.columns == df.columns
        kept[name] = [(r.doc_id, r.text) for r in frame.collect()]
    assert all(t and any(c.isalpha() for c in t) for _, t in kept["language"]) and len(kept["language"]) == 7
    assert len(kept["lines"]) == 7 and sum(t == long for _, t in kept["near copies"]) == 1
    left = {t for _, t in kept["benchmark"]}
    assert left == {long, "some words of a text", "kept words beside", "another text under a used id"}  # also of id 7 the clean row alone
    pieces = p.STAGES[-1][1](spark, df, SF)
    assert pieces.groupBy("doc_id").count().count() >= 7 and p.STAGES[-1][1](spark, df.where("false"), SF).count() == 0
    assert [name for name, _ in p.STAGES] == ["language", "lines", "near copies", "benchmark", "packing"]
