"""Periodic runs, packing into few sequences and spelling variants against brute force, and their odd cases."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bookloom.llm import fewest_sequences, periodic_runs, queries, spelling

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, runs string, word string, n string, sequence_id string, k string, t string"  # the last columns clash with results
ODD = [None, "", " ", "\n", "a", "a b\x1cc\x85d", "x " * 30, "日本 語 " * 8, "\t a  b\tc a b\x0bc a b c a b c a b\nc"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, *"abcdef") for i, t in rows], DOCS)


# --- periodic runs


def slow_runs(words, least):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i - start + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(1, 8)):
            k, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.choice([0, 1, 11, 12, 13, 30, 60, 120])
            words = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 2))
                words = words[:a] + [words[a + i % p] for i in range(n - a)]
            texts.append(words + [b"x"] + words if rng.random() < 0.3 else words)
        for least in (4, 5, 12, 20):
            assert periodic_runs.runs_of_texts(texts, least) == [slow_runs(w, least) for w in texts]


def test_runs_of_repetitive_words():
    x, y = [b"a"], [b"b"]
    for _ in range(10):
        x, y = x + y, x
    assert periodic_runs.runs_of_texts([x]) == [slow_runs(x, 12)]
    assert periodic_runs.runs_of_texts([[b"a"] * 50_000]) == [[(0, 50_000, 1)]]


def test_branching_repeats_are_those_that_cannot_shift_right():
    words = np.array([0, 1, 0, 1, 0, 0, 2, 2], dtype=np.int32)
    starts, periods = periodic_runs.branching_repeats(words, np.arange(len(words)))
    assert sorted(zip(starts.tolist(), periods.tolist())) == [(1, 2), (4, 1), (6, 1)]


def test_find_runs_on_odd_rows(spark):
    rows = [*enumerate(ODD), (None, "b " * 20), (3, "b " * 20), (3, "b " * 20)]
    got = sorted(((r.doc_id is None, r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(docs(spark, rows)).collect()), key=str)
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        runs = slow_runs(words, 12)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i is None, i, runs, b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    assert got == sorted(want, key=str)
    assert periodic_runs.find_runs(docs(spark, [])).count() == 0


def test_planted_periods():
    words = [b"%d" % i for i in range(100)]
    changed = [i for i in range(200) if queries.planted_period(i, words) != words]
    assert changed == [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert queries.planted_period(None, []) == []


# --- packing


def test_places_minimise_the_sum_of_squares():
    rng, bins, capacity = random.Random(2), fewest_sequences.SumOfSquares(40), 40
    fill: list[int] = []
    for _ in range(600):
        n = rng.randint(1, 40)
        squares = lambda f: sum(c * c for gap, c in collections.Counter(capacity - x for x in f).items() if gap)
        fits = [squares([x + n * (k == at) for k, x in enumerate(fill)]) for at in range(len(fill)) if fill[at] + n <= capacity]
        sequence, offset = bins.place(n)
        if sequence == len(fill):
            assert not fits and offset == 0
            fill.append(n)
        else:
            assert offset == fill[sequence] and offset + n <= capacity
            fill[sequence] += n
            assert squares(fill) == min(fits)


@pytest.mark.parametrize("task_pieces", [200_000, 40])
def test_few_sequences_hold_every_token_once(spark, task_pieces):
    rng = random.Random(5)
    rows = [*enumerate(ODD), (None, "x <|endoftext|> y"), (2, "word, " * 5000)] + [(100 + i, "some words here. " * rng.randint(1, 500)) for i in range(120)] + [(7, "twice told")] * 2
    library = Tokenizer.from_file(VOCABULARY)
    got = fewest_sequences.pack(docs(spark, rows), VOCABULARY, task_pieces=task_pieces).collect()
    want, total = collections.Counter(), 0
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        first, total = (len(ids) - 1) % 2048 + 1, total + len(ids)
        for k, (a, b) in enumerate([(0, first), *((x, x + 2048) for x in range(first, len(ids), 2048))]):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for x in sequences.values():
        assert [a for a, _ in sorted(x)] == [sum(n for _, n in sorted(x)[:k]) for k in range(len(x))] and sum(n for _, n in x) <= 2048
    if task_pieces > 1000:
        assert len(sequences) <= -(-total // 2048) * 1.02 + 1
    assert fewest_sequences.pack(docs(spark, []), VOCABULARY).count() == 0


def test_packing_a_table_twice_gives_the_same(spark):
    rows = [(i, "some words " * (i % 300)) for i in range(400)]
    one, two = ({tuple(r) for r in fewest_sequences.pack(docs(spark, rows), VOCABULARY, task_pieces=150).collect()} for _ in range(2))
    assert one == two


# --- spelling variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_shard_equals_brute_force():
    rng = random.Random(0)
    for t in range(120):
        words = {"".join(rng.choice("ab" if t % 2 else "abc") for _ in range(rng.randint(2, 7))) for _ in range(60)}
        n, shard = {w: rng.randint(1, 9) for w in words}, spelling.Shard()
        for w in words:
            shard.add("P", w, n[w])
            shard.add("S", w, n[w])
        shard.build()
        for w in words:
            want = [(-n[x], x) for x in words if near(w, x)]
            assert shard.scan(w) == (len(want), min(want, default=None))


def slow_variants(rows, shortest, least, ratio):
    letters = set("abcdefghijklmnopqrstuvwxyz") | {chr(c) for c in range(0xC0, 0x100)}
    n = collections.Counter()
    for _, t in rows:
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        n.update(w for w in "".join(c if c in letters else " " for c in low).split(" ") if len(w) >= shortest)
    n = {w: k for w, k in n.items() if k >= least}
    around = {w: sorted((-n[x], x) for x in n if near(w, x)) for w in n}
    form = {w: x[0][1] if x and -x[0][0] >= ratio * n[w] else None for w, x in around.items()}
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(around[w]), n.get(form[w])))
    return out


@pytest.mark.parametrize("limits", [{}, {"held_words": 10, "hot": 6}, {"held_words": 30, "hot": 3, "broadcast_rows": 0}])
def test_variants_equal_brute_force(spark, limits):
    rng = random.Random(4)
    words = {"".join(rng.choice("abÀé") for _ in range(rng.randint(3, 6))) for _ in range(150)} | {"common" + "".join(rng.choice("xyz") for _ in range(4)) for _ in range(50)}
    texts = [(i % 7 or None, " ".join(rng.choices(sorted(words), weights=[2 ** rng.randint(0, 9) for _ in words], k=400)).replace("a", "A")) for i in range(12)]
    rows = [*texts, *texts[:2], *enumerate(ODD), (1, "été-ÉTÉ_été×÷ŝabcd"), (1, "x" * 300), (2, "x" * 299), (2, "x" * 299 + " " + "x" * 300)]
    got = spelling.group_variants(docs(spark, rows), shortest=3, ratio=4, **limits).collect()
    assert len(got) == len(set(got)) and {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == slow_variants(rows, 3, 2, 4)


def test_variants_of_nothing(spark):
    assert spelling.group_variants(docs(spark, [])).count() == 0
    assert spelling.group_variants(docs(spark, list(enumerate([None, "", "short", "oncewritten"])))).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(docs(spark, []), shortest=1)


def test_planted_slips():
    slips = [i for i in range(300) if queries.planted_slip(i, "spelling") != "spelling"]
    assert slips == [i for i in range(300) if zlib.crc32(f"{i}:spelling".encode()) % 31 == 0]
    assert all(len(queries.planted_slip(i, "spelling")) == 7 for i in slips) and queries.planted_slip(None, "abc")


# --- the first tier of token counts


def test_frequent_words_are_counted_in_bounded_summaries(spark):
    from bookloom.llm import token_count

    rows = [(i, f"start common common\nusual rare{i} {'x' * 60} common") for i in range(300)] + [(None, None), (1, "")]
    assert token_count.frequent_words(docs(spark, rows), "text", 2) == ["common", "\nusual"]
    assert set(token_count.frequent_words(docs(spark, rows), "text", 2, task_words=3, summary=50)) == {"common", "\nusual"}
    words, lengths = token_count.frequent_lengths(["common", "\nusual"], VOCABULARY)
    library = Tokenizer.from_file(VOCABULARY)
    assert words.split(" ") == ["common", "\nusual"] and list(lengths) == [len(library.encode(x, add_special_tokens=False).ids) for x in (" common", "\nusual")]
    assert token_count.frequent_words(docs(spark, []), "text", 5) == []


# --- reader comments inside an article


@pytest.mark.parametrize("name", ["reader-comments", "user_comments", "comments", "visitor-comments-list"])
def test_reader_comments_inside_an_article_go(name):
    from bookloom.llm import main_text

    words = "A sentence of the article, long enough to be told from its furniture, with commas. " * 5
    page = f'<html><body><article><p>{words}</p><div class="{name}"><p>{"I agree, first. " * 20}</p></div><div class="user-guide"><p>{words}</p></div></article></body></html>'
    assert main_text.main_text(page).count("A sentence") == 10 and "agree" not in main_text.main_text(page)


def test_the_packing_stage_of_the_pipeline_keeps_small_caches(spark, monkeypatch):
    """Its workers stand beside heaps that four stages have grown: what their caches hold does not follow the texts."""
    import inspect
    import tracemalloc

    import corpus_pipeline
    from bookloom.llm import packing
    from bookloom.llm.bpe import token_chunks

    given = {p.name: p.default for p in inspect.signature(packing.pack).parameters.values()}
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with monkeypatch.context() as m:
        m.setattr(packing, "pack", lambda df, path, **more: given.update(more))
        corpus_pipeline.packed(spark, docs, "")
    encoder, chunks = token_chunks(public_tokenizers.path(corpus_pipeline.VOCABULARY), given["cache"])
    tracemalloc.start()
    for at in range(0, 300_000, 1000):
        text = " ".join(f"x{i:x}.y" for i in range(at, at + 1000))
        first, rest = chunks.split(text)
        ids = b"".join([first, *rest])
        assert at or ids == encoder.whole(text)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 40e6
    assert not given["keep"]


@pytest.mark.parametrize("stage", ["language", "packing"])
def test_a_worker_has_let_its_model_go_when_it_trims_its_memory(spark, monkeypatch, stage):
    """It waits for its next task beside the executor's heap, with what is still held then."""
    import types
    import weakref

    import pandas as pd

    from bookloom.llm import common, language, packing

    held, maps, alive = [], [], []
    module, name = (language, "Model") if stage == "language" else (packing, "token_chunks")
    make = getattr(module, name)

    def noted(*given):
        out = make(*given)
        held.append(weakref.ref(out if stage == "language" else out[1]))
        return out

    def trim():
        alive.append([x() is not None for x in held])

    monkeypatch.setattr(module, name, noted)
    monkeypatch.setattr(common, "trim", trim)
    monkeypatch.setattr(language, "trim", trim, raising=False)
    texts = ["a b c", "", "d e"]
    if stage == "language":
        empty = language.F.lit(None).cast("struct<lang_pred:string,score:double,bits_per_byte:double>")
        learned = language.Counts(("de", "en"), (np.array([97], np.uint32), np.array([98], np.uint32)), (np.ones(1), np.ones(1)))

        def udf(*given):
            if not callable(given[0]):
                return udf
            maps.append(given[0])
            return lambda *columns: empty

        monkeypatch.setattr(language.F, "pandas_udf", udf)
        language.identify(spark.createDataFrame([(1, "a")], "doc_id long, text string"), learned)
        found = list(maps[0](iter([pd.Series(texts)])))
    else:
        monkeypatch.setattr(packing, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
        table = types.SimpleNamespace(selectExpr=lambda *given: types.SimpleNamespace(mapInPandas=lambda run, schema: maps.append(run)))
        packing.pack(table, VOCABULARY)
        found = list(maps[0](iter([pd.DataFrame({"k": [1, 2, 3], "t": texts})])))
    assert sum(map(len, found)) == 3 and alive == [[False]]


def test_stages_of_the_pipeline_pass_small_batches(spark):
    """Also where a stage is called by itself, on documents that something else has read."""
    import corpus_pipeline
    from bookloom.llm.common import BATCH

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get(BATCH)
    try:
        for asked, expected in ((64 << 20, 1 << 20), (1 << 18, 1 << 18)):
            for name, stage in corpus_pipeline.STAGES:
                spark.conf.set(BATCH, str(asked))
                stage(spark, docs, "/root/testdata/sf0.001")
                assert int(spark.conf.get(BATCH).rstrip("bB")) == expected, name
    finally:
        spark.conf.set(BATCH, before)
