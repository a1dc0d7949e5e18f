"""The split reader of dumps against one that reads a file from its beginning to its end."""

import random

import pytest

from bookloom.sources import dump


def slow_rows(text, name):
    """Rows of one table, by a walk over the characters; comment lines outside strings go."""
    kept, inside, rows = [], False, []
    for line in text.split("\n"):
        if not inside and line.startswith(("--", "#")):
            continue
        kept.append(line)
        i = 0
        while i < len(line):
            if inside and line[i] == "\\":
                i += 1
            elif line[i] == "'":
                inside = not inside
            i += 1
    for one in dump._STATEMENT.findall("\n".join(kept)):
        m = dump._INSERT.match(one)
        if m and m[1].lower() == name and "VALUES" in one:  # a cut file may end before
            rows += list(dump.rows_of(one.split("VALUES", 1)[1]))
    return rows


def random_dump(rng):
    out, end = [], rng.choice(["\n", "\r\n"])
    for _ in range(rng.randint(5, 40)):
        kind = rng.random()
        if kind < 0.15:
            out.append(rng.choice(["-- it's a comment;", "# another 'one", "CREATE TABLE x (a int);", "", "DROP TABLE `y`;"]))
            continue
        rows = []
        for _ in range(rng.randint(1, 4)):
            text = "".join(rng.choice(["a", " ", "\\'", "''", "\\\\", ";", f";{end}", end, f"{end}-- not a comment", "(b),", "é", "\\n", f"\\{end}", f"{end}INSERT INTO `t` VALUES (9);{end}"]) for _ in range(rng.randint(0, 9)))
            rows.append(f"({rng.randint(0, 99)},'{text}',NULL)")
        out.append(f"INSERT INTO `{rng.choice(['t', 'T', 'u'])}` VALUES {f',{end if rng.random() < 0.3 else str()}'.join(rows)};" + rng.choice(["", "", " INSERT INTO u VALUES (1,'x',2);"]))
    return end.join(out) + rng.choice(["", end])


@pytest.fixture
def small_chunks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, str(size)) for n in names]
    for n, x in zip(names, before):
        spark.conf.set(n, x)


@pytest.mark.parametrize("size", [60, 300])
def test_chunks_read_as_the_whole_file(spark, tmp_path, small_chunks, size):
    rng = random.Random(size)
    texts = [random_dump(rng)[:900] for _ in range(2)] + ["", "INSERT INTO t VALUES (1,'a;\nb','x\\')"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.sql").write_bytes(text.encode())
    small_chunks(size)
    want = sorted(str(r) for text in texts for r in slow_rows(text, "t"))
    got = dump._values(spark, str(tmp_path), {"t"})
    assert sorted(str(r["values"]) for r in got.collect()) == want
    other = dump._values(spark, str(tmp_path), {"t"}, broadcast_chunks=0)
    assert sorted(str(r["values"]) for r in other.collect()) == want


def test_tables_in_one_pass(spark, tmp_path):
    texts = [random_dump(random.Random(i)) for i in range(5)]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.sql").write_bytes(text.encode())
    schema = "a long, b string, c string"
    tables = dump.read_tables(spark, str(tmp_path), {"T": schema, "u": schema, "none": "a int"})
    for name in ("T", "u"):
        rows = [r for text in texts for r in slow_rows(text, name.lower())]
        assert tables[name].count() == sum(len(r) == 3 for r in rows)
    bad = [r for text in texts for r in slow_rows(text, "t") if len(r) != 3]
    assert dump.bad_records(spark, str(tmp_path), "t", schema).count() == len(bad)
    assert tables["none"].count() == 0
