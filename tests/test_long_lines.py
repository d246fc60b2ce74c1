"""Dump lines cut anywhere: every cut gives the tuples of the whole."""

import random

import pyarrow as pa
import pytest

from linkloom.functions.automaton import DONE, PLAIN, Pieces, Range, head_of, scan
from linkloom.operators import dumps as op
from linkloom.operators import long_lines as long
from linkloom.sources import lines as source

TEXT = (
    "-- comment (x)\nINSERT INTO `page` VALUES (1,0,'A_(B)','it\\'s (a) \\\\',3),(2,0,'x''y)(',NULL) , (3,0,'\\)',-1);\n\n"
    "INSERT INTO `t` VALUES (4,'a;b),(c');tail ) (\nother ) line\nINSERT INTO `u` VALUES (5),(6)\t,(7,\\));,"
)


def brute(text: str) -> tuple[set, set]:
    """``(line, table, pos, tuple)`` of well-formed lines, and numbers of the malformed ones, character by character."""
    tuples, bad = set(), set()
    for number, line in enumerate(text.split("\n")):
        head = head_of(line.encode())
        if head is None:
            continue
        at, found, ok = head[1], [], False
        while True:
            begin, quoted, at = at, False, at + 1
            while at < len(line) and (quoted or line[at] not in "()"):
                quoted ^= line[at] == "'"
                at += 2 if line[at] == "\\" else 1
            if at >= len(line) or line[at] == "(":
                break
            at += 1
            found.append(line[begin:at])
            rest = line[at:].lstrip(" \t\x0b\f\r")
            if rest.startswith(";"):
                ok = True
                break
            follow = rest[1:].lstrip(" \t\x0b\f\r")
            if not rest.startswith(",") or not follow.startswith("("):
                break
            at = len(line) - len(follow)
        if ok:
            tuples |= {(number, head[0].decode(), i, t) for i, t in enumerate(found)}
        else:
            bad.add(number)
    return tuples, bad


def by_ranges(text: str, cuts: list[int]) -> tuple[set, set]:
    """The same from ranges of pieces, each gone through from its own start."""
    pieces = text.encode().split(b")")
    bounds = [0, *cuts, len(pieces)]
    ranges = [pieces[a:b] for a, b in zip(bounds, bounds[1:]) if a < b]
    functions = []
    for part in ranges:
        whole = Range()
        for piece in part:  # a batch per piece: the composition has to carry everything
            whole.add(Pieces(pa.array([piece], pa.binary())))
        functions.append(vars(whole))
    starts = scan(functions)
    rows = []
    for i, part in enumerate(ranges):
        reader = long._Reader(("file", i), **starts[i])
        reader.read(Pieces(pa.array(part, pa.binary())))
        rows += reader.rows(True).to_pylist()
    bad = {r["line"] for r in rows if r["pos"] < 0} | ({starts[-1]["line"]} if starts[-1]["state"] not in (PLAIN, DONE) else set())
    joined: dict = {}
    for r in rows:
        if r["pos"] >= 0 and r["line"] not in bad:
            key = r["line"], r["table"], r["pos"]
            joined[key] = joined.get(key, "") + r["tuple"]
    return {(*key, value) for key, value in joined.items()}, bad


def test_every_cut_of_a_small_case():
    assert brute(TEXT)[1] == set() and len(brute(TEXT)[0]) == 7
    n = TEXT.count(")") + 1
    for a in range(1, n):
        assert by_ranges(TEXT, [a]) == brute(TEXT)
        assert by_ranges(TEXT, sorted({a, 1 + a * 7 % (n - 1)})) == brute(TEXT)


def test_random_texts_and_cuts():
    draw = random.Random(5)
    words = ["INSERT INTO `t` VALUES (", "(", ")", "),(", ");\n", "'", "\\", "\n", ",", ";", "a", " ", "'b)'", "'c(d", "1,2"]
    for _ in range(1500):
        text = "".join(draw.choices(words, k=draw.randrange(1, 25)))
        if draw.random() < 0.7:
            text = words[0] + text
        n = text.count(")") + 1
        cuts = sorted(draw.sample(range(1, n), min(n - 1, draw.randrange(4)))) if n > 1 else []
        assert by_ranges(text, cuts) == brute(text), (text, cuts)


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_splits_at_every_byte(spark, tmp_path, size):
    (tmp_path / "dump.sql").write_text(TEXT)
    lines = source.scan_dump(spark, str(tmp_path / "dump.sql"))
    expected = {(r.table, r.pos, r.tuple, tuple(r.fields)) for r in op.parse_dump_tuples(lines).collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = long.parse_dump_ranges(spark, str(tmp_path), range_bytes=size).collect()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert {(r.table, r.pos, r.tuple, tuple(r.fields)) for r in found} == expected and len(found) == len(expected)


def test_one_long_line_is_read_by_many_tasks(spark, tmp_path):
    body = ",".join(f"({i},0,'T_({i})''x')" for i in range(40_000))
    (tmp_path / "dump.sql").write_text(f"INSERT INTO `page` VALUES {body};\n")
    with long._same_splits(spark, 64 << 10):
        functions = long.split_functions(long.read_pieces(spark, str(tmp_path)))
        assert functions.count() >= 8
    found = long.parse_dump_ranges(spark, str(tmp_path), range_bytes=64 << 10)
    assert found.count() == 40_000 == found.select("pos").distinct().count()
    assert found.where("tuple != concat('(', pos, ',0,''T_(', pos, ')''''x'')')").count() == 0


def test_malformed_lines_and_bytes(spark, tmp_path):
    text = b"INSERT INTO `t` VALUES (1),(2;\nINSERT INTO `t` VALUES (3,'\xff)\xe9');\nINSERT INTO `t` VALUES (4)(5);\nINSERT INTO `t` VALUES (6)"
    (tmp_path / "dump.sql").write_bytes(text)
    with pytest.raises(ValueError, match="line 0"):
        long.parse_dump_ranges(spark, str(tmp_path))
    for size in (1, 1000):
        found = long.parse_dump_ranges(spark, str(tmp_path), "drop", size).collect()
        assert [(r.line, r.pos, r.tuple) for r in found] == [(1, 0, "(3,'\xff)\xe9')")]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "dump.sql").write_text("")
    assert long.parse_dump_ranges(spark, str(tmp_path / "empty")).collect() == []
