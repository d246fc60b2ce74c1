import pytest
from pyspark.sql import functions as F

from linkloom.catalog.inputs import place_columns
from linkloom.operators import dumps as op
from linkloom.plans.dump_filter import filter_dumps, filter_tuples
from linkloom.sources import lines as source
from linkloom.sources import sinks

# Dump lines.
HEADER, FOOTER = "/* Header */", "/* Footer */"
ANARCHISM = "(12,0,'Anarchism','',0,0,0.786172332974311,'20190120003623','20190120011642',878871297,198626,'wikitext',NULL)"
COMPUTING = "(10,0,'AccessibleComputing','',1,0,0.33167112649574004,'20190116190543','20190105021557',854851586,94,'wikitext',NULL)"
HISTORY = "(13,0,'AfghanistanHistory','',1,0,0.0621502865684687,'20190116063934','20190105021557',783865149,90,'wikitext',NULL)"
ELEMENTS = r"(246424,1,'Euclid\'s_Elements','',0,0,0.22571038977508998,'20190117095503','20190117115115',863650667,41500,'wikitext',NULL)"
SCOUT = "(1271290,7,'Apaches_Ba-keitz-ogie,_(The_Yellow_Coyote),_called_Dutchy_Chiricahua_scout_(F19052_DPLW).jpg','',0,0,0.298012287594,'20180619101909','20180619101909',846533886,1314,'wikitext',NULL)"
STARCRAFT = "(26809,0,'StarCraft_(video_game)','',0,0,0.8594902091282329,'20190120003623','20190120020413',875950064,77587,'wikitext',NULL)"


def insert(*tuples, table="page"):
    return f"INSERT INTO `{table}` VALUES {','.join(tuples)};"


def frame(spark, lines):
    rows = spark.createDataFrame(list(enumerate(lines)), "slot long, value string")
    return rows.select("value", *place_columns(F.col("slot")))


def by_title(df, title):
    return op.filter_rules(df, [op.FieldRule(2, lambda value: value == title)])


def rebuilt(lines, tuples):
    return [r["value"] for r in op.rebuild_dump(lines, tuples).orderBy(*op.PLACE).collect()]


def ids(tuples):
    return [r["id"] for r in op.tuple_ids(tuples).orderBy(*op.PLACE, "pos").collect()]


def values(spark, text, position):
    tuples = op.parse_dump_tuples(frame(spark, [insert(text)]))
    return [r[0] for r in tuples.orderBy("pos").select(op.field(position)).collect()]


def text_of(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


def test_filter_line(spark):
    lines = frame(spark, [insert(COMPUTING, ELEMENTS, ANARCHISM, HISTORY)])
    tuples = by_title(op.parse_dump_tuples(lines), "Anarchism")
    assert rebuilt(lines, tuples) == [insert(ANARCHISM)]
    assert ids(tuples) == [12]


def test_quotes_parentheses_and_commas(spark):
    lines = frame(spark, [insert(COMPUTING, SCOUT, STARCRAFT, ELEMENTS)])
    tuples = op.parse_dump_tuples(lines)
    assert ids(by_title(tuples, "StarCraft_(video_game)")) == [26809]
    assert ids(by_title(tuples, "Euclid's_Elements")) == [246424]
    assert [r["n"] for r in tuples.select(F.size("fields").alias("n")).collect()] == [13] * 4
    assert rebuilt(lines, tuples) == [insert(COMPUTING, SCOUT, STARCRAFT, ELEMENTS)]


@pytest.mark.parametrize(
    "written, read",
    [
        ("'Paris,_Texas'", "Paris,_Texas"), ("'a);b'", "a);b"), ("'It''s'", "It's"), ("''", ""), ("NULL", None),
        (r"'ends_\\'", "ends_\\"), (r"'a\\\'b'", "a\\'b"), (r"'\\n'", "\\n"), (r"'\n'", "\n"), ("", ""),
        ("'ü€'", "ü€"), (r"'\'\''", "''"), ("' \u0085'", " \u0085"),
    ],
)
def test_field_values(spark, written, read):
    assert values(spark, f"(1,0,{written},2)", 2) == [read]
    assert values(spark, f"(1,0,{written},2)", 3) == ["2"]


def test_page_dump_end_to_end(spark, tmp_path):
    dump = tmp_path / "page.sql"
    dump.write_text(f"{HEADER}\n{insert(COMPUTING, ANARCHISM, HISTORY)}\n{insert(COMPUTING)}\n{FOOTER}\n")
    (tmp_path / "titles.tsv").write_text("Anarchism\t10\nfoo\t1\nbad line\na\tb\tc\n")
    lines = source.read_lines(spark, str(dump))
    titles = source.read_ranked_titles(spark, str(tmp_path / "titles.tsv"))
    assert {r[0] for r in titles.collect()} == {"Anarchism", "foo"}
    tuples = filter_tuples(lines, titles=titles)
    sinks.write_dump(op.rebuild_dump(lines, tuples), str(tmp_path / "out"))
    sinks.write_ids(op.tuple_ids(tuples), str(tmp_path / "ids"))
    assert text_of(tmp_path / "out") == [HEADER, insert(ANARCHISM), FOOTER]
    assert text_of(tmp_path / "ids") == ["12"]


def test_pagelinks_dump_end_to_end(spark, tmp_path):
    line = insert("(12,0,'foo',0)", "(12,0,'bar')", "(1,0,'foo',0)", table="pagelinks")
    lines = frame(spark, [HEADER, line, FOOTER])
    (tmp_path / "ids.txt").write_text("12\nx\n 5\n")
    listed = source.read_id_list(spark, str(tmp_path / "ids.txt"))
    assert [r[0] for r in listed.collect()] == [12]
    titles = spark.createDataFrame([("Anarchism",), ("foo",), ("foo",)], "page_title string")
    tuples = filter_tuples(lines, titles=titles, ids=listed)
    assert rebuilt(lines, tuples) == [HEADER, insert("(12,0,'foo',0)", table="pagelinks"), FOOTER]


def test_short_tuples_pass_rules_on_missing_fields(spark):
    tuples = op.parse_dump_tuples(frame(spark, [insert("(1,0)", "(2,0,'no')", "(3)", "(4,0,'yes')")]))
    titles = spark.createDataFrame([("yes",)], "page_title string")
    assert sorted(ids(op.semi_by_title(op.filter_main_ns(tuples), titles))) == [1, 3, 4]


def test_keys_and_namespaces_must_be_integers(spark):
    tuples = op.parse_dump_tuples(frame(spark, [insert("(x,0,'a')", "('1',0,'b')", "(2,'0','c')", "(3,n,'d')", "(4,1,'e')")]))
    assert ids(op.filter_main_ns(tuples)) == [2]


def test_other_and_empty_lines(spark):
    lines = frame(spark, ["", "-- comment", insert("(1,0,'a')"), "INSERT INTO `t` VALUES ;", insert("(2,0,'b')")])
    tuples = by_title(op.parse_dump_tuples(lines), "b")
    assert rebuilt(lines, tuples) == ["-- comment", "INSERT INTO `t` VALUES ;", insert("(2,0,'b')")]


@pytest.mark.parametrize("text", ["(1) ,(2)", "(1), (2)", "(1)\t,\n (2)"])
def test_blanks_between_tuples(spark, text):
    tuples = op.parse_dump_tuples(frame(spark, [insert(text)]))
    assert ids(tuples) == [1, 2] and rebuilt(frame(spark, []), tuples) == [insert("(1),(2)")]


@pytest.mark.parametrize("text", ["(1,(2),3)", "(1)(2)", "(1),,(2)", "(1) (2)", "(1), x (2)"])
def test_malformed_lists(spark, text):
    lines = frame(spark, [insert(text), insert("(7)")])
    with pytest.raises(Exception, match="malformed"):
        op.parse_dump_tuples(lines).collect()
    assert ids(op.parse_dump_tuples(lines, "drop")) == [7]
    assert [r["value"] for r in op.malformed_inserts(lines).collect()] == [insert(text)]


def test_chunks(spark, tmp_path):
    lines = [HEADER] + [insert(f"({i},0,'t{i}')") for i in range(9)] + [FOOTER]
    (tmp_path / "d.sql").write_text("\n".join(lines) + "\n")
    numbered = source.scan_dump(spark, str(tmp_path / "d.sql"))
    dump = op.with_chunk(op.rebuild_dump(numbered, op.parse_dump_tuples(numbered), ["line_no"]), 4)
    sinks.write_dump_chunks(dump, str(tmp_path / "out"))
    for k in range(3):
        assert text_of(tmp_path / "out" / f"chunk={k}") == lines[4 * k : 4 * k + 4]
    assert op.skip_chunks(dump, 1).count() == 7
    whole = op.with_chunk(dump.drop("chunk"), 0)
    assert op.skip_chunks(whole, 0).count() == 11 and op.skip_chunks(whole, 1).count() == 0


def test_three_dumps(spark):
    page = frame(spark, [insert(COMPUTING, ANARCHISM, STARCRAFT)])
    links = frame(spark, [insert("(12,0,'StarCraft_(video_game)',0)", "(12,0,'Nowhere',0)", "(10,0,'Anarchism',0)", table="pagelinks")])
    categories = frame(spark, [insert("(12,'Politics')", "(10,'Redirects')", table="categorylinks")])
    titles = spark.createDataFrame([("Anarchism",), ("StarCraft_(video_game)",)], "page_title string")
    done = filter_dumps(page, links, categories, titles)
    assert sorted(r["id"] for r in done.page_ids.collect()) == [12, 26809]
    assert [tuple(r) for r in op.as_table(done.pagelinks, op.PAGELINKS).collect()] == [(12, 0, "StarCraft_(video_game)", 0)]
    assert [tuple(r) for r in op.as_table(done.categorylinks, op.CATEGORYLINKS).collect()] == [(12, "Politics")]


def test_bytes_survive(spark, tmp_path):
    line = b"INSERT INTO `c` VALUES (1,'\xff\xfe\\'\xc3'),(2,'ok');"
    (tmp_path / "c.sql").write_bytes(line + b"\n")
    lines = source.read_lines(spark, str(tmp_path / "c.sql"))
    sinks.write_dump(op.rebuild_dump(lines, op.parse_dump_tuples(lines)), str(tmp_path / "out"))
    (part,) = [p for p in (tmp_path / "out").glob("part-*") if p.stat().st_size]
    assert part.read_bytes() == line + b"\n"


def test_very_long_line(spark):
    tuples = [f"({i},0,'a);b_\\'x,({i})','',0,NULL)" for i in range(60_000)]
    lines = frame(spark, [insert(*tuples)])
    parsed = op.parse_dump_tuples(lines)
    assert parsed.count() == 60_000
    kept = by_title(parsed, "a);b_'x,(59999)")
    assert rebuilt(lines, kept) == [insert(tuples[-1])]


def test_dump_texts_move_once(spark, monkeypatch):
    """The derived dumps: what is stored on the way holds columns, and only the dump itself the texts of its lines."""
    from linkloom.catalog import inputs
    from linkloom.operators import positions

    stored = []
    for module in (inputs, positions):
        keep = module.written
        monkeypatch.setattr(module, "written", lambda df, label, keep=keep: stored.append((label, df.columns)) or keep(df, label))
    monkeypatch.setattr(inputs, "_stored", {})
    made = inputs.Inputs(spark, "/root/testdata/sf0.001")
    lines = [r["value"] for r in source.read_lines(spark, made.dump("page")).orderBy("file", "block", "slot").collect()]
    assert [label for label, _ in stored] == ["page", "placed"] and "tuple" not in stored[1][1]
    assert lines[0] == "-- block 0" and lines[1].startswith("INSERT INTO `page` VALUES (0,") and lines[-2:] == ["/* Footer */", ""]
    assert len(lines) == 2 * -(-made.page.count() // inputs.TUPLES_PER_LINE) + 2
