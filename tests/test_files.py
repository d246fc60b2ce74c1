"""The whole chain from files to vectors, through the command line."""

import gzip
import os

import pytest

from linkloom.__main__ import main


def text_of(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


def test_chain(spark, tmp_path):
    titles = [f"Page_{i}" for i in range(12)]
    views, dumps, out = tmp_path / "views", tmp_path / "dumps", tmp_path / "out"
    views.mkdir(), dumps.mkdir()
    with gzip.open(views / "pageviews-20190101-000000.gz", "wt") as log:
        for i, title in enumerate(titles):
            log.write(f"en {title} {100 - i} 0\n")
        log.write("en Unknown 1 0\nen.m Page_0 5 0\n")
    main(["rank", "--input-path", str(views), "--output-path", str(out), "--limit", "12", "--shards", "2"])
    assert text_of(out / "pagecounts-summary") == [f"{t}\t{100 - i}" for i, t in enumerate(titles)]
    assert len(list((out / "pagecounts").glob("shard=*"))) == 2

    pages = ",".join(f"({i},0,'{t}','',0,0)" for i, t in enumerate(titles + ["Other"]))
    links = [f"({i},0,'Page_{j}',0)" for i in range(13) for j in range(12) if (i + j) % 3]
    categories = ",".join(f"({i},'cat_{i % 2}')" for i in range(13))
    (dumps / "x-page.sql").write_text(f"-- pages\nINSERT INTO `page` VALUES {pages};\n")
    (dumps / "x-pagelinks.sql").write_text("".join(f"INSERT INTO `pagelinks` VALUES {t};\n" for t in links))
    (dumps / "x-categorylinks.sql").write_text(f"INSERT INTO `categorylinks` VALUES {categories};\n")
    ranked = str(out / "pagecounts-summary")
    main(["filter-all", "--input-path", str(dumps), "--output-path", str(out), "--base", "x", "--page-filter", ranked, "--chunk-size", "10"])
    assert text_of(out / "page-indices.txt") == [str(i) for i in range(12)]
    kept = [t for t in links if not t.startswith("(12,")]
    chunks = sorted((out / "x-filtered-pagelinks.sql").glob("chunk=*"), key=lambda p: int(p.name[6:]))
    assert [line for c in chunks for line in text_of(c)] == [f"INSERT INTO `pagelinks` VALUES {t};" for t in kept]
    assert text_of(chunks[1]) == [f"INSERT INTO `pagelinks` VALUES {t};" for t in links[10:20]]

    skipped = str(out / "skipped.sql")
    main(["filter", "--input-path", str(dumps / "x-pagelinks.sql"), "--output-path", skipped, "--index-output", str(out / "some-ids"), "--chunk-size", "50", "--skip", "1"])
    assert [line for c in sorted((out / "some-ids").glob("chunk=*")) for line in text_of(c)] == [
        t[1:].split(",")[0] for t in links[50:]
    ]

    tables, names, groups = out / "tables", str(out / "names"), str(out / "groups")
    for table in ("page", "pagelinks", "categorylinks"):
        source = out / f"x-filtered-{table}.sql"
        main(["load", "--path", str(source), "--table", table, "--output-path", str(tables / table)])
    main(["count", "--tables", str(tables), "--page-dictionary", names, "--category-file", groups, "--min-links", "5"])
    assert text_of(out / "names") == titles and text_of(out / "groups") == ["cat_0", "cat_1"]
    main(["matrix", "--tables", str(tables), "--page-dictionary", names, "--category-file", groups, "--output-path", str(out / "cells"), "--shards", "3"])
    assert spark.read.parquet(str(out / "cells")).count() == 2 * len(kept) + 12
    main(["zeros", "--input-path", str(out / "cells"), "--page-dictionary", names, "--category-file", groups, "--output-path", str(out / "all-cells"), "--shards", "2", "--factor", "0.5"])
    assert spark.read.parquet(str(out / "all-cells")).groupBy("value").count().count() == 2
    for _ in range(2):
        main(["train", "--matrix-path", str(out / "all-cells"), "--page-dictionary", names, "--output-path", str(out / "model"), "--k", "2", "--epochs", "2"])
    # The same from binary shards, some of them empty, and begun afresh.
    dictionaries = ["--page-dictionary", names, "--category-file", groups]
    main(["matrix", "--tables", str(tables), *dictionaries, "--output-path", str(out / "bin"), "--shards", "40", "--binary"])
    assert len(list((out / "bin").glob("data.bin.*-of-00040"))) == 40
    assert sum(p.stat().st_size for p in (out / "bin").glob("data.bin.*")) == 12 * (2 * len(kept) + 12)
    main(["zeros", "--input-path", str(out / "bin"), *dictionaries, "--output-path", str(out / "all-bin"), "--shards", "2", "--factor", "0.5", "--binary"])
    for _ in range(2):
        main(["train", "--matrix-path", str(out / "all-bin"), "--page-dictionary", names, "--output-path", str(out / "again"), "--k", "2", "--epochs", "2", "--fresh"])
    assert [r["epoch"] for r in spark.read.parquet(str(out / "again" / "history")).orderBy("epoch").collect()] == [0, 1]
    main(["matrix", "--tables", str(tables), *dictionaries, "--output-path", str(out / "one"), "--shards", "3", "--shard-id", "1"])
    whole = spark.read.parquet(str(out / "cells")).where("shard = 1").select("row", "col")
    assert sorted(spark.read.parquet(str(out / "one")).select("row", "col").collect()) == sorted(whole.collect())
    history = spark.read.parquet(str(out / "model" / "history")).orderBy("epoch").collect()
    assert [r["epoch"] for r in history] == [0, 1, 2, 3]
    assert history[-1]["loss"] <= history[0]["loss"]
    vectors = text_of(out / "model" / "vectors.tsv")
    assert len(vectors) == 12 and all(len(v.split("\t")) == 2 for v in vectors)


def test_ranking_jobs(spark, tmp_path):
    views, out = tmp_path / "views", tmp_path / "out"
    views.mkdir()
    log = gzip.compress("".join(f"en {t} {n} 0\n" for t, n in (("A", 5), ("Talk:A", 9), ("B", 4), ("C", 3))).encode())
    (views / "pageviews-20190101-000000.gz").write_bytes(log)
    (views / "pageviews-20190101-010000.gz").write_bytes(gzip.compress(b"en D 2 0\nen broken\n"))
    (views / "pageviews-20190101-020000.gz").write_bytes(b"no gzip")
    (views / "pageviews-20190101-030000.gz").write_bytes(gzip.compress(os.urandom(5000))[:-500])
    base = ["rank", "--input-path", str(views), "--on-error", "drop"]
    with pytest.raises(Exception):
        main([*base, "--output-path", str(tmp_path / "fails")])
    main([*base, "--output-path", str(out), "--skip-corrupt", "--shards", "3"])
    assert text_of(out / "pagecounts-summary") == ["A\t5", "B\t4", "C\t3", "D\t2"]
    assert text_of(out / "rejected") == ["en broken"]
    names = [line.split("\t")[0].rsplit("/", 1)[1] for line in text_of(out / "skipped")]
    assert sorted(names) == ["pageviews-20190101-020000.gz", "pageviews-20190101-030000.gz"]
    for shard in range(3):
        main([*base, "--output-path", str(tmp_path / f"s{shard}"), "--skip-corrupt", "--shards", "3", "--shard-id", str(shard)])
    parts = [p for s in range(3) for p in (tmp_path / f"s{s}" / "pagecounts").glob("shard=*/part-*")]
    assert sorted(line for p in parts for line in p.read_text().splitlines()) == ["A\t5", "B\t4", "C\t3", "D\t2"]
    shards = tmp_path / "shards"
    shards.mkdir()
    for i, p in enumerate(parts):
        (shards / f"pagecounts-{i}").write_text(p.read_text())
    for limit, want in ((-1, 4), (2, 2), (0, 0)):
        main(["merge", "--input-path", str(shards), "--output-path", str(tmp_path / f"merged{limit}"), "--limit", str(limit)])
        assert text_of(tmp_path / f"merged{limit}") == ["A\t5", "B\t4", "C\t3", "D\t2"][:want]
    (tmp_path / "ranking.tsv").write_text("Talk:X\t9\nA\t5\nUser:Y\t3\nB\t1\n")
    main(["clean", "--input-path", str(tmp_path / "ranking.tsv"), "--output-path", str(tmp_path / "clean")])
    assert text_of(tmp_path / "clean") == ["A\t5", "B\t1"]


def test_rejected_inserts_are_written(spark, tmp_path):
    (tmp_path / "d.sql").write_text("INSERT INTO `t` VALUES (1),(2);\nINSERT INTO `t` VALUES (1)x(2);\n")
    main(["filter", "--input-path", str(tmp_path / "d.sql"), "--output-path", str(tmp_path / "f"), "--on-error", "drop"])
    assert text_of(tmp_path / "f") == ["INSERT INTO `t` VALUES (1),(2);"]
    assert text_of(tmp_path / "f-rejected") == ["INSERT INTO `t` VALUES (1)x(2);"]


def test_natural_file_order(spark):
    from pyspark.sql import functions as F

    from linkloom.functions.text import natural_key

    names = ["a/part-99999", "a/part-100000", "a/part-9", "b", "aa", "part-10.x2", "part-10.x10", "part-9"]
    got = [r["n"] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(natural_key(F.col("n"))).collect()]
    assert got == ["a/part-9", "a/part-99999", "a/part-100000", "aa", "b", "part-9", "part-10.x2", "part-10.x10"]


def test_other_stores_are_refused_early(spark):
    from linkloom.sources.coo import read_coo

    with pytest.raises(ValueError, match="wasbs"):
        read_coo(spark, "wasbs://c@a.example/x")


def test_many_chunks_are_written_by_many_tasks(spark, tmp_path):
    from linkloom.sources import sinks
    from linkloom.sources.chunks import read_chunks

    rows = [(i // 3, i, bytearray(b"a\xff%d" % i) if i % 5 else bytearray()) for i in range(1200)]
    rows += [(400, 1200 + i, bytearray(b"long %d" % i)) for i in range(2000)]
    lines = spark.createDataFrame(rows, "chunk bigint, line_no bigint, value binary")
    out = tmp_path / "out"
    sinks.write_dump_chunks(lines.withColumn("value", lines["value"].cast("string")), str(out))
    parts = {p.name.split(".")[0][:10] for p in out.glob("chunk=*/part-*")}
    assert len(parts) > 1 and (out / "_SUCCESS").exists() and not list(out.glob("chunk=*/.*"))
    for chunk in (0, 7, 399, 400):
        want = [bytes(v) for c, _, v in rows if c == chunk]
        assert b"".join(p.read_bytes() for p in sorted(out.glob(f"chunk={chunk}/part-*"))) == b"".join(v + b"\n" for v in want)
    back = read_chunks(spark, str(out))
    got = [(r["chunk"], bytes(r["v"])) for r in back.selectExpr("*", "cast(value as binary) v").orderBy("chunk", "file", "slot").collect()]
    assert got == [(c, bytes(v)) for c, _, v in rows]
    with pytest.raises(FileExistsError):
        sinks.write_dump_chunks(lines.withColumn("value", lines["value"].cast("string")), str(out))
