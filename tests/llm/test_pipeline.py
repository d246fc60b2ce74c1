"""The pipeline against plain Python, stage by stage and as a whole."""

from brute import exact_groups, local_alignment, near_components, words
from compare import TABLES  # noqa: F401  the folder of tests is on the path
from conftest import DATA

import corpus_pipeline
from linkloom.llm.mixing import REST, WEIGHTS, frame_schedule


def test_whole_pipeline(spark, rows):
    docs = [r for r in rows if any(c.isalpha() for c in r["text"] or "")]
    exact = exact_groups(docs)
    docs = [r for r in docs if exact[r["doc_id"]][2]]
    near = near_components(docs, 5)
    docs = [r for r in docs if near[r["doc_id"]][1] == r["doc_id"]]
    items = [words(r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = []
    for r in docs:
        text = words(r["text"])
        shared = [i for i in items if {*zip(i, i[1:], i[2:])} & {*zip(text, text[1:], text[2:])}]
        if not any(local_alignment(i, text) >= len(i) for i in shared):
            clean.append(r["doc_id"])
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_slot", "mix_place"]
    out = got.collect()
    assert sorted(r["doc_id"] for r in out) == sorted(clean) and len(clean) < len(rows)
    source = {r["doc_id"]: r for r in rows}
    assert all(source[r["doc_id"]]["text"] == r["text"] for r in out)
    # The first slots follow the schedule as long as all sources last.
    frame = frame_schedule([*WEIGHTS.values(), REST])
    names = [*WEIGHTS, None]
    for r in out:
        named = r["source"] if r["source"] in WEIGHTS else None
        assert names[frame[r["mix_slot"] % len(frame)][0]] == named


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    assert corpus_pipeline.ORACLE_SQL is None
