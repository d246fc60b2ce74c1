"""Words, pages, personal data, WARC records and token counts."""

import gzip
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from brute import base_spans, repeated_runs, words
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import extraction, html, pii, token_counts, warc
from linkloom.llm import words as word_op
from linkloom.llm.queries import QUERIES


@given(st.lists(st.text(st.sampled_from("aB é\t\n\x0b\xa0")), max_size=8))
@settings(max_examples=200, deadline=None)
def test_words_by_bytes(texts):
    found = word_op.words_of(pa.array([*texts, None], pa.string()))
    names = {}
    for i, text in enumerate([*texts, None]):
        own = slice(found.bounds[i], found.bounds[i + 1])
        raw = (text or "").encode()
        cut = [raw[a:b].lower().decode() for a, b in zip(found.starts[own], found.ends[own], strict=True)]
        assert cut == words(text)
        for w, h in zip(cut, found.hashes[own].tolist(), strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_words_of_long_texts_are_cut_at_white_space(monkeypatch):
    texts = pa.array(["ab cde " * 50, "x" * 300 + " y", "", "z"])
    whole = word_op.words_of(texts)
    monkeypatch.setattr(word_op, "SLICE_BYTES", 16)
    assert all(np.array_equal(a, b) for a, b in zip(whole, word_op.words_of(texts), strict=True))


PAGE = """<!doctype html><html lang=en><head><title>T</title><style>p{}</style></head><body><header>Site</header>
<nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article class="post"><header><h1>A &amp; B</h1></header><p>One  <b>bold</b><br>two&nbsp;three<p>Four &lt;5&#x21;
<script>if (a < b) { "</p>" }</script><div class="ad">Buy</div><form>Mail <input></form><aside>See also</aside>
<section id="comments"><p>First!</p></section></article><footer>&copy; x</footer></body></html>"""


def test_article_of_a_page():
    assert extraction.decided_blocks(PAGE) == (True, ["A & B", "One bold two three", "Four <5!"])
    assert extraction.decided_blocks("<div>plain &lt; text</div><nav>no</nav>") == (False, ["plain < text"])
    assert extraction.decided_blocks("") == (False, [])
    assert extraction.decided_blocks('<p title="a > b">yes</p><p hidden>no</p>') == (False, ["yes"])


@pytest.mark.parametrize(
    "menu",
    [
        "<nav><ul>" + "<li>entry" * 300 + "</ul></nav>",
        "<nav><dl>" + "<dt><div>term<dd>entry" * 200 + "</dl></nav>",
        "<form><select>" + "<option>entry" * 300 + "</select></form>",
        "<nav><table>" + "<tr><th>a<td><div>entry" * 200 + "</table></nav>",
        "<nav>" + "<b>" * 300 + "entry</nav>",
        "<ul><li class=ad>entry<li hidden>entry</ul>",
        "<p class=ad>entry",
    ],
)
def test_end_tags_left_out_lose_no_article(menu):
    assert extraction.decided_blocks(f"<body>{menu}<div><p>One<p>two</div>") == (False, ["One", "two"])
    assert extraction.decided_blocks(f"<body>{menu}<article><p>One<p>two</article>") == (True, ["One", "two"])


def test_list_items_end_at_the_next_one_only():
    page = "<ul><li class=ad>no<ul><li>no</ul>no<li>yes<ul><li>yes</ul>yes</ul><table><tr><td class=ad>no<table><tr><td>no</table>no<td>yes</table>"
    assert {b.kind: {x.text for x in html.blocks_of(page) if x.kind == b.kind} for b in html.blocks_of(page)} == {"boilerplate": {"no"}, "plain": {"yes"}}


@pytest.mark.parametrize("begin", ["<head><title>T</title><meta x=1>", "<head><title>T", "<html><head><style>p{}</style>"])
@pytest.mark.parametrize("body", ["<body><p>text</p>", "<p>text", "<div>text</div></body>", "text"])
def test_head_without_end_tag(begin, body):
    if begin.endswith("<title>T") and body == "text":
        body = "<body>text"
    assert extraction.decided_blocks(begin + body) == (False, ["text"])
    assert warc.plain_text(begin + body) == "text"


@pytest.mark.parametrize("quote", ["'", '"'])
def test_long_quoted_attributes_do_not_spill(quote):
    page = f"<div data-x = {quote}{'x' * 5000} <p> {'>' * 5000}{quote} title=a>text</div>"
    assert extraction.decided_blocks(page) == (False, ["text"]) and warc.plain_text(page) == "text"


@pytest.mark.parametrize("broken", ["<", "<!--", "<script>", '<div a="', "<p>", "</div>", "<textarea>", "<x y=1 ", "&", "<div>"])
def test_broken_markup_takes_linear_time(broken):
    assert len(list(html.blocks_of(broken * 20_000))) <= 1
    assert isinstance(warc.plain_text(broken * 20_000), str)


@pytest.mark.parametrize("broken", ["<a ", "<html ", "<a href ", "<html lang", "<a b='", '<a href="x', "<title "])
def test_long_payloads_are_derived_in_linear_time(broken):
    import time

    source = {"source_key": 1, "record_id": None, "target_uri": None, "date": None, "headers": None}
    began = time.perf_counter()
    records = list(warc.derive({**source, "payload": broken * (1_000_000 // len(broken)) + "><p>text"}))
    assert time.perf_counter() - began < 15 and [r["warc_type"] for r in records] == ["metadata", "conversion"]


@pytest.mark.parametrize(
    "begin, end",
    [
        ('<div class="page-with-sidebar"><article>', "</article></div>"), ('<div class="no-sidebar"><main>', "</main></div>"),
        ('<article class="post comments-open">', "</article>"), ('<section id="related-work"><article>', "</article></section>"),
        ('<form id="page-form"><div><article>', "</article></div></form>"), ('<div class="has-menu"><div class="left-sidebar"><main>', "</main></div></div>"),
        ('<main class="site-header"><div class="post-header">', "</div></main>"),
    ],
)
def test_names_of_elements_around_an_article_do_not_remove_it(begin, end):
    body = '<p>One</p><section class="related-work"><p>Two</p></section><div class="comment-list"><p>no</p></div><form><p>no</p></form>'
    page = f'<nav>no</nav><body class="no-nav">{begin}{body}{end}<div class="site-footer">no</div>'
    assert extraction.decided_blocks(page) == (True, ["One", "Two"])


def test_articles_in_elements_with_compound_names():
    teaser = '<div class="related-posts"><article>Teaser</article></div>'
    # Beside another article it is a teaser; alone, or among its like, it is what the page has.
    assert extraction.decided_blocks(f"{teaser}<form><article>Text</article></form>{teaser}") == (True, ["Text"])
    assert extraction.decided_blocks(f'{teaser}<div class="left-sidebar"><main>Text</main></div>') == (True, ["Teaser", "Text"])
    assert extraction.decided_blocks(f'<div class="page-wrap"><form>{teaser}</form></div>') == (True, ["Teaser"])


def test_title_and_lead_beside_the_article():
    page = "<main><h1>Title</h1><p>Lead</p><article><p>Text</p></article><aside>no</aside></main><p>no</p>"
    assert extraction.decided_blocks(page) == (True, ["Title", "Lead", "Text"])
    assert extraction.decided_blocks("<main><p>All of it</p><article>Teaser</article></main>") == (True, ["All of it", "Teaser"])
    assert extraction.decided_blocks('<div class="comments"><article>no</article></div><p>yes</p>') == (False, ["yes"])


def test_extraction_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = QUERIES["op6_extraction"](spark, DATA).collect()
    assert len(got) == len(pages)
    from html import unescape

    for r in got:
        inside = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.DOTALL)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_repeated_runs_of_a_host():
    draw = random.Random(1)
    for _ in range(40):
        streams = [[draw.randrange(3) for _ in range(draw.randrange(30))] for _ in range(draw.randrange(1, 8))]
        least = max(2, -(-3 * len({tuple(s) for s in streams}) // 10))
        got = extraction.repeated_tokens([np.array(s, dtype=np.int64) for s in streams], 0.3)
        assert [g.tolist() for g in got] == repeated_runs(streams, 8, least)


def test_host_boilerplate_without_markup(spark):
    bar = "home about contact imprint privacy terms help search now"
    pages = [(i, f"http://h.org/{i}", f"<div>{bar}</div><div>{' '.join(f'u{i}x{j}' for j in range(40))}</div>") for i in range(20)]
    pages += [(100, "http://h.org/m", "<main>kept</main>"), (101, None, None), (102, "", ""), (103, "http://one.org", f"<div>{bar}</div>")]
    pages += [(0, "http://h.org/0", pages[0][2])]
    got = extraction.extract_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(pages)
    assert all(texts[i] == " ".join(f"u{i}x{j}" for j in range(40)) for i in range(20))
    assert texts[100] == "kept" and texts[101] == texts[102] == "" and texts[103] == bar


def test_extraction_is_the_same_for_any_size_of_host(spark, monkeypatch):
    bars = ["home about contact imprint privacy terms help search now", "one two three four five six seven eight nine"]
    own = [" ".join(f"u{i}x{j}" for j in range(5 + 7 * (i % 6))) for i in range(60)]
    # Every third page has the second bar, every tenth a third one, which is too seldom; some are mirrored or decided by their markup.
    bodies = [f"<div>{bars[0]}</div><div>{own[i]} {bars[1] if i % 3 == 0 else ''}</div><p>{'a b c d e f g h ' if i % 10 == 0 else 'x'}</p>" for i in range(60)]
    bodies += [f"<main>{bars[1]}</main>", bodies[3], f"<div>{bars[0]}</div>", "", None]
    pages = spark.createDataFrame([(i, "http://h.org/p", b) for i, b in enumerate(bodies)], "page_id bigint, url string, html string")
    whole = {r["page_id"]: (r["text"], r["n_chars"]) for r in extraction.extract_text(pages).collect()}
    assert len(whole) == len(bodies) and whole[1][0] == own[1] + "\nx" and whole[0][0] == own[0] + "\na b c d e f g h" and whole[60][0] == bars[1]
    for pages_limit, bytes_limit in ((8, 8 << 20), (1, 8 << 20), (256, 100)):
        monkeypatch.setattr(extraction, "SHARD_PAGES", pages_limit)
        monkeypatch.setattr(extraction, "SHARD_BYTES", bytes_limit)
        got = {r["page_id"]: (r["text"], r["n_chars"]) for r in extraction.extract_text(pages.repartition(5)).collect()}
        assert got == whole


def test_extraction_of_shards_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(extraction, "SHARD_PAGES", 8)
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    assert extraction.extract_text(pages).count() == pages.count()
    assert extraction.extract_text(pages.limit(0)).count() == 0


@given(st.text(st.sampled_from("aB.@@+-12345678901234 ()%_é"), max_size=60))
@settings(max_examples=2000, deadline=None)
def test_base_spans_are_those_of_the_patterns(text):
    assert [s for s in pii.personal_spans(text) if s[0] in pii.BASE_KINDS] == base_spans(text)


def test_added_kinds():
    text = "Account no: 123456789, IBAN DE89 3704 0044 0532 0130 00 ok http://bob:pw@x.org"
    added = {(k, text[a:b]) for k, a, b in pii.personal_spans(text) if k in pii.ADDED_KINDS}
    assert added == {("account", "123456789"), ("account", "DE89 3704 0044 0532 0130 00"), ("userinfo", "bob:pw")}


def test_pii_query(spark, rows, awkward, nothing):
    import hashlib

    got = {r["doc_id"]: r for r in QUERIES["op8_pii"](spark, DATA).collect()}
    found = 0
    for d in rows:
        spans, r = base_spans(d["text"]), got[d["doc_id"]]
        found += len(spans)
        assert r["base_sha256"] == hashlib.sha256(pii.joined(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]
        assert r["spans"] == pii.joined(pii.personal_spans(d["text"] or ""))
    assert found > 0
    assert pii.find_personal(awkward).count() == awkward.count() and pii.span_digests(pii.find_personal(nothing)).count() == 0


def test_warc_records(spark):
    source = {"source_key": 1, "record_id": "<urn:uuid:1>", "target_uri": "http://x.org/é", "date": "2026-01-01T00:00:00Z",
              "headers": [{"name": "Server", "value": "s"}, {"name": "Empty", "value": None}], "payload": PAGE}
    records = list(warc.derive(source))
    assert [r["warc_type"] for r in records] == ["metadata", "conversion"]
    for record in records:
        (headers, block), = warc.parse(warc.serialise(record))
        assert block.decode() == record["block"] and int(headers["Content-Length"]) == len(block) == record["content_length"]
        assert headers["WARC-Block-Digest"] == warc.digest(block) == record["block_digest"]
        assert headers["WARC-Refers-To"] == "<urn:uuid:1>" and headers["WARC-Source-Payload-Digest"] == warc.digest(PAGE.encode())
        assert headers["WARC-Target-URI"] == "http://x.org/é" and headers["WARC-Date"] == source["date"]
    headers = {r["warc_type"]: {h["name"]: h["value"] for h in r["headers"]} for r in records}
    assert headers["metadata"]["WARC-Concurrent-To"] == headers["conversion"]["WARC-Record-ID"] and "WARC-Concurrent-To" not in headers["conversion"]
    assert "source-Server: s\r\n" in records[0]["block"] and "outlink: /a\r\n" in records[0]["block"] and "title: T\r\n" in records[0]["block"]
    assert "A & B\nOne bold\ntwo three\nFour <5!" in records[1]["block"] and "p{}" not in records[1]["block"]
    whole = b"".join(gzip.decompress(warc.serialise(r)) for r in records)
    assert len(list(warc.parse(whole))) == 2


def test_warc_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = QUERIES["op2_warc"](spark, DATA)
    rows = got.collect()
    assert len(rows) == 2 * len(pages) and len({r["record_id"] for r in rows}) == len(rows)
    for r in rows:
        page = pages[r["page_id"]]
        assert r["target_uri"] == page["url"] and r["source_digest"] == warc.digest(page["html"].encode())
        assert r["block_digest"] == warc.digest(r["block"].encode())
    assert len({r["refers_to"] for r in rows}) == len(pages)
    content = b"".join(r["content"] for r in warc.serialised(got).collect())
    assert sum(1 for _ in warc.parse(content)) == len(rows)


def test_warc_awkward(spark):
    kinds = f"source_key bigint, record_id string, target_uri string, date string, headers {warc.HEADERS}, payload string, block string"
    docs = spark.createDataFrame([(None, None, None, None, None, None, "own"), (1, None, None, None, [], "", "own")], kinds)
    got = warc.derivatives(docs).collect()
    assert len(got) == 4 and all(r["record_id"] for r in got) and sum(r["content_length"] == 0 for r in got) == 2
    assert warc.derivatives(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.read_ranks())


def test_edited_trees_count_like_the_tokenizer(counter):
    draw = random.Random(3)
    parts = ["a", "B", "'", " ", "  ", "\n", "12", "é", "ll", "'s", "!", ".", " the", "tion", "ß ", "\t"]
    for _ in range(600):
        tree = token_counts.TokenTree("".join(draw.choices(parts, k=draw.randrange(400))), counter)
        for _ in range(draw.randrange(1, 6)):
            start = draw.randint(0, len(tree.text))
            end = min(len(tree.text), start + draw.choice([0, 0, 1, 2, 5, 50, 300]))
            tree.edit(start, end, "".join(draw.choices(parts, k=draw.choice([0, 1, 2, 200]))))
            assert tree.tokens == len(counter.encoding.encode_ordinary(tree.text))
            assert sum(tree.lengths) == len(tree.text) and tree.tokens_of(0, len(tree.lengths)) == tree.tokens
    with pytest.raises(ValueError):
        token_counts.TokenTree("ab", counter).edit(1, 5, "")


def test_edits_touch_a_small_part(counter):
    tree = token_counts.TokenTree("some words and numbers 12, " * 20_000, counter)
    tree.edit(200_000, 200_004, "x")
    assert 0 < tree.encoded < 1000 and tree.tokens == len(counter.encoding.encode_ordinary(tree.text))


def test_token_query(spark, rows, counter, awkward, nothing):
    from pyspark.sql import functions as F

    got = {r["doc_id"]: r for r in QUERIES["op9_token_counts"](spark, DATA).collect()}
    for d in rows:
        text, r = d["text"] or "", got[d["doc_id"]]
        assert r["n_tokens"] == len(counter.encoding.encode_ordinary(text))
        for start, end, new in reversed(token_counts.mask_edits(text)):
            text = text[:start] + new + text[end:]
        assert r["n_tokens_edited"] == len(counter.encoding.encode_ordinary(text)) and r["n_chars_edited"] == len(text)
    edits = F.expr("array(named_struct('start', 0L, 'end', 0L, 'replacement', 'put in'))")
    done = token_counts.edited_counts(awkward.withColumn("edits", edits)).collect()
    assert len(done) == awkward.count() and all(r["n_edits"] == 1 and r["n_tokens_edited"] >= 2 for r in done)
    assert token_counts.edited_counts(nothing.withColumn("edits", edits)).count() == 0


def test_stored_trees_take_edits_round_by_round(spark, counter, tmp_path):
    from pyspark.sql import functions as F

    draw, parts = random.Random(8), ["word ", "don't, ", "7 8", " \u00e9t\u00e9", "!!", "\n\n", "\u4e2d\u6587\u3002", "mail@example.org ", "x" * 40]
    texts = {i: "".join(draw.choices(parts, k=draw.choice([0, 1, 5, 300, 2000]))) for i in range(40)}
    docs = [*texts.items(), (100, None), (7, texts[7]), (None, "no id here")]
    trees = token_counts.segment_trees(spark.createDataFrame(docs, "doc_id bigint, text string"))
    trees.write.parquet(f"{tmp_path}/trees0")
    for turn in range(3):
        stored = spark.read.parquet(f"{tmp_path}/trees{turn}")
        assert stored.count() == len(docs)
        edits, changed = [], dict(texts)
        for i, text in texts.items():
            start = draw.randint(0, len(text))
            end = min(len(text), start + draw.choice([0, 1, 30]))
            new = draw.choice([None, "", " put in", "!"])
            edits.append((i, [(start, end, new)]))
            changed[i] = text[:start] + (new or "") + text[end:]
        wanted = spark.createDataFrame(edits, f"doc_id bigint, edits {token_counts.EDITS}")
        none = F.array().cast(token_counts.EDITS)
        done = token_counts.edit_trees(stored.join(wanted, "doc_id", "left").withColumn("edits", F.coalesce("edits", none)))
        done.write.parquet(f"{tmp_path}/trees{turn + 1}")
        for r in spark.read.parquet(f"{tmp_path}/trees{turn + 1}").collect():
            text = changed.get(r["doc_id"], "no id here" if r["doc_id"] is None else "")
            before = texts.get(r["doc_id"], text)
            assert (r["text"], r["n_tokens_edited"], r["n_tokens"]) == (text, *(len(counter.encoding.encode_ordinary(t)) for t in (text, before)))
            assert sum(r["lengths"]) == r["n_chars_edited"] == len(text) and r["sums"][1] == r["n_tokens_edited"]
            leaves, at = r["sums"][len(r["sums"]) // 2 :], 0
            for length, tokens in zip(r["lengths"], leaves, strict=False):
                assert tokens == len(counter.encoding.encode_ordinary(text[at : at + length]))
                at += length
            # Nothing but the leaves around the one edit is encoded.
            assert r["n_edits"] == (r["doc_id"] in texts) and r["n_chars_reencoded"] <= (1200 if r["n_edits"] else 0)
        texts = changed
    with pytest.raises(ValueError):
        token_counts.TokenTree.stored("abc", [2], np.array([0, 1]), counter)
