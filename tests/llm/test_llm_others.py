"""Conversations, pages, vectors, graph helpers and registered queries."""

import hashlib
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import assert_same, connect  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from footfall.llm import chat, pages, vectors  # noqa: E402
from footfall.llm.components import components  # noqa: E402
from footfall.llm.oracle import ORACLE  # noqa: E402
from footfall.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SF), connect(SF), ORACLE[name].strip()) > 0


# Graph ---------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    pairs += [(5000, i) for i in range(5001, 5200)] + [(7, 7), (9000, 9000), (None, 3)]
    head = {}

    def find(i):
        head.setdefault(i, i)
        while head[i] != i:
            i = head[i]
        return i

    for a, b in pairs:
        if a is not None:
            head[max(find(a), find(b))] = min(find(a), find(b))
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {i: find(i) for i in head} and len(got) == len(head)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Conversations -------------------------------------------------------------

NODES = "conv_id long, node long, parent long, role string, text string, score double"


def test_branches_are_ranked(spark):
    rows = [
        (1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "poor", 0.1), (1, 2, 0, "assistant", "good", 0.9),
        (1, 3, 2, "user", "more", 0.0), (1, 4, 3, "assistant", "end", 0.5), (1, 5, 3, "assistant", "tie", 0.5),
        (None, 0, None, "user", "alone", 0.0), (2, 8, 99, "user", "orphan", 0.0), (3, 1, 2, "a", "circle", 0.0), (3, 2, 1, "b", "circle", 0.0),
    ]
    rows += [(9, i, i - 1 if i else None, "user", f"t{i}", 0.0) for i in range(70)]
    nodes = spark.createDataFrame(rows, NODES)
    got = {}
    for r in chat.branches(nodes).orderBy("conv_id", "rank", "step").collect():
        got.setdefault((r.conv_id, r["rank"]), []).append(r.node)
    assert got[(1, 1)] == [0, 2, 3, 4] and got[(1, 2)] == [0, 2, 3, 5] and got[(1, 3)] == [0, 1]
    assert not any(c == 3 for c, _ in got)
    assert got[(None, 1)] == [0] and got[(2, 1)] == [8] and got[(9, 1)] == list(range(70))
    best = chat.format_branches(nodes, best=1).where("conv_id = 1").first()
    assert best.formatted == "### user: q</turn>\n### assistant: good</turn>\n### user: more</turn>\n### assistant: end</turn>\n"
    assert [best.formatted[s.start : s.start + s.size] for s in best.loss] == ["good", "end"]


def test_nodes_that_repeat_are_told_apart(spark):
    rows = [(1, i, i - 1 if i else None, "user", f"t{i}", 0.0) for i in range(5)] * 2 + [(1, 4, 3, "user", "other", 0.0), (2, 0, 0, "u", "circle", 0.0)]
    nodes = spark.createDataFrame(rows, NODES)
    assert chat.branches(chat.told_apart(nodes)).count() == 1 + 2 + 3 + 4 + 5 + 5 + 5  # each copy ends a branch once
    found = {(r.leaf, r.copy): r.formatted for r in chat.format_trees(nodes).collect()}
    assert set(found) == {(4, 0), (4, 1), (4, 2), *((i, 1) for i in range(4))}
    chain = lambda *said: "".join(f"### user: {t}</turn>\n" for t in said)
    assert found[4, 0] == chain("t0", "t1", "t2", "t3", "other") and found[4, 1] == found[4, 2] == chain(*(f"t{i}" for i in range(5)))
    assert found[0, 1] == chain("t0") and found[2, 1] == chain("t0", "t1", "t2")


def test_round_trip(spark):
    awkward = ["", None, "\\", "\\s", "\\\\l</turn>\n### x: ", "<#:\\c>", "a" * 100_000, "é\U0001f600\n\n", "\\### Assistant: </turn> ok", "ends \\"]
    roles = ["user", "assistant", None, "a:b#<\\", "assistant"]
    rows = [(c, t, roles[(c + t) % 5], awkward[(c * 3 + t) % 10], "x") for c in range(8) for t in range(c * 5)]
    rows += [(100, 0, "user", "same", "x"), (100, 0, "user", "same", "x"), (100, None, "assistant", "null turn", "x"), (None, 1, "user", "no id", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, node string")
    found = chat.format_branches(chat.linear_nodes(frame), best=1)
    got = {
        r.conv_id: r
        for r in found.select("conv_id", chat.read_messages(F.col("formatted")).alias("m"), chat.read_learned(F.col("formatted"), F.col("loss")).alias("l")).collect()
    }
    want = {}
    for c, t, role, text, _ in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [(m.role, m.text) for m in r.m] for c, r in got.items()} == want
    assert {c: r.l for c, r in got.items()} == {c: "".join(t for r, t in m if r == "assistant") for c, m in want.items()}
    empty = spark.createDataFrame([], frame.schema)
    assert chat.format_branches(chat.linear_nodes(empty)).count() == 0


def test_conversation_seven(spark):
    row = QUERIES["op6_chat_format"](spark, SF).where("conv_id = -7").first()
    said = r"\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(said)
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


# Pages ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("plain", "plain"), ("<p>a<p>b", "a b"), ("a<b>b</b>c <i> d</i>", "abc d"),
        ("<article><h1>T&amp;x</h1><p><b>one<br><p>two&nbsp; &#233;</p></article><footer>f</footer>", "T&x one two é"),
        ("<nav>m</nav><article>a<nav>in</nav>b<aside>s<p>t</aside>c<form>f</form></article>z", "a b c"),
        ('<article>x<div class="reader-comments"><article>c</article></div>y<p class="ad">buy<p>z</article>', "x y z"),
        ('<div id="cookie_notice">ok<p>unclosed</div><div>body</div>', "body"),
        ("<article>a<script>var t=\"</p><article>\";</script>b<!-- </article> c -->d<style>p{}</style>", "ab d"[:2] + "d"),
        ('<article title="a>b">q<img alt="no">r</article>', "q r"), ("<main>a &am b &lt;p&gt; &copy</main>", "a &am b <p> ©"),
        ("<header>h<article>in header</article></header><article>main 1 < 2</article>", "main 1 < 2"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article", "a b c d"), ("<article>cut off &am", "cut off &am"),
        ("<article>a<span class='share'>no</span>b</article>", "a b"), ("<ARTICLE>Up</ARTICLE><DIV HIDDEN>x</DIV>", "Up"),
    ],
)
def test_structure(page, text):
    found = pages.blocks(page)
    main = [t for p, t in found if p == "main"]
    assert " ".join(main or [t for p, t in found if p == "open"]) == text


def test_host_repeats(spark):
    words = lambda n, s: " ".join(f"{s}{i}" for i in range(n))
    rows = [(i, f"http://a.example/{i}", f"<div>{words(15, 'boiler')}</div><div>{words(6, f'own{i}x')}</div>", 0) for i in range(5)]
    rows += [(10, "http://b.example/", f"<div>{words(15, 'boiler')}</div>", 0), (11, "http://c.example/", f"<div>{words(20, 'q')}</div>" * 2, 0)]
    rows += [(12, "http://d.example/1", f"<p>{words(30, 'copy')}</p>", 0), (13, "http://d.example/2", f"<p>{words(30, 'copy')}</p>", 0)]
    rows += [(14, "http://e.example/1", f"<article>{words(30, 'kept')}</article>", 0), (15, "http://e.example/2", f"<article>{words(30, 'kept')}</article>", 0)]
    rows += [(16, None, None, 0), (None, None, "<p>no id</p>", 0), (17, "x", "<p>twice</p>", 0), (17, "x", "<p>twice</p>", 0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = sorted((r.page_id if r.page_id is not None else -1, r.text) for r in pages.main_text(frame).collect())
    want = [(i, words(6, f"own{i}x")) for i in range(5)] + [(10, words(15, "boiler")), (11, f"{words(20, 'q')} {words(20, 'q')}")]
    want += [(i, words(30, "copy")) for i in (12, 13)] + [(i, words(30, "kept")) for i in (14, 15)]
    want += [(16, ""), (-1, "no id"), (17, "twice"), (17, "twice")]
    assert got == sorted(want)
    assert pages.main_text(frame.limit(0)).count() == 0


# Vectors -------------------------------------------------------------------


@pytest.mark.parametrize("cell, block", [(vectors.CELL, vectors.BLOCK), (40, 16)])
def test_vectors(spark, cell, block):
    rng = np.random.default_rng(6)
    rows = []
    for label in (0, 1):
        base = rng.normal(size=(60, 6))
        for i in range(260):
            noise = rng.normal(size=6) * rng.choice([0, 0.05, 0.12])
            rows.append((len(rows), [float(x) for x in (base[rng.integers(60)] + noise) * rng.uniform(0.5, 3)], label, "c"))
    one = rows[0][1]
    rows += [(1000 + i, one, 0, "c") for i in range(90)] + [(1200, one, None, "c"), (1201, one, 1, "c"), (1202, one[:5], 0, "c")]
    rows += [(1300, None, 0, "c"), (1301, [], 0, "c"), (1302, [0.0] * 6, 0, "c"), (1303, [None, *one[1:]], 0, "c")]
    rows += [(1304, [float("nan"), *one[1:]], 0, "c"), (1305, [float("inf"), *one[1:]], 0, "c"), (None, one, 0, "c")]
    rows += [(1400, [1e-200] * 6, 2, "c"), (1401, [1e200] * 6, 2, "c")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, cell string")
    fit = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    head, links = {r[0]: r[0] for r in rows}, dict.fromkeys((r[0] for r in rows), 0)

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    unit = {r[0]: np.array(r[1]) / np.abs(r[1]).max() for r in fit}
    unit = {i: u / np.linalg.norm(u) for i, u in unit.items()}
    for n, a in enumerate(fit):
        for b in fit[n + 1 :]:
            if a[2] == b[2] and len(a[1]) == len(b[1]) and unit[a[0]] @ unit[b[0]] >= 0.98:
                links[a[0]] += 1
                links[b[0]] += 1
                head[max(find(a[0]), find(b[0]))] = min(find(a[0]), find(b[0]))
    got = vectors.vector_links(frame, cell=cell, block=block).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (links[i], find(i)) for i in links}
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vectors.vector_links(frame.limit(0)).count() == 0


def test_forest_joins_what_links_join():
    rng = np.random.default_rng(1)
    plain, vectors.PLAIN = vectors.PLAIN, 0
    try:
        for _ in range(50):
            linked = rng.random((8, 9)) < 0.15
            left, right = np.arange(8), np.arange(100, 109)
            edges = vectors._forest(left, right, linked)
            pairs = [(left[i], right[j]) for i, j in zip(*np.nonzero(linked))]
            assert _groups(edges) == _groups(pairs)
    finally:
        vectors.PLAIN = plain


def _groups(pairs):
    head = {}

    def find(i):
        head.setdefault(i, i)
        while head[i] != i:
            i = head[i]
        return i

    for a, b in pairs:
        head[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for i in list(head):
        groups.setdefault(find(i), set()).add(int(i))
    return sorted(map(sorted, groups.values()))


# Pipeline ------------------------------------------------------------------


def test_stages_keep_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = docs.limit(1).selectExpr("doc_id", "text", "lang", "source", "n_chars").unionByName(docs)  # a repeated row
    odd = spark.createDataFrame([(None, None, None, None, None), (10**7, "?!", None, None, 2), (10**7 + 1, "", "en", "src0", 0)], docs.schema)
    frame = more.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == docs.columns and frame.schema["doc_id"].dataType == docs.schema["doc_id"].dataType, name
        path = corpus_pipeline.stored(frame, name)
        frame = path
    last = corpus_pipeline.STAGES[-1][1](spark, frame, SF)
    assert set(docs.columns) < set(last.columns)
    ids = [r.doc_id for r in last.collect()]
    assert len(ids) == len(set(ids)) and 10**7 not in ids
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


@pytest.mark.parametrize(
    "part", ["<a b", '<a "', "<a '\">", "<b>", "<b></x>", "<script", "<script></script ", "<!--", "<p class=\"class=", "</", "<", "<a<", "<p><b><i></p>", "&"]
)
def test_pages_of_a_megabyte_take_linear_time(part):
    import time

    page = "<article>begin " + part * (1_000_000 // len(part))
    start = time.process_time()
    found = pages.blocks(page)
    assert time.process_time() - start < 8, part  # some 250,000 tags on a slow machine; quadratic work takes minutes
    assert found[0][1].startswith("begin")


def test_quotes_that_are_not_closed():
    assert pages.blocks('<article><a href="x>y</a>z</article>w') == [("main", "yz"), ("open", "w")]
    assert pages.blocks("<article><a title='1 > 0' href=\"a>b\">y</a></article>") == [("main", "y")]
