"""Phrases: tiles against plain counts, results against plain loops."""

import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from footfall.llm import collocations as co


def plain(rows, least, top, most=5):
    """The rule, read word by word."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    f = {g: c for g, c in f.items() if c >= least}
    inside = lambda g, h: any(h[i : i + len(g)] == g for i in range(1, len(h) - len(g) + 1))
    out = []
    for g, a in f.items():
        if len(g) > 2 and not any(h[0] == g[0] and len(h) > len(g) and inside(g[1:], h) and c >= a for h, c in f.items()):
            cuts = [(1000 * a * n[g[0]] // (f[g[:k]] * f[(g[0], *g[k:])]), k) for k in range(2, len(g))]
            score, k = min(cuts)
            out.append((g[0], " ".join(g[1:]), a, f[g[:k]], f[(g[0], *g[k:])], n[g[0]], score))
    ranked = []
    for lang in sorted({r[0] for r in out}):
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(mine[:top], 1)]
    return ranked


def rows_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("id", F.lit(1)).withColumn("a", F.lit("x"))
    return sorted(map(tuple, co.collocations(df, **options).collect()))


@pytest.mark.parametrize("size, tile, head", [(40, 4, 2), (3000, 256, 64), (3000, 16, 4)])
def test_tiles(monkeypatch, size, tile, head):
    monkeypatch.setattr(co, "TILE", tile)
    monkeypatch.setattr(co, "HEAD", head)
    monkeypatch.setattr(co, "DENSE", tile * tile // 8)
    rng = np.random.default_rng(size)
    ids = (rng.zipf(1.3, 60_000) % size).astype(np.int64)
    ids[rng.random(len(ids)) < 0.2] = -1
    want = Counter((a, b) for a, b in zip(ids.tolist(), ids[1:].tolist()) if a >= 0 and b >= 0)
    a, b, n = co.count_pairs(ids)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == want and len(n) == len(want)
    for none in (ids[:0], ids[:1], np.full(5, -1)):
        assert not len(co.count_pairs(none)[0])


@pytest.mark.parametrize("seed, top", [(0, 5), (1, 2000)])
def test_against_plain_loops(spark, monkeypatch, seed, top):
    monkeypatch.setattr(co, "CHUNK", 50)
    rng = random.Random(seed)
    words = ["a", "B", "É", "the", "of", "x y", "ß", "zz", "\x00", "ſ"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n", "?!"]
    text = lambda: "".join(rng.choice(words[: rng.choice([3, 10])]) + rng.choice(ends) for _ in range(rng.randrange(40)))
    rows = [(text(), rng.choice(["en", "de", None, "und"])) for _ in range(80)] + [(None, "en"), ("", None), (" .", "xx")]
    rows += rows[:20] + [("the of the of the of a b. " * 30, "en")] * 3
    assert rows_of(spark, rows, least=8, top=top) == plain(rows, 8, top)


def test_edges(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [(None, None), ("", "en"), (" ., \n", "en"), ("one two", "en")]) == []
    rows = [("x y", None)] * 100 + [("x y", "few")] * 99 + [("x. y", "cut")] * 100 + [("X\ty", "mixed"), ("x  Y", "mixed")] * 50
    rows += [("a a a a", "over")] * 100
    want = [("mixed", 1, "x y", 100, 100, 100, 200, 2000), ("und", 1, "x y", 100, 100, 100, 200, 2000)]
    # Overlaps count: a a occurs 300 times, a a a 200 times.
    want += [("over", 1, "a a", 300, 400, 400, 400, 750)]
    want += [("over", 2, "a a a", 200, 400, 300, 400, 666), ("over", 3, "a a a a", 100, 300, 300, 400, 444)]
    assert rows_of(spark, rows) == sorted(want) == plain(rows, 100, 2000)


def test_one_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(co, "SLICE", 1000)
    monkeypatch.setattr(co, "CHUNK", 500)
    rng = random.Random(1)
    text = " ".join(rng.choice(["a", "b", "c", "d.", "e"]) for _ in range(20_000))
    assert rows_of(spark, [(text, "en")], least=50) == plain([(text, "en")], 50, 2000)


def test_products_beyond_64_bits(spark):
    """Counts as they are in a corpus of 10^13 words."""
    a, n, l, r = 123_456_789_012, 10**13 + 7, 999_999_999_989, 123_456_789_013
    exact = lambda c: f"cast({c} as decimal(38, 0))"
    got = spark.sql(f"SELECT ({exact(1000)} * {exact(a)} * {exact(n)}) div ({exact(l)} * {exact(r)}) AS s").first().s
    assert got == 1000 * a * n // (l * r)


def test_rare_phrases_are_not_sent(spark):
    """Of many different pairs those that are frequent are shuffled, and few that share a bucket with one."""
    rng = np.random.default_rng(5)
    rows = [(" ".join([*(f"w{w}" for w in rng.integers(0, 200, 400)), "of the"]), "en") for _ in range(200)]
    chunks = spark.createDataFrame(rows, "text string, lang string").mapInArrow(co._cut, co._CHUNKS)
    batches = chunks.drop("size").toArrow().to_batches()
    sent = []
    for _ in range(2):
        loads = pa.Table.from_batches(co._loads(sent, 18)(batches))
        bits = np.zeros(1 << 15, np.uint8)
        for block in range(4):
            own = loads.filter(pc.equal(loads["block"], block))
            if own.num_rows:
                bits[block << 13 : (block + 1) << 13] = np.frombuffer(co._summed(100)(own)["bits"][0].as_py(), np.uint8)
        sent.append(SimpleNamespace(value=bits))
    told = [b for b in co._told(sent, 2)(batches) if b.num_rows and b.column("words")[0].as_py() == 2]
    pairs = {p for b in told for p in b.column("phrase").to_pylist()}
    want = Counter(" ".join(p) for text, _ in rows for p in zip(text.split(), text.split()[1:]))
    assert {p for p, n in want.items() if n >= 100} == {"of the"} <= pairs
    assert len(want) > 30_000 and len(pairs) < 10


@pytest.mark.parametrize("least", [3, 90, 300])
def test_buckets_lose_no_count(least):
    rng = np.random.default_rng(least)
    at, n = rng.integers(0, 1 << 18, 50_000).astype(np.uint64), rng.integers(1, 400, 50_000)
    half = [co._by_block(at[i::2], n[i::2]) for i in (0, 1)]
    total = np.bincount(at.astype(np.int64), n, 1 << 18)
    table = pa.Table.from_batches(half)
    for block in range(4):
        bits = co._summed(least)(table.filter(pc.equal(table["block"], block)))["bits"][0].as_py()
        seen = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
        own = total[block << 16 : (block + 1) << 16]
        assert seen[own >= least].all() and not seen[own < min(least, 255)].any()
