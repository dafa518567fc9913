"""Document operators against brute force, and their edge cases."""

import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from footfall.llm import decontaminate, langid, mixing, nearcopies, paragraphs, quality, repeats

SF = "/root/testdata/sf0.01"
# Names that operators use inside, as extra columns.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("score", "id", "bucket", "size", "seed", "class_id", "words", "flagged", "a.b")),
    ]
)
EXTRA = ("s", None, "b", "x", "y", "z", "w", "f", "d")


def docs(spark, rows):
    """Documents of (id, text) or (id, text, lang, source)."""
    full = [(*r, *("en", "src")[len(r) - 2 :])[:4] if len(r) < 4 else r for r in rows]
    return spark.createDataFrame([(i, t, l, s, len(t) if t else 0, *EXTRA) for i, t, l, s in full], SCHEMA)


def prose(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def edited(words, share, seed):
    rng, out = random.Random(seed), []
    for w in words:
        pick = rng.random()
        if pick > share:
            out.append(w)
        elif pick < share / 2:
            out.append(f"new{rng.randrange(10**6)}")
    return out


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def split(text):
    return re.findall(r"[^\x00-\x20\x7f]+", lower(text or ""))


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose with copies, near copies, shared passages, and every awkward text."""
    base = [prose(120, s) for s in range(12)]
    shared = prose(60, 99)
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    rows += [(20 + k, " ".join(edited(base[0], 0.08, k))) for k in range(9)]
    rows += [(40 + k, " ".join(base[1]).upper() if k == 2 else "  ".join(base[1])) for k in range(4)]
    rows += [(50 + k, " ".join(prose(30, 500 + k)) + "\n" + " ".join(shared) + "\n" + " ".join(prose(15, 600 + k))) for k in range(7)]
    rows += [(60, None), (61, ""), (62, " \n\t "), (63, "one two"), (64, "one two"), (65, "x " * 300), (66, "é ü ß " * 40)]
    rows += [(70, " ".join(prose(30_000, 7))), (71, " ".join(prose(30_000, 7)[:29_000]))]  # very long
    rows += [(50, rows[[r[0] for r in rows].index(50)][1]), (None, " ".join(base[2])), (None, None)]
    return rows


def linked_classes(rows):
    """Least id of each class, by aligning every pair."""
    texts = {i: split(t) for i, t in rows if i is not None}
    head = {i: i for i in texts}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = texts[a], texts[b]
            if not x or not y or min(len(x), len(y)) < 0.8 * max(len(x), len(y)):
                continue
            if x == y or (set(x) & set(y) and 1 - distance(x, y) / max(len(x), len(y)) >= 0.8):
                head[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def distance(x, y):
    if len(x) > 5000:  # only cut copies are this long here
        return abs(len(x) - len(y)) if x[: len(y)] == y or y[: len(x)] == x else max(len(x), len(y))
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return row[-1]


def test_near_copies(spark, corpus):
    got = nearcopies.near_classes(docs(spark, corpus)).collect()
    expected = linked_classes(corpus)
    assert {r.doc_id: r.class_id for r in got} == expected
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)
    assert len(got) == sum(i is not None for i, _ in corpus)
    kept = nearcopies.keep_first(docs(spark, corpus))
    assert kept.columns == SCHEMA.names
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(expected.values()))  # the repeated row is one
    assert ids.count(None) == 2


def test_near_copies_of_nothing(spark):
    assert nearcopies.near_classes(docs(spark, [])).count() == 0
    assert nearcopies.keep_first(docs(spark, [])).count() == 0


def brute_repeats(rows, length=50):
    where = defaultdict(set)
    texts = {i: split(t) for i, t in rows if i is not None}
    for i, words in texts.items():
        for j in range(len(words) - length + 1):
            where[tuple(words[j : j + length])].add(i)
    out = {}
    for i, words in texts.items():
        gone, stay = set(), set()
        for j in range(len(words) - length + 1):
            owners = where[tuple(words[j : j + length])]
            if len(owners) > 1:
                (stay if min(owners) == i else gone).update(range(j, j + length))
        if gone or stay:
            out[i] = (gone, stay)
    return out


def test_repeated_passages(spark, corpus):
    found = defaultdict(lambda: (set(), set()))
    texts = dict(corpus)
    for r in set(repeats.repeated_spans(docs(spark, corpus)).collect()):
        at = [m.span() for m in re.finditer(r"[^\x00-\x20\x7f]+", texts[r.doc_id])]
        own = [k for k, (a, b) in enumerate(at) if a >= r.start and b <= r.end]
        assert (at[own[0]][0], at[own[-1]][1], len(own)) == (r.start, r.end, r.n_words)
        found[r.doc_id][0 if r.removed else 1].update(own)
        assert r.removed == (r.first_doc != r.doc_id)
    assert dict(found) == brute_repeats(corpus)
    assert set(found) >= set(range(50, 57)) | {1, 40, 41, 42, 43, 70, 71}


def test_cut_leaves_clean_texts_alone(spark, corpus):
    cut = repeats.cut(docs(spark, corpus))
    assert cut.columns == SCHEMA.names and cut.schema["n_chars"].dataType == T.LongType()
    rows, repeated = cut.collect(), brute_repeats(corpus)
    texts = dict(corpus)
    for r in rows:
        if r.doc_id not in repeated:
            assert r.doc_id is None or r.text == texts[r.doc_id]
        else:
            gone = repeated[r.doc_id][0]
            assert split(r.text) == [w for k, w in enumerate(split(texts[r.doc_id])) if k not in gone]
            assert r.n_chars == len(r.text)
    left = {i for i, (gone, _) in repeated.items() if len(gone) == len(split(texts[i]))}
    assert {40, 41, 42, 43} <= left
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(i for i, _ in corpus if i is not None and i not in left)
    assert not brute_repeats([(r.doc_id, r.text) for r in rows])
    assert repeats.cut(docs(spark, [])).count() == 0


def test_passages_with_short_windows(spark):
    """Many chance repeats over a small alphabet, at other lengths."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    found = defaultdict(lambda: (set(), set()))
    for r in repeats.repeated_spans(docs(spark, rows), length=9, seed=3).collect():
        low = len(split(dict(rows)[r.doc_id][: r.start]))
        found[r.doc_id][0 if r.removed else 1].update(range(low, low + r.n_words))
    assert dict(found) == brute_repeats(rows, 9)


def test_paragraphs(spark, corpus):
    rng = random.Random(8)
    lines = [prose(40, 900 + k) for k in range(6)]
    rows = [(i, t) for i, t in corpus if i is None or i < 60] + [
        (100 + i, "\n".join(" ".join(edited(rng.choice(lines), rng.choice([0, 0, 0.02, 0.2]), i * 9 + j)) for j in range(4)) + "\n\nshort one")
        for i in range(12)
    ]
    shingles = {}
    for i, t in rows:
        for p, line in enumerate((t or "").split("\n")):
            w = split(line)
            if i is not None and len(w) >= 20:
                shingles[i, p] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    head = {k: k for k in shingles}

    def find(k):
        while head[k] != k:
            k = head[k]
        return k

    keys = sorted(shingles)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            common = len(shingles[a] & shingles[b])
            if common >= 0.8 * (len(shingles[a]) + len(shingles[b]) - common) - 1e-9:
                head[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for k in keys:
        groups[find(k)].append(k)
    expected = {k: min(g) for g in groups.values() if len({i for i, _ in g}) > 1 for k in g}
    got = paragraphs.repeated_paragraphs(docs(spark, rows)).collect()
    assert {(r.doc_id, r.para): (r.first_doc, r.first_para) for r in got} == expected
    assert len(got) == len(expected) and all(r.kept == ((r.doc_id, r.para) == (r.first_doc, r.first_para)) for r in got)
    assert paragraphs.repeated_paragraphs(docs(spark, [])).count() == 0


def test_alignment_in_its_band():
    rng = random.Random(3)
    for _ in range(500):
        x, y = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        most = rng.randrange(14)
        assert nearcopies.edits(nearcopies.np.array(x, "uint32"), nearcopies.np.array(y, "uint32"), most) == min(distance(x, y), most + 1)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_leaks(texts, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for item, text in items:
        w = re.findall(pattern, lower(text or ""))
        for j in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[j : j + 10])].add("" if item is None else str(item))
    out = []
    for text in texts:
        w = re.findall(pattern, lower(text or ""))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("limit", [decontaminate.LIMIT, 200])
def test_decontamination(spark, limit):
    item = "Which of these, then, is the answer to: question number 42 of the test?"
    items = [(1, item), (2, "É tu"), (3, None), (4, "..."), (None, "null id has these words"), (5, item), (5, item)]
    texts = [
        None, "", "nothing", item, item.upper() * 3, "é TU", "a é tu, é, tu b", "etude é tus", "pre " + item.replace(" ", " -- ") + " post",
        "x " * 50_000 + "is the answer to question number 42 of the test" + " y" * 50_000, "null\nid has,these WORDS", item,
    ]
    frame = docs(spark, [(i if i else None, t) for i, t in enumerate(texts)])
    found = decontaminate.scan(frame, benchmark(spark, items), ["doc_id", "score"], limit=limit).collect()
    got = {r.doc_id: (r.n_words, sum(s.high - s.low for s in r.words), list(r.items)) for r in found}
    expected = brute_leaks(texts, items)
    assert got == {(i if i else None): e for i, e in enumerate(expected)} and len(found) == len(texts)
    for r in found:
        for s, w in zip(r.spans, r.words):
            text = texts[r.doc_id or 0]
            assert len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text[s.low : s.high]))) == w.high - w.low
    clean = decontaminate.keep_clean(frame, benchmark(spark, items), limit=limit)
    assert clean.columns == SCHEMA.names
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [i for i, e in enumerate(expected) if not e[1]]


def test_decontamination_of_nothing(spark):
    empty = benchmark(spark, [])
    assert [r.n_words for r in decontaminate.scan(docs(spark, [(1, "a b")]), empty, ["doc_id"]).collect()] == [2]
    assert decontaminate.scan(docs(spark, []), empty, ["doc_id"]).count() == 0


def test_language(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in table.collect()]
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows]
    train = docs(spark, [(i, t, l, None) for (i, t, l), h in zip(rows, held) if not h] + [(None, None, "en", None), (1, "", "de", None)])
    model = langid.fit(train)
    awkward = [(1, None), (2, ""), (3, "123 ... ###"), (4, "x" * 500_000), (5, "É"), (5, "É")]
    test = docs(spark, [(i, t, None, None) for (i, t, _), h in zip(rows, held) if h] + [(-i, t, None, None) for i, t in awkward])
    found = langid.predict(test, model, ["doc_id"]).collect()
    told = {r.doc_id: (r.lang_pred, r.score) for r in found}
    truth = [(i, l) for (i, _, l), h in zip(rows, held) if h]
    assert sum(told[i][0] == l for i, l in truth) / len(truth) > 0.97
    assert all(told[-i] == ("und", 0.0) for i in (1, 2, 3)) and told[-4][0] in model.languages
    assert sum(r.doc_id == -5 for r in found) == 2 and all(0 <= s <= 1 for _, s in told.values())
    kept = langid.keep_known(test, model)
    assert kept.columns == SCHEMA.names
    known = {r.doc_id: r.lang for r in kept.collect()}
    assert set(known) == {i for i, (l, _) in told.items() if l != "und"} and known[-4] == told[-4][0]
    assert langid.fit(docs(spark, [])) is None
    plain = docs(spark, [(1, "five plain words of English"), (2, "123 ..."), (3, None), (4, "")])
    assert [r.doc_id for r in langid.keep_known(plain, None).collect()] == [1]
    assert [r.lang_pred for r in langid.predict(test.limit(3), None, ["doc_id"]).collect()] == ["und"] * 3
    assert langid.predict(docs(spark, []), model, ["doc_id"]).count() == 0


def test_quality(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    learn = labels.where(~labels.doc_id.isin(list(held)))
    odd = spark.createDataFrame([(None, 1, 0), (3, None, 0), (10**9, 0, 0)], labels.schema)
    model = quality.fit(table, learn.unionByName(odd))
    found = {r.doc_id: r.score for r in quality.score(table, model, ["doc_id"]).collect()}
    good = [found[i] for i, q in held.items() if q == 1]
    bad = [found[i] for i, q in held.items() if q == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.9
    frame = docs(spark, [(1, None), (2, ""), (3, "x" * 300_000), (3, "x" * 300_000)])
    rows = quality.score(frame, model, ["doc_id", "lang"]).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id == 1} == {r.score for r in rows if r.doc_id == 2}
    none = quality.fit(table, labels.limit(0))
    assert {r.score for r in quality.score(frame, none, ["doc_id"]).collect()} == {0.5}
    assert quality.score(docs(spark, []), model, ["doc_id"]).count() == 0


def water(sizes, weights, most=3):
    """Targets by handing out words until nothing is above its limit."""
    target, open_, left = {}, set(sizes), sum(sizes.values())
    while open_:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total > most * sizes[s] + 1e-9}
        if not full:
            return target | {s: left * weights[s] / total for s in open_}
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("bucket, fan_in", [(mixing.BUCKET, mixing.FAN_IN), (8, 3)])
def test_mixing(spark, bucket, fan_in):
    rng = random.Random(4)
    sources = ["b", "a", None, "Z", "é", "tiny"]
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 90))), "en", rng.choice(sources[:5])) for i in range(600)]
    rows += [(700, "one two", "en", "tiny"), (701, None, "en", "tiny"), (702, "", "en", "void"), (1, rows[1][1], "en", rows[1][3])]
    frame = docs(spark, rows)
    found = mixing.mix(mixing.sized(frame), bucket, fan_in).collect()
    assert len(found) == len(rows)
    size = defaultdict(int)
    for _, t, _, s in rows:
        size[s] += len((t or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    expected = water(size, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == size[r.source] and abs(r.target - expected[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        share = r.target / r.source_size if r.source_size else 0
        assert r.size == 0 or int(share) <= r.copies <= int(share) + 1
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 45 for s in expected)  # half of the largest text
    again = mixing.mix(mixing.sized(frame.repartition(7)), bucket, fan_in).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))
    if bucket == mixing.BUCKET:
        mixed = mixing.mixed(frame)
        assert [c for c in mixed.columns if c not in SCHEMA.names] == ["source_size", "target", "copies", "taken"]
        assert sum(r.taken for r in mixed.collect()) == sum(taken.values())
        assert mixing.mix(mixing.sized(docs(spark, []))).count() == 0


def test_rounding_keeps_expectation():
    import numpy as np

    rng = np.random.default_rng(1)
    size = np.array([5.0, 3.0, 8.0, 1.0])
    mass = size * np.array([0.3, 0.6, 0.5, 0.9])
    runs = np.array([mixing.pivot(mass, size, rng.random(4)) for _ in range(20_000)])
    assert np.allclose(runs.sum(1), mass.sum())
    assert ((runs > 1e-6) & (runs < size - 1e-6)).sum(1).max() <= 1
    assert np.abs(runs.mean(0) - mass).max() < 0.08


def test_pipeline(spark, corpus, tmp_path):
    """All stages against their rules, each applied by brute force to what the one before left."""
    item = " ".join(prose(24, 777))
    rows = [*corpus, (80, f"{' '.join(prose(20, 778))} {item.upper()}"), (81, "123 456 ..."), (82, " ".join(prose(9, 779)))]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark(spark, [(1, item)]).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    first = linked_classes(left)
    left = [(i, t) for i, t in dict.fromkeys(left) if i is None or first[i] == i]
    repeated, texts = brute_repeats(left), {}
    for i, t in left:
        gone = repeated.get(i, (set(), set()))[0] if i is not None else set()
        words = [w for k, w in enumerate(split(t)) if k not in gone]
        if words:
            texts[i] = words
    leaks = brute_leaks([" ".join(w) for w in texts.values()], [(1, item)])
    expected = {i: w for (i, w), leak in zip(texts.items(), leaks) if not leak[1]}
    assert 80 not in expected and 81 not in expected and {82, None, 0, 50, 63} <= set(expected)
    assert {r.doc_id: split(r.text) for r in got} == expected and len(got) == len(expected)
    # One source: it gets its own words, each document once.
    assert all(r.copies == 1 and r.taken == r["size"] == len(r.text.split()) for r in got)
    assert {r.target for r in got} == {float(sum(map(len, expected.values())))}
