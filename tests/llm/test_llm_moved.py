"""What the operators move: texts and members that later steps do not need stay where they are."""

import contextlib
import io
import random

import pytest

from footfall.llm import linking, nearcopies


@pytest.fixture
def merged(spark):
    """Joins as between tables too large for a broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def plans(monkeypatch):
    """The plans of stored steps by name."""
    seen: dict[str, list[str]] = {}

    def watch(module):
        put = module.stored

        def stored(df, name):
            with contextlib.redirect_stdout(io.StringIO()) as text:
                df.explain()
            seen.setdefault(name, []).append(text.getvalue())
            return put(df, name)

        monkeypatch.setattr(module, "stored", stored)

    watch(nearcopies)
    watch(linking)
    return seen


def copies(seed, texts=60, versions=3):
    rnd, rows = random.Random(seed), []
    for i in range(texts):
        words = [f"w{rnd.randrange(5000)}" for _ in range(80)]
        for v in range(versions):
            own = list(words)
            own[rnd.randrange(80)] = "other"
            rows.append((i * 100 + v, " ".join(own)))
    return rows


def test_texts_of_candidates_are_not_moved_to_be_chosen(spark, merged, plans):
    rows = copies(1) + [(10_000 + i, " ".join(f"x{i}_{j}" for j in range(40))) for i in range(200)]
    # Texts that share a passage but are not alike, so that buckets go on to blocks.
    rows += [(20_000 + i, " ".join([*(f"p{j}" for j in range(60)), *(f"y{i}_{j}" for j in range(60))])) for i in range(40)]
    got = nearcopies.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {d: d // 100 * 100 if d < 10_000 else d for d, _ in rows}
    # One shuffle, of words by id, and none of texts.
    (plan,) = plans["words"]
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 2  # the other one is of bits
    # Members of buckets meet their sketches and bags once a turn.
    assert plans["blocks"] and all(p.count("SortMergeJoin [id") == 1 for p in plans["blocks"])


def test_few_links_are_joined_in_one_task(spark, monkeypatch):
    def refused(pairs):
        raise AssertionError("rounds for links that one task holds")

    monkeypatch.setattr(linking, "components", refused)
    pairs = spark.createDataFrame([(5, 3), (3, 9), (7, 7), (8, 12), (12, 20)], "a long, b long")
    got = {r.id: r.component for r in linking._merged(pairs, 5).collect()}
    assert got == {3: 3, 5: 3, 9: 3, 7: 7, 8: 8, 12: 8, 20: 8}
    assert linking._merged(pairs.where("a < 0"), 0).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_perhaps_among_keys(spark, kind):
    from footfall.llm.frames import perhaps_among

    rows = spark.range(20_000).selectExpr(f"cast(id as {kind}) AS `doc_id`", "id AS n").unionByName(
        spark.range(1).selectExpr(f"cast(null as {kind}) AS `doc_id`", "-1L AS n"))
    keys = rows.where("n % 10 = 0").select("doc_id")
    got = {r.n for r in perhaps_among(rows, keys, "doc_id").collect()}
    assert got >= set(range(0, 20_000, 10)) and -1 not in got
    assert len(got) < 2000 + 18_000 / 8
    assert perhaps_among(rows, keys.where("false"), "doc_id").count() == 0
