"""The trie of conversations against one built turn by turn."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from footfall.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """A node is a tuple of turns."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, role, sha(f"{len(role)}:{role}{text}"), text))
    own = {c: [(r[2], r[4]) for r in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:])
    members = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    below = lambda a, b: b[: len(a)] == a
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    children = {p: [q for q in members if len(q) == len(p) + 1 and below(p, q)] for p in members}
    out = []
    for p, cs in members.items():
        under = [q for q in members if below(p, q)]
        out.append((
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), sum(not children[q] for q in under),
            sum((len(members[q]) - 1) * words(q) for q in under), sha(",".join(map(str, sorted(c for c in cs if len(whole[c]) == len(p))))),
        ))
    return sorted(out, key=repr)


def nodes(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("x")).withColumn("k1", F.lit(1))
    found = prefixes.trie(df)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_loops(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(100), 60) + [10**12, 10**12 + 7]:
        for t in range(rng.choice([0, 1, 2, 3, 6])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "bot", None]), rng.choice(["a", "b c", " x\x0by z ", None, ""])))
    rows += rows[:15] + [(None, 1, "user", "none"), (-7, 0, "user", "q"), (-20, 0, "user", "r"), (-27, 1, None, None)]
    assert nodes(spark, rows) == plain(rows)


def test_edges(spark):
    assert nodes(spark, []) == [] and nodes(spark, [(None, None, None, None)]) == []
    # Only conversations without a turn: all that is left of them is the root.
    short = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1][:3]
    rows = [(c, 0, "u", "t") for c in short]
    assert nodes(spark, rows) == [(short[0], 0, None, 3, 0, 1, 0, sha(",".join(map(str, short))))]


def test_copies_and_one_long_conversation(spark):
    """Hundreds of equal conversations over several batches, and one whose path is cut over partitions."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(c * 20, t, "u", f"same {t}") for c in range(200) for t in range(3)]
        rows += [(5, t, "u", f"w {t % 7}") for t in range(150)] + [(5000, t, "u", f"w {t % 7}") for t in range(100)]
        assert nodes(spark, rows) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
