"""Near duplicates against all pairs, on small and skewed tables."""

import random

import pytest

from chargelake.llm import near_dup
from chargelake.llm.graph import components


def brute_force(rows, size, percent):
    sets = [near_dup.shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return sorted(((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component.id) for r in df.collect()), key=str)


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_matches_brute_force(documents, odd_rows, size):
    rng = random.Random(size)
    rows = list(odd_rows)
    for base in range(40):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 20, 60, 200]))]
        rows += [(100 + base * 10 + k, edited(words, rng.randrange(0, 6), rng)) for k in range(rng.randrange(1, 6))]
    rows += [(900, "single"), (901, "SINGLE"), (902, "other")]
    got = near_dup.near_duplicates(documents(rows, cid="c", node=1, key="k", component=2), size=size)
    assert result(got) == brute_force(rows, size, 80)


def test_large_group_of_near_copies(documents):
    """One group with more members than a node holds; it is found whole, and its outsiders are left alone."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = [(i, edited(words, rng.randrange(1, 9), rng)) for i in range(400)]
    rows += [(1000 + i, edited(words, 40, rng)) for i in range(60)]
    assert result(near_dup.near_duplicates(documents(rows))) == brute_force(rows, 2, 80)


def test_one_of_each_group_stays(documents, odd_rows):
    copies = [(20, "one two three four five six seven"), (21, "one two three four five six seven"), (22, "quite another text of seven words")]
    kept = near_dup.without_near_duplicates(documents([*odd_rows, *copies], key="k", row="r"))
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 5, 6, 7, 8, 20, 22]
    assert kept.columns[-2:] == ["key", "row"]


def test_empty(documents):
    assert near_dup.near_duplicates(documents([])).count() == 0
    assert near_dup.without_near_duplicates(documents([(1, None), (2, "")])).count() == 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 102), (102, 100), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "x bigint, y bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 104)}}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_trees_grow_with_the_deepest_level(documents, monkeypatch):
    """A boilerplate group that is branched four times and more: no pair is lost however few trees a round has."""
    assert all((1 - 0.8**level) ** near_dup.trees_for(level, 80) <= near_dup.MISS for level in range(1, near_dup.LEVELS + 1))
    monkeypatch.setattr(near_dup, "TREES", 4)
    monkeypatch.setattr(near_dup, "LEAF", 6)
    rng = random.Random(8)
    common = [f"c{i}" for i in range(75)]
    rows = []
    for i in range(0, 500, 2):
        words = common + [f"w{rng.randrange(10**6)}" for _ in range(45)]
        rows += [(i, " ".join(words)), (i + 1, " ".join(words[:107] + [f"x{rng.randrange(10**6)}" for _ in range(13)]))]
    assert result(near_dup.near_duplicates(documents(rows))) == brute_force(rows, 2, 80)


def test_dense_nodes_are_closed_in_every_tree(documents, monkeypatch):
    seen = []
    monkeypatch.setattr(near_dup, "left_edges", lambda packets, *_: seen.extend(
        r.tree for r in packets.select("tree").distinct().collect()) or packets.selectExpr("node AS x", "node AS y").limit(0).selectExpr("CAST(NULL AS binary) AS x", "CAST(NULL AS binary) AS y"))
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*words, f"end{i}"])) for i in range(100)]
    near_dup.near_duplicates(documents(rows)).count()
    assert max(seen) >= 8


def test_small_levels_take_few_tasks(documents, monkeypatch):
    """A level of known size is written by as many tasks as it needs, so many small levels cost little."""
    files, stage = {}, near_dup.staged

    def counted(df, label, *more):
        out = stage(df, label, *more)
        files[label] = max(files.get(label, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(near_dup, "staged", counted)
    monkeypatch.setattr(near_dup, "LEAF", 4)
    rng = random.Random(5)
    common = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join(common + [f"w{rng.randrange(10**6)}" for _ in range(50)])) for i in range(300)]
    spark = documents([]).sparkSession
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(near_dup.near_duplicates(documents(rows))) == brute_force(rows, 2, 80)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert {n for label, n in files.items() if label.startswith("level") and label != "level0"} == {1}


def test_members_of_several_dense_nodes_are_compared_once():
    got = near_dup.meet_before(5, [[5], [3, 5], [-1, 5, 9]], [[5, 9], [3, 5], [-1, 3, 5], []])
    assert got.tolist() == [[False] * 4, [False, True, True, False], [False, False, True, False]]
    assert near_dup.meet_before(5, [[5]], []).shape == (1, 0)
