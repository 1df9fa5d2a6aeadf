import random

import pytest
from xxhash import xxh64_intdigest

from newsloom.llm.components import connected
from newsloom.llm.simhash import BKTree, fingerprints, links, near_duplicates, one_of_each, simhash


def plain_simhash(text):
    """The definition, bit by bit."""
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split(" ")]
    words = [w for part in words for w in part.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\f", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=3):
    """rows: (id, fingerprint). Every pair is compared."""
    values = sorted({f for _, f in rows})
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return sorted(((i, f, least.get(root(f))) for i, f in rows), key=repr)


TEXTS = [None, "", " \t\n", "One", "one two", "One Two three", "one two three", "É é A", "a\x0bb\x0cc d", "a\x1cb c d e f g",
         "x " * 30000, "word " * 3 + "other"]


def test_fingerprint_definition():
    for text in TEXTS + [" ".join(random.Random(i).choices("ab c de Fgh".split(), k=i)) for i in range(1, 300, 7)]:
        assert simhash(text.encode() if text else None) == plain_simhash(text), text


def test_tree_finds_all_within_radius():
    r = random.Random(1)
    values = [r.getrandbits(64) for _ in range(50)]
    values += [v ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for v in values for _ in range(5)]
    tree = BKTree(values)
    for v in values:
        assert sorted(tree.within(v, 3)) == sorted({x for x in values if (x ^ v).bit_count() <= 3})


def clustered(seed, n):
    r = random.Random(seed)
    seeds = [r.getrandbits(64) for _ in range(n // 10)] + [0, (1 << 64) - 1]
    rows = []
    for i in range(n):
        value = r.choice(seeds)
        for _ in range(r.randrange(6)):
            value ^= 1 << r.randrange(64)
        rows.append((None if i % 17 == 0 else i // 2, value))
    return rows + rows[:5]


def signed(f):
    return f - (1 << 64) if f >> 63 else f


@pytest.mark.parametrize("shard_rows", [8192, 3])
def test_components_against_all_pairs(spark, shard_rows):
    rows = clustered(3, 300)
    marked = spark.createDataFrame([(i, signed(f), "x") for i, f in rows], "doc_id long, fingerprint long, component_id string")
    found = near_duplicates(marked, shard_rows=shard_rows).collect()
    assert sorted(((r[0], r[1] % (1 << 64), r[2]) for r in found), key=repr) == plain_components(rows)


def test_a_hot_fingerprint(spark):
    rows = [(i, 5 if i % 3 else i << 40) for i in range(3000)]
    found = near_duplicates(spark.createDataFrame([(i, f, "x") for i, f in rows], "doc_id long, fingerprint long, rows string"))
    assert {r[0]: r[3] for r in found.collect() if r[1] == 5} == {i: 0 for i in range(3000) if i % 3}
    assert found.count() == 3000 and found.columns == ["doc_id", "fingerprint", "rows", "component_id"]


def test_links_are_fewer_than_pairs(spark):
    near = [sum(1 << b for b in range(64) if (n >> b) & 1) for n in range(512)]
    frame = spark.createDataFrame([(n,) for n in near], "fingerprint long")
    assert links(frame).count() < 10 * len(near)


def test_connected_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7)]
    found = dict(map(tuple, connected(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(50)}}


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, fingerprint string")
    assert near_duplicates(fingerprints(empty, ["doc_id"])).count() == 0
    frame = spark.createDataFrame([(1, "", "old"), (None, None, "old"), (0, "a b c", "old")], "doc_id long, text string, fingerprint string")
    found = near_duplicates(fingerprints(frame, ["doc_id", "fingerprint"]))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, 0, 1), (None, 0, 1), (0, signed(plain_simhash("a b c")), 0)], key=repr)


@pytest.mark.parametrize("broadcast_bytes", [32 << 20, -1])
def test_one_of_each(spark, broadcast_bytes):
    """The smallest id of each component stays; of equal ids the first row, a null id only where there is no other."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(r.choices(words, k=r.randrange(20, 200))) for _ in range(30)]
    texts += [t + " end" for t in texts[:20]] + [None, "", " \t\n", texts[0], texts[1].upper(), "One", "one"]
    rows = [(None if i % 13 == 0 else i // 2, t) for i, t in enumerate(texts)]
    r.shuffle(rows)
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fingerprint string").repartition(3)
    found = one_of_each(frame, broadcast_bytes=broadcast_bytes)
    assert found.columns == frame.columns
    marked = [(i, plain_simhash(t)) for i, t in rows]
    components = plain_components([(k, f) for k, (_, f) in enumerate(marked)])  # named by row, so that null ids count
    groups = {}
    for k, _, component in components:
        groups.setdefault(component, []).append(marked[k][0])
    want = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert sorted((row["doc_id"] for row in found.collect()), key=repr) == sorted(want, key=repr)
    assert len(want) < len(rows) - 8
    assert one_of_each(frame.limit(0)).count() == 0
