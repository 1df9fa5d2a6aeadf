import random
import re
import zlib
from collections import Counter

import pytest

from newsloom.llm.spelling import digests, spelling_variants, variants

SCHEMA = "word string, n long"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[head + 1 :] == b[head + 1 :]
    return a[head + 1 :] == b[head:] if len(a) > len(b) else a[head:] == b[head + 1 :]


def plain(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def counted(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def got(frame):
    return sorted(map(tuple, frame.collect()))


def made(seed, n, letters="abÉé", low=5, high=9):
    r = random.Random(seed)
    return {"".join(r.choices(letters, k=r.randint(low, high))): r.choice([3, 3, 4, 6, 8, 17, 40]) for _ in range(n)}


@pytest.mark.parametrize("long", [64, 7, 4])
def test_all_pairs(spark, long):
    words = made(long, 400) | {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaab": 3, "baaaa": 3}
    found = got(variants(spark.createDataFrame(list(words.items()), SCHEMA), long=long))
    assert found == plain(words)
    assert any(row[2] not in (row[0], row[1]) for row in found)  # a root behind the form


def test_long_words(spark):
    r = random.Random(1)
    words = {}
    for size in (63, 64, 65, 66, 3000):
        base = "".join(r.choices("abc", k=size))
        words |= {base: 40, base[:9] + base[10:]: 5, base[:20] + "é" + base[21:]: 12, base + "c": 6, "x" + base[1:]: 3}
    assert got(variants(spark.createDataFrame(list(words.items()), SCHEMA))) == plain(words)


def test_digests_say_what_rotations_say():
    r = random.Random(2)
    words = {"".join(r.choices("ab", k=r.randint(3, 5))) for _ in range(40)}
    by_text, by_digest = {}, {}
    for word in words:
        keys = []
        for i in range(len(word) + 1):
            keys.append(word[i:] + "$" + word[:i])
            if i < len(word):
                keys.append(word[i + 1 :] + "$" + word[:i])
        for key, (digest, _, _) in zip(keys, digests(word, 0)):
            assert by_text.setdefault(key, digest) == digest and by_digest.setdefault(digest, key) == key


def test_documents(spark):
    r = random.Random(3)
    words = ["receive", "recieve", "receives", "Überall", "ÜBERALL", "überall", "naïve", "naive", "naïves", "tiny", "x" * 300]
    rows = [(i if i != 5 else None, " ".join(r.choices(words, weights=[90, 9, 9, 9, 9, 9, 60, 9, 9, 9, 1], k=60))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "12 _ !"), (73, "receive " * 30_000), (74, "same words again"), (74, "same words again")]
    rows = [(d, t, "x") for d, t in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(3)
    assert got(spelling_variants(frame)) == plain(counted([row[:2] for row in rows]))
    assert spelling_variants(frame.limit(0)).count() == 0
