import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from newsloom.llm.packing import karmarkar_karp, pack, packed
from newsloom.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_differencing(sizes, windows):
    """Differencing with lists of lists, as it is described."""
    parts = [(sorted([s] + [0] * (windows - 1), reverse=True), i) for i, s in enumerate(sizes)]
    count = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[0][-1] - p[0][0], p[1]))
        (a, _), (b, _), *rest = parts
        parts = [*rest, (sorted((x + y for x, y in zip(a, reversed(b))), reverse=True), count)]
        count += 1
    return parts[0][0]


def test_loads_are_those_of_differencing():
    r = random.Random(4)
    for _ in range(60):
        sizes = [r.randrange(1, 100) for _ in range(r.randrange(1, 40))]
        windows = r.randrange(1, 9)
        found = karmarkar_karp(sizes, windows)
        loads = np.bincount(found, weights=sizes, minlength=windows)
        assert sorted(loads, reverse=True) == plain_differencing(sizes, windows)


def test_windows_rise_until_all_fit():
    assert len(packed([6, 6, 6], 10)) == 3
    assert [sorted(w) for w in packed([], 10)] == []
    r = random.Random(1)
    for _ in range(30):
        sizes = [r.randrange(1, 11) for _ in range(r.randrange(1, 50))]
        found = packed(sizes, 10)
        assert sorted(i for w in found for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= 10 for w in found)


def test_each_id_once(spark):
    texts = [None, "", "  ", "one", "one", *(" ".join(f"w{i}x{k}" for k in range(i * 9)) for i in range(40)), "long words " * 20_000]
    rows = [(None if i == 7 else i // 2, t, "s", "clash") for i, t in enumerate(texts)] + [(99, "twice", "s", "x")] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, ids string").repartition(3)
    found = pack(frame, ["doc_id", "source", "ids", "text"], PATH, block=4).collect()
    coder = encoder(PATH)
    documents, windows = {}, {}
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= 512
        documents.setdefault((r["doc_id"], r["text"]), []).append((r["start"], ids, r["doc_tokens"]))
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for (i, t), pieces in documents.items():
        want = [*coder.whole(t or "").tolist(), 1]
        copies = sum(row[:2] == (i, t) for row in rows)
        got = sorted(pieces)
        assert [x for _, ids, _ in got[::copies] for x in ids] == want and len(got) % copies == 0
        assert all(n == len(want) for _, _, n in pieces)
        assert sum(len(ids) for _, ids, _ in pieces) == copies * len(want)
    assert len(documents) == len({r[:2] for r in rows})
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in found)
    assert total > 0.7 * 2048 * len(windows)  # blocks of four windows here, the last of each task not full


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"], PATH).count() == 0
