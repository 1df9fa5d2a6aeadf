import random
from collections import Counter, defaultdict

import pytest

from newsloom.llm.line_dedup import BLANKS, line_dedup


def plain(rows, ratio=0.1, min_pages=5):
    totals, pages = Counter(), defaultdict(int)
    for host, text in rows:
        totals[host] += 1
        for line in {x.strip(BLANKS) for x in (text or "").split("\n")} - {""}:
            pages[host, line] += 1
    out = []
    for host, text in rows:
        if text is None:
            out.append((host, None, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not (pages[host, x.strip(BLANKS)] >= min_pages and pages[host, x.strip(BLANKS)] > ratio * totals[host])]
        out.append((host, "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=repr)


def made(seed, n=300):
    r = random.Random(seed)
    lines = [f"line {i}" for i in range(60)] + ["", "  ", "menu", " menu\t", "é" * 50]
    rows = []
    for _ in range(n):
        host = r.choice(["hot", "hot", "hot", "a", "b", None])
        rows.append((host, "\n".join(r.choices(lines, k=r.randrange(0, 9))) if r.random() < 0.95 else None))
    return rows + [("a", "menu"), ("a", "menu"), ("hot", ""), ("lone", "menu"), ("b", "menu\n" * 5000)]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, -1])
def test_against_counting(spark, broadcast_bytes):
    rows = made(1)
    frame = spark.createDataFrame([(h, t, "x", 1) for h, t in rows], "source string, text string, n_dropped string, host int")
    found = line_dedup(frame, broadcast_bytes=broadcast_bytes)
    assert found.columns == ["source", "text", "host", "n_dropped"]
    got = sorted(((r["source"], r["text"], r["n_dropped"]) for r in found.collect()), key=repr)
    assert got == plain(rows)
    assert any(n for _, _, n in got)


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], "source string, text string")).count() == 0
