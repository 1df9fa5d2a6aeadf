"""Packing by Karmarkar-Karp multiway differencing.

Every document becomes ids plus an end id. A document is cut into pieces of at most ``PIECE`` ids, so that pieces
balance well, and pieces of one task are packed block by block, a block holding about ``BLOCK`` windows' worth. In a
block the number of windows is first the least that can hold its ids. Differencing starts from one partial partition per
piece (that piece in one window, the others empty), and always merges the two with the largest imbalance, fullest window
to emptiest, until one is left: near-equal windows. If a window exceeds the capacity, the window count rises by
one and the block is packed again.

A block is some megabytes at most, whatever the table, and nothing is shuffled: a lost task is repeated from its own
input and gives the same windows. Window numbers are the task's number times 2**32 plus a count, so they are unique
and rise, with gaps. Padding is what the last block of a task leaves open, so it falls with the size of the tasks.

Defined results: null and empty texts, and texts without tokens, are the end id alone; texts of any length are packed
whole; repeated rows are packed each; other columns pass through where asked for, unless a result column has their
name; an empty table gives no rows.
"""

import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tokens import ID, encoder

CAPACITY = 2048
PIECE = 512
BLOCK = 128  # windows
END_ID = 1


def karmarkar_karp(sizes: Sequence[int], windows: int) -> np.ndarray:
    """The window of each of ``sizes``.

    A partial partition is its loads, fullest first, and how it came about: the two that were merged and the order in
    which their sums were sorted. At the end the windows are read off from the last one back to the pieces.
    """
    n = len(sizes)
    if windows == 1:
        return np.zeros(n, np.int64)
    merges, heap = [], []
    for i, size in enumerate(sizes):
        loads = np.zeros(windows, np.int64)
        loads[0] = size
        heap.append((-int(size), i, loads))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, loads_a = heapq.heappop(heap)
        _, b, loads_b = heap[0]
        loads = loads_a + loads_b[::-1]
        order = (-loads).argsort(kind="stable")
        loads = loads[order]
        heapq.heapreplace(heap, (int(loads[-1] - loads[0]), n + len(merges), loads))
        merges.append((a, b, order))
    found = np.zeros(n, np.int64)
    place = {n + len(merges) - 1: np.arange(windows)}  # the final window of each of a partition's windows
    for number in range(len(merges) - 1, -1, -1):
        a, b, order = merges[number]
        final = place.pop(n + number)
        for child, at in ((a, order), (b, windows - 1 - order)):
            if child < n:
                found[child] = final[np.flatnonzero(at == 0)[0]]
            else:
                place[child] = moved = np.empty(windows, np.int64)
                moved[at] = final
    return found


def packed(sizes: Sequence[int], capacity: int = CAPACITY) -> list[list[int]]:
    """The indices in each window, none above ``capacity``; each size must be within it."""
    windows = max(1, -(-int(sum(sizes)) // capacity))
    while True:
        found = karmarkar_karp(sizes, windows)
        if np.bincount(found, weights=sizes, minlength=windows).max(initial=0) <= capacity:
            filled = [[] for _ in range(windows)]
            for i, window in enumerate(found.tolist()):
                filled[window].append(i)
            return [window for window in filled if window]
        windows += 1


def pack(
    docs: DataFrame,
    keep: Sequence[str],
    tokenizer: str,
    text: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per piece: ``keep``, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    made = {"start": "long", "length": "long", "ids": "binary", "doc_tokens": "long", "sequence_id": "long", "offset": "long"}
    keep = [c for c in keep if c.lower() not in made]
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    names = [*keep, *made]

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        waiting, tokens = [], 0
        for batch in batches:
            texts = batch.column(len(keep))
            for row, ids in enumerate(encoder(tokenizer).encode(texts)):
                ids = np.append(ids, ID.type(end_id))
                for start in range(0, len(ids), piece):
                    part = ids[start : start + piece]
                    waiting.append((batch, row, start, part, len(ids)))
                    tokens += len(part)
                    if tokens > (block - 1) * capacity:
                        yield windows_of(waiting, number)
                        number, waiting, tokens = number + len(waiting), [], 0
        if waiting:
            yield windows_of(waiting, number)

    def windows_of(waiting, number):
        """Windows are numbered from ``number`` on; there are never more of them than pieces."""
        order, sequence, offset = [], [], []
        for window in packed([len(w[3]) for w in waiting], capacity):
            at = 0
            for i in window:
                order.append(i)
                sequence.append(number)
                offset.append(at)
                at += len(waiting[i][3])
            number += 1
        rows = [waiting[i] for i in order]
        columns = [kept_of(rows, k) for k in range(len(keep))]
        lengths = [len(r[3]) for r in rows]
        columns += [pa.array([r[2] for r in rows], pa.int64()), pa.array(lengths, pa.int64())]
        columns += [pa.array([r[3].tobytes() for r in rows], pa.binary()), pa.array([r[4] for r in rows], pa.int64())]
        columns += [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def kept_of(rows, k):
        """Column ``k`` of each piece's document, from the batches that the pieces came from."""
        batches = list({id(r[0]): r[0] for r in rows}.values())
        first = dict(zip(map(id, batches), np.cumsum([0, *[b.num_rows for b in batches]]).tolist()))
        values = pa.concat_arrays([b.column(k) for b in batches])
        return values.take(pa.array([first[id(r[0])] + r[1] for r in rows], pa.int64()))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    return chosen.mapInArrow(run, ", ".join([*fields, *[f"{n} {t}" for n, t in made.items()]]))
