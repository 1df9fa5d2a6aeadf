"""Hard negatives by rotated one-bit codes.

Vectors of whole numbers are rotated (signs, then a Walsh-Hadamard transform, twice, which is exact) and coded by their signs; what a
code leaves over is coded again, ``LEVELS`` times. Stored with each vector: the codes, the length of its part along each
code (the alignment), the length of the sum of these parts and the length of what is left. An anchor's rotated vector is
cut into ``PLANES`` bit planes; popcounts of planes and codes estimate its product with a row. By Cauchy-Schwarz the true
product differs from that by no more than |anchor| * |left| + |cut off| * |parts|, whatever the data. Rows whose interval cannot
reach an anchor's results are left out, and all others are scored exactly in whole numbers.

Anchors go in blocks of about ``BLOCK``, a bounded number, to all tasks; every task holds its rows against the block and keeps the best
few for each anchor, so what is shuffled grows with anchors and tasks. For each block there are two passes over the
stored codes: one for the positives, of which the block's few go back to all tasks, and one for the negatives.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part; a shorter vector counts as
filled up with zeros; repeated rows, and different rows with one id, are rows of their own and an anchor each; of equal
scores the smaller id comes first; other columns play no part, whatever their names; an empty table gives no rows. A score must fit a
long: vectors whose lengths multiply to more are refused.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import cut_lineage
from newsloom.sources.tables import spread

EVERY, POSITIVES, NEGATIVES = 100, 5, 5
LOW, HIGH = 80, 100  # a negative's score in hundredths of the positive's
LEVELS, PLANES = 4, 6
BLOCK = 8192
ROWS, ANCHORS = 4096, 256  # compared at a time
SEED = 42
SLACK = 1e-6  # for rounding, of the product of lengths


def whole_numbers(rows: DataFrame, id_column: str, label: Column, vector: str, scale: int = 256) -> DataFrame:
    """(id, label, vec) of the rows that take part, components as floor(scale * x)."""
    vec = F.col(f"`{vector}`")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ints = F.transform(vec, lambda x: F.floor(scale * x.cast("double")).cast("long"))
    return rows.filter(F.col(f"`{id_column}`").isNotNull() & label.isNotNull() & finite).select(
        F.col(f"`{id_column}`").cast("long").alias("id"), label.cast("string").alias("label"), ints.alias("vec")
    )


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows rotated, their width filled up to a power of two; lengths stay."""
    width = 1 << max(6, (vectors.shape[1] - 1).bit_length())
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    signs = np.random.RandomState(SEED).randint(0, 2, (2, width)) * 2 - 1
    for sign in signs:
        out *= sign
        half = 1
        while half < width:
            pairs = out.reshape(len(out), width // (2 * half), 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), width)
            half *= 2
        out /= np.sqrt(width)
    return out


def coded(vectors: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), lengths along them (rows, levels), lengths of (all parts, what is left)."""
    whole = rotated(vectors)
    left = whole.copy()
    width = left.shape[1]
    codes, parts = [], []
    for _ in range(levels):
        positive = left >= 0
        along = np.abs(left).sum(axis=1) / np.sqrt(width)
        codes.append(np.packbits(positive, axis=1).view(np.uint64))
        parts.append(along)
        left = left - np.where(positive, 1.0, -1.0) * (along / np.sqrt(width))[:, None]
    spans = np.stack([np.linalg.norm(whole - left, axis=1), np.linalg.norm(left, axis=1)], axis=1)
    return np.stack(codes, axis=1), np.stack(parts, axis=1), spans


def cells(array: np.ndarray) -> pa.Array:
    """Rows of an array as binary values."""
    array = np.ascontiguousarray(array)
    return pa.array([row.tobytes() for row in array], pa.binary())


def index(vectors: DataFrame, dimension: int, levels: int = LEVELS) -> DataFrame:
    """The stored codes of (id, label, vec): a number for each row, its whole numbers, codes, parts and lengths."""

    def encode(batches):
        for batch in batches:
            lists = batch.column(2)
            filled = np.zeros((batch.num_rows, dimension), np.int64)
            sizes = np.diff(lists.offsets.to_numpy())
            at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            filled[np.repeat(np.arange(batch.num_rows), sizes), at] = lists.flatten().to_numpy(zero_copy_only=False)
            codes, parts, spans = coded(filled, levels)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), cells(filled), cells(codes), cells(parts), cells(spans)],
                names=["id", "label", "vec", "codes", "parts", "spans"],
            )

    found = vectors.mapInArrow(encode, "id long, label string, vec binary, codes binary, parts binary, spans binary")
    return cut_lineage(found.withColumn("row", F.monotonically_increasing_id()))


def matrix(column: pa.Array, kind, *shape) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), *shape) if joined else np.zeros((len(column), *shape), kind)


class Block:
    """Anchors of a block with what their estimates need."""

    def __init__(self, rows, ids, labels, vectors):
        self.rows, self.ids, self.labels, self.vectors = rows, ids, labels, vectors
        turned = rotated(vectors)
        self.width = turned.shape[1]
        low, high = turned.min(axis=1, initial=0.0), turned.max(axis=1, initial=0.0)
        self.low = low
        self.step = np.where(high > low, (high - low) / (2**PLANES - 1), 1.0)
        level = np.rint((turned - low[:, None]) / self.step[:, None]).astype(np.int64)
        self.total = level.sum(axis=1)
        self.planes = [np.packbits((level >> b & 1).astype(bool), axis=1).view(np.uint64) for b in range(PLANES)]
        self.cut_off = np.linalg.norm(turned - low[:, None] - level * self.step[:, None], axis=1)
        self.length = np.linalg.norm(turned, axis=1)

    def intervals(self, some: slice, codes: np.ndarray, parts: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the products of some anchors with rows."""
        low, step = self.low[some, None], self.step[some, None]
        estimate = np.zeros((low.shape[0], len(codes)))
        for level in range(codes.shape[1]):
            code = codes[:, level]
            weights = np.zeros(estimate.shape, np.int32)
            for b, plane in enumerate(self.planes):
                for word in range(code.shape[1]):
                    weights += np.bitwise_count(plane[some, word, None] & code[None, :, word]).astype(np.int32) << b
            ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
            signed = low * (2 * ones - self.width) + step * (2 * weights - self.total[some, None])
            estimate += signed * (parts[:, level] / np.sqrt(self.width))
        around = self.length[some, None] * (spans[:, 1] + SLACK * (spans[:, 0] + spans[:, 1])) + self.cut_off[some, None] * spans[:, 0]
        return estimate - around - SLACK, estimate + around + SLACK


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, exactly."""
    return np.einsum("ij,ij->i", a, b)


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


class Best:
    """The first ``size`` of each group, larger scores and then smaller ids first."""

    def __init__(self, groups: int, size: int):
        self.size, self.worst = size, np.full(groups, -np.inf)
        self.kept = [np.zeros(0, np.int64)] * 4  # group, score, id, row

    def add(self, *new: np.ndarray) -> None:
        group, score, ids, row = (np.concatenate(pair) for pair in zip(self.kept, new))
        order = np.lexsort((row, ids, -score, group))
        group, score, ids, row = group[order], score[order], ids[order], row[order]
        first = np.searchsorted(group, group)
        place = np.arange(len(group)) - first
        keep = place < self.size
        self.kept = [x[keep] for x in (group, score, ids, row)]
        last = place == self.size - 1
        self.worst[group[last]] = score[last]


def search(block: Block, windows: np.ndarray | None, size: int, levels: int):
    """A task's best rows: of the anchor's label without ``windows``, else of other labels within each score window.

    ``windows`` are (anchors, windows, 2) with the lowest and highest score that count; those that hold nothing have a low above the high.
    """
    slots = 1 if windows is None else windows.shape[1]

    def run(batches):
        best = Best(len(block.ids) * slots, size)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                compare(batch.slice(start, ROWS), best)
        group, score, ids, row = best.kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.rows[group // slots]), pa.array((group % slots).astype(np.int32)), pa.array(score), pa.array(ids), pa.array(row)],
            names=["anchor", "slot", "score", "id", "row"],
        )

    def compare(part, best):
        row, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
        labels = np.array(part.column(2).to_pylist(), object)
        vectors = matrix(part.column(3), np.int64, block.vectors.shape[1])
        codes = matrix(part.column(4), np.uint64, levels, block.width // 64)
        parts, spans = matrix(part.column(5), np.float64, levels), matrix(part.column(6), np.float64, 2)
        for start in range(0, len(block.ids), ANCHORS):
            some = slice(start, min(start + ANCHORS, len(block.ids)))
            low, high = block.intervals(some, codes, parts, spans)
            alike = block.labels[some, None] == labels[None, :]
            if windows is None:
                found = alike & (block.rows[some, None] != row[None, :])
                found &= high >= np.maximum(best.worst[some], kth(np.where(found, low, -np.inf), size))[:, None]
            else:
                found = np.zeros(alike.shape, bool)
                for slot in range(slots):
                    least, most = windows[some, slot, 0, None], windows[some, slot, 1, None]
                    sure = ~alike & (low >= least) & (high <= most)
                    floor = np.maximum(best.worst[np.arange(some.start, some.stop) * slots + slot], kth(np.where(sure, low, -np.inf), size))
                    found |= ~alike & (high >= np.maximum(least, floor[:, None])) & (low <= most) & (least <= most)
            a, r = np.nonzero(found)
            if not len(a):
                continue
            a += start
            scores = products(block.vectors[a], vectors[r])
            if windows is None:
                best.add(a, scores, ids[r], row[r])
                continue
            for slot in range(slots):
                inside = (windows[a, slot, 0] <= scores) & (scores <= windows[a, slot, 1])
                best.add(a[inside] * slots + slot, scores[inside], ids[r[inside]], row[r[inside]])

    return run


def first_of(found: DataFrame, size: int) -> DataFrame:
    """The first ``size`` rows of each anchor and slot, with their rank from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def hard_negatives(
    rows: DataFrame, id_column: str = "vec_id", label: str = "label", vector: str = "embedding", every: int = EVERY,
    positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = BLOCK, levels: int = LEVELS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the anchors: ids that ``every`` divides."""
    vectors = spread(whole_numbers(rows, id_column, F.col(f"`{label}`"), vector))
    vectors = cut_lineage(vectors)
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    known = vectors.agg(
        F.max(F.size("vec")).alias("dimension"), F.max(squares).alias("squares"), F.count_if(F.col("id") % every == 0).alias("anchors")
    ).first()
    if (known["squares"] or 0) >= 2.0**62:
        raise ValueError("scores do not fit a long")
    stored = index(vectors, known["dimension"] or 0, levels)
    columns = ["row", "id", "label", "vec", "codes", "parts", "spans"]
    blocks = max(1, -(-known["anchors"] // block))
    chosen = stored.filter(F.col("id") % every == 0).select(
        "row", "id", "label", "vec", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    )
    kind = "anchor long, slot int, score long, id long, row long"
    results = []
    for number in range(blocks):
        own = chosen.filter(F.col("block") == number).toArrow()  # about ``block`` rows
        anchors = Block(
            own["row"].to_numpy(), own["id"].to_numpy(), np.array(own["label"].to_pylist(), object),
            matrix(own["vec"], np.int64, known["dimension"] or 0),
        )
        scan = stored.select(columns)
        found = scan.mapInArrow(search(anchors, None, positives, levels), kind)
        best = first_of(found, positives).select("anchor", "rank", "score", "id").toArrow()  # ``positives`` for each anchor
        places = {row: i for i, row in enumerate(anchors.rows.tolist())}
        windows = np.tile(np.array([1, 0], np.int64), (len(own), positives, 1))
        pairs = []
        for row, rank, score, positive in zip(*(best[c].to_pylist() for c in ("anchor", "rank", "score", "id"))):
            windows[places[row], rank - 1] = -(-LOW * score // HIGH), score
            pairs.append((row, rank - 1, int(anchors.ids[places[row]]), positive, score))
        names = rows.sparkSession.createDataFrame(
            pairs, "anchor long, slot int, anchor_id long, positive_id long, positive_score long"
        )
        found = first_of(scan.mapInArrow(search(anchors, windows, negatives, levels), kind), negatives)
        joined = found.join(F.broadcast(names), ["anchor", "slot"])
        results.append(cut_lineage(joined.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )))
    return reduce(DataFrame.unionByName, results)
