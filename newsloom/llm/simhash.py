"""SimHash near-duplicates by BK-trees.

A fingerprint has a bit where over half the hashes of a text's word shingles have it. Fingerprints within
``radius`` differing bits are linked, and links are followed to components.

Only distinct fingerprints are searched, so exact copies cost one row. They are dealt to shards by the bits they
must share: of radius + 2 blocks of bits at least two are untouched by ``radius`` differences, so two linked
fingerprints agree in one of the pairs of blocks, and each pair's value is a shard. In a shard a BK-tree (children keyed
by their integer Hamming distance to the parent) is searched along the edges within the radius. A shard of more
than ``shard_rows`` fingerprints is cut into parts, and each pair of parts becomes a cell of its own with one
part's tree and the other part's searches: any two still meet, and no task holds more than two parts. A cell
reports a star for each group it links, so it sends fewer rows than it got.

Defined results: null and empty texts, and texts of white space, have fingerprint zero and are linked like any other; texts of any length
count whole; repeated rows each get their row; ids may be null or repeated, and a component is named by its
smallest id that is not null (null if there is none); other columns pass through where asked for, and
``fingerprint`` and ``component_id`` take the place of columns of these names; an empty table gives no rows.
"""

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.components import connected
from newsloom.session import cut_lineage

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD_ROWS = 8192
HEAVY = 1000  # a fingerprint with more than a HEAVY-th of all rows is heavy
AT_ONCE = 1 << 16  # shingles whose bits are unpacked at once


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text: A-Z lowered, words between ASCII white space."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    size = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxh64_intdigest(part, SEED) for part in parts), np.uint64, size)
    counts = np.zeros(64, np.int64)
    for start in range(0, size, AT_ONCE):
        bits = np.unpackbits(hashes[start : start + AT_ONCE].view(np.uint8), bitorder="little")
        lanes = bits.view(np.uint64).reshape(-1, 8)  # eight counters in each lane; 255 rows cannot overflow them
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > size, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, keep: Sequence[str], text: str = "text", shingle: int = SHINGLE, name: str = "fingerprint"
) -> DataFrame:
    """The columns ``keep`` and ``name``, a long with the 64 bits; a kept column of that name gives way."""
    keep = [c for c in keep if c.lower() != name.lower()]
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("binary").alias("__text"))

    def hashed(batches):
        for batch in batches:
            found = np.fromiter((simhash(t.as_py(), shingle) for t in batch.column(len(keep))), np.uint64, batch.num_rows)
            arrays = [*batch.columns[:-1], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, name])

    added = T.StructField(name, T.LongType(), False)
    return chosen.mapInArrow(hashed, T.StructType([*chosen.schema.fields[:-1], added]))


class BKTree:
    """Distinct 64-bit values; a node's children are keyed by their Hamming distance to it."""

    def __init__(self, values: Sequence[int] = ()):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        for value in values:
            self.add(value)

    def add(self, value: int) -> None:
        if self.values:
            node = 0
            while True:
                distance = (self.values[node] ^ value).bit_count()
                if not distance:
                    return
                after = self.children[node].get(distance)
                if after is None:
                    self.children[node][distance] = len(self.values)
                    break
                node = after
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(self.values[node])
            for edge, child in self.children[node].items():
                if -radius <= edge - distance <= radius:
                    open_nodes.append(child)
        return found


def stars(members: list[int], searches: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest value) for the groups that links between a member and a search form."""
    tree, parent = BKTree(members), {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for value in searches:
        for other in tree.within(value, radius):
            a, b = sorted((root(value), root(other)))
            parent[b] = a
    return [(x, root(x)) for x in parent if root(x) != x]


def shard_keys(fingerprint: Column, radius: int) -> Column:
    """One key for each pair of blocks: the pair's number and the blocks' bits."""
    blocks = radius + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned(fingerprint, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:])
    ]
    pairs = combinations(range(blocks), 2)
    return F.array(*[F.struct(F.lit(n).alias("pair"), parts[i].alias("x"), parts[j].alias("y")) for n, (i, j) in enumerate(pairs)])


def links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): stars that connect whatever of the distinct ``fingerprint``s is linked."""
    keyed = distinct.select("fingerprint", F.explode(shard_keys(F.col("fingerprint"), radius)).alias("key"))
    keyed = keyed.select("fingerprint", "key.*")
    shard = ["pair", "x", "y"]
    sizes = cut_lineage(keyed.groupBy(shard).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1))
    parts = F.ceil(F.col("rows") / F.lit(shard_rows)).cast("int")
    keyed = keyed.join(sizes.select(*shard, parts.alias("parts")), shard)  # alone in its shard: linked by others or not at all
    keyed = keyed.withColumn("own", F.expr("cast(pmod(xxhash64(fingerprint), parts) as int)"))
    dealt = keyed.select(*shard, "fingerprint", "own", F.explode(F.expr("sequence(0, parts - 1)")).alias("other"))
    cell = [*shard, "low", "high"]
    dealt = dealt.select(
        *shard, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "fingerprint"
    )
    dealt = dealt.repartition(*[F.col(c) for c in cell]).sortWithinPartitions(*cell)

    def search(batches):
        held = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(7)], axis=1)
            rows = rows if held is None else np.concatenate([held, rows])
            cuts = np.flatnonzero((rows[1:, :5] != rows[:-1, :5]).any(axis=1)) + 1
            for group in np.split(rows, cuts)[:-1]:
                yield from linked(group)
            held = rows[cuts[-1] if len(cuts) else 0 :]
        if held is not None:
            yield from linked(held)

    def linked(group):
        low, high = group[0, 3], group[0, 4]
        values = group[:, 6].astype(np.uint64)
        of_low = group[:, 5] == low
        members = values[of_low].tolist()
        found = stars(members, members if low == high else values[~of_low].tolist(), radius)
        if found:
            pairs = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return dealt.mapInArrow(search, "a long, b long")


def near_duplicates(
    marked: DataFrame, id_column: str = "doc_id", radius: int = RADIUS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``marked``, a stored table with ``fingerprint``, and the ``component_id`` of each row."""
    columns = [c for c in marked.columns if c.lower() != "component_id"]
    distinct = marked.groupBy("fingerprint").agg(F.min(F.col(f"`{id_column}`")).alias("first"), F.count("*").alias("rows"))
    distinct = cut_lineage(distinct)
    groups = connected(links(distinct, radius, shard_rows)).toDF("fingerprint", "component")
    placed = groups.join(distinct, "fingerprint")
    least = placed.groupBy("component").agg(F.min("first").alias("least"))
    named = placed.join(least, "component").select("fingerprint", "least")
    final = distinct.join(named, "fingerprint", "left")
    linked = F.col("least").isNotNull()
    final = cut_lineage(final.select(
        F.col("fingerprint").alias("__of"), F.when(linked, F.col("least")).otherwise(F.col("first")).alias("__component"),
        F.col("rows").alias("__rows"),
    ))
    # A fingerprint of many rows meets its one row by broadcast (there are fewer than HEAVY such), the others by shuffle.
    heavy = F.broadcast(final.filter(F.col("__rows") * HEAVY > marked.count()))
    rows, same = marked.select(*[F.col(f"`{c}`") for c in columns]), F.col("fingerprint") == F.col("__of")
    hot = rows.join(heavy, same)
    cold = rows.join(heavy, same, "left_anti").join(final, same)
    return hot.unionByName(cold).drop("__of", "__rows").withColumnRenamed("__component", "component_id")


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS, broadcast_bytes: int = 32 << 20,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, of equal ids the first row, null ids last.

    The rows are stored once with a number, their fingerprint and all columns, so that all later steps see the
    same rows. The numbers to drop are stored and measured: within ``broadcast_bytes`` they are broadcast, else joined.
    """
    columns = docs.columns
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    marked = cut_lineage(fingerprints(numbered, [*columns, "__row"], text, shingle, "__mark"))
    narrow = marked.select(
        "__row", F.col("__mark").alias("fingerprint"),
        F.struct(F.col(f"`{id_column}`").isNull().alias("none"), F.col(f"`{id_column}`").alias("id"), "__row").alias("rank"),
    )
    placed = near_duplicates(narrow, "rank", radius)
    drop = cut_lineage(placed.filter(F.col("rank.__row") != F.col("component_id.__row")).select(F.col("__row").alias("__drop")))
    small = F.broadcast(drop) if drop.count() * 16 <= broadcast_bytes else drop
    return marked.join(small, F.col("__row") == F.col("__drop"), "left_anti").select(*[F.col(f"`{c}`") for c in columns])
