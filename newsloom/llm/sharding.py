"""Sharding by vector bin packing under the law of bytes: shards of near equal sizes.

Equal texts form a group, and groups stay together. Every group has a vector (bytes, words, rows). Groups are gathered
into units by a hash of the text, ``UNITS`` for each shard, so that the units are as many whatever the table; a group
that alone exceeds a unit's share of the rows, bytes or words is a unit of its own, and only if its bytes exceed a shard's whole
share it is cut by row into parts below that, as no shard could take it with near equal sizes. Spark sums up the
units' vectors; only those sums, a bounded multiple of ``UNITS`` * shards, reach the driver. Units are placed largest
first, each on the shard where the dot product of its vector with the residual capacity is highest, among the shards
that have room for its bytes; where none has, on the one with the most room. Documents get their shard by a join with
this bounded table.

Places within a shard are counted without bringing a shard together, nor a large group: units, and slices of large ones,
are numbered by themselves, and each starts where those before it in its shard end.

Defined results: a null text has no bytes and no words and groups with the empty text; texts of any length count whole;
repeated rows get a place each (equal ids in any order); null ids come first in a unit; other columns pass
through where asked for, unless a result column has their name; an empty table gives no rows.
"""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import cut_lineage

SHARDS = 40
UNITS = 64
OVERHEAD = 16  # bytes a row costs besides its text


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit. Columns of ``vectors``: bytes first, then whatever else is balanced."""
    total = vectors.sum(axis=0)
    scaled = vectors / np.where(total > 0, total, 1) * shards  # a shard's fair share is 1 in each measure
    residual = np.ones((shards, vectors.shape[1]))
    found = np.zeros(len(vectors), np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -scaled[:, 0])):
        unit = scaled[i]
        room = residual[:, 0] >= unit[0]
        if room.any():
            at = int(np.argmax(np.where(room, residual @ unit, -np.inf)))
        else:
            at = int(np.argmax(residual[:, 0]))
        found[i] = at
        residual[at] -= unit
    return found


def shard(
    docs: DataFrame, keep: Sequence[str], text: str = "text", id_column: str = "doc_id", shards: int = SHARDS, units: int = UNITS
) -> DataFrame:
    """``keep``, size, text_crc32, law, shard, slot, grown_shard of each row."""
    made = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    keep = [c for c in keep if c.lower() not in made]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col(f"`{id_column}`").alias("__id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("__text"),
        F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("__words"),
        F.xxhash64(F.col(f"`{id_column}`"), F.monotonically_increasing_id()).alias("__salt"),
    )
    rows = cut_lineage(rows)
    group = ["__text", "text_crc32", "size"]
    sums = [F.sum("size").alias("b"), F.sum("__words").alias("w"), F.count("*").alias("n")]
    total = rows.agg(*sums).first()
    limit = units * shards
    share = F.greatest(*[F.col(c) / F.lit(float(max(total[c] or 0, 1))) for c in ("b", "w", "n")])
    large = rows.groupBy(group).agg(*sums).filter(share * limit > 1).select(
        *[F.col(c).alias(f"_{c}") for c in group],
        F.ceil(F.col("b") / F.lit(float(max(total["b"] or 0, 1))) * shards).cast("int").alias("__parts"),
        F.ceil(share * limit).cast("int").alias("__slices"),
    )
    large = cut_lineage(large)  # fewer than three times units * shards
    named = rows.join(F.broadcast(large), [F.col(c) == F.col(f"_{c}") for c in group], "left")
    own = F.col("__parts").isNotNull()
    slice_of = F.when(own, F.pmod("__salt", F.col("__slices"))).otherwise(0)
    home = F.when(own, F.xxhash64(*group, F.pmod(slice_of, F.col("__parts")))).otherwise(F.pmod("__text", F.lit(limit)))
    named = named.withColumns({"__home": home, "__slice": slice_of})
    table = named.groupBy("__home", "__slice").agg(*sums).orderBy("__home", "__slice").toPandas()
    homes = table.groupby("__home")[["b", "w", "n"]].sum()
    table["shard"] = table["__home"].map(dict(zip(homes.index, place(homes.to_numpy(np.float64), shards))))
    table["before"] = table.groupby("shard")["n"].cumsum() - table["n"]
    listed = [tuple(map(int, r)) for r in table[["__home", "__slice", "shard", "before"]].itertuples(index=False)]
    plan = docs.sparkSession.createDataFrame(listed, "_home long, _slice long, shard int, __before long")
    placed = named.join(F.broadcast(plan), (F.col("__home") == F.col("_home")) & (F.col("__slice") == F.col("_slice")))
    number = F.row_number().over(Window.partitionBy("__home", "__slice").orderBy("__id", "__salt"))
    return placed.select(
        *[F.col(f"`{c}`") for c in keep], "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("__before") + number - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
