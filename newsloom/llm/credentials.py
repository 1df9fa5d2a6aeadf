"""Secret scans with multipart credential linking, in DataFrame functions only.

Base spans are reported always: assignments of secrets, access key identifiers, long hexadecimal runs. Weak candidates
(logins, mixed-case keys, endpoints) say little alone and are reported only where parts that complete them are
near: a login with a secret, a key with an identifier, an endpoint with both. A part's scope reaches ``SCOPE`` code
points to either side. The scopes are joined as intervals: parts are dealt to the buckets of their document that they
touch, so a bucket holds no more parts than fit into its width, and a semi join asks only whether there is one.

A text is scanned once; what goes on are the lengths of its matches and of the gaps between them, never the secrets.
Positions are running sums of these, in code points, ends exclusive. Matches of a kind are leftmost and do not overlap;
those that fail their length are dropped after matching.

Defined results: null and empty texts have no spans; texts of any length are scanned whole, in time linear in
them; repeated rows each get their spans; ids may be null; other columns pass through where asked for, unless a
result column has their name; an empty table gives no rows.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import cut_lineage

SCOPE = 200
# The base patterns, letters of the names in either case.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # of a run of such signs either all or nothing matches, so the length may stand here
LOGIN = r"""(?i)(?:access_?key_?id|client_?id|account|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
KEY = (
    r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*+(?<=[A-Za-z0-9+/]{32}))(?=[a-z0-9+/]*+[A-Z])(?=[A-Z0-9+/]*+[a-z])"
    r"(?=[A-Za-z+/]*+[0-9])[A-Za-z0-9+/]++={0,2}"
)
ENDPOINT = r"""https?://[^\s"'<>]{4,}|(?<![A-Za-z0-9.-])[a-z0-9-]++(?:\.[a-z0-9-]++){1,8}:[0-9]{2,5}"""
# Kind, pattern, group whose length counts, least length, role; the order of spans that start together.
KINDS = (
    ("assign", ASSIGN, 2, 6, "secret"),
    ("access", ACCESS, 0, 20, "identifier"),
    ("hex", HEX, 0, 24, "secret"),
    ("login", LOGIN, 0, 0, "identifier"),
    ("key", KEY, 0, 0, "secret"),
    ("endpoint", ENDPOINT, 0, 0, "endpoint"),
)
BASE = ("assign", "access", "hex")
NEEDS = {"login": ("secret",), "key": ("identifier",), "endpoint": ("identifier", "secret")}


def matches(text: Column, pattern: str, group: int) -> Column:
    """For each match: code points before it since the last one, its own, and those of the group that counts."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    lengths = F.arrays_zip(gaps.alias("g"), found.alias("m"), counted.alias("c"))
    lengths = F.transform(
        F.slice(lengths, F.lit(1), F.size(found)),
        lambda x: F.struct(F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("own"), F.length(x["c"]).alias("counted")),
    )
    return F.when(text.rlike(pattern), lengths)


def _spans(rows: DataFrame) -> DataFrame:
    """(row, kind, place, role, start, end) of every match that is long enough."""
    kinds = []
    for place, (kind, _, _, least, role) in enumerate(KINDS):
        one = rows.select("__row", F.posexplode(f"__{kind}").alias("pos", "m")).select("__row", "pos", "m.*")
        kinds.append(one.withColumns({"kind": F.lit(kind), "place": F.lit(place), "role": F.lit(role), "least": F.lit(least)}))
    every = reduce(DataFrame.unionByName, kinds)
    before = Window.partitionBy("__row", "place").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.col("own")).cast("long")).over(before)
    every = every.withColumn("end", end).withColumn("start", F.col("end") - F.col("own"))
    return every.filter("counted >= least").select("__row", "kind", "place", "role", "start", "end")


def _near(candidates: DataFrame, parts: DataFrame, scope: int) -> DataFrame:
    """The candidates with a part within ``scope``: an interval join by the buckets that intervals touch."""

    def dealt(spans, low, high):
        buckets = F.sequence(F.floor(low / scope), F.floor(high / scope))
        return spans.select("*", F.explode(buckets).alias("bucket"))

    wide = dealt(candidates, F.col("start") - scope, F.col("end") + scope)
    narrow = dealt(parts.select("__row", "start", "end"), F.col("start"), F.col("end")).toDF("__of", "from", "to", "in")
    meets = (
        (F.col("__row") == F.col("__of")) & (F.col("bucket") == F.col("in"))
        & (F.col("from") <= F.col("end") + scope) & (F.col("to") >= F.col("start") - scope)
    )
    return wide.join(narrow, meets, "left_semi").drop("bucket").distinct()


def secret_spans(docs: DataFrame, keep: Sequence[str], text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``keep`` and, for each row, ``base`` and ``linked``: arrays of (start, place, kind, end) in order."""
    keep = [c for c in keep if c.lower() not in ("base", "linked")]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = [matches(body, pattern, group).alias(f"__{kind}") for kind, pattern, group, _, _ in KINDS]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("__row"), *found)
    rows = cut_lineage(rows)
    spans = cut_lineage(_spans(rows))
    is_base = F.col("kind").isin(*BASE)
    reported = spans.filter(is_base)
    for kind, roles in NEEDS.items():
        weak = spans.filter(F.col("kind") == kind)
        for role in roles:
            weak = _near(weak, spans.filter(F.col("role") == role), scope)
        reported = reported.unionByName(weak)
    listed = F.struct("start", "place", "kind", "end")
    grouped = reported.groupBy("__row").agg(
        F.sort_array(F.collect_list(F.when(is_base, listed))).alias("base"),
        F.sort_array(F.collect_list(listed)).alias("linked"),
    )
    none = F.expr("cast(array() as array<struct<start: bigint, place: int, kind: string, end: bigint>>)")
    joined = rows.select("__row", *[F.col(f"`{c}`") for c in keep]).join(grouped, "__row", "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in keep], F.coalesce("base", none).alias("base"), F.coalesce("linked", none).alias("linked")
    )


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
