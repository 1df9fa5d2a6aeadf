"""Spelling variants by permuterm rotations.

A word with its terminator "$" is rotated. The rotation that ends in a word's i-th letter starts with what stands
behind that letter, "$", and what stands before it. Words that agree on this prefix and skip one letter each are
replacements of one another there; a word whose whole rotation is the prefix lacks the letter. So the sorted rotations of
the vocabulary fall into groups of one prefix, each with at most one word for every letter that can be skipped and
one that skips none. A scan of each group tells every member how many neighbours it has there and which comes first;
no pair is written. A pair that differs by a letter of a run of equal letters meets in a group for each
of them, and is counted where the letter is the first of its run.

Words above ``LONG`` letters, and those one letter shorter, have the rotations' digests in their place, which are made from digests
of prefixes, so that a word of n letters costs n short rows; their groups give pairs, at most the alphabet's size for each.

Words are maximal runs of letters, counted over all documents per task before the shuffle. In a corpus whose
errors are to be simulated, ``dropped_letter`` deletes one letter of every 97th (document, run).

Defined results: a null text has no words; texts and words of any length count whole; repeated rows count each; a null id reads as an
empty one in the hash of (document, run); of near words with equal counts the smallest in code-point order is the form; other
columns play no part, whatever their names; an empty table gives no rows.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.lookup import Limits, lookup_join
from newsloom.session import cut_lineage

RUN = "[A-Za-zÀ-ÿ]+"
EVERY = 97
MIN_LETTERS, MIN_COUNT, FACTOR = 5, 3, 2
LONG = 64
LIMITS = Limits(table_bytes=8 << 20)
MODULUS, BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, run): the runs of letters of all texts, A to Z in lower case."""
    found = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(RUN), F.lit(0))).alias("run"),
    )
    plain = F.octet_length("run") == F.char_length("run")
    return found.select("id", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))


def dropped_letter(id_column: Column, run: Column, every: int = EVERY) -> Column:
    """The run, without one letter where ``every`` divides the hash of (document, run)."""
    h = F.crc32(F.concat(F.coalesce(id_column.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, short).otherwise(run)


def vocabulary(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    long_enough = words.filter(F.char_length("word") >= min_letters)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, skipped, word, n): each word's rotations, one letter skipped, and none ("")."""
    size = F.char_length("word")
    place = words.select("word", "n", size.alias("size"), F.explode(F.sequence(F.lit(0), size)).alias("i"))
    before = F.substring("word", F.lit(1), F.col("i"))
    behind = F.col("i") + F.lit(1)
    whole = F.concat(F.substring("word", behind, F.col("size")), F.lit("$"), before)
    skipping = F.concat(F.substring("word", behind + 1, F.col("size")), F.lit("$"), before)
    none = F.struct(whole.alias("prefix"), F.lit("").alias("skipped"))
    one = F.struct(skipping.alias("prefix"), F.substring("word", behind, F.lit(1)).alias("skipped"))
    both = F.when(F.col("i") < F.col("size"), F.array(none, one)).otherwise(F.array(none))
    return place.select(F.explode(both).alias("r"), "word", "n").select("r.prefix", "r.skipped", "word", "n")


def best_first(n: Column, word: Column) -> Column:
    return F.struct((-n).alias("minus_n"), word.alias("word"))


def group_neighbours(members: DataFrame) -> DataFrame:
    """(word, n_near, best) of each member of a prefix group with another member."""
    group = Window.partitionBy("prefix")
    ordered = group.orderBy(F.desc("n"), "word")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    again = F.col("skipped") == F.substring("prefix", -1, 1)  # a letter like the one before it: not the first of its run
    place = F.row_number().over(ordered)
    seen = members.select(
        "word", "skipped", again.alias("again"), place.alias("place"),
        F.count(F.lit(1)).over(whole).alias("size"),
        F.max(F.col("skipped") == "").over(whole).alias("shorter"),
        F.max(again).over(whole).alias("any_again"),
        F.first(best_first(F.col("n"), F.col("word"))).over(whole).alias("first"),
        F.lead(best_first(F.col("n"), F.col("word"))).over(ordered).alias("second"),
    ).filter("size > 1")
    others = F.col("size") - 1
    uncounted = F.when(F.col("skipped") == "", F.col("any_again")).otherwise(F.col("again") & F.col("shorter"))
    return seen.select(
        "word", (others - uncounted.cast("int")).alias("n_near"),
        F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("first")).alias("best"),
    )


def digests(word: str, own: int) -> Iterator[tuple[int, str, bool]]:
    """(digest of the prefix, skipped letter, whether it is like the one before) of a long word's rotations.

    A word of ``LONG`` letters or fewer gives those that skip none: what else it has is found among the short words.
    """
    size, sums, powers = len(word), [0], [1]
    for letter in word:
        sums.append((sums[-1] * BASE + ord(letter)) % MODULUS)
        powers.append(powers[-1] * BASE % MODULUS)
    for i in range(size + 1):
        tail = (sums[size] - sums[i] * powers[size - i]) % MODULUS
        yield ((tail * BASE + ord("$")) * powers[i] + sums[i]) % MODULUS, "", False
        if i < size and size > own:
            tail = (sums[size] - sums[i + 1] * powers[size - i - 1]) % MODULUS
            yield ((tail * BASE + ord("$")) * powers[i] + sums[i]) % MODULUS, word[i], i > 0 and word[i] == word[i - 1]


def long_neighbours(words: DataFrame, long: int = LONG) -> DataFrame:
    """(word, n_near, best) of pairs with a word above ``long`` letters."""

    def cut(batches):
        for batch in batches:
            for at, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = list(digests(word, long))
                for start in range(0, len(found), 10_000):
                    part = found[start : start + 10_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([d.to_bytes(16) for d, _, _ in part], pa.binary()), pa.array([s for _, s, _ in part]),
                        pa.array([a for _, _, a in part]), pa.array([at] * len(part)),
                    ], names=["prefix", "skipped", "again", "at"])

    some = words.filter(F.char_length("word") >= long).select(F.sha2(F.col("word").cast("binary"), 256).alias("at"), "word", "n")
    rows = some.select("at", "word").mapInArrow(cut, "prefix binary, skipped string, again boolean, at string")
    alike = rows.groupBy("prefix").agg(F.collect_list(F.struct("skipped", "again", "at")).alias("members"))  # a letter each
    some = cut_lineage(some)
    pairs = alike.filter(F.size("members") > 1).select(F.explode("members").alias("a"), "members")
    pairs = pairs.select("a", F.explode("members").alias("b")).filter("a.at <> b.at AND NOT (a.again AND b.skipped = '') AND NOT (b.again AND a.skipped = '')")
    ends = pairs.select(F.col("a.at").alias("from"), F.col("b.at").alias("to"))
    named = ends.join(some.select(F.col("at").alias("from"), "word"), "from")
    met = named.join(some.select(F.col("at").alias("to"), F.col("word").alias("other"), "n"), "to")
    return met.select("word", F.lit(1).alias("n_near"), best_first(F.col("n"), F.col("other")).alias("best"))


def variants(words: DataFrame, factor: int = FACTOR, long: int = LONG) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of (word, n)."""
    words = cut_lineage(words)
    short = group_neighbours(rotations(words.filter(F.char_length("word") <= long)))
    near = short.unionByName(long_neighbours(words, long))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    joined = words.join(near, "word", "left")
    best_n = -F.col("best.minus_n")
    has = best_n >= factor * F.col("n")
    found = cut_lineage(joined.select(
        "word", F.when(has, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, best_n).alias("form_n"),
    ))
    rooted = lookup_join(found, roots(found), ["word"], "left", limits=LIMITS)
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words with a form. Counts at least double from a word to its form, so chains are short."""
    steps = found.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        steps = cut_lineage(steps)
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = cut_lineage(lookup_join(steps, further, ["root"], "left", limits=LIMITS))
        if longer.filter(F.col("next").isNotNull()).isEmpty():
            return steps
        steps = longer.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame, text: str = "text", id_column: str = "doc_id", every: int = EVERY) -> DataFrame:
    """The words of all documents with their forms and roots, one letter deleted in every ``every``-th (document, run)."""
    words = runs(docs, text, id_column).select(dropped_letter(F.col("id"), F.col("run"), every).alias("word"))
    return variants(vocabulary(words))
