r"""Quality by the perplexity of an interpolated modified Kneser-Ney model of words, thresholded by language.

A text is read as its words `[^\x20\x09-\x0D]+`, with starts before and an end after them. Tasks count the n-grams of ``WORDS``
words of the trusted texts, Spark sums the counts by n-gram. A lower order's counts are of distinct left neighbours. Every
order's probabilities come from joins sharded by context (its totals) and by suffix (the next lower order). Below the
single words lies their spelling: a Kneser-Ney model of the distinct trusted words' symbols, order ``ORDER`` over an alphabet of
``SIZE``, so that each unknown word has a probability of its own. That table has SIZE ** ORDER entries at most,
whatever the corpus: 10 MB, which is the proven bound behind its broadcast.

The log probability of a text is a sum over its n-grams of all orders: what an n-gram adds to its suffix after
its context, and what the discounts left to it as a context. N-grams that the model has not seen add nothing. So
scoring joins the n-grams of the texts with the model's by their keys, 64-bit hashes, and sums by text. To spare the
join work it does not need, tasks add up the ``FREQUENT`` most frequent n-grams themselves, and ask only for n-grams whose
mark is among the ``MARKS`` of the others: both have fixed sizes (16 MB each), and neither changes a result.

Every score is held out. Texts fall into two halves by a hash, equal texts into the same, and a half is scored by the model
of the other half's trusted texts. The halves' models are made and used one after the other, and both the joins of a model
and those with the texts run in ``WAVES`` of n-grams by a hash; what a step has used up is deleted, shuffle files and
broadcasts too. So disk holds a part of the n-grams at a time, of any corpus the same part, and all n-grams have their turn.
A text's score is its mean negative log probability a symbol (of its words, one
end for each word and one for the text), drawn towards the language's trusted mean with the weight of ``PRIOR``
symbols, so that a few unusual words do not condemn a short text. A language's threshold is the ``QUANTILE`` of its trusted
scores, in steps of 0.001. A language without trusted texts takes the threshold of all together.

Defined results: null and empty texts are the end alone; texts of any length are read whole; a null language is
one of its own; repeated rows are scored each, and count each in training; labels without a row, or with null, are not
trust; without any trusted text the model is uniform, thresholds are null and all is kept; other columns pass through
where asked for, unless a result column has their name; an empty table gives no rows.
"""

import math
from collections.abc import Sequence
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.tokens import slices
from newsloom.session import cut_lineage, discard, freeing_shuffles, shared_arrays

WORDS = 2
ORDER = 4
# Symbol classes after the letters a to z; the boundary stands before and after every text.
CLASSES = ("boundary", "space", "newline", "digit", "capital", ".", ",", "!", "sign", "punctuation", "accented vowel",
           "accented consonant", "letter", "other")
SIZE = 26 + len(CLASSES)
BOUNDARY = 26
QUANTILE = 0.995
PRIOR = 50
SLICE = 1 << 22
GATHERED = 1 << 22  # words whose n-grams a task counts together
FREQUENT = 1_000_000
MARKS = 1 << 27  # bits
WAVES = 3
# The ids of what stands before and after a text.
START, END = 0x9E3779B97F4A7C14, 0xC2B2AE3D27D4EB4E
BROADCAST_BYTES = 64 << 20


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """The symbol of each code point."""
    of = {name: 26 + i for i, name in enumerate(CLASSES)}
    table = np.full(0x110000, of["other"], np.uint8)
    for code in range(0x3400):
        sign = chr(code)
        if sign.isupper():
            table[code] = of["capital"]
        elif sign.isalpha():
            table[code] = of["letter"]
        elif sign.isspace():
            table[code] = of["space"]
        elif sign.isdigit():
            table[code] = of["digit"]
    table[0x3400:0xD800] = of["letter"]
    table[33:48] = table[58:65] = table[91:97] = table[123:127] = of["punctuation"]
    table[97:123] = np.arange(26)
    for name, signs in ((".", "."), (",", ","), ("!", "!"), ("newline", "\n"), ("sign", "#*$%&|<>"),
                        ("accented vowel", "àáâãäåæèéêëìíîïòóôõöøùúûüýÿœ"), ("accented consonant", "çñðþßšž")):
        for sign in signs:
            table[ord(sign)] = of[name]
    return table


def ngrams(texts: Sequence[str | None], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram codes of all texts one after the other, and where each text's begin; the last is its end symbol."""
    before = "\0" * (order - 1)
    joined = "".join(f"{before}{t or ''}\0" for t in texts)
    lengths = np.fromiter((len(t or "") for t in texts), np.int64, len(texts)) + order
    starts = np.cumsum(lengths) - lengths
    read = symbols()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
    pads = starts[:, None] + np.arange(order - 1)
    read[pads.ravel()] = BOUNDARY
    read[starts + lengths - 1] = BOUNDARY
    codes = read.copy()
    for back in range(1, order):
        codes[back:] += read[:-back] * SIZE**back
    scored = np.ones(len(read), bool)
    scored[pads.ravel()] = False
    return codes[scored], starts - np.arange(len(texts)) * (order - 1)


def count_ngrams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, n) over the one column of ``texts``; a task sends each n-gram it has seen once."""

    def counted(batches):
        total = np.zeros(SIZE**order, np.int64)
        for batch in batches:
            column = batch.column(0)
            for start, end in slices(column, SLICE):
                codes, _ = ngrams(column.slice(start, end - start).to_pylist(), order)
                total += np.bincount(codes, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "n"])

    return texts.mapInArrow(counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(counts_of_counts: Sequence[int]) -> list[float]:
    """Discounts for counts of one, two, and three or more, from how many n-grams have the counts one to four."""
    n1, n2, n3, n4 = counts_of_counts
    if not (n1 and n2 and n3 and n4):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(max(d, 0.1), k - 0.1) for k, d in enumerate(raw, 1)]


def probabilities(counts: DataFrame, order: int = ORDER) -> np.ndarray:
    """log p(last symbol | the symbols before it) by n-gram code."""
    tables = {order: counts}
    for n in range(order - 1, 0, -1):
        tables[n] = cut_lineage(tables[n + 1].groupBy((F.col("code") % SIZE**n).alias("code")).agg(F.count("*").alias("n")))
    log_p = np.full(1, -math.log(SIZE))
    lower = None
    for n in range(1, order + 1):
        table = tables[n].withColumn("context", F.floor(F.col("code") / SIZE).cast("long"))
        first = table.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
        d1, d2, d3 = discounts([x or 0 for x in first])
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        totals = table.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount).alias("taken"))
        joined = table.join(totals, "context").withColumn("suffix", F.col("code") % SIZE ** (n - 1))
        if lower is None:
            joined = joined.withColumn("below", F.lit(1 / SIZE))
        else:
            joined = joined.join(lower, "suffix")
        p = (F.col("n") - discount + F.col("taken") * F.col("below")) / F.col("total")
        seen = cut_lineage(joined.select("code", "context", p.alias("p"), (F.col("taken") / F.col("total")).alias("left")))
        lower = seen.select(F.col("code").alias("suffix"), F.col("p").alias("below"))
        # What was not seen after a context shares what the discounts left, in proportion to the lower order.
        log_p = np.tile(log_p, SIZE**n // len(log_p))
        rows = seen.toArrow()
        left = np.zeros(SIZE ** (n - 1))
        left[rows["context"].to_numpy()] = np.log(rows["left"].to_numpy())
        log_p = log_p + np.repeat(left, SIZE)
        log_p[rows["code"].to_numpy()] = np.log(rows["p"].to_numpy())
    return log_p.astype(np.float32)


def scored(docs: DataFrame, keep: Sequence[str], log_p: np.ndarray | Broadcast, text: str = "text", order: int = ORDER) -> DataFrame:
    """``keep``, n_symbols and the sum of negative log probabilities in ``nats``."""
    keep = list(keep)
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    shared = log_p if isinstance(log_p, Broadcast) else docs.sparkSession.sparkContext.broadcast([log_p.tobytes()])

    def run(batches):
        table = np.frombuffer(shared.value[0], np.float32)
        for batch in batches:
            column = batch.column(len(keep))
            number, nats = [], []
            for start, end in slices(column, SLICE):
                codes, starts = ngrams(column.slice(start, end - start).to_pylist(), order)
                nats.append(-np.add.reduceat(table[codes].astype(np.float64), starts))
                number.append(np.diff(np.append(starts, len(codes))))
            if number:
                arrays = [*batch.columns[:-1], pa.array(np.concatenate(number)), pa.array(np.concatenate(nats))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_symbols", "nats"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, f"{fields}, n_symbols long, nats double")


def read_words(texts: pa.Array, order: int = WORDS) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Ids of all texts one after the other, ``order`` - 1 starts and an end included, and the text of each; the
    distinct words, and which of them each word is."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, owner = split.flatten(), pc.list_parent_indices(split)
    real = pc.not_equal(flat, "")
    coded = flat.filter(real).dictionary_encode()
    owner = owner.filter(real).to_numpy()
    at = coded.indices.to_numpy()
    lengths = np.bincount(owner, minlength=len(texts)) + order
    ids = np.full(lengths.sum(), START, np.uint64)
    ids[np.arange(len(at)) + owner * order + order - 1] = hashed(coded.dictionary)[at]
    ids[np.cumsum(lengths) - 1] = END
    text = np.repeat(np.arange(len(texts)), lengths)
    return ids, text, coded.dictionary, at


def hashed(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def longer(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Keys of the n-grams that end at each place, from those one shorter; ``key`` is the same in Spark."""
    before = np.roll(keys, 1)
    return (before << np.uint64(21) | before >> np.uint64(43)) ^ ids


def key(words: Sequence[Column]) -> Column:
    found = words[0]
    for word in words[1:]:
        found = F.shiftleft(found, 21).bitwiseOR(F.shiftrightunsigned(found, 43)).bitwiseXOR(word)
    return found


def signed(ids: np.ndarray) -> pa.Array:
    return pa.array(ids.view(np.int64))


def columns(n: int) -> list[str]:
    return [f"w{i}" for i in range(1, n + 1)]


def count_words(texts: DataFrame, order: int = WORDS) -> DataFrame:
    """(w1, ..., n): how often each n-gram of word ids is in the one column of ``texts``."""
    names = columns(order)

    def counted(parts):
        ids, ends = [np.concatenate(p) for p in zip(*parts)]
        keys = ids
        for _ in range(order - 1):
            keys = longer(keys, ids)
        _, first, n = np.unique(keys[ends], return_index=True, return_counts=True)
        at = np.flatnonzero(ends)[first]
        grams = [signed(ids[at - back]) for back in range(order - 1, -1, -1)]
        return pa.RecordBatch.from_arrays([*grams, pa.array(n)], names=[*names, "n"])

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for start, end in slices(batch.column(0), SLICE):
                ids, text, _, _ = read_words(batch.column(0).slice(start, end - start), order)
                parts.append((ids, place(text) >= order - 1))
                size += len(ids)
                if size >= GATHERED:
                    yield counted(parts)
                    parts, size = [], 0
        if parts:
            yield counted(parts)

    fields = ", ".join(f"{name} long" for name in [*names, "n"])
    return texts.mapInArrow(run, fields).groupBy(*names).agg(F.sum("n").alias("n"))


def place(text: np.ndarray) -> np.ndarray:
    """How far each id lies from the begin of its text."""
    at = np.arange(len(text))
    begins = np.flatnonzero(np.diff(text, prepend=-1))
    return at - begins[text]


def vocabulary(texts: DataFrame) -> DataFrame:
    """(id, word) of the distinct words in the one column of ``texts``; the end's word is empty."""

    def run(batches):
        for batch in batches:
            for start, end in slices(batch.column(0), SLICE):
                _, _, words, _ = read_words(batch.column(0).slice(start, end - start))
                ids = np.append(hashed(words), np.uint64(END))
                yield pa.RecordBatch.from_arrays([signed(ids), pa.concat_arrays([words, pa.array([""])])], names=["id", "word"])

    return texts.mapInArrow(run, "id long, word string").groupBy("id").agg(F.min("word").alias("word"))


def weights(counts: DataFrame, spelled: DataFrame, order: int = WORDS, waves: int = WAVES) -> tuple[list[DataFrame], float]:
    """Stored tables (key, weight, n) of all n-grams, some keys in two rows that add up; the log of the share of unknown words.

    ``spelled`` has the ``id`` of every word and ``nats`` of its spelling. ``counts``, a stored table, is deleted in the end.
    """
    tables = {order: counts}
    for n in range(order - 1, 0, -1):
        left = [F.col(f"w{i + 1}").alias(f"w{i}") for i in range(1, n + 1)]
        tables[n] = cut_lineage(tables[n + 1].groupBy(*left).agg(F.count("*").alias("n")))
    parts, lower, unknown = [], None, 0.0
    for n in range(1, order + 1):
        names, table = columns(n), tables[n]
        of_counts = table.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)], F.sum("n"), F.count("*")).first()
        n1, n2, n3, n4, total, rows = [x or 0 for x in of_counts]
        d1, d2, d3 = discounts((n1, n2, n3, n4))
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        if n == 1:
            unknown = math.log((n1 * d1 + n2 * d2 + (rows - n1 - n2) * d3) / total) if rows else 0.0
            joined = [table.join(spelled.withColumnRenamed("id", "w1"), "w1")]
            below = F.lit(unknown) - F.col("nats")
            kept = (F.col("n") - discount) / F.lit(float(total))
        else:
            context = table.groupBy(*names[:-1]).agg(F.sum("n").alias("total"), F.sum(discount).alias("taken"))
            context = cut_lineage(context.withColumn("left", F.log(F.col("taken") / F.col("total"))).drop("taken"))
            parts.append(context.select(key([F.col(w) for w in names[:-1]]).alias("key"), F.col("left").alias("weight"), F.col("total").alias("n")))
            suffix = lower.select(*[F.col(f"w{i}").alias(f"w{i + 1}") for i in range(1, n)], "log_p")
            wave = F.pmod(F.xxhash64(*names[:-1]), F.lit(waves))
            joined = [table.filter(wave == k).join(context.filter(wave == k), names[:-1]).join(suffix, names[1:]) for k in range(waves)]
            below = F.col("left") + F.col("log_p")
            kept = (F.col("n") - discount) / F.col("total")
        chosen = [F.log(kept + F.exp("below")).alias("log_p")] if n < order else []
        words = [F.col(w) for w in names]
        weight = F.when(F.col("below") > -700, F.log1p(F.col("kept") * F.exp(-F.col("below")))).otherwise(F.log("kept") - F.col("below"))
        done = []
        for rows in joined:
            rows = rows.withColumns({"below": below, "kept": kept})
            done.append(cut_lineage(rows.select(*(names if n < order else []), *chosen, key(words).alias("key"), weight.alias("weight"), "n")))
        discard(table)
        lower = reduce(DataFrame.unionByName, done)
        parts += [rows.select("key", "weight", "n") for rows in done]
    return parts, unknown


def divided(model: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Keys and weights of at most ``most`` of the most frequent rows of the model; the other rows."""
    level = F.floor(F.log2("n") * 4)
    sizes = sorted(model.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True)
    lowest, size = math.inf, 0
    for row in sizes:
        size += row["n"]
        if size > most:
            break
        lowest = row["level"]
    is_frequent = level >= F.lit(float(lowest))
    rows = model.filter(is_frequent).groupBy("key").agg(F.sum("weight").alias("weight")).toArrow()
    return rows["key"].to_numpy(), rows["weight"].to_numpy(), model.filter(~is_frequent).select("key", "weight")


def marks(keys: DataFrame, bits: int = MARKS) -> np.ndarray:
    """A bit for each residue of a key; what Spark sums up are blocks of 4 KB."""
    mark = F.shiftrightunsigned("key", 3).bitwiseAND(F.lit(bits - 1)) + 1  # the functions count from 1
    blocks = keys.groupBy(F.bitmap_bucket_number(mark).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(mark)).alias("bits"))
    found = np.zeros((-(-bits // (1 << 15)), 1 << 12), np.uint8)
    for row in blocks.toLocalIterator():
        found[row["block"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return found.ravel()


def marked(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    mark = keys >> np.uint64(3) & np.uint64(8 * len(bits) - 1)
    return bits[mark >> np.uint64(3)] >> (mark & np.uint64(7)).astype(np.uint8) & 1 == 1


def wave_of(keys: np.ndarray, waves: int) -> np.ndarray:
    """The wave of the scoring in which a key is asked for; ``half_scored`` has the same in Spark."""
    return (keys >> np.uint64(40)) % np.uint64(waves)


def by_order(ids: np.ndarray, text: np.ndarray, order: int):
    """Keys and texts of the n-grams of each order, contexts included."""
    at, keys = place(text), ids
    for n in range(1, order + 1):
        if n > 1:
            keys = longer(keys, ids)
        read = at >= (order - 1 if n == order else order - 2)
        yield keys[read], text[read]


def partly_scored(
    docs: DataFrame, keep: Sequence[str], log_p: Broadcast, unknown: float, frequent: Broadcast, text: str, order: int = WORDS,
) -> DataFrame:
    """``keep``, n_symbols and in ``nats`` what spellings and frequent n-grams (keys, weights) add up to."""
    keep = list(keep)
    chosen = docs.select(*keep, text)

    def run(batches):
        table = np.frombuffer(log_p.value[0], np.float32)
        known = pd.Index(np.frombuffer(frequent.value[0], np.int64))
        weight = np.append(np.frombuffer(frequent.value[1], np.float64), 0.0)  # the last is what unknown keys find
        for batch in batches:
            for start, end in slices(batch.column(len(keep)), SLICE):
                rows = batch.slice(start, end - start)
                ids, owner, words, at = read_words(rows.column(len(keep)), order)
                codes, starts = ngrams([*words.to_pylist(), ""])
                spelled = -np.add.reduceat(table[codes].astype(np.float64), starts) - unknown
                size = np.diff(np.append(starts, len(codes)))
                which = np.full(len(ids), len(words))
                is_read = place(owner) >= order - 1
                which[is_read & (np.diff(owner, append=len(rows)) == 0)] = at
                of, which = owner[is_read], which[is_read]
                number = np.bincount(of, size[which]).astype(np.int64)
                nats = np.bincount(of, spelled[which])
                for keys, of in by_order(ids, owner, order):
                    nats -= np.bincount(of, weight[known.get_indexer(keys.view(np.int64))], len(rows))
                arrays = [*rows.columns[: len(keep)], pa.array(number), pa.array(nats)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_symbols", "nats"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[: len(keep)])
    return chosen.mapInArrow(run, f"{fields}, n_symbols long, nats double")


def text_ngrams(texts: DataFrame, bits: Broadcast, order: int = WORDS, wave: int = 0, waves: int = 1) -> DataFrame:
    """(text_key, key, times) of the marked n-grams of all orders in ``texts`` (text_key, text), of one wave, text by text."""

    def run(batches):
        table = np.frombuffer(bits.value[0], np.uint8)
        for batch in batches:
            for start, end in slices(batch.column(1), SLICE):
                rows = batch.slice(start, end - start)
                ids, text, _, _ = read_words(rows.column(1), order)
                owner = rows.column(0).to_numpy()
                for keys, of in by_order(ids, text, order):
                    in_wave = wave_of(keys, waves) == wave
                    keys, of = keys[in_wave], of[in_wave]
                    asked = marked(keys, table)
                    keys, of = keys[asked], of[asked]
                    apart = keys + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)  # by text
                    _, first, times = np.unique(apart, return_index=True, return_counts=True)
                    placed = np.argsort(first)  # rows of one text together take less room in a shuffle
                    first, times = first[placed], times[placed]
                    arrays = [pa.array(owner[of[first]]), signed(keys[first]), pa.array(times)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["text_key", "key", "times"])

    return texts.mapInArrow(run, "text_key long, key long, times long")


def half_scored(
    training: DataFrame, judged: DataFrame, order: int = WORDS, most: int = FREQUENT, bits: int = MARKS, waves: int = WAVES
) -> DataFrame:
    """(__id, __lang, n_symbols, nats) of ``judged`` (those, text_key, __body), by the model of the one column of ``training``."""
    spark = judged.sparkSession
    words = cut_lineage(vocabulary(training))
    log_p = probabilities(cut_lineage(count_ngrams(words.select("word"))))
    with shared_arrays(spark, log_p) as spelling:
        spelled = cut_lineage(scored(words, ["id"], spelling, "word"))
        discard(words)
        model, unknown = weights(cut_lineage(count_words(training, order)), spelled.select("id", "nats"), order, waves)
        discard(spelled)
        *frequent, others = divided(reduce(DataFrame.unionByName, model), most)
        with shared_arrays(spark, *frequent) as sums:
            found = cut_lineage(partly_scored(judged, ["__id", "__lang", "text_key"], spelling, unknown, sums, "__body", order))
    wave, known = F.pmod(F.shiftrightunsigned("key", 40), F.lit(waves)), []
    for k in range(waves):
        of_wave = others.filter(wave == k)
        found_marks = marks(of_wave, bits)
        if not found_marks.any():
            continue  # all of them are frequent
        with shared_arrays(spark, found_marks) as asked:
            rows = text_ngrams(judged.select("text_key", "__body"), asked, order, k, waves).join(of_wave, "key")
            known.append(cut_lineage(rows.groupBy("text_key").agg(F.sum(F.col("times") * F.col("weight")).alias("known"))))
    discard(*model)
    if not known:
        return found.drop("text_key")
    copies = found.groupBy("text_key").agg(F.count("*").alias("copies"))
    of_text = reduce(DataFrame.unionByName, known).groupBy("text_key").agg(F.sum("known").alias("known")).join(copies, "text_key")
    of_text = of_text.select("text_key", (F.col("known") / F.col("copies")).alias("known"))
    nats = F.col("nats") - F.coalesce("known", F.lit(0.0))
    whole = cut_lineage(found.join(of_text, "text_key", "left").select("__id", "__lang", "n_symbols", nats.alias("nats")))
    discard(found, *known)
    return whole


def classify(
    docs: DataFrame,
    trusted: DataFrame,
    id_column: str = "doc_id",
    language: str = "lang",
    text: str = "text",
    quantile: float = QUANTILE,
    prior: float = PRIOR,
    order: int = WORDS,
    most: int = FREQUENT,
    bits: int = MARKS,
    waves: int = WAVES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """id, language, n_symbols, perplexity, threshold (of the smoothed score, as a perplexity), kept.

    ``trusted`` has one column: the ids of trusted documents. Within ``broadcast_bytes`` it is broadcast, so that
    training shuffles no text; beyond that it is joined by id. ``order`` is that of the n-grams of words;
    ``most`` and ``bits``, a power of two, bound what is broadcast of them; ``waves`` divides what is shuffled at once.
    """
    ids = cut_lineage(trusted.toDF("__trusted").filter("__trusted is not null").distinct())
    small = F.broadcast(ids) if ids.count() * 16 <= broadcast_bytes else ids
    is_trusted = F.col("__id") == F.col("__trusted")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = docs.select(
        F.col(f"`{id_column}`").alias("__id"), F.col(f"`{language}`").alias("__lang"), F.xxhash64(body).alias("text_key"), body.alias("__body")
    )
    own = F.col("text_key").bitwiseAND(F.lit(1))
    training = named.join(small, is_trusted, "left_semi")
    with freeing_shuffles(docs.sparkSession):
        halves = [half_scored(training.filter(own == h).select("__body"), named.filter(own != h), order, most, bits, waves) for h in (0, 1)]
    found = halves[0].unionByName(halves[1])
    reference = found.join(small, is_trusted, "left_semi")
    languages = found.select(F.col("__lang").alias("__of")).distinct()
    means = reference.groupBy(F.col("__lang").alias("__of")).agg((F.sum("nats") / F.sum("n_symbols")).alias("own"))
    mean_of_all = reference.agg((F.sum("nats") / F.sum("n_symbols")).alias("mean")).first()["mean"]
    means = languages.join(means.withColumnRenamed("__of", "__by"), F.col("__of").eqNullSafe(F.col("__by")), "left")
    means = cut_lineage(means.select("__of", F.coalesce("own", F.lit(mean_of_all).cast("double")).alias("mean")))

    def smoothed(rows):
        rows = rows.join(means, F.col("__lang").eqNullSafe(F.col("__of"))).drop("__of")
        drawn = (F.col("nats") + F.lit(prior) * F.col("mean")) / (F.col("n_symbols") + F.lit(prior))
        return rows.withColumn("score", drawn)

    steps = smoothed(reference).groupBy("__lang", F.ceil(F.col("score") * 1000).alias("step")).agg(F.count("*").alias("n"))
    steps = cut_lineage(steps)  # some thousands of steps a language
    all_steps = steps.groupBy("step").agg(F.sum("n").alias("n")).select(F.lit(0).alias("own"), F.lit(None).cast("string").alias("__by"), "step", "n")
    ranked = steps.select(F.lit(1).alias("own"), F.col("__lang").cast("string").alias("__by"), "step", "n").unionByName(all_steps)
    of = Window.partitionBy("own", "__by")
    ranked = ranked.withColumns({
        "below": F.sum("n").over(of.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n").over(of)
    })
    limits = ranked.filter(F.col("below") >= F.lit(quantile) * F.col("all")).groupBy("own", "__by").agg(F.min("step").alias("step"))
    limits = cut_lineage(limits.withColumn("limit", F.col("step") / 1000).drop("step"))
    limit_of_all = (limits.filter("own = 0").first() or {"limit": None})["limit"]
    own_limits = limits.filter("own = 1").select("__by", "limit")
    judged = smoothed(found).join(own_limits, F.col("__lang").cast("string").eqNullSafe(F.col("__by")), "left")
    limit = F.coalesce("limit", F.lit(limit_of_all).cast("double"))
    return judged.select(
        F.col("__id").alias(id_column), F.col("__lang").alias(language), "n_symbols",
        F.exp(F.col("nats") / F.col("n_symbols")).alias("perplexity"), F.exp("score").alias("smoothed"),
        F.exp(limit).alias("threshold"), F.coalesce(F.col("score") <= limit, F.lit(True)).alias("kept"),
    )
