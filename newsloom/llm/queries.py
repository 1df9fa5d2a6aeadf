"""One query per dealt operator, over its whole table, and the SQL of those that SQL can express."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.cascade import METRICS, quality_rules, rule_order
from newsloom.llm.credentials import BASE, secret_spans, written
from newsloom.llm.decontaminate import overlaps
from newsloom.llm.line_dedup import line_dedup
from newsloom.llm.negatives import hard_negatives
from newsloom.llm.packing import pack
from newsloom.llm.page_text import page_text
from newsloom.llm.perplexity import classify
from newsloom.llm.pseudonyms import pseudonymize
from newsloom.llm.records import new_folder, read_index, read_records, write_records
from newsloom.llm.sharding import shard
from newsloom.llm.simhash import as_hex, fingerprints, near_duplicates
from newsloom.llm.spelling import spelling_variants
from newsloom.session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark, sf_dir):
    """Documents without the boilerplate lines of their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup(docs)


def op2_records(spark, sf_dir):
    """What the record files say of each document once they are read back."""
    folder = new_folder(spark)
    write_records(table(spark, sf_dir, "documents"), folder, tokenizer())
    read = read_records(spark, folder).select("file", "number", "doc_id", F.crc32("ids").alias("ids_crc32"),
                                              (F.octet_length("ids") / 4).cast("long").alias("n_tokens"))
    placed = read.join(read_index(spark, folder).select("file", "number", "start"), ["file", "number"])
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_pseudonyms(spark, sf_dir):
    """Documents with pseudonyms for personal values. The key is an example; a real one comes from a secret store."""
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), "example key")


def op4_credentials(spark, sf_dir):
    """Base spans of each document, and all spans with the weak ones that others complete."""
    found = secret_spans(table(spark, sf_dir, "documents"), ["doc_id"])

    def count(kind):
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("linked")).alias("spans")
    )


def op5_perplexity(spark, sf_dir):
    """Perplexity of each document under a word model of the other half's documents labelled good, and whether its language allows it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return classify(docs, table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"))


def op6_quality_rules(spark, sf_dir):
    """Word, symbol and repetition counts of each document, and the cascade's verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, rule_order(docs), metrics=METRICS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *METRICS, failed.alias("base_failed"), "kept")


def op7_packing(spark, sf_dir):
    """The pieces of all documents in near-equal windows of at most 2048 ids."""
    pieces = pack(table(spark, sf_dir, "documents"), ["doc_id"], tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_decontaminate(spark, sf_dir):
    """Where documents overlap benchmark items."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash(spark, sf_dir):
    """Fingerprint and component of each document."""
    marked = cut_lineage(fingerprints(table(spark, sf_dir, "documents"), ["doc_id"]))
    found = near_duplicates(marked)
    return found.select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op10_sharding(spark, sf_dir):
    """The shard and place of each document."""
    return shard(table(spark, sf_dir, "documents"), ["doc_id"])


def op11_page_text(spark, sf_dir):
    """The main text of each page."""
    return page_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op12_spelling_variants(spark, sf_dir):
    """The words of all documents, the near word each is a variant of, and where these lead."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark, sf_dir):
    """The hard negatives of every hundredth vector's positives; every seventh vector has a wrong label first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


QUERIES = {
    run.__name__: run
    for run in (
        op1_line_dedup, op2_records, op3_pseudonyms, op4_credentials, op5_perplexity, op6_quality_rules, op7_packing,
        op8_decontaminate, op9_simhash, op10_sharding, op11_page_text, op12_spelling_variants, op13_hard_negatives,
    )
}

ORACLE = {
    "op1_line_dedup": r"""
WITH cut AS (
    SELECT doc_id, source, i, line, trim(line, chr(32) || chr(9) || chr(13) || chr(12) || chr(11)) AS bare
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS i
          FROM documents)),
totals AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
shared AS (
    SELECT source, bare FROM cut JOIN totals USING (source) WHERE bare <> ''
    GROUP BY source, bare, total
    HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) > total * 0.1::DOUBLE),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE shared.bare IS NULL) AS text,
           count(shared.bare) AS n_dropped
    FROM cut LEFT JOIN shared ON cut.source = shared.source AND cut.bare = shared.bare
    GROUP BY doc_id)
SELECT doc_id, source, CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(n_dropped, 0) AS n_dropped
FROM documents LEFT JOIN kept USING (doc_id)
""",
    "op6_quality_rules": r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
    FROM documents),
windows AS (
    SELECT doc_id, i, words[i : i + 2] AS three
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM cut)),
found AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows),
covered AS (
    SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words
    FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS d FROM found WHERE n > 1) GROUP BY doc_id),
counts AS (
    SELECT doc_id, words, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           len([w FOR w IN words IF ends_with(w, '!!')]) AS n_shouted,
           len([w FOR w IN words IF regexp_full_match(w, '[^\pL\pM]+')]) AS n_wordless
    FROM cut LEFT JOIN covered USING (doc_id)),
stutters AS (
    SELECT doc_id, count(*) AS n_stuttered
    FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM cut)
    WHERE words[i] = words[i + 1] GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines
            OR 5 * n_shouted > n_words OR 5 * n_wordless > n_words
            OR 5 * coalesce(n_stuttered, 0) > n_words) AS kept
FROM counts LEFT JOIN stutters USING (doc_id)
""",
    # The extraction goes by structure; this says what it must give on the markup that the given pages have.
    "op11_page_text": r"""
WITH cut AS (
    SELECT page_id, url,
           string_split(regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
               '<br>', ' ', 'g'), '</?(h1|p)>', chr(1), 'g'), chr(1)) AS blocks
    FROM pages),
bare AS (
    SELECT page_id, url,
           [trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(b, '</?b>', '', 'g'),
               '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))
            FOR b IN blocks] AS blocks
    FROM cut),
joined AS (
    SELECT page_id, url, coalesce(array_to_string([b FOR b IN blocks IF b <> ''], chr(10) || chr(10)), '') AS text
    FROM bare)
SELECT page_id, url, text, length(text) AS n_chars FROM joined
""",
    "op13_hard_negatives": r"""
WITH vectors AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS alike,
           list_inner_product(a.vec, b.vec)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positives AS (
    SELECT a, anchor_id, b AS positive, id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5),
ranked AS (
    SELECT scores.anchor_id, positive_id, positive_score, scores.id AS negative_id, scores.score AS negative_score,
           row_number() OVER (PARTITION BY scores.a, positive ORDER BY scores.score DESC, scores.id, scores.b) AS rank
    FROM positives JOIN scores ON positives.a = scores.a AND NOT alike
     AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
""",
}
