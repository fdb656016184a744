"""Quality rules: counts of repetition and symbols, and a hashed n-gram likelihood ratio.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, discard, materialize, words

MIN_WORDS = 50
#: Rejected when repeated windows cover more than this percentage of the words.
MAX_REPEAT = 50
SYMBOLS = "[#*$%&|<>]"
#: Buckets of the hashed one- and two-token counts; the table has this size for any input.
#: So few that a rare n-gram, met in one document, says next to nothing about that document.
BUCKETS = 1 << 14
SMOOTH = 0.5
#: Repeated hashes up to this number are looked up one by one; beyond it the text's windows are sorted.
FEW = 64
#: Rejected below a ratio, in nats for each n-gram, that lies MARGIN under all but a thousandth (LOW) of all trusted
#: documents.
MARGIN, LOW = 0.3, 0.001
#: A value is looked for in bins of 1 / BINS, then in bins 1,024 times as fine, until so few values are left.
BINS, LEFT = 64, 4_096
#: Trusted ids up to this number (8 bytes each) are sent to the tasks; more meet the documents in a shuffled join.
TRUSTED_SENT = 1_000_000


def tokens(text: Column) -> Column:
    """Words with their marks split off: marks that fill a text show as tokens of their own."""
    return words(F.regexp_replace(text, r"([^\p{L}\p{N}\x20\x09-\x0D]++)", " $1 "))


def bucket(h: Column) -> Column:
    """The bucket of a token by its hash."""
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def pair_bucket(h: Column, after: Column) -> Column:
    """The bucket of a token and the one after it, by their hashes."""
    return bucket(F.shiftrightunsigned(h, 17).bitwiseXOR(after))


def all_but_first(a: Column) -> Column:
    return F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))


def gram_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(bucket) of each token and of each pair of neighbours of all texts; hashed in generated code, row by row."""
    w = docs.select(tokens(F.col(text_col)).alias("w"))
    pairs = w.select(F.explode(F.arrays_zip(F.col("w").alias("a"), all_but_first(F.col("w")).alias("b"))).alias("p"))
    # xxhash64 of null is its seed: whether there is a token after is kept apart
    h = pairs.select(F.xxhash64("p.a").alias("a"), F.xxhash64("p.b").alias("b"), F.col("p.b").isNotNull().alias("more"))
    rows = h.select(F.explode(F.array(bucket(F.col("a")), F.when(F.col("more"), pair_bucket(F.col("a"), F.col("b"))))).alias("bucket"))
    return rows.where("bucket is not null")


def with_ratio(rows: DataFrame, table: Column, text_col: str, out: str = "ratio") -> DataFrame:
    """rows with the mean of the table's values over the text's n-grams; 0 without any."""
    h, values = F.col("__h"), F.col("__table")
    rows = rows.withColumn("__table", table).withColumn("__t", tokens(F.col(text_col))).withColumn("__h", F.transform("__t", lambda x: F.xxhash64(x)))
    later = F.transform(all_but_first(h), lambda x, i: F.get(values, bucket(x)) + F.get(values, pair_bucket(F.get(h, i), x)))
    total = F.aggregate(later, F.coalesce(F.get(values, bucket(F.get(h, F.lit(0)))), F.lit(0.0)), lambda acc, x: acc + x)
    return rows.withColumn(out, total / F.greatest(2 * F.size(h) - 1, F.lit(1))).drop("__table", "__t", "__h")


def repeated_words(rows: DataFrame) -> DataFrame:
    """rows with n_repeat_words: the words of __w inside three-word windows that occur at least twice.

    Equal windows have equal 64-bit hashes.  A text with few repeated hashes
    looks each window up in them and goes on with those alone.  A window's hash
    and its place share one long, equal windows are neighbours after a sort, and
    neighbours are compared word by word.  Each step is a column of its own and
    not a nested lambda: the generated code then works on primitive longs.
    """
    w, h, low, at, d, p = (F.col(x) for x in ("__w", "__h", "__low", "__at", "__d", "__p"))
    # each word is hashed once; a window's hash is that of its words' hashes
    rows = rows.withColumn("__x", F.transform(w, lambda x: F.xxhash64(x)))
    one = F.col("__x")
    windows = F.transform(F.slice(one, 3, F.greatest(F.size(one) - 2, F.lit(0))), lambda x, i: F.xxhash64(F.get(one, i), F.get(one, i + 1), x))
    rows = rows.withColumn("__h", windows).withColumn("__s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(h)))
    rows = rows.withColumn("__d", F.array_distinct(F.filter("__s", lambda v, k: v == F.get(F.col("__s"), k + 1))))
    rows = rows.withColumn("__low", F.pow(F.lit(2.0), F.ceil(F.log2(F.size(h) + F.lit(1.0)))).cast("long") - 1)
    packed = lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))
    few = F.sort_array(F.array_compact(F.transform(h, lambda x, i: F.when(F.array_contains(d, x), packed(x, i)))))
    rows = rows.withColumn("__p", F.when(F.size(d) > FEW, F.sort_array(F.transform(h, packed))).when(F.size(d) > 0, few))

    def same(a: Column, b: Column) -> Column:
        i, j = a.bitwiseAND(low).cast("int"), b.bitwiseAND(low).cast("int")
        equal = (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))
        return F.coalesce(a.bitwiseXOR(b).between(F.lit(0), low) & equal, F.lit(False))

    many = F.filter(p, lambda v, k: same(v, F.get(p, k + 1)) | same(v, F.get(p, k - 1)))
    rows = rows.withColumn("__at", F.when(F.size(d) > 0, F.sort_array(F.transform(many, lambda v: v.bitwiseAND(low)))))
    gaps = F.transform(at, lambda p, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, k + 1) - p, F.lit(3).cast("long"))))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__x", "__h", "__s", "__d", "__low", "__p", "__at")


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with __w (words) and the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    drop = [c for c in docs.columns if c.lower() in {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"} and c != text_col]
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = docs.drop(*drop).withColumn("__w", words(F.col(text_col))).withColumn("__lines", lines)
    w, x = F.col("__w"), F.col("__lines")
    out = out.withColumn("n_words", F.size(w).cast("long")).withColumn("word_chars", F.length(F.array_join(w, "")).cast("long"))
    out = out.withColumn("n_symbols", (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"))
    out = out.withColumn("n_dup_lines", (F.size(x) - F.size(F.array_distinct(x))).cast("long")).drop("__lines")
    return repeated_words(out)


def trusted_rows(docs: DataFrame, trusted: DataFrame, id_col: str) -> DataFrame:
    """The rows of docs with a trusted id; no text moves where the ids are few enough to be sent."""
    good = trusted.select(F.col(id_col).alias("__id")).where("__id is not null").distinct()
    good = F.broadcast(good) if good.count() <= TRUSTED_SENT else good
    return docs.join(good, docs[id_col] == good["__id"], "left_semi")


def ratio_table(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, ratio): log-likelihood ratio of the trusted documents to all, from all n-grams of all documents."""
    rows = docs.select(id_col, text_col)
    counted = lambda r, n: gram_rows(r, text_col).groupBy("bucket").agg(F.count("*").alias(n))
    counts = counted(rows, "all").join(counted(trusted_rows(rows, trusted, id_col), "good"), "bucket", "left").fillna(0)
    counts = materialize(counts, "ngram-counts")
    sums = counts.agg(F.sum("good").alias("g"), F.sum("all").alias("a"))
    total_g, total_a = sums.select("g").scalar(), sums.select("a").scalar()
    filled = counts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0)
    rate = lambda n, total: F.log((F.col(n) + SMOOTH) / (F.coalesce(total, F.lit(0)) + SMOOTH * BUCKETS))
    return filled.select("bucket", (rate("good", total_g) - rate("all", total_a)).alias("ratio"))


def value_at(values: DataFrame, rank: int) -> float:
    """The value of that rank, 0 the least, of one column of finite numbers, exactly.

    Only counts of bins and at most LEFT values leave the tasks, at any size; equal values are one bin of their own.
    """
    x, inside, fine = F.col(values.columns[0]), values, BINS
    while True:
        key = F.floor(x * F.lit(float(fine)))
        bins = inside.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))
        for r in bins.orderBy("key").collect():
            if rank < r.n:
                break
            rank -= r.n
        if r.low == r.high:
            return r.low
        inside = inside.where(key == r.key)
        if r.n <= LEFT:
            return sorted(v for (v,) in inside.collect())[rank]
        fine *= 1024


def calibrated_ratio(docs: DataFrame, trusted: DataFrame, table: Column, id_col: str, text_col: str) -> float:
    """The least ratio that passes: MARGIN below the ratio that all but LOW of the trusted documents reach.

    Read from all trusted documents with enough words, linear between two of them; without any, no ratio fails.
    """
    rows = with_ratio(trusted_rows(docs.select(id_col, text_col), trusted, id_col), table, text_col)
    # not a filter: pushed below the join, it would split every text
    long_enough = F.when(F.size(words(F.col(text_col))) >= MIN_WORDS, F.col("ratio"))
    found = materialize(rows.select(long_enough.alias("ratio")), "trusted-ratios")
    values = found.where("ratio is not null")
    at = LOW * (values.count() - 1)
    if at < 0:
        return -math.inf
    low, high = (value_at(values, k) for k in (math.floor(at), math.ceil(at)))
    discard(found)
    return low + (high - low) * (at - math.floor(at)) - MARGIN


def judged(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_ratio: float | None = None, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """docs with the counts, base_failed, ratio (nats for each n-gram) and kept.

    trusted: a table of the ids of trusted documents; they also calibrate the
    least ratio that is kept, if none is given.  Null and empty texts have no
    words and fail; very long texts are counted whole; with no trusted documents
    the base rules decide.  Columns of the names made here are replaced; others
    stay.  Repeated rows give repeated rows, each judged by itself, and equal
    ratios pass or fail alike; an empty table gives none.
    """
    table = materialize(ratio_table(docs, trusted, id_col, text_col), "ngram-ratios")
    values = table.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))), lambda x: x["ratio"])).scalar()
    if least_ratio is None:
        least_ratio = calibrated_ratio(docs, trusted, values, id_col, text_col)
    out = with_ratio(counted(docs, text_col), values, text_col)
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")))
    # the partition's number is never below 0; naming it keeps a filter on kept above these columns:
    # pushed down, it would put whole expressions, tokenizing and all, into the lambdas
    passed = F.when(F.spark_partition_id() >= 0, ~F.col("base_failed") & (F.col("ratio") >= F.lit(least_ratio)))
    return out.withColumn("kept", passed).drop("__w")


def kept(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that pass, with their own columns."""
    shelf = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in (id_col, text_col)}
    found = judged(docs.withColumnsRenamed(shelf), trusted, id_col, text_col, **options).where("kept")
    return found.select(*[F.col(shelf.get(c, c)).alias(c) for c in docs.columns])
