"""URL filter: host and path rules, and a ratio of character language models.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lower_ascii, materialize

#: (verdict, rule): the rule's host, then its path.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: 41 symbols: letters, digits, marks, one for anything else, one for both ends.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789.-/_^"
#: A symbol is judged after up to ORDER symbols: 41**(ORDER+1) table entries, at any input size.
ORDER = 3
#: Weight of the next shorter context.
BACKOFF = 4.0
#: One of FOLDS rows calibrates the threshold; the others are counted.
FOLDS = 5
#: Width of a bin of the length-normalised difference, in nats, and the range of bins.
BIN, REACH = 0.02, 500


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? or #; path: then up to ? or #; both empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host, or a parent of it, and the path's start."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: len(r[1])):  # the last one set is the outermost
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def symbols(host: Column, path: Column) -> Column:
    """The array of symbol numbers of an url, with end marks."""
    s = F.regexp_replace(F.lower(F.concat(host, path)), "[^a-z0-9./-]", "_")
    return F.transform(F.split(F.concat(s, F.lit("^")), "(?!$)"), lambda c: F.instr(F.lit(ALPHABET), c).cast("long") - 1)


_STEP, _START = len(ALPHABET), sum((len(ALPHABET) - 1) * len(ALPHABET) ** i for i in range(ORDER))
_SIZE = len(ALPHABET) ** (ORDER + 1)


def _grams(syms: Column) -> Column:
    """For each symbol the number of the gram that ends in it."""
    start = F.struct(F.lit(_START).cast("long").alias("code"), F.array().cast("array<bigint>").alias("all"))

    def add(acc: Column, s: Column) -> Column:
        code = (acc["code"] * _STEP + s) % _SIZE
        return F.struct(code.alias("code"), F.concat(acc["all"], F.array(code)).alias("all"))

    return F.aggregate(syms, start, add, lambda acc: acc["all"])


def _model(counts: DataFrame, n: str, out: str) -> DataFrame:
    """(code, out): the log-probability of a gram's last symbol after the others, shorter contexts mixed in."""
    spark = counts.sparkSession
    table = spark.range(_SIZE).select(F.col("id").alias("code")).withColumn("p", F.lit(1.0 / _STEP))
    for order in range(ORDER + 1):
        span = _STEP ** (order + 1)
        seen = counts.groupBy((F.col("code") % span).alias("g")).agg(F.sum(n).alias("n_gram"))
        context = counts.groupBy(F.floor((F.col("code") % span) / _STEP).alias("c")).agg(F.sum(n).alias("n_context"))
        table = table.withColumn("g", F.col("code") % span).join(seen, "g", "left").withColumn("c", F.floor(F.col("g") / _STEP)).join(context, "c", "left")
        p = (F.coalesce("n_gram", F.lit(0)) + BACKOFF * F.col("p")) / (F.coalesce("n_context", F.lit(0)) + BACKOFF)
        table = table.select("code", p.alias("p"))
    return table.select("code", F.log("p").alias(out))


def judged(urls: DataFrame, url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """The rows of urls with host, path, rule, score and verdict; columns of those names are replaced.

    Rules decide first.  The urls they decide, all of them, train an accepted
    and a rejected model; the rest are allowed if their log-likelihood
    difference for each symbol reaches a threshold, the one with the least mean
    error over both classes on a fold that is not counted.  Without both classes
    everything undecided is allowed.  A null url has an empty host and path.
    """
    host, path = host_and_path(F.col(url_col))
    drop = [c for c in urls.columns if c.lower() in {"host", "path", "rule", "verdict", "score"} and c != url_col]
    base = urls.drop(*drop).withColumn("host", host).withColumn("path", path)
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("__said", said)
    fold = F.pmod(F.xxhash64("host", "path"), F.lit(FOLDS))
    decided = base.where("__said is not null").select((F.col("__said") == "allow").cast("long").alias("yes"), symbols(F.col("host"), F.col("path")).alias("s"), fold.alias("fold"))
    grams = decided.where("fold > 0").select("yes", F.explode(_grams(F.col("s"))).alias("code"))
    counts = materialize(grams.groupBy("code").agg(F.sum("yes").alias("yes"), F.sum(1 - F.col("yes")).alias("no")), "url-grams")
    ratio = _model(counts, "yes", "yes").join(_model(counts, "no", "no"), "code").select("code", (F.col("yes") - F.col("no")).cast("float").alias("d"))
    ratio = materialize(ratio, "url-model")

    def scored(rows: DataFrame, syms: str, name: str) -> DataFrame:
        # the table has a fixed size, so it goes to the tasks as one value
        table = ratio.agg(F.transform(F.sort_array(F.collect_list(F.struct("code", "d"))), lambda x: x["d"])).scalar()
        total = F.aggregate(_grams(F.col(syms)), F.lit(0.0), lambda acc, g: acc + F.get(F.col("__table"), g.cast("int")).cast("double"))
        return rows.withColumn("__table", table).withColumn(name, total / F.size(syms)).drop("__table")

    held = scored(decided.where("fold = 0"), "s", "score")
    at = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.floor(F.col("score") / BIN)))
    bins = held.groupBy(at.alias("bin")).agg(F.sum("yes").alias("yes"), F.sum(1 - F.col("yes")).alias("no"))
    below, every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    part = lambda n: F.try_divide(F.coalesce(F.sum(n).over(below), F.lit(0)), F.sum(n).over(every))
    error = part("yes") + 1 - part("no")
    best = bins.select("bin", error.alias("error")).agg(F.min_by(F.col("bin") * BIN, F.struct("error", "bin"))).scalar()
    out = scored(base.withColumn("__s", symbols(F.col("host"), F.col("path"))), "__s", "score").withColumn("__least", best)
    verdict = F.coalesce("__said", F.when(F.col("score") < F.col("__least"), "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).drop("__said", "__s", "__least")
