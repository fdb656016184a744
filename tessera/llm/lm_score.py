"""Language-model scoring: a log-bilinear model trained by noise-contrastive estimation, in numpy."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

#: Places of the neural vocabulary: the most frequent words, one each, then SUFFIXES classes of words, then the end.
VOCAB, SUFFIXES = 2048, 512
#: Most frequent tokens whose counts go to every task; counts of others are joined.
FREQUENT = 1 << 18
DIM, CONTEXT = 16, 2
BATCH, NOISE, RATE = 2048, 64, 0.08
#: Training tokens of a trainer, about: trainers grow with the corpus, not with tasks.  Rounds of training and averaging.
TRAIN_TOKENS, ROUNDS = 2_000_000, 2
#: Types that a task counts before it hands them on; tokens of a training row.
TYPES_MAX, PIECE = 400_000, 500_000
#: Parameters of so many trainers are summed by one task, level by level.
FAN = 16
#: Stands for the end of a text; no word holds a line end.
END = b"\n"
CHUNK = 200_000


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words with A-Z lower-cased, without the end."""
    return (text or b"").lower().split()


def suffix_class(token: bytes) -> int:
    """The class of a word without a place of its own: by its last three bytes, so that words of one form share it."""
    return zlib.crc32(token[-3:]) % SUFFIXES


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, class, n) over all texts (column text), the ends included; counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            cols = [pa.array(found.keys(), pa.binary()), pa.array(map(suffix_class, found.keys()), pa.int32()), pa.array(found.values(), pa.int64())]
            b = pa.RecordBatch.from_arrays(cols, names=["token", "class", "n"])
            found.clear()
            return b

        for b in batches:
            for t in b.column(0).cast(pa.binary()).to_pylist():
                found.update(tokens_of(t))
                found[END] += 1
                if len(found) > TYPES_MAX:
                    yield out()
        if found:
            yield out()

    return texts.select("text").mapInArrow(run, "token binary, class int, n long").groupBy("token", "class").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most `most` tokens, the highest counts first; among equal counts by hash, whole 65,536ths of it.

    Sizes are binned by a sixteenth of a power of two, then the bin that does
    not fit by count, then that count by hash, so the bins are few at any input
    and no task sends more tokens than are wanted in all.
    """
    size, mark = F.floor(F.log2("n") * 16), F.shiftrightunsigned(F.xxhash64("token"), 48)
    left, inside, held = most, F.lit(True), F.lit(False)
    for key in (size, F.col("n"), mark):
        down = key is not mark
        bins = counts.where(inside).groupBy(key.alias("key")).agg(F.count("*").alias("k")).orderBy(F.desc("key") if down else F.asc("key"))
        last = None
        for r in bins.collect():
            if r.k > left:
                break
            left, last = left - r.k, r["key"]
        else:  # all that is left fits
            held = held | inside
            break
        if last is not None:
            held = held | (inside & ((key >= last) if down else (key <= last)))
        inside = inside & (key == r["key"])
    rows = counts.where(held).collect()
    return sorted(((bytes(r.token), r.n) for r in rows), key=lambda x: (-x[1], x[0]))


class LogBilinear:
    """P(word | the two tokens before): softmax of a bias and an inner product with the sum of position vectors."""

    def __init__(self, counts: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        n = len(counts)
        self.noise = (counts + 0.5) / (counts + 0.5).sum()
        self.bias = np.log(self.noise).astype(np.float32)
        self.words = rng.normal(0, 0.1, (n, DIM)).astype(np.float32)
        self.before = np.zeros((CONTEXT, n, DIM), dtype=np.float32)

    def weighted(self, targets: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """The parameters times how often each row was trained, and those numbers: targets, and contexts at each place."""
        w, c = targets.astype(np.float64), seen.astype(np.float64)
        return np.concatenate([self.bias * w, (self.words * w[:, None]).ravel(), (self.before * c[:, :, None]).ravel(), w, c.ravel()])

    def average(self, flat: np.ndarray) -> None:
        """Take the averages of summed weighted(); rows that no trainer met stay."""
        n = len(self.bias)
        sizes = np.cumsum([n, n * DIM, CONTEXT * n * DIM, n])
        bias, words, before, w, c = np.split(flat, sizes)
        words, before, c = words.reshape(n, DIM), before.reshape(CONTEXT, n, DIM), c.reshape(CONTEXT, n)
        at = w > 0
        self.bias[at] = (bias[at] / w[at]).astype(np.float32)
        self.words[at] = (words[at] / w[at][:, None]).astype(np.float32)
        for k in range(CONTEXT):
            at = c[k] > 0
            self.before[k][at] = (before[k][at] / c[k][at][:, None]).astype(np.float32)

    def copy(self) -> LogBilinear:
        out = LogBilinear(np.ones(len(self.bias)))
        out.noise, out.bias, out.words, out.before = self.noise, self.bias.copy(), self.words.copy(), self.before.copy()
        return out

    def trainer(self, seed: int):
        """A function that takes one batch (contexts, targets): a step of AdaGrad on the NCE loss, noise shared in the batch."""
        rng = np.random.default_rng(seed)
        cumulative = np.cumsum(self.noise)
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        seen = [np.full_like(x, 1.0) for x in (self.bias, self.words, self.before[0], self.before[1])]
        n = len(self.bias)

        def scatter(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The distinct places and the sums of their rows."""
            order = np.argsort(at.astype(np.uint16), kind="stable")
            there = at[order]
            first = np.flatnonzero(np.concatenate([[True], there[1:] != there[:-1]]))
            return there[first], np.add.reduceat(rows.take(order, axis=0), first, axis=0)

        def move(x: np.ndarray, s: np.ndarray, at: np.ndarray, g: np.ndarray) -> None:
            now = s.take(at, axis=0) + g * g
            s[at] = now
            x[at] += np.float32(RATE) * g / np.sqrt(now)

        def step(c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> None:
            q = self.before[0].take(c1, axis=0) + self.before[1].take(c2, axis=0)
            drawn = np.searchsorted(cumulative, rng.random(NOISE)).clip(max=n - 1)
            mine = self.words.take(w, axis=0)
            good = 1 - 1 / (1 + np.exp(log_noise[w] - np.einsum("ij,ij->i", q, mine) - self.bias[w]))
            noise = self.words[drawn]
            bad = q @ noise.T
            np.subtract((log_noise - self.bias)[drawn], bad, out=bad)
            np.exp(bad, out=bad)
            bad += 1
            np.divide(-1, bad, out=bad)
            dq = good[:, None] * mine + bad @ noise
            # targets and noise meet in one sum, the bias as one more column
            rows, m = np.empty((len(w) + NOISE, DIM + 1), dtype=np.float32), len(w)
            np.multiply(good[:, None], q, out=rows[:m, :-1])
            rows[:m, -1], rows[m:, :-1], rows[m:, -1] = good, bad.T @ q, bad.sum(axis=0)
            at, g = scatter(np.concatenate([w, drawn]), rows)
            move(self.bias, seen[0], at, g[:, -1])
            move(self.words, seen[1], at, g[:, :-1])
            for k, c in enumerate((c1, c2)):
                move(self.before[k], seen[2 + k], *scatter(c, dq))

        return step

    def log_norms(self) -> np.ndarray:
        """The log of the sum over words, for each pair of context tokens: one product of exponentials."""
        a, b = self.before[0] @ self.words.T, self.before[1] @ self.words.T + self.bias
        ma, mb = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
        return (np.log(np.exp(a - ma) @ np.exp(b - mb).T) + ma + mb.T).astype(np.float32)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        return self.before[0] @ self.words.T, self.before[1] @ self.words.T + self.bias


def contexts(ids: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens one and two places before each; the end stands before a text's first."""
    c1, c2 = np.roll(ids, 1), np.roll(ids, 2)
    c1[starts] = c2[starts] = end
    second = starts[np.diff(np.append(starts, len(ids))) > 1] + 1
    c2[second] = end
    return c1, c2


def unlisted_words(places: np.ndarray, words: list[list[bytes]]) -> list[bytes]:
    """The words at places of -1, in order; the ends (-2) are not among the words."""
    flat = list(chain.from_iterable(words))
    return [flat[i] for i in np.flatnonzero(places[places != -2] == -1).tolist()]


class TextScorer:
    """Vocabulary and counts: first the places of the most frequent words, then the classes of all others, then the end."""

    def __init__(self, frequent: list[tuple[bytes, int]], total: int, types: int, classes: list[tuple[int, int]], vocab: int = VOCAB):
        """classes: for each suffix class its tokens and types, the end left out."""
        words = [(t, n) for t, n in frequent if t != END]
        self.end_count = next((n for t, n in frequent if t == END), 0)
        own = words[: max(0, vocab - SUFFIXES - 1)]
        self.own, self.end = len(own), len(own) + SUFFIXES
        self.places = {t: i for i, (t, _) in enumerate(words)}
        self.total, self.types = total, types
        tokens, kinds = (np.array([c[k] for c in classes], dtype=np.float64) for k in range(2))
        for t, n in own:
            tokens[suffix_class(t)] -= n
            kinds[suffix_class(t)] -= 1
        self.model = LogBilinear(np.concatenate([np.array([n for _, n in own], dtype=np.float64), tokens, [float(self.end_count)]]))
        # by place; places from `own` on are frequent words that share a class
        self.n = np.array([n for _, n in words], dtype=np.float64)
        self.class_of = np.array([i if i < self.own else self.own + suffix_class(t) for i, (t, _) in enumerate(words)], dtype=np.int64)
        self.base = np.log10((self.n + 0.5) / (total + 0.5 * (types + 1))) if words else np.zeros(0)
        self.base_end = float(np.log10((self.end_count + 0.5) / (total + 0.5 * (types + 1))))
        #: Of each class, the log of what the words in it share out: their counts, a half for each and a half for unseen ones.
        self.class_log = np.log10(tokens + 0.5 * (kinds + 1))
        self.share = np.log10(self.n + 0.5) - self.class_log[np.maximum(self.class_of - self.own, 0)] if words else np.zeros(0)
        self.share[: self.own] = 0.0
        self.norms: np.ndarray | None = None

    def base_of(self, n: Column) -> Column:
        return F.log10((n + 0.5) / F.lit(self.total + 0.5 * (self.types + 1)))

    def runs(self, texts: list[bytes | None]) -> Iterator[tuple[int, list[list[bytes]], np.ndarray, np.ndarray]]:
        """(first text, words of each, places with the end and -1 for unlisted, starts) for runs of texts."""
        at, run, size = 0, [], 0
        for t in [*texts, None]:
            if size >= CHUNK or (run and at + len(run) == len(texts)):
                sizes = np.array([len(w) + 1 for w in run])
                ends = np.cumsum(sizes)
                get, out = self.places.get, np.empty(int(ends[-1]), dtype=np.int64)
                flat = np.fromiter(map(get, chain.from_iterable(run), repeat(-1)), dtype=np.int64, count=int(ends[-1]) - len(run))
                mask = np.ones(len(out), dtype=bool)
                mask[ends - 1] = False
                out[mask], out[~mask] = flat, -2
                yield at, run, out, ends - sizes
                at, run, size = at + len(run), [], 0
            if at + len(run) < len(texts):
                run.append(tokens_of(t))
                size += len(run[-1]) + 1

    def ids(self, places: np.ndarray, words: list[list[bytes]]) -> np.ndarray:
        """Places to neural ids; a word that is not listed has its class."""
        out = np.full(len(places), self.end, dtype=np.int64)
        listed = places >= 0
        out[listed] = self.class_of[places[listed]]
        out[places == -1] = [self.own + suffix_class(w) for w in unlisted_words(places, words)]
        return out


def encoded(texts: DataFrame, shared, trainers: int) -> DataFrame:
    """(trainer, h, piece, ids): the neural ids of all texts, dealt to trainers by the hash of the whole row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            marks = b.column(1).to_pylist()
            for first, words, places, starts in own.runs(b.column(0).cast(pa.binary()).to_pylist()):
                ids, rows = own.ids(places, words).astype("<u2"), []
                for k, (x, y) in enumerate(zip(starts.tolist(), [*starts.tolist()[1:], len(ids)], strict=True)):
                    rows += [(marks[first + k] % trainers, marks[first + k], at, ids[x + at : min(y, x + at + PIECE)].tobytes()) for at in range(0, y - x, PIECE)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["trainer", "h", "piece", "ids"])

    return texts.select("text", F.xxhash64(*texts.columns).alias("h")).mapInArrow(run, "trainer int, h long, piece long, ids binary")


def summed(rows: DataFrame, trainers: int) -> np.ndarray:
    """The sum of all trainers' arrays (trainer, p), FAN at a time, so that no task and not the driver adds more than FAN of them."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((t, p) for b in batches for t, p in zip(b.column("trainer").to_pylist(), b.column("p").to_pylist(), strict=True))
        total = np.sum([np.frombuffer(p, "<f8") for _, p in got], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["trainer", "p"])

    while trainers > FAN:
        trainers = -(-trainers // FAN)
        rows = rows.withColumn("up", F.floor(F.col("trainer") / FAN).cast("int")).groupBy("up").applyInArrow(add, "trainer int, p binary")
    return np.sum([np.frombuffer(r.p, "<f8") for r in sorted(rows.collect(), key=lambda r: r.trainer)], axis=0)


def fit(texts: DataFrame, vocab: int = VOCAB, frequent: int = FREQUENT, train_tokens: int = TRAIN_TOKENS, rounds: int = ROUNDS) -> tuple[TextScorer, DataFrame]:
    """Learn from all texts: (scorer, counts of all tokens).

    texts: column text, and any others by which equal texts may be told apart,
    so that copies are dealt to several trainers.  The training tokens, as ids,
    are dealt by hash to trainers of about train_tokens each; in every round each
    trainer runs over its tokens in a fixed order from the same start, and the
    parameters are averaged by how often each row was trained.  The result
    depends on the rows alone, not on files, tasks or executors.
    """
    spark = texts.sparkSession
    counts = materialize(token_counts(texts), "token-counts")
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = most_frequent(counts, frequent)
    is_end = F.col("token") == F.lit(END)
    if all(t != END for t, _ in top):  # the end is known to every task, however rare
        top += [(END, r.n) for r in counts.where(is_end).collect()]
    sizes = {r["class"]: (r.n, r.k) for r in counts.where(~is_end).groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()}
    scorer = TextScorer(top, total, types, [sizes.get(c, (0, 0)) for c in range(SUFFIXES)], vocab)
    trainers = max(1, round(total / train_tokens))
    if total:
        ids = materialize(encoded(texts, spark.sparkContext.broadcast(scorer), trainers), "training-ids")
        rows = ids.repartitionByRange(trainers, "trainer") if trainers > 1 else ids.coalesce(1)
        rows = rows.sortWithinPartitions("trainer", "h", "piece", "ids")
    for k in range(rounds if total else 0):
        start, end = spark.sparkContext.broadcast(scorer.model), scorer.end

        def train(batches: Iterator[pa.RecordBatch], start=start, end=end, k=k) -> Iterator[pa.RecordBatch]:
            at, model = None, None

            def done() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([model.weighted(*met).astype("<f8").tobytes()], pa.binary())], names=["trainer", "p"])

            for b in batches:
                for t, pieces in trainer_runs(b):
                    if t != at:
                        if model:
                            step.flush()
                            yield done()
                        at, model = t, start.value.copy()
                        step = Batches(model.trainer(t * 7919 + k))
                        met = np.zeros(len(model.bias)), np.zeros((CONTEXT, len(model.bias)))
                    ids = np.frombuffer(b"".join(pieces), "<u2").astype(np.int64)
                    before = contexts(ids, np.cumsum([0, *map(len, pieces[:-1])]) // 2, end)
                    step.add(*before, ids)
                    for a, c in ((met[0], ids), (met[1][0], before[0]), (met[1][1], before[1])):
                        a += np.bincount(c, minlength=len(a))
            if model:
                step.flush()
                yield done()

        scorer.model.average(summed(rows.mapInArrow(train, "trainer int, p binary"), trainers))
    if total:
        discard(ids)
    scorer.norms = scorer.model.log_norms()
    return scorer, counts


def trainer_runs(b: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(trainer, pieces) of a batch of `encoded` rows in their order: neighbours of one trainer, about CHUNK tokens at a time."""
    for t, rows in groupby(zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True), key=lambda r: r[0]):
        run, size = [], 0
        for _, x in rows:
            run.append(x)
            size += len(x) // 2
            if size >= CHUNK:
                yield t, run
                run, size = [], 0
        if run:
            yield t, run


class Batches:
    """Hands examples on BATCH at a time, across texts."""

    def __init__(self, step):
        self.step, self.held, self.size = step, [], 0

    def add(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> None:
        self.held.append((c1, c2, w))
        self.size += len(w)
        if self.size >= 64 * BATCH:
            self.run(self.size // BATCH)

    def run(self, batches: int) -> None:
        c1, c2, w = (np.concatenate(x) for x in zip(*self.held, strict=True))
        for at in range(0, batches * BATCH, BATCH):
            self.step(c1[at : at + BATCH], c2[at : at + BATCH], w[at : at + BATCH])
        self.held, self.size = [(c1[batches * BATCH :], c2[batches * BATCH :], w[batches * BATCH :])], len(w[batches * BATCH :])

    def flush(self) -> None:
        if self.size:
            self.run(-(-self.size // BATCH))


def scored(docs: DataFrame, scorer: TextScorer, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every row, in log10.

    Frequent tokens are scored where the text is read.  The others, each few
    times in the corpus, meet their counts in a join; a token that is not in
    the counts has count 0.  A word outside the neural vocabulary has the
    probability of that class times its smoothed share in it.  Null texts are
    empty and have their end only.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, row = shared.value, TaskContext.get().partitionId() << 40
        a, b_ = own.model.tables()
        for batch in batches:
            keys = batch.column(0)
            for first, run_, places, starts in own.runs(batch.column(1).cast(pa.binary()).to_pylist()):
                ids = own.ids(places, run_)
                c1, c2 = contexts(ids, starts, own.end)
                score = (a[c1, ids] + b_[c2, ids] - own.norms[c1, c2]).astype(np.float64) / np.log(10)
                base = np.zeros(len(places))
                listed = places >= 0
                base[listed] = own.base[places[listed]]
                base[places == -2] = own.base_end
                score[listed] += own.share[places[listed]]
                unlisted = places == -1
                score[unlisted] -= own.class_log[ids[unlisted] - own.own]
                sizes = np.diff(np.append(starts, len(places)))
                known = np.add.reduceat(((places >= 0) | ((places == -2) & (own.end_count > 0))).astype(np.int64), starts)
                rows = np.arange(row, row + len(run_))
                row += len(run_)
                n = len(run_)
                yield pa.RecordBatch.from_arrays([pa.array(rows), keys.slice(first, n), pa.nulls(n, pa.binary()), pa.array(sizes), pa.array(known), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(score, starts))], names=names)
                at = np.flatnonzero(places == -1)
                if len(at):
                    text = np.searchsorted(starts, at, side="right") - 1
                    rare = Counter(zip(text.tolist(), unlisted_words(places, run_), strict=True))
                    m = len(rare)
                    of = rows[np.fromiter((k for k, _ in rare), dtype=np.int64, count=m)]
                    yield pa.RecordBatch.from_arrays([pa.array(of), pa.nulls(m, keys.type), pa.array([t for _, t in rare], pa.binary()), pa.array(list(rare.values()), pa.int64()), pa.array(np.zeros(m, np.int64)), pa.array(np.zeros(m)), pa.array(np.zeros(m))], names=names)

    names = ["row", "id", "token", "n", "known", "base", "score"]
    parts = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"row long, id {kind}, token binary, n long, known long, base double, score double"), "lm-parts")
    whole, rare = parts.where("token is null"), parts.where("token is not null")
    c = F.coalesce(F.col("c"), F.lit(0))
    met = rare.select("row", "token", "n").join(counts.select("token", F.col("n").alias("c")), "token", "left")
    more = met.groupBy("row").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("k2"), F.sum(F.col("n") * scorer.base_of(c)).alias("b2"), F.sum(F.col("n") * F.log10(c + 0.5)).alias("s2"))
    out = whole.join(more, "row", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("k2", F.lit(0))).alias("n_known"), (F.col("base") + F.coalesce("b2", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("s2", F.lit(0.0))).alias("score"))
