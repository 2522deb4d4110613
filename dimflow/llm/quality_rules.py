"""Quality rules: rule counts of a text and the log-likelihood ratio of its hashed n-grams.

The ratio compares two multinomials over hashed words and word pairs: one of trusted
target documents, one of the raw corpus. Both counts of an n-gram, the one found in the
target and the one the raw share lets expect there, get the same prior count, so an n-gram
too rare to tell weighs next to nothing, and what remains below NOISE counts as nothing. A
document is thus not rejected for words that no trusted one happens to hold, unless the
corpus has far more of such words than the target's own rare words let expect. The sum is
divided by the number of n-grams, so long and short documents meet the same threshold.

The trusted documents are dealt in two by a hash of their ids: one half is the target, the
other is held out and sets the threshold, so that HELD_OUT_LOSS of it is rejected. Both
are bounded; the raw counts and the verdicts cover every document. Only built-in functions
run; no text is shuffled.

Defined results: a null text counts as empty; an empty text has zero counts, a score of 0
and fails the base rules. Without trusted documents all scores are 0. Repeated rows are
judged one by one, each alike; labels of one doc_id that disagree count as trusted if one
of them is. Columns beyond the text are passed through untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.session import stage_table

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Words in a window of the repetition rule.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: Buckets of the hashed n-grams.
BUCKETS = 1 << 17
#: Count added to what an n-gram has in the target, and to what it should have.
PRIOR = 2.0
#: Weights of less than so many nats either way count as 0.
NOISE = 1.0
#: At most so many trusted documents are fitted on (those with the smallest hashes of their ids).
MAX_TRUSTED = 20_000
#: Weights are whole numbers of 1/UNIT nats, so that sums don't depend on their order.
UNIT = 1000
#: Share of the trusted documents held out from the fit that the threshold rejects.
HELD_OUT_LOSS = 0.03
#: The threshold, in nats an n-gram, is this at most, however well the held-out documents score.
HIGHEST = -0.01


def computed_once(condition: Column) -> Column:
    """The condition as a column that a later filter reads.

    Without the second part, which always holds, the optimizer would put the whole
    expression into the filter and into its lambdas, and compute it for each element.
    """
    return condition & (F.monotonically_increasing_id() >= 0)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _windows(hashes: Column, width: int) -> Column:
    """Hash of each run of `width` words; empty where there are fewer."""
    starts = F.sequence(F.lit(1), F.size(hashes) - F.lit(width - 1))
    return F.when(
        F.size(hashes) >= width, F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, F.lit(width))))
    ).otherwise(F.array().cast("array<bigint>"))


def _found_again(tagged: Column) -> Column:
    """Starts of the windows that equal a neighbour in the sorted array `tagged`, which must be a column."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def again(x: Column, i: Column) -> Column:
        return same(x, F.get(tagged, i - 1)) | same(x, F.get(tagged, i + 1))

    return F.sort_array(F.transform(F.filter(tagged, again), lambda x: x["i"]))


def _covered(at: Column, width: int) -> Column:
    """Words covered by windows of `width` words with the ascending starts `at`, which must be a column."""
    steps = F.transform(at, lambda p, i: F.coalesce(F.least(F.get(at, i + 1) - p, F.lit(width)), F.lit(width)))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")


def rule_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` as the struct `row`, with the word hashes and the counts of the base rules."""
    t = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    df = df.select(F.struct("*").alias("row"))
    df = df.select("row", _word_hashes(t).alias("hashes"))
    df = df.select(
        "row",
        "hashes",
        _windows(F.col("hashes"), WINDOW).alias("windows"),
        _lines(t).alias("lines"),
        F.size("hashes").cast("bigint").alias("n_words"),
        F.length(F.translate(t, SPACE_CHARS, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    kept = ["row", "hashes", "n_words", "word_chars", "n_symbols"]
    tagged = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Each step is a column of its own: inside a lambda an expression would be computed for every element.
    df = df.select(
        *kept,
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), tagged).alias("tagged"),
    )
    df = df.select(*kept, "n_dup_lines", _found_again(F.col("tagged")).alias("at"))
    df = df.select(
        *kept, "n_dup_lines", F.coalesce(_covered(F.col("at"), WINDOW), F.lit(0).cast("bigint")).alias("n_repeat_words")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return df.withColumn("base_failed", failed)


def _features(hashes: Column, buckets: int) -> Column:
    """Buckets of the words and of the pairs of neighbouring words."""
    n = F.size(hashes)
    pairs = F.zip_with(
        F.slice(hashes, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(hashes, F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"),
    )
    return F.concat(F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")), pairs)


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """Ids of documents labelled as good and harmless: a bounded sample by the hash of the id."""
    good = labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
    ids = good.select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _half(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(F.col(doc_id), F.lit("half")), F.lit(2))


def fit_weights(
    docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS
) -> DataFrame:
    """One row per bucket seen: its log-likelihood ratio of target against raw, in 1/UNIT nats.

    `target`, ids of documents, must be bounded (see `trusted_ids`): it is broadcast. The
    raw counts cover every document; each task sends one row per bucket.
    """
    ids = target.select(F.col(target.columns[0]).alias("target_id"))
    rows = docs.select(F.col(doc_id).alias("id"), _word_hashes(F.col(text)).alias("hashes"))
    rows = rows.join(F.broadcast(ids), F.col("id") == F.col("target_id"), "left")
    grams = rows.select(
        F.col("target_id").isNotNull().cast("bigint").alias("target"),
        F.explode(_features(F.col("hashes"), buckets)).alias("bucket"),
    )
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("target").alias("target"))
    counts = stage_table(counts, "grams")  # read twice: for the totals and for the shares
    once = F.count_if(F.col("target") == 1)
    totals = counts.groupBy().agg(F.array(F.sum("raw"), F.sum("target"), once).alias("totals")).scalar()

    def ratio(target: Column, raw: Column) -> Column:
        return F.log((target + PRIOR) / (raw * totals[1] / totals[0] + PRIOR))

    own = ratio(F.col("target"), F.col("raw"))
    # What the target doesn't have and is too rare to tell counts together; the target
    # should have as much of it as it has n-grams that occur once (Good and Turing).
    unseen = (F.col("target") == 0) & (F.abs(own) < NOISE)
    together = ratio(totals[2], counts.filter(unseen).agg(F.sum("raw")).scalar())
    chosen = F.when(unseen, F.coalesce(together, F.lit(0.0))).otherwise(own)
    # Without any target document there is no ratio: all weights are 0.
    weight = F.when((totals[1] > 0) & (F.abs(chosen) >= NOISE), F.round(chosen * UNIT)).otherwise(0.0)
    return counts.select("bucket", weight.cast("bigint").alias("weight"))


@dataclass(frozen=True)
class Fit:
    """Weights by bucket, in 1/UNIT nats, and the threshold of the mean."""

    weights: list[int]
    threshold: float


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS) -> Fit:
    """Weights from one half of the trusted documents, the threshold from the other."""
    trusted = trusted_ids(labels)
    half = _half("doc_id")
    weights = [0] * buckets
    for bucket, weight in fit_weights(docs, trusted.filter(half == 0), text, doc_id, buckets).filter("weight <> 0").collect():
        weights[bucket] = weight
    ids = trusted.filter(half == 1).select(F.col("doc_id").alias("held_id"))
    held = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    held = held.join(F.broadcast(ids), F.col("id") == F.col("held_id"), "left_semi").select("text")
    scores = judge(held, Fit(weights, 0.0)).filter("not base_failed")
    low = scores.agg(F.percentile("score", F.lit(HELD_OUT_LOSS))).first()[0]
    return Fit(weights, HIGHEST if low is None else min(HIGHEST, low))


def judge(df: DataFrame, fitted: Fit, text: str = "text") -> DataFrame:
    """`df` as the struct `row` with rule counts, `score`, `base_failed` and `kept`.

    The weights, one number a bucket at any corpus size, reach the tasks as one
    constant array.
    """
    buckets = len(fitted.weights)
    table = F.split(F.lit(",".join(map(str, fitted.weights))), ",").cast("array<bigint>")
    df = rule_counts(df, text)
    total = F.aggregate(
        _features(F.col("hashes"), buckets), F.lit(0).cast("bigint"), lambda acc, b: acc + F.get(table, b)
    )
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    df = df.withColumn("score", total / grams / UNIT).drop("hashes")
    kept = ~F.col("base_failed") & (F.col("score") >= fitted.threshold)
    # Filters on the result must not be put into the expressions above.
    return df.withColumns({"base_failed": computed_once(F.col("base_failed")), "kept": computed_once(kept)})


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the base rules and the threshold, with their own columns."""
    return judge(docs, fit(docs, labels)).filter("kept").select("row.*")
