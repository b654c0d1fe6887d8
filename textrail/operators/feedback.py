"""Feedback analytics: null/blank gates, counts, reports, pairs, lookups,
template weights and degradation checks (P1, P12, A1-A8, J1-J2, J4-J8,
W2-W4, W7, W8).

Scale notes.  Every per-key result here is an aggregate with map-side
partial combination (``count_if``, ``max_by``, ``sum``) or a top-k window
that Spark plans as ``WindowGroupLimit`` (partial limit before the
shuffle).  Answer pairs are plain equi-joins whose skewed keys AQE splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, topic

# --- fixed values ----------------------------------------------------------
NO_FEEDBACK = "No feedback yet."
FEEDBACK_PREFIX = "Feedback: \U0001F44D "
FEEDBACK_SEP = " | \U0001F44E "
NO_ANSWER = "No answer found."
PROBLEM_RATIO = 0.3
TEMPLATE_FLOOR = 0.1
# ---------------------------------------------------------------------------


def drop_blank(df: DataFrame, cols: list[str], min_len: int = 1) -> DataFrame:
    """Drop rows where any column is null, blank, or shorter than
    ``min_len`` characters."""
    df = df.na.drop(subset=cols)
    conds = [(strip(F.col(c)) != "") & (F.length(F.col(c)) >= min_len) for c in cols]
    return df.where(reduce(lambda a, b: a & b, conds))


def require_rows(df: DataFrame, n: int = 5) -> bool:
    """P12 guard: at least ``n`` rows (reads at most ``n`` rows)."""
    return df.limit(n).count() >= n


def rows_guard(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """P12 per key: ``(key, enough)``, whether the key has ``n`` rows."""
    return df.groupBy(key).agg((F.count(F.lit(1)) >= n).alias("enough"))


def md5_bucket(cols: list[Column], buckets: Column | int) -> Column:
    """Deterministic bucket in ``[0, buckets)`` from md5 of the columns
    (the same number in Spark and in SQL engines that have ``md5``)."""
    h = F.conv(F.substring(F.md5(F.concat_ws("\u0001", *[c.cast("string") for c in cols])), 1, 8), 16, 10).cast("bigint")
    b = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(h, b.cast("bigint"))


def preference_pairs(fb: DataFrame, key: str = "query", answer: str = "answer", label: str = "label",
                     good=1, bad=0) -> DataFrame:
    """Every good x bad answer pair of the same query as
    ``(query, answer_preferred, answer_dispreferred)``, duplicates removed.

    Answers repeated within a side are dropped before the join, so the pairs
    need no second de-duplication.  The equi-join is left to AQE, which splits
    a hot query on either side."""
    g = fb.where(F.col(label) == F.lit(good)).select(key, F.col(answer).alias("answer_preferred")).distinct()
    b = fb.where(F.col(label) == F.lit(bad)).select(key, F.col(answer).alias("answer_dispreferred")).distinct()
    return g.join(b, key)


def graded_pairs(fb: DataFrame, key: str = "query", answer: str = "answer", grade: str = "feedback",
                 chosen: str = "good", rejected=("partially correct", "hallucinated", "incorrect")) -> DataFrame:
    """Every ``(query, chosen_answer, rejected_answer)`` of a query's good
    and lower-graded answers; repeated answers give repeated pairs."""
    g = fb.where(F.col(grade) == chosen).select(key, F.col(answer).alias("chosen_answer"))
    b = fb.where(F.col(grade).isin(list(rejected))).select(key, F.col(answer).alias("rejected_answer"))
    return g.join(b, key)


# --- aggregates --------------------------------------------------------------

def feedback_score(fb: DataFrame, queries: DataFrame, key: str = "query", label: str = "feedback") -> DataFrame:
    """A1: good/bad counts per query; ``No feedback yet.`` when absent."""
    counts = fb.groupBy(key).agg(F.count_if(F.col(label) == "good").alias("good"),
                                 F.count_if(F.col(label) == "bad").alias("bad"))
    j = queries.select(key).distinct().join(counts, key, "left")
    msg = F.when(F.col("good").isNull(), F.lit(NO_FEEDBACK)).otherwise(
        F.concat(F.lit(FEEDBACK_PREFIX), F.col("good").cast("string"), F.lit(FEEDBACK_SEP), F.col("bad").cast("string")))
    return j.select(key, F.col("good").cast("bigint").alias("good"), F.col("bad").cast("bigint").alias("bad"),
                    msg.alias("summary"))


def value_share(df: DataFrame, col: str) -> DataFrame:
    """A2: value counts and percentage of the total row count."""
    total = df.count()  # one cheap count job; no single-partition window
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return c.select(col, F.col("n").cast("bigint").alias("n"),
                    (F.lit(100.0) * F.col("n") / F.lit(float(max(total, 1)))).alias("pct"))


def dedupe_first(df: DataFrame, key: str, order: str, cols: list[str]) -> DataFrame:
    """A3: order-preserving de-duplication - the first row per key wins."""
    return df.groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in cols if c != key],
                               F.min(order).alias(order))


def performance_report(fb: DataFrame, label: str = "feedback", rt: str = "response_time",
                       ts: str | None = None) -> DataFrame:
    """A4: totals, good, bad (= not good), success rate, mean response
    time (0 if none) and last event time, as one row."""
    good = F.count_if(F.lower(F.col(label)) == "good")
    total = F.count(F.lit(1))
    mean_rt = F.coalesce(F.avg(rt), F.lit(0.0)) if rt in fb.columns else F.lit(0.0)  # no times: 0
    aggs = [total.cast("bigint").alias("total"), good.cast("bigint").alias("good"),
            (total - good).cast("bigint").alias("bad"),
            (good / F.greatest(total, F.lit(1))).alias("success_rate"),
            mean_rt.alias("avg_response_time")]
    if ts:
        aggs.append(F.max(ts).alias("last_event"))
    return fb.agg(*aggs)


def category_report(fb: DataFrame, query: str = "query", label: str = "feedback") -> DataFrame:
    """A5: per keyword category good / bad / total."""
    good = F.count_if(F.lower(F.col(label)) == "good")
    return (fb.withColumn("category", topic(query)).groupBy("category")
            .agg(good.cast("bigint").alias("good"), (F.count(F.lit(1)) - good).cast("bigint").alias("bad"),
                 F.count(F.lit(1)).cast("bigint").alias("total")))


def problem_categories(fb: DataFrame, limit: float = PROBLEM_RATIO, **kw) -> DataFrame:
    """Categories whose bad share exceeds ``limit``."""
    rep = category_report(fb, **kw)
    ratio = F.when(F.col("total") > 0, F.col("bad") / F.col("total"))
    return rep.withColumn("bad_ratio", ratio).where(F.col("bad_ratio") > limit)


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and binary F1 in one aggregate."""
    tp = F.count_if((F.col(label) == 1) & (F.col(pred) == 1))
    fp = F.count_if((F.col(label) == 0) & (F.col(pred) == 1))
    fn = F.count_if((F.col(label) == 1) & (F.col(pred) == 0))
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == F.col(pred)).alias("correct"),
                 tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    return agg.select(F.when(F.col("n") > 0, F.col("correct") / F.col("n")).alias("accuracy"), prec.alias("precision"),
                      rec.alias("recall"),
                      F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1"))


def pairwise_loss_expr(chosen: str, rejected: str, kind: str = "hinge", margin: float = 0.0,
                       preferred: str | None = None) -> Column:
    """A8 as an aggregate expression: hinge ``mean(max(0, m - (c - r)))`` or
    logistic ``-mean(log sigmoid((r1 - r2) * (2p - 1)))`` (p in {0, 1})."""
    if kind == "hinge":
        return F.avg(F.greatest(F.lit(0.0), F.lit(margin) - (F.col(chosen) - F.col(rejected))))
    sign = (F.lit(2.0) * F.col(preferred) - 1) if preferred else F.lit(1.0)
    x = (F.col(chosen) - F.col(rejected)) * sign
    # -log(sigmoid(x)) = log1p(exp(-x)), computed stably
    return F.avg(F.when(x >= 0, F.log1p(F.exp(-x))).otherwise(-x + F.log1p(F.exp(x))))


def pairwise_loss(df: DataFrame, chosen: str, rejected: str, kind: str = "hinge", margin: float = 0.0,
                  preferred: str | None = None) -> DataFrame:
    """One-row loss table."""
    return df.agg(pairwise_loss_expr(chosen, rejected, kind, margin, preferred).alias("loss"))


# --- lookups -----------------------------------------------------------------

def lookup_last(df: DataFrame, key: str, value: str, order: str, keys: DataFrame,
                default: str = NO_ANSWER) -> DataFrame:
    """Key -> value where the last row (by ``order``) wins; keys without
    a value get ``default``."""
    last = df.groupBy(key).agg(F.max_by(value, order).alias(value))
    return keys.select(key).join(last, key, "left").select(key, F.coalesce(F.col(value), F.lit(default)).alias(value))


def attach_latest(fb: DataFrame, log: DataFrame, keys: list[str], value: str, ts: str,
                  default=0.0, out: str | None = None) -> DataFrame:
    """Attach the value of the latest matching log row (by ``ts``),
    ``default`` when there is none."""
    latest = log.groupBy(*keys).agg(F.max_by(value, ts).alias("_v"))
    return fb.join(latest, keys, "left").withColumn(out or value, F.coalesce(F.col("_v"), F.lit(default))).drop("_v")


def cache_split(requests: DataFrame, cache: DataFrame, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """(hits with their cached row, misses to compute)."""
    hits = requests.join(cache, key, "inner")
    misses = requests.join(cache.select(key), key, "left_anti")
    return hits, misses


def cache_merge(cache: DataFrame, fresh: DataFrame, key: str = "cache_key", answer: str = "answer") -> DataFrame:
    """New cache version = old cache + freshly computed rows (a null
    answer is not cached; a recomputed key replaces the old row)."""
    fresh = fresh.where(F.col(answer).isNotNull())
    return cache.join(fresh.select(key), key, "left_anti").unionByName(fresh.select(*cache.columns))


# --- sampling and splits -------------------------------------------------------

def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Reproducible sample of ``min(n, rows)`` rows: the ``n`` smallest
    md5(seed, key) values (a top-n, planned as a partial limit)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def hash_shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """W2 shuffle: a reproducible permutation - rows sorted by md5(seed,
    key) with a distributed (range-partitioned) sort."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).drop("_h")


def hash_split(df: DataFrame, key: str, weights=(0.8, 0.2), seed: int = 42, out: str = "split") -> DataFrame:
    """Deterministic train/test split by md5 bucket of the key."""
    from ..functions.text import uniform_hash
    u = uniform_hash(F.col(key), seed=seed)
    cut = F.lit(weights[0] / sum(weights))
    return df.withColumn(out, F.when(u < cut, F.lit("train")).otherwise(F.lit("test")))


def last_n(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """Last ``n`` rows per group (a top-n window: partial limit before
    the shuffle, so a hot group is never sorted in one task)."""
    w = Window.partitionBy(by).orderBy(F.col(order).desc())
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def top_k(df: DataFrame, by: str, order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows per group under ``order``."""
    w = Window.partitionBy(by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def degradation(fb: DataFrame, by: str, order: str, bad: Column, n: int = 10, factor: float = 1.5) -> DataFrame:
    """Per group, bad ratio of the last ``n`` rows vs the first ``n``
    rows; flagged when recent > factor x old and the group has more than
    ``2n`` rows.  Both ends are top-n windows."""
    first = Window.partitionBy(by).orderBy(F.col(order).asc())
    last = Window.partitionBy(by).orderBy(F.col(order).desc())
    x = fb.select(by, order, bad.cast("int").alias("_bad"))
    old = (x.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= n)
           .groupBy(by).agg(F.avg("_bad").alias("old_bad_ratio")))
    new = (x.withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= n)
           .groupBy(by).agg(F.avg("_bad").alias("recent_bad_ratio")))
    size = x.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
    j = size.join(old, by).join(new, by)
    return j.withColumn("degraded", (F.col("n_rows") > 2 * n) & (F.col("recent_bad_ratio") > F.col("old_bad_ratio") * factor))


def template_weights(selections: DataFrame, n_templates: int, key: str | None = None, order: str = "ts",
                     choice: str = "template", reward: str = "reward", floor: float = TEMPLATE_FLOOR,
                     tie: str | None = None, partitions: int | None = None) -> DataFrame:
    """Weights start at 1.0, each selection adds its reward to the chosen
    template, a weight never drops below ``floor``; shares are normalised
    by the sum.  Equal times are taken in order of ``tie`` (an event id), then
    of the reward; a null reward counts as 0.

    The clamped update ``w = max(floor, w + r)`` has the closed form
    ``w_T = S_T + max(0, floor - min_j S_j)`` with ``S_j = 1 + r_1 + .. + r_j``.
    It is an associative scan in two passes: selections lie in sorted range
    partitions, each gives a ``(sum, least running sum)`` per template, and
    these few are put one after another.  A template's history, or a busy
    moment of it, spreads over as many partitions as it fills.
    """
    keys = ([key] if key else []) + [choice]
    b = selections.select(*keys, F.col(order).alias("_o"), (F.col(tie) if tie else F.lit(None).cast("long")).alias("_e"),
                          F.coalesce(F.col(reward).cast("double"), F.lit(0.0)).alias("_r"))
    n = partitions or int(selections.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = b.repartitionByRange(n, *keys, "_o", "_e", "_r").withColumn("_p", F.spark_partition_id())
    inside = Window.partitionBy("_p", *keys).orderBy("_o", "_e", "_r").rowsBetween(Window.unboundedPreceding, 0)
    parts = (ranged.withColumn("_s", F.sum("_r").over(inside))
             .groupBy("_p", *keys).agg(F.sum("_r").alias("_sum"), F.min("_s").alias("_least")))  # a template's are at most n
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.lit(1.0) + F.coalesce(F.sum("_sum").over(before), F.lit(0.0))
    folded = (parts.withColumn("_least", begun + F.col("_least"))
              .groupBy(*keys).agg(F.sum("_sum").alias("_sum"), F.min("_least").alias("_least"))
              .select(*keys, (F.lit(1.0) + F.col("_sum") + F.greatest(F.lit(0.0), F.lit(floor) - F.col("_least"))).alias("weight")))
    grid = F.explode(F.sequence(F.lit(0), F.lit(n_templates - 1)))
    if key:
        base = selections.select(key).distinct().select(key, grid.alias(choice))
    else:
        base = selections.sparkSession.range(n_templates).select(F.col("id").cast("int").alias(choice))
    allw = base.join(folded, keys, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    if key:
        return allw.withColumn("share", F.col("weight") / F.sum("weight").over(Window.partitionBy(key)))
    total = allw.agg(F.sum("weight")).collect()[0][0]  # n_templates numbers summed: one scalar
    return allw.withColumn("share", F.col("weight") / F.lit(float(total)))
