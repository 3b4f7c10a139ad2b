"""Statistics of evaluation rows: (model, question, trials, form_ok, control_ok)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values
TOLERANCE, SLACK, CODEC_TRIALS, CI, FAIL_SHARE = 0.05, 1e-9, 20, 1.96, 0.2


def checked(ok: Column, trials: Column) -> Column:
    """The count, or an error where it is no count of so many trials."""
    return F.when((ok < 0) | (ok > trials), F.raise_error(F.lit("successes outside the trials")).cast("long")).otherwise(ok)


def accuracy(rows: DataFrame, ok: str, *keys: str) -> DataFrame:
    """(keys, n, trials, acc, se): ratio and its standard error clustered on the question.

    From sums of k, t, k^2, kt and t^2, so one aggregation does; a single question falls
    back to its binomial error.
    """
    k, t = checked(F.col(ok), F.col("trials")).cast("double"), F.col("trials").cast("double")
    sums = rows.where("trials > 0").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(k).alias("k"), F.sum(t).alias("t"), F.sum(k * k).alias("kk"), F.sum(k * t).alias("kt"), F.sum(t * t).alias("tt"),
    )
    acc = F.col("k") / F.col("t")
    spread = F.greatest(F.lit(0.0), F.col("kk") - 2 * acc * F.col("kt") + acc * acc * F.col("tt"))
    many = F.sqrt(F.col("n") / (F.col("n") - 1) * spread) / F.col("t")
    one = F.sqrt(F.col("t") * acc * (1 - acc)) / F.col("t")
    return sums.select(*keys, "n", F.col("t").cast("long").alias("trials"), acc.alias("acc"), F.when(F.col("n") > 1, many).otherwise(one).alias("se"))


def paired(rows: DataFrame) -> DataFrame:
    """Questions on which both arms answered every trial (rows without attempts always count)."""
    full = (F.coalesce("form_trials", "trials") == F.col("trials")) & (F.coalesce("control_trials", "trials") == F.col("trials"))
    return rows.where(F.col("attempts").isNull() | full)


def gaps(rows: DataFrame, *keys: str) -> DataFrame:
    """Form against control: gap = form - control and its 95% half-width."""
    form, control = (accuracy(rows, c, *keys).select(*keys, F.col("acc").alias(f"{n}_acc"), F.col("se").alias(f"{n}_se")) for c, n in (("form_ok", "form"), ("control_ok", "control")))
    both = form.join(control, list(keys))
    return both.withColumns({"gap": F.col("form_acc") - F.col("control_acc"), "gap_ci": CI * F.sqrt(F.col("form_se") * F.col("form_se") + F.col("control_se") * F.col("control_se"))})


def worst_case(gap_rows: DataFrame) -> DataFrame:
    """The model with the lowest gap and whether it passes."""
    worst = gap_rows.agg(F.min_by(F.struct("model", "gap", "gap_ci", "form_acc", "control_acc"), F.struct("gap", "model")).alias("w")).select("w.*")
    return worst.where("model is not null").withColumn("passed", F.col("gap") >= -TOLERANCE - SLACK)


def codec_verdict(rows: DataFrame, *keys: str) -> DataFrame:
    """UNSAFE on any excess of form misses, SAFE after enough trials without one, else UNRESOLVED."""
    out = rows.groupBy(*keys).agg(F.sum("trials").alias("trials"), F.sum(F.greatest(F.lit(0), F.col("control_ok") - F.col("form_ok"))).alias("excess_misses"))
    return out.withColumn("verdict", F.when(F.col("excess_misses") > 0, "UNSAFE").when(F.col("trials") >= CODEC_TRIALS, "SAFE").otherwise("UNRESOLVED"))


def regressions(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count_if((F.col("control_ok") == F.col("trials")) & (F.col("form_ok") < F.col("trials"))).alias("regressions"))


def ab_sessions(runs: DataFrame) -> DataFrame:
    """Mean, deviation and weighted cost of the runs of each arm: (arm, input, cache_write, cache_read, output)."""
    cost = F.col("input") * 1.0 + F.col("cache_write") * 1.25 + F.col("cache_read") * 0.1 + F.col("output") * 5.0
    rows = runs.withColumn("cost", cost)
    return rows.groupBy("arm").agg(F.count(F.lit(1)).alias("n"), F.avg("cost").alias("mean_cost"), F.stddev_samp("cost").alias("sd_cost"))


def ab_signal(arms: DataFrame) -> DataFrame:
    """Two arms side by side; a signal needs two runs each and a difference above both deviations together."""
    a, b = arms.where("arm = 'a'"), arms.where("arm = 'b'")
    both = a.select(*(F.col(c).alias(f"a_{c}") for c in a.columns)).join(b.select(*(F.col(c).alias(f"b_{c}") for c in b.columns)), F.lit(True))
    delta = F.col("b_mean_cost") - F.col("a_mean_cost")
    clear = (F.col("a_n") >= 2) & (F.col("b_n") >= 2) & (F.abs(delta) > F.col("a_sd_cost") + F.col("b_sd_cost"))
    return both.withColumns({"delta": delta, "signal": F.coalesce(clear, F.lit(False))})


def unmeasured(rows: DataFrame, *keys: str) -> DataFrame:
    """Arms that lost over a fifth of their calls, or have no trials at all."""
    out = rows.groupBy(*keys).agg(F.sum("fails").alias("fails"), F.sum("attempts").alias("attempts"), F.sum("trials").alias("trials"))
    return out.withColumn("unmeasured", (F.coalesce("trials", F.lit(0)) == 0) | (F.try_divide(F.col("fails"), F.col("attempts")) > FAIL_SHARE))


def arm_gaps(rows: DataFrame, forms: list[str], control: str, *keys: str) -> DataFrame:
    """The best of several forms against one control, over the rows that all of them completed, or why not.

    Columns: ``<arm>_ok`` and ``<arm>_trials`` of each arm, trials, attempts, fails.  Excluded are
    groups that lost over a fifth of their calls or a whole arm (unmeasured), and those whose
    control never succeeds (broken control).  Rows without attempts have lost nothing.
    """
    arms = [*forms, control]
    lost = rows.groupBy(*keys).agg(F.sum("attempts").alias("a"), F.sum("fails").alias("f"), *(F.sum(F.coalesce(f"{x}_trials", F.lit(0))).alias(f"t_{x}") for x in arms))
    none = F.lit(False)
    for x in arms:
        none = none | (F.col(f"t_{x}") == 0)
    lost = lost.select(*keys, F.coalesce((F.col("a") > 0) & (none | (F.col("f") / F.col("a") > FAIL_SHARE)), F.lit(False)).alias("unmeasured"))
    whole = F.col("attempts").isNull()
    complete = F.lit(True)
    for x in arms:
        complete = complete & (F.coalesce(f"{x}_trials", "trials") == F.col("trials"))
    kept = rows.where(whole | complete)
    made = lost
    for x in arms:
        own = kept.withColumn("trials", F.coalesce(f"{x}_trials", "trials"))
        made = made.join(accuracy(own, f"{x}_ok", *keys).select(*keys, F.col("n").alias(f"n_{x}"), F.col("acc").alias(f"{x}_acc"), F.col("se").alias(f"{x}_se")), list(keys), "left")
    best = F.sort_array(F.array(*(F.struct(F.coalesce(f"{x}_acc", F.lit(0.0)).alias("acc"), F.lit(-k).alias("order"), F.lit(x).alias("arm"), F.coalesce(f"{x}_se", F.lit(0.0)).alias("se")) for k, x in enumerate(forms))), asc=False)[0]
    made = made.withColumn("best", best)
    broken = F.coalesce(f"{control}_acc", F.lit(0.0)) == 0
    excluded = F.when(F.col("unmeasured"), "unmeasured").when(broken, "broken control")
    out = made.select(*keys, F.coalesce(f"n_{control}", F.lit(0)).alias("n"), F.col("best.arm").alias("arm"), F.col("best.acc").alias("form_acc"), F.col("best.se").alias("form_se"), F.col(f"{control}_acc").alias("control_acc"), F.col(f"{control}_se").alias("control_se"), excluded.alias("excluded"))
    gap, ci = F.col("form_acc") - F.col("control_acc"), CI * F.sqrt(F.col("form_se") * F.col("form_se") + F.col("control_se") * F.col("control_se"))
    return out.withColumns({"gap": F.when(F.col("excluded").isNull(), gap), "gap_ci": F.when(F.col("excluded").isNull(), ci)})


def by_transform(rows: DataFrame, arms: list[str], *keys: str) -> DataFrame:
    """Pooled accuracy of each arm on the questions about each transform."""
    sums = [F.try_divide(F.sum(F.col(f"{x}_ok")) * 1.0, F.sum(F.coalesce(f"{x}_trials", "trials"))).alias(f"{x}_acc") for x in arms]
    return rows.groupBy(*keys, "transform").agg(F.count(F.lit(1)).alias("questions"), *sums)


def bench_totals(measured: DataFrame, column: str = "m") -> DataFrame:
    """Weighted savings over payloads that came back whole; the others are counted and left out."""
    m = lambda name: F.col(f"{column}.{name}")
    lossless = m("roundtrip_ok") & m("embedded_ok")
    total = lambda name: F.sum(F.when(lossless, m(name)))
    pct = lambda a, b: F.try_divide((total(a) - total(b)) * 100.0, total(a))
    return measured.agg(
        F.count_if(lossless).alias("payloads"), F.count_if(~lossless).alias("dropped_lossy"), total("raw_tok").alias("raw"),
        pct("raw_tok", "minified_tok").alias("minified_pct"), pct("raw_tok", "embedded_tok").alias("packed_pct"), pct("minified_tok", "embedded_tok").alias("packed_vs_minified_pct"),
    )
