"""Diffusion arithmetic: schedules as small tables (one row per step) and the closed-form steps as column expressions.

A schedule is joined to data on its step number.  Networks are arguments: anything that takes a DataFrame with a noisy
column and returns it with a prediction column.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_BETA = 0.999


def betas(spark: SparkSession, name: str, steps: int, scale: float = 1.0) -> DataFrame:
    """(t, beta) of the ``linear`` schedule, scaled to 1000 steps, or the ``cosine`` one."""
    t = spark.range(steps).select(F.col("id").cast("int").alias("t"))
    if name == "linear":
        k = scale * 1000 / steps
        return t.select("t", (k * 0.0001 + F.col("t") * ((k * 0.02 - k * 0.0001) / max(steps - 1, 1))).alias("beta"))
    if name == "cosine":
        bar = lambda x: F.cos((x + 0.008) / 1.008 * (math.pi / 2)) ** 2
        return betas_of(t, bar, steps)
    raise ValueError(f"no schedule named {name}")


def betas_of(t: DataFrame, bar: Callable[[Column], Column], steps: int, top: float = MAX_BETA) -> DataFrame:
    """betas for a function of the remaining signal on [0, 1]."""
    return t.select("t", F.least(1 - bar((F.col("t") + 1) / F.lit(float(steps))) / bar(F.col("t") / F.lit(float(steps))), F.lit(top)).alias("beta"))


def coefficients(schedule: DataFrame) -> DataFrame:
    """Everything that steps need, per t: products of the kept signal, their roots, and the posterior's mean and variance."""
    order = W.orderBy("t")  # the schedule is a table of at most a few thousand steps
    s = schedule.withColumn("bar", F.exp(F.sum(F.log(1 - F.col("beta"))).over(order.rowsBetween(W.unboundedPreceding, 0))))
    s = s.withColumns({"bar_before": F.coalesce(F.lag("bar").over(order), F.lit(1.0)), "bar_after": F.coalesce(F.lead("bar").over(order), F.lit(0.0))})
    s = s.withColumn("post_var", F.col("beta") * (1 - F.col("bar_before")) / (1 - F.col("bar")))
    floor = F.when(F.col("t") == 0, F.lead("post_var").over(order)).otherwise(F.col("post_var"))
    return s.select(
        "t", "beta", "bar", "bar_before", "bar_after", "post_var", F.log(floor).alias("post_log_var"), F.sqrt("bar").alias("root_bar"), F.sqrt(1 - F.col("bar")).alias("root_rest"), F.log(1 - F.col("bar")).alias("log_rest"),
        F.sqrt(1 / F.col("bar")).alias("root_recip"), F.sqrt(1 / F.col("bar") - 1).alias("root_recip_less"),
        (F.col("beta") * F.sqrt("bar_before") / (1 - F.col("bar"))).alias("post_start"), ((1 - F.col("bar_before")) * F.sqrt(1 - F.col("beta")) / (1 - F.col("bar"))).alias("post_noisy"),
    )


def kept_steps(steps: int, sections: list[int] | str) -> list[int]:
    """Steps kept when each equal section gives a number of evenly spread ones, or a fixed stride (``ddimN``)."""
    if isinstance(sections, str):
        if sections.startswith("ddim"):
            want = int(sections[4:])
            for stride in range(1, steps):
                if -(-steps // stride) == want:
                    return list(range(0, steps, stride))
            raise ValueError(f"no whole stride gives {want} of {steps} steps")
        sections = [int(x) for x in sections.split(",")]
    kept, begin = [], 0
    for i, count in enumerate(sections):
        size = steps // len(sections) + (i < steps % len(sections))
        if size < count:
            raise ValueError(f"{count} steps do not fit in a section of {size}")
        stride = (size - 1) / (count - 1) if count > 1 else 1
        kept += [begin + round(k * stride) for k in range(count)]
        begin += size
    return sorted(set(kept))


def respaced(schedule: DataFrame, kept: list[int]) -> DataFrame:
    """(t, beta, source step) of the schedule restricted to the kept steps."""
    order = W.orderBy("source")
    k = coefficients(schedule).where(F.col("t").isin(kept)).select(F.col("t").alias("source"), "bar")
    return k.select((F.row_number().over(order) - 1).alias("t"), (1 - F.col("bar") / F.coalesce(F.lag("bar").over(order), F.lit(1.0))).alias("beta"), "source")


# steps on joined coefficient columns


def noised(x0: Column, noise: Column) -> Column:
    return F.col("root_bar") * x0 + F.col("root_rest") * noise


def posterior_mean(x0: Column, xt: Column) -> Column:
    return F.col("post_start") * x0 + F.col("post_noisy") * xt


def start_from_noise(xt: Column, eps: Column) -> Column:
    return F.col("root_recip") * xt - F.col("root_recip_less") * eps


def start_from_before(xt: Column, before: Column) -> Column:
    return before / F.col("post_start") - F.col("post_noisy") / F.col("post_start") * xt


def noise_from_start(xt: Column, x0: Column) -> Column:
    return (F.col("root_recip") * xt - x0) / F.col("root_recip_less")


def ancestral(x0: Column, xt: Column, noise: Column) -> Column:
    """x at the step before, with the posterior's variance and no noise at step 0."""
    return posterior_mean(x0, xt) + F.when(F.col("t") == 0, 0.0).otherwise(F.exp(F.col("post_log_var") / 2)) * noise


def ddim(x0: Column, xt: Column, noise: Column, eta: float = 0.0) -> Column:
    eps = noise_from_start(xt, x0)
    sigma = eta * F.sqrt((1 - F.col("bar_before")) / (1 - F.col("bar"))) * F.sqrt(1 - F.col("bar") / F.col("bar_before"))
    return F.sqrt("bar_before") * x0 + F.sqrt(1 - F.col("bar_before") - sigma * sigma) * eps + F.when(F.col("t") == 0, 0.0).otherwise(sigma) * noise


def ddim_reverse(x0: Column, xt: Column) -> Column:
    """x at the step after, without noise."""
    return F.sqrt("bar_after") * x0 + F.sqrt(1 - F.col("bar_after")) * noise_from_start(xt, x0)


def multistep_noise(history: list[Column]) -> Column:
    """Adams-Bashforth mix of up to four noise predictions, newest first."""
    weights = {1: (1.0,), 2: (3 / 2, -1 / 2), 3: (23 / 12, -16 / 12, 5 / 12), 4: (55 / 24, -59 / 24, 37 / 24, -9 / 24)}[len(history)]
    out = history[0] * weights[0]
    for h, w in zip(history[1:], weights[1:]):
        out = out + h * w
    return out


def guided_mean(mean: Column, variance: Column, gradient: Column) -> Column:
    return mean + variance * gradient


def guided_noise(eps: Column, gradient: Column) -> Column:
    return eps - F.col("root_rest") * gradient


def learned_log_variance(fraction: Column) -> Column:
    """Between the posterior's (-1) and the forward step's (1) log variance."""
    part = (fraction + 1) / 2
    return part * F.log("beta") + (1 - part) * F.col("post_log_var")


def normal_kl(mean1: Column, log_var1: Column, mean2: Column, log_var2: Column) -> Column:
    return 0.5 * (-1.0 + log_var2 - log_var1 + F.exp(log_var1 - log_var2) + (mean1 - mean2) ** 2 * F.exp(-log_var2))


def normal_cdf(x: Column) -> Column:
    """The usual tanh approximation."""
    return 0.5 * (1.0 + F.tanh(math.sqrt(2.0 / math.pi) * (x + 0.044715 * x**3)))


def discretized_log_likelihood(x: Column, mean: Column, log_scale: Column) -> Column:
    """Log probability of the 1/255 bin of x, open at -1 and 1."""
    c, k = x - mean, F.exp(-log_scale)
    above, below = normal_cdf(k * (c + 1 / 255)), normal_cdf(k * (c - 1 / 255))
    safe = lambda p: F.log(F.greatest(p, F.lit(1e-12)))
    return F.when(x < -0.999, safe(above)).when(x > 0.999, safe(1 - below)).otherwise(safe(above - below))


def bound_term(x0: Column, xt: Column, predicted_x0: Column, log_var: Column) -> Column:
    """One term of the variational bound in bits: the decoder's at step 0, else the divergence of posterior and model."""
    kl = normal_kl(posterior_mean(x0, xt), F.col("post_log_var"), posterior_mean(predicted_x0, xt), log_var)
    nll = -discretized_log_likelihood(x0, posterior_mean(predicted_x0, xt), 0.5 * log_var)
    return F.when(F.col("t") == 0, nll).otherwise(kl) / math.log(2.0)


def masked_l2(rows: DataFrame, group: list[str], a: str, b: str, mask: str) -> DataFrame:
    """Mean squared difference over the rows where the mask is set."""
    m = F.col(mask).cast("double")
    return rows.groupBy(*group).agg((F.sum((F.col(a) - F.col(b)) ** 2 * m) / F.sum(m)).alias("loss"))


def step_embedding(rows: DataFrame, t: str, dim: int, period: float = 10_000.0, last: bool = False) -> DataFrame:
    """Cosines then sines of t at dim // 2 falling frequencies; ``last`` reaches the period's own frequency (divides by half - 1)."""
    half = dim // 2
    angle = lambda i: F.col(t) * F.exp(-math.log(period) * i / F.lit(float(half - 1 if last else half)))
    places = F.sequence(F.lit(0), F.lit(half - 1))
    value = F.concat(F.transform(places, lambda i: F.cos(angle(i))), F.transform(places, lambda i: F.sin(angle(i))), F.array_repeat(F.lit(0.0), dim % 2))
    return rows.withColumn("embedding", value)


def scaled_step(t: Column, steps: int, scale: bool = True) -> Column:
    """A step on the scale of a thousand steps."""
    return t.cast("double") * (1000.0 / steps) if scale else t.cast("double")


def model_log_variance(kind: str, value: Column | None = None) -> Column:
    """learned: the value itself; learned_range: between posterior and step; fixed_large: of the step, the posterior's first; fixed_small: the posterior's."""
    if kind == "learned":
        return value
    if kind == "learned_range":
        return learned_log_variance(value)
    if kind == "fixed_large":
        return F.when(F.col("t") == 0, F.col("post_log_var")).otherwise(F.log("beta"))
    return F.col("post_log_var")


def model_mean(kind: str, output: Column, xt: Column, clip: bool = False) -> tuple[Column, Column]:
    """(mean, start) that a model's output stands for: the mean before (``before``), the start (``start``) or the noise (``noise``); the start may be kept within -1 and 1."""
    start = {"before": lambda: start_from_before(xt, output), "start": lambda: output, "noise": lambda: start_from_noise(xt, output)}[kind]()
    if clip:
        start = F.least(F.greatest(start, F.lit(-1.0)), F.lit(1.0))
    return (output if kind == "before" else posterior_mean(start, xt)), start


def ema(target: Column, source: Column, rate: float = 0.99) -> Column:
    return target * rate + source * (1 - rate)


def training_loss(simple: Column, geodesic: Column | None = None, sliding: Column | None = None, by_geodesic: float = 0.0, by_sliding: float = 0.0) -> Column:
    """The sum of a clip's loss terms; a term without weight is not asked for, and a missing one counts nothing."""
    out = simple
    for term, weight in ((geodesic, by_geodesic), (sliding, by_sliding)):
        if weight > 0:
            out = out + weight * F.coalesce(term, F.lit(0.0))
    return out


Denoiser = Callable[[DataFrame], DataFrame]


def sample(noise: DataFrame, schedule: DataFrame, model: Denoiser, keep: Callable[[Column], Column] | None = None, store: Callable[[DataFrame, str], DataFrame] | None = None, every: int = 8) -> DataFrame:
    """DDIM sampling of rows with a column ``x`` from the last step to the first; ``model`` adds ``x0`` to rows with ``x`` and ``t``.

    ``keep`` may overwrite known parts of the prediction (in-painting).  Lineage is cut every few steps through ``store``.
    """
    table = coefficients(schedule)
    steps = sorted((r[0] for r in schedule.select("t").collect()), reverse=True)
    columns = noise.columns
    for n, t in enumerate(steps):
        rows = model(noise.withColumn("t", F.lit(t)))
        rows = rows.join(F.broadcast(table), "t")  # one row per step: the schedule is fixed in size
        x0 = keep(F.col("x0")) if keep else F.col("x0")
        noise = rows.withColumn("x", ddim(x0, F.col("x"), F.lit(0.0))).select(*columns)
        if store and n % every == every - 1:
            noise = store(noise, "sample")
    return noise
