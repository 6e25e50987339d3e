"""Diffusion arithmetic on schedules of 100 steps and on every finite row of ``motion``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions import diffusion as D
from stridelake.functions import rotations as R
from stridelake.operators import features as X
from stridelake.queries.base import FINITE, Registry, finite_motion
from stridelake.scratch import stored

query = Registry()
STEPS = 100
K = "object_type, motion_id, frame, joint"

_COSINE = """
WITH t0 AS (SELECT CAST(range AS INTEGER) AS t FROM range(100)),
sch AS (SELECT t, least(1 - cos(((t + 1)/100.0 + 0.008)/1.008*pi()/2)**2 / cos((t/100.0 + 0.008)/1.008*pi()/2)**2, 0.999) AS beta FROM t0)"""
_LINEAR = """
WITH sch AS (SELECT CAST(range AS INTEGER) AS t, 0.001 + range*(0.2 - 0.001)/99 AS beta FROM range(100))"""
_COEF = """, b0 AS (SELECT t, CAST(beta AS DOUBLE) AS beta, exp(sum(ln(1 - CAST(beta AS DOUBLE))) OVER (ORDER BY t)) AS bar FROM sch),
b1 AS (SELECT *, coalesce(lag(bar) OVER (ORDER BY t), 1) AS bar_before, coalesce(lead(bar) OVER (ORDER BY t), 0) AS bar_after FROM b0),
b2 AS (SELECT *, beta*(1 - bar_before)/(1 - bar) AS post_var FROM b1),
co AS (SELECT *, ln(CASE WHEN t = 0 THEN lead(post_var) OVER (ORDER BY t) ELSE post_var END) AS post_log_var, beta*sqrt(bar_before)/(1 - bar) AS post_start, (1 - bar_before)*sqrt(1 - beta)/(1 - bar) AS post_noisy FROM b2)"""


@query(_COSINE + _COEF + " SELECT t, round(beta, 9) AS beta, round(bar, 9) AS bar, round(post_var, 9) AS post_var, round(post_log_var, 6) AS post_log_var, round(post_start, 9) AS post_start, round(post_noisy, 9) AS post_noisy FROM co")
def df_coefficients_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coefficients(spark, "cosine")


@query(_LINEAR + _COEF + " SELECT t, round(beta, 9) AS beta, round(bar, 9) AS bar, round(post_var, 9) AS post_var, round(post_log_var, 6) AS post_log_var, round(post_start, 9) AS post_start, round(post_noisy, 9) AS post_noisy FROM co")
def df_coefficients_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coefficients(spark, "linear")


def _coefficients(spark: SparkSession, name: str) -> DataFrame:
    c = D.coefficients(D.betas(spark, name, STEPS))
    return c.select("t", *(F.round(k, 9).alias(k) for k in ("beta", "bar", "post_var")), F.round("post_log_var", 6).alias("post_log_var"), *(F.round(k, 9).alias(k) for k in ("post_start", "post_noisy")))


@query(_LINEAR + _COEF + ", k AS (SELECT * FROM co WHERE t IN (0, 7, 14, 21, 29, 36, 43, 50) OR t % 10 = 9 AND t > 50 OR t = 51) SELECT CAST(row_number() OVER (ORDER BY t) - 1 AS INTEGER) AS t, round(1 - bar/coalesce(lag(bar) OVER (ORDER BY t), 1), 9) AS beta, t AS source FROM k")
def df_respaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule kept at eight steps up to 50, and at 51, 59, 69, 79, 89 and 99."""
    kept = D.kept_steps(51, [8]) + [51, 59, 69, 79, 89, 99]
    return D.respaced(D.betas(spark, "linear", STEPS), kept).withColumn("beta", F.round("beta", 9))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x0 from channel 1, noise from channel 4, another prediction from channel 2, at step (frame + joint) mod 100."""
    m = finite_motion(spark, sf_dir).select(*X.KEYS, *(F.get("f", F.lit(c)).cast("double").alias(n) for c, n in ((1, "x0"), (3, "noise"), (2, "other"))), F.pmod(F.col("frame") + F.col("joint"), F.lit(STEPS)).cast("int").alias("t"))
    return m.join(F.broadcast(D.coefficients(D.betas(spark, "cosine", STEPS))), "t").withColumn("xt", D.noised(F.col("x0"), F.col("noise")))


_ROWS = _COSINE + _COEF + f", {FINITE}, j AS (SELECT {K}, f[2] AS x0, f[4] AS noise, f[3] AS other, co.*, sqrt(bar)*f[2] + sqrt(1 - bar)*f[4] AS xt FROM m JOIN co ON co.t = (frame + joint) % 100)"


@query(_ROWS + f""" SELECT {K}, round(xt, 6) + 0.0 AS xt, round(post_start*x0 + post_noisy*xt, 6) + 0.0 AS mean, round(sqrt(1/bar)*xt - sqrt(1/bar - 1)*other, 5) + 0.0 AS x0_from_noise, round((sqrt(1/bar)*xt - other)/sqrt(1/bar - 1), 5) + 0.0 AS noise_from_x0, round((other - post_noisy*xt)/post_start, 4) + 0.0 AS x0_from_before FROM j""")
def df_forward_and_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _joined(spark, sf_dir)
    xt, other = F.col("xt"), F.col("other")
    out = {"xt": (xt, 6), "mean": (D.posterior_mean(F.col("x0"), xt), 6), "x0_from_noise": (D.start_from_noise(xt, other), 5), "noise_from_x0": (D.noise_from_start(xt, other), 5), "x0_from_before": (D.start_from_before(xt, other), 4)}
    return j.select(*X.KEYS, *((F.round(c, d) + 0.0).alias(k) for k, (c, d) in out.items()))


@query(
    _ROWS
    + f""", e AS (SELECT *, (sqrt(1/bar)*xt - other)/sqrt(1/bar - 1) AS eps, 0.5*sqrt((1 - bar_before)/(1 - bar))*sqrt(1 - bar/bar_before) AS sg FROM j)
SELECT {K}, round(post_start*other + post_noisy*xt + CASE WHEN t = 0 THEN 0 ELSE exp(post_log_var/2) END*noise, 5) + 0.0 AS ancestral, round(sqrt(bar_before)*other + sqrt(1 - bar_before - sg*sg)*eps + CASE WHEN t = 0 THEN 0 ELSE sg END*noise, 5) + 0.0 AS ddim,
round(sqrt(bar_after)*other + sqrt(1 - bar_after)*eps, 5) + 0.0 AS reverse, round(55/24.0*eps - 59/24.0*noise + 37/24.0*x0 - 9/24.0*other, 4) + 0.0 AS multistep FROM e"""
)
def df_sampling_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _joined(spark, sf_dir)
    x0, xt, other, noise = (F.col(c) for c in ("x0", "xt", "other", "noise"))
    out = {"ancestral": (D.ancestral(other, xt, noise), 5), "ddim": (D.ddim(other, xt, noise, 0.5), 5), "reverse": (D.ddim_reverse(other, xt), 5), "multistep": (D.multistep_noise([D.noise_from_start(xt, other), noise, x0, other]), 4)}
    return j.select(*X.KEYS, *((F.round(c, d) + 0.0).alias(k) for k, (c, d) in out.items()))


@query(
    _ROWS
    + f""", v AS (SELECT *, ((0.2 + 1)/2)*ln(beta) + (1 - (0.2 + 1)/2)*post_log_var AS lv, post_start*x0 + post_noisy*xt AS m1, post_start*(0.9*x0) + post_noisy*xt AS m2 FROM j)
SELECT {K}, round(0.5*(-1 + lv - post_log_var + exp(post_log_var - lv) + (m1 - m2)**2*exp(-lv))/ln(2), 4) + 0.0 AS kl_bits FROM v WHERE t > 0"""
)
def df_bound_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of posterior and a model that predicts nine tenths of the start, in bits, with a learned variance."""
    j = _joined(spark, sf_dir).where("t > 0")
    return j.select(*X.KEYS, (F.round(D.bound_term(F.col("x0"), F.col("xt"), F.col("x0") * 0.9, D.learned_log_variance(F.lit(0.2))), 4) + 0.0).alias("kl_bits"))


_CDF = "(0.5*(1 + tanh(sqrt(2/pi())*({0} + 0.044715*({0})**3))))"


@query(
    f"WITH {FINITE}, l AS (SELECT {K}, f[4] AS x, f[5] AS mu FROM m), e AS (SELECT *, "
    + _CDF.format("(exp(1.5)*(x - mu + 1/255.0))") + " AS hi, " + _CDF.format("(exp(1.5)*(x - mu - 1/255.0))") + " AS lo FROM l) "
    + f"SELECT {K}, round(ln(greatest(CASE WHEN x < -0.999 THEN hi WHEN x > 0.999 THEN 1 - lo ELSE hi - lo END, 1e-12)), 4) + 0.0 AS log_likelihood FROM e"
)
def df_discretized_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = finite_motion(spark, sf_dir).select(*X.KEYS, F.get("f", F.lit(3)).cast("double").alias("x"), F.get("f", F.lit(4)).cast("double").alias("mu"))
    return m.select(*X.KEYS, (F.round(D.discretized_log_likelihood(F.col("x"), F.col("mu"), F.lit(-1.5)), 4) + 0.0).alias("log_likelihood"))


@query(f"WITH {FINITE} SELECT object_type, motion_id, round(sum(CASE WHEN joint > 0 THEN (f[1] - f[10])**2 ELSE 0 END) / sum(CASE WHEN joint > 0 THEN 1 ELSE 0 END), 6) + 0.0 AS loss FROM m GROUP BY ALL HAVING count(CASE WHEN joint > 0 THEN 1 END) > 0")
def df_masked_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per clip the masked loss between channels 0 and 9 over all joints but the root."""
    m = finite_motion(spark, sf_dir).select(*X.KEYS, F.get("f", F.lit(0)).cast("double").alias("a"), F.get("f", F.lit(9)).cast("double").alias("b"), (F.col("joint") > 0).cast("int").alias("mask"))
    some = m.where("mask = 1").select(*X.CLIP).distinct()
    return D.masked_l2(m.join(some, X.CLIP, "left_semi"), X.CLIP, "a", "b", "mask").withColumn("loss", F.round("loss", 6) + 0.0)


@query(
    f"""WITH {FINITE}, g AS (SELECT object_type, motion_id, frame, joint, f, lead(frame) OVER w AS nf, lead(f) OVER w AS h FROM m WINDOW w AS (PARTITION BY object_type, motion_id, joint ORDER BY frame)),
p AS (SELECT object_type, motion_id, unnest([1, 2]) AS which, CASE WHEN which = 1 THEN f ELSE h END AS f, frame, joint FROM g WHERE nf = frame + 1),
n AS (SELECT *, sqrt(f[4]**2 + f[5]**2 + f[6]**2) + 1e-8 AS a FROM p), x AS (SELECT *, f[4]/a AS x0, f[5]/a AS x1, f[6]/a AS x2 FROM n), c AS (SELECT *, x1*f[9] - x2*f[8] AS c0, x2*f[7] - x0*f[9] AS c1, x0*f[8] - x1*f[7] AS c2 FROM x),
z AS (SELECT *, sqrt(c0**2 + c1**2 + c2**2) + 1e-8 AS b FROM c), r AS (SELECT object_type, motion_id, which, frame, joint, x0, x1, x2, c0/b AS z0, c1/b AS z1, c2/b AS z2 FROM z), y AS (SELECT *, z1*x2 - z2*x1 AS y0, z2*x0 - z0*x2 AS y1, z0*x1 - z1*x0 AS y2 FROM r)
SELECT a.object_type, a.motion_id, round(avg(acos(greatest(-1 + 1e-6, least(1 - 1e-6, (a.x0*b.x0 + a.x1*b.x1 + a.x2*b.x2 + a.y0*b.y0 + a.y1*b.y1 + a.y2*b.y2 + a.z0*b.z0 + a.z1*b.z1 + a.z2*b.z2 - 1)/2)))), 5) AS loss
FROM y a JOIN y b USING (object_type, motion_id, frame, joint) WHERE a.which = 1 AND b.which = 2 GROUP BY ALL"""
)
def df_geodesic_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per clip the mean angle between the rotations of neighbouring frames."""
    ahead = X._series()
    m = finite_motion(spark, sf_dir).select(*X.KEYS, "f", F.lead("frame").over(ahead).alias("next"), F.lead("f").over(ahead).alias("h")).where("next = frame + 1")
    m = m.select(*X.CLIP, *R.aliased("a", R.sixd_matrix_safe(R.parts("f", 3, 6))), *R.aliased("b", R.sixd_matrix_safe(R.parts("h", 3, 6))))
    return m.groupBy(*X.CLIP).agg(F.round(F.avg(R.geodesic(R.names("a", 9), R.names("b", 9))), 5).alias("loss"))


@query("WITH t AS (SELECT CAST(range AS INTEGER) AS t FROM range(100)) SELECT t, CAST(unnest(range(32)) AS INTEGER) AS place, round(unnest(list_concat(list_transform(range(16), lambda i: cos(t*exp(-ln(10000)*i/16.0))), list_transform(range(16), lambda i: sin(t*exp(-ln(10000)*i/16.0))))), 6) + 0.0 AS value FROM t")
def df_step_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = D.step_embedding(spark.range(STEPS).select(F.col("id").cast("int").alias("t")), "t", 32)
    return e.select("t", F.posexplode("embedding").alias("place", "value")).select("t", "place", (F.round("value", 6) + 0.0).alias("value"))


@query("WITH t AS (SELECT CAST(range AS INTEGER) AS t FROM range(100)) SELECT t, CAST(unnest(range(16)) AS INTEGER) AS place, round(unnest(list_concat(list_transform(range(8), lambda i: cos(t*exp(-ln(10000)*i/7.0))), list_transform(range(8), lambda i: sin(t*exp(-ln(10000)*i/7.0))))), 6) + 0.0 AS value FROM t")
def df_position_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = D.step_embedding(spark.range(STEPS).select(F.col("id").cast("int").alias("t")), "t", 16, last=True)
    return e.select("t", F.posexplode("embedding").alias("place", "value")).select("t", "place", (F.round("value", 6) + 0.0).alias("value"))


@query(
    (_COSINE + _COEF).replace("range(100)", "range(10)").replace("100.0", "10.0").replace("(t + 1)/10.0", "(t + 1)/10.0")
    + f""", steps AS (SELECT product(sqrt(bar_before)*0.8 + sqrt(1 - bar_before)*(1 - sqrt(bar)*0.8)/sqrt(1 - bar)) AS factor FROM co), {FINITE}
SELECT {K}, round(CASE WHEN joint = 0 THEN f[2] ELSE factor*f[4] END, 5) + 0.0 AS x FROM m CROSS JOIN steps"""
)
def df_sampled_inpainting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DDIM sampling over ten steps with a model that predicts eight tenths of its input, the root's heights kept."""
    m = finite_motion(spark, sf_dir).select(*X.KEYS, F.get("f", F.lit(1)).cast("double").alias("known"), F.get("f", F.lit(3)).cast("double").alias("x"))
    keep = lambda x0: F.when(F.col("joint") == 0, F.col("known")).otherwise(x0)
    out = D.sample(m, D.betas(spark, "cosine", 10), lambda rows: rows.withColumn("x0", F.col("x") * 0.8), keep, store=stored)
    return out.select(*X.KEYS, (F.round("x", 5) + 0.0).alias("x"))


@query(
    _ROWS + f""", s AS (SELECT *, least(greatest(sqrt(1/bar)*xt - sqrt(1/bar - 1)*other, -1), 1) AS by_noise, (other - post_noisy*xt)/post_start AS by_before FROM j)
SELECT {K}, t*10.0 AS scaled, round(post_start*by_noise + post_noisy*xt, 5) + 0.0 AS mean_noise, round(post_start*other + post_noisy*xt, 5) + 0.0 AS mean_start, round(other, 5) + 0.0 AS mean_before, round(by_before, 3) + 0.0 AS start_before, round(CASE WHEN t = 0 THEN post_log_var ELSE ln(beta) END, 5) + 0.0 AS large, round(post_log_var, 5) + 0.0 AS small,
round(x0, 5) + 0.0 AS learned, round(0.6*ln(beta) + 0.4*post_log_var, 5) + 0.0 AS ranged, round(x0 + 0.3*other, 5) + 0.0 AS guided, round(noise - sqrt(1 - bar)*other, 5) + 0.0 AS guided_noise, round(0.9*x0 + 0.1*other, 5) + 0.0 AS ema FROM s"""
)
def df_model_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model's output stands for, by each kind of mean and variance; guidance, scaled steps and averaged parameters."""
    j = _joined(spark, sf_dir)
    x0, xt, other, noise = (F.col(c) for c in ("x0", "xt", "other", "noise"))
    out = {
        "scaled": (D.scaled_step(F.col("t"), STEPS), 5), "mean_noise": (D.model_mean("noise", other, xt, clip=True)[0], 5), "mean_start": (D.model_mean("start", other, xt)[0], 5), "mean_before": (D.model_mean("before", other, xt)[0], 5), "start_before": (D.model_mean("before", other, xt)[1], 3),
        "large": (D.model_log_variance("fixed_large"), 5), "small": (D.model_log_variance("fixed_small"), 5), "learned": (D.model_log_variance("learned", x0), 5), "ranged": (D.model_log_variance("learned_range", F.lit(0.2)), 5),
        "guided": (D.guided_mean(x0, F.lit(0.3), other), 5), "guided_noise": (D.guided_noise(noise, other), 5), "ema": (D.ema(x0, other, 0.9), 5),
    }
    return j.select(*X.KEYS, *((F.round(c, d) + 0.0).alias(k) for k, (c, d) in out.items()))


@query("SELECT object_type, motion_id, round(a.loss + 0.1*coalesce(b.loss, 0), 6) AS loss FROM (" + query.oracle["df_masked_l2"] + ") a LEFT JOIN (" + query.oracle["df_geodesic_loss"] + ") b USING (object_type, motion_id)")
def df_training_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per clip the masked loss and a tenth of the geodesic one."""
    both = df_masked_l2(spark, sf_dir).join(df_geodesic_loss(spark, sf_dir).withColumnRenamed("loss", "turn"), X.CLIP, "left")
    return both.select(*X.CLIP, F.round(D.training_loss(F.col("loss"), F.col("turn"), by_geodesic=0.1), 6).alias("loss"))


QUERIES, ORACLE = query.queries, query.oracle
