"""Rotation algebra over every finite row of ``motion``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions import rotations as R
from stridelake.queries.base import FINITE, Registry, finite_motion

query = Registry()
KEYS = ["object_type", "motion_id", "frame", "joint"]


def _rounded(columns: dict[str, tuple], digits: int = 6) -> list:
    return [(F.round(c, digits) + 0.0).alias(f"{k}{i}" if len(v) > 1 else k) for k, v in columns.items() for i, c in enumerate(v)]


def _quats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two unit quaternions a, b from channels 3-6 and 5-8, and a vector v from channels 0-2; a zero quaternion stays zero."""
    m = finite_motion(spark, sf_dir).select(*KEYS, *R.aliased("g", R.parts("f", 3, 6)), *R.aliased("v", R.parts("f", 0, 3)))
    g = R.names("g", 6)
    return m.select(*KEYS, *R.aliased("a", R.quat_normalize(g[:4])), *R.aliased("b", R.quat_normalize(g[2:])), "v0", "v1", "v2")


_QUATS = f"""
WITH {FINITE},
g AS (SELECT object_type, motion_id, frame, joint, f, coalesce(nullif(sqrt(f[4]*f[4] + f[5]*f[5] + f[6]*f[6] + f[7]*f[7]), 0), 1) AS na, coalesce(nullif(sqrt(f[6]*f[6] + f[7]*f[7] + f[8]*f[8] + f[9]*f[9]), 0), 1) AS nb FROM m),
q AS (SELECT object_type, motion_id, frame, joint, f[4]/na AS a0, f[5]/na AS a1, f[6]/na AS a2, f[7]/na AS a3, f[6]/nb AS b0, f[7]/nb AS b1, f[8]/nb AS b2, f[9]/nb AS b3, f[1] AS v0, f[2] AS v1, f[3] AS v2 FROM g)
"""
_K = "object_type, motion_id, frame, joint"


def _r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name}"


@query(
    _QUATS
    + f"SELECT {_K}, "
    + ", ".join(
        [
            _r("a0*b0 - a1*b1 - a2*b2 - a3*b3", "mul0"), _r("a0*b1 + a1*b0 + a2*b3 - a3*b2", "mul1"), _r("a0*b2 - a1*b3 + a2*b0 + a3*b1", "mul2"), _r("a0*b3 + a1*b2 - a2*b1 + a3*b0", "mul3"),
            _r("(1 - 2*(a2*a2 + a3*a3))*v0 + 2*(a1*a2 - a3*a0)*v1 + 2*(a1*a3 + a2*a0)*v2", "rot0"), _r("2*(a1*a2 + a3*a0)*v0 + (1 - 2*(a1*a1 + a3*a3))*v1 + 2*(a2*a3 - a1*a0)*v2", "rot1"), _r("2*(a1*a3 - a2*a0)*v0 + 2*(a2*a3 + a1*a0)*v1 + (1 - 2*(a1*a1 + a2*a2))*v2", "rot2"),
            _r("CASE WHEN a0 < 0 THEN -a0 ELSE a0 END", "pole0"), _r("CASE WHEN a0 < 0 THEN -a1 ELSE a1 END", "pole1"), _r("-a1", "conj1"),
        ]
    )
    + " FROM q"
)
def rot_quaternion_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, v = (R.names(k, n) for k, n in (("a", 4), ("b", 4), ("v", 3)))
    pole = R.quat_positive(a)
    return _quats(spark, sf_dir).select(*KEYS, *_rounded({"mul": R.quat_multiply(a, b), "rot": R.quat_rotate(a, v), "pole": pole[:2], "conj1": R.quat_conjugate(a)[1:2]}))


@query(
    _QUATS
    + f""", s AS (SELECT *, CASE WHEN a0 < 0 THEN -1.0 ELSE 1.0 END AS p, sqrt(a1*a1 + a2*a2 + a3*a3) AS n FROM q), l AS (SELECT *, p*atan2(n, p*a0)/(n + 1e-10) AS k FROM s)
SELECT {_K}, """
    + ", ".join([_r(f"a{i}*k", f"log{i - 1}") for i in (1, 2, 3)] + [_r("2*acos(greatest(-1, least(1, a0)))", "angle", 5)] + [_r("CASE WHEN n < 1e-9 THEN a1/0.001 ELSE a1/sqrt(greatest(1 - a0*a0, 1e-300)) END", "axis0", 4)] + ["CAST(0 AS DOUBLE) AS back_error"])
    + " FROM l"
)
def rot_log_exp_angle_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log map, exp of the log (the same rotation on its positive pole), and angle with axis."""
    q = _quats(spark, sf_dir)
    a = R.names("a", 4)
    logs = q.select(*KEYS, *R.aliased("l", R.quat_log(a)), *R.aliased("t", R.quat_angle_axis(a)), *R.aliased("p", R.quat_positive(a)))
    error = F.greatest(*(F.abs(x - y) for x, y in zip(R.quat_exp(R.names("l", 3)), R.names("p", 4))))
    return logs.select(*KEYS, *_rounded({"log": R.names("l", 3)}), F.round("t0", 5).alias("angle"), (F.round("t1", 4) + 0.0).alias("axis0"), F.round(error, 5).alias("back_error"))


_MATRIX = """, r AS (SELECT *, 1 - 2*(a2*a2 + a3*a3) AS m0, 2*(a1*a2 - a3*a0) AS m1, 2*(a1*a3 + a2*a0) AS m2, 2*(a1*a2 + a3*a0) AS m3, 1 - 2*(a1*a1 + a3*a3) AS m4, 2*(a2*a3 - a1*a0) AS m5, 2*(a1*a3 - a2*a0) AS m6, 2*(a2*a3 + a1*a0) AS m7, 1 - 2*(a1*a1 + a2*a2) AS m8 FROM q)
"""


@query(
    _QUATS + _MATRIX + f"SELECT {_K}, " + ", ".join([_r(f"m{i}", f"m{i}") for i in range(9)] + [_r(f"m{i}", f"d{k}") for k, i in enumerate((0, 3, 6, 1, 4, 7))] + ["CAST(0 AS DOUBLE) AS back_error"])
    + " FROM r"
)
def rot_matrix_and_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix, 6D form, and the quaternion found again from the matrix."""
    a = R.names("a", 4)
    q = _quats(spark, sf_dir).select(*KEYS, *R.aliased("a", a), *R.aliased("m", R.quat_matrix(a)))
    m = R.names("m", 9)
    q = q.select(*KEYS, *R.aliased("a", a), *R.aliased("m", m), *R.aliased("q", R.matrix_quat(m)))
    error = 1 - F.abs(R.dot(a, R.names("q", 4)))  # q and -q are one rotation
    return q.select(*KEYS, *_rounded({"m": m, "d": R.matrix_6d(m)}), (F.round(error, 5) + 0.0).alias("back_error"))


@query(
    _QUATS + _MATRIX + f"SELECT {_K}, " + ", ".join([_r("atan2(m7, m8)", "xyz0", 4), _r("asin(greatest(-1, least(1, -m6)))", "xyz1", 4), _r("atan2(m3, m0)", "xyz2", 4), _r("atan2(-m1, m0)", "zyx0", 4), _r("asin(greatest(-1, least(1, m2)))", "zyx1", 4), _r("atan2(-m5, m8)", "zyx2", 4)])
    + " FROM r"
)
def rot_euler_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Euler angles: about fixed axes for xyz, about moving axes for zyx (x last)."""
    q = _quats(spark, sf_dir).select(*KEYS, *R.aliased("a", R.names("a", 4)), *R.aliased("m", R.quat_matrix(R.names("a", 4))))
    moving = R.matrix_euler(R.names("m", 9), "XYZ")
    return q.select(*KEYS, *_rounded({"xyz": R.quat_euler(R.names("a", 4), "xyz"), "zyx": moving[::-1]}, 4))


_SLERP = """, d AS (SELECT *, abs(a0*b0 + a1*b1 + a2*b2 + a3*b3) AS c, CASE WHEN a0*b0 + a1*b1 + a2*b2 + a3*b3 < 0 THEN -1.0 ELSE 1.0 END AS s FROM q),
w AS (SELECT *, CASE WHEN 1 - c < 0.01 THEN 0.7 ELSE sin(0.7*acos(least(c, 1)))/sin(acos(least(c, 1))) END AS wa, s*CASE WHEN 1 - c < 0.01 THEN 0.3 ELSE sin(0.3*acos(least(c, 1)))/sin(acos(least(c, 1))) END AS wb FROM d)
"""


@query(_QUATS + _SLERP + f"SELECT {_K}, " + ", ".join([_r(f"wa*a{i} + wb*b{i}", f"mid{i}") for i in range(4)] + [_r("acos(greatest(-1 + 1e-6, least(1 - 1e-6, 2*c*c - 1)))", "geodesic", 5)]) + " FROM w")
def rot_slerp_and_geodesic(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = R.names("a", 4), R.names("b", 4)
    q = _quats(spark, sf_dir)
    angle = R.geodesic(R.quat_matrix(a), R.quat_matrix(b))
    return q.select(*KEYS, *_rounded({"mid": R.quat_slerp(a, b, F.lit(0.3))}), F.round(angle, 5).alias("geodesic"))


_SIXD = f"""
WITH {FINITE},
x AS (SELECT object_type, motion_id, frame, joint, f, sqrt(f[4]*f[4] + f[5]*f[5] + f[6]*f[6]) AS n FROM m),
u AS (SELECT *, f[4]/greatest(n, 1e-8) AS x0, f[5]/greatest(n, 1e-8) AS x1, f[6]/greatest(n, 1e-8) AS x2 FROM x),
z AS (SELECT *, x1*f[9] - x2*f[8] AS z0, x2*f[7] - x0*f[9] AS z1, x0*f[8] - x1*f[7] AS z2 FROM u),
k AS (SELECT *, sqrt(z0*z0 + z1*z1 + z2*z2) AS nz FROM z),
r AS (SELECT object_type, motion_id, frame, joint, f, x0, x1, x2, z0/greatest(nz, 1e-8) AS z0, z1/greatest(nz, 1e-8) AS z1, z2/greatest(nz, 1e-8) AS z2 FROM k)
"""


@query(_SIXD + f"SELECT {_K}, " + ", ".join([_r(e, f"m{i}") for i, e in enumerate(("x0", "z1*x2 - z2*x1", "z0", "x1", "z2*x0 - z0*x2", "z1", "x2", "z0*x1 - z1*x0", "z2"))]) + " FROM r")
def rot_sixd_to_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _sixd(spark, sf_dir)
    return m.select(*KEYS, *_rounded({"m": R.sixd_matrix(R.names("g", 6))}))


def _sixd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finite_motion(spark, sf_dir).select(*KEYS, *R.aliased("g", R.parts("f", 3, 6)))


@query(
    _SIXD.replace("r AS (", "rr AS (").rstrip()
    + f""", h AS (SELECT *, x0*f[7] + x1*f[8] + x2*f[9] AS p FROM rr), o AS (SELECT *, f[7] - p*x0 AS y0, f[8] - p*x1 AS y1, f[9] - p*x2 AS y2 FROM h), y AS (SELECT *, sqrt(y0*y0 + y1*y1 + y2*y2) AS ny FROM o)
SELECT {_K}, """
    + ", ".join([_r(e, f"m{i}") for i, e in enumerate(("x0", "x1", "x2", "y0/ny", "y1/ny", "y2/ny", "(x1*y2 - x2*y1)/ny", "(x2*y0 - x0*y2)/ny", "(x0*y1 - x1*y0)/ny"))])
    + " FROM y"
)
def rot_sixd_rows_to_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sixd(spark, sf_dir).select(*KEYS, *_rounded({"m": R.sixd_rows_matrix(R.names("g", 6))}))


@query(
    f"""WITH {FINITE}, h AS (SELECT a.object_type, a.motion_id, a.frame, a.f[1] - b.f[1] AS ax, a.f[2] - b.f[2] AS ay, a.f[3] - b.f[3] AS az FROM m a JOIN m b USING (object_type, motion_id, frame) WHERE a.joint = 1 AND b.joint = 2),
n AS (SELECT *, sqrt(ax*ax + ay*ay + az*az) AS k FROM h), w AS (SELECT object_type, motion_id, frame, CASE WHEN k > 1e-8 THEN az/k ELSE 0 END AS fx, CASE WHEN k > 1e-8 THEN -ax/k ELSE -1 END AS fz FROM n),
u AS (SELECT *, sqrt(fx*fx + fz*fz) AS k FROM w), p AS (SELECT object_type, motion_id, frame, CASE WHEN k > 1e-8 THEN fx/k ELSE 0 END AS fx, CASE WHEN k > 1e-8 THEN fz/k ELSE 1 END AS fz FROM u)
SELECT object_type, motion_id, frame, round(fx, 6) + 0.0 AS forward0, round(fz, 6) + 0.0 AS forward2, round(cos(-atan2(fx, fz)/2), 6) + 0.0 AS yaw0, round(sin(-atan2(fx, fz)/2), 6) + 0.0 AS yaw2 FROM p"""
)
def rot_facing_yaw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facing of each frame from joints 1 (right) and 2 (left), and the turn that makes it face +Z."""
    m = finite_motion(spark, sf_dir).where("joint in (1, 2)").select("object_type", "motion_id", "frame", "joint", *R.aliased("p", R.parts("f", 0, 3)))
    both = m.groupBy("object_type", "motion_id", "frame").agg(*(F.max(F.when(F.col("joint") == j, F.col(f"p{i}"))).alias(f"{k}{i}") for k, j in (("r", 1), ("l", 2)) for i in range(3)))
    both = both.where("r0 is not null and l0 is not null")
    faced = both.select("object_type", "motion_id", "frame", *R.aliased("w", R.facing_of_hips(R.names("r", 3), R.names("l", 3))))
    yaw = R.yaw_to_face_z(R.names("w", 3))
    return faced.select("object_type", "motion_id", "frame", *[(F.round(c, 6) + 0.0).alias(n) for c, n in ((F.col("w0"), "forward0"), (F.col("w2"), "forward2"), (yaw[0], "yaw0"), (yaw[2], "yaw2"))])


_ANGLES = ", ".join(f"sin({h}) AS s{i}, cos({h}) AS c{i}, sin({h}/2)/(1 + 1e-10) AS hs{i}, cos({h}/2) AS hc{i}" for i, h in enumerate(("v0", "v1", "v2")))


@query(
    _QUATS + f", e AS (SELECT *, {_ANGLES}, sqrt(v0*v0 + v1*v1 + v2*v2) AS n FROM q) SELECT {_K}, "
    + ", ".join(
        [
            _r("cos(v0/2)", "about0"), _r("sin(v0/2)*a1/(sqrt(a1*a1 + a2*a2 + a3*a3) + 1e-10)", "about1"), _r("hc0*hc1*hc2 - hs0*hs1*hs2", "euler0"), _r("hs0*hc1*hc2 + hc0*hs1*hs2", "euler1"), _r("hc0*hc1*hc2 + hs0*hs1*hs2", "world0"), _r("hs0*hc1*hc2 - hc0*hs1*hs2", "world1"),
            _r("cos(n/2)", "vector0"), _r("v1*CASE WHEN n < 1e-6 THEN 0.5 - n*n/48 ELSE sin(n/2)/n END", "vector2"),
            _r("c1*c2", "e0"), _r("-c1*s2", "e1"), _r("s1", "e2"), _r("c0*s2 + s0*s1*c2", "e3"), _r("c0*c2 - s0*s1*s2", "e4"), _r("-s0*c1", "e5"),
            _r("2*atan2(sqrt(a1*a1 + a2*a2 + a3*a3), a0)*CASE WHEN sqrt(a1*a1 + a2*a2 + a3*a3) < 1e-12 THEN 0 ELSE a1/sqrt(a1*a1 + a2*a2 + a3*a3) END", "turn0", 5),
        ]
    ) + " FROM e"
)
def rot_more_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quaternions from angle and axis, from Euler angles (moving and fixed axes) and from a rotation vector; the matrix of Euler angles by its first two rows; and a rotation vector."""
    a, v = R.names("a", 4), R.names("v", 3)
    moving, fixed = R.quat_from_euler(v, "xyz"), R.quat_from_euler(v, "xyz", world=True)
    about, vector = R.quat_from_angle_axis(F.col("v0"), a[1:]), R.axis_angle_quat(v)
    out = {"about0": about[0], "about1": about[1], "euler0": moving[0], "euler1": moving[1], "world0": fixed[0], "world1": fixed[1], "vector0": vector[0], "vector2": vector[2]}
    out |= {f"e{i}": x for i, x in enumerate(R.matrix_6d_rows(R.euler_matrix(v, "XYZ")))}
    turn = R.quat_axis_angle(a)
    return _quats(spark, sf_dir).select(*KEYS, *((F.round(x, 6) + 0.0).alias(k) for k, x in out.items()), (F.round(F.coalesce(turn[0], F.lit(0.0)), 5) + 0.0).alias("turn0"))


@query(
    _QUATS + _MATRIX + f", w AS (SELECT *, v0 + 1 AS u0, v1 + 2 AS u1, v2 + 3 AS u2 FROM r), d AS (SELECT *, a2 AS im, sqrt(a0*a0 + a2*a2) AS len FROM w), k AS (SELECT *, sqrt(u0*u0 + u1*u1 + u2*u2) + u2 AS bb, sqrt((sqrt(u0*u0 + u1*u1 + u2*u2) + u2)**2 + u1*u1 + u0*u0) AS bn FROM d) SELECT {_K}, "
    + ", ".join([_r("-(m0*v0 + m3*v1 + m6*v2)", "rigid0", 5), _r("-(m1*v0 + m4*v1 + m7*v2)", "rigid1", 5), _r("m3", "rigid_m1"), _r("abs(a0)/len", "twist0", 5), _r("bb/bn", "between0", 5), _r("u1/bn", "between1", 5), _r("-u0/bn", "between2", 5), _r("1 - 2*(u0/bn)**2", "matrix0", 5)]) + " FROM k WHERE len > 1e-6"
)
def rot_inverses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undone rigid motions, the twist about Y, and the turn from a vector to +Z as quaternion and matrix; rows whose twist is not defined are left out."""
    a, v = R.names("a", 4), R.names("v", 3)
    rows = _quats(spark, sf_dir).where("sqrt(a0 * a0 + a2 * a2) > 1e-6")
    back, moved = R.rigid_inverse(R.quat_matrix(a), v)
    twist = R.quat_twist(a, (F.lit(0.0), F.lit(1.0), F.lit(0.0)))
    u, z = tuple(v[i] + float(i + 1) for i in range(3)), (F.lit(0.0), F.lit(0.0), F.lit(1.0))
    between, matrix = R.quat_between(u, z), R.rotation_between(u, z)
    out = {"rigid0": (moved[0], 5), "rigid1": (moved[1], 5), "rigid_m1": (back[1], 6), "twist0": (F.abs(twist[0]), 5), "between0": (between[0], 5), "between1": (between[1], 5), "between2": (between[2], 5), "matrix0": (matrix[0], 5)}
    return rows.select(*KEYS, *((F.round(x, d) + 0.0).alias(k) for k, (x, d) in out.items()))


@query(
    _QUATS + f", i AS (SELECT *, 2 + abs(v0) AS s, v1/10 AS h FROM q) SELECT {_K}, " + ", ".join([_r("1/s", "i0", 5), _r("-h/s", "i1", 5), _r("1.0", "i4", 5), _r("0.5", "i8", 5), _r("-(v0/s - h*v1/s)", "t0", 4), _r("-v1", "t1", 5), _r("-v2/2", "t2", 5)]) + " FROM i"
)
def rot_affine_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inverse of a scaled and sheared motion."""
    v, o, one = R.names("v", 3), F.lit(0.0), F.lit(1.0)
    m = (2 + F.abs("v0"), F.col("v1") / 10, o, o, one, o, o, o, F.lit(2.0))
    back, moved = R.affine_inverse(m, v)
    out = {"i0": (back[0], 5), "i1": (back[1], 5), "i4": (back[4], 5), "i8": (back[8], 5), "t0": (moved[0], 4), "t1": (moved[1], 5), "t2": (moved[2], 5)}
    return _quats(spark, sf_dir).select(*KEYS, *((F.round(x, d) + 0.0).alias(k) for k, (x, d) in out.items()))


@query(f"WITH {FINITE} SELECT {_K}, true AS unit, true AS bounded FROM m")
def rot_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random rotations and poses: unit quaternions, and rotation vectors of at most a half turn."""
    m = finite_motion(spark, sf_dir).select(*KEYS, *R.aliased("q", R.random_quaternion(5)), *R.aliased("p", R.random_pose(9)))
    return m.select(*KEYS, (F.abs(R.norm(R.names("q", 4)) - 1) < 1e-9).alias("unit"), (R.norm(R.names("p", 3)) <= 3.1416).alias("bounded"))


QUERIES, ORACLE = query.queries, query.oracle
