import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.functions import diffusion as D
from stridelake.functions import rotations as R
from stridelake.functions import strings as T


def mul(a, b):
    w, v, x, u = a[0], a[1:], b[0], b[1:]
    return np.r_[w * x - v @ u, w * u + x * v + np.cross(v, u)]


def matrix(q):
    w, x, y, z = q / np.linalg.norm(q)
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


@pytest.fixture(scope="module")
def quats(spark):
    rng = np.random.default_rng(3)
    q = rng.normal(size=(60, 4))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    p = np.roll(q, 7, axis=0)
    v = rng.normal(size=(60, 3))
    p[5] = q[5]
    v[6] = 0
    df = spark.createDataFrame([(i, *map(float, (*a, *b, *c))) for i, (a, b, c) in enumerate(zip(q, p, v))], ["i", *[f"a{k}" for k in range(4)], *[f"b{k}" for k in range(4)], *[f"v{k}" for k in range(3)]])
    return df, q, p, v


def run(df, columns):
    return np.array([list(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()], float)


A, B, V = (lambda: R.names("a", 4)), (lambda: R.names("b", 4)), (lambda: R.names("v", 3))


def test_products_and_matrices(quats):
    df, q, p, v = quats
    assert np.allclose(run(df, R.quat_multiply(A(), B())), [mul(a, b) for a, b in zip(q, p)])
    assert np.allclose(run(df, R.quat_rotate(A(), V())), [matrix(a) @ x for a, x in zip(q, v)])
    assert np.allclose(run(df, R.quat_matrix(tuple(3 * c for c in A()))), [matrix(a).ravel() for a in q])
    back = run(df.select("i", *R.aliased("m", R.quat_matrix(A()))), R.matrix_quat(R.names("m", 9)))
    assert np.allclose(np.abs((back * q).sum(1)), 1)
    twice = run(df, R.matrix_multiply(R.quat_matrix(A()), R.matrix_transpose(R.quat_matrix(A()))))
    assert np.allclose(twice, np.eye(3).ravel())


def test_log_exp_axis_angle_and_slerp(quats):
    df, q, p, v = quats
    logs = df.select("i", *R.aliased("l", R.quat_log(A())))
    assert np.allclose(np.abs((run(logs, R.quat_exp(R.names("l", 3))) * q).sum(1)), 1, atol=1e-8)
    axis = df.select("i", *R.aliased("x", R.quat_axis_angle(A())))
    assert np.allclose(np.abs((run(axis, R.axis_angle_quat(R.names("x", 3))) * q).sum(1)), 1)
    for t in (0.0, 0.25, 1.0):
        s = run(df, R.quat_slerp(A(), B(), F.lit(t)))
        angle = np.arccos(np.clip(np.abs((q * p).sum(1)), 0, 1))
        assert np.allclose(np.arccos(np.clip(np.abs((s / np.linalg.norm(s, axis=1, keepdims=True) * q).sum(1)), 0, 1)), t * angle, atol=2e-3)
    between = run(df, R.matrix_apply(R.quat_matrix(R.quat_between(V(), (F.lit(0.0), F.lit(1.0), F.lit(0.0)))), V()))
    ok = np.linalg.norm(v, axis=1) > 0
    assert np.allclose(between[ok], np.c_[np.zeros(60), np.linalg.norm(v, axis=1), np.zeros(60)][ok])


@pytest.mark.parametrize("order", ["xyz", "xzy", "yxz", "yzx", "zxy", "zyx"])
def test_euler_round_trip(quats, order):
    df, q, *_ = quats
    angles = df.select("i", *R.aliased("e", R.quat_euler(A(), order)))
    e = R.names("e", 3)
    back = R.quat_from_euler(e, order, world=True) if order == "xyz" else R.quat_from_euler(e, order)
    assert np.allclose(np.abs((run(angles, back) * q).sum(1)), 1, atol=1e-8)
    if order != "xyz":
        m = df.select("i", *R.aliased("m", R.quat_matrix(A()))).select("i", *R.names("m", 9), *R.aliased("e", R.matrix_euler(R.names("m", 9), order.upper())))
        assert np.allclose(run(m, R.euler_matrix(R.names("e", 3), order.upper())), [matrix(a).ravel() for a in q])


def test_sixd_forms(quats):
    df, q, *_ = quats
    m = df.select("i", *R.aliased("m", R.quat_matrix(A())))
    want = np.array([matrix(a).ravel() for a in q])
    six = m.select("i", *R.aliased("d", tuple(2 * c for c in R.matrix_6d(R.names("m", 9)))))
    assert np.allclose(run(six, R.sixd_matrix(R.names("d", 6))), want)
    rows = m.select("i", *R.aliased("d", R.matrix_6d_rows(R.names("m", 9))))
    assert np.allclose(run(rows, R.sixd_rows_matrix(R.names("d", 6))), want)
    assert np.allclose(run(six, R.sixd_matrix_safe(R.names("d", 6))), want, atol=1e-6)
    odd = six.limit(1).select("i", *[F.lit(float("nan")).alias(f"d{k}") for k in range(6)])
    assert np.allclose(run(odd, R.sixd_matrix_safe(R.names("d", 6))), 0)


def test_rigid_twist_and_facing(quats):
    df, q, p, v = quats
    m = R.quat_matrix(A())
    back, t = R.rigid_inverse(m, V())
    point = R.plus(R.matrix_apply(m, V()), V())
    assert np.allclose(run(df, R.plus(R.matrix_apply(back, point), t)), v)
    twist = run(df, R.quat_twist(A(), (F.lit(0.0), F.lit(1.0), F.lit(0.0))))
    assert np.allclose(twist[:, [1, 3]], 0)
    best = np.abs(q[:, 0]) ** 2 + q[:, 2] ** 2
    assert np.allclose((twist * q).sum(1) ** 2, best, atol=1e-6)
    turned = R.quat_rotate(R.yaw_to_face_z(V()), (V()[0], F.lit(0.0), V()[2]))
    assert np.allclose(run(df, turned)[:, 0], 0)
    assert np.allclose(run(df, R.safe_normalize(V()))[6], [0, 0, 1])
    assert np.allclose(np.linalg.norm(run(df, R.random_quaternion(4)), axis=1), 1)


def test_strings(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()[0]
    lit = F.lit
    assert one(T.norm_key(lit("a/b/Red_Wolf-01.npy"))) == "redwolf01" and one(T.norm_key(lit("Red Wolf.01"))) == "redwolf01"
    assert one(T.safe_name(lit(" a@b..c  d__"))) == "a_b_c_d" and one(T.safe_name(lit("@@"))) == "unnamed"
    assert one(T.clean_sentence(lit("  the  wolf runs "))) == "The wolf runs." and one(T.clean_sentence(lit(" "))) is None
    assert one(T.animal_phrase(lit("red_wolf_female"))) == "female red wolf" and one(T.animal_phrase(lit("wolf"))) == "wolf"
    assert tuple(one(T.turn_of(lit("walk_turnl90")))) == ("walk", "left", 90) and tuple(one(T.turn_of(lit("walk")))) == ("walk", None, None)
    assert one(T.without_onspot(lit("turn_onspot"))) == "turn" and one(T.spaced_action(lit("walkFast2x"))) == "walk fast 2 x"
    assert one(T.object_key(lit("red_wolf__walk"))) == "Red_Wolf" and one(T.short_action(lit("Wolf@Walk"), lit("wolf"))) == "Walk"
    assert one(T.raw_stem_of_caption_file(lit("wolf__animationmotionextractedlocomotion.maniset12ab_walk_keypoints.json.txt"))) == "wolf__animationmotionextractedlocomotion_maniset12ab__walk"
    assert one(T.raw_stem_of_caption_file(lit("x.txt"))) is None and tuple(one(T.stem_parts(lit("a__b__c__d")))) == ("a", "b", "c__d")
    assert one(T.joint_words(lit("BN_Finger_R_01"))) == "finger right" and one(T.joint_words(lit("LeftUpLeg2"))) == "left up leg"
    import hashlib

    assert one(T.hash_word(lit("spine"), 1024)) == int(hashlib.sha256(b"spine").hexdigest(), 16) % 1024
    assert one(T.is_float_text(lit(" -1.5 "))) and not one(T.is_float_text(lit("1"))) and one(T.is_number_text(lit("12")))
    assert one(T.light_caption(lit("a  owl  sits , , here."))) == "an owl sits, here"
    assert one(T.length_mask(lit(2), 4)) == [True, True, False, False] and one(T.before_hash(lit("a b # c"))) == "a b"
    assert one(T.article(lit("Owl"))) == "an" and one(T.action_class(lit("walk_turn_left"))) == "walk" and one(T.action_class(lit("slow_trot"))) == "other"
    assert one(T.preview_name(lit(3), lit("x/y.npy"))).startswith("00003_y_")


def test_kept_steps():
    assert D.kept_steps(300, [10, 15, 20])[:2] == [0, 11] and len(D.kept_steps(300, "10,15,20")) == 45
    assert D.kept_steps(100, "ddim25") == list(range(0, 100, 4))
    with pytest.raises(ValueError):
        D.kept_steps(10, [11])


def test_coefficients(spark):
    rows = D.coefficients(D.betas(spark, "linear", 50)).orderBy("t").collect()
    beta = np.linspace(0.002, 0.4, 50)
    bar = np.cumprod(1 - beta)
    assert np.allclose([r["bar"] for r in rows], bar) and np.allclose([r["beta"] for r in rows], beta)
    before = np.r_[1, bar[:-1]]
    assert np.allclose([r["post_var"] for r in rows], beta * (1 - before) / (1 - bar))
    assert math.isclose(rows[0]["post_log_var"], math.log(rows[1]["post_var"]))
