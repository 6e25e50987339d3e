import numpy as np

from stridelake.operators import encode as E
from stridelake.sources.bvh import multiply


def unit(rng, *shape):
    q = rng.normal(size=(*shape, 4))
    return q / np.linalg.norm(q, axis=-1, keepdims=True)


def test_rebasing_has_an_inverse():
    rng = np.random.default_rng(4)
    parents = [-1, 0, 1, 1, 0]
    rest, q = unit(rng, 5), unit(rng, 7, 5)
    assert np.allclose(E.unbased(rest, E.rebased(rest, q, parents), parents), q)
    still = np.zeros((5, 4))
    still[:, 0] = 1
    assert np.allclose(E.rebased(still, q, parents), q)


def test_aligned_rest_keeps_positions():
    """Turned offsets with aligned rotations put every joint where it was."""
    rng = np.random.default_rng(5)
    parents, offsets = [-1, 0, 1, 1], rng.normal(size=(4, 3))
    q, align, root = unit(rng, 6, 4), unit(rng), rng.normal(size=(6, 3))
    turned = offsets.copy()
    turned[1:] = offsets[1:] @ E.matrices(align).T
    new = E.aligned_rest(q, align)
    a = E.place(parents, offsets, root, E.matrices(q))
    b = E.place(parents, turned, root, E.matrices(new))
    assert np.allclose(a, b)
    assert np.allclose(np.abs((multiply(new[:, 0], np.broadcast_to(align, new[:, 0].shape)) * q[:, 0]).sum(-1)), 1)


def test_canonical_form():
    rng = np.random.default_rng(6)
    parents, offsets, face = [-1, 0, 0, 1], rng.normal(size=(4, 3)), [1, 2]
    offsets, root, local = E.canonical(parents, offsets, rng.normal(size=(9, 3)), E.matrices(unit(rng, 9, 4)), face, 0.5, [])
    world = E.place(parents, offsets, root, local)
    assert np.allclose(E.forward(world, face)[0], [0, 0, 1]) and np.allclose(root[0, [0, 2]], 0) and abs(world[..., 1].min()) < 1e-12


def test_bad_skeletons_and_short_clips_are_reported(spark):
    t = spark.createDataFrame([("a", [-1, 2, 0], [[0.0] * 3] * 3, [], None, [1, 2]), ("b", [-1, 0, 0], [[0.0, 1.0, 0.0]] * 3, None, [], [1, 2])], "object_type string, parents array<int>, offsets array<array<double>>, foot_joint_idx array<int>, scale_ref_joint_idx array<int>, face array<int>")
    rows = [(o, "m", i, j, [1.0, 0.0, 0.0, 0.0], [0.0] * 3) for o, n in (("a", 3), ("b", 1)) for i in range(n) for j in range(3)]
    raw = spark.createDataFrame(rows, "object_type string, motion_id string, frame int, joint int, q array<double>, pos array<double>")
    assert {(r["object_type"], r["error"]) for r in E.encoded(raw, t).collect()} == {("a", "skeleton"), ("b", "frames")}
