"""Rotation algebra as column expressions.

Quaternions are ``(w, x, y, z)``, vectors ``(x, y, z)``, matrices nine columns in row order, 6D rotations six columns.
All are plain tuples of double columns, so every function stays inside whole-stage code generation; put a
``select`` between long compositions to keep expressions small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Columns = tuple[Column, ...]


def parts(column: Column | str, start: int, n: int) -> Columns:
    """n doubles of an array column from a 0-based start."""
    c = F.col(column) if isinstance(column, str) else column
    return tuple(F.get(c, F.lit(start + i)).cast("double") for i in range(n))


def names(prefix: str, n: int) -> Columns:
    return tuple(F.col(f"{prefix}{i}") for i in range(n))


def aliased(prefix: str, columns: Sequence[Column]) -> list[Column]:
    return [c.alias(f"{prefix}{i}") for i, c in enumerate(columns)]


def dot(a: Sequence, b: Sequence) -> Column:
    out = a[0] * b[0]
    for x, y in zip(a[1:], b[1:]):
        out = out + x * y
    return out


def norm(v: Sequence) -> Column:
    return F.sqrt(dot(v, v))


def scale(v: Sequence, k) -> Columns:
    return tuple(x * k for x in v)


def plus(a: Sequence, b: Sequence) -> Columns:
    return tuple(x + y for x, y in zip(a, b))


def minus(a: Sequence, b: Sequence) -> Columns:
    return tuple(x - y for x, y in zip(a, b))


def cross(a: Sequence, b: Sequence) -> Columns:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def pick(condition: Column, yes: Sequence, no: Sequence) -> Columns:
    return tuple(F.when(condition, a).otherwise(b) for a, b in zip(yes, no))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


# quaternions


def quat_multiply(a: Sequence, b: Sequence) -> Columns:
    """Hamilton product a b: b is applied first."""
    vector = plus(plus(scale(b[1:], a[0]), scale(a[1:], b[0])), cross(a[1:], b[1:]))
    return (a[0] * b[0] - dot(a[1:], b[1:]), *vector)


def quat_conjugate(q: Sequence) -> Columns:
    return (q[0], -q[1], -q[2], -q[3])


def quat_normalize(q: Sequence) -> Columns:
    """Unit length; an all-zero quaternion stays as it is."""
    n = norm(q)
    return scale(q, 1 / F.when(n == 0, 1.0).otherwise(n))


def quat_positive(q: Sequence) -> Columns:
    """The one of q and -q whose real part is not negative."""
    return scale(q, F.when(q[0] < 0, -1.0).otherwise(1.0))


def quat_rotate(q: Sequence, v: Sequence) -> Columns:
    """v turned by the unit quaternion q."""
    t = scale(cross(q[1:], v), 2.0)
    return plus(plus(v, scale(t, q[0])), cross(q[1:], t))


def quat_log(q: Sequence) -> Columns:
    """Half the rotation vector of q on its positive pole."""
    p = quat_positive(quat_normalize(q))
    n = norm(p[1:])
    return scale(p[1:], F.atan2(n, p[0]) / (n + 1e-10))


def quat_exp(w: Sequence) -> Columns:
    """The unit quaternion whose log is w; a zero vector uses the angle 0.001."""
    n = norm(w)
    angle = F.when(n == 0, 0.001).otherwise(n)
    return quat_normalize((F.cos(angle), *scale(w, F.sin(angle) / angle)))


def quat_slerp(a: Sequence, b: Sequence, t) -> Columns:
    """Spherical interpolation on the short way; straight where the two differ by less than 0.01 in their cosine."""
    raw = dot(a, b)
    c = F.abs(raw)
    angle = F.acos(F.least(c, F.lit(1.0)))
    straight = (1.0 - c) < 0.01
    sine = F.when(straight, 1.0).otherwise(F.sin(angle))
    first = F.when(straight, 1.0 - t).otherwise(F.sin((1.0 - t) * angle) / sine)
    second = F.when(straight, t).otherwise(F.sin(t * angle) / sine) * F.when(raw < 0, -1.0).otherwise(1.0)
    return plus(scale(a, first), scale(b, second))


def quat_between(u: Sequence, v: Sequence) -> Columns:
    """The shortest rotation that takes u to v."""
    return quat_normalize((F.sqrt(dot(u, u) * dot(v, v)) + dot(u, v), *cross(u, v)))


def quat_from_angle_axis(angle: Column, axis: Sequence) -> Columns:
    k = F.sin(angle / 2) / (norm(axis) + 1e-10)
    return (F.cos(angle / 2), *scale(axis, k))


def quat_angle_axis(q: Sequence) -> Columns:
    """(angle, axis x, y, z) of a quaternion."""
    p = quat_normalize(q)
    s = F.sqrt(F.greatest(1 - p[0] * p[0], F.lit(0.0)))
    return (2 * F.acos(clamp(p[0], -1, 1)), *scale(p[1:], 1 / F.when(s == 0, 0.001).otherwise(s)))


def _about(axis: str, angle: Column) -> Columns:
    half = (F.cos(angle / 2), F.sin(angle / 2) / (1 + 1e-10))
    return (half[0], *(half[1] if axis == k else F.lit(0.0) for k in "xyz"))


def quat_from_euler(angles: Sequence, order: str = "xyz", world: bool = False) -> Columns:
    """Turns about the axes of ``order``; with ``world`` about the fixed axes, the first turn first."""
    a, b, c = (_about(axis, angle) for axis, angle in zip(order, angles))
    return quat_multiply(quat_multiply(c, b), a) if world else quat_multiply(quat_multiply(a, b), c)


def quat_euler(q: Sequence, order: str = "xyz") -> Columns:
    """Euler angles; for ``xyz`` those about fixed axes in that order, for the other orders about moving axes."""
    p = quat_normalize(q)
    m = quat_matrix(p)
    at = {k: i for i, k in enumerate("xyz")}
    e = lambda i, j: m[3 * i + j]
    if order == "xyz":
        return (F.atan2(e(2, 1), e(2, 2)), F.asin(clamp(-e(2, 0), -1, 1)), F.atan2(e(1, 0), e(0, 0)))
    i, j, k = (at[x] for x in order)
    sign = 1.0 if (j - i) % 3 == 1 else -1.0
    return (F.atan2(-sign * e(j, k), e(k, k)), F.asin(clamp(sign * e(i, k), -1, 1)), F.atan2(-sign * e(i, j), e(i, i)))


def quat_twist(q: Sequence, axis: Sequence) -> Columns:
    """The rotation about a unit axis nearest to q."""
    im = dot(axis, q[1:])
    base = -2 * F.atan2(q[0], im)
    top, bottom = (quat_exp(scale(axis, (base + d) / 2)) for d in (3.141592653589793, -3.141592653589793))
    return pick(dot(q, top) > dot(q, bottom), top, bottom)


def axis_angle_quat(v: Sequence) -> Columns:
    """A rotation vector as a quaternion, by a series near 0."""
    n = norm(v)
    k = F.when(n < 1e-6, 0.5 - n * n / 48).otherwise(F.sin(n / 2) / F.when(n == 0, 1.0).otherwise(n))
    return (F.cos(n / 2), *scale(v, k))


def quat_axis_angle(q: Sequence) -> Columns:
    """The rotation vector of a unit quaternion, by a series near 0."""
    n = norm(q[1:])
    angle = 2 * F.atan2(n, q[0])
    k = F.when(F.abs(angle) < 1e-6, 0.5 - angle * angle / 48).otherwise(F.sin(angle / 2) / F.when(angle == 0, 1.0).otherwise(angle))
    return scale(q[1:], 1 / k)


def random_quaternion(seed: int) -> Columns:
    """A uniformly random unit quaternion per row."""
    return quat_normalize(tuple(F.randn(seed + i) for i in range(4)))


# matrices


def quat_matrix(q: Sequence) -> Columns:
    """The matrix of a quaternion of any length; no turn where it is 0."""
    w, x, y, z = q
    n = dot(q, q)
    s = 2.0 / F.when(n == 0, float("inf")).otherwise(n)
    return (1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w), s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w), s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y))


def matrix_quat(m: Sequence) -> Columns:
    """A unit quaternion of a rotation matrix: the largest component is positive, the others take the sign of their off-diagonal pair (none where the pair is equal)."""
    trace = (m[0] + m[4] + m[8] + 1, m[0] - m[4] - m[8] + 1, -m[0] + m[4] - m[8] + 1, -m[0] - m[4] + m[8] + 1)
    size = [F.sqrt(F.greatest(t / 4, F.lit(0.0))) for t in trace]
    sign = {(0, 1): m[7] - m[5], (0, 2): m[2] - m[6], (0, 3): m[3] - m[1], (1, 2): m[3] + m[1], (1, 3): m[2] + m[6], (2, 3): m[7] + m[5]}
    top = F.greatest(*size)
    out = []
    for i in range(4):
        by_case = None
        for lead in (3, 2, 1, 0):  # where several are largest, every one's signs apply: the pairs agree, so the first decides
            value = size[i] if i == lead else size[i] * F.signum(sign[tuple(sorted((i, lead)))])
            by_case = value if by_case is None else F.when(size[lead] == top, value).otherwise(by_case)
        out.append(by_case)
    return tuple(out)


def matrix_multiply(a: Sequence, b: Sequence) -> Columns:
    return tuple(dot(a[3 * i : 3 * i + 3], b[j::3]) for i in range(3) for j in range(3))


def matrix_transpose(m: Sequence) -> Columns:
    return tuple(m[3 * j + i] for i in range(3) for j in range(3))


def matrix_apply(m: Sequence, v: Sequence) -> Columns:
    return tuple(dot(m[3 * i : 3 * i + 3], v) for i in range(3))


def rigid_inverse(m: Sequence, t: Sequence) -> tuple[Columns, Columns]:
    """Rotation and translation that undo x -> m x + t."""
    back = matrix_transpose(m)
    return back, tuple(-x for x in matrix_apply(back, t))


def matrix_6d(m: Sequence) -> Columns:
    """First column, then second column."""
    return (m[0], m[3], m[6], m[1], m[4], m[7])


def matrix_6d_rows(m: Sequence) -> Columns:
    """First row, then second row."""
    return tuple(m[:6])


def _unit(v: Sequence, floor: float) -> Columns:
    return scale(v, 1 / F.greatest(norm(v), F.lit(floor)))


def sixd_matrix(d: Sequence, floor: float = 1e-8) -> Columns:
    """The matrix whose first column is the first half of d and whose second lies in the plane of both halves."""
    x = _unit(d[:3], floor)
    z = _unit(cross(x, d[3:]), floor)
    y = cross(z, x)
    return (x[0], y[0], z[0], x[1], y[1], z[1], x[2], y[2], z[2])


def sixd_matrix_safe(d: Sequence) -> Columns:
    """As ``sixd_matrix``, with missing and non-finite values as 0 and 1e-8 added to each length."""
    clean = tuple(F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x) for x in d)
    x = scale(clean[:3], 1 / (norm(clean[:3]) + 1e-8))
    z = cross(x, clean[3:])
    z = scale(z, 1 / (norm(z) + 1e-8))
    y = cross(z, x)
    return (x[0], y[0], z[0], x[1], y[1], z[1], x[2], y[2], z[2])


def sixd_rows_matrix(d: Sequence) -> Columns:
    """The matrix whose first two rows come from the halves of d by Gram-Schmidt."""
    a = _unit(d[:3], 1e-12)
    b = _unit(minus(d[3:], scale(a, dot(a, d[3:]))), 1e-12)
    return (*a, *b, *cross(a, b))


def matrix_euler(m: Sequence, order: str = "XYZ") -> Columns:
    """Angles of m = R(first) R(second) R(third) about moving axes, for orders of three different axes."""
    at = {k: i for i, k in enumerate("XYZ")}
    i, j, k = (at[x] for x in order)
    s = 1.0 if (j - i) % 3 == 1 else -1.0
    e = lambda r, c: m[3 * r + c]
    return (F.atan2(-s * e(j, k), e(k, k)), F.asin(clamp(s * e(i, k), -1, 1)), F.atan2(-s * e(i, j), e(i, i)))


def euler_matrix(angles: Sequence, order: str = "XYZ") -> Columns:
    out = None
    for axis, angle in zip(order, angles):
        c, s, o, l = F.cos(angle), F.sin(angle), F.lit(0.0), F.lit(1.0)  # noqa: E741
        m = {"X": (l, o, o, o, c, -s, o, s, c), "Y": (c, o, s, o, l, o, -s, o, c), "Z": (c, -s, o, s, c, o, o, o, l)}[axis]
        out = m if out is None else matrix_multiply(out, m)
    return out


def geodesic(a: Sequence, b: Sequence, margin: float = 1e-6) -> Column:
    """The angle between two rotations, its cosine kept ``margin`` away from -1 and 1."""
    return F.acos(clamp((dot(a, b) - 1) / 2, -1 + margin, 1 - margin))


def safe_normalize(v: Sequence, fallback: Sequence = (0.0, 0.0, 1.0), eps: float = 1e-8) -> Columns:
    n = norm(v)
    return tuple(F.when(n > eps, x / F.when(n > eps, n).otherwise(1.0)).otherwise(F.lit(float(f))) for x, f in zip(v, fallback))


def yaw_to_face_z(forward: Sequence) -> Columns:
    """The turn about Y that takes a forward direction to +Z."""
    half = -F.atan2(forward[0], forward[2]) / 2
    return (F.cos(half), F.lit(0.0), F.sin(half), F.lit(0.0))


def facing_of_hips(right_hip: Sequence, left_hip: Sequence, right_shoulder: Sequence | None = None, left_shoulder: Sequence | None = None) -> Columns:
    """Forward direction: across (right minus left) by up."""
    across = minus(right_hip, left_hip)
    if right_shoulder is not None:
        across = plus(across, minus(right_shoulder, left_shoulder))
    across = safe_normalize(across, (1.0, 0.0, 0.0))
    up = (F.lit(0.0), F.lit(1.0), F.lit(0.0))
    return safe_normalize(cross(up, across))


def rotation_between(u: Sequence, v: Sequence) -> Columns:
    """Matrix of the shortest turn between two vectors."""
    return quat_matrix(quat_between(u, v))


def affine_inverse(m: Sequence, t: Sequence) -> tuple[Columns, Columns]:
    """Matrix and translation that undo x -> m x + t, for any invertible m."""
    minor = lambda r, c: m[3 * ((r + 1) % 3) + (c + 1) % 3] * m[3 * ((r + 2) % 3) + (c + 2) % 3] - m[3 * ((r + 1) % 3) + (c + 2) % 3] * m[3 * ((r + 2) % 3) + (c + 1) % 3]
    det = m[0] * minor(0, 0) + m[1] * minor(0, 1) + m[2] * minor(0, 2)
    back = tuple(minor(c, r) / det for r in range(3) for c in range(3))
    return back, tuple(-x for x in matrix_apply(back, t))


def random_pose(seed: int, spread: float = 1.0) -> Columns:
    """A random rotation vector per row: any axis, an angle of normal size (a sixth of a half turn times ``spread``), at most a half turn."""
    axis = tuple(F.randn(seed + i) for i in range(3))
    n = norm(axis)
    angle = clamp(F.randn(seed + 3) * (3.141592653589793 / 6 * spread), -3.141592653589793, 3.141592653589793)
    return scale(axis, angle / F.when(n == 0, 1.0).otherwise(n))
