"""Whitening of vectors by the exact characteristic polynomial of their scatter.

Vectors become whole numbers, so n times their scatter, n * sum(x x') - S S', is a matrix of
integers that tasks sum exactly. Its characteristic polynomial is found modulo primes of 31
bits, each by reduction to Hessenberg form in a task of its own, and put together by Chinese
remaindering; the trace bounds the coefficients, and with them how many primes are needed.

All roots are real and none is negative, so the changes of sign in the coefficients of the
polynomial shifted by a are the number of its roots above a, exactly and with multiplicity.
Halving by that number isolates every root, whatever lies close together; each is then halved
on by the sign alone to hundreds of bits. Components are null vectors of the matrix less a
root, by elimination with full pivoting and inverse iteration in fixed point of as many bits,
one root a task. They become doubles at the end, so they are as exact as doubles are.

The driver sees matrices whose size is the square of the vectors' length and nothing of the
rows.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import table, written
from monsoon.llm.topk import quantized
from monsoon.llm.vectors import EXACT, LONG, padded, whole

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# A component beyond this counts as this, so that sums of products of 2**36 rows fit.
MOST = 2.0**45
# Bits of a root below the trace, and beyond its own leading bit.
ROOT_BITS, RELATIVE_BITS = 200, 60
# Bits below the trace that elimination works with.
WORK_BITS = 320
PRIMES_A_TASK = 8

SUMS = "i int, j int, value decimal(38,0)"


def _scatter(batches):
    """Sums of one task: the count at (-1, -1), sums at (i, -1), products at (i, j), i <= j."""
    from decimal import Decimal

    import numpy as np
    import pyarrow as pa

    n, sums, products = 0, np.zeros(0, dtype=object), np.zeros((0, 0), dtype=object)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            rows = padded(batch.column(0).slice(at, 4096))
            most = np.abs(rows).max(initial=0.0)
            if most * most * max(1, len(rows)) < EXACT:
                new = whole(rows.T @ rows)
                total = whole(rows.sum(axis=0)[None])[0]
            else:
                exact = whole(rows)
                new, total = exact.T @ exact, exact.sum(axis=0)
            width = max(len(sums), rows.shape[1])
            sums = np.concatenate([sums, np.zeros(width - len(sums), dtype=object)])
            more = np.zeros((width, width), dtype=object)
            more[: len(products), : len(products)] = products
            more[: len(new), : len(new)] += new
            products = more
            sums[: len(total)] += total
            n += len(rows)
    out = [(-1, -1, n)] + [(i, -1, s) for i, s in enumerate(sums)]
    out += [(i, j, products[i, j]) for i in range(len(sums)) for j in range(i, len(sums))]
    i, j, value = zip(*out)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(v)) for v in value], pa.decimal128(38, 0))],
        names=["i", "j", "value"],
    )


def scatter(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S, and n * sum(x x') - S S' of the column ``vector`` of whole doubles."""
    found = rows.select("vector").mapInArrow(_scatter, SUMS)
    values = {(r.i, r.j): int(r.value) for r in found.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    n = values.get((-1, -1), 0)
    width = max((i for i, _ in values), default=-1) + 1
    sums = [values[i, -1] for i in range(width)]
    matrix = [
        [n * values[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(width)] for i in range(width)
    ]
    return n, sums, matrix


def primes(bits: int) -> list[int]:
    """The largest primes below 2**31, so many that their product has more than ``bits`` bits."""
    out, product, p = [], 1, (1 << 31) + 1
    while product.bit_length() <= bits + 1:
        p -= 2
        d, r = p - 1, 0
        while d % 2 == 0:
            d, r = d // 2, r + 1
        if all(p % q for q in (3, 5, 7)) and all(
            (x := pow(a, d, p)) in (1, p - 1) or any((x := x * x % p) == p - 1 for _ in range(r - 1))
            for a in (2, 3, 5, 7)
        ):
            out.append(p)
            product *= p
    return out


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo a prime, from the constant one on."""
    import numpy as np

    d = len(matrix)
    h = np.array([[x % p for x in row] for row in matrix], dtype=np.int64).reshape(d, d)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + below[0]
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    leading = np.zeros((d + 1, d + 1), dtype=np.int64)
    leading[0, 0] = 1
    for k in range(1, d + 1):
        new = np.roll(leading[k - 1], 1) - h[k - 1, k - 1] * leading[k - 1] % p
        weights, t = np.zeros(max(0, k - 1), dtype=np.int64), 1
        for i in range(k - 2, -1, -1):
            t = t * int(h[i + 1, i]) % p
            weights[i] = t * int(h[i, k - 1]) % p
        if k > 1:
            new -= (weights[:, None] * leading[: k - 1] % p).sum(axis=0)
        leading[k] = new % p
    return leading[d].tolist()


def _moduli(matrix: list[list[int]], moduli: list[int]):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.column(0).to_pylist()
            found = [polynomial_modulo(matrix, moduli[i]) for i in at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "coefficients"]
            )

    return run


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - matrix), from the constant one on, for a symmetric matrix of
    integers without negative eigenvalues."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # The k-th elementary symmetric function of d numbers that are not negative is at most
    # what it is for d equal numbers of the same sum.
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    moduli = primes(bound.bit_length() + 1)
    tasks = math.ceil(len(moduli) / PRIMES_A_TASK)
    found = spark.range(0, len(moduli), 1, tasks).mapInArrow(
        _moduli(matrix, moduli), "id long, coefficients array<long>"
    )
    residues = {r.id: r.coefficients for r in found.collect()}
    product = math.prod(moduli)
    lifts = [(product // p) * pow(product // p, -1, p) for p in moduli]
    out = [sum(residues[i][k] * lift for i, lift in enumerate(lifts)) % product for k in range(d + 1)]
    return [c - product if 2 * c > product else c for c in out]


def _scaled(poly: list[int], w: int) -> list[int]:
    """A multiple of the polynomial in units of 2**w."""
    d = len(poly) - 1
    return [c << (w * k if w >= 0 else -w * (d - k)) for k, c in enumerate(poly)]


def _above(poly: list[int], v: int, w: int) -> int:
    """How many roots, all of them real, lie above v * 2**w."""
    c = _scaled(poly, w)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += v * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value_sign(poly: list[int], v: int, w: int) -> int:
    d, out = len(poly) - 1, 0
    for k in range(d, -1, -1):
        out = out * v + (poly[k] << (w * k if w >= 0 else -w * (d - k)))
    return (out > 0) - (out < 0)


def largest_roots(poly: list[int], most: int) -> list[tuple[Fraction, int]]:
    """The positive roots of a real-rooted monic polynomial without negative roots, falling,
    with their multiplicities, until ``most`` are found. Roots are right to ROOT_BITS bits
    below their sum and to RELATIVE_BITS of their own; those closer than that count as one."""
    while len(poly) > 1 and not poly[0]:
        poly = poly[1:]
    if len(poly) == 1:
        return []
    top = (-poly[-2]).bit_length()
    out: list[tuple[Fraction, int]] = []
    # Intervals (v, v + 1] in units of 2**w, with the roots above either end; the highest last.
    stack = [(0, top, len(poly) - 1, 0)]
    while stack and sum(n for _, n in out) < most:
        v, w, lower, upper = stack.pop()
        if lower == upper:
            continue
        fine = w <= top - ROOT_BITS and v.bit_length() > RELATIVE_BITS
        if fine:
            out.append((Fraction(2 * v + 1) * Fraction(2) ** (w - 1), lower - upper))
            continue
        middle, w = 2 * v + 1, w - 1
        if lower - upper == 1:
            # The sign above the root, and at it, tells the lower half.
            sign = _value_sign(poly, middle, w)
            at = upper if not sign or (sign > 0) == (upper % 2 == 0) else lower
        else:
            at = _above(poly, middle, w)
        stack.append((2 * v, w, lower, at))
        stack.append((middle, w, at, upper))
    return out


def null_vectors(matrix: list[list[int]], root: Fraction, many: int) -> list[list[float]]:
    """``many`` orthonormal vectors that the matrix multiplies by ``root``, as doubles."""
    import numpy as np

    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    shift = max(64, WORK_BITS - trace.bit_length())
    one = WORK_BITS
    a = np.array([[x << shift for x in row] for row in matrix], dtype=object).reshape(d, d)
    a[np.arange(d), np.arange(d)] -= (root.numerator << shift) // root.denominator
    rows, columns = np.arange(d), np.arange(d)
    factors = np.zeros((d, d), dtype=object)
    for m in range(d - 1):
        at = int(np.abs(a[m:, m:]).argmax())
        i, j = m + at // (d - m), m + at % (d - m)
        for matrix_of, swap in ((a, i), (factors, i)):
            matrix_of[[m, swap]] = matrix_of[[swap, m]]
        rows[[m, i]] = rows[[i, m]]
        a[:, [m, j]] = a[:, [j, m]]
        columns[[m, j]] = columns[[j, m]]
        if not a[m, m]:
            break
        f = (a[m + 1 :, m] << one) // a[m, m]
        factors[m + 1 :, m] = f
        a[m + 1 :, m + 1 :] -= (f[:, None] * a[m, m + 1 :]) >> one
        a[m + 1 :, m] = 0
    rank = d - many
    pivots = [a[i, i] if i < rank or a[i, i] else 1 for i in range(d)]

    def back(right, last):
        x = [0] * d
        for i in range(d - 1, -1, -1):
            if i >= rank and last is not None:
                x[i] = (1 << one) if i == last else 0
                continue
            left = right[i] - (sum(int(a[i, k]) * x[k] for k in range(i + 1, d)) >> one)
            x[i] = (left << one) // pivots[i]
        return x

    found: list[list[int]] = []
    for last in range(rank, d):
        x = back([0] * d, last)
        # One step of inverse iteration, with the factors at hand.
        placed = [0] * d
        for i in range(d):
            placed[columns[i]] = x[i]
        b = [placed[r] for r in rows]
        for i in range(d):
            b[i] -= sum(int(factors[i, k]) * b[k] for k in range(i)) >> one
        y = back(b, None)
        large = max(map(abs, y)).bit_length()
        y = [(v << one) >> large for v in y]
        for other in found:
            dot, norm = sum(p * q for p, q in zip(y, other)), sum(p * p for p in other)
            y = [p - q * dot // norm for p, q in zip(y, other)]
        large = max(map(abs, y)).bit_length()
        found.append([(v << one) >> large for v in y])
    out = []
    for y in found:
        placed = [0] * d
        for i in range(d):
            placed[columns[i]] = y[i]
        norm = math.isqrt(sum(v * v for v in placed))
        sign = 1 if max(placed, key=abs) > 0 else -1
        out.append([sign * v / norm for v in placed])
    return out


def _vectors(matrix: list[list[int]], roots: list[tuple[Fraction, int]]):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.column(0).to_pylist()
            found = [null_vectors(matrix, *roots[i]) for i in at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.list_(pa.float64())))], names=["id", "vectors"]
            )

    return run


def components(
    spark: SparkSession, matrix: list[list[int]], most: int = COMPONENTS
) -> list[tuple[Fraction, list[float]]]:
    """Eigenvalues above zero and unit eigenvectors of the matrix, falling, ``most`` of them."""
    if not any(matrix[i][i] for i in range(len(matrix))):
        return []
    roots = largest_roots(characteristic_polynomial(spark, matrix), most)
    found = spark.range(0, len(roots), 1, len(roots)).mapInArrow(
        _vectors(matrix, roots), "id long, vectors array<array<double>>"
    )
    vectors = {r.id: r.vectors for r in found.collect()}
    return [(root, v) for i, (root, _) in enumerate(roots) for v in vectors[i]][:most]


def _white(n: int, sums: list[int], found: list[tuple[float, list[float]]]):
    """A function from vectors to their deviations (exact, as far as a long goes) and whitened
    coordinates."""

    def run(vectors):
        import numpy as np

        most = np.abs(vectors).max(initial=0.0) * n + max(map(abs, sums))
        if most * most * max(1, len(sums)) < 2.0**62:
            apart = vectors.astype(np.int64) * n - np.array(sums, dtype=np.int64)
            deviation = (apart * apart).sum(axis=1)
        else:
            apart = whole(vectors) * n - np.array(sums, dtype=object)
            deviation = np.array([min(sum(x * x for x in row), LONG) for row in apart], dtype=np.int64)
        axes = np.array([[x / math.sqrt(e) for x in v] for e, v in found]).reshape(len(found), len(sums))
        return deviation, (apart / n).astype(np.float64) @ axes.T

    return run


def _gram(white, width: int):
    """Sums of a task's whitened coordinates at (i, -1) and of their products at (i, j)."""

    def run(batches):
        from decimal import Decimal

        import numpy as np
        import pyarrow as pa

        sums, products = 0.0, 0.0
        for batch in batches:
            found = white(padded(batch.column(0), width))[1]
            sums, products = sums + found.sum(axis=0), products + found.T @ found
        if np.ndim(sums):
            k = len(sums)
            out = [(i, -1, sums[i]) for i in range(k)]
            out += [(i, j, products[i, j]) for i in range(k) for j in range(i, k)]
            i, j, value = zip(*out)
            exact = [Decimal(round(float(v) * 2**40)) for v in value]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(exact, pa.decimal128(38, 0))],
                names=["i", "j", "value"],
            )

    return run


def _rows(white, width: int, shares: list[float]):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        k = len(shares)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                deviation, found = white(padded(part.column(1), width))
                each = pa.array(np.repeat(np.arange(part.num_rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                        pa.array(np.repeat(deviation, k)),
                        pa.array(found.ravel()),
                        pa.array(np.tile(np.array(shares), part.num_rows)),
                    ],
                    names=["vec_id", "component", "deviation", "whitened", "explained"],
                )

    return run


def whitened(
    docs: DataFrame, vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET, most: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error.

    One row per usable vector and component. A vector that is null or has a null or
    non-finite entry takes no part; entries c become floor(scale * c), held within 2**45
    either way, plus the offset; shorter vectors end in zeros. Null and repeated ids and
    repeated rows take part like any other. A component without variance, of which whitening
    would divide by zero, is left out, so vectors that are all equal give no rows, as does
    an empty table. Other columns are ignored. A deviation beyond a long is its limit.
    """
    spark = docs.sparkSession
    held = F.transform(quantized(F.col(vector), scale), lambda x: F.greatest(F.least(x, F.lit(MOST)), F.lit(-MOST)))
    rows = written(docs.select("vec_id", held.alias("vector")).filter("vector IS NOT NULL"), "vectors")
    # The offset moves every row alike and cancels in all that follows.
    n, sums, matrix = scatter(rows)
    found = components(spark, matrix, most) if n else []
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    schema = T.StructType(
        [
            T.StructField("vec_id", rows.schema["vec_id"].dataType),
            *T.StructType.fromDDL("component int, deviation long, whitened double, explained double").fields,
        ]
    )
    if not found:
        out, error = spark.createDataFrame([], schema), 0.0
    else:
        white = _white(n, sums, [(float(e / (n * n)), v) for e, v in found])
        shares = [float(e / trace) for e, _ in found]
        sent = rows.select("vector").mapInArrow(_gram(white, len(sums)), SUMS)
        gram = {
            (r.i, r.j): float(r.value) / 2**40 / n
            for r in sent.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
        }
        # Rows are centred before they are multiplied; what is left of a mean is rounding.
        error = max(
            abs(value - gram[i, -1] * gram[j, -1] - (i == j)) for (i, j), value in gram.items() if j >= 0
        )
        out = rows.select("vec_id", "vector").mapInArrow(_rows(white, len(sums), shares), schema)
    return out.select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).alias("identity_error"),
    )


def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
