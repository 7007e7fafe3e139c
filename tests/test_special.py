"""Distribution tails against ``math.erfc`` and quadrature."""

import math

import numpy as np
from pyspark.sql import functions as F

from strideframe.functions import special


def test_erfc(spark):
    xs = [0.0, 1e-9, 0.1, 0.5, 1.0, 1.9, 1.999999, 2.0, 2.5, 3.0, 5.0, 9.0, 20.0, 26.0, -0.3, -2.5, -6.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", special.erfc(F.col("x")).alias("p"))
    for r in df.collect():
        assert abs(r["p"] - math.erfc(r["x"])) < 1e-10 and abs(r["p"] - math.erfc(r["x"])) <= 1e-9 * math.erfc(r["x"])
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double").select(special.erfc(F.col("x")).alias("p")).collect()
    assert odd[0]["p"] is None and math.isnan(odd[1]["p"])
    chi = spark.createDataFrame([(3.841458820694124,), (0.0,), (100.0,)], "x double").select(special.chi_square_tail(F.col("x")).alias("p")).collect()
    assert abs(chi[0]["p"] - 0.05) < 1e-10 and chi[1]["p"] == 1.0 and abs(chi[2]["p"] / math.erfc(math.sqrt(50)) - 1) < 1e-9


def quadrature(t, dof):
    """Composite Gauss-Legendre over the density from 0 to |t|."""
    nodes, weights = np.polynomial.legendre.leggauss(40)
    edges = np.linspace(0, abs(t), 101)
    mid, half = (edges[1:] + edges[:-1]) / 2, np.diff(edges) / 2
    u = mid[:, None] + half[:, None] * nodes
    z = dof / 2
    if dof < 1e4:
        ratio = math.lgamma(z + 0.5) - math.lgamma(z)
    else:
        ratio = 0.5 * math.log(z) - 1 / (8 * z) + 1 / (192 * z**3)
    area = (np.exp(-(dof + 1) / 2 * np.log1p(u * u / dof)) * weights * half[:, None]).sum()
    return 1 - 2 * area * math.exp(ratio) / math.sqrt(dof * math.pi)


def test_student_tail(spark):
    cases = [(t, d) for t in (0.0, 0.01, 0.5, 1.0, 1.7, 1.8, 2.5, -3.0, 4.0, 6.0) for d in (1.0, 2.5, 7.0, 30.0, 999.5, 1e5, 1e7, 1e9)]
    df = spark.createDataFrame(cases, "t double, d double").select("t", "d", special.student_two_sided(F.col("t"), F.col("d")).alias("p"))
    for r in df.collect():
        assert abs(r["p"] - quadrature(r["t"], r["d"])) < 1e-10, r
    # known values: the Cauchy distribution, and 5 % at 10 degrees of freedom
    known = spark.createDataFrame([(1.0, 1.0), (2.2281388519649385, 10.0)], "t double, d double")
    got = [r[0] for r in known.select(special.student_two_sided(F.col("t"), F.col("d"))).collect()]
    assert abs(got[0] - 0.5) < 1e-12 and abs(got[1] - 0.05) < 1e-10
