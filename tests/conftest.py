import os
import sys

import numpy as np
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from pyspark.sql import types as T  # noqa: E402

from tidemark import schema as S  # noqa: E402
from tidemark.operators.joins import merge_identity  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF


def make_frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def transactions(spark):
    """60 made-up transactions with every column family."""
    rng = np.random.default_rng(42)
    n = 60

    def holes(values, share):
        return [None if gone else v for v, gone in zip(values, rng.random(n) < share)]

    columns = {
        S.KEY: ("bigint", list(range(1, n + 1))),
        S.TIME: ("bigint", [3600 * i for i in range(1, n + 1)]),
        S.AMOUNT: ("double", rng.uniform(1, 2000, n).tolist()),
        S.LABEL: ("int", [1 if i % 9 == 0 else 0 for i in range(n)]),
        "ProductCD": ("string", rng.choice(list("WHCSR"), n).tolist()),
    }
    for name in ("card1", "card2", "card5", "addr1", "addr2"):
        columns[name] = ("double", rng.uniform(100, 500, n).tolist())
    for name, share in (("card3", 0.1), ("dist1", 0.3), ("dist2", 0.6)):
        columns[name] = ("double", holes(rng.uniform(0, 200, n).tolist(), share))
    columns["card4"] = ("string", holes(rng.choice(["visa", "mastercard", "discover"], n).tolist(), 0.25))
    columns["card6"] = ("string", holes(rng.choice(["credit", "debit", "charge card"], n).tolist(), 0.25))
    columns["P_emaildomain"] = ("string", holes(rng.choice(["gmail.com", "yahoo.com", "hotmail.com"], n).tolist(), 0.1))
    columns["R_emaildomain"] = ("string", holes(rng.choice(["gmail.com", "yahoo.com"], n).tolist(), 0.85))
    for i in range(1, 15):
        columns[f"C{i}"] = ("double", rng.uniform(0, 20, n).tolist())
    for i in range(1, 16):
        columns[f"D{i}"] = ("double", holes(rng.uniform(0, 500, n).tolist(), 0.2))
    for name in S.BINARY_FLAGS:
        columns[name] = ("string", holes(rng.choice(["T", "F"], n).tolist(), 0.33))
    columns["M4"] = ("string", holes(rng.choice(["M0", "M1", "M2"], n).tolist(), 0.25))
    columns["V1"] = ("double", holes(rng.uniform(0, 1, n).tolist(), 0.05))
    columns["V2"] = ("double", rng.uniform(0, 1, n).tolist())
    columns["mostly_missing"] = ("double", [1.0 if i % 20 < 3 else None for i in range(n)])
    columns["rarely_missing"] = ("double", [None if i % 20 < 3 else 1.0 + i % 2 for i in range(n)])
    ddl = ", ".join(f"{name} {kind}" for name, (kind, _) in columns.items())
    rows = list(zip(*[values for _, values in columns.values()]))
    return spark.createDataFrame(rows, ddl).cache()


@pytest.fixture(scope="session")
def identity(spark):
    rng = np.random.default_rng(1)
    rows = [
        (i, ["desktop", "mobile", None][i % 3], ["Windows", "iOS", "MacOS", None][i % 4], float(rng.uniform(-10, 0)), float(rng.uniform(0, 5e5)))
        for i in range(1, 36)
    ]
    return spark.createDataFrame(rows, "TransactionID bigint, DeviceType string, DeviceInfo string, id_01 double, id_02 double").cache()


@pytest.fixture(scope="session")
def merged(transactions, identity):
    return merge_identity(transactions, identity).cache()


@pytest.fixture(scope="session")
def skewed(spark):
    """4,000 scored rows: a third share one score, many share a time, one class is rare."""
    rng = np.random.default_rng(3)
    n = 4_000
    frame = pd.DataFrame({
        "id": rng.permutation(n).astype("int64") * 3 + 1,
        "dt": np.where(rng.random(n) < 0.34, 777, rng.integers(0, 3_000, n)).astype("int64"),
        "score": np.where(rng.random(n) < 0.34, 0.5, np.round(rng.random(n), 3)),
        "y": (rng.random(n) < 0.07).astype("int32"),
        "g": np.where(rng.random(n) < 0.8, "a", "b"),
    })
    path_frame = spark.createDataFrame(frame).repartition(4).cache()
    path_frame.count()
    return path_frame, frame
