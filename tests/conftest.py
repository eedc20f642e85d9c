import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fieldbook.plans import prepare_session, session_builder

    s = (
        session_builder()
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield prepare_session(s)
    s.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate an expression over a column of strings."""
    from pyspark.sql import functions as F

    def run(expr, texts, *more):
        names = ["a", "b", "c", "d", "e", "f"][: 1 + len(more)]
        rows = list(zip(range(len(texts)), texts, *more))
        df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} string" for n in names)).orderBy("i")
        return [r[0] for r in df.select(expr(*[F.col(n) for n in names])).collect()]

    return run
