import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapestry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", shuffle_partitions=4, memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Build bars or ticks of one contract from column lists, one row per minute."""
    import datetime as dt

    def build(contract="A", start=dt.datetime(2024, 1, 2, 15, 0), seconds=60, **columns):
        n = len(next(iter(columns.values())))
        names = list(columns)
        columns = {c: [float(x) for x in v] if any(isinstance(x, float) for x in v) else v for c, v in columns.items()}
        rows = [(contract, start + dt.timedelta(seconds=seconds * i), i, *[columns[c][i] for c in names]) for i in range(n)]
        return spark.createDataFrame(rows, ["contract", "ts", "seq", *names])

    return build


def values(df, column, order="ts"):
    return [r[column] for r in df.orderBy(order).select(column).collect()]
