"""Every registered query against its SQL twin, or at least to its end, over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from matchlake.llm.queries import ORACLE, QUERIES
from parity.compare import normal

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    columns, rows = normal(df.columns, [tuple(r) for r in df.collect()])
    assert rows
    if name in ORACLE:
        con = duckdb.connect()
        for file in Path(SF).glob("*.parquet"):
            con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        cursor = con.execute(ORACLE[name])
        assert (columns, rows) == normal([d[0] for d in cursor.description], cursor.fetchall())


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]
