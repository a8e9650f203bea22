import duckdb
import pytest

from chronoweave.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(frame_rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("null" if r[i] is None else f"{r[i]:.6f}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in frame_rows)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    got = df.collect()
    if name not in catalogue.oracle_sql():
        assert got
        return
    want = db.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(got, df.columns) == rows(want.fetchall(), columns)


def test_unwanted_components_stay_out_of_the_shuffle(spark):
    """Rows are made distinct in the columns that the SQL has, without the struct of code components."""
    plan = catalogue.queries()["source_block_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert moved and not any("code_components" in line for line in moved)
