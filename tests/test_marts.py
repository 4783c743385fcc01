from pyspark.sql import Row

from layerkit.layout import COMPLAINTS as L
from layerkit.operators import build_marts, mart_by_state, mart_by_year, mart_company, row_counts, to_silver, year_profile
from layerkit.plans import fixtures as fx
from tests.conftest import SF001


SCHEMA = ", ".join(f"{c} string" for c in L.bronze_columns[:-1]) + ", creation_time timestamp"


def rows(spark, data):
    full = [tuple(d.get(c) for c in L.bronze_columns) for d in data]
    return spark.createDataFrame(full, SCHEMA)


def test_null_groups_are_kept(spark):
    df = rows(
        spark,
        [
            {"company": "A", "state": "CA", "date_received": "2020-01-01"},
            {"company": "A", "state": None, "date_received": "bad"},
            {"company": None, "state": "CA", "date_received": None},
        ],
    )
    assert sorted(mart_company(df).collect(), key=str) == sorted([Row(company="A"), Row(company=None)], key=str)
    by_state = {r.state: r["count"] for r in mart_by_state(df).collect()}
    assert by_state == {"CA": 2, None: 1}
    by_year = {r.year: r["count"] for r in mart_by_year(df).collect()}
    assert by_year == {"2020": 1, None: 2}
    assert dict(mart_by_state(df).dtypes)["count"] == "bigint"


def test_mart_order(spark):
    df = rows(spark, [{"state": s, "date_received": d} for s, d in [("A", "2020-01-01"), ("B", "2021-01-01"), ("B", "2019-01-01")]])
    assert [r.state for r in mart_by_state(df).collect()] == ["B", "A"]
    assert [r.year for r in mart_by_year(df).collect()] == ["2021", "2020", "2019"]
    assert [r.complaint_year for r in year_profile(df).collect()] == ["2019", "2020", "2021"]


def test_mart_counts_sum_to_layer_rows(spark):
    bronze = fx.bronze_fixture(spark, SF001)
    silver = to_silver(bronze)
    n_b, n_s = bronze.count(), silver.count()
    for df, n in ((bronze, n_b), (silver, n_s)):
        marts = build_marts(df)
        assert sum(r["count"] for r in marts["summary_by_state"].collect()) == n
        assert sum(r["count"] for r in marts["summary_by_year"].collect()) == n
    counts = {r.layer: r.rows for r in row_counts({"bronze": bronze, "silver": silver}).collect()}
    assert counts == {"bronze": n_b, "silver": n_s}
    assert n_b > n_s
