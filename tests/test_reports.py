import datetime as dt

from starloom.operators import reports


def test_report_orders_and_matrix_shape(spark):
    funnel = spark.createDataFrame([("A", 5, 2), ("B", 9, 3), ("C", 1, 1)],
                                   "feature_name string, total_uses long, unique_users long")
    e1 = reports.feature_avg_uses(funnel).collect()
    assert [r.feature_name for r in e1] == ["B", "A", "C"]
    assert [float(r.avg_uses_per_user) for r in e1] == [3.0, 2.5, 1.0]

    churn = spark.createDataFrame([("high",), ("low",), ("high",)], "churn_risk_category string")
    e2 = reports.churn_distribution(churn).collect()
    assert [(r.churn_risk_category, r.user_count, float(r.percentage)) for r in e2] == [
        ("high", 2, 66.7), ("low", 1, 33.3)]

    ret = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 0, 100.0), (dt.date(2024, 1, 1), 2, 40.0), (dt.date(2024, 2, 1), 0, 100.0),
         (dt.date(2024, 3, 1), None, 0.0)],
        "cohort_month date, months_since_signup long, retention_rate double")
    m = reports.retention_matrix(ret)
    assert m.columns == ["cohort_month", "0", "2"]
    rows = {r.cohort_month: (r["0"], r["2"]) for r in m.collect()}
    assert rows == {dt.date(2024, 1, 1): (100.0, 40.0), dt.date(2024, 2, 1): (100.0, None)}
