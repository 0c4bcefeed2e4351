"""What the daily suites read is shaped without work that is done twice or row by row in the interpreter."""

from stratawell.registry.clean import clean
from stratawell.registry.fixtures import trajectory_documents


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_days_are_parsed_before_the_shuffle_only(spark, tiny):
    above = optimized(clean(spark, tiny)).split("Window [")[0]
    assert "gettimestamp" not in above and "_day" in above


def test_documents_are_compiled(spark, tiny):
    docs = trajectory_documents(spark, tiny)
    assert "transform(" not in optimized(docs)
    sizes = docs.selectExpr("size(trajectoryStation) AS n", "trajectoryStation[size(trajectoryStation) - 1]._uid AS last").collect()
    assert {r.n for r in sizes} == {1, 2, 3} and all(r.last.endswith(f"-{r.n}") for r in sizes)
