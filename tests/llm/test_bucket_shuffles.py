"""No written table of the near-duplicate search shuffles all bucket keys twice."""

from stratawell.llm import tensored_minhash


def test_keys_are_made_once_a_table(spark, tiny, monkeypatch):
    made, plans = tensored_minhash.materialize, []

    def watched(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return made(df)

    monkeypatch.setattr(tensored_minhash, "materialize", watched)
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    tensored_minhash.near_duplicates(docs).count()
    counts = [plan.count("Generate posexplode") for plan in plans]
    assert max(counts) == 2 and counts.count(2) == 2
