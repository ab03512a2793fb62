from finspark.llm import quality_model as Q


def test_only_features_meet_in_one_task(spark):
    sample = spark.range(0, 40, 1, 4).selectExpr("id", "concat('word ', id) as text", "id % 2 as grade")
    got = Q._gathered(sample)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert got.rdd.getNumPartitions() == 1 and got.count() == 40
    assert "Coalesce" not in plan and plan.index("Exchange SinglePartition") < plan.index("MapInArrow")
