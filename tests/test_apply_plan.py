"""Applying a plan works the plan out once."""

from pyspark.sql import functions as F

from tributary.operators import mapping


def test_the_plan_is_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    v = spark.createDataFrame([(x, None, None) for x in "abcd"], "id string, name_en string, description string")
    e = spark.createDataFrame([("1", "a", "c", "t"), ("2", "b", "c", "t")], "id string, source_entity string, target_entity string, type string")
    plan = spark.createDataFrame([("a", "b", "merge")], "orphan string, anchor string, action string")
    v2, e2 = mapping.apply_plan(v, e, plan.mapInArrow(look, plan.schema))
    got = v2.select("id", F.lit("v").alias("kind")).unionByName(e2.select("id", F.lit("e").alias("kind"))).collect()
    assert sorted(tuple(r) for r in got) == [("1", "e"), ("b", "v"), ("c", "v"), ("d", "v")]
    assert seen.value == 1
