"""Rules as a table against the CASE form."""

import random

from pyspark.sql import functions as F

from measlake.functions import instruments
from measlake.operators import rules


def resolved(spark, ids, table, **options):
    df = spark.createDataFrame(list(enumerate(ids)), "n int, id string")
    found = rules.with_rule(df, "id", table, **options).orderBy("n").collect()
    assert [r.n for r in found] == list(range(len(ids)))
    return [r.rule for r in found]


def test_same_as_the_case_form(spark):
    draw = random.Random(3)

    def word(least, most):
        return "".join(draw.choice("abAB-4") for _ in range(draw.randint(least, most)))

    known = tuple(
        instruments.Instrument(word(1, 5), aliases=tuple(word(1, 6) for _ in range(draw.randint(0, 2))))
        for _ in range(12)
    ) + instruments.KNOWN
    ids = [word(0, 7) for _ in range(300)] + ["REF_L", "x-bl4b", "BL-4B", None, "", "zzz"]
    df = spark.createDataFrame(list(enumerate(ids)), "n int, id string")
    wanted = [r.name for r in df.select("n", instruments.resolve(F.col("id"), known).alias("name")).orderBy("n").collect()]
    assert [r.name for r in resolved(spark, ids, rules.table_of(spark, known))] == wanted


def test_defaults_and_the_generic_rule(spark):
    found = resolved(spark, ["REF_L", "other", None], rules.table_of(spark, instruments.KNOWN))
    assert [r.name for r in found] == ["REF_L", "GENERIC", "GENERIC"]
    assert [r.wavelength for r in found] == [6.0, None, None]
    assert found[0].temperature_logs == ["SampleTemp"]
    assert found[1].temperature_logs == list(instruments.GENERIC.temperature_logs)
    assert found[1].facility == "SNS"


def test_nulls_ties_and_repeated_rules(spark):
    table = spark.createDataFrame(
        [
            (None, "last", ["abc"], 1.0),
            (1, "b", ["abc", None, ""], 2.0),
            (1, "a", None, 3.0),
            (1, "a", ["abc"], 4.0),
            (0, None, ["abc"], 5.0),
        ],
        "ord int, name string, aliases array<string>, wavelength double",
    )
    found = resolved(spark, ["abc", "xABCx", "last", "q", None], table, generic={"name": "none"})
    assert [tuple(r) for r in found] == [("a", 3.0), ("a", 3.0), ("last", 1.0), ("none", None), ("none", None)]
    assert [r.name for r in resolved(spark, ["abc"], table.limit(0))] == ["GENERIC"]


def test_many_rules_without_a_nested_loop(spark):
    """100,000 rules that share their prefix: each id meets a handful of them."""
    table = spark.range(100_000).select(
        F.col("id").alias("ord"),
        F.format_string("INSTR_%06d", "id").alias("name"),
        F.array(F.format_string("beam-%06x", F.col("id") * 167)).alias("aliases"),
    )
    ids = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.format_string("run at instr_%06d", F.col("id") * 37))
        .otherwise(F.format_string("BEAM-%06X/2", F.col("id") * 37 * 167)).alias("given"),
        (F.col("id") * 37).alias("wanted"),
    )
    found = rules.with_rule(ids, "given", table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    wrong = found.filter(F.col("rule.name") != F.format_string("INSTR_%06d", "wanted"))
    assert found.count() == 2000 and wrong.count() == 0
    index = rules.index_of(rules.texts_of(table))
    fullest = index.groupBy("gram").count().agg(F.max("count")).first()[0]
    print("texts under the fullest gram:", fullest)


def test_values_by_rule(spark):
    runs = spark.createDataFrame(
        [(1, ["a", "b"], True), (2, ["a", "b"], False), (3, ["c"], None), (4, [], True), (5, None, True)],
        "run int, names array<string>, zero boolean",
    )
    logs = spark.createDataFrame(
        [
            (1, 0, "a", 0.0, 5.0), (1, 1, "a", 7.0, 5.0), (1, 2, "b", float("nan"), 3.0),
            (2, 0, "a", 0.0, 5.0), (2, 1, "b", 1.0, 1.0), (3, 0, "a", 1.0, 1.0), (4, 0, "a", 1.0, 1.0),
        ],
        "run int, row int, log_name string, average_value double, value_numeric double",
    )
    found = rules.values_by_rule(runs, logs, ["run"], F.col("names"), F.col("zero"), ["row"])
    assert {r.run: r.value for r in found.collect()} == {1: 3.0, 2: 0.0}
