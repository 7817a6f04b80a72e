"""Windows of decontamination are hashed in compiled code."""

from pyspark.sql import functions as F

from inkmill.llm import decontaminate


def test_windows_are_hashed_outside_lambdas(spark):
    text = "Anna met 12 kg of Bob and 3 4 5 6 7 kg there. Then Carl said it is done by 20 percent"
    formed = decontaminate._formed(spark.createDataFrame([("k", text), ("short", "two words")], "_key string, _text string"))
    tokens = formed.select("_key", "_l", "_f", "_o", "_t", "_q", "_names", "_starts").filter("_key = 'k'").first()
    windows = decontaminate._window_rows(formed.drop("_text", "_v"), 8)
    made = windows._jdf.queryExecution().optimizedPlan().toString()
    assert "inline(" not in made and "lambdafunction(named_struct(dpos" not in made
    n, want = len(tokens["_t"]), []
    over = lambda places, least=1: [i for i in range(n - 7) if sum(i <= p < i + 8 for p in places) >= least]
    for name, starts in (("_f", range(n - 7)), ("_o", over(tokens["_names"])), ("_t", over(tokens["_starts"])), ("_l", over(tokens["_q"], 5))):
        want += [(i, tuple(tokens[name][i:i + 8])) for i in starts]
    hashed = spark.createDataFrame(want, "i int, w struct<" + ",".join(f"_{k}:long" for k in range(8)) + ">")
    hashed = hashed.select(F.lit("k"), "i", F.xxhash64(*[F.col(f"w._{k}") for k in range(8)], F.lit(8)))
    assert sorted(map(tuple, windows.collect())) == sorted(map(tuple, hashed.collect())) and len(want) > n
