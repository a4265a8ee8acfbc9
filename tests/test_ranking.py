"""Order statistics: exact against DuckDB / brute force, including a hot
group holding a third of the rows and a value repeated on a third."""

import random

import pytest
from pyspark.sql import functions as F

from valora.operators.ranking import dense_id, exact_quantiles, percent_rank, rank_table


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{i % 17}"
        v = None if i % 29 == 0 else (42.0 if i % 3 == 0 and i % 2 == 0 else round(rnd.uniform(-50, 500), 2))
        rows.append((i, g, v))
    rows += [(9001, "allnull", None), (9002, "single", 5.0)]
    return rows, spark.createDataFrame(rows, "id long, g string, v double")




def test_quantiles_match_duckdb(spark, duck, skewed):
    rows, df = skewed
    duck.execute("CREATE OR REPLACE TABLE t (id BIGINT, g VARCHAR, v DOUBLE)")
    duck.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    exp = {r[0]: (r[1], r[2], r[3]) for r in duck.execute(
        "SELECT g, quantile_cont(v, 0.25), median(v), quantile_cont(v, 0.9) FROM t GROUP BY g").fetchall()}
    got = exact_quantiles(df, ["g"], ["v"], {"q1": 0.25, "med": 0.5, "p90": 0.9}, name_fmt="{q}")
    got = {r.g: (r.q1, r.med, r.p90) for r in got.collect()}
    assert got == exp
    whole = exact_quantiles(df, [], ["v", "id"], {"med": 0.5}).collect()[0]
    assert whole["med_v"] == duck.execute("SELECT median(v) FROM t").fetchone()[0]
    assert whole["med_id"] == duck.execute("SELECT median(id) FROM t").fetchone()[0]


def test_rank_table_brute_force(spark, skewed):
    rows, df = skewed
    rt = {(r.g, r.v): (r._cnt, r._before, r._n) for r in rank_table(df, ["g"], "v", 5).collect()}
    text = df.withColumn("v", F.when(F.col("v").isNotNull(), F.format_string("%012.2f", F.col("v") + 1000)))  # the range-slice plan
    tx = {(r.g, r.v and round(float(r.v) - 1000, 2)): (r._cnt, r._before, r._n) for r in rank_table(text, ["g"], "v", 5).collect()}
    assert tx == rt
    for (g, v), (cnt, before, n) in rt.items():
        vals = [x[2] for x in rows if x[1] == g and x[2] is not None]
        assert n == len(vals)
        if v is None:
            assert cnt == 0
        else:
            assert cnt == vals.count(v)
            assert before == sum(1 for x in vals if x < v)


def test_percent_rank_matches_window(spark, duck, skewed):
    rows, df = skewed
    duck.execute("CREATE OR REPLACE TABLE t (id BIGINT, g VARCHAR, v DOUBLE)")
    duck.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    exp = dict(duck.execute("SELECT id, percent_rank() OVER (PARTITION BY g ORDER BY v ASC NULLS FIRST) FROM t")
               .fetchall())
    got = {r.id: r.pr for r in percent_rank(df, ["g"], "v", "pr", 6).select("id", "pr").collect()}
    assert got == exp


def test_dense_id_is_ordered_and_dense(spark, skewed):
    _, df = skewed
    out = dense_id(df.repartition(5), ["g", "id"], "rid", 4).select("g", "id", "rid").collect()
    got = sorted(out, key=lambda r: r.rid)
    assert [r.rid for r in got] == list(range(1, len(out) + 1))
    assert [(r.g, r.id) for r in got] == sorted((r.g, r.id) for r in out)


def test_no_single_partition_window(spark, skewed):
    _, df = skewed
    plan = exact_quantiles(df, ["g"], ["v"], {"med": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_value_bucket_is_order_preserving(spark):
    from valora.operators.ranking import value_bucket
    rnd = random.Random(3)
    vals = [rnd.uniform(-1, 1) * 10 ** rnd.uniform(-12, 300) for _ in range(20000)]
    vals += [0.0, -0.0, 1e-320, -1e-320, float("inf"), float("-inf"), float("nan"), 1.0, 1.0 + 2 ** -52]
    vals += [x + k * 1e-9 for x in (12345.678, -0.5) for k in range(50)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
    rows = df.select("v", value_bucket(F.col("v")).alias("b")).orderBy(F.col("v").asc_nulls_first()).collect()
    bs = [r.b for r in rows]
    assert all(a <= b for a, b in zip(bs, bs[1:]))
    assert len(set(bs)) > 1000


def test_values_that_lie_close_together_are_no_single_task(spark):
    """All values in one value bucket, a third of them equal: exact medians, and
    the ranking of distinct values spread over tasks."""
    from valora.operators import ranking

    rnd = random.Random(12)
    values = [1000.0 if k % 3 == 0 else 1000 + rnd.random() * 0.01 for k in range(6000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.select(ranking.value_bucket(F.col("v")).alias("b")).distinct().count() == 1
    got = ranking.exact_quantiles(df, [], ["v"], {"q1": 0.25, "median": 0.5, "top": 1.0}, "{q}").collect()[0]
    s = sorted(values)
    pos = 0.25 * (len(s) - 1)
    assert got.median == (s[2999] + s[3000]) / 2 and got.top == s[-1]
    assert abs(got.q1 - (s[int(pos)] + (pos - int(pos)) * (s[int(pos) + 1] - s[int(pos)]))) < 1e-9
    agg = df.groupBy("v").agg(F.count(F.lit(1)).alias("_cnt"), F.count(F.lit(1)).alias("_rows"))
    tagged = agg.repartitionByRange(8, "v").groupBy(F.spark_partition_id()).count().collect()
    assert len(tagged) == 8 and max(r["count"] for r in tagged) < 1500
    ranks = {r.v: r._before for r in ranking.rank_table(df, [], "v").collect()}
    assert all(ranks[v] == sum(x < v for x in values) for v in rnd.sample(values, 40))
