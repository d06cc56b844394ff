"""Readers over a relational source and over delimited files."""

from pyspark.sql import functions as F

from varloom.sources import text

SF = "/root/testdata/sf0.001"
# the source keeps the column names in quotes, as Spark writes them
QUERY = """select "user_id", count(*) as "n" from events where "event_type" = 'purchase' and "amount" > 10 group by "user_id" """


def test_relational_extract(spark):
    url = "jdbc:derby:memory:extract;create=true"
    events = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_type", F.col("value").alias("amount"))
    events.coalesce(1).write.option("createTableColumnTypes", "event_type varchar(64)").mode("overwrite").jdbc(url, "events")
    want = {r.user_id: r.n for r in events.filter("event_type = 'purchase' and amount > 10").groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    whole = text.scan_rdb(spark, url, QUERY)
    assert want and {r.user_id: r.n for r in whole.collect()} == want
    top = max(want)
    parts = text.scan_rdb(spark, url, QUERY, "user_id", (0, top + 1, 4))
    assert parts.rdd.getNumPartitions() == 4
    assert {r.user_id: r.n for r in parts.collect()} == want
    assert text.scan_rdb(spark, url, 'select "user_id" from events where 1 = 0').count() == 0


def test_delimited_files(spark, tmp_path):
    nations = spark.read.parquet(f"{SF}/nation.parquet").select("n_nationkey", "n_name")
    folder = str(tmp_path / "nations")
    nations.repartition(3).write.csv(folder, sep="\t", header=True)
    read = text.scan_delimited(spark, folder, nations.schema.simpleString()[7:-1].replace(":", " "))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, nations.collect()))
    odd = tmp_path / "odd.csv"
    odd.write_text('id,name,score\n1,"a, ""b""",NA\n2,,0.5\n3,plain\n')
    rows = text.scan_delimited(spark, str(odd), "id int, name string, score double", sep=",").collect()
    assert [tuple(r) for r in rows] == [(1, 'a, "b"', None), (2, None, 0.5), (3, "plain", None)]
