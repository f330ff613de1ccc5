"""The crosswalk's range join against all pairs, and links without a key."""

import datetime
import random

from pyspark.sql import functions as F

from catalith.operators import joins as jn

DAY = datetime.date(2000, 1, 1)


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


def test_equals_all_pairs(spark):
    rng = random.Random(5)
    book = []
    for c in "abcd":
        for k in range(60):
            start = rng.randint(-4000, 4000)
            end = None if rng.random() < 0.02 else start + rng.choice([0, 1, 3, 30, 400, -2])
            book.append((c, f"{c}{k}", day(start), day(end)))
    book += [("e", "e1", day(0), None), ("e", "e2", day(50), None), ("e", "e3", day(60), None), (None, "n", day(0), day(9)), ("f", "f1", None, day(9))]
    rows = [(i, rng.choice([*"abcdefz", None]), None if i % 50 == 0 else day(rng.randint(-4200, 4500)), "old") for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, code string, d date, target_code string")
    x = spark.createDataFrame(book, "code string, target_code string, valid_from date, valid_to date")
    got = {r["i"]: (r["target_code"], r["crosswalk_status"]) for r in jn.crosswalk_join(df, x, "code", "d").collect()}
    assert len(got) == len(rows)
    for i, c, d, _ in rows:
        valid = [t for k, t, a, b in book if c and d and k == c and a and a <= d and (b is None or d <= b)]
        want = (valid[0], "match") if len(valid) == 1 else (None, "ambiguous" if valid else "unknown")
        assert got[i] == want, (c, d, valid)


def test_code_with_many_intervals(spark):
    n = 100_000
    x = spark.range(n).select(F.lit("hot").alias("code"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("target_code"),
                              F.timestamp_seconds(F.col("id") * 60).alias("valid_from"), F.timestamp_seconds(F.col("id") * 60 + 59).alias("valid_to"))
    df = spark.range(0, n, 7).select("id", F.lit("hot").alias("code"), F.timestamp_seconds(F.col("id") * 60 + 30).alias("d"))
    out = jn.crosswalk_join(df, x, "code", "d")
    assert out.filter(F.col("target_code") != F.concat(F.lit("t"), F.col("id").cast("string"))).count() == 0
    assert out.filter("crosswalk_status = 'match'").count() == df.count()


def test_empty_crosswalk(spark):
    df = spark.createDataFrame([("a", day(1))], "code string, d date")
    x = spark.createDataFrame([], "code string, target_code string, valid_from date, valid_to date")
    assert jn.crosswalk_join(df, x, "code", "d").first()["crosswalk_status"] == "unknown"


def test_links_without_key_do_not_shuffle(spark):
    links = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit("https://p.example/data/"), F.col("id").cast("string"))).otherwise(F.lit("mailto:x")).alias("url"))
    rec = spark.createDataFrame([("r0", "p", "0"), ("r0b", "p", "0"), ("r4", "p", "4"), ("q", "other", "2")], "id string, portal_id string, dataset_key string")
    out = jn.resolve_references(links, rec, "url", "^https://p\\.example/data/([0-9]+)$", "p")
    got = {r["id"]: (r["target_registrations"], r["first_target"], r["resolved"]) for r in out.collect()}
    assert len(got) == 1000 and got[0] == (2, "r0", True) and got[4] == (1, "r4", True) and got[2] == (0, None, False) and got[1] == (0, None, False)
