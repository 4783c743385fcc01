import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from layerkit.llm import oracles, quality
from layerkit.llm.queries import op9_quality_rules
from tests.llm.conftest import SF

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = [x for x in SPACE.split(t) if x]
    lines = [x for x in t.split("\n") if SPACE.sub("", x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if c[g] > 1:
            covered.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark, make, odd):
    rows = odd + [
        (20, "a b c d e a b c d e"),
        (21, "a a a a a a a"),
        (22, "x y a b c d e f z a b c d e f q"),
        (23, "l1\nl1\nl2 \nl2\n\n \n#|# & <x>\nl1"),
    ]
    out, m, kept = quality.judge(make(rows))
    got = sorted((r.doc_id or -1, *[r[m][k] for k in quality.BASE]) for r in out.collect())
    assert got == sorted((r[0] or -1, *brute(r[1])) for r in rows)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(oracles.oracle_sql()["op9_quality_rules"])
    df = op9_quality_rules(spark, SF)
    got = sorted(tuple(r[c] for c in rel.columns) for r in df.collect())
    assert got == sorted(rel.fetchall())


def test_limits_adapt_to_the_group(make):
    """Symbols common in one source are rare in another: only there they fail."""
    plain = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(i, " ".join(f"w{i}x{j}#" for j in range(12)), "en", "code") for i in range(120)]
    rows += [(1000 + i, plain + f" w{i}", "en", "prose") for i in range(120)]
    rows += [(5000, " ".join(f"z{j}#" for j in range(12)), "en", "prose")]
    kept = {r.doc_id for r in quality.keep_good(make(rows)).collect()}
    assert kept == {r[0] for r in rows} - {5000}


def test_word_length_has_limits_on_both_sides(make):
    rng = random.Random(2)
    text = lambda sizes: " ".join("".join(rng.choices("abcdefghijklmnop", k=k)) for k in sizes)
    rows = [(i, text([4 + (i + j) % 3 for j in range(40)]), "en", "s") for i in range(120)]
    rows += [(900, text([2] * 80), "en", "s"), (901, text([12] * 80), "en", "s")]
    out, m, kept = quality.judge(make(rows))
    assert not out.where(~F.col(kept) & (F.col("doc_id") < 900)).count()
    assert out.where(F.col("doc_id") >= 900).select(kept).distinct().collect() == [(False,)]


def test_limits_differ_between_groups_of_the_table_and_spare_labelled_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    measured = docs.withColumn("m", quality.measures(F.col("text"))).drop("text").cache()
    lim = quality.thresholds(measured, "m", "lang", "source").toPandas()
    for k in ("word_length", "signs", "stutter"):
        assert (lim[f"upper_{k}"].dropna() > quality.FLOOR[k]).any()
    assert all(lim[k].nunique() > 1 for k in ("upper_word_length", "lower_word_length", "upper_signs"))
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").distinct()
    rate = dict(
        op9_quality_rules(spark, sf)
        .where("not base_failed")
        .join(labels, "doc_id")
        .groupBy("quality")
        .agg(F.avg(F.col("kept").cast("int")))
        .collect()
    )
    assert rate[1] > 0.995 and rate[0] < 0.1


def test_merged_sketches_equal_one_sketch(spark, make):
    rows = [(i, "word " * 12 + "#" * (i % 7) + f" a{i}", "en", f"s{i % 3}") for i in range(60)]
    docs = make(rows).withColumn("m", quality.measures(F.col("text")))
    named = docs.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "m")
    parts = quality.merge(quality.sketch(named, ["g_lang", "g_source"], "m"), ["g_lang"])
    whole = quality.sketch(named, ["g_lang"], "m")
    assert sorted(parts.collect()) == sorted(whole.select(parts.columns).collect())


def test_sketch_error_is_bounded(spark):
    df = spark.range(1, 5000).select(F.col("id").alias("v"), quality.bucket_value(quality.bucket(F.col("id"))).alias("q"))
    worst = df.select(F.max(F.abs(F.col("q") / F.col("v") - 1))).first()[0]
    assert worst <= quality.ALPHA * 1.01


def test_odd_rows_and_clashing_names(make, odd):
    docs = make(odd, clashing=True)
    out = quality.keep_good(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} >= {4, 6}
    assert quality.keep_good(make([])).count() == 0


@pytest.mark.parametrize("text,failed", [(None, True), ("a b c", True), ("a b c d e f g h i j", False)])
def test_base_rule(make, text, failed):
    out, m, kept = quality.judge(make([(1, text)]))
    assert out.select(quality.base_failed(out[m])).first()[0] is failed
