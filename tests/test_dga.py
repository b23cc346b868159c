from pyspark.sql import functions as F

from netforensics.operators import dga


def samples(spark):
    names = [(f"{a}{b}{c}", int(a in "xyz")) for a in "abcxyz" for b in "aeiou" for c in "nrst"]
    return spark.createDataFrame(names, "name string, label int")


def test_training_reads_the_names_twice_and_keeps_the_vocabulary(spark):
    """Once for the vocabulary and once for the vectors, which are stored before the optimiser reads them."""
    rows = samples(spark)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    weights, _ = dga.train(rows.mapInArrow(seen, rows.schema), min_df=5, max_features=40, max_iter=5)
    assert read.value == 2 * rows.count()
    wanted = {r.feature for r in dga.build_vocabulary(dga.name_features(rows.select("name")), 5, 40).collect()}
    assert {r.feature for r in weights.collect()} == wanted


def test_features_count_repeated_grams_and_characters_outside_the_plane(spark):
    rows = spark.createDataFrame([("aaaa",), ("\U0001d49cé\U0001d49cé",), ("",)], "name string")
    got = {(r.name, r.feature): r.value for r in dga.name_features(rows).filter(F.col("feature").startswith("ng:")).collect()}
    assert got["aaaa", "ng:aa"] == 3 / 9 and got["aaaa", "ng:aaa"] == 2 / 9 and got["aaaa", "ng:^a"] == 1 / 9
    assert got["\U0001d49cé\U0001d49cé", "ng:\U0001d49cé"] == 2 / 9
    plain = dga.name_features(rows, with_scalars=False)
    assert {(r.name, r.feature): r.value for r in plain.collect()} == got
