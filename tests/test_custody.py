from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from netforensics.operators import custody as cu


def rows(spark, n=25):
    return spark.createDataFrame([("c1", i, f"row {i}") for i in range(n)] + [("c2", 0, "only")], "case_id string, n bigint, row_text string")


def chain(texts, seed="0" * 64):
    out, prev = [], seed
    for t in texts:
        prev = hashlib.sha256((prev + t).encode()).hexdigest()
        out.append(prev)
    return out


def test_chain_is_the_plain_chain(spark):
    got = cu.hash_chain(rows(spark), ["n"])
    c1 = [r.evidence_hash for r in got.filter("case_id = 'c1'").orderBy("chain_pos").collect()]
    assert c1 == chain([f"row {i}" for i in range(25)])
    assert all(r.is_valid for r in cu.verify_chain(got).collect())


def test_any_edit_is_found_at_its_row(spark):
    got = cu.hash_chain(rows(spark), ["n"])
    for place in (0, 11, 24):
        edited = got.withColumn(
            "row_text", F.when((F.col("case_id") == "c1") & (F.col("chain_pos") == place), "x").otherwise(F.col("row_text"))
        )
        report = {r.case_id: (r.is_valid, r.first_broken) for r in cu.verify_chain(edited).collect()}
        assert report == {"c1": (False, place), "c2": (True, -1)}


def test_segments_verify_and_seal(spark):
    got = cu.hash_chain(rows(spark), ["n"], segment_rows=10)
    assert all(r.is_valid for r in cu.verify_chain(got, segment_rows=10).collect())
    seals = {r.case_id: (r.rows, r.segments) for r in cu.seal_segments(got).collect()}
    assert seals == {"c1": (25, 3), "c2": (1, 1)}


def test_seeded_chain(spark):
    seeded = rows(spark, 3).withColumn("seed", F.lit("ab" * 32))
    got = cu.hash_chain(seeded, ["n"], seed="seed").filter("case_id = 'c1'").orderBy("chain_pos").collect()
    assert [r.evidence_hash for r in got] == chain(["row 0", "row 1", "row 2"], "ab" * 32)


def test_manifest_id_ignores_order(spark):
    a = spark.createDataFrame([("c", "h1", 1), ("c", "h2", 2)], "case_id string, sha256 string, size_bytes bigint")
    b = spark.createDataFrame([("c", "h2", 2), ("c", "h1", 1)], "case_id string, sha256 string, size_bytes bigint")
    assert cu.case_manifest(a).first().manifest_id == cu.case_manifest(b).first().manifest_id


def test_removed_repeated_swapped_and_edited_rows_are_found(spark):
    got = cu.hash_chain(rows(spark), ["n"], segment_rows=10).filter("case_id = 'c1'").persist()
    record = cu.seal_segments(got)
    pos = F.col("chain_pos")
    again = got.filter(pos == 4)
    swapped = got.withColumn("chain_pos", F.when(pos == 6, 7).when(pos == 7, 6).otherwise(pos).cast("bigint"))
    cases = {
        "intact": (got, -1),
        "first": (got.filter(pos != 0), 0),
        "middle": (got.filter(pos != 13), 13),
        "segment": (got.filter("chain_segment <> 1"), 19),
        "repeated": (got.unionByName(again), 4),
        "swapped": (swapped, 6),
        "column": (got.withColumn("n", F.when(pos == 17, -1).otherwise(F.col("n"))), 17),
        "tail": (got.filter(pos < 22), 22),
    }
    text = F.concat(F.lit("row "), F.col("n"))
    for name, (tampered, place) in cases.items():
        report = cu.verify_chain(tampered, text=text, record=record).first()
        assert (report.is_valid, report.first_broken) == (place < 0, place), name
    gone = cu.verify_chain(got.filter("false"), text=text, record=record).first()
    assert (gone.rows, gone.is_valid, gone.first_broken) == (0, False, 0)


def test_a_long_case_is_one_plain_chain(spark):
    texts = [f"row {i}" for i in range(100_003)]
    long = spark.range(100_003).select(F.lit("c").alias("case_id"), F.col("id").alias("n"), F.concat(F.lit("row "), "id").alias("row_text"))
    got = cu.hash_chain(long, ["n"])
    assert [r.evidence_hash for r in got.where("chain_pos >= 99999").orderBy("chain_pos").collect()] == chain(texts)[99_999:]
    assert [r.segments for r in cu.seal_segments(got).collect()] == [1]
