import re

from netforensics.operators import emit as em
from netforensics.plans.case import Context, network_findings
from netforensics.sources.documents import parse_manifests
from netforensics.sources.feeds import demo_indicators
from tests.test_case_plan import CASE, tables

# A join of two inputs that are both dealt by case alone: no more tasks than cases, whatever their size.
BY_CASE = re.compile(r"(?:SortMergeJoin|ShuffledHashJoin) (?:\(\w+=\w+\) )?\[case_id#\d+\], ")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_record_tables_are_not_dealt_by_case(spark):
    raw = '{"network_mode":"simulated","guest_vm_identity":{"guest_ip":"10.0.0.5"}}'
    seen = []

    def stage(df):
        seen.append(plan(df))
        return spark.createDataFrame(df.collect(), df.schema)

    manifests = parse_manifests(spark.createDataFrame([(CASE, raw)], "case_id string, raw string"))
    found = network_findings(tables(spark), Context(intel=demo_indicators(spark), manifests=manifests, stage=stage))
    assert len(seen) == 3 and not [p for p in (*seen, plan(found)) if BY_CASE.search(p)]
    assert found.filter("kind = 'beacon'").count() == 1


def test_first_rows_of_cases_carry_the_seed(spark):
    rows = spark.range(20).selectExpr("concat('c', id % 2) AS case_id", "named_struct('at', id) AS chain_order", "'s' AS _seed")
    rows = rows.select("*", *[em.F.lit(None).cast("string").alias(c) for c in em.HASHED_COLUMNS if c not in ("case_id", "manifest_sha256")])
    chained = em.emit_events(rows.repartition(4))
    assert {(r.case_id, r.chain_pos): r.manifest_sha256 for r in chained.filter("manifest_sha256 IS NOT NULL").collect()} == {
        ("c0", 0): "s", ("c1", 0): "s",
    }
