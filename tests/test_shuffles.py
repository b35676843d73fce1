"""What plans move: read off plans over tables without rows."""

import re

import pytest
from pyspark.sql import functions as F

from coverlake.adapters import Tables
from coverlake.operators import quality as Q
from coverlake.operators.premium import ledger_enrich
from coverlake.operators.timeline import shared
from coverlake.plans import load_all
from coverlake.session import tune

TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


@pytest.fixture
def folder(rows, tmp_path):
    for name, schema in TABLES.items():
        rows(schema, []).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as over large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString().split("\n")


def below(lines, pattern):
    """For each line that matches, the lines of the tree under it."""
    deep = [len(re.match(r"[\s:+|-]*", x).group()) for x in lines]
    for i, line in enumerate(lines):
        if re.search(pattern, line):
            end = next((j for j in range(i + 1, len(lines)) if deep[j] <= deep[i]), len(lines))
            yield "\n".join(lines[i + 1 : end])


def test_what_a_task_reads_does_not_grow_with_the_table(spark):
    many = tune(spark).range(1_500_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    assert many.repartition("id").rdd.getNumPartitions() > 4  # the session's number of shuffle partitions


def test_ids_of_lines_are_put_together_behind_the_join(spark, folder):
    for table in (Tables(spark, folder).insured, Tables(spark, folder).endorsement):
        found = [*below(plan_of(table, "optimizedPlan"), "Join Inner")]
        assert found and not any("concat_ws" in x for x in found)


def test_sellers_meet_policies_and_not_movements(rows):
    ledger = rows("policy_id long, preserve_id string, day date", [(1, "a", None), (1, "a", None), (1, "b", None), (2, "c", None), (3, "d", None)])
    policy = rows("policy_id long, holder_name string, product_code string", [(1, "h", "x"), (2, "none", None)])
    plan = rows("policy_id long, sku_price int, sku_coverage int, sku_ratio string, sku_charge_type int", [(1, 5, 6, "1", 1)])
    sales = rows("ent_name string, channel_name string, salesman string", [("h", "直客", "s"), ("h", "c", None)])
    team = rows("sale_name string, team_name string", [("s", "t")])
    product = rows("product_code string, one_level string", [("x", "line")])
    df = ledger_enrich(ledger, policy, plan, sales, team, product)
    got = {(r.preserve_id, r.holder_name, r.channel_name, r.salesman, r.team_name, r.sku_price, r.one_level) for r in df.collect()}
    assert got == {
        ("a", "h", "h", "s", "t", 5, "line"), ("a", "h", "c", None, None, 5, "line"), ("b", "h", "h", "s", "t", 5, "line"),
        ("b", "h", "c", None, None, 5, "line"), ("c", "none", None, None, None, None, None),
    }
    assert df.count() == 5
    found = [*below(plan_of(df, "optimizedPlan"), r"Join LeftOuter.*ent_name")]
    assert found and not any("preserve_id" in x for x in found)


def test_people_on_endorsements_are_dealt_once_by_the_endorsement(shuffled, folder):
    lines = plan_of(load_all()["endorsement_people"].run(shuffled, folder))
    assert not any("join_date" in x for x in lines if "Exchange hashpartitioning" in x)


def test_only_people_of_located_policies_are_dealt_by_workplace(shuffled, folder):
    dealt = below(plan_of(load_all()["insured_location"].run(shuffled, folder)), r"Exchange hashpartitioning\(workplace_id")
    found = [x for x in dealt if "l_suppkey" in x]  # the other side of the join are the names
    assert found and all("LeftSemi" in x for x in found)


def test_layers_are_read_once_for_their_differences(spark, folder):
    layers = [Q.long_form(spark.read.parquet(f"{folder}/{t}.parquet").agg(F.count(F.lit(1)).alias("n")), t) for t in ("orders", "part")]
    assert sum("Relation [" in x for x in plan_of(Q.level_reconcile(layers), "optimizedPlan")) == 2


def test_shared_rows_are_computed_once(shuffled, rows, tmp_path):
    rows("k long, v long", [(k % 7, k) for k in range(50)] + [(None, 1), (None, None)]).write.parquet(f"{tmp_path}/t")
    table = shuffled.read.parquet(f"{tmp_path}/t")
    one = shared(table.groupBy("k").agg(F.sum("v").alias("v")), "k")
    keys = shuffled.range(9).select(F.col("id").alias("k"))
    both = keys.join(one, "k", "left").join(one.select("k", F.col("v").alias("w")), "k", "left")
    got = sorted(((r.k, r.v, r.w) for r in both.collect()), key=str)
    sums = {k: sum(v for v in range(50) if v % 7 == k) for k in range(7)}
    assert got == sorted([(k, v, v) for k, v in sums.items()] + [(k, None, None) for k in (7, 8)], key=str)
    final = "\n".join(plan_of(both)).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_the_fact_layer_and_the_mart_share_exposure(shuffled, folder):
    df = load_all()["level_reconcile"].run(shuffled, folder)
    kept = [x for x in plan_of(df) if "REPARTITION_BY_COL" in x]
    assert len(kept) == 6  # claims by two layers, exposure and earned premium by two


def test_only_people_with_a_claim_are_summed_up(shuffled, folder):
    found = [*below(plan_of(load_all()["plan_work_type_share"].run(shuffled, folder), "optimizedPlan"), r"Window \[")]
    assert found and all("LeftSemi" in x for x in found)


def test_plan_facts_meet_people_before_these_are_dealt_by_certificate(shuffled, folder):
    lines = plan_of(load_all()["plan_work_type_share"].run(shuffled, folder))
    found = [*below(lines, r"SortMergeJoin \[policy_id#\d+L, cert_no#\d+, start_date#\d+\]")]
    assert found and all("o_orderpriority" in x for x in found)  # the insurer


@pytest.mark.parametrize("name", ["work_type_claim", "policy_person_wide", "plan_work_type_share"])
def test_people_and_claims_stay_dealt_by_policy(shuffled, folder, name):
    dealt = [x for x in plan_of(load_all()[name].run(shuffled, folder)) if "Exchange hashpartitioning" in x]
    assert dealt and not any(re.search(r"cert_no|_range|isnull\(", x) for x in dealt)


def test_no_shuffle_of_people_for_their_work_type_carries_ids(shuffled, folder):
    dealt = below(plan_of(load_all()["work_type_match"].run(shuffled, folder)), r"Exchange hashpartitioning\((l_partkey|person_id|l_orderkey|policy_id)")
    assert not any("concat_ws" in x for x in dealt)


def test_masters_and_insured_people_read_one_shuffle(shuffled, folder):
    final = plan_of(load_all()["insured_facts"].run(shuffled, folder))
    shuffles = sorted(re.sub(r"#\d+L?|plan_id=\d+", "", x) for x in final if re.search(r"Exchange hashpartitioning\(l_orderkey", x))
    columns = [tuple(sorted(set(re.findall(r"l_\w+", x)))) for x in below(final, r"Exchange hashpartitioning\(l_partkey")]
    assert len(shuffles) == 3 and len(set(columns)) == 1  # claims, and twice the same people
