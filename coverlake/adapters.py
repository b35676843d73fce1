"""Domain tables derived from the driver's TPC-H-like tables.

Every adapter has a twin in :mod:`coverlake.oracle` with the same meaning in SQL.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlake.operators.timeline import previous_in_time
from coverlake.sources.literal import literal_table

AS_OF = date(2001, 6, 30)

MONEY = "decimal(14,4)"

# The test tables' work types and their standard names and risk classes.
WORK_NAMES = {"STANDARD": "装配工", "ECONOMY": "保洁", "PROMO": "快递员", "LARGE": "司机", "MEDIUM": "未知"}
WORK_RISK = {"装配工": ("2", "3|x"), "保洁": ("1", "S|x"), "快递员": ("4", "5|x"), "司机": ("6", "")}

# Product lines of the five market segments.
PRODUCTS = [
    ("AUTOMOBILE", "雇主责任险", "蓝领外包", "雇主", "雇主"),
    ("BUILDING", "建筑工人意外险", "蓝领外包", "雇主", "雇主"),
    ("FURNITURE", "马拉松意外险", "体育", "场景", "场景"),
    ("HOUSEHOLD", "家庭健康险", "健康", "健康", "健康"),
    ("MACHINERY", "骑行意外险", "体育", "场景", "体育"),
]

# Liability codes the claim system knows.
LIABILITY_CODES = [
    "2000000224", "2000000217", "2000000216", "2000000219", "2000000220",
    "2000000256", "2000000255", "2000000229", "2000000209", "2000000213",
]


def money(c: Column) -> Column:
    return c.cast("decimal(14,2)").cast(MONEY)


def certificate(key: Column, area: Column) -> Column:
    """18 digits from a key, put together as one number; some carry a star, some are cut to 15."""
    birthday = (F.pmod(key, F.lit(50)) + 1950) * 10000 + (F.pmod(key, F.lit(12)) + 1) * 100 + F.pmod(key, F.lit(28)) + 1
    tail = F.pmod(key, F.lit(1000)) * 10 + F.pmod(key, F.lit(10))
    full = ((F.lit(110000) + area * 1000) * F.lit(1000000000000) + birthday * 10000 + tail).cast("string")
    return (
        F.when(F.pmod(key, F.lit(50)) == 49, F.overlay(full, F.lit("**"), 15))
        .when(F.pmod(key, F.lit(70)) == 69, F.substring(full, 1, 15))
        .otherwise(full)
    )


def mobile(key: Column) -> Column:
    return F.concat(F.lit("1"), F.lpad(F.pmod(key * 7919, F.lit(100000)).cast("string"), 10, "0"))


class Tables:
    """Lazy access to the raw and the domain tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def area(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
            "n_nationkey",
            (F.lit(110000) + F.col("n_nationkey") * 1000).cast("string").alias("code"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("province"),
            F.lit("中国").alias("short_name"),
        )

    @cached_property
    def customer(self) -> DataFrame:
        c = self.raw("customer")
        return c.join(self.area, c.c_nationkey == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("holder_id"),
            F.col("c_name").alias("holder_name"),
            certificate(F.col("c_custkey"), F.col("c_nationkey")).alias("holder_cert_no"),
            mobile(F.col("c_custkey")).alias("holder_mobile"),
            F.col("c_mktsegment").alias("product_code"),
            F.col("code").alias("region_code"),
            "city",
            "province",
            F.col("c_acctbal").cast("decimal(14,2)").cast(MONEY).alias("balance"),
        )

    @cached_property
    def policy(self) -> DataFrame:
        o = self.raw("orders")
        start = F.col("o_orderdate").cast("date")
        even = F.pmod(F.col("o_orderkey"), F.lit(2)) == 0
        return (
            o.select(
                F.col("o_orderkey").alias("policy_id"),
                F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("policy_code"),
                F.col("o_custkey").alias("holder_id"),
                F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 0).otherwise(-1).alias("policy_status"),
                F.when(even, 1).otherwise(2).alias("charge_type"),
                start.alias("start_date"),
                F.date_add(start, F.when(even, 29).otherwise(364)).alias("end_date"),
                money(F.col("o_totalprice")).alias("first_premium"),
                (F.col("o_totalprice").cast("decimal(14,2)") / 100).cast(MONEY).alias("price"),
                (F.pmod(F.col("o_orderkey"), F.lit(20)) + 1).cast("int").alias("person_count"),
                F.col("o_orderpriority").alias("insurer"),
            )
            .join(self.customer, "holder_id", "left")
            .withColumnRenamed("city", "channel")
            .withColumn(
                "region_code",
                F.when(F.pmod(F.col("policy_id"), F.lit(6)) == 0, None)
                .when(F.pmod(F.col("policy_id"), F.lit(6)) == 1, F.substring("region_code", 1, 4))
                .otherwise(F.col("region_code")),
            )
        )

    @cached_property
    def policy_chain(self) -> DataFrame:
        """Policies with their predecessor: the holder's policy before, by (start, id)."""
        return previous_in_time(self.policy, "holder_id", "start_date", "policy_id", "predecessor_id")

    def _with_id(self, line: DataFrame) -> DataFrame:
        ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        price = F.col("l_extendedprice").cast("decimal(14,2)")
        return line.withColumn("line_id", F.concat_ws("-", *[F.col(c).cast("string") for c in ids], price.cast("string")))

    @cached_property
    def _line(self) -> DataFrame:
        return self._with_id(self.raw("lineitem"))

    def _started(self, line: DataFrame) -> DataFrame:
        """Lines with the day of their order; the id is put together behind the join, so the shuffle carries plain numbers."""
        o = self.raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"))
        return self._with_id(line.join(o, F.col("l_orderkey") == F.col("o_orderkey")))

    @cached_property
    def _line_start(self) -> DataFrame:
        return self._started(self.raw("lineitem"))

    def _insured(self, line: DataFrame, *more: str) -> DataFrame:
        start = F.date_add("order_day", F.col("l_linenumber") * 5 - 10)
        end = F.date_add(start, F.col("l_quantity").cast("int"))
        return line.select(
            F.col("line_id").alias("insured_id"),
            F.col("l_orderkey").alias("policy_id"),
            F.col("l_partkey").alias("person_id"),
            certificate(F.col("l_partkey"), F.pmod(F.col("l_partkey"), F.lit(25))).alias("cert_no"),
            mobile(F.col("l_partkey")).alias("mobile"),
            F.when((F.col("l_linenumber") == 7) & (F.col("l_discount") == 0), None).otherwise(start).alias("start_date"),
            F.when((F.col("l_linenumber") == 1) & (F.col("l_tax") == 0), None).otherwise(end).alias("end_date"),
            F.col("l_suppkey").alias("workplace_id"),
            *more,
        )

    @cached_property
    def insured(self) -> DataFrame:
        return self._insured(self._line_start)

    @cached_property
    def _work_type(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("person_id"), F.when(F.pmod("p_size", F.lit(10)) != 0, F.col("p_type")).alias("work_type"))

    @cached_property
    def insured_work(self) -> DataFrame:
        """Insured people with the text of their work type."""
        return self.insured.join(self._work_type, "person_id", "left")

    @cached_property
    def insured_work_by_policy(self) -> DataFrame:
        """The same rows, dealt by policy: plain lines get the text before they are dealt by order, so no shuffle carries ids or
        certificates."""
        line = self.raw("lineitem")
        typed = line.join(self._work_type, F.col("l_partkey") == F.col("person_id"), "left").select(line["*"], "work_type")
        return self._insured(self._started(typed), "work_type")

    @cached_property
    def dependant(self) -> DataFrame:
        """People who accompany an insured person: lines with return flag A."""
        return self._line.where("l_returnflag = 'A'").select(
            F.col("line_id").alias("master_id"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("slave_name"),
            certificate(F.col("l_suppkey"), F.pmod(F.col("l_suppkey"), F.lit(25))).alias("slave_cert_no"),
        )

    @cached_property
    def endorsement(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(14,2)")
        return self._line_start.select(
            F.col("line_id").alias("preserve_id"),
            F.col("l_orderkey").alias("policy_id"),
            (F.pmod(F.col("l_suppkey"), F.lit(3)) + 1).cast("int").alias("preserve_type"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("preserve_status"),
            (price * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY).alias("add_premium"),
            (-(price * F.col("l_tax").cast("decimal(4,2)"))).cast(MONEY).alias("del_premium"),
            F.col("l_quantity").cast("int").alias("add_person_count"),
            F.col("l_linenumber").alias("del_person_count"),
            F.date_add("order_day", F.col("l_linenumber")).alias("effective_date"),
        )

    @cached_property
    def claim_raw(self) -> DataFrame:
        """Claims as the source system keeps them, all text."""
        risk = F.date_add("order_day", F.pmod(F.col("l_partkey"), F.lit(60)).cast("int"))
        price = F.col("l_extendedprice").cast("decimal(14,2)")
        settled = F.col("l_linestatus") == "F"
        return self._line_start.where("l_returnflag = 'R'").select(
            F.col("line_id").alias("case_no"),
            F.col("l_orderkey").alias("policy_id"),
            F.col("l_partkey").alias("person_id"),
            certificate(F.col("l_partkey"), F.pmod(F.col("l_partkey"), F.lit(25))).alias("risk_cert_no"),
            F.when(F.col("l_tax") == 0, "")
            .when(F.pmod(F.col("l_suppkey"), F.lit(2)) == 0, F.date_format(risk, "yyyy/MM/dd"))
            .otherwise(F.date_format(risk, "yyyy-MM-dd"))
            .alias("risk_date"),
            (price * F.lit("0.1").cast("decimal(3,1)")).cast(MONEY).cast("string").alias("pre_com"),
            F.when(settled, (price * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY).cast("string")).otherwise("").alias("final_payment"),
            F.when(settled, "结案").otherwise("处理中").alias("case_status"),
            F.when(F.pmod(F.col("l_linenumber"), F.lit(2)) == 0, "死亡").otherwise("伤残").alias("case_type"),
        )

    @cached_property
    def claim_source(self) -> DataFrame:
        """Claims, liabilities and notices of the second claim system, one row each per returned line."""
        price = F.col("l_extendedprice").cast("decimal(14,2)")
        codes = F.array(*[F.lit(c) for c in LIABILITY_CODES])
        return self._line.where("l_returnflag = 'R'").select(
            F.concat(F.lit("C"), "line_id").alias("claim_no"),
            F.when(F.col("l_linestatus") == "F", F.concat(F.lit("N"), "line_id")).alias("notice_no"),
            F.when(F.col("l_tax") == 0.08, -1).otherwise(1).alias("status"),
            F.element_at(codes, (F.pmod(F.col("l_linenumber") + F.col("l_suppkey"), F.lit(len(LIABILITY_CODES))) + 1).cast("int")).alias("liability_code"),
            (price * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY).alias("amount"),
            F.col("l_orderkey").alias("policy_id"),
            mobile(F.col("l_partkey")).alias("mobile"),
            F.when(F.col("l_tax") > 0, F.col("l_shipdate").cast("date")).alias("loss_day"),
        )

    @cached_property
    def claim(self) -> DataFrame:
        from coverlake.operators.claims import claim_conform

        return claim_conform(self.claim_raw)

    @cached_property
    def product(self) -> DataFrame:
        names = ["product_code", "product_name", "one_level", "two_level", "business_line"]
        return literal_table(self.spark, names, PRODUCTS)

    @cached_property
    def sales(self) -> DataFrame:
        """Who sells to an enterprise: salesman, channel, operator and customer age."""
        c = self.customer
        s = self.raw("supplier").select("s_suppkey", F.col("s_name").alias("salesman"))
        return c.join(s, F.pmod(F.col("holder_id"), F.lit(100)) == F.col("s_suppkey"), "left").select(
            F.col("holder_name").alias("ent_name"),
            F.md5("holder_name").alias("ent_id"),
            F.when(F.pmod(F.col("holder_id"), F.lit(5)) == 0, F.lit("直客")).otherwise(F.col("city")).alias("channel_name"),
            "salesman",
            F.concat(F.lit("OP-"), "province").alias("biz_operator"),
            F.when(F.col("balance") < 0, "old").otherwise("new").alias("consumer_new_old"),
            F.when(F.pmod(F.col("holder_id"), F.lit(3)) == 0, "").otherwise("线上").alias("business_source"),
        )

    @cached_property
    def sales_team(self) -> DataFrame:
        s = self.raw("supplier")
        return s.join(self.area, s.s_nationkey == F.col("n_nationkey"), "left").select(
            F.col("s_name").alias("sale_name"),
            F.col("city").alias("team_name"),
            F.col("province").alias("department"),
            F.when(F.col("s_acctbal") >= 5000, F.col("province")).alias("group_name"),
        )

    @cached_property
    def plan(self) -> DataFrame:
        """One price plan per policy."""
        p = self.policy
        return p.select(
            "policy_id",
            "product_code",
            F.col("price").alias("sku_price"),
            (F.col("person_count") * 10).cast(MONEY).alias("sku_coverage"),
            F.when(F.col("charge_type") == 2, "1").otherwise("2").alias("sku_ratio"),
            F.col("charge_type").alias("sku_charge_type"),
            (F.pmod(F.col("policy_id"), F.lit(7)) / 100).cast(MONEY).alias("tech_rate"),
            F.when(F.pmod(F.col("policy_id"), F.lit(11)) == 0, None)
            .otherwise((F.pmod(F.col("policy_id"), F.lit(13)) / 100).cast(MONEY))
            .alias("broker_rate"),
        )

    @cached_property
    def work_match(self) -> DataFrame:
        return literal_table(self.spark, ["primitive_work", "work_name_check"], list(WORK_NAMES.items()))

    @cached_property
    def work_risk(self) -> DataFrame:
        rows = [(n, r, g) for n, (r, g) in WORK_RISK.items()]
        return literal_table(self.spark, ["standard_work_name", "standard_work_risk", "gs_work_risk"], rows)

    @cached_property
    def work_grade(self) -> DataFrame:
        kind = F.pmod(F.col("o_orderkey"), F.lit(4))
        return self.raw("orders").select(
            F.col("o_orderkey").alias("policy_id"),
            F.when(kind == 0, "1-3类").when(kind == 1, "1-4类").when(kind == 2, "5类").otherwise("").alias("profession_type"),
        )

    @cached_property
    def watch_list(self) -> DataFrame:
        """Enterprises on the black list (1) and the grey list (2)."""
        return self.customer.where("balance < 0").select(
            F.col("holder_name").alias("ent_name"), F.when(F.col("balance") < -500, 1).otherwise(2).alias("colour")
        )

    @cached_property
    def change_log(self) -> DataFrame:
        kind = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
        return self.raw("events").select(
            F.col("user_id").alias("key"), F.col("event_id").alias("seq"), kind.alias("type"), "value", "props"
        )
