"""The analysed domain on top of the driver tables.

The named analyses speak of patients, encounters, outcomes, drugs, diagnoses and
providers. Those are views over the star schema:

| domain                | built from                                             |
| --------------------- | ------------------------------------------------------ |
| patients              | customer (segment as race, parity of key as gender)   |
| encounters, outcomes  | orders (1:1, so one scan carries both)                 |
| encounter_drugs       | distinct (order, part) pairs of lineitem               |
| encounter_diagnoses   | distinct (order, line number) pairs of lineitem        |
| encounter_providers   | distinct (order, supplier) pairs of lineitem           |
| drugs / providers     | part / supplier                                        |
| medical_specialties   | nation                                                 |

``SQL_VIEWS`` holds the same definitions as SQL for the DuckDB oracle; the two sides
must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Tables

# Outcome categories by order status.
READMIT_BY_STATUS = {"F": "<30", "P": ">30"}
READMIT_OTHERWISE = "NO"


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = Tables(spark, sf_dir)
        self.spark = spark

    # ------------------------------------------------------------ patients
    def patients(self) -> DataFrame:
        c = self.t.customer
        return c.select(
            F.col("c_custkey").alias("patient_id"),
            F.col("c_mktsegment").alias("race"),
            F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male").alias("gender"),
            F.col("c_nationkey").alias("nation_key"),
            F.col("c_acctbal").alias("acctbal"),
            F.to_json(
                F.struct(
                    (F.col("c_acctbal") > 4500).alias("diabetes"),
                    (F.col("c_nationkey") % 2 == 0).alias("on_diabetes_medication"),
                    (F.col("c_custkey") % 3 == 0).alias("a1c_tested"),
                )
            ).alias("risk_factors"),
        )

    # ------------------------------------------------------------ encounters (+ outcome columns)
    def encounters(self) -> DataFrame:
        o = self.t.orders
        decile = (F.col("o_custkey") % 10) * 10
        status = F.col("o_orderstatus")
        category = F.when(status == "F", READMIT_BY_STATUS["F"]).when(status == "P", READMIT_BY_STATUS["P"]) \
            .otherwise(READMIT_OTHERWISE)
        return o.select(
            F.col("o_orderkey").alias("encounter_id"),
            F.col("o_custkey").alias("patient_id"),
            F.col("o_orderdate").cast("date").alias("encounter_date"),
            F.col("o_orderpriority").alias("admission_type_name"),
            (F.col("o_orderkey") % 30).alias("medical_specialty_id"),
            F.concat(F.lit("["), decile.cast("string"), F.lit("-"), (decile + 10).cast("string"), F.lit(")"))
            .alias("encounter_age"),
            (F.col("o_orderkey") % 14 + 1).alias("time_in_hospital"),
            (F.col("o_orderkey") % 5).alias("number_outpatient"),
            (F.col("o_orderkey") % 3).alias("number_emergency"),
            (F.col("o_custkey") % 4).alias("number_inpatient"),
            F.col("o_totalprice").alias("total_charge"),
            category.alias("readmitted_category"),
            F.when(status == "F", 1).otherwise(0).alias("readmitted_flag"),
        )

    def outcomes(self) -> DataFrame:
        return self.encounters().select("encounter_id", "readmitted_category", "readmitted_flag")

    # ------------------------------------------------------------ junction tables
    def encounter_drugs(self) -> DataFrame:
        return self.t.lineitem.select(F.col("l_orderkey").alias("encounter_id"),
                                      F.col("l_partkey").alias("drug_id")).distinct()

    def encounter_diagnoses(self) -> DataFrame:
        return self.t.lineitem.select(F.col("l_orderkey").alias("encounter_id"),
                                      F.col("l_linenumber").alias("diagnosis_code_id")).distinct()

    def encounter_providers(self) -> DataFrame:
        return self.t.lineitem.select(F.col("l_orderkey").alias("encounter_id"),
                                      F.col("l_suppkey").alias("provider_id")).distinct()

    # ------------------------------------------------------------ lookups
    def drugs(self) -> DataFrame:
        p = self.t.part
        return p.select(
            F.col("p_partkey").alias("drug_id"),
            F.concat(F.lit("D"), F.col("p_partkey").cast("string")).alias("drug_code"),
            F.col("p_name").alias("generic_name"),
            F.col("p_type").alias("drug_class"),
            monograph_xml(F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size")).alias("monograph_xml"),
        )

    def providers(self) -> DataFrame:
        s = self.t.supplier
        return s.select(F.col("s_suppkey").alias("provider_id"), F.col("s_name").alias("provider_name"),
                        F.col("s_nationkey").alias("specialty_id"))

    def medical_specialties(self) -> DataFrame:
        # 25 rows whatever the scale: a bounded lookup.
        n = self.t.nation
        return F.broadcast(n.select(F.col("n_nationkey").alias("medical_specialty_id"),
                                    F.col("n_name").alias("specialty_name")))


def indicators(dom: "Domain") -> DataFrame:
    """Country indicators, one observation per order: country of the customer, year of the order.

    Missing values are planted on fixed key patterns so the pandas null rules are exercised.
    """
    o, c, n = dom.t.orders, dom.t.customer, dom.t.nation
    j = o.join(c.select("c_custkey", "c_nationkey"), o.o_custkey == c.c_custkey, "inner") \
        .join(F.broadcast(n.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    return j.select(
        k.alias("obs_id"),
        F.col("n_name").alias("Country"),
        F.year("o_orderdate").alias("Year"),
        F.when(k % 11 == 3, None).otherwise(F.lit(40) + ((k * 7 + ck) % 4500) / F.lit(100.0)).alias("LifeExpectancy"),
        F.when(k % 13 == 5, None).otherwise(F.col("o_totalprice") / F.lit(10.0)).alias("GDPperCapita"),
        ((k % 17) - 5).cast("double").alias("GDPGrowth"),
        F.when(ck % 7 == 0, None).otherwise((k % 15).cast("double")).alias("HealthExpenditure"),
        F.when(k % 19 == 4, None).otherwise((ck % 50 + 50).cast("double")).alias("LiteracyRate"),
        (F.col("o_totalprice") * 1000).alias("Population"),
    )


def risk_band(size):
    return F.when(size > 40, "HIGH").when(size > 20, "MEDIUM").otherwise("LOW")


def monograph_xml(name, brand, ptype, size):
    """XML document per drug: indication, contraindication, warning, risk level."""
    return F.concat(
        F.lit("<drug><indication>"), name, F.lit("</indication><contraindication>"), brand,
        F.lit("</contraindication><warning>"), ptype, F.lit("</warning><risk_level>"), risk_band(size),
        F.lit("</risk_level></drug>"),
    )


# ---------------------------------------------------------------- the same views in SQL (oracle side)

SQL_VIEWS = {
    "patients": """
        SELECT c_custkey AS patient_id, c_mktsegment AS race,
               CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
               c_nationkey AS nation_key, c_acctbal AS acctbal,
               CAST(json_object('diabetes', c_acctbal > 4500,
                                'on_diabetes_medication', c_nationkey % 2 = 0,
                                'a1c_tested', c_custkey % 3 = 0) AS VARCHAR) AS risk_factors
        FROM customer""",
    "encounters": """
        SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
               CAST(o_orderdate AS DATE) AS encounter_date, o_orderpriority AS admission_type_name,
               o_orderkey % 30 AS medical_specialty_id,
               '[' || CAST((o_custkey % 10) * 10 AS VARCHAR) || '-' || CAST((o_custkey % 10) * 10 + 10 AS VARCHAR) || ')'
                   AS encounter_age,
               o_orderkey % 14 + 1 AS time_in_hospital, o_orderkey % 5 AS number_outpatient,
               o_orderkey % 3 AS number_emergency, o_custkey % 4 AS number_inpatient,
               o_totalprice AS total_charge,
               CASE o_orderstatus WHEN 'F' THEN '<30' WHEN 'P' THEN '>30' ELSE 'NO' END AS readmitted_category,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS readmitted_flag
        FROM orders""",
    "outcomes": "SELECT encounter_id, readmitted_category, readmitted_flag FROM encounters",
    "encounter_drugs": "SELECT DISTINCT l_orderkey AS encounter_id, l_partkey AS drug_id FROM lineitem",
    "encounter_diagnoses": "SELECT DISTINCT l_orderkey AS encounter_id, l_linenumber AS diagnosis_code_id FROM lineitem",
    "encounter_providers": "SELECT DISTINCT l_orderkey AS encounter_id, l_suppkey AS provider_id FROM lineitem",
    "drugs": """
        SELECT p_partkey AS drug_id, 'D' || CAST(p_partkey AS VARCHAR) AS drug_code, p_name AS generic_name,
               p_type AS drug_class,
               '<drug><indication>' || p_name || '</indication><contraindication>' || p_brand
               || '</contraindication><warning>' || p_type || '</warning><risk_level>'
               || CASE WHEN p_size > 40 THEN 'HIGH' WHEN p_size > 20 THEN 'MEDIUM' ELSE 'LOW' END
               || '</risk_level></drug>' AS monograph_xml
        FROM part""",
    "providers": "SELECT s_suppkey AS provider_id, s_name AS provider_name, s_nationkey AS specialty_id FROM supplier",
    "medical_specialties": "SELECT n_nationkey AS medical_specialty_id, n_name AS specialty_name FROM nation",
    "indicators": """
        SELECT o_orderkey AS obs_id, n_name AS Country, CAST(year(o_orderdate) AS INTEGER) AS Year,
               CASE WHEN o_orderkey % 11 = 3 THEN NULL
                    ELSE 40 + ((o_orderkey * 7 + o_custkey) % 4500) / CAST(100 AS DOUBLE) END AS LifeExpectancy,
               CASE WHEN o_orderkey % 13 = 5 THEN NULL ELSE o_totalprice / CAST(10 AS DOUBLE) END AS GDPperCapita,
               CAST(o_orderkey % 17 - 5 AS DOUBLE) AS GDPGrowth,
               CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 15 AS DOUBLE) END AS HealthExpenditure,
               CASE WHEN o_orderkey % 19 = 4 THEN NULL ELSE CAST(o_custkey % 50 + 50 AS DOUBLE) END AS LiteracyRate,
               o_totalprice * 1000 AS Population
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
}

_DEPENDS = {"outcomes": ["encounters"]}


def with_views(query: str, *names: str) -> str:
    """Prefix ``query`` with the CTEs it names (dependencies first)."""
    ordered: list[str] = []

    def add(n):
        for dep in _DEPENDS.get(n, []):
            add(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in ordered)
    q = query.strip()
    if q.upper().startswith("WITH "):
        return f"WITH {ctes},\n{q[5:]}"
    return f"WITH {ctes}\n{q}"
