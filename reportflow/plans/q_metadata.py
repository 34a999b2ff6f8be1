"""Queries: receiver metadata (insert-if-absent, members, defaults, specs, URLs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportflow.operators import metadata as md
from reportflow.plans.registry import query
from reportflow.sources.tables import table

DUCK_JTRIM = "regexp_replace({0}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def org_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("OU"), F.col("c_custkey").cast("string")).alias("id"),
                    F.col("c_name").alias("name"), "c_acctbal")


@query("insert_missing", oracle="""
SELECT 'OU' || c_custkey AS id, c_name AS name, false AS created FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT DISTINCT 'OU' || o_custkey, 'from orders ' || o_custkey, true FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
""")
def insert_missing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create only what is absent; existing rows untouched, incoming repeats created once."""
    existing = org_units(spark, sf_dir).filter(F.col("c_acctbal") >= 0).select("id", "name")
    o = table(spark, sf_dir, "orders")
    incoming = o.select(F.concat(F.lit("OU"), F.col("o_custkey").cast("string")).alias("id"),
                        F.concat(F.lit("from orders "), F.col("o_custkey").cast("string")).alias("name"))
    new, _ = md.insert_missing(existing, incoming, ["id"])
    return existing.withColumn("created", F.lit(False)).unionByName(new.withColumn("created", F.lit(True)))


ADMIN_USERS = ["admin", "system"]


@query("assign_all_members", oracle="\nUNION ALL\n".join(
    f"SELECT '{u}' AS user_id, '{lst}' AS list_name, 'OU' || c_custkey AS member_id FROM customer"
    for u in ADMIN_USERS for lst in md.USER_ACCESS_LISTS))
def assign_all_members_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every org unit on each access list of the configured users (lists replaced)."""
    return md.assign_all_members(org_units(spark, sf_dir), ADMIN_USERS)


@query("add_members", oracle="""
SELECT l_orderkey, l_linenumber,
       a || ',' || b || ',' || a || CASE WHEN c <> a AND c <> b THEN ',' || c ELSE '' END AS members
FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS a, CAST(l_suppkey AS VARCHAR) AS b,
             CAST(l_orderkey AS VARCHAR) AS c FROM lineitem)
""")
def add_members_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add ids to a member list if missing; the existing list is kept as it is."""
    li = table(spark, sf_dir, "lineitem")
    ref = lambda c: F.struct(F.col(c).cast("string").alias("id"))
    existing = F.array(ref("l_partkey"), ref("l_suppkey"), ref("l_partkey"))
    new = F.array(ref("l_suppkey"), ref("l_orderkey"))
    merged = md.add_members(existing, new)
    return li.select("l_orderkey", "l_linenumber",
                     F.array_join(F.transform(merged, lambda x: x["id"]), ",").alias("members"))


@query("pick_by_priority", oracle="""
WITH c AS (
  SELECT c_nationkey AS grp, c_custkey,
         CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 9000 THEN 0 WHEN c_custkey = 7 THEN 1 ELSE 2 END AS prio
  FROM customer),
best AS (SELECT grp, CAST(c_custkey AS VARCHAR) AS picked_id, prio AS priority FROM c
         QUALIFY row_number() OVER (PARTITION BY grp ORDER BY prio, c_custkey) = 1),
groups AS (SELECT n_nationkey AS grp FROM nation UNION ALL SELECT r_regionkey + 1000 FROM region)
SELECT g.grp, coalesce(b.picked_id, 'CcDefault') AS picked_id, b.priority
FROM groups g LEFT JOIN best b ON g.grp = b.grp
""")
def pick_by_priority_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named default first, else a known id, else the first, else a constant."""
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "grp")
    prio = (F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9000), 0)
            .when(F.col("c_custkey") == 7, 1).otherwise(2))
    groups = (table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("grp"))
              .unionByName(table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1000).alias("grp"))))
    return md.pick_by_priority(c, ["grp"], "c_custkey", prio, groups=groups, fallback="CcDefault")


@query("dataset_definition", oracle="""
SELECT data_set, COUNT(*) AS n_elements, string_agg(el || ':' || cc, ',' ORDER BY el, cc) AS elements
FROM (SELECT DISTINCT 'DS' || l_orderkey AS data_set, 'EL' || l_partkey AS el,
             CASE WHEN l_returnflag = 'R' THEN 'CcReturn' ELSE 'CcDefault' END AS cc FROM lineitem)
GROUP BY data_set
""")
def dataset_definition_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data set's element list nested as ``{dataElement:{id}, categoryCombo:{id}}``."""
    li = table(spark, sf_dir, "lineitem").withColumn(
        "data_set", F.concat(F.lit("DS"), F.col("l_orderkey").cast("string"))).withColumn(
        "el", F.concat(F.lit("EL"), F.col("l_partkey").cast("string")))
    combo = F.when(F.col("l_returnflag") == "R", F.lit("CcReturn")).otherwise(F.lit("CcDefault"))
    d = md.dataset_definition(li, "data_set", "el", combo)
    return d.select("data_set", F.size("dataSetElements").cast("long").alias("n_elements"),
                    F.array_join(F.transform("dataSetElements", lambda x: F.concat(
                        x["dataElement"]["id"], F.lit(":"), x["categoryCombo"]["id"])), ",").alias("elements"))


@query("split_specs", oracle="""
SELECT split_part(s, '|', 1) AS id, split_part(s, '|', 2) AS name,
       regexp_extract(s, '^[^|]*\\|[^|]*\\|(.*)$', 1) AS description
FROM (SELECT CASE WHEN p_size < 10 THEN p_partkey || '|' || p_name
                  ELSE p_partkey || '|' || p_name || '|' || p_type || '|' || p_brand END AS s FROM part)
""")
def split_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id|name|description`` lines; the last field keeps any further pipes."""
    p = table(spark, sf_dir, "part")
    line = F.when(F.col("p_size") < 10, F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name")) \
        .otherwise(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_type", "p_brand"))
    return p.select(*md.split_spec(line))


@query("normalize_url", oracle=f"""
SELECT page_id, CASE WHEN suffix(t, '/api') THEN t ELSE t || '/api' END AS base_url
FROM (SELECT page_id, regexp_replace({DUCK_JTRIM.format('raw')}, '/$', '') AS t
      FROM (SELECT page_id, ' ' || url || CASE WHEN url LIKE 'https%' THEN '/' WHEN url LIKE '%#top' THEN '/api/'
                                              ELSE '//' END || chr(9) AS raw FROM pages))
""")
def normalize_url_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trim, drop one trailing slash, ensure the ``/api`` suffix."""
    p = table(spark, sf_dir, "pages")
    tail = F.when(F.col("url").like("https%"), F.lit("/")).when(F.col("url").like("%#top"), F.lit("/api/")) \
        .otherwise(F.lit("//"))
    raw = F.concat(F.lit(" "), F.col("url"), tail, F.lit("\t"))
    return p.select("page_id", md.normalize_url(raw).alias("base_url"))


@query("fill_template", oracle="""
SELECT page_id, replace('<meta level="<OU_LEVEL_FACILITY_UID>"/>' || html, '<OU_LEVEL_FACILITY_UID>', 'LvlFacility')
         AS filled
FROM pages
""")
def fill_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facility-level token replaced throughout a whole template text."""
    p = table(spark, sf_dir, "pages")
    tpl = F.concat(F.lit('<meta level="<OU_LEVEL_FACILITY_UID>"/>'), F.col("html"))
    return p.select("page_id", md.fill_token(tpl, "LvlFacility").alias("filled"))
