"""Update, delete, upsert, compaction and snapshots on immutable files."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import EMP, emp, table
from weftline.operators.tables import bucket_count, total_bytes
from weftline.operators.versions import BUCKETS, VersionedTable, compact, snapshot_diff
from weftline.registry import query
from weftline.session import scratch

COLUMNS = ["emp_id", "name", "department", "salary", "country"]
SCHEMA = "emp_id bigint, name string, department string, salary double, country string"

# The second snapshot, in SQL: building staff get a raise, customers divisible by 40 leave, those divisible by 41 get a
# new number, and a copy of the top earners joins under numbers of its own.
LATER = f"""WITH {EMP}, later AS (
  SELECT CASE WHEN emp_id % 41 = 0 THEN emp_id + 1000000000 ELSE emp_id END AS emp_id, name, department,
    CASE WHEN department = 'BUILDING' AND emp_id % 41 <> 0 THEN round(salary * 1.10, 3) ELSE salary END AS salary
  FROM emp WHERE emp_id % 40 <> 0
  UNION ALL SELECT emp_id + 2000000000, name || ' II', department, salary FROM emp WHERE salary > 9500)"""


def buckets(spark, sf):
    return bucket_count(total_bytes(spark, f"{sf}/customer.parquet"), least=BUCKETS)


def managed(spark, sf):
    acid = VersionedTable(spark, scratch(spark, "acid"), SCHEMA, ["emp_id"], buckets(spark, sf))
    acid.create(emp(spark, sf).select(*COLUMNS))
    return acid


@query("acid_update", f"""
WITH {EMP} SELECT emp_id, name, department, round(CASE WHEN department = 'BUILDING' THEN salary * 1.10 ELSE salary END, 3) AS salary
FROM emp""")
def acid_update(spark, sf):
    acid = managed(spark, sf)
    acid.update(F.col("department") == "BUILDING", {"salary": F.round(F.col("salary") * 1.10, 3)})
    return acid.read().drop("country")


@query("acid_delete", f"WITH {EMP} SELECT emp_id, name, salary FROM emp WHERE NOT (emp_id = 12 OR salary < 0)")
def acid_delete(spark, sf):
    acid = managed(spark, sf)
    acid.delete(F.col("emp_id") == 12)
    acid.delete(F.col("salary") < 0)
    return acid.read().select("emp_id", "name", "salary")


@query("delta_compaction", """
WITH deltas AS (SELECT user_id, event_id AS txn, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'put' END AS op, value FROM events),
every AS (SELECT user_id, -1 AS txn, 'put' AS op, 0.0 AS value FROM (SELECT c_custkey AS user_id FROM customer)
  UNION ALL SELECT * FROM deltas),
last AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY txn DESC) AS rn FROM every)
SELECT user_id, CAST(value AS DOUBLE) AS value FROM last WHERE rn = 1 AND op <> 'delete'""")
def delta_compaction(spark, sf):
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.lit(0.0).alias("value"))
    op = F.when(F.col("event_type") == "error", "delete").otherwise("put")
    deltas = table(spark, sf, "events").select("user_id", "value", op.alias("op"), F.col("event_id").alias("txn"))
    return compact(base, deltas, ["user_id"], ["user_id", "value"])


@query("upsert", f"""
WITH {EMP} SELECT emp_id, department, name, salary FROM emp WHERE salary < 6000
UNION ALL SELECT emp_id, department, upper(name), round(salary + 100, 2) FROM emp WHERE salary >= 6000
UNION ALL SELECT emp_id, 'FINANCE', name, salary FROM emp WHERE emp_id % 100 = 0""")
def upsert(spark, sf):
    """Composite key (emp_id, department): equal pairs are replaced, new pairs are added."""
    staff = emp(spark, sf).select("emp_id", "department", "name", "salary")
    acid = VersionedTable(
        spark, scratch(spark, "upsert"), "emp_id bigint, department string, name string, salary double",
        ["emp_id", "department"], buckets(spark, sf),
    )
    acid.create(staff)
    raised = staff.filter("salary >= 6000").withColumns(
        {"name": F.upper("name"), "salary": F.round(F.col("salary") + 100, 2)}
    )
    added = staff.filter("emp_id % 100 = 0").withColumn("department", F.lit("FINANCE"))
    acid.upsert(raised.unionByName(added))
    return acid.read()


def later_staff(staff):
    moved = F.col("emp_id") % 41 == 0
    kept = staff.filter("emp_id % 40 <> 0").select(
        F.when(moved, F.col("emp_id") + 1_000_000_000).otherwise(F.col("emp_id")).alias("emp_id"),
        "name",
        "department",
        F.when((F.col("department") == "BUILDING") & ~moved, F.round(F.col("salary") * 1.10, 3))
        .otherwise(F.col("salary")).alias("salary"),
    )
    heirs = staff.filter("salary > 9500").select(
        (F.col("emp_id") + 2_000_000_000).alias("emp_id"),
        F.concat("name", F.lit(" II")).alias("name"), "department", "salary",
    )
    return kept.unionByName(heirs)


@query("snapshot_diff", f"""
{LATER}, pairs AS (SELECT e.emp_id AS old_key, l.emp_id AS new_key, to_json({{'n': e.name, 'd': e.department, 's': e.salary}}) AS a,
  to_json({{'n': l.name, 'd': l.department, 's': l.salary}}) AS b FROM emp e FULL JOIN later l ON e.emp_id = l.emp_id),
gone AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY old_key) AS copy FROM pairs WHERE new_key IS NULL),
come AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY new_key) AS copy FROM pairs WHERE old_key IS NULL)
SELECT 'M' AS change, old_key, new_key FROM pairs WHERE old_key = new_key AND a <> b
UNION ALL SELECT CASE WHEN come.new_key IS NULL THEN '-' WHEN gone.old_key IS NULL THEN '+' ELSE 'R' END, gone.old_key, come.new_key
FROM gone FULL JOIN come ON gone.a = come.b AND gone.copy = come.copy""")
def diff_snapshots(spark, sf):
    staff = emp(spark, sf).select("emp_id", "name", "department", "salary")
    return snapshot_diff(staff, later_staff(staff), "emp_id", ["name", "department", "salary"])


@query("snapshot_read_restore", f"""
WITH {EMP} SELECT emp_id, salary, 'before' AS state FROM emp
UNION ALL SELECT emp_id, salary, 'after' FROM emp WHERE department <> 'HOUSEHOLD'
UNION ALL SELECT emp_id, salary, 'restored' FROM emp""")
def snapshot_read_restore(spark, sf):
    acid = managed(spark, sf)
    snapshot = acid.version
    acid.delete(F.col("department") == "HOUSEHOLD")
    after = acid.version
    restored = acid.restore(snapshot)
    states = [("before", snapshot), ("after", after), ("restored", restored)]
    parts = [acid.read(v).select("emp_id", "salary", F.lit(s).alias("state")) for s, v in states]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
