"""Sinks, table layout and table definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import EMP, SALES, emp, sales, table
from weftline.operators.joins import bucketed_join
from weftline.operators.tables import (
    bucket_count,
    by_partition,
    fresh_database,
    merge_small_files,
    partition_advice,
    total_bytes,
    write_bucketed,
    write_partitioned,
)
from weftline.registry import query
from weftline.session import scratch
from weftline.sources.files import inventory

EMP_DDL = "emp_id BIGINT, name STRING, department STRING, salary DOUBLE, country STRING"
EMP_ORDER = ["emp_id", "name", "department", "salary", "country"]

# The two rows appended by the literal insert.
EXTRA_ROWS = "(900000001, 'Karl', 'FINANCE', 8100.0, 'NATION_1'), (900000002, 'Laura', 'FINANCE', 8700.0, 'NATION_2')"

# What each built-in format can compress with in this Spark.
CODECS = {
    "parquet": ["none", "snappy", "zstd", "gzip", "lz4_raw"],
    "orc": ["none", "snappy", "zlib", "zstd", "lz4"],
    "csv": ["none", "gzip", "bzip2", "deflate"],
}


def employee_table(spark, sf, kind="parquet", name="employees"):
    """A fresh managed table holding the employees; returns its qualified name."""
    full = f"{fresh_database(spark)}.{name}"
    spark.sql(f"CREATE TABLE {full} ({EMP_DDL}) USING {kind}")
    emp(spark, sf).select(*EMP_ORDER).write.insertInto(full)
    return full


@query("write_delimited", f"WITH {EMP} SELECT sep, emp_id, name, salary FROM emp, (VALUES ('comma'), ('tab')) s(sep)")
def write_delimited(spark, sf):
    staff = emp(spark, sf).select("emp_id", "name", "salary")
    parts = []
    for label, sep in (("comma", ","), ("tab", "\t")):
        path = scratch(spark, label)
        staff.write.option("sep", sep).csv(path)
        parts.append(spark.read.schema(staff.schema).option("sep", sep).csv(path).withColumn("sep", F.lit(label)))
    return parts[0].unionByName(parts[1])


@query("write_parquet_partitioned", f"WITH {EMP} SELECT {', '.join(EMP_ORDER)} FROM emp")
def write_parquet_partitioned(spark, sf):
    path = scratch(spark, "by-country")
    write_partitioned(emp(spark, sf), path, ["country"])
    return spark.read.parquet(path).select(*EMP_ORDER)


@query("write_modes", f"""
WITH {EMP} SELECT 'append' AS mode, emp_id FROM emp WHERE salary >= 0
UNION ALL SELECT 'append', emp_id FROM emp WHERE salary < 0
UNION ALL SELECT 'error', emp_id FROM emp WHERE salary >= 0
UNION ALL SELECT 'ignore', emp_id FROM emp WHERE salary >= 0
UNION ALL SELECT 'overwrite', emp_id FROM emp WHERE salary < 0""")
def write_modes(spark, sf):
    """Write the same folder twice under each mode; only the second write differs."""
    from pyspark.errors import AnalysisException

    staff = emp(spark, sf).select("emp_id", "salary")
    first, second = staff.filter("salary >= 0").select("emp_id"), staff.filter("salary < 0").select("emp_id")
    results = None
    for mode in ("append", "error", "ignore", "overwrite"):
        path = scratch(spark, mode)
        first.write.parquet(path)
        try:
            second.write.mode(mode).parquet(path)
        except AnalysisException:
            if mode != "error":
                raise
        held = spark.read.parquet(path).select(F.lit(mode).alias("mode"), "emp_id")
        results = held if results is None else results.unionByName(held)
    return results


@query("write_orc_tuned", f"WITH {EMP} SELECT {', '.join(EMP_ORDER)} FROM emp WHERE emp_id = 17 OR department = 'BUILDING'")
def write_orc_tuned(spark, sf):
    path = scratch(spark, "orc")
    writer = emp(spark, sf).select(*EMP_ORDER).write.option("orc.compress", "SNAPPY")
    writer = writer.option("orc.stripe.size", str(64 * 1024 * 1024))
    writer.option("orc.bloom.filter.columns", "emp_id,department").option("orc.bloom.filter.fpp", "0.05").orc(path)
    return spark.read.orc(path).filter("emp_id = 17 OR department = 'BUILDING'")


def codec_sizes(spark, sf):
    """Rows and bytes of the events table under every format and codec."""
    events = table(spark, sf, "events")
    root = scratch(spark, "codecs")
    rows = None
    for kind, codecs in CODECS.items():
        for codec in codecs:
            path = f"{root}/{kind}/{codec}"
            events.write.option("compression", codec).format(kind).save(path)
            back = spark.read.schema(events.schema).format(kind).load(path).agg(F.count("*").alias("rows_read"))
            back = back.select(F.lit(kind).alias("format"), F.lit(codec).alias("codec"), "rows_read")
            rows = back if rows is None else rows.unionByName(back)
    sizes = inventory(spark, root).groupBy(
        F.regexp_extract("path", r"/(\w+)/\w+/[^/]+$", 1).alias("format"),
        F.regexp_extract("path", r"/\w+/(\w+)/[^/]+$", 1).alias("codec"),
    ).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("files"))
    return rows.join(sizes, ["format", "codec"])


@query("codec_matrix", " UNION ALL ".join(
    f"SELECT '{kind}' AS format, '{codec}' AS codec, count(*) AS rows_read, true AS has_bytes FROM events"
    for kind, codecs in CODECS.items() for codec in codecs))
def codec_matrix(spark, sf):
    """What cannot be said in SQL, the bytes, is only tested for being there."""
    return codec_sizes(spark, sf).select("format", "codec", "rows_read", (F.col("bytes") > 0).alias("has_bytes"))


@query("ctas", f"""
WITH {EMP} SELECT emp_id, name, department, salary FROM emp WHERE salary > 8500 ORDER BY salary DESC""")
def ctas(spark, sf):
    db = fresh_database(spark)
    emp(spark, sf).createOrReplaceTempView("weft_ctas_emp")
    spark.sql(f"""CREATE TABLE {db}.high_earners USING orc AS
        SELECT emp_id, name, department, salary FROM weft_ctas_emp WHERE salary > 8500 ORDER BY salary DESC""")
    return spark.table(f"{db}.high_earners")


@query("insert_values", f"""
WITH {EMP} SELECT department, count(*) AS headcount, max(name) AS last_name FROM
  (SELECT {', '.join(EMP_ORDER)} FROM emp UNION ALL VALUES {EXTRA_ROWS}) GROUP BY department""")
def insert_values(spark, sf):
    name = employee_table(spark, sf)
    spark.sql(f"INSERT INTO {name} VALUES {EXTRA_ROWS}")
    return spark.table(name).groupBy("department").agg(
        F.count("*").alias("headcount"), F.max("name").alias("last_name")
    )


@query("insert_overwrite_select", f"WITH {EMP} SELECT emp_id, name, salary FROM emp WHERE country = 'NATION_3'")
def insert_overwrite_select(spark, sf):
    source = employee_table(spark, sf)
    target = employee_table(spark, sf, "orc", "employees_orc")
    spark.sql(f"INSERT OVERWRITE {target} SELECT * FROM {source} WHERE country = 'NATION_3'")
    return spark.table(target).select("emp_id", "name", "salary")


@query("load_files_into_table", f"WITH {EMP} SELECT {', '.join(EMP_ORDER)} FROM emp WHERE salary >= 0")
def load_files_into_table(spark, sf):
    """Delimited files replace whatever the table held."""
    name = employee_table(spark, sf)
    path = scratch(spark, "incoming")
    emp(spark, sf).select(*EMP_ORDER).filter("salary >= 0").write.csv(path)
    spark.read.schema(EMP_DDL).csv(path).write.mode("overwrite").format("parquet").saveAsTable(name)
    return spark.table(name)


@query("merge_small_files", "SELECT * FROM events")
def merge_files(spark, sf):
    many, few = scratch(spark, "many"), scratch(spark, "few")
    events = table(spark, sf, "events")
    events.repartition(3 * spark.sparkContext.defaultParallelism).write.parquet(many)  # far more files than the data need
    merge_small_files(spark, many, few)
    return spark.read.parquet(few)


@query("table_lifecycle", f"WITH {EMP} SELECT kind, emp_id, name, salary FROM emp, (VALUES ('external'), ('like')) k(kind)")
def table_lifecycle(spark, sf):
    """Dropping a managed table deletes its files, dropping an external one leaves them readable."""
    db = fresh_database(spark, "employee exercises")
    path = scratch(spark, "external")
    spark.sql(f"CREATE TABLE {db}.employees ({EMP_DDL}) USING parquet")
    spark.sql(f"CREATE TABLE {db}.employees_ext ({EMP_DDL}) USING parquet LOCATION '{path}'")
    emp(spark, sf).select(*EMP_ORDER).write.insertInto(f"{db}.employees")
    spark.table(f"{db}.employees").write.insertInto(f"{db}.employees_ext")
    like_path = scratch(spark, "like")
    spark.sql(f"CREATE TABLE {db}.employees_like LIKE {db}.employees LOCATION '{like_path}'")
    spark.table(f"{db}.employees").write.insertInto(f"{db}.employees_like")
    spark.sql(f"DROP TABLE {db}.employees_ext")
    spark.sql(f"DROP TABLE {db}.employees")
    if spark.catalog.tableExists(f"{db}.employees_ext") or spark.catalog.tableExists(f"{db}.employees"):
        raise RuntimeError("dropped tables are still listed")
    kept = spark.read.parquet(path).withColumn("kind", F.lit("external"))
    like = spark.table(f"{db}.employees_like").withColumn("kind", F.lit("like"))
    return kept.unionByName(like).select("kind", "emp_id", "name", "salary")


@query("alter_table_columns", f"""
WITH {EMP} SELECT emp_id, name, department, salary, country, CAST(NULL AS DOUBLE) AS commission FROM emp""")
def alter_table_columns(spark, sf):
    """Add a column and a property in place; a file table cannot rename a column, so that is a rewrite."""
    name = employee_table(spark, sf)
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (bonus DOUBLE)")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('author' = 'weftline')")
    spark.table(name).withColumnRenamed("bonus", "commission").write.format("parquet").saveAsTable(f"{name}_renamed")
    return spark.table(f"{name}_renamed")


@query("view_filter", f"WITH {EMP} SELECT emp_id, name, salary, country FROM emp WHERE department = 'MACHINERY'")
def view_filter(spark, sf):
    emp(spark, sf).filter("department = 'MACHINERY'").select(
        "emp_id", "name", "salary", "country"
    ).createOrReplaceTempView("weft_machinery_staff")
    return spark.table("weft_machinery_staff")


def sales_table(spark, sf):
    """Partitioned sales table filled by dynamic partition insert; partition columns come last."""
    name = f"{fresh_database(spark)}.sales_partitioned"
    spark.sql(f"""CREATE TABLE {name} (sale_id BIGINT, category STRING, amount DOUBLE, year INT, quarter STRING)
        USING parquet PARTITIONED BY (year, quarter)""")
    rows = sales(spark, sf).select("sale_id", "category", "amount", "year", "quarter")
    by_partition(rows, "year", "quarter").write.insertInto(name)
    return name


@query("static_partition_insert", f"""
WITH {SALES} SELECT quarter, count(*) AS n, round(sum(amount), 2) AS total FROM sales WHERE year = 1996 GROUP BY quarter""")
def static_partition_insert(spark, sf):
    name = f"{fresh_database(spark)}.sales_static"
    spark.sql(f"""CREATE TABLE {name} (sale_id BIGINT, category STRING, amount DOUBLE, year INT, quarter STRING)
        USING orc PARTITIONED BY (year, quarter)""")
    sales(spark, sf).createOrReplaceTempView("weft_static_sales")
    for quarter in ("Q1", "Q2", "Q3", "Q4"):
        spark.sql(f"""INSERT INTO {name} PARTITION (year = 1996, quarter = '{quarter}')
            SELECT sale_id, category, amount FROM weft_static_sales WHERE year = 1996 AND quarter = '{quarter}'""")
    return spark.table(name).filter("year = 1996").groupBy("quarter").agg(
        F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total")
    )


@query("dynamic_partition_insert", f"WITH {SALES} SELECT sale_id, category, amount, year, quarter FROM sales")
def dynamic_partition_insert(spark, sf):
    return spark.table(sales_table(spark, sf))


@query("show_partitions", f"""
WITH {SALES} SELECT DISTINCT 'year=' || CAST(year AS VARCHAR) || '/quarter=' || quarter AS partition FROM sales""")
def show_partitions(spark, sf):
    return spark.sql(f"SHOW PARTITIONS {sales_table(spark, sf)}")


@query("partition_pruned_scan", f"""
WITH {SALES} SELECT sale_id, category, amount FROM sales WHERE year = 1998 AND quarter = 'Q2'""")
def partition_pruned_scan(spark, sf):
    return spark.table(sales_table(spark, sf)).filter("year = 1998 AND quarter = 'Q2'").select(
        "sale_id", "category", "amount"
    )


@query("partition_aggregate", f"""
WITH {SALES} SELECT quarter, round(sum(amount), 2) AS total FROM sales WHERE year = 1997 GROUP BY quarter ORDER BY quarter""")
def partition_aggregate(spark, sf):
    return (
        spark.table(sales_table(spark, sf)).filter("year = 1997")
        .groupBy("quarter").agg(F.round(F.sum("amount"), 2).alias("total")).orderBy("quarter")
    )


@query("alter_partitions", f"""
WITH {SALES} SELECT DISTINCT 'year=' || year || '/quarter=' || quarter AS partition FROM sales
UNION ALL SELECT 'year=2030/quarter=Q3'""")
def alter_partitions(spark, sf):
    """Add an empty partition, one at a path of its own, drop one; the table lists the outcome."""
    name = sales_table(spark, sf)
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (year = 2030, quarter = 'Q2')")
    spark.sql(f"""ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (year = 2030, quarter = 'Q3')
        LOCATION '{scratch(spark, 'own-path')}'""")
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (year = 2030, quarter = 'Q2')")
    return spark.sql(f"SHOW PARTITIONS {name}")


@query("repair_partitions", f"WITH {SALES} SELECT year, quarter, count(*) AS n FROM sales GROUP BY year, quarter")
def repair_partitions(spark, sf):
    """Folders written behind the catalog's back become partitions once the table is repaired."""
    path = scratch(spark, "found")
    name = f"{fresh_database(spark)}.sales_found"
    spark.sql(f"""CREATE TABLE {name} (sale_id BIGINT, category STRING, amount DOUBLE, year INT, quarter STRING)
        USING parquet PARTITIONED BY (year, quarter) LOCATION '{path}'""")
    write_partitioned(sales(spark, sf), path, ["year", "quarter"], mode="append")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).groupBy("year", "quarter").agg(F.count("*").alias("n"))


@query("partition_column_advisor")
def partition_column_advisor(spark, sf):
    orders = table(spark, sf, "orders").withColumn("order_year", F.year("o_orderdate"))
    columns = ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "order_year"]
    orders = orders.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return partition_advice(orders, columns, total_bytes(spark, f"{sf}/orders.parquet"))


@query("bucketed_write", f"WITH {EMP} SELECT {', '.join(EMP_ORDER)} FROM emp")
def bucketed_write(spark, sf):
    """Buckets by employee inside one folder per country; four buckets until the table outgrows them."""
    name = f"{fresh_database(spark)}.employees_part_bucketed"
    buckets = bucket_count(total_bytes(spark, f"{sf}/customer.parquet"), least=4)
    write_bucketed(emp(spark, sf), name, buckets, "emp_id", ["country"])
    return spark.table(name).select(*EMP_ORDER)


def bucketed_pair(spark, sf):
    """Names of orders and customers tables bucketed on the join key, and the number of buckets."""
    db = fresh_database(spark)
    buckets = bucket_count(total_bytes(spark, f"{sf}/orders.parquet"), least=8)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    for name, frame in (("orders_b", orders), ("customer_b", customer)):
        write_bucketed(frame, f"{db}.{name}", buckets, "o_custkey")
    return f"{db}.orders_b", f"{db}.customer_b", buckets


@query("bucket_join", """
SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def bucket_join(spark, sf):
    orders, customer, _ = bucketed_pair(spark, sf)
    joined = bucketed_join(spark.table(orders), spark.table(customer), "o_custkey")
    return joined.select("o_orderkey", "o_totalprice", "c_name")


@query("sample_from_bucketed")
def sample_from_bucketed(spark, sf, bucket: int = 3):
    """One bucket, read from the files of that bucket alone."""
    orders, _, _ = bucketed_pair(spark, sf)
    details = spark.sql(f"DESCRIBE FORMATTED {orders}").filter("col_name = 'Location'")
    location = details.first()["data_type"]
    return spark.read.option("pathGlobFilter", f"*_{bucket:05d}.c*").parquet(location)
