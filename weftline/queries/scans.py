"""Sources: every reader is checked on data Spark first wrote from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import EMP, EMP_H, emp, emp_hired, table
from weftline.operators.tables import fresh_database, write_partitioned
from weftline.registry import query
from weftline.session import scratch
from weftline.sources.files import (
    folder_totals,
    load_pairs,
    read_delimited,
    read_evolved,
    rows_per_folder,
    save_pairs,
)

EMP_SCHEMA = "emp_id bigint, name string, department string, salary double, hire_date date, country string"
EMP_ORDER = ["emp_id", "name", "department", "salary", "hire_date", "country"]


@query("read_csv_schema", f"WITH {EMP_H} SELECT {', '.join(EMP_ORDER)} FROM emp_h")
def read_csv_schema(spark, sf):
    path = scratch(spark, "emp-csv")
    emp_hired(spark, sf).select(*EMP_ORDER).write.csv(path)
    return read_delimited(spark, path, EMP_SCHEMA)


@query("read_csv_infer", f"WITH {EMP} SELECT emp_id, name, salary FROM emp")
def read_csv_infer(spark, sf):
    path = scratch(spark, "emp-header")
    emp(spark, sf).select("emp_id", "name", "salary").write.csv(path, header=True)
    inferred = spark.read.csv(path, header=True, inferSchema=True)
    return inferred.withColumn("emp_id", F.col("emp_id").cast("bigint"))  # inferred as int while ids are small


@query("read_text_lines", r"""
SELECT line, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\r?\n')) AS line FROM documents) GROUP BY line""")
def read_text_lines(spark, sf):
    path = scratch(spark, "doc-lines")
    table(spark, sf, "documents").select(
        F.explode(F.split("text", r"\r?\n")).alias("value")
    ).write.text(path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("read_parquet_orc_json", """
SELECT format, event_type, count(*) AS n, round(sum(value), 2) AS total
FROM events, (VALUES ('json'), ('orc'), ('parquet')) f(format) GROUP BY ALL""")
def read_parquet_orc_json(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    parts = []
    for kind in ("json", "orc", "parquet"):
        path = scratch(spark, f"events-{kind}")
        events.write.format(kind).save(path)
        back = spark.read.schema(events.schema).format(kind).load(path)
        totals = back.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
        parts.append(totals.withColumn("format", F.lit(kind)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("read_catalog_table", f"WITH {EMP} SELECT country, count(*) AS headcount FROM emp GROUP BY country")
def read_catalog_table(spark, sf):
    db = fresh_database(spark)
    emp(spark, sf).write.format("parquet").saveAsTable(f"{db}.employees")
    return spark.table(f"{db}.employees").groupBy("country").agg(F.count("*").alias("headcount"))


@query("read_with_input_file", """
SELECT 'source=' || source AS folder, count(*) AS lines, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS parts
FROM documents GROUP BY source""")
def read_with_input_file(spark, sf):
    """Every line carries its file; the folder above the file tells the source apart."""
    path = scratch(spark, "by-source")
    line = F.to_json(F.struct("text")).alias("value")
    write = table(spark, sf, "documents").select("source", line)
    write.hint("rebalance", "source").write.partitionBy("source").text(path)
    tagged = spark.read.text(path).select(
        "value", F.regexp_extract(F.url_decode("_metadata.file_path"), r"/(source=[^/]+)/[^/]+$", 1).alias("folder")
    )
    return tagged.groupBy("folder").agg(
        F.count("*").alias("lines"),
        F.sum(F.size(F.split(F.get_json_object("value", "$.text"), "\n"))).cast("long").alias("parts"),
    )


@query("sequencefile_roundtrip", """
SELECT 'doc' || CAST(doc_id AS VARCHAR) || '.txt' AS file, md5(text) AS digest FROM documents""")
def sequencefile_roundtrip(spark, sf):
    """Pack many small texts into a key/value container, keyed by file name, and read them back."""
    path = scratch(spark, "packed")
    named = table(spark, sf, "documents").select(F.format_string("doc%d.txt", "doc_id").alias("file"), "text")
    save_pairs(named, "file", "text", path)
    return load_pairs(spark, path, "file string, text string").select("file", F.md5("text").alias("digest"))


@query("schema_evolution_read", f"""
WITH {EMP} SELECT emp_id, name, salary, CASE WHEN emp_id % 2 = 0 THEN 0.0 ELSE round(salary * 0.1, 3) END AS bonus FROM emp""")
def schema_evolution_read(spark, sf):
    """Old files lack ``bonus`` and still carry ``country``; new files have ``bonus``."""
    path = scratch(spark, "evolving")
    staff = emp(spark, sf)
    staff.filter("emp_id % 2 = 0").select("emp_id", "name", "salary", "country").write.parquet(f"{path}/gen=1")
    newer = staff.filter("emp_id % 2 = 1")
    newer.select("emp_id", "name", "salary", F.round(F.col("salary") * 0.1, 3).alias("bonus")).write.parquet(
        f"{path}/gen=2"
    )
    wanted = {"emp_id": ("bigint", None), "name": ("string", None), "salary": ("double", None), "bonus": ("double", 0.0)}
    return read_evolved(spark, [f"{path}/gen=1", f"{path}/gen=2"], wanted)


@query("file_inventory", """
SELECT 'event_type=' || event_type AS folder, count(*) AS n_rows FROM events GROUP BY event_type""")
def file_inventory(spark, sf):
    """Rows of every listed folder, counted by the file they are read from; files and bytes are columns of `folder_totals`."""
    path = scratch(spark, "inventory")
    write_partitioned(table(spark, sf, "events"), path, ["event_type"])
    name = F.regexp_extract("folder", r"([^/]+)$", 1).alias("folder")
    rows = rows_per_folder(spark.read.parquet(path)).select(name, "n_rows")
    return folder_totals(spark, path).filter("files > 0 AND bytes > 0").select(name).join(rows, "folder")
