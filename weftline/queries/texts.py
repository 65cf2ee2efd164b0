"""Word counts, inverted index, top words, chained and incremental text jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.adapters import table
from weftline.functions.text import lines, words_delimited, words_stripped, words_unicode
from weftline.operators.index import POSTINGS_PER_ROW, index_documents
from weftline.operators.tables import fill_ready_hours, write_hours
from weftline.plans.sizing import spread
from weftline.queries.ingestion import LOGS, log_body
from weftline.registry import query
from weftline.session import scratch
from weftline.sources.files import read_counts

UNICODE_WORDS = r"SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM documents"


def count_words(words):
    return words.groupBy("word").agg(F.count("*").alias("n"))


def texts(spark, sf, *columns):
    return spread(table(spark, sf, "documents").select(*columns, "text"))


def unicode_words(spark, sf):
    return texts(spark, sf).select(F.explode(words_unicode(F.col("text"))).alias("word"))


@query("wordcount", f"SELECT word, count(*) AS n FROM ({UNICODE_WORDS}) WHERE word <> '' GROUP BY word")
def wordcount(spark, sf):
    return count_words(unicode_words(spark, sf).filter("word <> ''"))


@query("wordcount_min2", f"""
SELECT word, count(*) AS n FROM ({UNICODE_WORDS}) WHERE length(word) > 1 GROUP BY word ORDER BY n DESC, word""")
def wordcount_min2(spark, sf):
    return count_words(unicode_words(spark, sf).filter(F.length("word") > 1)).orderBy(F.desc("n"), "word")


@query("wordcount_strip_punct", r"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split_regex(regexp_replace(lower(text), '[^\w\s]', '', 'g'), '\s+')) AS word FROM documents)
WHERE regexp_matches(word, '\w{2,}') GROUP BY word ORDER BY n DESC, word""")
def wordcount_strip_punct(spark, sf):
    words = texts(spark, sf).select(F.explode(words_stripped(F.col("text"))).alias("word"))
    return count_words(words.filter(F.col("word").rlike(r"\w{2,}"))).orderBy(F.desc("n"), "word")


@query("wordcount_tokenize", r"""
WITH l AS (SELECT unnest(string_split_regex(text, '\r?\n')) AS line FROM documents),
w AS (SELECT unnest(string_split_regex(lower(line), '[ ",()*]+')) AS word FROM l)
SELECT word, count(*) AS n FROM w WHERE length(word) > 1 GROUP BY word ORDER BY n DESC, word LIMIT 20""")
def wordcount_tokenize(spark, sf):
    each_line = texts(spark, sf).select(F.explode(lines(F.col("text"))).alias("line"))
    words = each_line.select(F.explode(words_delimited(F.col("line"))).alias("word"))
    return count_words(words.filter(F.length("word") > 1)).orderBy(F.desc("n"), "word").limit(20)


@query("inverted_index", rf"""
WITH w AS (SELECT 'doc' || CAST(doc_id AS VARCHAR) || '.txt' AS file,
  unnest(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}_]+')) AS word FROM documents),
c AS (SELECT word, file, count(*) AS n FROM w WHERE word <> '' GROUP BY word, file),
p AS (SELECT *, (row_number() OVER (PARTITION BY word ORDER BY file) - 1) // {POSTINGS_PER_ROW} AS part FROM c)
SELECT word, CAST(part AS BIGINT) AS part, string_agg(file || ':' || CAST(n AS VARCHAR), ',' ORDER BY file) AS postings
FROM p GROUP BY word, part""")
def build_inverted_index(spark, sf):
    file = F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file")
    return index_documents(table(spark, sf, "documents").select(file, "text"), words_unicode(F.col("text")))


@query("top_n_words", f"""
SELECT word, count(*) AS n FROM ({UNICODE_WORDS}) WHERE word <> '' GROUP BY word ORDER BY n DESC, word DESC LIMIT 10""")
def top_n_words(spark, sf, n: int = 10):
    """Reads count lines. Each task keeps its own n best, one last task merges them (TakeOrderedAndProject)."""
    lines_in = wordcount(spark, sf).select(F.concat_ws("\t", "word", "n").alias("value"))
    return read_counts(lines_in).orderBy(F.desc("n"), F.desc("word")).limit(n)


@query("wordcount_load_report", f"""
SELECT word, count(*) AS n FROM ({UNICODE_WORDS}) WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 10""")
def wordcount_load_report(spark, sf):
    """Count, store as delimited text, declare a table over the files, report the top ten."""
    path = scratch(spark, "wordcount")
    wordcount(spark, sf).write.mode("overwrite").option("sep", "\t").csv(path)
    loaded = spark.read.schema("word string, n bigint").option("sep", "\t").csv(path)
    return loaded.orderBy(F.desc("n"), "word").limit(10)


@query("hourly_incremental_wordcount", """
WITH """ + LOGS + r""", w AS (SELECT strftime(ts, '%Y-%m-%d-%H') AS hour, unnest(string_split_regex(lower(body), '[^\p{L}\p{N}_]+')) AS word FROM logs)
SELECT hour, word, count(*) AS n FROM w WHERE word <> '' GROUP BY hour, word""")
def hourly_incremental_wordcount(spark, sf):
    """Hourly partitions of log lines with a ready mark; each run counts the words of the ready hours that have no result yet."""
    hourly = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd-HH").alias("hour"), log_body().alias("line")
    )
    root, out = scratch(spark, "hours"), scratch(spark, "hour-counts")
    write_hours(hourly, root, "hour")

    def count_hour_words(frame):
        words = frame.select("hour", F.explode(words_unicode(F.col("line"))).alias("word")).filter("word <> ''")
        return words.groupBy("hour", "word").agg(F.count("*").alias("n"))

    done = fill_ready_hours(spark, root, out, "hour", hourly.schema, count_hour_words)
    return done.select("hour", "word", "n")
