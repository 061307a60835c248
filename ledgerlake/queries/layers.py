"""Queries on layers, columns, files and tables. People-like rows come from ``part``."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.checks import check_table, observe_checks, top_groups
from ..operators.embedding import embedder
from ..operators.guarded_sql import run_guarded_sql
from ..plans import medallion
from ..sources import files, tables
from ..sources.corpus import write_corpus
from ..workspace import shared_folder
from .registry import ORACLES, query, table

RUN_TS = "2024-01-01 00:00:00"

PEOPLE = """
SELECT p_partkey AS id, p_name AS name, p_name || ' ' || p_type AS bio,
       p_type AS department, p_brand AS country
FROM part"""
SILVER = f"SELECT *, upper(name) AS name_upper, TIMESTAMP '{RUN_TS}' AS ingestion_ts FROM ({PEOPLE})"


def run_ts() -> Column:
    return C.moment(RUN_TS, "timestamp_ntz")


def people(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_name", "p_type").alias("bio"),
        F.col("p_type").alias("department"),
        F.col("p_brand").alias("country"),
    )


def stored(df: DataFrame, by: list[str] | None = None) -> tuple[str, DataFrame]:
    """``df`` as a new table in the shared folder: its name and its rows."""
    name = f"ledgerlake_{uuid.uuid4().hex}"
    return name, tables.replace_table(df, name, by, shared_folder(df.sparkSession))


@query(SILVER)
def bronze_to_silver(spark, folder):
    return medallion.bronze_to_silver(people(spark, folder), run_ts())


@query(f"SELECT *, 'ledgerlake' AS record_source FROM ({SILVER})")
def silver_to_gold(spark, folder):
    return medallion.silver_to_gold(medallion.bronze_to_silver(people(spark, folder), run_ts()))


@query(f"SELECT *, 'ledgerlake' AS record_source, 64 AS dims FROM ({SILVER})")
def run_layers(spark, folder):
    """All layers as tables, from a CSV file on; gold is shown with the size of its vectors."""
    rows, shared = people(spark, folder), shared_folder(spark)
    files.write_csv(rows, f"{shared}/people.csv")
    written = medallion.run_layers(
        spark,
        f"{shared}/people.csv",
        ts=run_ts(),
        embed=embedder(),
        schema=rows.schema,
        prefix=f"ledgerlake_{uuid.uuid4().hex}_",
        path=shared,
    )
    sizes = written["enriched"].select("id", F.size("embedding").alias("dims"))
    return written["gold"].join(sizes, "id")


@query(
    """
SELECT c_custkey,
       CASE WHEN length(c_name) > 0 THEN left(c_name, 3) || '***' ELSE '<empty>' END AS masked_name,
       CASE WHEN length(c_mktsegment) > 0 THEN left(c_mktsegment, 5) || '***' ELSE '<empty>' END
           AS masked_segment,
       lower(c_mktsegment) AS segment_lower
FROM customer"""
)
def mask_names(spark, folder):
    return C.with_lower(table(spark, folder, "customer"), "c_mktsegment", "segment_lower").select(
        "c_custkey",
        C.mask("c_name").alias("masked_name"),
        C.mask("c_mktsegment", 5).alias("masked_segment"),
        "segment_lower",
    )


@query(
    """
SELECT doc_id,
       sha256(coalesce(source, '') || '|' || coalesce(lang, '') || '|' || doc_id || '|' ||
              coalesce(text, '')) AS stable_id
FROM documents"""
)
def stable_ids(spark, folder):
    ids = C.stable_id("source", "lang", "doc_id", "text").alias("stable_id")
    return table(spark, folder, "documents").select("doc_id", ids)


FENCED = "CASE WHEN role = 'assistant' THEN '```sql' ELSE '```' END || chr(10) || text || chr(10) || '```'"


@query(f"""
SELECT conv_id, turn, trim(regexp_replace(regexp_replace(trim(fenced, blanks),
           '^(```sql)?(```)?', ''), '```$', ''), blanks) AS answer
FROM (SELECT conv_id, turn, {FENCED} AS fenced, ' ' || chr(9) || chr(10) || chr(13) AS blanks
      FROM conversations)""")
def strip_fences(spark, folder):
    opening = F.when(F.col("role") == "assistant", "```sql").otherwise("```")
    fenced = F.concat(opening, F.lit("\n"), "text", F.lit("\n```"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", C.strip_code_fence(fenced).alias("answer")
    )


@query(f"""
SELECT department, country, count(*) AS n FROM ({PEOPLE})
GROUP BY department, country ORDER BY n DESC, department, country LIMIT 5""")
def top_department_countries(spark, folder):
    return top_groups(people(spark, folder), ["department", "country"], 5)


@query(f"""
WITH silver AS ({SILVER}), sizes AS (
    SELECT count(*) AS n, count(*) FILTER (embedding IS NOT NULL AND len(embedding) = 64) AS fit
    FROM embeddings)
SELECT 'silver' AS layer, 'at least 1 rows' AS "check", count(*) >= 1 AS passed, count(*) AS found
FROM silver
UNION ALL SELECT 'silver', 'column name_upper', true, 1
UNION ALL SELECT 'silver', 'column ingestion_ts', true, 1
UNION ALL SELECT 'silver', 'column name_initial', false, 0
UNION ALL SELECT 'vectors', 'at least 1 rows', n >= 1, n FROM sizes
UNION ALL SELECT 'vectors', 'column embedding', true, 1
UNION ALL SELECT 'vectors', '64 values in embedding', fit = n, fit FROM sizes""")
def layer_checks(spark, folder):
    silver = medallion.bronze_to_silver(people(spark, folder), run_ts())
    vectors = table(spark, folder, "embeddings")
    a = check_table(silver, ["name_upper", "ingestion_ts", "name_initial"])
    b = check_table(vectors, ["embedding"], dims={"embedding": 64})
    return (
        a.withColumn("layer", F.lit("silver"))
        .unionByName(b.withColumn("layer", F.lit("vectors")))
        .select("layer", "check", "passed", "found")
    )


@query(ORACLES["layer_checks"])
def layer_checks_in_write(spark, folder):
    """The same checks, observed while both tables are written."""
    silver, of_silver = observe_checks(
        medallion.bronze_to_silver(people(spark, folder), run_ts()), ["name_upper", "ingestion_ts", "name_initial"]
    )
    vectors, of_vectors = observe_checks(table(spark, folder, "embeddings"), ["embedding"], dims={"embedding": 64})
    stored(silver)
    stored(vectors)
    checks = of_silver().withColumn("layer", F.lit("silver"))
    return checks.unionByName(of_vectors().withColumn("layer", F.lit("vectors"))).select("layer", "check", "passed", "found")


METADATA_PATHS = """
SELECT 's3://w/' || lower(c_mktsegment) || '/' || t || '_' ||
       regexp_replace(md5(c_nationkey::VARCHAR), '^(.{8})(.{4})(.{4})(.{4})(.{12})$',
                      '\\1-\\2-\\3-\\4-\\5') || '/' || part || c_custkey || '.json' AS path
FROM customer, (VALUES ('people', 'metadata/v'), ('people_partitioned', 'metadata/v'),
                       ('people', 'data/')) AS kinds(t, part)"""


@query(f"""
SELECT DISTINCT regexp_replace(path, '/metadata/.*$', '') AS dir FROM ({METADATA_PATHS})
WHERE path LIKE '%/metadata/%'
  AND regexp_matches(path, '/people_[0-9a-f-]{{36}}/metadata/')""")
def discover_dirs(spark, folder):
    uuid_text = F.regexp_replace(
        F.md5(F.col("c_nationkey").cast("string")),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )

    def path(name: str, rest: str) -> Column:
        return F.concat(
            F.lit("s3://w/"), F.lower("c_mktsegment"), F.lit(f"/{name}_"), uuid_text,
            F.lit(f"/{rest}"), F.col("c_custkey").cast("string"), F.lit(".json"),
        )

    kinds = [("people", "metadata/v"), ("people_partitioned", "metadata/v"), ("people", "data/")]
    paths = table(spark, folder, "customer").select(
        F.explode(F.array(*[path(*kind) for kind in kinds])).alias("path")
    )
    return tables.discover_table_dirs(paths, "people")


@query(SILVER)
def roundtrip_replace(spark, folder):
    return stored(medallion.bronze_to_silver(people(spark, folder), run_ts()))[1]


@query(f"SELECT *, upper(left(name, 1)) AS name_initial FROM ({SILVER})")
def roundtrip_partitioned(spark, folder):
    silver = medallion.bronze_to_silver(people(spark, folder), run_ts())
    return stored(medallion.silver_by_initial(silver), ["name_initial"])[1]


@query(f"{PEOPLE} UNION ALL SELECT id, upper(name), bio, department, country FROM ({PEOPLE})")
def append_strict(spark, folder):
    rows = people(spark, folder)
    name, _ = stored(rows)
    return tables.append_rows(rows.withColumn("name", F.upper("name")), name)


@query(f"""
SELECT *, NULL::INTEGER AS size FROM ({PEOPLE})
UNION ALL
SELECT p_partkey, p_name, NULL, NULL, NULL, p_size FROM part""")
def append_evolving(spark, folder):
    name, _ = stored(people(spark, folder))
    sized = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    )
    return tables.append_evolving(sized, name)


@query("SELECT conv_id, turn, role, '\"' || text || '\", ' || chr(10) || role AS text FROM conversations")
def csv_roundtrip(spark, folder):
    """Texts with quotes, commas and line ends, written and read again."""
    path = shared_folder(spark)
    quoted = F.concat(F.lit('"'), "text", F.lit('", \n'), "role").alias("text")
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", quoted)
    files.write_csv(said, path)
    return files.read_csv(spark, path, said.schema, multi_line=True)


@query(
    """
SELECT vec_id, label, len(embedding)::INTEGER AS dims,
       round(list_sum(embedding::DOUBLE[]), 6) AS total
FROM embeddings"""
)
def json_roundtrip(spark, folder):
    vectors, path = table(spark, folder, "embeddings"), shared_folder(spark)
    files.write_json(vectors, path)
    back = files.read_json_records(
        spark, path, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT", one_array=False
    )
    total = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double"))
    return back.select(
        "vec_id", "label", F.size("embedding").alias("dims"), F.round(total, 6).alias("total")
    )


@query("SELECT item_id, text || chr(10) AS text FROM benchmark")
def documents_wholetext(spark, folder):
    """Each item as a file of its own, with a line feed at its end, read back whole."""
    path = shared_folder(spark)
    named = F.concat(F.lit("item_"), "item_id", F.lit(".txt"))
    write_corpus(table(spark, folder, "benchmark").select(named.alias("source_path"), F.concat("text", F.lit("\n")).alias("text")), path)
    item = F.regexp_extract("source_path", "item_([0-9]+)[.]txt", 1).cast("bigint")
    return files.read_documents(spark, path).select(item.alias("item_id"), "text")


@query(
    """
SELECT vec_id, label, generate_subscripts(embedding, 1)::INTEGER AS i, unnest(embedding)::DOUBLE AS value
FROM embeddings"""
)
def json_array(spark, folder):
    """Vectors from files that each hold one array of records; every entry is shown.

    A file is made of a group of at most 100 rows, whatever the size of the table.
    """
    path, records = shared_folder(spark), F.to_json(F.collect_list(F.struct("vec_id", "embedding", "label")))
    groups = table(spark, folder, "embeddings").groupBy(F.floor(F.col("vec_id") / 100).alias("_group"))
    array = groups.agg(records.alias("value")).select("value")
    array.write.option("maxRecordsPerFile", 1).text(path)
    back = files.read_json_records(spark, path, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    entries = back.select("vec_id", "label", F.posexplode("embedding").alias("place", "value"))
    return entries.select(
        "vec_id", "label", (F.col("place") + 1).alias("i"), F.col("value").cast("double").alias("value")
    )


EVENT_SQL = """
SELECT e.event_type, count(*) AS n, min(e.ts) AS first_ts, round(sum(e.value), 2) AS total
FROM {0} e JOIN {1} c ON e.user_id = c.c_custkey
WHERE e.value > (SELECT avg(value) FROM {0})
GROUP BY e.event_type ORDER BY e.event_type"""


@query(f"SELECT * FROM ({EVENT_SQL.format('events', 'customer')}) LIMIT 100")
def guarded_sql(spark, folder):
    """Generated text names tables with their namespace."""
    names = {"lake.bronze.events": "events", "silver.customer": "customer"}
    tables_of = {name: table(spark, folder, stored_as) for name, stored_as in names.items()}
    return run_guarded_sql(spark, EVENT_SQL.format(*names), tables_of, 100)
