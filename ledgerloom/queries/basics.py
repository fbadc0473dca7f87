"""One query per operator, on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import measures as m
from ledgerloom.functions import nested as n
from ledgerloom.functions import text as t
from ledgerloom.operators import matching, ranking
from ledgerloom.queries.registry import query, table
from ledgerloom.session import scratch_path
from ledgerloom.sources import files
from ledgerloom.sources.seeds import in_plan_table, values
from ledgerloom.sources.snapshots import (
    chosen_partition,
    expire_partition_versions,
    latest_partition,
    newest,
    newest_load_date,
    replace_partition,
    switch_partition,
    write_partition,
)

LONG_AGO = dt.datetime(1970, 1, 1)

# --- sources and partitions --------------------------------------------------


@query("""
SELECT doc_id AS document_key, lang, source, n_chars, '2024-01-02' AS load_date
FROM documents WHERE list_contains(string_split(text, ' '), 'the')
""")
def member_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep rows whose list holds a member, rename the key, stamp the load date."""
    documents = table(spark, sf_dir, "documents")
    return documents.where(n.has_member(F.split("text", " "), "the")).select(
        F.col("doc_id").alias("document_key"),
        "lang",
        "source",
        "n_chars",
        F.lit("2024-01-02").cast("date").cast("string").alias("load_date"),
    )


_EVENT_DAYS = "SELECT *, CAST(ts AS DATE) AS load_date FROM events"


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("load_date", F.to_date("ts"))


@query(f"""
WITH days AS ({_EVENT_DAYS})
SELECT event_id, user_id, event_type, CAST(load_date AS VARCHAR) AS load_date
FROM days WHERE load_date = (SELECT max(load_date) FROM days)
""")
def latest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = latest_partition(_events_by_day(spark, sf_dir))
    return days.select(
        "event_id", "user_id", "event_type", F.col("load_date").cast("string").alias("load_date")
    )


@query(f"""
WITH days AS ({_EVENT_DAYS})
SELECT event_id, user_id, event_type FROM days WHERE load_date = DATE '2024-01-15'
""")
def chosen_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = chosen_partition(_events_by_day(spark, sf_dir), "2024-01-15")
    return days.select("event_id", "user_id", "event_type")


@query(f"""
WITH days AS ({_EVENT_DAYS}),
newest AS (SELECT max(load_date) AS d FROM days),
before AS (SELECT max(load_date) AS d FROM days, newest WHERE load_date < newest.d)
SELECT CAST(newest.d AS VARCHAR) AS newest, CAST(before.d AS VARCHAR) AS previous,
  (SELECT count(*) FROM days, newest WHERE load_date = newest.d) AS n_newest,
  (SELECT count(*) FROM days, before WHERE load_date = before.d) AS n_previous
FROM newest, before
""")
def load_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest load beside the one before it: two counts in one pass over two partitions."""
    days = _events_by_day(spark, sf_dir)
    last = newest(days)
    before = days.where(F.col("load_date") < last).agg(F.max("load_date")).scalar()
    return days.where(F.col("load_date").isin(last, before)).agg(
        F.max("load_date").cast("string").alias("newest"),
        F.min("load_date").cast("string").alias("previous"),
        F.count_if(F.col("load_date") == last).alias("n_newest"),
        F.count_if(F.col("load_date") == before).alias("n_previous"),
    )


@query(f"""
WITH days AS ({_EVENT_DAYS}),
ends AS (SELECT max(load_date) AS emptied,
    max(load_date) FILTER (WHERE load_date < (SELECT max(load_date) FROM days)) AS replaced FROM days)
SELECT CAST(load_date AS VARCHAR) AS load_date, count(*) AS n_events,
  CAST(sum(CAST(value AS DECIMAL(18,2)) * if(load_date = replaced, 2, 1)) AS DOUBLE) AS total,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (load_date = replaced) AS DOUBLE) AS total_between,
  any_value(3) FILTER (load_date = replaced) AS n_versions
FROM days, ends WHERE load_date < emptied GROUP BY 1
""")
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days stored; the last one replaced by nothing, the one before by other rows, twice.

    Between writing and switching, a reader still finds the load before (``total_between``).
    """
    days = _events_by_day(spark, sf_dir)
    path = scratch_path(spark, "events-by-day")
    name = "events_" + path.rsplit("-", 1)[1]
    days.write.partitionBy("load_date").format("parquet").saveAsTable(name, path=path)
    replace_partition(days.limit(0), name, newest_load_date(spark, name))
    last = newest_load_date(spark, name)
    doubled = days.where(F.col("load_date") == F.lit(last)).withColumn("value", F.col("value") * 2)
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    written = write_partition(doubled, name, last)
    between = spark.table(name).where(F.col("load_date") == F.lit(last)).agg(total).first()[0]
    switch_partition(spark, name, last, written)
    replace_partition(doubled, name, last)
    # One version for each of the three replacements; the first files of a day are in its own folder.
    versions = expire_partition_versions(spark, name, LONG_AGO)
    replaced = F.col("load_date") == F.lit(last)
    stored = spark.table(name).groupBy("load_date").agg(F.count(F.lit(1)).alias("n_events"), total.alias("total"))
    return stored.withColumns(
        {
            "total_between": F.when(replaced, F.lit(between)),
            "n_versions": F.when(replaced, F.lit(len(versions))),
            "load_date": F.col("load_date").cast("string"),
        }
    )


@query("""
SELECT * REPLACE (CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props) FROM events
""")
def evolve_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files from before a column existed, read together with newer ones."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-evolved")
    old = events.where("event_type = 'error'").drop("props")
    old.write.parquet(f"{path}/part=old")
    events.where("event_type <> 'error'").write.parquet(f"{path}/part=new")
    return files.read_evolved(spark, path, events.schema).drop("part")


@query("""
SELECT * REPLACE (NULL AS value) FROM events WHERE event_type = 'error'
UNION ALL SELECT * FROM events WHERE event_type <> 'error'
""")
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union of two sets of rows, one of which lacks a column."""
    events = table(spark, sf_dir, "events")
    with_value = events.where("event_type <> 'error'")
    return files.append_rows(with_value, events.where("event_type = 'error'").drop("value"))


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
  string_split(c_name, '#')[1] AS first_tag, len(string_split(c_name, '#')) AS n_tags
FROM customer
""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV, nested columns as JSON and NULL as an empty cell, and read back typed."""
    customer = (
        table(spark, sf_dir, "customer")
        .withColumn("c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
        .withColumn("tags", F.split("c_name", "#"))
    )
    path = scratch_path(spark, "customer-csv")
    files.write_csv(customer, path)
    back = files.read_csv(spark, path, customer.schema)
    return back.withColumn("first_tag", F.get("tags", F.lit(0))).withColumn(
        "n_tags", F.size("tags").cast("bigint")
    ).drop("tags")


@query("""
SELECT doc_id, chr(10) || '"' || coalesce(text, '') || '", ' || source || chr(10) AS text, nullif(lang, '') AS lang
FROM documents
""")
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, commas and quotes as cells; records are cut by many tasks per file."""
    text = F.concat(F.lit('\n"'), F.coalesce("text", F.lit("")), F.lit('", '), "source", F.lit("\n"))
    documents = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), "lang")
    path = scratch_path(spark, "documents-csv")
    files.write_csv(documents, path)
    return files.read_csv(spark, path, documents.schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to a new path that appears only when complete."""
    documents = table(spark, sf_dir, "documents")
    return files.write_complete(documents, scratch_path(spark, "documents"))


@query("""
SELECT conv_id, turn, to_json({'lang': role, 'text': nullif(role, 'user')}) AS doc,
  to_json(string_split(role, 's')) AS parts
FROM conversations
""")
def nested_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs and lists as JSON text that keeps NULL fields."""
    doc = F.struct(F.col("role").alias("lang"), F.nullif("role", F.lit("user")).alias("text"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        n.json_text(doc).alias("doc"),
        n.json_text(F.split("role", "s")).alias("parts"),
    )


# --- scalar functions --------------------------------------------------------


@query("""
SELECT p_partkey, nullif(trim(replace(p_name, 'red', ' ')), '') AS cleaned,
  nullif(trim(replace(replace(p_type, 'PROMO', '   '), 'SMALL', '')), '') AS kind,
  coalesce(nullif(trim(replace(p_type, 'PROMO', '  ')), ''), lower(p_brand), 'none') AS first_known
FROM part
""")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = F.replace(F.replace("p_type", F.lit("PROMO"), F.lit("   ")), F.lit("SMALL"), F.lit(""))
    kind = F.replace("p_type", F.lit("PROMO"), F.lit("  "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        t.blank_to_null(F.replace("p_name", F.lit("red"), F.lit(" "))).alias("cleaned"),
        t.blank_to_null(blanked).alias("kind"),
        F.coalesce(t.blank_to_null(kind), t.fold("p_brand"), F.lit("none")).alias("first_known"),
    )


@query("""
SELECT o_orderkey, CASE WHEN lower(trim(split_part(o_orderpriority, '-', 2))) IN ('urgent', 'high', 'low')
  THEN lower(trim(split_part(o_orderpriority, '-', 2))) END AS priority
FROM orders
""")
def restrict_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.split_part("o_orderpriority", F.lit("-"), F.lit(2))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", t.restrict_domain(priority, ("urgent", "high", "low")).alias("priority")
    )


@query("""
SELECT o_orderkey, make_timestamp((CAST(epoch(o_orderdate) AS BIGINT) + o_custkey) * 1000000) AS ordered_at
FROM orders
""")
def epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", m.epoch_to_timestamp(seconds).cast("timestamp_ntz").alias("ordered_at")
    )


@query(r"""
SELECT p_partkey, nullif(trim(regexp_replace(split_part(p_name || chr(9) || '  x, ' || p_brand, ',', 1),
    '\s+', ' ', 'g')), '') AS label,
  nullif(trim(regexp_replace(split_part(' , ' || p_brand, ',', 1), '\s+', ' ', 'g')), '') AS blank_label,
  lower(coalesce(nullif(trim(regexp_replace(split_part(replace(p_brand, 'Brand#1', ' ') || ',' || p_type,
    ',', 1), '\s+', ' ', 'g')), ''), 'unknown')) AS label_key
FROM part
""")
def first_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First entry of a comma list with its whitespace collapsed, and its case-folded key."""
    rebranded = F.replace("p_brand", F.lit("Brand#1"), F.lit(" "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        t.first_label(F.concat("p_name", F.lit("\t  x, "), "p_brand")).alias("label"),
        t.first_label(F.concat(F.lit(" , "), "p_brand")).alias("blank_label"),
        t.label_key(F.concat(rebranded, F.lit(","), "p_type")).alias("label_key"),
    )


@query(r"""
SELECT o_orderkey, regexp_full_match(lpad(CAST(o_orderkey AS VARCHAR), 7, '0')
    || CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN '12' ELSE '1' || chr(10) END, '[0-9]{8,14}') AS ok
FROM orders
""")
def code_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 to 14 digits and nothing else, not even a final newline."""
    tail = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "F", "12")
    code = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 7, "0"), tail.otherwise("1\n"))
    return table(spark, sf_dir, "orders").select("o_orderkey", t.matches(code).alias("ok"))


@query("""
SELECT event_id,
  CAST(CAST(TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(15,2)) AS VARCHAR)
    END AS DECIMAL(33,18)) AS DECIMAL(18,6)) AS DOUBLE) AS amount
FROM events
""")
def text_to_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to exact decimal; what is no number becomes NULL."""
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.col("value").cast("decimal(15,2)").cast("string")
    )
    amount = m.to_amount(text).cast("decimal(18,6)").cast("double")
    return table(spark, sf_dir, "events").select("event_id", amount.alias("amount"))


@query("""
SELECT p_partkey, CASE WHEN p_type = 'LARGE' THEN '100ml' WHEN p_type = 'SMALL' THEN '100g'
  WHEN p_size % 5 < 3 THEN '100ml' ELSE '100g' END AS basis
FROM part
""")
def basis_heuristic(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = F.when(F.col("p_type") == "LARGE", "100ml").when(F.col("p_type") == "SMALL", "100g")
    unit = F.get(F.array(*map(F.lit, ("ml", "CL", "L", "g"))), F.col("p_size") % 5)
    return table(spark, sf_dir, "part").select(
        "p_partkey", m.nutrition_basis(stated, unit).alias("basis")
    )


@query("""
SELECT s.s_suppkey, n.n_name, md5(n.n_name) AS nation_key,
  md5(concat_ws('-', coalesce(CAST(nullif(s.s_nationkey, 0) AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    s.s_name)) AS supplier_key
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash keys over one and over two parts, one of them NULL at times."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select(
        "s_suppkey",
        "n_name",
        m.surrogate_key("n_name").alias("nation_key"),
        m.surrogate_key(F.nullif("s_nationkey", F.lit(0)), "s_name").alias("supplier_key"),
    )


@query("""
SELECT event_type, max(ts) < TIMESTAMP '2024-01-31 23:00:00' - INTERVAL 48 HOURS AS older_48,
  max(ts) < TIMESTAMP '2024-01-31 23:00:00' - INTERVAL 20 HOURS AS older_20
FROM events GROUP BY 1
""")
def age_of_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = dt.datetime(2024, 1, 31, 23, tzinfo=dt.timezone.utc)
    newest_event = F.max(F.col("ts").cast("timestamp"))
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            m.older_than(newest_event, as_of, 48).alias("older_48"),
            m.older_than(newest_event, as_of, 20).alias("older_20"),
        )
    )


# --- nested values -----------------------------------------------------------


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.missing') AS missing
FROM events
""")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("missing", T.StringType())]
    )
    props = F.from_json("props", fields)
    return table(spark, sf_dir, "events").select(
        "event_id", props["k"].alias("k"), props["missing"].alias("missing")
    )


@query("""
WITH given AS (
  SELECT conv_id, turn, unnest([{'lang': role, 'text': text},
    {'lang': 'length', 'text': CAST(length(text) AS VARCHAR)}]) AS e
  FROM conversations WHERE role <> 'system')
SELECT conv_id, turn, e.lang AS kind, e.text AS content FROM given
""")
def explode_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per list element; a NULL list gives none."""
    pairs = F.array(
        F.struct(F.col("role").alias("lang"), "text"),
        F.struct(F.lit("length").alias("lang"), F.length("text").cast("string").alias("text")),
    )
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") != "system", pairs).alias("pairs")
    )
    return n.explode_rows(turns, "pairs", "e").select(
        "conv_id", "turn", F.col("e.lang").alias("kind"), F.col("e.text").alias("content")
    )


@query("""
SELECT doc_id, coalesce(
  (SELECT w FROM (SELECT unnest(ws) AS w, generate_subscripts(ws, 1) AS i) WHERE substr(w, 1, 1) = 'q'
    ORDER BY i LIMIT 1),
  (SELECT w FROM (SELECT unnest(ws) AS w, generate_subscripts(ws, 1) AS i) WHERE substr(w, 1, 1) = 'w'
    ORDER BY i LIMIT 1), ws[1]) AS word
FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)
""")
def pick_by_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First word that begins with q, else the first with w, else the first word."""
    tagged = F.transform(
        F.split("text", " "),
        lambda w: F.struct(F.substring(w, 1, 1).alias("lang"), w.alias("text")),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", n.pick_by_preference(tagged, ("q", "w")).alias("word")
    )


@query("""
SELECT vec_id, count(*) AS n_large, CAST(round(max(CAST(v AS DOUBLE)), 6) AS DOUBLE) AS largest
FROM (SELECT vec_id, unnest(embedding) AS v FROM embeddings) WHERE v IS NOT NULL AND v >= 0.1
GROUP BY vec_id
""")
def explode_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    long = n.explode_rows(vectors, "embedding", "v").where(F.col("v").isNotNull() & (F.col("v") >= 0.1))
    largest = F.round(F.max(F.col("v").cast("double")), 6)
    return long.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n_large"), largest.alias("largest"))


MEASURES = [
    ("quantity", "unit", False),
    ("price", "EUR", False),
    ("discount", "pct", False),
    ("energy", "kJ", True),
]
_MEASURES_SCHEMA = T.StructType(
    [
        T.StructField("measure", T.StringType()),
        T.StructField("standard_unit", T.StringType()),
        T.StructField("is_energy", T.BooleanType()),
    ]
)


@query(f"""
WITH reference(measure, standard_unit, is_energy) AS ({values(MEASURES)}),
long AS (
  SELECT l_orderkey, l_linenumber, l_partkey, unnest([
    {{'name': 'Quantity', 'v': CAST(l_quantity AS DECIMAL(15,2)) * 1.000, 'unit': 'G'}},
    {{'name': 'price', 'v': CAST(l_extendedprice AS DECIMAL(15,2)) * 1.000, 'unit': 'g'}},
    {{'name': 'discount', 'v': (CAST(l_discount AS DECIMAL(15,2)) - 0.02) * 1.000, 'unit': 'mg'}},
    {{'name': 'energy', 'v': CAST(l_quantity AS DECIMAL(15,2)) * 1.000,
      'unit': CASE WHEN l_returnflag = 'A' THEN 'Kcal' ELSE 'KJ' END}},
    {{'name': 'tax', 'v': CAST(l_tax AS DECIMAL(15,2)) * 1.000, 'unit': '%'}}]) AS e
  FROM lineitem)
SELECT measure, standard_unit AS unit, CASE WHEN lower(e.unit) = 'kj' THEN 'kJ' ELSE e.unit END AS source_unit,
  count(*) AS n, CAST(CAST(sum(CASE WHEN e.name = 'energy' AND lower(e.unit) = 'kcal' THEN e.v * 4.184 ELSE e.v END)
    AS DECIMAL(24,6)) AS DOUBLE) AS total
FROM long JOIN reference ON lower(e.name) = measure
WHERE e.v >= 0 AND lower(e.unit) IN ('g', 'mg', 'kcal', 'kj')
GROUP BY ALL
""")
def measures_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns to long form, joined to a reference, one measure converted to its unit."""
    reference = in_plan_table(spark, MEASURES, _MEASURES_SCHEMA)

    def entry(name: str, amount, unit):
        unit = F.lit(unit) if isinstance(unit, str) else unit
        return F.struct(F.lit(name).alias("name"), m.to_amount(amount).alias("v"), unit.alias("unit"))

    energy_unit = F.when(F.col("l_returnflag") == "A", "Kcal").otherwise("KJ")
    discount = F.col("l_discount").cast("decimal(15,2)") - F.expr("0.02BD")
    entries = F.array(
        entry("Quantity", F.col("l_quantity").cast("decimal(15,2)"), "G"),
        entry("price", F.col("l_extendedprice").cast("decimal(15,2)"), "g"),
        entry("discount", discount, "mg"),
        entry("energy", F.col("l_quantity").cast("decimal(15,2)"), energy_unit),
        entry("tax", F.col("l_tax").cast("decimal(15,2)"), "%"),
    )
    long = table(spark, sf_dir, "lineitem").select(F.explode(entries).alias("e"))
    usable = long.where((F.col("e.v") >= 0) & F.lower("e.unit").isin("g", "mg", "kcal", "kj"))
    return (
        usable.join(reference, F.lower("e.name") == F.col("measure"))
        .groupBy(
            "measure", F.col("standard_unit").alias("unit"), t.unit_label("e.unit").alias("source_unit")
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(m.energy_in_kj("e.name", "e.unit", "e.v"))
            .cast("decimal(24,6)")
            .cast("double")
            .alias("total"),
        )
    )


# --- ranking, joins, aggregates ----------------------------------------------


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id) AS rn
  FROM events) WHERE rn = 1
""")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return ranking.latest_per_key(events, ["user_id"], "ts").drop("ts")


@query("""
WITH spellings AS (
  SELECT lower(spelled) AS brand_key, spelled, count(*) AS n FROM (
    SELECT CASE WHEN p_type = 'SMALL' THEN upper(p_brand) WHEN p_type = 'LARGE' THEN lower(p_brand)
      ELSE p_brand END AS spelled FROM part) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY brand_key ORDER BY n DESC, spelled) AS rn,
  sum(n) OVER (PARTITION BY brand_key) AS n_rows FROM spellings)
SELECT brand_key, spelled, CAST(n_rows AS BIGINT) AS n_rows FROM ranked WHERE rn = 1
""")
def canonical_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    spelled = (
        F.when(kind == "SMALL", F.upper("p_brand"))
        .when(kind == "LARGE", F.lower("p_brand"))
        .otherwise(F.col("p_brand"))
    )
    part = table(spark, sf_dir, "part").select(spelled.alias("spelled"))
    keyed = part.withColumn("brand_key", F.lower("spelled"))
    return ranking.most_common_value(keyed, "brand_key", "spelled")


@query("""
WITH picked AS (
  SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (
    PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 13)
SELECT o_orderkey, o_orderpriority, o_custkey FROM orders
WHERE o_orderkey IN (SELECT o_orderkey FROM picked) ORDER BY o_orderkey
""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 13 orders of every priority, in key order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    keys = ranking.top_per_group(
        orders.select("o_orderpriority", "o_orderkey"), ["o_orderpriority"], [F.asc("o_orderkey")], 13
    )
    return matching.with_parent(orders, keys, "o_orderkey", "o_orderkey").orderBy("o_orderkey")


MAPPING = [
    ("bolt", "hardware", 1), ("rod", "hardware", 1), ("gear", "machine", 1), ("widget", "device", 2),
    ("gizmo", "device", 2), ("red", "colour", 3), ("blue", "colour", 3), ("old", "other", 4),
    ("new", "other", 4),
]
_MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("priority", T.IntegerType()),
    ]
)


def _parts_by_category(spark: SparkSession, sf_dir: str, cap: int) -> DataFrame:
    mapping = in_plan_table(spark, MAPPING, _MAPPING_SCHEMA)
    no_words = F.array().cast("array<string>")
    words = F.when(F.col("p_size") <= 3, no_words).otherwise(F.split("p_name", " "))
    parts = table(spark, sf_dir, "part").select("p_partkey", words.alias("tags"))
    matched = matching.best_tag(
        parts, "p_partkey", "tags", mapping, tag="tag", target="category", cap=cap
    )
    status = (
        F.when(n.is_missing_list("tags"), "no_categories")
        .when(F.col("matched_tag").isNotNull(), "mapped")
        .otherwise("unmapped")
    )
    category = F.coalesce("matched_target", F.lit("other"))
    return matched.select("p_partkey", "matched_tag", category.alias("category"), status.alias("status"))


_CATEGORY_SQL = f"""
WITH mapping(tag, category, priority) AS ({values(MAPPING)}),
parts AS (SELECT p_partkey, CASE WHEN p_size <= 3 THEN [] ELSE string_split(p_name, ' ') END AS tags FROM part),
ranked AS (
  SELECT p_partkey, m.tag, m.category,
    row_number() OVER (PARTITION BY p_partkey ORDER BY m.priority, m.tag) AS rn
  FROM (SELECT p_partkey, unnest(tags) AS tag FROM parts) x JOIN mapping m ON lower(x.tag) = m.tag),
matched AS (
  SELECT p.p_partkey, r.tag AS matched_tag, coalesce(r.category, 'other') AS category,
    CASE WHEN len(p.tags) = 0 THEN 'no_categories' WHEN r.tag IS NOT NULL THEN 'mapped'
      ELSE 'unmapped' END AS status
  FROM parts p LEFT JOIN ranked r ON p.p_partkey = r.p_partkey AND r.rn = 1)
"""


@query(_CATEGORY_SQL + "SELECT category, status, count(*) AS n FROM matched GROUP BY ALL")
def tag_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts per category and status: every part resolved on its own row, without a shuffle."""
    return ranking.count_by(_parts_by_category(spark, sf_dir, cap=500), "category", "status")


@query(_CATEGORY_SQL + "SELECT * FROM matched")
def tag_category_large_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by joins, the way that serves mappings too large for the plan."""
    return _parts_by_category(spark, sf_dir, cap=0)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
""")
def keep_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    solvent = table(spark, sf_dir, "supplier").where("s_acctbal >= 0")
    return matching.with_parent(lines, solvent, "l_suppkey", "s_suppkey")


@query("""
SELECT o_orderkey, o_custkey FROM orders o
LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) c ON o.o_custkey = c.c_custkey
WHERE c.c_custkey IS NULL
""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return matching.without_parent(orders, customers, "o_custkey", "c_custkey", null_is_orphan=True)


@query("""
SELECT p.p_partkey, p.p_brand, n.n_name, r.r_name, count(*) AS n_lines,
  CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY ALL
""")
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact joined to its dimensions. Spark sizes each dimension and decides what to broadcast."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    suppliers = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_partkey", "p_brand", "n_name", "r_name")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.col("l_quantity").cast("decimal(15,2)")).cast("double").alias("quantity"),
        )
    )


@query("""
SELECT l_orderkey, CAST(max(l_quantity) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS largest_a,
  CAST(max(l_quantity) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS largest_r,
  CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) AS open_quantity,
  count(DISTINCT l_returnflag) FILTER (WHERE l_linestatus = 'O') AS n_open_flags, count(*) AS n
FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
""")
def filtered_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot by conditional maximum, filtered sum and distinct count, and groups with several rows."""
    is_open = F.col("l_linestatus") == "O"
    quantity = F.when(is_open, F.col("l_quantity").cast("decimal(15,2)"))

    def largest(flag: str):
        return F.max(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))

    # One marker per flag adds up to the distinct count, and combines before the shuffle.
    seen = [F.max(F.when(is_open & (F.col("l_returnflag") == f), 1).otherwise(0)) for f in "ANR"]
    flags = (seen[0] + seen[1] + seen[2]).cast("bigint")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            largest("A").alias("largest_a"),
            largest("R").alias("largest_r"),
            F.sum(quantity).cast("double").alias("open_quantity"),
            flags.alias("n_open_flags"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
    )
