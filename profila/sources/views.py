"""Views that map the driver's tables onto the engine's data model.

``devices``    (device_id, phone_brand, device_model, gender, age, is_train)
``app_events`` (event_id, device_id, app_id, is_installed, is_active, date, tag_list)

The mapping rules below are fixed values: the oracle SQL restates them in
DuckDB's dialect and both must agree row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the mapping (must equal the oracle's view text):
#   app id           = props.k
#   is_installed     = event_type <> 'error'
#   is_active        = event_type in ('click', 'purchase')
#   date             = day of month of ts
#   tag list of app k = 't' || (7k + i) % 40 for i = 0 .. k % 5, comma-joined
#   device label     = customer rows with custkey % 5 <> 0 are labelled
#   gender           = acctbal >= 4500, age = 18 + custkey % 40
#   device_model     = 10 * length(mktsegment) + custkey % 10
ACTIVE_TYPES = ("click", "purchase")
ERROR_TYPE = "error"
TAG_COUNT = 40
TAG_STRIDE = 7
TAG_SPAN = 5
HOLDOUT_MOD = 5
GENDER_BALANCE = 4500
AGE_BASE, AGE_SPAN = 18, 40


def _app_tags(app: Column) -> Column:
    """Comma-joined tag list of an app, derived from its id."""
    return F.array_join(
        F.transform(F.sequence(F.lit(0), app % TAG_SPAN),
                    lambda i: F.concat(F.lit("t"), ((app * TAG_STRIDE + i) % TAG_COUNT).cast("string"))),
        ",")


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app-event log (U1: one table holds both labelled and unlabelled
    devices' events)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    app = F.get_json_object("props", "$.k").cast("int")
    return (ev.select(
        F.col("event_id"),
        F.col("user_id").alias("device_id"),
        app.alias("app_id"),
        (F.col("event_type") != ERROR_TYPE).cast("int").alias("is_installed"),
        F.col("event_type").isin(*ACTIVE_TYPES).cast("int").alias("is_active"),
        F.dayofmonth("ts").alias("date"),
        F.col("props"))
        .select("event_id", "device_id", "app_id", "is_installed", "is_active", "date",
                _app_tags(F.col("app_id")).alias("tag_list")))


def devices(spark: SparkSession, sf_dir: str, dedup: bool = True) -> DataFrame:
    """Device table, labelled and unlabelled rows together (U2), whole-row
    de-duplicated (D1)."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    labelled = (key % HOLDOUT_MOD) != 0
    df = c.select(
        key.alias("device_id"),
        F.col("c_nationkey").alias("phone_brand"),
        (F.length("c_mktsegment") * 10 + key % 10).cast("int").alias("device_model"),
        F.when(labelled, (F.col("c_acctbal") >= GENDER_BALANCE).cast("int")).alias("gender"),
        F.when(labelled, (AGE_BASE + key % AGE_SPAN).cast("int")).alias("age"),
        labelled.cast("int").alias("is_train"))
    return df.dropDuplicates() if dedup else df


def retail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A retail-size event log with the same schema as ``app_events``:
    device = customer, event = order, app = part, tags = part attributes.
    (l_orderkey, l_linenumber) is not unique, so event ids repeat."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linestatus", "l_returnflag", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_name")
    j = (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
           .join(pt, li.l_partkey == pt.p_partkey, "left"))
    return j.select(
        F.col("l_orderkey").alias("event_id"),
        F.col("o_custkey").alias("device_id"),
        F.col("l_partkey").alias("app_id"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_installed"),
        (F.col("l_returnflag") == "A").cast("int").alias("is_active"),
        F.dayofmonth("l_shipdate").alias("date"),
        F.concat_ws(",", "p_type", "p_brand", "p_name").alias("tag_list"))


def document_tokens_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels: doc = device, text = list,
    quality = binary label, is_train = labelled."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("device_id"), "text", "n_chars",
        F.col("quality").alias("label"),
        F.col("quality").isNotNull().cast("int").alias("is_train"))
