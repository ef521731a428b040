"""Message views and derived logs over the given tables, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.operators.queue_config import queue_config
from waybill.sources import envelopes
from waybill.sources.envelopes import table

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
QUEUES = ["QUEUE.CLICK", "QUEUE.ERROR", "QUEUE.PURCHASE", "QUEUE.SIGNUP", "QUEUE.VIEW"]

ERROR_CLASSES = [
    "waybill.ConnectorException",
    "waybill.ConnectorException",
    "waybill.ConnectorException",
    "waybill.ConnectorException",
    "java.lang.IllegalArgumentException",
    "java.net.SocketTimeoutException",
    "java.io.EOFException",
    "java.util.regex.PatternSyntaxException",
]
ERROR_TEXTS = [
    "Authentication rejected",
    "Bad CONFIGURATION value",
    "Parse stopped: invalid format",
    "Connection broken",
    "bad argument",
    None,
    "end of stream",
    "bad pattern",
]
REASON_CODES = [2035, 2063, 2059, 2009, 2538, 2537, 2085, 2058, 2003, 2195, 2033, None]


def pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sql_list(values: list) -> str:
    return "[" + ",".join("NULL" if v is None else repr(v) for v in values) + "]"


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Event messages, with the source columns the logs below are derived from."""
    return envelopes.event_messages(table(spark, folder, "events"), ("event_id", "value"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return envelopes.document_messages(table(spark, folder, "documents"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return envelopes.page_messages(table(spark, folder, "pages"))


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return envelopes.conversation_messages(table(spark, folder, "conversations"))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return envelopes.order_messages(table(spark, folder, "orders"))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return envelopes.line_messages(table(spark, folder, "lineitem"))


def batch_id() -> Column:
    return F.floor(F.col("event_id") / 1000).cast("bigint")


def delivery_log(e: DataFrame) -> DataFrame:
    """Cheap events are committed; every message was rolled back as often as it was backed out."""
    base = ["queueName", "messageIdHex"]
    commits = e.filter(F.col("value") < 25).select(
        *base, (F.col("backoutCount") + 1).alias("attempt"), F.lit("COMMIT").alias("outcome"),
        F.col("receivedAt").alias("ts"), batch_id().alias("batchId"),
    )
    rollbacks = e.filter(F.col("backoutCount") > 0).select(
        *base, F.explode(F.sequence(F.lit(1), F.col("backoutCount"))).alias("attempt"),
        F.lit("ROLLBACK").alias("outcome"), F.col("receivedAt").alias("ts"), batch_id().alias("batchId"),
    )
    return commits.unionByName(rollbacks)


def failures(e: DataFrame) -> DataFrame:
    """Every event as one failed attempt, over eight errors and twelve reason codes."""
    key = F.col("event_id")
    return e.select(
        "queueName",
        "messageIdHex",
        pick(ERROR_CLASSES, key % 8).alias("errorClass"),
        pick(ERROR_TEXTS, key % 8).alias("message"),
        pick(REASON_CODES, key % 12).alias("reasonCode"),
        F.when(key % 3 > 0, (key % 3).cast("int")).alias("completionCode"),
        (key % 5 + 1).cast("int").alias("attempt"),
        F.col("receivedAt").alias("ts"),
    )


def polls(e: DataFrame) -> DataFrame:
    """One poll per queue and hour, empty hours included."""
    hour = F.floor(F.unix_millis("timestamp") / HOUR_MS)
    counts = e.groupBy("queueName", hour.alias("hour")).agg(F.count("*").alias("n"))
    hours = counts.groupBy("queueName").agg(F.explode(F.sequence(F.min("hour"), F.max("hour"))).alias("hour"))
    n = F.coalesce("n", F.lit(0))
    return hours.join(counts, ["queueName", "hour"], "left").select(
        "queueName", n.alias("messageCount"), (n * 10).alias("durationMs"),
        F.timestamp_millis(F.col("hour") * HOUR_MS).alias("ts"),
    )


def connections(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as connection attempts: one queue manager per market segment, overdrawn means refused."""
    return table(spark, folder, "customer").select(
        F.concat(F.lit("QM."), "c_mktsegment").alias("queueManager"),
        (F.col("c_acctbal") >= 0).alias("success"),
        F.timestamp_millis("c_custkey").alias("ts"),
    )


def commands(spark: SparkSession, folder: str) -> DataFrame:
    return commands_of(table(spark, folder, "events"))


def commands_of(rows: DataFrame) -> DataFrame:
    """Each user's events as commands to a connector of that number."""
    value, kind = F.col("value"), F.col("event_type")
    command = (
        F.when(value >= 250, "GRACEFUL_STOP")
        .when(value >= 200, "COMPLETE_DRAIN")
        .when(value >= 150, "DRAIN")
        .when(kind.isin("signup", "purchase"), "PAUSE")
        .when(kind.isin("view", "click"), "RESUME")
        .otherwise("REQUEST_STOP")
    )
    return rows.select(
        F.col("user_id").alias("connectorId"), F.col("event_id").alias("seq"),
        F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("ts"), command.alias("command"),
    )


def tracking(e: DataFrame) -> DataFrame:
    """Messages tracked when put and, unless cheap, completed when received."""
    track = e.select(
        "queueName", "messageIdHex", F.lit("TRACK").alias("action"), F.col("timestamp").alias("ts"),
        (F.col("event_id") * 2).alias("seq"),
    )
    complete = e.filter(F.col("value") >= 10).select(
        "queueName", "messageIdHex", F.lit("COMPLETE").alias("action"), F.col("receivedAt").alias("ts"),
        (F.col("event_id") * 2 + 1).alias("seq"),
    )
    return track.unionByName(complete)


def drain_log(e: DataFrame) -> DataFrame:
    """Every message tracked when put and completed when received; a second after every seventh a drain request."""
    number = F.conv("messageIdHex", 16, 10).cast("bigint")
    log = lambda action, ts, step, timeout: e.select(
        "queueName", "messageIdHex", F.lit(action).alias("action"), ts.alias("ts"),
        (number * 3 + step).alias("seq"), timeout.cast("bigint").alias("timeoutMs"),
    )
    later = F.timestamp_millis(F.unix_millis("timestamp") + 1000)
    asked = log("DRAIN", later, 2, number % 4 * 1000).where(F.pmod(F.col("seq") - 2, F.lit(21)) == 0)
    return log("TRACK", F.col("timestamp"), 0, F.lit(None)).union(log("COMPLETE", F.col("receivedAt"), 1, F.lit(None))).union(asked)


def event_queue_config(spark: SparkSession) -> DataFrame:
    return queue_config(
        spark,
        {"queueName": "QUEUE.CLICK", "batchSize": 100, "parserType": "JSON"},
        {"queueName": "QUEUE.ERROR", "batchSize": 200, "parserType": "TEXT"},
        {"queueName": "QUEUE.PURCHASE", "batchSize": 300, "parserType": "XML"},
        {"queueName": "QUEUE.SIGNUP", "batchSize": 400, "enabled": False},
        {"queueName": "QUEUE.VIEW", "batchSize": 500, "throttleMessagesPerSecond": 2},
    )


def limits(spark: SparkSession, tokens: int) -> DataFrame:
    """Tokens per window for four of the five event queues."""
    rows = [(q, tokens + i) for i, q in enumerate(QUEUES[:-1])]
    return spark.createDataFrame(rows, "queueName string, tokens int")


def flat(df: DataFrame, *names: str) -> DataFrame:
    """Columns in a form every engine compares alike: binaries as hex, times as milliseconds."""
    out = []
    for name in names or df.columns:
        kind = df.schema[name].dataType.typeName()
        column = F.col(name)
        if kind == "binary":
            out.append(F.lower(F.hex(column)).alias(f"{name}Hex"))
        elif kind == "timestamp":
            out.append(F.unix_millis(column).alias(f"{name}Ms"))
        elif kind == "integer":
            out.append(column.cast("bigint").alias(name))
        else:
            out.append(column)
    return df.select(*out)


# The same views as SQL. Short names: q queue, id / corr hex ids, ms / recv_ms times, size bytes.

E = f"""WITH e AS (
  SELECT event_id, user_id, event_type, value,
    'QUEUE.' || upper(event_type) AS q,
    lpad(lower(to_hex(event_id)), 48, '0') AS id,
    lpad(lower(to_hex(user_id)), 48, '0') AS corr,
    props AS body, octet_length(encode(props))::BIGINT AS size,
    epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000 + event_id % 5000 AS recv_ms,
    event_id % 10 AS priority, event_id % 7 AS backout,
    CASE event_id % 4 WHEN 0 THEN 'MQSTR' WHEN 1 THEN 'JSON' WHEN 2 THEN '' ELSE 'XML' END AS fmt,
    event_id % 2 AS persistence, event_id // 1000 AS batch
  FROM events)"""

LOG = E + """, log AS (
  SELECT q, id, backout + 1 AS attempt, 'COMMIT' AS outcome, recv_ms, batch FROM e WHERE value < 25
  UNION ALL
  SELECT q, id, unnest(range(1, backout + 1)), 'ROLLBACK', recv_ms, batch FROM e WHERE backout > 0)"""

_FAILURES = f"""failures AS (
  SELECT q, id, {sql_list(ERROR_CLASSES)}[event_id % 8 + 1] AS class,
    {sql_list(ERROR_TEXTS)}[event_id % 8 + 1] AS message,
    {sql_list(REASON_CODES)}[event_id % 12 + 1] AS reason,
    nullif(event_id % 3, 0) AS completion, event_id % 5 + 1 AS attempt, recv_ms
  FROM e), judged AS (
  SELECT *, coalesce(message, split_part(class, '.', -1)) AS text,
    class LIKE '%ConnectorException' AS own FROM failures), classified AS (
  SELECT *, CASE WHEN own AND contains(lower(text), 'auth') THEN 'Authentication error: '
      WHEN own AND contains(lower(text), 'config') THEN 'Configuration error: '
      WHEN own AND (contains(lower(text), 'parse') OR contains(lower(text), 'invalid format')) THEN 'Parse error: '
      ELSE '' END AS prefix FROM judged), typed AS (
  SELECT *, prefix || text AS why,
    CASE WHEN prefix <> '' OR class IN ('java.lang.IllegalArgumentException', 'java.util.regex.PatternSyntaxException')
      THEN 'PERMANENT' ELSE 'TRANSIENT' END AS kind FROM classified), planned AS (
  SELECT *, kind = 'TRANSIENT' AND attempt <= 3 AS retry,
    least(1000 * pow(2, attempt - 1), 30000)::BIGINT AS delay FROM typed)"""

FAILURES = E + ", " + _FAILURES

_POLLS = """counts AS (SELECT q, ms // 3600000 AS hour, count(*) AS n FROM e GROUP BY ALL),
  hours AS (SELECT q, unnest(range(min(hour), max(hour) + 1)) AS hour FROM counts GROUP BY q),
  polls AS (SELECT q, coalesce(n, 0) AS n, 10 * coalesce(n, 0) AS dur, hour * 3600000 AS ms
    FROM hours LEFT JOIN counts USING (q, hour))"""

POLLS = E + ", " + _POLLS
LOG_FAILURES_POLLS = LOG + ", " + _FAILURES + ", " + _POLLS

CONNECTIONS = """SELECT 'QM.' || c_mktsegment AS qm, c_acctbal >= 0 AS ok, c_custkey AS ms FROM customer"""

CONFIG = """config AS (SELECT * FROM (VALUES
  ('QUEUE.CLICK', 100, 'JSON', true), ('QUEUE.ERROR', 200, 'TEXT', true), ('QUEUE.PURCHASE', 300, 'XML', true),
  ('QUEUE.SIGNUP', 400, 'AUTO', false), ('QUEUE.VIEW', 500, 'AUTO', true)) t(q, n, parser, enabled))"""


def limits_sql(tokens: int) -> str:
    rows = ", ".join(f"('{q}', {tokens + i})" for i, q in enumerate(QUEUES[:-1]))
    return f"limits AS (SELECT * FROM (VALUES {rows}) t(q, tokens))"


DOCS = """WITH d AS (SELECT lpad(lower(to_hex(doc_id)), 48, '0') AS id, 'DOC.' || upper(lang) AS q, text AS body,
  octet_length(encode(text))::BIGINT AS size FROM documents)"""
PAGES = """WITH p AS (SELECT lpad(lower(to_hex(page_id)), 48, '0') AS id, 'PAGE' AS q, html AS body,
  octet_length(encode(html))::BIGINT AS size FROM pages)"""
CHATS = """WITH c AS (SELECT conv_id, turn, lpad(lower(to_hex(conv_id * 1000 + turn)), 48, '0') AS id,
  lpad(lower(to_hex(conv_id)), 48, '0') AS grp, 'CHAT.' || upper(role) AS q, text AS body,
  octet_length(encode(text))::BIGINT AS size FROM conversations)"""
ORDERS = """WITH o AS (SELECT o_orderkey, o_custkey, lpad(lower(to_hex(o_orderkey)), 48, '0') AS id FROM orders)"""
LINES = """WITH l AS (SELECT lpad(lower(to_hex(l_orderkey * 10 + l_linenumber)), 48, '0') AS id, l_partkey, l_suppkey,
  '{"o":' || l_orderkey || ',"l":' || l_linenumber || ',"p":' || l_partkey || '}' AS body FROM lineitem)"""
