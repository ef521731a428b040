"""Claims that exclude each other: leases with an expiry and a fencing number.

Everything that happens to leases is a numbered entry (``sources.manifest``) of one lease table: CLAIM, RENEW, COMMIT,
ROLLBACK. A claim is worked out from the entries up to n and asks for number n + 1. If another one got it, it is worked
out anew, so no two claims ever rest on the same state, and no message has two leases at a time. The ids of a claim are
written before its entry; without the entry they count for nothing.

The number of a CLAIM is its fencing number: later claims have greater ones. Clocks of claimers may differ: time in a
lease table is the latest that any entry has told, and never goes back.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.operators.claim import KEY, QUEUE_ORDER, unread, with_payload
from waybill.operators.ordered import first_n
from waybill.sources.manifest import latest_version, put_entry, read_entries

_ENTRY = "kind string, fence bigint, owner string, lease string, until bigint, at bigint"
_IDS = "queueName string, messageIdHex string, timestamp timestamp, position int, returned int, lease string"
ENTRIES, IDS = "_leases", "ids"


class LeaseLost(RuntimeError):
    """The lease has expired or was ended; its messages may be with somebody else."""


@dataclass(frozen=True)
class Lease:
    root: str
    owner: str
    fence: int
    lease: str
    bound: int

    def ids(self, spark: SparkSession) -> DataFrame:
        """Ids of the lease, with their ``position`` in the claim and how often they were ``returned`` before."""
        found = spark.read.schema(_IDS).parquet(f"{self.root}/{IDS}")
        return found.where(F.col("lease") == self.lease).drop("lease")

    def batch(self, messages: DataFrame) -> DataFrame:
        """The leased messages; every lease of them that ended without a commit counts as a redelivery."""
        rows = with_payload(messages, self.ids(messages.sparkSession), self.bound)
        return rows.withColumn("backoutCount", (F.col("backoutCount") + F.col("returned")).cast("int")).drop("returned")


def leases(spark: SparkSession, root: str, now_ms: int) -> DataFrame:
    """``fence, owner, lease, until, outcome`` of every claim at ``now_ms``, a row each.

    ``outcome`` is COMMIT, ROLLBACK, EXPIRED or HELD.
    """
    return _state(read_entries(spark, f"{root}/{ENTRIES}", _ENTRY), now_ms)


def _state(entries: DataFrame, now_ms: int) -> DataFrame:
    told = entries.agg(F.max("at")).first()[0] or 0
    ended = F.min(F.when(F.col("kind").isin("COMMIT", "ROLLBACK"), F.struct("version", "kind")))
    claims = entries.groupBy("fence").agg(
        F.max(F.when(F.col("kind") == "CLAIM", F.col("owner"))).alias("owner"),
        F.max(F.when(F.col("kind") == "CLAIM", F.col("lease"))).alias("lease"),
        F.max("until").alias("until"),
        ended["kind"].alias("_ended"),
    )
    late = F.col("until") <= max(now_ms, told)
    outcome = F.coalesce(F.col("_ended"), F.when(late, "EXPIRED").otherwise("HELD"))
    return claims.withColumn("outcome", outcome).drop("_ended")


def lease_log(spark: SparkSession, root: str, now_ms: int) -> DataFrame:
    """What happened to every leased message: a delivery log with ``fence``, ``returned`` and the lease's outcome.

    Expired leases read as ROLLBACK, as ``delivery.with_redelivery_count`` and the metrics expect; HELD stays.
    """
    return _log(spark, root, leases(spark, root, now_ms))


def _log(spark: SparkSession, root: str, state: DataFrame) -> DataFrame:
    outcome = F.when(F.col("outcome") == "EXPIRED", "ROLLBACK").otherwise(F.col("outcome"))
    if not state.limit(1).count():
        return spark.createDataFrame([], "queueName string, messageIdHex string, returned int, fence bigint, owner string, outcome string")
    ids = spark.read.schema(_IDS).parquet(f"{root}/{IDS}")
    return ids.join(state, "lease").select(*KEY, "returned", "fence", "owner", outcome.alias("outcome"))


def claim(
    messages: DataFrame, root: str, owner: str, queues: list[str], now_ms: int, lease_ms: int = 60_000, batch_size: int = 1000
) -> Lease | None:
    """Lease the first ``batch_size`` messages of each queue that are neither committed nor leased; None if there are none.

    At ``now_ms + lease_ms`` the lease ends by itself, and its messages are free again.
    """
    if batch_size <= 0 or lease_ms <= 0:
        raise ValueError("batch_size and lease_ms must be positive")
    spark = messages.sparkSession
    wanted = messages.where(F.col("queueName").isin(*queues)).select(*KEY, "timestamp")
    while True:
        entries = read_entries(spark, f"{root}/{ENTRIES}", _ENTRY)
        version = latest_version(entries) + 1
        log = _log(spark, root, _state(entries, now_ms)).where(F.col("queueName").isin(*queues))
        taken = log.where(F.col("outcome").isin("COMMIT", "HELD")).withColumn("outcome", F.lit("COMMIT"))
        picked = first_n(unread(wanted, taken), ["queueName"], QUEUE_ORDER, batch_size)
        returned = log.where(F.col("outcome") == "ROLLBACK").groupBy(*KEY).agg(F.count("*").cast("int").alias("returned"))
        picked = picked.join(returned, KEY, "left").withColumn("returned", F.coalesce("returned", F.lit(0)))
        lease = uuid.uuid4().hex
        ids = picked.select(*KEY, "timestamp", "position", "returned")
        ids.write.parquet(f"{root}/{IDS}/lease={lease}")
        if not spark.read.schema(_IDS).parquet(f"{root}/{IDS}/lease={lease}").limit(1).count():
            return None
        entry = {"kind": "CLAIM", "fence": version, "owner": owner, "lease": lease, "until": now_ms + lease_ms, "at": now_ms}
        if put_entry(spark, f"{root}/{ENTRIES}", version, entry):
            return Lease(root, owner, version, lease, batch_size * len(queues))


def renew(spark: SparkSession, lease: Lease, now_ms: int, lease_ms: int = 60_000) -> None:
    """Hold the lease until ``now_ms + lease_ms``. LeaseLost if it is over."""
    _end(spark, lease, now_ms, {"kind": "RENEW", "until": now_ms + lease_ms})


def commit(spark: SparkSession, lease: Lease, now_ms: int) -> None:
    """The messages are done with for good. LeaseLost if the lease is over; doing it twice is once."""
    _end(spark, lease, now_ms, {"kind": "COMMIT"})


def rollback(spark: SparkSession, lease: Lease, now_ms: int) -> None:
    """The messages are free again, redelivered once more. LeaseLost if the lease is over."""
    _end(spark, lease, now_ms, {"kind": "ROLLBACK"})


def _end(spark: SparkSession, lease: Lease, now_ms: int, entry: dict) -> None:
    folder = f"{lease.root}/{ENTRIES}"
    while True:
        entries = read_entries(spark, folder, _ENTRY)
        row = _state(entries, now_ms).where(F.col("fence") == lease.fence).first()
        if row is None or row["outcome"] not in ("HELD", entry["kind"]):
            raise LeaseLost(f"lease {lease.fence} of {lease.owner}: {row and row['outcome']}")
        if row["outcome"] == entry["kind"]:
            return
        if put_entry(spark, folder, latest_version(entries) + 1, {**entry, "fence": lease.fence, "at": now_ms}):
            return


def overlapping(log: DataFrame) -> DataFrame:
    """Messages that more than one lease holds or has committed: always empty, for audits."""
    live = log.where(F.col("outcome").isin("COMMIT", "HELD"))
    return live.withColumn("holders", F.count("*").over(Window.partitionBy(*KEY))).where(F.col("holders") > 1)
