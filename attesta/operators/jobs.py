"""The job queue: a log of events, the views of it, and the worker that serves it.

Nothing in the log is changed; a job's state is its newest event. `at` is the time of an event in microseconds.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attesta.functions import text as X

LOG = "job_id string, arxiv_id string, ip string, status string, stage string, created_at long, at long, seq long, result string, error string"
HOUR = 3600 * 1_000_000


def quota(jobs: DataFrame, who: str, at: str, hours: int = 24) -> DataFrame:
    """jobs with `before`: how many the same client had sent in the hours before each, itself not counted; null without
    a time. A job enters at its time and leaves hours later; the running sum of both is added up from hourly sums, so
    that no task sorts more than one client's hour."""
    span = hours * HOUR
    cols = [F.col(c) for c in jobs.columns]
    own = jobs.withColumn("_us", F.unix_micros(F.col(at).cast("timestamp")))
    moves = F.array(F.struct(F.col("_us").alias("t"), F.lit(1).alias("v")), F.struct((F.col("_us") + span).alias("t"), F.lit(-1).alias("v")))
    m = own.withColumn("_m", F.explode(moves)).withColumn("_t", F.col("_m.t")).withColumn("_v", F.col("_m.v")).withColumn("_h", F.floor(F.col("_t") / HOUR))
    sums = m.groupBy(who, "_h").agg(F.sum("_v").alias("_n"))
    base = sums.withColumn("_base", F.coalesce(F.sum("_n").over(Window.partitionBy(who).orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.sum("_v").over(Window.partitionBy(who, "_h").orderBy("_t").rangeBetween(Window.unboundedPreceding, 0))
    timed = m.withColumn("_in", inside).where("_v = 1").withColumnRenamed(who, "_who").join(base.withColumnRenamed(who, "_client").withColumnRenamed("_h", "_hour"), F.col("_who").eqNullSafe(F.col("_client")) & F.col("_h").eqNullSafe(F.col("_hour")))
    timed = timed.withColumnRenamed("_who", who)
    return timed.select(*cols, F.when(F.col("_us").isNotNull(), F.col("_base") + F.col("_in") - 1).alias("before"))


def latest_done(jobs: DataFrame, key: str, at: str, id_col: str, done: Column, since: Column) -> DataFrame:
    """The newest finished job of each key that is not older than since."""
    good = jobs.where(done & (F.col(at) >= since))
    return good.groupBy(key).agg(F.max_by(id_col, F.struct(at, id_col)).alias("job_id"), F.max(at).alias("created_at"))


def queue(jobs: DataFrame, at: str, queued: Column) -> DataFrame:
    """Waiting jobs with the number created before each; null for one without a time. Ranks are added up from hourly
    counts, so that no task sorts the whole queue."""
    q = jobs.where(queued).withColumn("_hour", F.date_trunc("hour", F.col(at)))
    hours = q.where("_hour is not null").groupBy("_hour").agg(F.count(F.lit(1)).alias("n"))
    base = hours.withColumn("_base", F.coalesce(F.sum("n").over(Window.orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    own = F.rank().over(Window.partitionBy("_hour").orderBy(at)) - 1
    return q.withColumn("_own", own).join(base, "_hour", "left").withColumn("position", F.col("_base") + F.col("_own")).drop("_hour", "_base", "_own")


def admission(valid: Column, reusable: Column, running: Column, sent: Column, limit: int = 5) -> Column:
    """What becomes of a request: the first rule that holds."""
    return F.when(~valid, "invalid").when(reusable, "reuse").when(running, "attach").when(sent >= limit, "over_quota").otherwise("enqueue")


def latest(log: DataFrame) -> DataFrame:
    """The state of each job: what its newest event says."""
    fields = [c for c in log.columns if c != "job_id"]
    return log.groupBy("job_id").agg(F.max_by(F.struct(*fields), F.struct("at", "seq")).alias("s")).select("job_id", *[f"s.{c}" for c in fields])


def recovered(state: DataFrame, now: int) -> DataFrame:
    """Events that put jobs orphaned by a restart back into the queue."""
    return state.where("status = 'running'").withColumns({"status": F.lit("queued"), "stage": F.lit(None).cast("string"), "at": F.lit(now).cast("long"), "seq": F.col("seq") + 1})


def status(state: DataFrame, job_ids: DataFrame) -> DataFrame:
    """job_ids (job_id) with arxiv_id, status, stage, queue_ahead, result of a finished and error of a failed job; all
    null for an unknown one."""
    waiting = queue(state.withColumn("ts", F.timestamp_micros("created_at")), "ts", F.col("status") == "queued").select("job_id", F.col("position").alias("queue_ahead"))
    s = job_ids.join(state, "job_id", "left").join(waiting, "job_id", "left")
    ahead = F.when(F.col("status").isNotNull(), F.coalesce("queue_ahead", F.lit(0).cast("long")))
    return s.select("job_id", "arxiv_id", "status", "stage", ahead.alias("queue_ahead"), F.when(F.col("status") == "done", F.col("result")).alias("result"), F.when(F.col("status") == "error", F.col("error")).alias("error"))


def submitted(state: DataFrame, requests: DataFrame, limit: int = 5, days: int = 7) -> DataFrame:
    """requests (request_id, raw, forwarded, at; one a client and paper at a time) with arxiv_id, decision and job_id: a
    finished job created within days is reused, a waiting or running one attached to, and a client that has sent `limit`
    jobs in 24 hours is refused."""
    r = requests.withColumn("arxiv_id", X.arxiv_id(F.col("raw"))).withColumn("ip", X.client_ip(F.col("forwarded")))
    known = r.select("request_id", "arxiv_id", F.col("at").alias("asked")).join(state.select("arxiv_id", "status", "created_at", "job_id"), "arxiv_id")
    newest = lambda cond: F.max_by(F.when(cond, F.col("job_id")), F.when(cond, F.struct("created_at", "job_id")))
    fresh = (F.col("status") == "done") & (F.col("created_at") > F.col("asked") - days * 24 * HOUR)
    k = known.groupBy("request_id").agg(newest(fresh).alias("reuse"), newest(F.col("status").isin("queued", "running")).alias("attach"))
    sent = r.select("request_id", "ip", F.col("at").alias("asked")).join(state.select("ip", "created_at"), "ip").where((F.col("created_at") > F.col("asked") - 24 * HOUR) & (F.col("created_at") <= F.col("asked")))
    r = r.join(k, "request_id", "left").join(sent.groupBy("request_id").agg(F.count(F.lit(1)).alias("sent")), "request_id", "left")
    d = admission(F.col("arxiv_id").isNotNull(), F.col("reuse").isNotNull(), F.col("attach").isNotNull(), F.coalesce("sent", F.lit(0)), limit)
    job = F.when(F.col("decision") == "reuse", F.col("reuse")).when(F.col("decision") == "attach", F.col("attach")).when(F.col("decision") == "enqueue", F.concat(F.lit("job-"), "request_id"))
    return r.withColumn("decision", d).select("request_id", "arxiv_id", "ip", "at", "decision", job.alias("job_id"))


class Service:
    """One worker over a log in a shared folder: first come, first served. A job that fails does not stop it."""

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], int] = lambda: time.time_ns() // 1000):
        self.spark, self.path, self.clock = spark, path.rstrip("/"), clock

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], LOG)

    def _tell(self, job, **change) -> None:
        row = {**job, **change, "at": self.clock(), "seq": job["seq"] + 1}
        job.update(row)
        self.spark.createDataFrame([tuple(row[f.split()[0]] for f in LOG.split(", "))], LOG).write.mode("append").parquet(self.path)

    def submit(self, raw: str, forwarded: str, limit: int = 5) -> dict:
        now = self.clock()
        ask = self.spark.createDataFrame([(uuid.uuid4().hex[:12], raw, forwarded, now)], "request_id string, raw string, forwarded string, at long")
        got = submitted(latest(self.log()), ask, limit).first()
        if got["decision"] == "enqueue":
            job = {"job_id": got["job_id"], "arxiv_id": got["arxiv_id"], "ip": got["ip"], "status": None, "stage": None, "created_at": now, "at": now, "seq": 0, "result": None, "error": None}
            self._tell(job, status="queued")
        return {"decision": got["decision"], "job_id": got["job_id"]}

    def restart(self) -> None:
        recovered(latest(self.log()), self.clock()).select(*[f.split()[0] for f in LOG.split(", ")]).write.mode("append").parquet(self.path)

    def work(self, check: Callable[[str, Callable[[str], None]], dict]) -> bool:
        """Serves the oldest waiting job; False if there is none. check: from a paper's id and a callback for the stage
        to the result."""
        row = latest(self.log()).where("status = 'queued'").orderBy("created_at", "job_id").first()
        if row is None:
            return False
        job = row.asDict()
        self._tell(job, status="running", stage="starting")
        try:
            result = json.dumps(check(job["arxiv_id"], lambda stage: self._tell(job, stage=stage)))
            self._tell(job, status="done", result=result)
        except Exception as e:  # a failed job must not stop the worker
            self._tell(job, status="error", error=str(e)[:500])
        return True
