"""Input tables of the registered queries, derived from the given parquet tables.

Each has a twin of the same name in ``oracles.py``. Timestamps stay without a zone. All
run over whole tables; a modulo below only decides how a row looks (bad, deleted, delivered
twice, damaged in the copy), as the given tables hold no such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import micros, parse_tags
from tidemark.jobs import store as st
from tidemark.operators import deadletter, mutate
from tidemark.operators.change import MAPPING_ERROR, rejected, judged
from tidemark.schemas import LEDGER, RECORD
from tidemark.session import pin_utc, shared_dir
from tidemark.sources import numbered, page_plan
from tidemark.sources.tables import parquet_table

# Fixed values shared with the SQL side.
PAGE_ROWS = 500
CURSOR_AT, CURSOR_ID = "1997-01-01 00:00:00", 5
CURSOR_MICROS = 852_076_800_000_000
NOW_MICROS = 915_148_800_000_000  # 1999-01-01
HOUR_MICROS = 3_600_000_000


TABLES = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
}


# Where an application has stored the rows of an input folder.
_STORED: dict[tuple[str, str], str] = {}


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = pin_utc(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        """A given table, with the columns used here. A stated schema saves the job that
        would read it off a file."""
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def rec(self) -> DataFrame:
        """One source row per order."""
        return (
            self.table("orders")
            .join(self.table("customer"), F.expr("c_custkey = o_custkey"))
            .join(self.table("nation"), F.expr("n_nationkey = c_nationkey"))
            .join(self.table("region"), F.expr("r_regionkey = n_regionkey"))
            .selectExpr(
                "*", "o_orderdate + make_dt_interval(CAST(o_orderkey % 3 AS INT)) AS changed_at"
            )
            .selectExpr(
                "o_orderkey + 1 AS id",
                "concat('ext-', o_orderkey + 1) AS external_id",
                "c_name AS name",
                "lower(concat(c_name, '.', o_orderkey, '@example.com')) AS email",
                "c_mktsegment AS company",
                "r_name AS city",
                "n_name AS country",
                "CASE o_orderstatus WHEN 'F' THEN 'inactive' WHEN 'O' THEN 'active' "
                "ELSE 'pending' END AS status",
                "concat('{', lower(c_mktsegment), ',', lower(substr(o_orderpriority, 3)), '}') "
                "AS tags_literal",
                "CASE WHEN o_orderkey % 97 = 5 THEN 'N/A' "
                "ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS amount",
                "CAST(1 + o_orderkey % 3 AS INT) AS version",
                "o_orderdate AS created_at",
                "changed_at AS updated_at",
                "CASE WHEN o_orderkey % 11 = 7 THEN changed_at END AS deleted_at",
            )
        )

    def stored(self) -> DataFrame:
        """The rows as a table of files, so that cursors reach the scan as pushed filters.

        Written once per application.
        """
        rows, key = self.rec(), (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _STORED:
            path = shared_dir(self.spark, "rec")
            rows.write.parquet(path)
            _STORED[key] = path
        return parquet_table(self.spark, _STORED[key], rows.schema)

    def records(self) -> DataFrame:
        """``rec`` in the library's record schema, as the jobs read it."""
        rec = self.rec().withColumn("tags", parse_tags(F.col("tags_literal")))
        return rec.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD.fields])

    def feed(self) -> DataFrame:
        """Every version of every row, delivered by both workers."""
        rec = self.rec()
        versions = rec.withColumn("v", F.explode(F.sequence(F.lit(1), F.col("version"))))
        last = F.col("v") == F.col("version")
        both = F.array(F.lit("backfill"), F.lit("incremental"))
        return versions.select(
            "id",
            F.col("v").alias("version"),
            (F.col("updated_at") - F.make_dt_interval(F.col("version") - F.col("v"))).alias("updated_at"),
            F.when(last, F.col("status")).otherwise("pending").alias("status"),
            F.when(last, F.col("amount")).otherwise("0.00").alias("amount"),
            F.when(last, F.col("deleted_at")).alias("deleted_at"),
            F.explode(both).alias("worker"),
        )

    def ev(self) -> DataFrame:
        """The event stream: each user is an entity, its events are its versions."""
        slot = F.floor(micros(F.col("ts")) / HOUR_MICROS)
        ranked = numbered(self.table("events"), ["ts", "event_id"], [slot], ["user_id"], "version")
        return ranked.select(
            "event_id",
            F.col("user_id").alias("id"),
            F.col("version").cast("int").alias("version"),
            F.when(F.col("event_type") == "error", "deleted")
            .when(F.col("version") == 1, "created")
            .otherwise("updated")
            .alias("op"),
            F.col("event_type").alias("status"),
            F.col("ts").alias("emitted_at"),
            "value",
        )

    def deliveries(self) -> DataFrame:
        """``ev`` where every other event was delivered twice."""
        times = F.when(F.col("event_id") % 2 == 0, 2).otherwise(1)
        return self.ev().withColumn("delivery", F.explode(F.sequence(F.lit(1), times)))

    def raw_events(self) -> DataFrame:
        """``deliveries`` as JSON texts, some of them broken in different ways."""
        parts = self.deliveries().selectExpr(
            "event_id",
            "delivery",
            "value AS v",
            """concat('{"id":', id, ',"external_id":"ext-', id, '"') AS head""",
            """concat(',"version":', version) AS ver""",
            """concat(',"op":"', op, '"') AS oper""",
            """concat(',"data":{"status":"', status, '","country":"',
                      CASE WHEN status = 'signup' THEN '' ELSE concat('NATION_', id % 25) END,
                      '"}') AS body""",
        )
        return parts.selectExpr(
            "event_id",
            "delivery",
            """CASE WHEN v < 2 THEN concat(head, ver, oper, ',"data":{"sta')
                    WHEN v < 3 THEN 'null'
                    WHEN v < 4 THEN concat(head, oper, body, '}')
                    WHEN v < 5 THEN concat(head, ver, oper, '}')
                    ELSE concat(head, ver, oper, body, '}') END AS value""",
        )

    def plan(self) -> DataFrame:
        return page_plan(self.rec(), PAGE_ROWS)

    def ledger(self) -> DataFrame:
        """Committed pages of a backfill that stopped after three fifths of the pages."""
        plan = self.plan()
        pages = F.ceil(F.count(F.lit(1)) / PAGE_ROWS)
        stop = self.rec().agg(F.ceil(pages * 3 / 5)).scalar()
        return plan.where(F.col("page") <= stop).withColumn("mode", F.lit(st.BACKFILL))

    def incremental_ledger(self) -> DataFrame:
        """Committed incremental batches, one per update time before the cursor day."""
        before = F.col("updated_at") < F.lit(CURSOR_AT).cast("timestamp_ntz")
        return (
            self.rec()
            .where(before)
            .groupBy("updated_at")
            .agg(F.max("id").alias("hi_id"), F.count(F.lit(1)).alias("n_rows"))
            .select(
                F.lit(st.INCREMENTAL).alias("mode"),
                micros(F.col("updated_at")).alias("hi_micros"),
                "hi_id",
                "n_rows",
            )
        )

    def status_log(self) -> DataFrame:
        """Reports of the workers and commands of the operator, one per event."""
        kind, command = F.col("event_type"), F.col("event_type").isin("error", "signup")
        return self.table("events").select(
            F.when(F.col("event_id") % 2 == 0, st.BACKFILL).otherwise(st.INCREMENTAL).alias("mode"),
            F.col("event_id").alias("at_micros"),
            F.when(command, st.OPERATOR).otherwise(st.WORKER).alias("actor"),
            F.when(kind == "error", st.PAUSED)
            .when(kind == "click", st.RUNNING)
            .when(kind == "purchase", st.COMPLETED)
            .otherwise(st.IDLE)
            .alias("status"),
        )

    def full_ledger(self) -> DataFrame:
        """Pages, batches and statuses together, in the ledger's schema."""
        pages = self.ledger().withColumn("batch_id", F.col("page"))
        batches = self.incremental_ledger().withColumn("batch_id", F.col("hi_micros"))
        commits = pages.unionByName(batches, allowMissingColumns=True)
        rows = commits.withColumn("kind", F.lit(st.COMMIT)).unionByName(
            self.status_log().withColumn("kind", F.lit(st.STATUS)), allowMissingColumns=True
        )
        return rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in LEDGER.fields
            ]
        )

    def failures(self) -> DataFrame:
        """One rejection per worker for every bad live row, in the dead-letter log's form."""
        bad = rejected(judged(self.rec()))
        seen = F.array(
            F.struct(F.lit("backfill").alias("mode"), F.lit(1).alias("hrs")),
            F.struct(F.lit("incremental").alias("mode"), F.lit(2).alias("hrs")),
        )
        return bad.withColumn("_w", F.explode(seen)).select(
            F.col("id").alias("source_record_id"),
            "external_id",
            F.lit("search").alias("sink"),
            F.col("_w.mode").alias("mode"),
            F.concat("amount", F.lit("@"), "_w.mode").alias("payload"),
            F.concat(F.lit(f"{MAPPING_ERROR}: bad amount "), "amount", F.lit(" in "), "_w.mode").alias("error"),
            (F.col("updated_at") + F.make_dt_interval(hours=F.col("_w.hrs"))).alias("failed_at"),
            F.lit(deadletter.FAILURE).alias("kind"),
            F.col("_w.hrs").cast("long").alias("batch_seq"),
        )

    def dlq(self) -> DataFrame:
        return deadletter.entries(self.failures())

    def repaired(self) -> DataFrame:
        """The source some time later: bad rows were fixed, deleted, dropped or left."""
        bad = (F.col("amount") == "N/A") & F.col("deleted_at").isNull()
        fixed, closed = F.col("status") == "active", F.col("status") == "inactive"
        machinery = F.col("company") == "MACHINERY"
        bumped = bad & fixed & F.col("company").isin("HOUSEHOLD", "BUILDING")
        deleted = bad & closed & ~machinery
        later = F.col("updated_at") + F.make_dt_interval(F.lit(10))
        return (
            self.rec()
            .where(~(bad & closed & machinery))
            .withColumns(
                {
                    "amount": F.when(bad & fixed, "1.00").otherwise(F.col("amount")),
                    "version": F.col("version") + F.when(bumped | deleted, 1).otherwise(0),
                    "updated_at": F.when(bumped | deleted, later).otherwise(F.col("updated_at")),
                    "deleted_at": F.when(deleted, later).otherwise(F.col("deleted_at")),
                }
            )
        )

    def replay_plan(self) -> DataFrame:
        return deadletter.replay_plan(self.dlq(), self.repaired())

    def sink_copy(self) -> DataFrame:
        """A damaged copy of the live rows: some missing, some stale, some extra."""
        live = self.rec().where(F.col("deleted_at").isNull() & (F.col("id") % 47 != 0))
        version = F.when(F.col("id") % 53 == 1, F.col("version") - 1).otherwise(F.col("version"))
        extra = self.rec().where(F.col("id") % 1009 == 0)
        return live.select("id", version.cast("int").alias("version")).unionByName(
            extra.select((-F.col("id")).alias("id"), F.lit(1).alias("version"))
        )

    def sink_contents(self) -> DataFrame:
        """The same damage with contents; some rows of an equal version differ in a field."""
        damaged = self.sink_copy().withColumnRenamed("version", "held")
        live = self.rec().where("deleted_at IS NULL").select("id", "status", "amount", "updated_at")
        rows = damaged.join(live, "id", "left")
        other = F.when(F.col("id") % 59 == 2, None).when(F.col("id") % 61 == 3, "gone").otherwise(F.col("status"))
        return rows.select("id", F.col("held").alias("version"), other.alias("status"), "amount", "updated_at")

    def samples(self) -> DataFrame:
        """Throughput samples every 4 s, the two modes in turn."""
        return self.table("events").select(
            F.when(F.col("event_id") % 2 == 0, "backfill").otherwise("incremental").alias("mode"),
            (F.col("event_id") * 4000).alias("t_ms"),
            (1 + F.col("event_id") % 500).alias("n"),
        )

    def changes(self) -> DataFrame:
        """Changes to orders, read off all their lines: some lines update their order, with
        or without values, some delete it, some insert it again; each customer adds a row
        of its own, under a negative id."""
        at = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
        line, flag, seq = F.col("l_linenumber"), F.col("l_returnflag"), F.col("seq")
        # An order has a handful of lines; all columns make their order unique.
        order = """l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax
        l_returnflag l_linestatus l_shipdate""".split()
        lines = self.table("lineitem").withColumn(
            "seq", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))
        )
        by_line = lines.select(
            (F.col("l_orderkey") + 1).alias("id"),
            seq.cast("long").alias("seq"),
            F.when(flag.isin("R", "N"), mutate.UPDATE)
            .when(line >= 4, mutate.DELETE)
            .otherwise(mutate.INSERT)
            .alias("kind"),
            (at + F.make_dt_interval(hours=seq)).alias("changed_at"),
            F.when((flag != "N") & (line % 2 == 0), F.lit("pending")).alias("status"),
            F.when(flag != "N", F.col("l_quantity").cast("decimal(12,2)").cast("string")).alias("amount"),
        )
        key = F.col("c_custkey")
        steps = F.array(F.lit(mutate.UPDATE), F.lit(mutate.INSERT), F.lit(mutate.UPDATE))
        by_customer = (
            self.table("customer")
            .select(key, "c_acctbal", F.posexplode(steps).alias("step", "kind"))
            .select(
                (-1 - key).alias("id"),
                F.col("step").cast("long").alias("seq"),
                "kind",
                (at + F.make_dt_interval(hours=F.col("step"))).alias("changed_at"),
                F.lit("active").alias("status"),
                F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("amount"),
            )
        )
        return by_line.unionByName(by_customer)
