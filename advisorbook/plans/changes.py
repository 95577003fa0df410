"""The monthly fact and its report kept up by changes, equal to a full build after each of them.

Three tables, all partitioned by month, hold what a change needs: the live entries, the totals per
(agent, month, customer) and (agent, month, product), and the fact. A change of entries is
taken out and put in; a position whose month-end entry moved adds the difference to both its
totals, negative where money left; the fact's months are folded from the totals again. Months
without a changed entry are not read.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StructType

from advisorbook import fixed_values as fv
from advisorbook.contracts import MONEY
from advisorbook.functions.dates import business_date, month_start
from advisorbook.operators.latest import latest_per_key
from advisorbook.plans.kpis import as_money, kpis_of_totals, position_totals
from advisorbook.plans.performance import performance_rows
from advisorbook.plans.staging import is_active
from advisorbook.session import cut_lineage
from advisorbook.sources.change_log import StagedChange, partition_is
from advisorbook.sources.tables import create_partitioned

MONTH = "month_start_date"
_CARRY = (
    StructType().add("agent_id", LongType()).add(MONTH, DateType()).add("total_aum", DoubleType())
    .add("core_customer_count", LongType()).add("checkpoint", DateType()).add("slot", IntegerType())
)
_POSITION = [MONTH, "agent_id", "customer_id", "product_id"]
_TOTAL = [MONTH, "agent_id", "customer_id", "product_id", "is_product_total"]


def live_entry(get: Callable[[str], Column], money: DataType = MONEY) -> Column:
    """The entry a raw row stands for, NULL where it is deleted or has no balance."""
    day = business_date(get("date"))
    entry = F.struct(
        month_start(day).alias(MONTH),
        get("agent_id").alias("agent_id"),
        get("unit_holder_id").alias("customer_id"),
        get("product_id").alias("product_id"),
        day.alias("portfolio_date"),
        get("id").alias("portfolio_id"),
        as_money(get("ending_balance"), money).alias("ending_balance"),
    )
    return F.when(is_active(get("is_deleted")) & get("ending_balance").isNotNull(), entry)


class MaintainedFact:
    """Names of the three tables and the settings they are built with.

    ``threshold`` and ``money`` belong to the stored rows: after changing one, rebuild.
    """

    def __init__(
        self, spark: SparkSession, entries: str, totals: str, fact: str,
        threshold: int = fv.CORE_CUSTOMER_THRESHOLD, money: DecimalType = MONEY, stamp: Column | None = None,
    ) -> None:
        self.spark, self.entries, self.totals, self.fact = spark, entries, totals, fact
        self.threshold, self.money, self.stamp = threshold, money, stamp

    def _months(self, table: str, schema: StructType, months: list) -> DataFrame:
        if not self.spark.catalog.tableExists(table):
            create_partitioned(self.spark, table, schema, MONTH)
        return self.spark.table(table).filter(partition_is(MONTH, months))

    def _moved(self, feed: DataFrame) -> DataFrame:
        """Entries taken out (``rank`` 1) and put in (2) by a feed of id, before and after."""

        def entry(side: str) -> Column:
            return live_entry(lambda c: F.col("id") if c == "id" else F.col(side)[c], self.money)

        both = feed.select(entry("before").alias("old"), entry("after").alias("new"))
        both = both.filter(~F.col("old").eqNullSafe(F.col("new")))
        sides = F.array(F.struct(F.lit(1).alias("rank"), F.col("old").alias("e")), F.struct(F.lit(2).alias("rank"), F.col("new").alias("e")))
        return both.select(F.inline(sides)).filter(F.col("e").isNotNull()).select("rank", "e.*")

    def _merge_entries(self, moved: DataFrame, months: list, change: StagedChange) -> DataFrame:
        """Stage the entries of the months; returns each id's entry as it is now, what was stored and flags.

        ``_gone``: the entry is taken out. ``_same``: the stored entry stays, and is not told again in ``_was``.
        """
        schema = StructType([f for f in moved.schema if f.name != "rank"])
        stored = self._months(self.entries, schema, months).withColumn("rank", F.lit(0))
        columns = [c for c in schema.names if c not in (MONTH, "portfolio_id")]
        each = stored.unionByName(moved).groupBy(MONTH, "portfolio_id").agg(
            F.max(F.when(F.col("rank") == 0, F.struct(*columns))).alias("was"),
            F.max(F.struct("rank", *columns)).alias("top"),
        )
        gone = F.col("top.rank") == 1
        now = [F.col("top")[c].alias(c) for c in columns]
        each = each.withColumn("_same", ~gone & F.col("was").eqNullSafe(F.struct(*now)))
        flat = each.select(MONTH, "portfolio_id", *now, F.when(~F.col("_same"), F.col("was")).alias("_was"), "_same", gone.alias("_gone"))
        path, merged = change.write(flat)
        # Without entries taken out the files hold just the table's rows, and are not written again.
        if merged.filter("_gone").isEmpty():
            change.stage_written(path, StructType([merged.schema[c] for c in schema.names]), self.entries, MONTH, months)
        else:
            change.stage(merged.filter("NOT _gone").select(*schema.names), self.entries, MONTH, months)
        return merged

    def _differences(self, merged: DataFrame) -> DataFrame:
        """Per position whose month-end entry moved: the change in money and in positions."""
        values = ("agent_id", "customer_id", "product_id", "portfolio_date", "ending_balance")
        here = F.struct(*values)
        was, now = F.when(F.col("_same"), here).otherwise(F.struct(*[F.col("_was")[c].alias(c) for c in values])), F.when(~F.col("_gone"), here)
        was = F.when(F.col("_same") | F.col("_was").isNotNull(), was)
        names = ("agent_id", "customer_id", "product_id", "portfolio_date", "ending_balance")

        def side(number: int, row: Column) -> Column:
            kept = F.struct(*[row[c].alias(c) for c in names])
            return F.struct(F.lit(number).alias("side"), F.when(row.isNotNull(), kept).alias("e"))

        rows = merged.select(MONTH, "portfolio_id", F.inline(F.array(side(0, was), side(1, now)))).filter(F.col("e").isNotNull())
        rows = rows.select(MONTH, "portfolio_id", "side", "e.*")
        last = F.struct("portfolio_date", "portfolio_id", "ending_balance")
        ends = rows.groupBy(*_POSITION).agg(
            F.max(F.when(F.col("side") == 0, last)).alias("was"), F.max(F.when(F.col("side") == 1, last)).alias("now")
        )
        ends = ends.filter(~F.col("was").eqNullSafe(F.col("now")))
        zero = F.lit(0).cast(self.money)
        return ends.select(
            *_POSITION,
            (F.coalesce("now.ending_balance", zero) - F.coalesce("was.ending_balance", zero)).alias("aum"),
            (F.col("now").isNotNull().cast("long") - F.col("was").isNotNull().cast("long")).alias("positions"),
        )

    def apply(
        self, feed: DataFrame, products: DataFrame, change: StagedChange, reclassified: DataFrame | None = None
    ) -> tuple[list, DataFrame | None]:
        """Stage what a feed of changed raw rows (id, before, after) does to the three tables.

        The feed is read twice; it should be stored, as ``LatestTable.merge`` returns it.
        ``reclassified`` names products (``product_id``) whose bucket is another than at the last change.
        Returns the months of the fact that are replaced, and their new rows.
        """
        moved = self._moved(feed)
        months = [r[0] for r in moved.select(MONTH).distinct().collect()]
        again = list(months)
        if reclassified is not None and self.spark.catalog.tableExists(self.totals):
            held = self.spark.table(self.totals).filter("is_product_total = 1").join(reclassified, "product_id", "left_semi")
            again += [r[0] for r in held.select(MONTH).distinct().collect() if r[0] not in months]
        if not again:
            return [], None
        merged = self._merge_entries(moved, months, change)
        differences, sums = self._differences(merged), (F.sum("aum"), F.sum("positions"))

        def told(rows: DataFrame) -> DataFrame:
            return rows.select(*_TOTAL, F.col("aum").cast(DecimalType(38, self.money.scale)), "positions")

        stored = self._months(self.totals, told(position_totals(differences, *sums)).schema, months)
        summed = told(position_totals(differences, *sums, known=stored))
        totals = change.stage(summed.filter("positions != 0"), self.totals, MONTH, months)
        unmoved = [m for m in again if m not in months]
        if unmoved:
            totals = totals.unionByName(self._months(self.totals, totals.schema, unmoved))
        facts = kpis_of_totals(totals, products, self.threshold, self.stamp, stored=True)
        self._months(self.fact, facts.schema, again)
        return again, change.stage(facts, self.fact, MONTH, again)


class MaintainedReport:
    """The report's rows, without names, kept up with the fact.

    Changed months are ranked anew. A change reaches a later month only as the previous month of an
    agent's next present row, so of the later months those rows' are replaced. What came before the
    first changed month is known from ``carry``: each agent's last row before a checkpoint, which moves to
    the first month of each change; the fact is read from the checkpoint on, and wholly only where a
    change lies before it. A NULL month comes last.
    """

    def __init__(self, spark: SparkSession, fact: str, report: str, carry: str) -> None:
        self.spark, self.fact, self.report, self.carry = spark, fact, report, carry

    def _before(self, start: dt.date) -> DataFrame:
        """The last row of each agent before a month."""
        narrow = ["agent_id", MONTH, "total_aum", "core_customer_count"]
        rows = self.spark.table(self.fact).filter(F.col(MONTH) < F.lit(start)).select(*narrow)
        if self.spark.catalog.tableExists(self.carry):
            carried = self.spark.table(self.carry)
            checkpoint = carried.agg(F.min("checkpoint")).first()[0]
            if checkpoint is not None and checkpoint <= start:
                carried = carried.filter(F.col(MONTH).isNotNull()).select(*narrow)
                rows = rows.filter(F.col(MONTH) >= F.lit(checkpoint)).unionByName(carried)
        return cut_lineage(latest_per_key(rows, ["agent_id"], [MONTH]), "report-carry")

    def _reached(self, present: DataFrame, marks: DataFrame) -> list:
        """Months of the next present row behind each changed row."""
        flagged = present.withColumn("here", F.lit(True)).unionByName(marks.withColumn("here", F.lit(False)))
        rows = flagged.groupBy("agent_id", MONTH).agg(F.bool_or("here").alias("here"), F.bool_or(~F.col("here")).alias("mark"))
        later = Window.partitionBy("agent_id").orderBy(F.asc_nulls_last(MONTH)).rowsBetween(1, Window.unboundedFollowing)
        following = F.first(F.when(F.col("here"), F.struct(MONTH)), ignorenulls=True).over(later)
        found = rows.withColumn("following", following).filter(F.col("mark") & F.col("following").isNotNull())
        return [r[0] for r in found.select(f"following.{MONTH}").distinct().collect()]

    def apply(self, months: list, facts: DataFrame | None, change: StagedChange) -> None:
        """Stage the report for a fact whose ``months`` become ``facts``; the fact itself is not swapped yet."""
        if not months:
            return
        known = [m for m in months if m is not None]
        start = min(known, default=dt.date.max)
        if self.spark.catalog.tableExists(self.fact):
            stored = self.spark.table(self.fact).filter((F.col(MONTH) >= F.lit(start)) | F.col(MONTH).isNull())
        else:
            stored = facts.limit(0)
        here = F.coalesce(partition_is(MONTH, months), F.lit(False))
        rows = cut_lineage(stored.filter(~here).unionByName(facts, allowMissingColumns=True), "report-input")
        key = ["agent_id", MONTH]
        marks = cut_lineage(stored.filter(here).select(*key).unionByName(facts.select(*key)).distinct(), "report-marks")
        agents = marks.select(F.col("agent_id").alias("_agent")).distinct()
        present = rows.select(*key).join(agents, F.col("agent_id").eqNullSafe(F.col("_agent")), "left_semi")
        replaced = months + [m for m in self._reached(present, marks) if m not in months]
        before = self._before(start)
        made = performance_rows(cut_lineage(before.unionByName(rows, allowMissingColumns=True), "report-range"))
        kept = made.filter(F.coalesce(partition_is(MONTH, replaced), F.lit(False)))
        for name, schema, by in ((self.report, made.schema, MONTH), (self.carry, _CARRY, "slot")):
            if not self.spark.catalog.tableExists(name):
                create_partitioned(self.spark, name, schema, by)
        change.stage(kept, self.report, MONTH, replaced)
        marker = self.spark.range(1).select(F.lit(None).cast(before.schema["agent_id"].dataType).alias("agent_id"))
        state = before.unionByName(marker, allowMissingColumns=True)
        state = state.withColumns({"checkpoint": F.lit(start), "slot": F.lit(0)})
        change.stage(state.select(*_CARRY.names), self.carry, "slot", [0])
