"""Scans, sinks and incremental control."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import adapters as A
from ..sources import scan, scratch, sinks
from ..sources.partitions import PartitionedTable
from ..streaming import incremental as I
from ..streaming.changes import follow
from ..operators import volume as V
from ..operators.commits import commit_cadence
from .base import on_hits, on_orders, query


@query("scan_table", "select * from nation")
def _(spark, d):
    return scan.scan_table(spark, f"{d}/nation.parquet")


@query("scan_pruned", "select o_orderkey, o_orderstatus from orders")
def _(spark, d):
    return scan.scan_pruned(A.table(spark, d, "orders"), ["o_orderkey", "o_orderstatus"])


@on_hits("schema_contract", "select hit_id, hit_date, rsid from hits")
def _(h):
    need = ["hit_id", "hit_date", "rsid"]
    return scan.schema_contract(h, need).select(*need)


@on_hits("column_policy", "select hit_date, hit_id, language from hits")
def _(h):
    cols = scan.column_policy(h.columns, ["hit_date", "hit_id", "hit_date"], ["language", "absent", "mcvisid"],
                              sensitive=["mcvisid"])
    return h.select(*cols)


@on_hits("watermark", "select cast(max(hit_date) as string) as watermark from hits")
def _(h):
    return I.watermark(h, "hit_date")


@query("freshness_gate", """select (select cast(max(hit_date) as string) from hits) as source_watermark,
    (select cast(max(hit_date) as string) from phits where hit_date < date '2024-01-20') as target_watermark,
    (select max(hit_date) from hits) > (select max(hit_date) from phits where hit_date < date '2024-01-20') as new_data""")
def _(spark, d):
    target = A.page_hits(spark, d).where("hit_date < date '2024-01-20'")
    return I.freshness_gate(A.event_hits(spark, d), target, "hit_date")


def _by_day(h, label):
    """The hits' ids as a table with a folder a day."""
    path = scratch.scratch_path(h.sparkSession, label)
    h.select("hit_id", "hit_date").hint("rebalance", "hit_date").write.partitionBy("hit_date").parquet(path)
    return PartitionedTable(h.sparkSession, path)


@on_hits("watermark_partitions", """select cast(max(hit_date) as string) as watermark, cast(min(hit_date) as string) as earliest,
    count(distinct hit_date) as days from hits""")
def _(h):
    t = _by_day(h, "by-day")
    days = F.lit(len(t.values("hit_date") - {None})).cast("long").alias("days")
    return t.extremes("hit_date").select(F.col("last").cast("string").alias("watermark"), F.col("first").cast("string").alias("earliest"), days)


@on_hits("freshness_partitions", """select cast(max(hit_date) as string) as source_watermark,
    cast(max(case when hit_date < date '2024-01-20' then hit_date end) as string) as target_watermark,
    max(hit_date) > max(case when hit_date < date '2024-01-20' then hit_date end) as new_data from hits""")
def _(h):
    """Both sides of the gate from folder names."""
    return I.freshness_gate(_by_day(h, "gate-source"), _by_day(h.where("hit_date < date '2024-01-20'"), "gate-target"), "hit_date")


@on_hits("windows_partitions", """select (select cast(max(hit_date) - 3 as date) from hits) as ingest_start,
    (select cast(date_trunc('month', max(hit_date)) - interval 1 month as date) from hits) as month_start,
    (select count(*) from hits where hit_date >= (select max(hit_date) - 5 from hits)) as trailing_hits""")
def _(h):
    """Ingest, month and trailing windows over one table by day."""
    t = _by_day(h, "windows")
    trailing = V.trailing_window(t, "hit_date", 5).agg(F.count(F.lit(1)).alias("trailing_hits"))
    return trailing.select(I.ingest_window(t, "hit_date", 3, "2024-01-01").scalar().alias("ingest_start"),
                           V.month_window(t, "hit_date", 1).select("start").scalar().alias("month_start"), "trailing_hits")


@on_hits("ingest_window", "select cast(max(hit_date) - 3 as date) as start from hits")
def _(h):
    return I.ingest_window(h, "hit_date", 3, "2024-01-01")


@on_hits("in_window", "select hit_id, hit_date from hits where hit_date >= (select max(hit_date) - 5 from hits)")
def _(h):
    return I.in_window(h, "hit_date", I.ingest_window(h, "hit_date", 5, "2024-01-01")).select("hit_id", "hit_date")


@on_hits("partition_pred", "select hit_id from hits where hit_date between date '2024-01-10' and date '2024-01-12'")
def _(h):
    return h.where(I.partition_pred(h, "hit_date", "2024-01-10", "2024-01-12")).select("hit_id")


@on_orders("dry_run_window", """select date '1998-02-01' as start, date '1998-02-28' as end, count(*) as hits from ohits
    where hit_date between date '1998-02-01' and date '1998-02-28'""")
def _(o):
    w = I.dry_run_window(o, "1998-02", "1995-01-01", "2001-12-31")
    lo, hi = w.select("start").scalar(), w.select("end").scalar()
    hits = o.where(F.col("hit_date").between(lo, hi)).agg(F.count(F.lit(1)).alias("hits"))
    return hits.select(lo.alias("start"), hi.alias("end"), "hits")


@on_hits("windowed_overwrite", """select hit_date, count(*) as hits, round(sum(case when hit_date >= date '2024-01-20' then 2 * amount else amount end), 4) as amount
    from hits where hit_date <> date '2024-01-25' group by 1""")
def _(h):
    """Load, then replace the window with changed rows in which one day became empty."""
    spark, path = h.sparkSession, scratch.scratch_path(h.sparkSession, "windowed")
    rows = h.select("hit_id", "amount", "hit_date")
    sinks.windowed_overwrite(rows, path, "hit_date", "2024-01-01")
    changed = rows.where("hit_date <> date '2024-01-25'").withColumn("amount", F.col("amount") * 2)
    sinks.windowed_overwrite(changed, path, "hit_date", "2024-01-20")
    return spark.read.parquet(path).groupBy("hit_date").agg(
        F.count(F.lit(1)).alias("hits"), F.round(F.sum("amount"), 4).alias("amount"))


@on_hits("days_overwrite", """select hit_date, count(*) as hits, round(sum(case when hit_date in (date '2024-01-03', date '2024-01-17') then 2 * amount else amount end), 4) as amount
    from hits where hit_date <> date '2024-01-25' group by 1""")
def _(h):
    """Replace three days that lie apart, one of which has become empty."""
    spark, path = h.sparkSession, scratch.scratch_path(h.sparkSession, "days")
    rows = h.select("hit_id", "amount", "hit_date")
    sinks.windowed_overwrite(rows, path, "hit_date", "2024-01-01")
    changed = rows.where("hit_date <> date '2024-01-25'").withColumn("amount", F.col("amount") * 2)
    sinks.days_overwrite(changed, path, "hit_date", ["2024-01-17", "2024-01-25", "2024-01-03"])
    return spark.read.parquet(path).groupBy("hit_date").agg(F.count(F.lit(1)).alias("hits"), F.round(F.sum("amount"), 4).alias("amount"))


@on_hits("late_days", "select hit_date, count(*) as hits, round(sum(amount), 4) as amount from hits group by 1")
def _(h):
    """A table kept up by the days that got new files: most hits, then late ones of old days, then nothing new."""
    spark, base = h.sparkSession, scratch.scratch_path(h.sparkSession, "late")
    rows = h.select("hit_id", "amount", "hit_date")
    late = (F.col("hit_date") < F.lit("2024-01-10").cast("date")) & (F.col("hit_id") % 5 == 0)

    def process(days, number):
        source = spark.read.parquet(f"{base}/source")
        sinks.days_overwrite(source.groupBy("hit_date").agg(F.count(F.lit(1)).alias("hits"), F.round(F.sum("amount"), 4).alias("amount")), f"{base}/daily", "hit_date", days)

    for part in (rows.where(~late), rows.where(late), None):
        if part is not None:
            part.hint("rebalance", "hit_date").write.mode("append").partitionBy("hit_date").parquet(f"{base}/source")
        follow(spark, f"{base}/source", "hit_date", f"{base}/seen", process)
    return spark.read.parquet(f"{base}/daily").select("hit_date", "hits", "amount")


@on_hits("rundate_overwrite", """select run_date, rsid, n * case when run_date = date '2024-02-02' then 10 else 1 end as n
    from (select rsid, count(*) as n from hits group by 1), (select unnest([date '2024-02-01', date '2024-02-02']) as run_date)""")
def _(h):
    spark, path = h.sparkSession, scratch.scratch_path(h.sparkSession, "rundate")
    n = h.groupBy("rsid").agg(F.count(F.lit(1)).alias("n"))
    sinks.rundate_overwrite(n, path, "2024-02-01")
    sinks.rundate_overwrite(n, path, "2024-02-02")
    sinks.rundate_overwrite(n.withColumn("n", F.col("n") * 10), path, "2024-02-02")
    return spark.read.parquet(path).select("run_date", "rsid", "n")


@on_hits("full_overwrite", "select language, count(*) as n from hits group by 1")
def _(h):
    spark, path = h.sparkSession, scratch.scratch_path(h.sparkSession, "full")
    sinks.full_overwrite(h.select("hit_id", "rsid"), path)
    sinks.full_overwrite(h.groupBy("language").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.parquet(path)


@on_hits("append_meta", """select 'run1' as run_id, count(*) as n, cast(null as string) as note from hits
    union all select 'run2', count(*), 'more columns' from hits""")
def _(h):
    spark, path = h.sparkSession, scratch.scratch_path(h.sparkSession, "meta")
    n = h.agg(F.count(F.lit(1)).alias("n"))
    sinks.append_meta(n.select(F.lit("run1").alias("run_id"), "n"), path)
    sinks.append_meta(n.select(F.lit("run2").alias("run_id"), "n", F.lit("more columns").alias("note")), path)
    return sinks.read_merged(spark, path).select("run_id", "n", "note")


@on_orders("upsert_preserve", """select hit_id as anomaly_id, case when language = 'F' then 'closed' else 'open' end as status,
    language = 'F' as reconciled, case when language = 'P' then 3.0::double when language = 'O' then 2.0 else 1.0 end as score
    from ohits""")
def _(o):
    """First load F and O rows (analysts close F), then upsert O and P rows."""
    spark, path = o.sparkSession, scratch.scratch_path(o.sparkSession, "upsert")

    def rows(where, score, status, done):
        return o.where(where).select(F.col("hit_id").alias("anomaly_id"), F.expr(status).alias("status"),
                                     F.expr(done).alias("reconciled"), F.expr(score).alias("score"))
    sinks.upsert_preserve(rows("language in ('F', 'O')", "1.0D", "case when language = 'F' then 'closed' else 'open' end",
                               "language = 'F'"), path)
    sinks.upsert_preserve(rows("language in ('O', 'P')", "case when language = 'P' then 3.0D else 2.0D end", "'open'", "false"), path)
    return spark.read.parquet(path)


@on_orders("upsert_by_month", """select hit_id as anomaly_id, case when language = 'F' then 'closed' else 'open' end as status, language = 'F' as reconciled,
    case when hit_date >= date '1997-01-01' and language <> 'F' then 2.0::double else 1.0 end as score, (year(hit_date) * 100 + month(hit_date))::int as month from ohits""")
def _(o):
    """All rows first, of which analysts close F; then new scores for the later months only."""
    spark, path = o.sparkSession, scratch.scratch_path(o.sparkSession, "upsert-months")

    def rows(df, score, status, done):
        return df.select(F.col("hit_id").alias("anomaly_id"), F.expr(status).alias("status"), F.expr(done).alias("reconciled"), F.expr(score).alias("score"),
                         F.expr("year(hit_date) * 100 + month(hit_date)").alias("month"))
    sinks.upsert_preserve(rows(o, "1.0D", "case when language = 'F' then 'closed' else 'open' end", "language = 'F'"), path, by="month")
    sinks.upsert_preserve(rows(o.where("hit_date >= date '1997-01-01' and language <> 'F'"), "2.0D", "'open'", "false"), path, by="month")
    return spark.read.parquet(path)


@on_hits("slim_export", "select hit_date, language, rsid from hits")
def _(h):
    return sinks.slim_export(h, ["hit_date", "language", "rsid", "language"])


@on_orders("result_sinks", """select fmt, hits, days from (select unnest(['parquet', 'csv', 'json']) as fmt),
    (select count(*) as hits, count(distinct hit_date) as days from ohits)""")
def _(o):
    spark = o.sparkSession
    daily = o.groupBy("hit_date").agg(F.count(F.lit(1)).alias("n"))
    paths = sinks.result_sinks(daily, scratch.scratch_path(spark, "results"))
    schema = "hit_date date, n long"
    back = {"parquet": spark.read.parquet(paths["parquet"]),
            "csv": spark.read.schema(schema).csv(paths["csv"], header=True),
            "json": spark.read.schema(schema).json(paths["json"])}
    out = None
    for fmt, df in back.items():
        row = df.agg(F.sum("n").alias("hits"), F.count("hit_date").alias("days")).select(F.lit(fmt).alias("fmt"), "hits", "days")
        out = row if out is None else out.unionByName(row)
    return out


@on_hits("lookup_scan", """select distinct rsid as event_id, upper(rsid) as label from hits""")
def _(h):
    spark, path = h.sparkSession, scratch.scratch_path(h.sparkSession, "lookup")
    h.select("rsid", F.upper("rsid").alias("l")).distinct().write.csv(path, sep="\t", header=False)
    return scan.lookup_scan(spark, path)


@query("commit_cadence", """select op, commits, round(median_gap_hours, 6) as median_gap_hours, round(min_gap_hours, 6) as min_gap_hours,
    round(max_gap_hours, 6) as max_gap_hours from (select event_type as op, count(*) as commits,
    percentile_disc(0.5) within group (order by gap desc) as median_gap_hours, min(gap) as min_gap_hours, max(gap) as max_gap_hours
    from (select event_type, epoch_us(ts - lag(ts) over (partition by event_type order by ts)) / 3.6e9 as gap from events) group by 1)""")
def _(spark, d):
    out = commit_cadence(A.table(spark, d, "events"), "ts", "event_type", exact=True)
    return out.select("op", "commits", *[F.round(c, 6).alias(c) for c in ("median_gap_hours", "min_gap_hours", "max_gap_hours")])
