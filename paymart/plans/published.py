"""The published warehouse: versioned tables that every session finds, brought up to date load by load (IO13, IO14, R6).

Each table is a ``TableLog`` under ``<root>/<layer>/<name>``.  Tables with rows
of a time are kept by calendar month, a folder version for each month; the
others are written whole.  ``update`` looks at what the raw log has gained
since the last build and rewrites the months that can have changed:

* months of new transactions, and of the 24 hours after each (their trailing
  windows see it);
* months with transactions of users or merchants that are new or changed in
  the dimensions (fact keys, merchant names).

The windows of a month need the 24 hours before it and nothing else, so the
rebuilt months equal those of a full build.  Tables without a month are built
again from the published rows, which are read by column.  The build's own mark
moves last: a build that stops is repeated by the next one.

The reporting views are entries of the catalog (a view's name, its mart and
the time it was generated): ``open_views`` registers them in any session.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.config import DEFAULT, RiskConfig
from paymart.operators import dimensions, enrich, facts, marts, reporting, staging
from paymart.operators.ingest import raw_table, read_current
from paymart.operators.joins import broadcast_if_small
from paymart.operators.table_log import Entry, TableLog, new_version
from paymart.session import prepare

LAYERS = {"int_transactions_enriched": "intermediate", "int_user_metrics": "intermediate"}    # others: marts
MONTHLY = {"int_transactions_enriched": "transaction_ts", "fct_transactions": "transaction_ts",
           "fraud_analysis_mart": "transaction_ts", "velocity_anomaly_detection": "transaction_ts",
           "daily_overview_kpis": "day", "daily_merchant_kpis": "day"}
WHOLE = ("int_user_metrics", "hourly_fraud_trends", "merchant_risk_profiling", "fraud_customer_segments",
         "cohort_analysis")
CATALOG = "entry string, mart string, generated_at timestamp"
NO_TIME = "none"       # partition of rows without a time
RAW_TABLES = ("users", "merchants", "transactions")


class NotPublishedError(LookupError):
    """A table that no build has published under this root."""


def month_of(ts: str) -> F.Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit(NO_TIME))


class Published:
    def __init__(self, spark: SparkSession, root: str, cfg: RiskConfig = DEFAULT):
        self.spark, self.root, self.cfg = prepare(spark), root.rstrip("/"), cfg

    # tables -----------------------------------------------------------------
    def log(self, name: str) -> TableLog:
        return TableLog(self.spark, f"{self.root}/{LAYERS.get(name, 'marts')}/{name}")

    def table(self, name: str, months: set[str] | None = None) -> DataFrame:
        """A published table (or some of its months) as the last finished build left it."""
        rows = self.log(name).read(parts=months)
        if rows is None:
            raise NotPublishedError(f"{name} is not published under {self.root}")
        return rows

    def _write_whole(self, name: str, df: DataFrame) -> str:
        log, version = self.log(name), new_version()
        log.begin()
        df.write.parquet(f"{log.path}/v={version}")
        log.commit(version)
        return version

    def _write_months(self, name: str, df: DataFrame, months: set[str]) -> DataFrame:
        """Replace the given months; the rows just written."""
        log, version = self.log(name), new_version()
        log.begin()
        folder = f"{log.path}/v={version}"
        dealt = df.withColumn("part", month_of(MONTHLY[name])).repartitionByRange("part", MONTHLY[name])
        dealt.write.partitionBy("part").parquet(folder)
        written = self.spark.read.schema(dealt.schema).option("basePath", folder).parquet(folder)
        sizes = {r.part: r["count"] for r in written.groupBy("part").count().collect()}    # a row a month
        log.commit(version, "part", {m: sizes.get(m, 0) for m in months})
        return written.drop("part")

    # what a build has to look at --------------------------------------------
    def _marks(self) -> dict[str, Entry]:
        """What the last finished build has seen: the newest commit (``rows``) of each raw table, and the version of
        each dimension."""
        return {e.part: e for e in TableLog(self.spark, f"{self.root}/marts/_BUILT").live()}

    def _new_commits(self, name: str, seen: int) -> tuple[list[str], int, bool]:
        """(folders since the commit ``seen``, newest commit, was the table started anew since then)."""
        table = raw_table(self.spark, self.root, name)
        lines = table.lines() or []
        newest = max((e.seq for e in lines), default=-1)
        return ([table.folder(e) for e in table.live() if e.seq > seen], newest,
                any(e.kind == "base" and e.seq > seen for e in lines))

    def _months(self, tx: DataFrame) -> set[str]:
        """Months of transactions and of the windows that can see them."""
        later = F.col("transaction_ts") + F.expr(f"interval {max(self.cfg.window_1h_us, self.cfg.window_24h_us)} microseconds")
        both = tx.select(F.explode(F.array("transaction_ts", later)).alias("t")).select(month_of("t").alias("m"))
        return {r.m for r in both.distinct().collect()}                       # bounded by the calendar

    def _months_of_changed(self, name: str, fresh: DataFrame, version: str) -> set[str]:
        """Months with transactions of users that are new, or of merchants that are new or changed, since the
        dimension's given version (a build that stopped may have left a newer one)."""
        key = "user_id" if name == "users" else "merchant_id"
        before = self.spark.read.parquet(f"{self.log(f'dim_{name}').path}/v={version}")
        columns = [key] if name == "users" else [c for c in fresh.columns]
        changed = fresh.select(*columns).join(before.select(*columns), [fresh[c].eqNullSafe(before[c]) for c in columns], "left_anti").select(key)
        rows = self.table("int_transactions_enriched").select(key, "transaction_ts")
        hit = rows.join(broadcast_if_small(changed), key, "left_semi")
        return {r.m for r in hit.select(month_of("transaction_ts").alias("m")).distinct().collect()}

    def _slice(self, tx: DataFrame, months: set[str]) -> DataFrame:
        """Transactions of the months and of the 24 hours before each."""
        reach = dt.timedelta(microseconds=max(self.cfg.window_1h_us, self.cfg.window_24h_us))
        wanted = F.lit(False)
        if NO_TIME in months:
            wanted = F.col("transaction_ts").isNull()
        for m in sorted(months - {NO_TIME}):
            start = dt.datetime.strptime(m, "%Y-%m")
            end = (start + dt.timedelta(days=32)).replace(day=1)
            wanted = wanted | ((F.col("transaction_ts") >= F.lit(start - reach)) & (F.col("transaction_ts") < F.lit(end)))
        return tx.where(wanted)

    # building ---------------------------------------------------------------
    def update(self, run_at: dt.datetime | None = None, full: bool = False) -> dict[str, list[str]]:
        """Bring every table up to date with the raw layer; table -> months written (none: the whole table)."""
        run_at = run_at or dt.datetime.now()
        raw = {n: read_current(self.spark, self.root, n) for n in RAW_TABLES}
        seen = {} if full else self._marks()
        new = {n: self._new_commits(n, seen[n].rows if seen else -1) for n in RAW_TABLES}
        months: set[str] = set()
        if not seen or new["transactions"][2]:
            months = self._months(raw["transactions"]) | self._published_months()
        else:
            if new["transactions"][0]:
                months |= self._months(self.spark.read.schema(raw["transactions"].schema).parquet(*new["transactions"][0]))
            for name in ("users", "merchants"):
                if new[name][1] > seen[name].rows:
                    months |= self._months_of_changed(name, raw[name], seen[f"dim_{name}"].version)
        newest = {n: found[1] for n, found in new.items()}
        return self._build(raw, months, newest, run_at)

    def update_from(self, raw: dict[str, DataFrame], run_at: dt.datetime | None = None) -> dict[str, list[str]]:
        """A full build from given raw tables instead of the root's own."""
        months = self._months(raw["transactions"]) | self._published_months()
        return self._build(raw, months, {n: -1 for n in RAW_TABLES}, run_at or dt.datetime.now())

    def _published_months(self) -> set[str]:
        return {e.part for name in MONTHLY for e in self.log(name).live() if e.part is not None}

    def _build(self, raw: dict[str, DataFrame], months: set[str], newest: dict[str, int],
               run_at: dt.datetime) -> dict[str, list[str]]:
        cfg, done = self.cfg, sorted(months)
        dims = {"dim_users": self._write_whole("dim_users", dimensions.dim_users(raw["users"], run_at.date())),
                "dim_merchants": self._write_whole("dim_merchants",
                                                   dimensions.dim_merchants(raw["merchants"], run_at.date(), cfg))}
        du, dm = self.table("dim_users"), self.table("dim_merchants")
        if months:
            part = enrich.enrich_raw(self._slice(raw["transactions"], months), cfg, run_at)
            inside = month_of("transaction_ts").isin(*done)
            enr = self._write_months("int_transactions_enriched", part.where(inside), months)
            fct = self._write_months("fct_transactions", facts.fct_transactions(enr, du, dm, keys_from_hash=True), months)
            for name, df in (("fraud_analysis_mart", marts.fraud_analysis_mart(fct, dm)),
                             ("velocity_anomaly_detection", marts.velocity_anomaly_detection(enr, cfg, run_at)),
                             ("daily_overview_kpis", marts.daily_overview_kpis(fct)),
                             ("daily_merchant_kpis", marts.daily_merchant_kpis(fct, dm))):
                self._write_months(name, df, months)
        enr, fct = self._all("int_transactions_enriched", raw), self._all("fct_transactions", raw)
        for name, df in (("int_user_metrics", marts.user_metrics(enr, run_at)),
                         ("hourly_fraud_trends", marts.hourly_fraud_trends(enr, run_at)),
                         ("merchant_risk_profiling", marts.merchant_risk_profiling(dm, fct, cfg, run_at)),
                         ("fraud_customer_segments", marts.fraud_customer_segments(fct, du, cfg, run_at)),
                         ("cohort_analysis", marts.cohort_analysis(fct, du, run_at))):
            self._write_whole(name, df)
        built = TableLog(self.spark, f"{self.root}/marts/_BUILT")
        built.begin()
        built.start([Entry(k, "part", "mark", n, seq) for k, (n, seq) in enumerate(newest.items())]
                    + [Entry(len(newest), "part", v, n, 0) for n, v in dims.items()])
        return {name: done for name in MONTHLY} | {name: [] for name in ("dim_users", "dim_merchants", *WHOLE)}

    def _all(self, name: str, raw: dict[str, DataFrame]) -> DataFrame:
        rows = self.log(name).read()
        if rows is not None:
            return rows
        enr = enrich.enrich_transactions(staging.stage_transactions(raw["transactions"].limit(0), self.cfg), self.cfg)
        if name == "int_transactions_enriched":
            return enr
        return facts.fct_transactions(enr, self.table("dim_users"), self.table("dim_merchants"), keys_from_hash=True)

    # views ------------------------------------------------------------------
    def deploy_views(self, run_at: dt.datetime | None = None) -> list[str]:
        """Enter the reporting views in the catalog and check that each opens; a missing mart raises."""
        run_at = run_at or dt.datetime.now()
        rows = []
        for view, (mart, _) in reporting.VIEWS.items():
            if not self.log(mart).live():
                raise reporting.ViewDeployError(f"mart {mart!r} for view {view!r} is missing")
            rows.append((view, mart, run_at))
        log, version = TableLog(self.spark, f"{self.root}/marts/_VIEWS"), new_version()
        log.begin()
        self.spark.createDataFrame(rows, CATALOG).coalesce(1).write.parquet(f"{log.path}/v={version}")
        log.commit(version)
        return self.open_views()

    def open_views(self, prefix: str = "reporting_") -> list[str]:
        """Register the catalog's views in this session, over the published marts; nothing is built."""
        entries = TableLog(self.spark, f"{self.root}/marts/_VIEWS").read(CATALOG)
        if entries is None:
            raise NotPublishedError(f"no reporting views are published under {self.root}")
        names = []
        for e in entries.collect():                                           # a row a view
            _, fn = reporting.VIEWS[e.entry]
            fn(self.table(e.mart), e.generated_at).createOrReplaceTempView(prefix + e.entry)
            names.append(prefix + e.entry)
        missing = [n for n in names if not self.spark.catalog.tableExists(n)]
        if missing:
            raise reporting.ViewDeployError(f"views not found after deploy: {missing}")
        return sorted(names)
