"""Builds that read only what changed.

``LoanStore`` keeps mergeable partials of every loan family (wide sums with their weighted triples, segments, scores)
by source file. An update finds the files whose checksum, rows or build fingerprint differ, reads these alone,
replaces their partials and drops those of files that are gone; the cube is made from partials of all files, as a full
build makes it from the loans.

``TransitionStore`` carries what a new month needs of the months before it: each loan's state in the last month
and its cohorts that are still open, at most twelve months of them. A month is joined with that frontier alone; what
happened is added to the sums of the months before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as C
from ..functions import scalars as S
from . import cube, release, transitions
from .parts import Parts, digests


def totals(loans: DataFrame) -> DataFrame:
    return cube.loan_partials(loans)


def segments(loans: DataFrame) -> DataFrame:
    active = loans.where(cube.is_active_loan())
    return cube.segments(active, cube.loan_dimensions(), "current_upb_cents", by=("source_file", "report_period"), more=cube.score_members())


FAMILIES: dict[str, Callable[[DataFrame], DataFrame]] = {"totals": totals, "segments": segments}


class LoanStore:
    """Partials of loans below ``root``; ``fingerprint`` is of whatever the partials depend on besides the loans."""

    def __init__(self, spark: SparkSession, root: str, fingerprint: str, after: Callable[[str], None] = lambda step: None):
        self.spark, self.fingerprint = spark, fingerprint
        self.parts = {f: Parts(spark, f"{root}/{f}", after) for f in FAMILIES}
        self.sources = Parts(spark, f"{root}/sources", after)

    def stale(self, manifest: DataFrame) -> DataFrame:
        """Files to build again; ``manifest``: source_file, checksum, rows."""
        built = self.sources.listed().select(F.col("part").alias("source_file"), "checksum", "rows", "fingerprint")
        return release.stale(manifest.select("source_file", "checksum", "rows"), built, self.fingerprint)

    def update(self, manifest: DataFrame, loans_of: Callable[[list[str]], DataFrame]) -> list[str]:
        """Brings the partials up to ``manifest`` (source_file, checksum, rows); ``loans_of`` reads the loans of some files.

        The names of the files that were read. A file whose loans are not as many as its manifest says stops the update
        before anything changes. The families are committed one by one, the list of sources last: after a crash between
        them the same files are stale, and are built again."""
        changed = sorted(r.source_file for r in self.stale(manifest).select("source_file").distinct().collect())  # a row for each file
        present = {r.source_file for r in manifest.select("source_file").collect()}
        gone = sorted(r.part for r in self.sources.listed().select("part").collect() if r.part not in present)
        if not changed and not gone:
            return []
        if not changed:
            for parts in (*self.parts.values(), self.sources):
                parts.commit_list(None, gone)
            return []
        wanted = manifest.where(F.col("source_file").isin(changed)).select(F.col("source_file").alias("part"), "rows", "checksum")
        loans = loans_of(changed)
        sums = totals(loans)
        made = {f: (sums if f == "totals" else make(loans)).withColumnRenamed("source_file", "part") for f, make in FAMILIES.items()}
        for f, frame in made.items():
            staged = release.staged(frame, f"{self.parts[f].root}/building")
            if f == "totals":
                counted = staged.groupBy("part").agg(F.sum("rows").alias("found"))
                short = wanted.join(counted, "part", "left").where("not (rows <=> coalesce(found, 0))").orderBy("part").first()
                if short is not None:
                    raise release.CheckFailed(f"{short.part} has {short.found or 0} loans of {short.rows}")
            known = digests(staged)
            expected = wanted.select("part", "checksum").join(known, "part", "left").select("part", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "digest", "checksum")
            self.parts[f].commit(staged, expected, gone, self.fingerprint)
        self.sources.commit_list(wanted.select("part", "rows", "checksum"), gone, self.fingerprint)
        return changed

    def partials(self, family: str) -> DataFrame:
        found = self.parts[family].read()
        if found is None:
            raise FileNotFoundError("nothing was built yet")
        return found.withColumnRenamed("part", "source_file")

    def cube(self, only=None) -> DataFrame:
        """All that is derived from loans of the latest view, transitions apart."""
        wide = cube.consolidated(self.partials("totals"))
        by = self.partials("segments").groupBy("report_period", "dimension", "contract", "member").agg(F.sum("n").alias("n"), F.sum("upb").cast(C.WIDE).alias("upb"))
        base = cube.union([cube.loan_totals(wide), cube._segment_rows(by, "latest", "loan-period")])
        return cube.union([base, cube.top_n(base), cube.hhi(base), cube.threshold_rates(base), cube.modification_rate(base)])


# ---- transitions

_STATE = "struct<active:boolean,upb:long,days:long,modified:boolean>"
FRONTIER = [*transitions.KEY, "month", *C.VIEWS, "open"]
_OPEN = "array<struct<view:string,kind:string,month:int,upb:long>>"
HAPPENED = ["correction_view", "kind", "report_period", "origin", "result"]


def _month_of(loans: DataFrame) -> int | None:
    low, high = loans.agg(F.min("report_period"), F.max("report_period")).first()
    if low != high:
        raise ValueError(f"one month at a time, not {low} to {high}")
    return None if low is None else int(low[:4]) * 12 + int(low[5:7])


def _name_of(month: int) -> str:
    return f"{(month - 1) // 12:04d}-{(month - 1) % 12 + 1:02d}"


class TransitionStore:
    """The frontier and the sums of what happened, by month, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, threshold: int = transitions.THRESHOLD, window: int = transitions.WINDOW, after: Callable[[str], None] = lambda step: None):
        self.spark, self.threshold, self.window = spark, threshold, window
        self.frontiers, self.sums = Parts(spark, f"{root}/frontier", after), Parts(spark, f"{root}/happened", after)

    def month(self) -> int | None:
        """The last month that is in."""
        last = self.frontiers.listed().agg(F.max("part")).first()[0]
        return None if last is None else int(last[:4]) * 12 + int(last[5:7])

    def start(self, loans: DataFrame) -> None:
        """From a whole history: what happened until its last month, and the frontier there."""
        last = loans.agg(F.max("report_period")).first()[0]
        month = int(last[:4]) * 12 + int(last[5:7])
        states = release.staged(transitions.histories(loans, to_store=True, whole=True), f"{self.frontiers.root}/building")  # read twice
        each = transitions.followed(states, C.VIEWS, self.threshold, self.window, upto=month)
        open_ = F.filter(
            F.array(*(F.when(c & (F.col(f"status_{v}") == "open"), F.struct(F.lit(v).alias("view"), F.lit(k).alias("kind"), F.col("month").cast("int").alias("month"), F.col(v)["upb"].cast("long").alias("upb"))) for v in C.VIEWS for k, c in transitions.triggers(v, self.threshold).items())),
            lambda c: c.isNotNull(),
        )
        # A loan's cohorts of the last months beside its state in the last one: one aggregate of what was shuffled by loan already.
        now = F.max(F.when(F.col("month") == month, F.struct(*C.VIEWS)))
        frontier = each.where(F.col("month") > month - self.window).groupBy(*transitions.KEY).agg(now.alias("now"), F.flatten(F.collect_list(open_)).alias("open")).where("now is not null")
        frontier = frontier.select(*transitions.KEY, F.lit(month).cast("int").alias("month"), *(F.col("now")[v].cast(_STATE).alias(v) for v in C.VIEWS), F.col("open").cast(_OPEN).alias("open"))
        happened = transitions.happenings(loans, threshold=self.threshold, window=self.window, upto=month, states=states).where("result != 'open'")
        self._commit(last, happened.select(*HAPPENED, "n", F.col("upb").cast(C.WIDE).alias("upb")), frontier)

    def advance(self, loans: DataFrame) -> None:
        """Adds the loans of one month, later than all that are in; a month that is in already is done again.

        Only the frontier of the month before it and these loans are read."""
        month = _month_of(loans)
        if month is None:
            return
        name, before = _name_of(month), _name_of(month - 1)
        last = self.month()
        if last is not None and last > month:
            raise ValueError(f"{name} comes after {_name_of(last)}: go back with rewind first")
        if last == month:
            self.rewind(month)
            last = self.month()
        now = transitions.histories(loans, to_store=True).select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(transitions.KEY)), *(F.col(v).cast(_STATE).alias(f"now_{v}") for v in C.VIEWS))
        prior = self.frontiers.read([_name_of(last)]) if last is not None else None
        if prior is None:
            prior = self.spark.createDataFrame([], ", ".join([*(f"{k} string" for k in transitions.KEY), "month int", *(f"{v} {_STATE}" for v in C.VIEWS), f"open {_OPEN}"]))
        same = None
        for i, k in enumerate(transitions.KEY):
            here = F.col(k).eqNullSafe(F.col(f"k{i}"))
            same = here if same is None else same & here
        both = prior.drop("part").withColumn("was", F.lit(True)).join(now.withColumn("is", F.lit(True)), same, "full")
        adjacent = F.lit(last is not None and last == month - 1)
        was, came = F.coalesce("was", F.lit(False)), F.coalesce("is", F.lit(False))
        rows, begun, kept = [], [], []
        for v in C.VIEWS:
            old, new = F.col(v), F.col(f"now_{v}")
            gone = ~came | ~F.coalesce(new["active"], F.lit(False)) | new["days"].isNull()
            moved = adjacent & was & F.coalesce(old["active"], F.lit(False)) & old["days"].isNotNull()
            result = F.when(gone, "Attrition").otherwise(S.delinquency_band(new["days"]))
            rows.append(F.array(F.when(moved, _happened(v, "transition", F.lit(month), S.delinquency_band(old["days"]), result, old["upb"]))))
            ended, open_, own_ = self._judged(v, month, ~adjacent | gone, new["days"])
            rows.append(F.transform(F.filter(F.coalesce("open", F.array().cast(_OPEN)), own_), ended))
            kept.append(F.filter(F.filter(F.coalesce("open", F.array().cast(_OPEN)), own_), open_))
            for kind, starts in self._starts(old, new, adjacent & was).items():
                begun.append(F.when(came & starts, F.struct(F.lit(v).alias("view"), F.lit(kind).alias("kind"), F.lit(month).cast("int").alias("month"), new["upb"].alias("upb"))))
        each = both.select(F.explode(F.concat(*rows)).alias("r")).where("r is not null").select("r.*")
        happened = each.groupBy("correction_view", "kind", "month", "origin", "result").agg(F.count("*").alias("n"), F.sum(S.wide(F.col("upb"))).cast(C.WIDE).alias("upb"))
        happened = happened.select("correction_view", "kind", transitions._period(F.col("month")).alias("report_period"), "origin", "result", "n", "upb")
        opened = F.concat(*kept, F.filter(F.array(*begun), lambda c: c.isNotNull())).cast(_OPEN)
        frontier = both.where(came).select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(transitions.KEY)), F.lit(month).cast("int").alias("month"), *(F.col(f"now_{v}").alias(v) for v in C.VIEWS), opened.alias("open"))
        self._commit(name, happened, frontier)

    def _judged(self, view: str, month: int, cut: Column, days: Column):
        """For one view's cohorts: the row of one that ends in ``month`` (null otherwise), whether one stays open, and whose it is."""

        def status(c: Column) -> Column:
            return F.when(cut, "censored").when(days >= self.threshold, "redefault").when(month - c["month"] >= self.window, "complete").otherwise("open")

        row = lambda c: _happened(view, c["kind"], c["month"], F.lit(""), status(c), c["upb"])
        return lambda c: F.when(status(c) != "open", row(c)), lambda c: status(c) == "open", lambda c: c["view"] == view

    def _starts(self, old, new, near) -> dict:
        both = near & F.coalesce(new["active"], F.lit(False)) & F.coalesce(old["active"], F.lit(False))
        cure = (old["days"] >= self.threshold) & (new["days"] == 0)
        return {"cure": F.coalesce(both & cure, F.lit(False)), "modification": F.coalesce(both & ~old["modified"] & new["modified"], F.lit(False))}

    def _commit(self, name: str, happened: DataFrame, frontier: DataFrame) -> None:
        """Sums first: until the frontier is there, the month counts as not in, and is done again."""
        for parts, frame in ((self.sums, happened), (self.frontiers, frontier)):
            staged = release.staged(frame.withColumn("part", F.lit(name)), f"{parts.root}/building")
            known = digests(staged)
            expected = self.spark.createDataFrame([(name,)], "part string").join(known, "part", "left").select("part", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "digest")
            parts.commit(staged, expected)

    def rewind(self, month: int) -> None:
        """Forgets ``month`` and all later ones, as when a month before comes again: advance through them once more."""
        for parts in (self.frontiers, self.sums):
            later = [r.part for r in parts.listed().where(F.col("part") >= _name_of(month)).select("part").collect()]
            if later:
                parts.commit_list(None, later)

    def happened(self) -> DataFrame:
        """What ``transitions.happenings`` gives of all months that are in: sums, and the open cohorts as censored ones."""
        last = self.month()
        if last is None:
            raise FileNotFoundError("no month is in")
        sums = self.sums.read([r.part for r in self.sums.listed().where(F.col("part") <= _name_of(last)).select("part").collect()])
        opened = self.frontiers.read([_name_of(last)])
        out = None if sums is None else sums.select(*HAPPENED, "n", "upb")
        if opened is not None:
            c = opened.select(F.explode("open").alias("c")).groupBy("c.view", "c.kind", "c.month").agg(F.count("*").alias("n"), F.sum(S.wide(F.col("c.upb"))).cast(C.WIDE).alias("upb"))
            c = c.select(F.col("view").alias("correction_view"), "kind", transitions._period(F.col("month")).alias("report_period"), F.lit("").alias("origin"), F.lit("censored").alias("result"), "n", "upb")
            out = c if out is None else out.unionByName(c)
        return out.groupBy(*HAPPENED).agg(F.sum("n").alias("n"), F.sum("upb").cast(C.WIDE).alias("upb"))

    def cube(self, periods: DataFrame) -> DataFrame:
        """Both transition contracts; ``periods``: report_period of all months that have loans."""
        happened = self.happened()
        counts = happened.where("kind = 'transition'")
        return cube.union([transitions.roll_cure(counts), transitions.new_delinquency(counts), transitions.cohort_rows(happened.where("kind != 'transition'"), periods)])


def _happened(view, kind, month, origin, result, upb):
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(F.lit(view).alias("correction_view"), kind.alias("kind"), month.cast("int").alias("month"), origin.alias("origin"), result.alias("result"), upb.alias("upb"))
