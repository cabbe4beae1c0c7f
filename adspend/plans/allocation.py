"""The whole daily run: campaign frame -> claimed keys -> phases -> ledger.

Plan shape (see README): the only large inputs are today's clicks and the
click-to-batch links of their id range. They are reduced in one aggregation
(``click_facts``) and joined to the eligible campaigns. Everything after that is a
projection of one row per campaign, so the stages add no exchange. The ledger is
exploded once at the end and replaces the folder of the target date.

A stored ledger of the target date can be given as ``existing``: its rows close their keys
to the scenarios (but stage 0, which does not look) and take part in all later phases. Rows
of campaigns that are not eligible stay and get the updates only.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspend.functions.spend import let, next_day, session_cached
from adspend.operators import feeds, ledger
from adspend.operators.candidates import (
    campaign_frame, candidate_array, claimed_spend, claimed_step, ledger_entry,
)
from adspend.operators.eligibility import salted_user_join
from adspend.operators.facts import FEED_PRICES, campaign_policy_flags, price_tag, user_policy_flags
from adspend.params import FEED_ID_BY_PRICE, MAIN_PUBLISHER, PARTNER_PUBLISHER, SCENARIO_ORDER, AllocParams
from adspend.schemas import LEDGER
from adspend.sources.tables import AdInputs

Predicate = Callable[[Column], Column]


@dataclass(frozen=True)
class Phase:
    name: str
    apply: Callable[[Column], Column]
    # entries this phase wrote or changed, tested right after it ran
    touched: Predicate
    # report lines of an update: entries that it matches, tested before it runs; none: inserts
    matched: tuple[tuple[str, Predicate], ...] = ()

    def lines(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.matched) or (self.name,)

    def counts(self, before: Column, after: Column) -> list[Column]:
        """Rows inserted or matched, one number per report line."""
        return [F.size(F.filter(before, pred)) for _, pred in self.matched] or [F.size(after) - F.size(before)]


def _step(n: int) -> Predicate:
    return lambda x: x.step_num == n


PHASES: tuple[Phase, ...] = (
    Phase("stage_12", ledger.premium_rollup, _step(12)),
    Phase("stage_13", ledger.premium_zero, _step(13), (("stage_13", ledger.is_premium_zero),)),
    Phase("stage_14", ledger.premium_uncapped, _step(14)),
    Phase("stage_15", ledger.premium_capped, _step(15)),
    Phase("stage_16", ledger.premium_boost, _step(16), (("stage_16", ledger.is_boosted),)),
    Phase("stage_10", ledger.exclusions, _step(10), (("stage_10", ledger.is_excluded),)),
    Phase("stage_11", ledger.inclusions, _step(11)),
    Phase("feed_ids", feeds.feed_ids, lambda x: x.job_export_feed_id.isNotNull(), (("feed_ids", feeds.is_priced),)),
    Phase("active_flags", feeds.active_flags, lambda x: x.active_flag == 1,
          tuple((f"active_flags_{k}", feeds.is_live_on(k)) for k in FEED_ID_BY_PRICE.values())),
    Phase("stage_601", feeds.partner_rollup, _step(601)),
    Phase("partner_feed_ids", feeds.partner_feed_ids,
          lambda x: (x.publisher_id == PARTNER_PUBLISHER) & x.job_export_feed_id.isNotNull(),
          (("partner_feed_ids", feeds.is_partner),)),
    Phase("partner_active_flags", feeds.partner_active_flags,
          lambda x: (x.publisher_id == PARTNER_PUBLISHER) & (x.active_flag == 1),
          (("partner_active_flags", feeds.is_live_partner),)),
)
PHASE_NAMES = tuple(p.name for p in PHASES)
# every line of the run report, in run order
REPORT_LINES = tuple(f"stage_{s:02d}" for s in SCENARIO_ORDER) + tuple(n for p in PHASES for n in p.lines())

# Columns of the campaign frame the phases read.
_PHASE_INPUTS = ("camp_id", "user_id", "system_daily_budget", "cost_today", "cost_per_click", "eligible")
_FLAG_PREFIXES = ("user_premium", "user_exclude", "user_include", "camp_premium", "camp_exclude", "camp_include")


def _entry_type() -> str:
    return ("array<struct<publisher_id: bigint, publisher_cpc: double, target_spend: double, step_num: int, "
            "job_export_feed_id: int, active_flag: int>>")


def _with_stored(inputs: AdInputs, params: AllocParams, frame: DataFrame, existing: DataFrame) -> DataFrame:
    """The frame with the campaign's ledger rows of the target date (``stored``), and a row for
    each other campaign that has such rows."""
    e = F.struct("publisher_id", "publisher_cpc", "target_spend", "step_num", "job_export_feed_id", "active_flag")
    rows = existing.filter(F.col("date_date") == next_day(params.run_date))
    stored = rows.groupBy("camp_id").agg(F.collect_list(e).cast(_entry_type()).alias("stored"))
    inside = frame.join(stored, "camp_id", "left")
    flags = (campaign_policy_flags(inputs).withColumnRenamed("id", "camp_id"))
    outside = (stored.join(frame.select("camp_id"), "camp_id", "left_anti")
               .join(inputs.campaigns.select("camp_id", "user_id", "system_daily_budget", "cost_today", "cost_per_click"), "camp_id", "left"))
    outside = salted_user_join(outside, user_policy_flags(inputs), inputs, params, "left").join(flags, "camp_id", "left")
    outside = outside.select(*[F.coalesce(F.col(c), F.lit(False)).alias(c) if c.startswith(_FLAG_PREFIXES) else c for c in outside.columns])
    return inside.unionByName(outside.withColumn("eligible", F.lit(False)), allowMissingColumns=True)


def scenario_frame(inputs: AdInputs, params: AllocParams, frame: DataFrame | None = None,
                   existing: DataFrame | None = None) -> DataFrame:
    """Campaign rows with ``claimed`` (rows of stages 0-9 after key exclusion) and ``entries``
    (stored rows, then those). The claims are plain CASE columns of two projections."""
    frame = frame if frame is not None else campaign_frame(inputs, params)
    frame = _with_stored(inputs, params, frame, existing) if existing is not None else frame.withColumn("stored", F.lit(None))
    stored = F.coalesce(F.col("stored").cast(_entry_type()), F.array().cast(_entry_type()))
    main = F.filter(stored, lambda x: x.publisher_id == MAIN_PUBLISHER) if existing is not None else stored
    frame = frame.withColumns({"stored": stored, "stored_prices": F.transform(main, lambda x: x.publisher_cpc)
                               if existing is not None else F.array().cast("array<double>")})
    steps = {f"step_{price_tag(p)}": p for p in FEED_PRICES}
    frame = frame.withColumns({name: claimed_step(p) for name, p in steps.items()})
    flags = [c for c in frame.columns if c.startswith(_FLAG_PREFIXES)]
    slots = [F.when(F.col(name).isNotNull(), ledger_entry(MAIN_PUBLISHER, p, claimed_spend(p, name), F.col(name)))
             for name, p in steps.items()]
    frame = frame.select(*_PHASE_INPUTS, *flags, "stored", F.array_compact(F.array(*slots)).cast(_entry_type()).alias("claimed"))
    return frame.withColumn("entries", F.concat("stored", "claimed") if existing is not None else F.col("claimed"))


@session_cached
def phased_entries(upto: str | None = None) -> Column:
    """``entries`` after the phases up to and including ``upto`` (all if None).

    Phases nest as ``let`` bindings, so the array each phase reads is computed
    once per row, and the whole chain is one projection. The array functions are
    interpreted, over the few entries of one campaign.
    """
    expr = F.col("entries")
    for phase in PHASES:
        expr = let(expr, phase.apply)
        if phase.name == upto:
            break
    return expr


@session_cached
def _touched(name: str) -> Column:
    phase = next(p for p in PHASES if p.name == name)
    return F.filter(phased_entries(name), phase.touched)


@session_cached
def _run() -> Column:
    """All phases with what each did: a struct of the final entries and of counts, in the
    order of the report lines after the scenarios."""
    state = F.struct(F.col("entries").alias("entries"), F.array().cast("array<int>").alias("counts"))
    for phase in PHASES:
        def step(s: Column, phase: Phase = phase) -> Column:
            return let(phase.apply(s.entries), lambda after: F.struct(
                after.alias("entries"), F.concat(s.counts, F.array(*phase.counts(s.entries, after))).alias("counts")))
        state = let(state, step)
    return state


def run_with_counts(scenarios: DataFrame) -> DataFrame:
    """``camp_id``, the final ``entries``, and one column of numbers per report line."""
    ran = scenarios.select("camp_id", "claimed", _run().alias("ran"))
    claimed = {f"stage_{s:02d}": F.size(F.filter("claimed", _step(s))) for s in SCENARIO_ORDER}
    later = {name: F.col("ran.counts")[i] for i, name in enumerate(REPORT_LINES[len(claimed):])}
    return ran.select("camp_id", F.col("ran.entries").alias("entries"), *[c.alias(n) for n, c in (claimed | later).items()])


def _totals() -> list[Column]:
    return [F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in REPORT_LINES]


def run_phases(scenarios: DataFrame, upto: str | None = None, snapshot: str | None = None) -> DataFrame:
    """Apply the phases in run order up to ``upto``. With ``snapshot`` (= ``upto``),
    the entries that phase wrote or changed are returned as ``touched``."""
    if snapshot is not None:
        if snapshot != upto:
            raise ValueError("snapshot must name the last phase run")
        return scenarios.withColumn("touched", _touched(snapshot))
    return scenarios.withColumn("entries", phased_entries(upto))


def entries_to_rows(df: DataFrame, column: str, params: AllocParams, *keep: str) -> DataFrame:
    """Explode an entry array into ledger rows of the target date (and the columns ``keep``).

    ``explode_outer`` and a filter of the exploded row: a plain explode would make the
    optimizer test the size of the array below, and work the whole array out for that too.
    """
    e = F.col("e")
    return (df.select("camp_id", *keep, F.explode_outer(column).alias("e")).filter(e.isNotNull())
            .select(next_day(params.run_date).alias("date_date"),
                    e.publisher_id.alias("publisher_id"), e.publisher_cpc.alias("publisher_cpc"),
                    F.col("camp_id"), F.coalesce(e.target_spend, F.lit(0.0)).alias("target_spend"),
                    e.step_num.alias("step_num"), e.job_export_feed_id.alias("job_export_feed_id"),
                    e.active_flag.alias("active_flag"), *keep))


def _ledger_columns(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields])


def allocate(inputs: AdInputs, params: AllocParams, existing: DataFrame | None = None) -> DataFrame:
    """The final ledger of the target date (schema ``LEDGER``)."""
    scenarios = scenario_frame(inputs, params, existing=existing)
    return _ledger_columns(entries_to_rows(run_phases(scenarios), "entries", params))


def scenario_ledger(inputs: AdInputs, params: AllocParams, *keep: str) -> DataFrame:
    """Ledger after stages 0-9 and key exclusion (before the premium phases)."""
    return entries_to_rows(scenario_frame(inputs, params), "entries", params, *keep)


def scenario_candidates(inputs: AdInputs, params: AllocParams, step: int) -> DataFrame:
    """Rows one scenario proposes, before key exclusion."""
    frame = campaign_frame(inputs, params)
    rows = frame.select("camp_id", candidate_array((step,)).alias("cands"))
    return entries_to_rows(rows, "cands", params).select(
        "date_date", "publisher_id", "publisher_cpc", "camp_id", "target_spend", "step_num")


def phase_rows(inputs: AdInputs, params: AllocParams, name: str, existing: DataFrame | None = None) -> DataFrame:
    """Rows a later phase inserted or updated, with their values right after it."""
    df = run_phases(scenario_frame(inputs, params, existing=existing), upto=name, snapshot=name)
    return entries_to_rows(df, "touched", params)


def stage_row_counts(inputs: AdInputs, params: AllocParams, existing: DataFrame | None = None) -> DataFrame:
    """The run report: ``phase, rows`` with the rows each scenario inserted after key exclusion
    and each later phase inserted or updated."""
    totals = run_with_counts(scenario_frame(inputs, params, existing=existing)).agg(*_totals())
    lines = F.array(*[F.struct(F.lit(n).alias("phase"), F.col(n).alias("rows")) for n in REPORT_LINES])
    return totals.select(F.explode(lines).alias("x")).select("x.phase", "x.rows")


def write_ledger(ledger_rows: DataFrame, path: str, fmt: str = "parquet", target_date: _dt.date | None = None) -> None:
    """Replace the target date's folder; other dates stay.

    The rows are staged beside the folders and take the place of a date's earlier rows when the
    whole job has ended well (Spark's dynamic partition overwrite): a run that fails in a task
    leaves the earlier rows as they are. With ``target_date`` all rows are of that date; if there
    are none the date's folder is emptied, after the job. Without it the dates that the rows have
    are replaced, and none if there are no rows.
    """
    from pyspark.sql import Observation

    def replace_dates(rows: DataFrame) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date_date").format(fmt).save(path))

    if target_date is None:
        replace_dates(ledger_rows)
        return
    written = Observation()
    rows = ledger_rows.withColumn("date_date", F.lit(target_date))
    replace_dates(rows.observe(written, F.count(F.lit(1)).alias("n")))
    if not written.get.get("n"):
        day = f"{path.rstrip('/')}/date_date={target_date.isoformat()}"
        nothing = ledger_rows.sparkSession.createDataFrame([], rows.schema)
        nothing.drop("date_date").coalesce(1).write.mode("overwrite").format(fmt).save(day)


def run_daily(spark, inputs: AdInputs, params: AllocParams, ledger_path: str,
              checkpoint: bool = True, existing: DataFrame | None = None, check: bool = True) -> dict[str, int]:
    """The production run: allocate, replace the target date's folder, report counts.

    * Raises, and writes nothing, on repeated keys and on policy rows that no rule reads
      (``sources.tables.check_inputs``, over the key columns only); ``check=False`` leaves that out
      for inputs that were checked at the load.
    * Stops without writing when no advertiser has a usable vertical (the ledger
      of the day is left as it is), like the reference's guard.
    * With ``checkpoint``, the campaign frame (one row per eligible campaign, the
      result of the click and account shuffles) is checkpointed into the session's
      checkpoint folder. Losing an executor after that point does not re-run the
      click rollups.
    * The run starts from an empty day. ``existing`` (``sources.tables.read_ledger``) starts it
      from stored rows instead: they are kept, with the duplicates that stages 0 and 12 add
      because they do not look at existing keys. The rows are checkpointed first, so they may
      come from the folder that is replaced; this needs ``checkpoint``.
    * Returns rows per report line, counted by an ``Observation`` during the write itself
      (no second pass over the ledger).
    """
    from pyspark.sql import Observation

    from adspend.operators.eligibility import eligible_advertisers
    from adspend.session import ensure_checkpoint_dir
    from adspend.sources.tables import check_inputs

    if existing is not None and not checkpoint:
        raise ValueError("a run over an existing ledger needs checkpoint=True")
    if check:
        check_inputs(inputs)
    if eligible_advertisers(inputs, params).isEmpty():
        return {}
    frame = campaign_frame(inputs, params)
    if checkpoint:
        ensure_checkpoint_dir(spark)
        frame = frame.checkpoint(eager=True)
        existing = existing.checkpoint(eager=True) if existing is not None else None
    report = Observation("allocation_phases")
    ran = run_with_counts(scenario_frame(inputs, params, frame, existing)).observe(report, *_totals())
    write_ledger(_ledger_columns(entries_to_rows(ran, "entries", params)), ledger_path, target_date=params.target_date)
    return {name: int(n) for name, n in report.get.items()}
