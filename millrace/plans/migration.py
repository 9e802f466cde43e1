"""The power-plant migration: wide text files to plants and generation tables.

1. stage     parse, blank out missing values, type, check every row rule: one narrow pass
2. plants    one row per natural key, not yet loaded, dense ids, append
3. facts     look up ids on the wide rows, years to rows, one row per plant and year, append
4. validate

Each stage reads what the stage before wrote.  Both tables become visible together, in a
new version, and a load skips keys that are already there, so a run that died can simply be
started again.  Loaded rows are met through an index of their keys, so the cost of a load
follows the delivery.  No row gets lost on the way: the counts of a run add up, for plants
and for figures, to what was extracted.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.contract import GENERATION, GENERATION_YEARS, PLANTS, TABLES, TableContract, text_schema
from millrace.functions.clean import col, null_tokens, quoted
from millrace.operators import stats
from millrace.operators.checks import VIOLATIONS, with_violations
from millrace.operators.keys import (
    orphans,
    settle_copies,
    surrogate_key,
    unique_id,
    unique_violations,
)
from millrace.operators.reshape import (
    figure_years,
    generation_unpivot,
    plants_transform,
    with_reject_reason,
    year_columns,
)
from millrace.plans.pipeline import discard
from millrace.sources.files import RAW_LINE, header_columns
from millrace.sources.records import ragged_reason_sql, text_rows
from millrace.sources.keyindex import digest
from millrace.sources.tables import stamp_new
from millrace.sources.versions import Store, Table, Version
from millrace.sources.workspace import materialize, scratch

NATURAL_KEY = "gppd_idnr"
# Yearly columns that hold no figure.
NOT_FIGURES = ("generation_data_source", "estimated_generation_note")
NOT_RAGGED = "ragged_line IS NULL"


@dataclass
class Migration:
    """Files under ``source`` to ``power_plants`` and ``power_plant_generation`` under ``target``.

    ``source`` may also be a frame of text columns, such as rows a stream has staged.
    What cannot be loaded goes to ``quarantine/*`` there, each run that has such rows in a partition of its own:

    * ``rows``: rows with their problems; one with too many fields or bad quotes keeps its untouched text
    * ``figures``: years that break a rule
    * ``orphans``: figures whose plant is in no table
    * ``copies``: natural keys that occur more than once, with their number of rows
    * ``conflicts``, ``figure_conflicts``: rows that lost against a more complete copy
    * ``changed``, ``changed_figures``: rows that differ from what is loaded under their key

    With ``update`` such rows also replace the loaded ones, whose ids and creation times stay.

    ``metrics`` counts rows: extracted plants are errors + broken + loaded + merged + conflicting
    + known + changed, and extracted figures the same with orphans instead of errors.
    """

    spark: SparkSession
    source: str | DataFrame
    target: str
    encoding: str = "UTF-8"
    update: bool = False
    metrics: dict[str, int] = field(default_factory=dict)
    run_id: str = ""
    _base: Version = field(default_factory=Version, repr=False)
    _tables: dict[str, Table] = field(default_factory=dict, repr=False)

    def path(self, table: str) -> str:
        return f"{self.target.rstrip('/')}/{table}"

    @property
    def store(self) -> Store:
        return Store(self.spark, self.target)

    def table(self, contract: TableContract, version: int | None = None) -> DataFrame:
        """A table as the newest version has it, or the one of that number."""
        return self.store.read(self.store.version(version).table(contract.name), contract.schema)

    def run(self, dry_run: bool = False) -> dict[str, int]:
        """Run all stages; gives the row counts of the run.  Its intermediate tables are deleted at the end."""
        with scratch(self.spark):
            return self._run(dry_run)

    def _run(self, dry_run: bool) -> dict[str, int]:
        self.run_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        seen = Observation("staged")
        typed = self._typed().observe(
            seen,
            F.count(F.lit(1)).alias("plants_extracted"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("errors"),
            F.count_if(F.col("reject_reason").isNull() & ~F.col("loadable")).alias("broken"),
        )
        if dry_run:
            figures = Observation("figures")
            long = generation_unpivot(typed.where(NOT_RAGGED), figure_years(typed.columns) or GENERATION_YEARS)
            discard(long.observe(figures, F.count(F.lit(1)).alias("figures")))
            self.metrics = seen.get | figures.get
            return self.metrics
        staged = materialize(typed, "staged", partition_by=["loadable"])
        self.metrics = dict(seen.get)
        if self.metrics["errors"] + self.metrics["broken"]:
            self._quarantine(staged.where("NOT loadable").drop("loadable"), "rows")
        self._base = self.store.version()
        self._tables = {}
        # Plants that are there already, as far as this delivery names them.
        named = staged.where(NOT_RAGGED).where(col(NATURAL_KEY).isNotNull())
        known = materialize(self.store.lookup(self._base.table(PLANTS.name), named, [NATURAL_KEY]), "known")
        self.metrics["plants_loaded"], new_ids = self._load_plants(staged.where("loadable"), known)
        ids = known.select(NATURAL_KEY, "id").unionByName(new_ids)
        self.metrics["generation_records"] = self._load_generation(staged.where(NOT_RAGGED), ids)
        if any(self._tables[t.name] != self._base.table(t.name) for t in TABLES):
            self.store.commit(self._base, self._tables)
        return self.metrics

    def validate(self) -> dict[str, DataFrame]:
        """Counts, fuel breakdown, and the key rules the tables must keep (empty when they do)."""
        plants, generation = self.table(PLANTS), self.table(GENERATION)
        return {
            "counts": stats.validate_counts(plants, generation),
            "fuel_breakdown": stats.validate_fuel_breakdown(plants),
            "repeated_plants": unique_violations(plants, PLANTS.unique[0]),
            "repeated_years": unique_violations(generation, GENERATION.unique[0]),
            "orphans": orphans(generation, plants, GENERATION.parent[0], GENERATION.parent[2]),
        }

    # -- stages ----------------------------------------------------------------

    def _text(self) -> DataFrame:
        """All-text rows with missing values blanked, and the text of a record that is none."""
        rows = self.source
        if not isinstance(rows, DataFrame):
            columns = header_columns(self.spark, rows, self.encoding)
            rows = text_rows(self.spark, rows, text_schema(columns), self.encoding)
        names = [c for c in rows.columns if c != RAW_LINE]
        line = RAW_LINE if RAW_LINE in rows.columns else "CAST(NULL AS string)"
        return null_tokens(rows, names).selectExpr(*[quoted(c) for c in names], f"{line} AS ragged_line")

    def _typed(self) -> DataFrame:
        """Typed plant columns, the yearly text, and what is wrong with a row."""
        text = self._text()
        carried = [quoted(c) for c in year_columns(text)]
        plants = with_reject_reason(plants_transform(text, extra=[*carried, "ragged_line"]))
        checked = with_violations(plants, PLANTS)
        # Not beside the blanking of the wide row: together they make a method too large for the JIT compiler.
        reason = ragged_reason_sql("ragged_line", len(text.columns) - 1)
        return checked.selectExpr(
            *PLANTS.loaded_columns,
            *carried,
            "ragged_line",
            f"coalesce({reason}, reject_reason) AS reject_reason",
            VIOLATIONS,
            f"ragged_line IS NULL AND reject_reason IS NULL AND size({VIOLATIONS}) = 0 AS loadable",
        )

    def _settle(
        self, rows: DataFrame, contract: TableContract, label: str, conflicts: str, changed: str, known: DataFrame | None = None
    ) -> DataFrame:
        """New rows of the table, one per key; what else there was is counted and quarantined."""
        key = list(contract.unique[0])
        winners, losers, repeated = settle_copies(rows, key)
        lost = 0
        if losers is not None:
            if label == "plants":
                self._quarantine(repeated, "copies")
            lost = self._quarantine_counted(losers, conflicts, "n_rows")
        elif not self._base.table(contract.name).index:
            # Nothing is loaded and no key repeats, so there is nothing to compare with and every row is new.
            self.metrics |= {f"{label}_{fate}": 0 for fate in ("conflicting", "merged", "known", "changed")}
            return winners
        if known is None:
            known = self.store.lookup(self._base.table(contract.name), winners, key)
        held = known.select(*[col(k) for k in key], col("digest").alias("_held"))
        values = [c for c in contract.schema.names if c in contract.loaded_columns and c not in key]
        state = F.when(F.col("_held").isNull(), "new").when(F.col("_held") == digest(values), "known").otherwise("changed")
        compared = winners.join(held, key, "left").withColumn("_state", state).drop("_held")
        compared = materialize(compared, "compared", partition_by=["_state"])
        count = {
            r["_state"]: (r["n"], r["rows"])
            for r in compared.groupBy("_state").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("rows")).collect()
        }
        if "changed" in count:
            differing = compared.where("_state = 'changed'").drop("_state", "copies")
            self._quarantine(differing, changed)
            if self.update:
                base = self._base.table(contract.name)
                self._tables[contract.name], _ = self.store.upserted(
                    contract.name, base, differing, contract.schema, key, contract.partition_by
                )
        total = sum(n for _, n in count.values())
        self.metrics |= {
            f"{label}_conflicting": lost,
            f"{label}_merged": total - sum(n for n, _ in count.values()) - lost,
            f"{label}_known": count.get("known", (0, 0))[0],
            f"{label}_changed": count.get("changed", (0, 0))[0],
        }
        return compared.where("_state = 'new'").drop("_state")

    def _load_plants(self, loadable: DataFrame, known: DataFrame) -> tuple[int, DataFrame]:
        rows = loadable.select(*[col(c) for c in PLANTS.loaded_columns])
        new = self._settle(rows, PLANTS, "plants", "conflicts", "changed", known).drop("copies")
        table = self._base.table(PLANTS.name)
        numbered = surrogate_key(new, [NATURAL_KEY], start_after=table.last_id)
        before = self._tables.get(PLANTS.name, table).folders
        n = self._append(stamp_new(numbered), PLANTS)
        added = Table([f for f in self._tables[PLANTS.name].folders if f not in before])
        return n, self.store.read(added, PLANTS.schema).select(NATURAL_KEY, "id")

    def _load_generation(self, staged: DataFrame, ids: DataFrame) -> int:
        # Ids are looked up on wide rows, which are fewer than the long ones.
        ids = ids.withColumnRenamed("id", "power_plant_id")
        years = figure_years(staged.columns) or GENERATION_YEARS
        figures = [c for c in year_columns(staged) if not c.startswith(NOT_FIGURES)]
        has_text = f"coalesce({', '.join(quoted(c) for c in figures)}) IS NOT NULL" if figures else "false"
        wide = staged.select(col(NATURAL_KEY), *[col(c) for c in year_columns(staged)]).where(has_text)
        long = generation_unpivot(wide.join(ids, NATURAL_KEY, "left"), keep=[NATURAL_KEY, "power_plant_id"], years=years)
        state = f"CASE WHEN power_plant_id IS NULL THEN 'orphan' WHEN size({VIOLATIONS}) > 0 THEN 'broken' ELSE 'good' END"
        seen = Observation("figures")
        checked = with_violations(long, GENERATION).withColumn("_fate", F.expr(state)).observe(
            seen,
            F.count(F.lit(1)).alias("figures_extracted"),
            F.count_if(F.col("_fate") == "orphan").alias("figures_orphaned"),
            F.count_if(F.col("_fate") == "broken").alias("figures_broken"),
        )
        checked = materialize(checked, "figures", partition_by=["_fate"])
        self.metrics |= seen.get
        values = checked.drop("_fate")
        if self.metrics["figures_orphaned"]:
            self._quarantine(values.where(F.col("_fate") == "orphan").drop("power_plant_id", VIOLATIONS), "orphans")
        if self.metrics["figures_broken"]:
            self._quarantine(values.where(F.col("_fate") == "broken"), "figures")
        good = values.where(F.col("_fate") == "good").drop(NATURAL_KEY, VIOLATIONS)
        new = self._settle(good, GENERATION, "figures", "figure_conflicts", "changed_figures").drop("copies")
        return self._append(unique_id(new, start_after=self._base.table(GENERATION.name).last_id), GENERATION)

    def _append(self, df: DataFrame, contract: TableContract) -> int:
        """Write new rows and index their keys; they count from the next version on."""
        table = self._tables.get(contract.name, self._base.table(contract.name))
        key, parts = contract.unique[0], contract.partition_by
        self._tables[contract.name], n = self.store.added(contract.name, table, df, contract.schema, key, parts)
        return n

    def _quarantine(self, df: DataFrame, reason: str) -> None:
        df.write.mode("overwrite").parquet(self.path(f"quarantine/{reason}/run={self.run_id}"))

    def _quarantine_counted(self, df: DataFrame, reason: str, rows: str) -> int:
        written = Observation(reason)
        self._quarantine(df.observe(written, F.coalesce(F.sum(rows), F.lit(0)).alias("n")), reason)
        return written.get["n"]

