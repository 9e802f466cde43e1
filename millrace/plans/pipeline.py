"""A pipeline: one source, several named outputs, each with its writer."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.sources.workspace import materialize

Extract = Callable[[SparkSession], DataFrame]
Transform = Callable[[DataFrame], DataFrame]
Load = Callable[[DataFrame], None]
Validate = Callable[[], dict[str, DataFrame]]


def _observed_write(df: DataFrame, label: str, write: Load) -> int:
    """Rows written, counted by the write itself instead of by a second job.

    The count sits in the writing stage, where a repeated task is counted once.
    """
    seen = Observation(label)
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def discard(df: DataFrame) -> None:
    """Run the plan and keep nothing: the writer of a dry run."""
    df.write.format("noop").mode("overwrite").save()


@dataclass
class Pipeline:
    """Fan-out: every transform gets the extracted rows, and its output goes to the loader
    of the same name.  Loaders run in the order of the transforms, so name parents first.
    Rows of the outputs named in ``rejects`` count as errors.
    """

    spark: SparkSession
    extract: Extract
    transforms: Mapping[str, Transform]
    loaders: Mapping[str, Load]
    validate: Validate = dict
    rejects: Collection[str] = ()
    stats: dict[str, int] = field(default_factory=dict)

    def run(self, dry_run: bool = False) -> dict[str, int]:
        if set(self.transforms) != set(self.loaders):
            raise ValueError(
                f"transforms {sorted(self.transforms)} and loaders {sorted(self.loaders)} differ"
            )
        # The raw text is parsed once, however many outputs read it.
        seen = Observation("extracted")
        staged = materialize(self.extract(self.spark).observe(seen, F.count(F.lit(1)).alias("n")), "extracted")
        self.stats = {"extracted": seen.get["n"], "transformed": 0, "loaded": 0, "errors": 0}
        for name, transform in self.transforms.items():
            output = transform(staged)
            write = discard if dry_run else self.loaders[name]
            rows = _observed_write(output, name, write)
            self.stats[name] = rows
            self.stats["transformed"] += rows
            self.stats["errors"] += rows if name in self.rejects else 0
            if not dry_run:
                self.stats["loaded"] += rows
        return self.stats

    def validated(self, dry_run: bool = False) -> dict[str, DataFrame]:
        """The validation frames; a dry run has nothing to validate."""
        return {} if dry_run else self.validate()
