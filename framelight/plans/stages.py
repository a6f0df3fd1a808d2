"""The pipeline's stages: ranges, inputs, and which ones a resumed run can skip."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

STAGES = ("meta", "extract", "filter", "appearance", "cameras", "ocr", "reference", "enrich", "associate", "aggregate")


@dataclass(frozen=True)
class Settings:
    """What changes relational results."""

    camera_samples_per_scene: int = 5
    ocr_samples_per_sec: float = 2.0
    min_vote_share: float = 0.6
    enrich_iou: float = 0.3
    readability_factor: float = 1.25
    merge_threshold: float = 0.70
    merge_group: int = 3
    reconcile_least: int = 2
    approve_new: bool = True


def stage_range(first: str = STAGES[0], last: str = STAGES[-1]) -> tuple[str, ...]:
    for name in (first, last):
        if name not in STAGES:
            raise ValueError(f"unknown stage {name!r}")
    a, b = STAGES.index(first), STAGES.index(last)
    if a > b:
        raise ValueError(f"from_step {first!r} is after to_step {last!r}")
    return STAGES[a : b + 1]


@dataclass
class Store:
    """Tables by name in a folder that every executor reaches."""

    spark: SparkSession
    path: str
    open_: dict[str, DataFrame] = field(default_factory=dict)

    def has(self, name: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return bool(place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.read(name)


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    makes: str
    run: Callable[..., DataFrame]


def execute(store: Store, stages: list[Stage], resume: bool = False) -> list[str]:
    """Runs the stages in order and returns those that ran; with resume, stages whose table is whole are skipped."""
    ran = []
    for stage in stages:
        missing = [n for n in stage.needs if not store.has(n)]
        if missing:
            raise FileNotFoundError(f"stage {stage.name} needs {', '.join(missing)}")
        if not (resume and store.has(stage.makes)):
            store.write(stage.makes, stage.run(*[store.read(n) for n in stage.needs]))
            ran.append(stage.name)
    return ran
