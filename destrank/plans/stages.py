"""A batch as stages whose results are kept, so that a rerun resumes.

Each stage has a key: a digest of its name and version, its parameters, the
files that it reads and the keys of the stages that it needs. Its result is
written to a folder of its own and then recorded under the key by one small
file that appears at once. A run takes what is recorded and computes the rest:
after a failure it goes on at the first missing stage, and after a change of
one input or parameter it repeats only the stages that depend on it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from destrank.sources import commits
from destrank.sources.versions import Table, write_table

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Stage:
    """``build(spark, tables)`` makes the stage's table from those of ``needs``.

    ``inputs`` are the landed paths that it reads itself, ``params`` any JSON
    value; raise ``version`` when ``build`` computes something else than before.
    """

    name: str
    build: Callable[[SparkSession, Tables], DataFrame]
    needs: Sequence[str] = ()
    inputs: Sequence[str] = ()
    params: object = None
    version: int = 1


@dataclass
class Run:
    """Where every stage's table lies, and which stages this run computed."""

    tables: dict[str, Table] = field(default_factory=dict)
    computed: list[str] = field(default_factory=list)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return self.tables[name].read(spark)

    @property
    def counts(self) -> dict[str, int]:
        return {name: t.rows for name, t in self.tables.items()}


def stage_key(spark: SparkSession, stage: Stage, keys: Mapping[str, str]) -> str:
    told = [stage.name, stage.version, stage.params, [keys[n] for n in stage.needs], list(stage.inputs)]
    told.append(commits.fingerprint(spark, stage.inputs))
    return hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()[:32]


def run_stages(spark: SparkSession, stages: Sequence[Stage], folder: str) -> Run:
    """Runs ``stages``, each after those it needs, with their results in ``folder``.

    Two runs at once may both compute a stage; the one recorded first counts
    for both, so all later stages read the same rows."""
    folder = folder.rstrip("/")
    run, keys = Run(), {}
    for stage in stages:
        if missing := [n for n in stage.needs if n not in keys]:
            raise ValueError(f"stage {stage.name} needs {', '.join(missing)} before it")
        if stage.name in keys:
            raise ValueError(f"two stages named {stage.name}")
        key = keys[stage.name] = stage_key(spark, stage, keys)
        record = f"{folder}/done/{stage.name}-{key}.json"
        if not commits.exists(spark, record):
            needed = {n: run.read(spark, n) for n in stage.needs}
            table = write_table(stage.build(spark, needed), f"{folder}/data/{stage.name}-{key}-{uuid.uuid4().hex}")
            if commits.publish(spark, record, json.dumps(vars(table))):
                run.computed.append(stage.name)
        run.tables[stage.name] = Table(**json.loads(commits.read_text(spark, record)))
    return run
