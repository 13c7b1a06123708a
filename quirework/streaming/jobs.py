"""Remote transcription jobs: a service behind an interface, polled by a state machine with a time limit."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a job's status means.
COPIED, ENDED, FAILED = ("DERIVED_READY",), ("COMPLETED",), ("FAILED", "ERROR")


class Service(Protocol):
    def upload(self, key: str) -> None: ...
    def create(self, metadata: dict, keys: list[str]) -> str: ...
    def status(self, job: str) -> str: ...
    def enqueue(self, job: str) -> None: ...
    def artefacts(self, job: str) -> list[dict]: ...


class JobFailed(RuntimeError):
    pass


def with_steps(steps: list[str]) -> list[str]:
    """The steps with those that they imply: descriptive metadata needs the folio numbers."""
    return list(dict.fromkeys([*(["foliate"] if "metadata" in steps else []), *steps]))


# The fields of a job's metadata that have a default, the modules, the preferences, and the descriptive fields.
FIELDS = {"writing_style": "", "language": "", "time_period": "", "layout_structure": "", "transcription_instructions": "", "non_textual_elements": [], "allow_subject_similarity": False}
MODULES = ("transcription", "captioning", "foliation", "aggregation", "metadata", "ner")
PREFERENCES = {"expand_abbreviations": False, "preserve_line_breaks": True, "retain_punctuation_and_spelling": True, "normalize_to_modern_language": False, "ignore_marginalia": False}
DESCRIPTIVE = ("title", "creator", "subject", "description", "publisher", "contributor", "date", "type", "format", "identifier", "source", "language", "relation", "coverage", "rights")


def metadata(config: dict, title: str, steps: list[str]) -> dict:
    """What a job is created with: the configured fields over their defaults, the models of each module where one is chosen,
    and the descriptive fields with the prompts that the configuration gives them."""
    api = config.get("api", {})
    job, models, wanted, prompts = (api.get(k, {}) for k in ("job", "models", "transcription_preferences", "metadata_schema"))
    out = {"title": title, "steps": with_steps(steps), "instructions": api.get("instructions", "")}
    out |= {k: job.get(k, default) for k, default in FIELDS.items()}
    out |= {f"{m}_model": models.get(m, "") for m in MODULES}
    out["transcription_preferences"] = {k: wanted.get(k, default) for k, default in PREFERENCES.items()}
    out["metadata_schema"] = {k: prompts.get(k, "") for k in DESCRIPTIVE}
    out |= {"additional_context_file": "", "additional_context_modules": [], "foliation_file": "", "delete_data": bool(api.get("delete_data", True))}
    return out | {"foliation_override_discrete": "metadata" in steps and "foliate" not in steps}


def attempt(call: Callable[[], None], tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> None:
    """Tries again after 1, 2, 4, 8 ... seconds on server and network faults; a client fault ends at once."""
    for i in range(tries):
        try:
            return call()
        except Exception as e:
            status = getattr(e, "status", None)
            if i == tries - 1 or (status is not None and status < 500):
                raise
            sleep(2.0**i)


TRIES = 5


def retried(log: DataFrame, item: str, order: list[str], failed: Column) -> DataFrame:
    """What became of each item's upload from the outcomes of its tries in order: how many were made, whether one was good,
    and the seconds waited between them (1, 2, 4, 8 ...)."""
    tries = F.row_number().over(Window.partitionBy(item).orderBy(*order))
    rows = log.select(item, tries.alias("i"), failed.alias("failed")).where(F.col("i") <= TRIES)
    out = rows.groupBy(item).agg(F.min(F.when(~F.col("failed"), F.col("i"))).alias("good"), F.max("i").alias("last"))
    made = F.coalesce("good", "last")
    return out.select(item, made.cast("int").alias("tries"), F.col("good").isNotNull().alias("done"), (F.pow(F.lit(2.0), made - 1) - 1).alias("waited"))


def run(service: Service, meta: dict, keys: list[str], poll: float = 5.0, limit: float = 86_400.0, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """Creates a job, waits until its files are copied, starts it, waits for its end, and lists its artefacts."""
    for key in keys:
        attempt(lambda key=key: service.upload(key), sleep=sleep)
    job, waited = service.create(meta, keys), 0.0
    for wanted in (COPIED, ENDED):
        while (status := service.status(job)) not in (*wanted, *ENDED):
            if status in FAILED:
                raise JobFailed(f"job {job}: {status}")
            if waited >= limit:
                raise TimeoutError(f"job {job} still {status} after {waited:.0f} s")
            sleep(poll)
            waited += poll
        if wanted is COPIED and status not in ENDED:
            service.enqueue(job)
    return service.artefacts(job)
