"""Written tables between the one pass over bronze and the tables it feeds.

Layout, beside silver, one folder per run, so that runs do not touch each other's::

    publishing                        lease of the one job that is changing tables
    run=<id>/lease                    lease of the run
    run=<id>/rows/outcome=accepted/batch=<label>    silver rows to publish
    run=<id>/rows/outcome=rejected    the others; what silver's columns lack of their text, in struct ``raw``
    run=<id>/staged.json              the request and the rows written: staging is complete
    run=<id>/input                    the files the run read: names, lengths and times
    run=<id>/gone/epoch=<n>           users to leave out of the staged rows, up to this epoch
    run=<id>/ids, hints, old, users   keys of joins, and where silver holds them
    run=<id>/rejected, slices         rows that slices are to hold, and the slices' names
    run=<id>/group=<label>/survivors  rows that must stay of partitions about to be replaced
    run=<id>/group=<label>/replaced   names of these partitions: the replacement may begin
    run=<id>/group=<label>/done       the replacement is complete

A run that ends well removes its folder. One that was broken off leaves it: the next job that
changes tables finishes it if it was staged, and drops it if it was not.
"""

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from eventlake.operators.erase import without_users
from eventlake.sinks.lease import Lease, alive
from eventlake.sources.folders import create, exists, matching, read_text, remove, write_text
from eventlake.sources.silver import read_silver

ROWS, ACCEPTED, REJECTED = "rows", "rows/outcome=accepted", "rows/outcome=rejected"
INPUT, ASIDE, SLICES = "input", "rejected", "slices"


@contextmanager
def run_folder(spark: SparkSession, area: str) -> Iterator[str]:
    began = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
    folder = f"{area}/run={began}-{uuid.uuid4().hex[:8]}"
    with Lease(spark, f"{folder}/lease"):
        yield folder
        remove(spark, folder)


@contextmanager
def exclusive(spark: SparkSession, area: str) -> Iterator[None]:
    """Waits until no other job is changing the lake's tables."""
    with Lease(spark, f"{area}/publishing"):
        yield


def broken_off(spark: SparkSession, area: str) -> list[str]:
    """Folders of runs that no job is working on, in the order they began."""
    found = matching(spark, f"{area}/run=*")
    return [folder for folder in found if not alive(spark, f"{folder}/lease")]


def mark_staged(spark: SparkSession, folder: str, request: dict) -> None:
    write_text(spark, f"{folder}/staged.json", json.dumps(request))


def staged(spark: SparkSession, folder: str) -> dict | None:
    """The request of a run whose staging is complete."""
    path = f"{folder}/staged.json"
    return json.loads(read_text(spark, path)) if exists(spark, path) else None


def accepted(spark: SparkSession, folder: str, label: str | None = None) -> DataFrame | None:
    """The staged silver rows of a run, or of one of its groups, but for users to leave out."""
    path = f"{folder}/{ACCEPTED}" + (f"/batch={label}" if label else "")
    if not exists(spark, path):
        return None
    users = gone(spark, folder)
    rows = read_silver(spark, path)
    return rows if users is None else without_users(rows, users)


def epochs(spark: SparkSession, path: str) -> dict[int, str]:
    """The numbered folders below a path that were written to their end."""
    found = {int(x.rsplit("=", 1)[1]): x for x in matching(spark, f"{path}/epoch=*")}
    return {number: x for number, x in sorted(found.items()) if complete(spark, x)}


def gone(spark: SparkSession, folder: str) -> DataFrame | None:
    paths = epochs(spark, f"{folder}/gone").values()
    return spark.read.schema("user_id string").parquet(*paths) if paths else None


def replacement(spark: SparkSession, folder: str, label: str) -> DataFrame | None:
    """Silver rows a group publishes: the run's accepted rows and the survivors."""
    rows, kept = accepted(spark, folder, label), f"{folder}/group={label}/survivors"
    if not exists(spark, kept):
        return rows
    survivors = read_silver(spark, kept)
    return survivors if rows is None else survivors.unionByName(rows)


def ready(spark: SparkSession, folder: str, label: str) -> bool:
    return exists(spark, f"{folder}/group={label}/replaced")


def done(spark: SparkSession, folder: str, label: str) -> bool:
    return exists(spark, f"{folder}/group={label}/done")


def mark_done(spark: SparkSession, folder: str, label: str) -> None:
    create(spark, f"{folder}/group={label}/done", "")


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    return exists(spark, f"{path}/_SUCCESS")
