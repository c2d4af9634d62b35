"""Indexes beside the stored data, kept in parts that say which data files they cover.

A part is a folder of Parquet files. The state of an index, one small file, lists its parts with the data files each covers;
it counts from the moment it is there. Files that no part covers, such as those of the last batches or of a writer that
failed, are looked at themselves by whoever asks: an index saves reading, and no answer depends on what it covers.

Uncovered files are added as one part, together with the smaller parts there are, so parts stay few and an
entry is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedmill.sources import files

BUCKET, VERSION = "bucket", "version"
CURRENT, STATE = "_current.", "_state."
#: A part is merged with the next larger one unless that covers more than so many times as many files.
FAN = 4
#: Uncovered files that are worth a new part.
INDEX_FILES = 64


def current_versions(spark: SparkSession, path: str) -> dict[int, int]:
    """Version of every bucket that an upsert or a compaction has rewritten; all others are at 0."""
    switches = [int(n.removeprefix(CURRENT)) for n in files.listed(spark, path, f"{CURRENT}*", rf"{CURRENT}\d+")]
    if not switches:
        return {}
    return {int(b): v for b, v in json.loads(files.text(spark, path, f"{CURRENT}{max(switches)}")).items()}


def stored_files(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Data files of each bucket's current version, relative to the store, by one listing."""
    versions = current_versions(spark, path)
    found: dict[int, list[str]] = {}
    for name in files.listed(spark, path, f"{BUCKET}=*/{VERSION}=*/*.parquet", rf"{BUCKET}=\d+/{VERSION}=\d+/[^/,]*\.parquet"):
        bucket, version = (int(part.split("=")[1]) for part in name.split("/")[:2])
        if versions.get(bucket, 0) == version:
            found.setdefault(bucket, []).append(name)
    return found


def state(spark: SparkSession, folder: str) -> tuple[int, list[dict]]:
    """Number and parts of the newest state of an index."""
    numbers = [int(n.removeprefix(STATE)) for n in files.listed(spark, folder, f"{STATE}*", rf"{STATE}\d+")]
    if not numbers:
        return -1, []
    return max(numbers), json.loads(files.text(spark, folder, f"{STATE}{max(numbers)}"))


def uncovered(stored: dict[int, list[str]], parts: list[dict]) -> dict[int, list[str]]:
    """By bucket, the stored files that no part covers."""
    covered = {f for p in parts for f in p["files"]}
    left = {b: [f for f in names if f not in covered] for b, names in stored.items()}
    return {b: names for b, names in left.items() if names}


def extend(
    spark: SparkSession,
    path: str,
    index: str,
    build: Callable[[list[str]], DataFrame],
    write: Callable[[DataFrame, str], None],
    at_least: int = 1,
) -> bool:
    """Cover the files that no part covers, if there are ``at_least`` so many; whether it did.

    ``build`` gives the entries of files (full paths), ``write`` puts entries into a folder. What a failed call has
    written is never read, and the next call removes it; the parts before stay for readers of the state before.
    """
    root = path.rstrip("/")
    folder, stored = f"{root}/{index}", stored_files(spark, path)
    number, parts = state(spark, folder)
    left = uncovered(stored, parts)
    fresh = [f for names in left.values() for f in names]
    if len(fresh) < max(1, at_least):
        return False
    now = {f for names in stored.values() for f in names}
    live = sorted((p for p in parts if now & set(p["files"])), key=lambda p: len(p["files"]))
    merged, size = [], len(fresh)
    while live and len(live[0]["files"]) <= FAN * size:
        merged.append(live.pop(0))
        size += len(merged[-1]["files"])
    entries = build([f"{root}/{f}" for f in fresh])
    for part in merged:
        entries = entries.unionByName(spark.read.schema(entries.schema).parquet(f"{folder}/{part['name']}"))
    if merged:
        entries = entries.distinct()  # a bucket that was rewritten brings its entries again
    name = f"part={uuid.uuid4().hex}"
    write(entries, f"{folder}/{name}")
    made = {
        "name": name,
        "buckets": sorted({*left, *(b for p in merged for b in p["buckets"])}),
        "files": sorted({*fresh, *(f for p in merged for f in p["files"] if f in now)}),
    }
    files.publish(spark, folder, f"{STATE}{number + 1}", json.dumps([*live, made]))
    kept = {p["name"] for p in (*parts, made)}
    for old in files.listed(spark, folder, "part=*", r"part=\w+"):
        if old not in kept:
            files.remove(spark, folder, old)
    files.remove(spark, folder, f"{STATE}{number - 1}")
    return True
