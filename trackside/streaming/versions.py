"""Folders of micro-batches that are merged into larger parts from time to time.

``batches/query=<id>/batch_id=<n>`` holds the rows of one batch, ``parts/<name>`` what was folded from
several, and ``manifest/<v>.json`` says which parts make up version ``v``, which batches they cover,
and which files a part has, with the least and greatest value of one column. A reader takes one
manifest, its parts and the batches after it: it lists few folders however long the stream has run,
and opens only files that can hold what it looks for.

Parts have levels. Open batches become a part of level 0; when ``FAN`` parts of a group (a day, or the
whole store) are of one level, they are merged into one of the next. So a row is written once per
level, and levels grow with the logarithm of the batches, not with them. Files of the version before
the last stay, for readers under way.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a part are older than those of any open batch, and those of a later part newer.
GENERATION = "_generation"

# Parts of one level that are merged.
FAN = 4

Fold = Callable[[DataFrame], DataFrame]


class Folder:
    """The few file operations that readers and writers of tables do not have."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.path = path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Appears whole: written beside its place and renamed."""
        beside = self._at(f"{name}.new")
        stream = self._fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._fs.rename(beside, self._at(name)):
            raise OSError(f"{self.path}/{name} could not be put in place")


def query_id(rows: DataFrame) -> str:
    """Id of the running stream; a table written outside one counts as query ``none``."""
    return rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def batch_path(rows: DataFrame, path: str, batch_id: int) -> str:
    return f"{path}/batches/query={query_id(rows)}/batch_id={batch_id}"


def append(rows: DataFrame, batch_id: int, path: str) -> None:
    """Add a batch; the same batch written again replaces itself."""
    rows.write.mode("overwrite").parquet(batch_path(rows, path, batch_id))


def manifest(spark: SparkSession, path: str) -> dict:
    """The last version: its number, the batches it covers, its parts from the oldest to the newest, and how
    many rows were written to parts so far."""
    folder = Folder(spark, path)
    numbers = [int(name[:-5]) for name in folder.names("manifest") if name.endswith(".json")]
    return json.loads(folder.read(f"manifest/{max(numbers)}.json")) if numbers else {"version": 0, "covers": {}, "parts": [], "written": 0}


def open_batches(spark: SparkSession, path: str, info: dict | None = None) -> list[tuple[str, int]]:
    """Batches that the last version does not cover, as (query, number)."""
    info, folder = info or manifest(spark, path), Folder(spark, path)
    found = [(q.removeprefix("query="), number) for q in folder.names("batches") if q.startswith("query=") for number in _numbers(folder, q)]
    return sorted((query, number) for query, number in found if number > info["covers"].get(query, -1))


def _numbers(folder: Folder, query: str) -> list[int]:
    names = folder.names(f"batches/{query}")
    return [int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id=")]


def _reader(spark: SparkSession, schema: T.StructType | None):
    return spark.read if schema is None else spark.read.schema(schema)


def _batches(spark: SparkSession, path: str, schema: T.StructType | None, taken: list[tuple[str, int]], within: Callable[[str], bool] | None = None) -> DataFrame | None:
    places = [f"{path}/batches/query={query}/batch_id={number}" for query, number in taken]
    if within:
        folder = Folder(spark, f"{path}/batches")
        inner = [(place, place.removeprefix(folder.path + "/")) for place in places]
        places = [f"{place}/{name}" for place, own in inner for name in folder.names(own) if "=" in name and within(name.split("=", 1)[1])]
    if not places:
        return None
    rows = _reader(spark, schema).option("basePath", f"{path}/batches").parquet(*places)
    return rows.withColumn(GENERATION, F.col("batch_id").cast("long")).drop("query", "batch_id")


def _parts(spark: SparkSession, path: str, schema: T.StructType | None, parts: list[dict], files: Callable[[dict], bool]) -> DataFrame | None:
    """Rows of the chosen files of parts, given from the oldest to the newest, with their generation. A
    part's group is a column of them."""
    chosen = [f"{path}/parts/part={part['name']}/{file['file']}" for part in parts for file in part["files"] if files(file)]
    if not chosen:
        return None
    rows = _reader(spark, schema).option("basePath", f"{path}/parts").parquet(*chosen)
    # Groups of one part are of one age.
    ages = {part["name"]: age - len(parts) for age, part in enumerate(parts)}
    aged = F.element_at(F.create_map(*[F.lit(x) for pair in ages.items() for x in pair]), F.col("part")).cast("long")
    return rows.withColumn(GENERATION, aged).drop("part")


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    info: dict | None = None,
    parts: Callable[[dict], bool] = lambda part: True,
    files: Callable[[dict], bool] = lambda file: True,
    within: Callable[[str], bool] | None = None,
    but: tuple[str, int] | None = None,
) -> DataFrame:
    """Rows of one version and of the batches after it, with their ``GENERATION``; the rows of a key are
    still to be folded. ``parts`` and ``files`` choose by what the manifest says of them, ``within`` by
    the value in the name of a folder in an open batch; ``but`` is a batch that is left out, because it is
    being written. A store without rows needs its ``schema`` to be read."""
    info = info or manifest(spark, path)
    taken = [batch for batch in open_batches(spark, path, info) if batch != but]
    both = [_parts(spark, path, schema, [part for part in info["parts"] if parts(part)], files), _batches(spark, path, schema, taken, within)]
    found = [rows for rows in both if rows is not None]
    if found:
        return found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)
    if info["parts"] or taken:  # nothing of what there is was asked for
        some = _parts(spark, path, schema, info["parts"][-1:], lambda file: True) if info["parts"] else _batches(spark, path, schema, taken[-1:])
        return some.limit(0)
    if schema is None:
        raise ValueError(f"nothing written to {path} yet")
    return spark.createDataFrame([], schema).withColumn(GENERATION, F.lit(-1).cast("long"))


def _written(rows: DataFrame, path: str, level: int, group: str | None, zone: str | None, options: dict[str, str]) -> list[dict]:
    """Write rows as parts of one name, one for each value of ``group``; what the manifest says of them."""
    spark, name = rows.sparkSession, f"p{uuid.uuid4().hex}"
    place = f"{path}/parts/part={name}"
    writer = rows.write.mode("overwrite").options(**options)
    (writer.partitionBy(group) if group else writer).parquet(place)
    least, most = (F.min(zone), F.max(zone)) if zone else (F.lit(None), F.lit(None))
    # One row per file of this part, from the files as they were written. Values may be missing in all rows.
    told = spark.read.schema(rows.schema).parquet(place).groupBy(F.col("_metadata.file_path").alias("file"))
    found = told.agg(F.count(F.lit(1)).alias("rows"), least.cast("string").alias("least"), most.cast("string").alias("most")).collect()
    parts: dict[str, list[dict]] = defaultdict(list)
    for row in found:
        file = row["file"].split(f"/parts/part={name}/", 1)[1]
        parts[file.split("/")[0].split("=", 1)[1] if group else ""].append({"file": file, "rows": row["rows"], "least": row["least"], "most": row["most"]})
    return [
        {"name": name, "group": own, "level": level, "rows": sum(file["rows"] for file in files), "files": sorted(files, key=lambda file: file["file"])}
        for own, files in sorted(parts.items())
    ]


def compact(
    spark: SparkSession,
    path: str,
    fold: Fold,
    lay_out: Callable[[DataFrame, int], DataFrame] = lambda rows, most: rows,
    schema: T.StructType | None = None,
    group: str | None = None,
    zone: str | None = None,
    most: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Fold the open batches (the first ``most`` of them) into a part, and merge parts of one level.

    ``fold`` makes one row per key out of rows with their ``GENERATION``; ``lay_out`` deals and sorts what
    is written, of which it is told the most rows there can be, with the writer's ``options``; ``group`` is a column by whose values parts are kept apart,
    ``zone`` one whose range is noted for each file.
    """
    info = manifest(spark, path)
    taken = open_batches(spark, path, info)[:most]
    if not taken:
        return
    parts, written = list(info["parts"]), info["written"]

    def add(rows: DataFrame, level: int, at_most: int) -> None:
        nonlocal written
        for part in _written(lay_out(fold(rows), at_most), path, level, group, zone, options or {}):
            parts.append(part)
            written += part["rows"]

    batches = _batches(spark, path, schema, taken)
    add(batches, 0, batches.count())
    level = 0
    while parts and level <= max(part["level"] for part in parts):
        same: dict[str, list[dict]] = defaultdict(list)
        for part in parts:
            if part["level"] == level:
                same[part["group"]].append(part)
        due = [part for own in same.values() if len(own) >= FAN for part in own]
        if due:
            due = [part for part in parts if part in due]
            parts = [part for part in parts if part not in due]
            add(_parts(spark, path, schema, due, lambda file: True), level + 1, sum(part["rows"] for part in due))
        level += 1
    covers = dict(info["covers"])
    for query, batch in taken:
        covers[query] = max(batch, covers.get(query, -1))
    folder, number = Folder(spark, path), info["version"] + 1
    folder.write(f"manifest/{number}.json", json.dumps({"version": number, "covers": covers, "parts": parts, "written": written}))
    _tidy(folder, info, parts)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was ever written."""
    return bool(Folder(spark, path).names())


def drop(spark: SparkSession, path: str, gone: Callable[[dict], bool]) -> None:
    """Take whole parts out of the store, in a version of their own."""
    info = manifest(spark, path)
    parts = [part for part in info["parts"] if not gone(part)]
    if len(parts) == len(info["parts"]):
        return
    folder, number = Folder(spark, path), info["version"] + 1
    folder.write(f"manifest/{number}.json", json.dumps({**info, "version": number, "parts": parts}))
    _tidy(folder, info, parts)


def _tidy(folder: Folder, before: dict, parts: list[dict]) -> None:
    """Delete what neither this version nor the one before it needs."""
    for query, batch in before["covers"].items():
        for number in _numbers(folder, f"query={query}"):
            if number <= batch:
                folder.delete(f"batches/query={query}/batch_id={number}")
    needed = {f"part={part['name']}" for part in [*before["parts"], *parts]}
    for name in folder.names("parts"):
        if name not in needed:
            folder.delete(f"parts/{name}")
    for name in folder.names("manifest"):
        if name.endswith(".json") and int(name[:-5]) < before["version"]:
            folder.delete(f"manifest/{name}")
