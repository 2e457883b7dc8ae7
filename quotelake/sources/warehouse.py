"""The stored tables, written one load at a time.

Every attempt at a load writes folders of its own and, last of all, its commit: one small
JSON file that is created only if that number is not taken. The commit names every folder
that belongs to the warehouse as of this load, and readers read the named folders only. So
what a dead attempt left is never seen, and of two writers that start from the same load
one gets the number and the other a ``CommitConflict``, with nothing lost or overwritten.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake import schemas as S
from quotelake.functions.calendar import key_year
from quotelake.sources import files

COMMITS = T.StructType(
    [
        T.StructField("load", T.IntegerType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("dims_load", T.IntegerType()),
        *(
            T.StructField(name, T.LongType())
            for name in (
                "records", "records_processed", "records_rejected", "quotes_parsed",
                "elements_skipped", "elements_rejected", "facts_loaded", "quotes_skipped",
            )
        ),
    ]
)

DIMS = {"dim_assets": S.DIM_ASSETS, "dim_sources": S.DIM_SOURCES}
YEAR = T.StructField("year", T.IntegerType())
LOAD = T.StructField("load", T.IntegerType())
FACTS = T.StructType([*S.FACT_QUOTES.fields, LOAD, YEAR])
RECORD = (T.StructField("record_id", T.LongType()), T.StructField("source", T.StringType()))
REASON = T.StructField("reason", T.StringType())
# Compaction: bytes up to which all folders are alike, and how much larger each class above is.
SMALL, GROWTH = 64 << 20, 8
# Tables that grow by a folder per load; the dimensions are rewritten whole.
GROWING = {
    "fact_quotes": FACTS,
    "dim_dates": S.DIM_DATES,
    "outcomes": T.StructType([*RECORD, REASON]),
    "rejects": T.StructType([*RECORD, T.StructField("element_pos", T.IntegerType()), REASON]),
    "runs": T.StructType([T.StructField("run", T.StringType())]),
}


class CommitConflict(RuntimeError):
    """Another writer has committed this load; load again on top of it."""


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    columns = (f"CAST(NULL AS {field.dataType.simpleString()}) AS {field.name}" for field in schema.fields)
    return spark.range(0, numPartitions=1).selectExpr(*columns)


class Warehouse:
    """A handle on the stored tables. It follows the newest commit, or stays at commit ``at``."""

    def __init__(self, spark: SparkSession, root: str, at: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.at = at
        self._known = -1
        self._attempts: dict[int, str] = {}
        self._tables: dict[int, set[str]] = {}

    @classmethod
    def create(cls, spark: SparkSession, root: str) -> Warehouse:
        """An empty warehouse in a new folder."""
        house = cls(spark, root)
        for name, schema in {**DIMS, "dim_dates": S.DIM_DATES}.items():
            house.write(name, 0, no_rows(spark, schema))
        house.commit(Row(load=0, dims_load=0))
        return house

    def pinned(self) -> Warehouse:
        """A handle of its own that stays at what is the newest commit now."""
        return type(self)(self.spark, self.root, self.last["load"])

    def path(self, table: str, load: int) -> str:
        """This handle's own folder for a table of a load it is writing."""
        attempt = self._attempts.setdefault(load, f"{load:010d}-{uuid.uuid4().hex}")
        return f"{self.root}/{table}/attempt={attempt}"

    def write(self, table: str, load: int, rows: DataFrame, *partitions: str) -> None:
        # Only this handle's attempt can lie there, so only its own retry is overwritten.
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*partitions).parquet(self.path(table, load), compression=files.CODEC)
        self._tables.setdefault(load, set()).add(table)

    def written(self, table: str, load: int) -> DataFrame:
        """What this handle wrote for a load, committed or not."""
        return self.spark.read.parquet(self.path(table, load))

    def commit(self, row: Row, replaces: dict[str, list[str]] | None = None) -> None:
        """Publishes what this handle wrote for the load, on top of the folders of the load
        before it; ``replaces`` names folders, by table, that the written ones stand for. With
        each folder goes its size in bytes and the newest load whose rows it may hold."""
        values = row.asDict()
        load = values["load"]
        self.path("", load)
        before = self._commit(load - 1) if load else {"load": 0, "folders": {}, "sizes": {}, "streams": {}}
        attempt, wrote = self._attempts[load], self._tables.get(load, set())
        folders = {
            name: [
                folder for folder in before["folders"].get(name, [])
                if not (name in DIMS and name in wrote) and folder not in (replaces or {}).get(name, ())
            ]
            + ([attempt] if name in wrote else [])
            for name in (*DIMS, *GROWING)
        }
        known, kept = before["sizes"], {f"{name}/{folder}" for name, held in folders.items() for folder in held}
        sizes = {folder: held for folder, held in known.items() if folder in kept}
        for name in wrote:
            replaced = [known[f"{name}/{folder}"][1] for folder in (replaces or {}).get(name, ())]
            sizes[f"{name}/{attempt}"] = [files.size(self.spark, self.path(name, load)), max(replaced, default=load)]
        streams = dict(before["streams"])
        if values.get("stream_id") is not None:
            streams[values["stream_id"]] = values["batch_id"]
        content = {name: values.get(name) for name in COMMITS.fieldNames()}
        text = json.dumps({**content, "folders": folders, "sizes": sizes, "streams": streams})
        if not files.create(self.spark, self._commit_path(load), text):
            raise CommitConflict(f"load {load} of {self.root} is committed already")

    def _commit_path(self, load: int) -> str:
        return files.numbered(f"{self.root}/commits", load)

    def _commit(self, load: int) -> dict:
        return json.loads(files.text(self.spark, self._commit_path(load)))

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).json(f"{self.root}/commits")

    @property
    def last(self) -> dict:
        """The commit this handle reads, looked up on every use from the newest one it has seen."""
        if self.at is not None:
            return self._commit(self.at)
        self._known = files.newest(self.spark, f"{self.root}/commits", self._known)
        return self._commit(self._known)

    def _read(self, table: str, schema: T.StructType, commit: dict | None = None) -> DataFrame:
        folders = (commit or self.last)["folders"][table]
        if not folders:
            return no_rows(self.spark, schema)
        return files.read_parts(self.spark, schema, f"{self.root}/{table}", [f"attempt={name}" for name in folders])

    def assets(self) -> DataFrame:
        return self._read("dim_assets", S.DIM_ASSETS)

    def sources(self) -> DataFrame:
        return self._read("dim_sources", S.DIM_SOURCES)

    def dates(self) -> DataFrame:
        return self._read("dim_dates", S.DIM_DATES)

    def facts(self, after_load: int | None = None) -> DataFrame:
        """The quote fact with its ``year``, by which its files are laid out; with
        ``after_load``, the facts that later loads added, of old assets as of new ones."""
        commit = self.last
        if after_load is not None:
            newest = {name: commit["sizes"][f"fact_quotes/{name}"][1] for name in commit["folders"]["fact_quotes"]}
            commit = {"folders": {"fact_quotes": [name for name in newest if newest[name] > after_load]}}
        facts = self._read("fact_quotes", FACTS, commit)
        if after_load is not None:
            # A compacted folder holds older loads as well.
            facts = facts.where(F.col("load") > after_load)
        return facts.drop("load")

    def outcomes(self) -> DataFrame:
        """Id, source and reason of every record any load has read."""
        return self._read("outcomes", GROWING["outcomes"])

    def rejects(self) -> DataFrame:
        """Rejected records, and single rejected elements by position, with the reason."""
        return self._read("rejects", GROWING["rejects"])

    def runs(self) -> DataFrame:
        """The lake's ingest runs that loads have read."""
        return self._read("runs", GROWING["runs"])

    def folder_count(self) -> int:
        """The most folders a table is read from."""
        return max(len(folders) for folders in self.last["folders"].values())


def _alike(commit: dict, table: str, least: int) -> list[str]:
    """The folders of a table that are to become one: those of the smallest class of sizes
    (each class up to ``GROWTH`` times the one below) that has ``least`` of them."""
    classes: dict[int, list[str]] = {}
    for folder in commit["folders"][table]:
        size = commit["sizes"][f"{table}/{folder}"][0]
        classes.setdefault(int(math.log(max(size, SMALL) / SMALL, GROWTH)), []).append(folder)
    return next((classes[c] for c in sorted(classes) if len(classes[c]) >= least), [])


def compact(house: Warehouse, least: int = 2) -> int | None:
    """Rewrites folders of similar size into one, as a load without records; None if no table
    has ``least`` such folders.

    A fact is rewritten only together with folders of its own size, so about once per factor
    of ``GROWTH`` in the size of the history, and a large folder is left alone until there are
    others like it. Facts keep the number of the load that added them. The replaced folders
    stay, so a reader pinned to an older commit is still served.
    """
    base = house.pinned()
    commit = base.last
    load = commit["load"] + 1
    chosen = {name: _alike(commit, name, least) for name in GROWING}
    chosen = {name: folders for name, folders in chosen.items() if folders}
    if not chosen:
        return None
    for name, folders in chosen.items():
        rows = base._read(name, GROWING[name], {"folders": {name: folders}})
        if name == "fact_quotes":
            _store_facts(base, load, rows)
        else:
            base.write(name, load, rows.coalesce(1) if name == "dim_dates" else rows)
    base.commit(Row(load=load, dims_load=commit["dims_load"]), replaces=chosen)
    return load


def write_facts(house: Warehouse, load: int, facts: DataFrame) -> None:
    """Stores the facts a load adds by year, sorted by asset and date inside the files.

    The range partitioning takes the whole key, so a hot year or asset spreads over tasks,
    and each file covers few assets, which lets a reader skip row groups.
    """
    _store_facts(
        house, load, facts.selectExpr(*S.FACT_QUOTES.fieldNames(), f"{load} AS load", f"{key_year('date_key')} AS year")
    )


def _store_facts(house: Warehouse, load: int, rows: DataFrame) -> None:
    order = ("year", "asset_key", "date_key", "source_key")
    house.write(
        "fact_quotes", load, rows.repartitionByRange(*order).sortWithinPartitions(*order), "year"
    )
