"""Derived tables that are kept as long as their inputs stay the same.

A kept table is a folder ``builds/<number>`` of Parquet files and a manifest
that names the build in force and the stamps of its inputs. The manifest is
written after the build is complete and replaced in one step, so a build that
was broken off is never read; its files are removed by the next build. The
folder may be in any store that pyarrow.fs opens.
"""

import json
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import table_stamp
from .voxel_files import store_of


def files_stamp(spark, path: str) -> str:
    """Fingerprint of the files of a table or folder: names, sizes and times; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    n, digest = table_stamp(files).first()
    return f"{n}:{digest}"


def rows_stamp(df: DataFrame) -> str:
    """Fingerprint of a table's rows in any order."""
    n, digest = table_stamp(df).first()
    return f"{n}:{digest}"


class Kept:
    """A table kept in a folder."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.store, self.place = store_of(self.folder)

    def manifest(self):
        """What is in force: build, schema, stamps; None without a build."""
        try:
            with self.store.open_input_file(f"{self.place}/manifest.json") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def agreement(self, stamps: dict) -> DataFrame:
        """input, reusable: which stamps are those of the build in force. Inputs that only one side has are not."""
        then = (self.manifest() or {"stamps": {}})["stamps"]
        rows = [(name, name in stamps and stamps[name] == then.get(name)) for name in sorted({*stamps, *then})]
        return self.spark.createDataFrame(rows, "input string, reusable boolean")

    def reusable(self, stamps: dict) -> bool:
        held = self.manifest()
        return held is not None and held["stamps"] == stamps

    def read(self) -> DataFrame:
        held = self.manifest()
        if held is None:
            raise FileNotFoundError(f"nothing is kept in {self.folder}")
        return self.spark.read.schema(held["schema"]).parquet(f"{self.folder}/builds/{held['build']}")

    def build(self, df: DataFrame, stamps: dict) -> DataFrame:
        """Write a new build and put it in force. The one before it is kept for readers that have begun; older ones go."""
        before, name = self.manifest(), uuid.uuid4().hex
        df.write.parquet(f"{self.folder}/builds/{name}")
        text = json.dumps({"build": name, "schema": df._jdf.schema().toDDL(), "stamps": stamps})
        fresh = f"{self.place}/manifest-{name}.json"
        with self.store.open_output_stream(fresh) as f:
            f.write(text.encode())
        self.store.move(fresh, f"{self.place}/manifest.json")
        keep = {name, before["build"] if before else name}
        for old in self.store.get_file_info(fs.FileSelector(f"{self.place}/builds")):
            if old.base_name not in keep:
                self.store.delete_dir(old.path)
        return self.read()


def kept_table(spark, folder: str, stamps: dict, build) -> DataFrame:
    """The table kept in a folder if all its inputs have the given stamps, or else what ``build()`` gives, kept from now on."""
    kept = Kept(spark, folder)
    return kept.read() if kept.reusable(stamps) else kept.build(build(), stamps)
