"""Tables that are kept up to date: rows by key in hash buckets, and a mark that says how far the input has been taken in.

A version of the table is one row under <path>/marks/v=<n>: its mark, the number of buckets, and which version wrote each bucket last. Buckets lie under <path>/rows/v=<n>/bucket=<k>. A merge reads and writes only the buckets that hold
a key of the delta; the row of the new version is written last, so a run that fails before that leaves the old version in
force and can simply be repeated. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
#: Files that a bucket is written as, so that a bucket's rows are not one task.
FILES = 4


class KeptTable:
    """One row per key. schema: of the rows; marks are longs (times, versions of a source), null before the first merge."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def _versions(self) -> list[int]:
        """Versions whose row was written whole, ascending."""
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.path}/marks")
        fs = top.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(top):
            return []
        found = [s.getPath() for s in fs.listStatus(top)]
        return sorted(int(p.getName().removeprefix("v=")) for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _state(self) -> tuple[int, int | None, dict[int, int]]:
        """(version, mark, version that wrote each bucket)."""
        versions = self._versions()
        if not versions:
            return 0, None, {}
        row = self.spark.read.schema("mark bigint, buckets int, places map<int,int>").parquet(f"{self.path}/marks/v={versions[-1]}").first()
        if row.buckets != self.buckets:
            raise ValueError(f"the table has {row.buckets} buckets")
        return versions[-1], row.mark, dict(row.places)

    def mark(self) -> int | None:
        return self._state()[1]

    def _rows(self, places: dict[int, int]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/v={v}/bucket={b}" for b, v in sorted(places.items())])

    def rows(self) -> DataFrame:
        """All rows of the version in force."""
        return self._rows(self._state()[2])

    def files(self) -> set[str]:
        """Paths of the files of the version in force."""
        return {r[0] for r in self.rows().select(F.input_file_name()).distinct().collect()}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def merge(self, delta: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame], mark: int | None = None) -> int:
        """Replace the rows of the touched buckets by fold(their old rows, delta). The mark moves to `mark`, or stays if that is
        None. A delta without rows writes no bucket. Returns the version."""
        version, old_mark, places = self._state()
        touched = [r[0] for r in delta.select(self._bucket().alias("b")).distinct().collect()]  # as many as buckets at most
        new = version + 1
        if touched:
            old = self._rows({b: v for b, v in places.items() if b in touched})
            rows = fold(old, delta).select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
            spread = rows.withColumn("bucket", self._bucket()).repartition("bucket", F.pmod(F.hash(self.key), F.lit(FILES)))
            spread.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/v={new}")
            # a bucket that the fold left empty has no folder
            kept = {r[0] for r in self.spark.read.schema(T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])).parquet(f"{self.path}/rows/v={new}").select("bucket").distinct().collect()}
            places = {b: v for b, v in places.items() if b not in touched} | {b: new for b in kept}
        state = self.spark.createDataFrame([(old_mark if mark is None else mark, self.buckets, places)], "mark bigint, buckets int, places map<int,int>")
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/v={new}")
        return new

    def put_many(self, updates: DataFrame, order: str | None = None) -> int:
        """Rows by key: an update replaces what was there; of several updates to a key the last by order, or, without one, by its
        values, stays."""
        fields = [f.name for f in self.schema]
        by = F.struct(*([F.col(order).alias("_x_order")] if order else []), *fields)

        def fold(old: DataFrame, delta: DataFrame) -> DataFrame:
            last = delta.groupBy(self.key).agg(F.max(by).alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in fields])
            return old.join(last.select(self.key), self.key, "left_anti").select(*fields).unionByName(last)

        return self.merge(updates.filter(F.col(self.key).isNotNull()), fold)

    def contains(self, keys: DataFrame) -> DataFrame:
        """keys with a column member."""
        return keys.join(self.rows().select(self.key, F.lit(True).alias("member")), self.key, "left").withColumn("member", F.coalesce("member", F.lit(False)))

    def clean(self) -> None:
        """Delete folders of buckets that neither the version in force nor the one before it names."""
        versions = self._versions()
        jvm, named = self.spark._jvm, set()
        for v in versions[-2:]:
            row = self.spark.read.schema("mark bigint, buckets int, places map<int,int>").parquet(f"{self.path}/marks/v={v}").first()
            named |= {(at, b) for b, at in row.places.items()}
        top = jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows")
        fs = top.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        for at in [s.getPath() for s in fs.listStatus(top)] if fs.exists(top) else []:
            if (v := int(at.getName().removeprefix("v="))) <= (versions[-1] if versions else -1):
                for b in [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("bucket=")]:
                    if (v, int(b.getName().removeprefix("bucket="))) not in named:
                        fs.delete(b, True)
