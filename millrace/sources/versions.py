"""Tables kept in versions, so that a load of several tables becomes visible in one step.

A version is one small file that names the folders of every table.  Data are written to
folders that no version names yet; putting the next version's file in its place, which
fails if another writer was faster, makes all of them visible together.  A load that dies
before leaves the last version whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import col
from millrace.sources import keyindex, pagelist
from millrace.sources.keyindex import BITMAP_BITS, FILE, ROW, Index, bit_is_set

# A deletion vector: bit r of part p stands for row 32768 p + r of the file.
_VECTORS = T.StructType([T.StructField(FILE, T.StringType()), T.StructField("_part", T.LongType()), T.StructField("bits", T.BinaryType())])


class Conflict(RuntimeError):
    """Another writer committed a version first; the load can simply be run again."""


@dataclass
class Table:
    """One table of a version: its folders, the files in them that count no more, and its key index.

    ``vectors`` are folders of deletion vectors, each with the files that they mark rows of.
    ``lists`` are folders of the rows in the order of a list, with the list's columns; a
    change of the table leaves them out, so a stored list is never older than its table.
    """

    folders: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)
    index: list[Index] = field(default_factory=list)
    last_id: int = 0
    vectors: list[tuple[str, list[str]]] = field(default_factory=list)
    lists: dict[str, tuple[str, str]] = field(default_factory=dict)


@dataclass
class Version:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)

    def table(self, name: str) -> Table:
        return self.tables.get(name, Table())

    def text(self) -> str:
        return json.dumps({"number": self.number, "tables": {k: v.__dict__ | {"index": [i.__dict__ for i in v.index]} for k, v in self.tables.items()}})

    @classmethod
    def parse(cls, text: str) -> Version:
        given = json.loads(text)
        tables = {}
        for name, t in given["tables"].items():
            index, vectors = [Index(**i) for i in t["index"]], [(folder, files) for folder, files in t["vectors"]]
            tables[name] = Table(**t | {"index": index, "vectors": vectors})
        return cls(given["number"], tables)


class Store:
    """Versioned tables under a folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # -- versions --------------------------------------------------------------

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_versions")
        return jvm, path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Numbers of all versions, oldest first."""
        _, folder, files = self._files()
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version:
        """The version of that number, or the newest; version 0 is empty."""
        numbers = self.numbers()
        number = number if number is not None else numbers[-1] if numbers else 0
        if number == 0:
            return Version()
        jvm, folder, files = self._files()
        stream = files.open(jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}.json"))
        try:
            return Version.parse(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, base: Version, tables: dict[str, Table]) -> Version:
        """The version after ``base``, with these tables in place of its own; all or nothing."""
        new = Version(base.number + 1, base.tables | tables)
        jvm, folder, files = self._files()
        files.mkdirs(folder)
        hidden = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
        stream = files.create(hidden, False)
        try:
            stream.write(bytearray(new.text().encode()))
        finally:
            stream.close()
        place = jvm.org.apache.hadoop.fs.Path(folder, f"{new.number:012d}.json")
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            # Refuses to replace a file: of two writers one gets the number.
            context.rename(files.makeQualified(hidden), files.makeQualified(place), how)
        except Exception as error:
            files.delete(hidden, False)
            if "FileAlreadyExistsException" in str(error):
                raise Conflict(f"version {new.number} of {self.root} exists already") from error
            raise
        return new

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete folders that none of the newest ``keep`` versions names; gives their names.

        Also those of loads that died.  Not to be run while a load is at work.
        """
        numbers = self.numbers()
        used = {name for n in numbers[-keep:] for t in self.version(n).tables.values() for name in (*t.folders, *[i.folder for i in t.index], *[v[0] for v in t.vectors], *[v[0] for v in t.lists.values()])}
        jvm, _, files = self._files()
        gone = []
        for kind in ("data", "keys", "deletes", "lists"):
            top = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
            for table in files.listStatus(top) if files.exists(top) else []:
                for status in files.listStatus(table.getPath()):
                    name = f"{kind}/{table.getPath().getName()}/{status.getPath().getName()}"
                    if name not in used:
                        files.delete(status.getPath(), True)
                        gone.append(name)
        return sorted(gone)

    # -- tables ----------------------------------------------------------------

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def read(self, table: Table, schema: T.StructType, with_file: bool = False) -> DataFrame:
        """The rows of a table; ``with_file`` adds the file a row lies in and its number there."""
        if not table.folders:
            places = [T.StructField(FILE, T.StringType()), T.StructField(ROW, T.LongType())]
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *places * with_file]))
        # Folders are partitions of the table's own, so that they can be read together.
        top = self.path(table.folders[0].rsplit("/", 1)[0])
        rows = self.spark.read.option("basePath", top).schema(schema).parquet(*[self.path(f) for f in table.folders])
        # Table, folder, partition and name: the same wherever the store lies.
        file = F.substring_index("_metadata.file_path", "/data/", -1)
        if table.dropped:
            rows = rows.where(~file.isin(table.dropped))
        columns = [col(c) for c in schema.names]
        places = [file.alias(FILE), F.col("_metadata.row_index").alias(ROW)]
        if not table.vectors:
            return rows.select(*columns, *places * with_file)
        marked = sorted({f for _, files in table.vectors for f in files})
        # Files without deleted rows are read as ever.
        clean = rows.where(~file.isin(marked)).select(*columns, *places * with_file)
        rest = self._alive(table, rows.where(file.isin(marked)).select(*columns, *places))
        return clean.unionByName(rest.select(*clean.columns))

    def _alive(self, table: Table, rows: DataFrame) -> DataFrame:
        """Rows (with their places) that no deletion vector marks."""
        vectors = self.spark.read.schema(_VECTORS).parquet(*[self.path(f) for f, _ in table.vectors])
        # At most 4 KB for 32768 rows of a file that has lost some.
        bits = vectors.groupBy(FILE, "_part").agg(F.bitmap_or_agg("bits").alias("bits"))
        parted = rows.withColumn("_part", F.expr(f"{ROW} div {BITMAP_BITS}"))
        joined = parted.join(bits, [FILE, "_part"], "left")
        gone = F.coalesce(bit_is_set((F.col(ROW) % BITMAP_BITS).cast("int")), F.lit(False))
        return joined.where(~gone).drop("_part", "bits")

    def write(self, name: str, rows: DataFrame, columns: Sequence[str], partition_by: Iterable[str] = (), id_col: str = "id") -> tuple[str, int, int]:
        """Write rows to a folder that no version names yet: (folder, rows, largest id)."""
        folder = f"data/{name}/_load={uuid.uuid4().hex}"
        seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        parts = list(partition_by)
        if parts:
            # Rows of a partition value meet in few tasks; a value with very many rows is split by size.
            rows = rows.hint("rebalance", *[col(p) for p in parts])
        chosen = rows.select(*[col(c) for c in columns])
        largest = F.coalesce(F.max(col(id_col)), F.lit(0)) if id_col in columns else F.lit(0)
        chosen = chosen.observe(seen, F.count(F.lit(1)).alias("n"), largest.alias("last"))
        chosen.write.partitionBy(*parts).parquet(self.path(folder))
        return folder, seen.get["n"], seen.get["last"]

    def added(self, name: str, table: Table, rows: DataFrame, schema: T.StructType, key: Sequence[str], partition_by: Iterable[str] = ()) -> tuple[Table, int]:
        """The table with these rows added and their keys indexed, not yet committed, and their number."""
        folder, n, last = self.write(name, rows, schema.names, partition_by)
        if not n:
            return table, 0
        new = self.read(Table([folder]), schema, with_file=True)
        index = self.indexed(name, new, key, n)
        merged = self._merged(name, [*table.index, index], key, table.dropped)
        return Table([*table.folders, folder], table.dropped, merged, max(table.last_id, last), table.vectors), n

    def indexed(self, name: str, rows: DataFrame, key: Sequence[str], n: int) -> Index:
        values = [c for c in rows.columns if c not in (*key, *keyindex.UNCOMPARED, FILE, ROW)]
        entries = rows.select(*[col(k) for k in dict.fromkeys([*key, "id"])], keyindex.digest(values).alias("digest"), FILE, ROW)
        return keyindex.build(self.spark, self.root, f"keys/{name}/{uuid.uuid4().hex}", entries, key, n)

    def _merged(self, name: str, index: list[Index], key: Sequence[str], dropped: Sequence[str]) -> list[Index]:
        """Four parts of about one size become one, so a lookup meets few parts and a key is rarely rewritten."""
        tiers: dict[int, list[Index]] = {}
        for part in index:
            tiers.setdefault(part.tier, []).append(part)
        for tier, parts in sorted(tiers.items()):
            if len(parts) >= keyindex.MERGE:
                entries = keyindex.entries(self.spark, self.root, parts).where(~col(FILE).isin(list(dropped)))
                n = sum(p.n_keys for p in parts)
                one = keyindex.build(self.spark, self.root, f"keys/{name}/{uuid.uuid4().hex}", entries, key, n)
                return self._merged(name, [*[i for i in index if i not in parts], one], key, dropped)
        return index

    def lookup(self, table: Table, keys: DataFrame, key: Sequence[str]) -> DataFrame:
        """``key``, ``id``, ``digest`` and place of those keys that the table holds."""
        found = keyindex.lookup(self.spark, self.root, table.index, keys, key, table.dropped)
        return self._alive(table, found) if table.vectors else found

    def deleted(self, name: str, table: Table, places: DataFrame) -> tuple[Table, int]:
        """The table without the rows at these places (file and number), not yet committed, and their number.

        No file of the table is written: the places go into bitmaps per file, which a read
        applies to the rows of those files alone.
        """
        folder = f"deletes/{name}/{uuid.uuid4().hex}"
        parts = places.select(FILE, ROW).distinct().groupBy(FILE, F.expr(f"{ROW} div {BITMAP_BITS}").alias("_part"))
        bits = parts.agg(F.bitmap_construct_agg(F.col(ROW) % BITMAP_BITS).alias("bits"))
        bits.write.parquet(self.path(folder))
        written = self.spark.read.schema(_VECTORS).parquet(self.path(folder))
        # One row per file that lost rows.
        lost = written.groupBy(FILE).agg(F.sum(F.bitmap_count("bits")).alias("n")).collect()
        if not lost:
            return table, 0
        vectors = [*table.vectors, (folder, sorted(r[FILE] for r in lost))]
        return Table(table.folders, table.dropped, table.index, table.last_id, vectors), sum(r["n"] for r in lost)

    def folded(self, name: str, table: Table, schema: T.StructType, key: Sequence[str], partition_by: Iterable[str] = ()) -> Table:
        """The table with the files that lost rows written anew without them, not yet committed."""
        marked = sorted({f for _, files in table.vectors for f in files} - set(table.dropped))
        if not marked:
            return table
        rows = self.read(table, schema, with_file=True).where(col(FILE).isin(marked)).drop(FILE, ROW)
        base = Table(table.folders, sorted({*table.dropped, *marked}), table.index, table.last_id)
        return self.added(name, base, rows, schema, key, partition_by)[0]

    def listed(
        self, name: str, table: Table, schema: T.StructType, label: str, ordering: Sequence[tuple[str, bool]], columns: Sequence[str] = ()
    ) -> Table:
        """The table with a stored list of its rows under that label, not yet committed.

        ``ordering`` names the sort columns and whether each descends (nulls last ascending
        and first descending); ``columns`` are kept in the list, all unless named.
        """
        folder = f"lists/{name}/{uuid.uuid4().hex}"
        kept = list(dict.fromkeys([*(columns or schema.names), *[c for c, _ in ordering]]))
        rows = self.read(table, schema).select(*[col(c) for c in kept])
        pagelist.build(rows, self.path(folder), [col(c).desc_nulls_first() if down else col(c).asc_nulls_last() for c, down in ordering])
        return replace(table, lists=table.lists | {label: (folder, rows.schema.json())})

    def page(self, table: Table, label: str, limit: int, offset: int = 0) -> DataFrame:
        """A page of a stored list, however deep, by the counts kept with it; reads the ranges that hold it alone."""
        folder, schema = self._list(table, label)
        return pagelist.page(self.spark, self.path(folder), schema, limit, offset)

    def list_total(self, table: Table, label: str) -> int:
        return pagelist.total(self.spark, self.path(self._list(table, label)[0]))

    def _list(self, table: Table, label: str) -> tuple[str, T.StructType]:
        if label not in table.lists:
            raise KeyError(f"the table has no list {label!r}; a change of its rows leaves lists out")
        folder, schema = table.lists[label]
        return folder, T.StructType.fromJson(json.loads(schema))

    def changes(self, before: Table, after: Table, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
        """``(added, removed)`` rows between two states of a table.

        Reads new folders, and files that were dropped or lost rows.  Rows that were only
        written anew are in both.
        """
        new = [f for f in after.folders if f not in before.folders]
        added = self.read(Table(new, after.dropped, vectors=after.vectors), schema)
        gone = sorted(set(after.dropped) - set(before.dropped))
        fresh = {f for v in after.vectors if v not in before.vectors for f in v[1]} - set(after.dropped)
        held = self.read(before, schema, with_file=True)
        removed = held.where(col(FILE).isin(gone)) if gone else held.limit(0)
        if fresh:
            touched = held.where(col(FILE).isin(sorted(fresh)))
            left = self.read(after, schema, with_file=True).where(col(FILE).isin(sorted(fresh))).select(FILE, ROW)
            removed = removed.unionByName(touched.join(left, [FILE, ROW], "left_anti").select(*held.columns))
        return added, removed.drop(FILE, ROW)

    def upserted(
        self,
        name: str,
        table: Table,
        changes: DataFrame,
        schema: T.StructType,
        key: Sequence[str],
        partition_by: Iterable[str] = (),
    ) -> tuple[Table, dict[str, int]]:
        """The table with rows replaced by key and new keys added, not yet committed.

        ``changes`` carries the key, once each, and any of the other columns; of a row that is
        there the others, ``id`` and ``created_at`` stay and ``updated_at`` is now.  Only files that
        hold such a row are written anew, found by the key index; a new row gets the next ids.
        Counts: ``updated``, ``inserted`` and ``files`` written anew.
        """
        repeated = changes.groupBy(*[col(k) for k in key]).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
        if repeated is not None:
            raise ValueError(f"a key occurs {repeated['n']} times among the changes: {repeated}")
        held = keyindex.stored(self.lookup(table, changes.select(*[col(k) for k in key]), key), "held")
        # One name per file that is written anew.
        touched = [r[FILE] for r in held.select(FILE).distinct().collect()]
        given = [c for c in changes.columns if c in schema.names and c not in (*key, "id", "created_at", "updated_at")]
        now = F.current_timestamp()
        old = self.read(table, schema, with_file=True)
        old = old.where(col(FILE).isin(touched)) if touched else old.limit(0)
        patch = changes.select(*[col(k) for k in key], F.lit(True).alias("_hit"), *[col(c).alias(f"_new_{c}") for c in given])
        joined = old.drop(FILE, ROW).join(patch, list(key), "left")
        hit = F.col("_hit").isNotNull()

        def value(c: str):
            if c in given:
                return F.when(hit, F.col(f"`_new_{c}`")).otherwise(col(c)).cast(schema[c].dataType).alias(c)
            return F.when(hit, now).otherwise(col(c)).alias(c) if c == "updated_at" else col(c)

        rewritten = joined.select(*[value(c) for c in schema.names])
        fresh = changes.join(held.select(*[col(k) for k in key]), list(key), "left_anti")
        stamped = fresh.select(
            *[
                (now if c in ("created_at", "updated_at") else col(c) if c in fresh.columns and c != "id" else F.lit(None)).cast(schema[c].dataType).alias(c)
                for c in schema.names
            ]
        )
        seen = Observation(f"new-{uuid.uuid4().hex[:8]}")
        numbered = stamped.withColumn("id", F.monotonically_increasing_id() + F.lit(table.last_id + 1))
        numbered = keyindex.stored(numbered.observe(seen, F.count(F.lit(1)).alias("n")), "inserted")
        base = Table(table.folders, sorted({*table.dropped, *touched}), table.index, table.last_id, table.vectors)
        rows = rewritten.unionByName(numbered.select(*[col(c) for c in schema.names]))
        new, _ = self.added(name, base, rows, schema, key, partition_by)
        return new, {"updated": held.count(), "inserted": seen.get["n"], "files": len(touched)}
