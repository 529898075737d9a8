"""A stored index of everything accepted: a new batch is checked against it and appended, and the history is never read again as texts.

Each append writes one segment of four tables in buckets of their key: the halves of its titles, the titles themselves, the component of each new node,
and the places (row, day) and first day of each component. A batch reads the stored halves of the buckets its own halves fall into, opens
only the stored titles that share a half with a new one (batches.title_links), and looks up the components its links touch. Merged
components are told by a table of remappings, so older segments stay as they were written, byte for byte. Rows of earlier batches that
become known because a later batch ties their component to older rows are reported as revised.

`compact` merges segments on the schedule of levels: FAN segments of a level become one of the next. The manifest names the segments in force
and is replaced in one step; a crash leaves the manifest before it. Words count as ordinary by the statistics stored when the index was created.

Null or blank URLs and titles match nothing; rows without ordinal or time of discovery are left out; an empty batch appends an empty segment.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestflow.llm import batches
from digestflow.operators.components import connected_components
from digestflow.session import cut

BUCKETS, FAN = 16, 8
TABLES = {
    "halves": ("half", "half long, title_node long"),
    "titles": ("title_node", "title_node long, units string, plain string"),
    "components": ("node", "node long, component long"),
    "firsts": ("component", "component long, first long"),
    "places": ("component", "component long, ordinal long, day long"),
}


class HistoryIndex:
    """The index in a folder of the shared file system."""

    def __init__(self, spark: SparkSession, path: str, sites: DataFrame, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.sites, self.buckets = spark, path.rstrip("/"), sites, buckets
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # manifest ------------------------------------------------------------------------------------------------

    def manifest(self) -> dict:
        """The manifest of the highest number: segments, remapping table and number."""
        if not self._fs.exists(self._fs_path(self.path)):
            return {"number": 0, "segments": [], "remaps": None}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._fs_path(self.path))]
        numbers = [int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")]
        if not numbers:
            return {"number": 0, "segments": [], "remaps": None}
        return json.loads(self.spark.read.text(f"{self.path}/manifest-{max(numbers)}.json", wholetext=True).first()[0])

    def _commit(self, manifest: dict) -> None:
        target = f"{self.path}/manifest-{manifest['number']}.json"
        out = self._fs.create(self._fs_path(f"{target}.part"))
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs.rename(self._fs_path(f"{target}.part"), self._fs_path(target)):
            raise RuntimeError(f"{target} exists: another writer was first")

    # tables --------------------------------------------------------------------------------------------------

    def _bucket(self, key: Column) -> Column:
        return F.pmod(key, F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, segment: str, table: str) -> None:
        key, _ = TABLES[table]
        df.withColumn("bucket", self._bucket(F.col(key))).repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{segment}/{table}")

    def read(self, table: str, keys: DataFrame | None = None) -> DataFrame:
        """A table over all segments in force; with keys(key) only the buckets the keys fall into."""
        columns, schema = TABLES[table][0], TABLES[table][1]
        segments = [s["name"] for s in self.manifest()["segments"] if s["rows"]]
        stored = self.spark.read.schema(f"{schema}, bucket int")
        out = None if segments else self.spark.createDataFrame([], f"{schema}, bucket int")
        for s in segments:  # as many as levels times FAN
            part = stored.option("basePath", f"{self.path}/{s}/{table}").parquet(f"{self.path}/{s}/{table}")
            out = part if out is None else out.unionByName(part)
        if keys is not None:
            touched = [r[0] for r in keys.select(self._bucket(F.col("key")).alias("b")).distinct().collect()]  # at most `buckets` numbers
            out = out.where(F.col("bucket").isin(touched)).join(keys.select(F.col("key").alias(columns)).distinct(), columns, "left_semi")
        return out.drop("bucket")

    def remaps(self) -> DataFrame:
        """(component, root): components that were merged into others."""
        name = self.manifest()["remaps"]
        return self.spark.read.parquet(f"{self.path}/{name}") if name else self.spark.createDataFrame([], "component long, root long")

    def ordinary(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/ordinary")

    # building ------------------------------------------------------------------------------------------------

    def create(self, items: DataFrame, history_urls: DataFrame, history_titles: DataFrame, ordinary: DataFrame | None = None) -> DataFrame:
        """The first segment, from the history and, in bulk, the items accepted so far; gives the known (ordinal) among them."""
        past = history_titles.select(F.lit(-1).cast("long").alias("ordinal"), F.lit(-1).cast("long").alias("day"), F.lit(0).cast("long").alias("url_node"), "title")
        rows = cut(batches.normalised(batches.rows_of(items).unionByName(past), self.sites), "rows")
        words = batches.ordinary_words(rows.where("title_node is not null").groupBy("title_node").agg(F.min("plain").alias("plain"))) if ordinary is None else ordinary
        words.write.parquet(f"{self.path}/ordinary")
        pages = history_urls.select(batches.url_node(F.col("url")).alias("url_node")).where("url_node is not null").select(F.lit(-1).cast("long").alias("ordinal"), F.lit(-1).cast("long").alias("day"), "url_node", F.lit(None).cast("long").alias("title_node"), F.lit("").alias("units"), F.lit("").alias("plain"))
        return self._add(rows.unionByName(pages))[0]

    def append(self, items: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
        """One batch: (known, revised, report). known(ordinal) of the batch, revised(ordinal) of earlier ones, and how much was read."""
        return self._add(cut(batches.normalised(batches.rows_of(items), self.sites), "rows"))

    def _add(self, rows: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
        before = self.manifest()
        rows = rows.withColumn("url_node", F.nullif("url_node", F.lit(0).cast("long"))).withColumn("node", F.coalesce("title_node", "url_node")).where("node is not null")
        titles = cut(rows.where("title_node is not null").groupBy("title_node").agg(F.min("units").alias("units"), F.min("plain").alias("plain")), "titles")
        halves = cut(batches.half_keys(titles), "halves")
        met = self.read("halves", halves.select(F.col("half").alias("key"))).select(F.col("title_node").alias("key")).distinct()
        opened = cut(self.read("titles", cut(met, "met")), "opened")
        both = titles.unionByName(opened).dropDuplicates(["title_node"])
        links = batches.title_links(both, self.ordinary())
        pairs = rows.where("url_node is not null and title_node is not null").select(F.col("url_node").alias("a"), F.col("title_node").alias("b")).distinct()
        edges = cut(links.unionByName(pairs), "edges")
        nodes = cut(edges.select(F.explode(F.array("a", "b")).alias("key")).unionByName(rows.select(F.col("node").alias("key"))).distinct(), "nodes")
        # what the index knows of these nodes, with merged components followed to their root
        remaps = self.remaps()
        stored = self.read("components", nodes).join(remaps, "component", "left").select(F.col("node").alias("key"), F.coalesce("root", "component").alias("root"))
        placed = cut(nodes.join(stored, "key", "left").select("key", F.coalesce("root", "key").alias("at"), F.col("root").isNotNull().alias("old")), "placed")
        left, right = placed.select(F.col("key").alias("a"), F.col("at").alias("at_a")), placed.select(F.col("key").alias("b"), F.col("at").alias("at_b"))
        merged = connected_components(edges.join(left, "a").join(right, "b").select(F.col("at_a").alias("a"), F.col("at_b").alias("b")))
        now = cut(placed.join(merged, F.col("at") == F.col("node"), "left").select("key", "at", "old", F.coalesce("component", "at").alias("component")), "now")
        moved = now.where("old and at <> component").select(F.col("at").alias("component"), F.col("component").alias("root")).distinct()
        # first days: of the batch, and of every stored part of the touched components
        days = rows.join(now, F.col("node") == F.col("key")).groupBy("component").agg(F.min("day").alias("first"))
        roots = cut(now.where("old").select(F.col("at").alias("root"), F.col("component").alias("into")).distinct(), "roots")
        parts = cut(roots.select("root", "into", F.col("root").alias("key")).unionByName(roots.join(remaps, "root").select("root", "into", F.col("component").alias("key"))), "parts")
        firsts = self.read("firsts", parts.select("key")).join(parts, F.col("component") == F.col("key")).groupBy("root", "into").agg(F.min("first").alias("first"))
        whole = cut(days.unionByName(firsts.select(F.col("into").alias("component"), "first")).groupBy("component").agg(F.min("first").alias("first")), "firsts")
        batch = cut(rows.where("ordinal >= 0").join(now, F.col("node") == F.col("key")).select("component", "ordinal", "day"), "batch")
        known = cut(batch.join(whole, "component").where("first < day").select("ordinal").distinct(), "known")
        # rows of the first day of a component that now begins earlier
        earlier = firsts.withColumnRenamed("first", "was").join(whole, F.col("into") == F.col("component")).where("first < was").select("root", "was")
        changed = cut(parts.join(earlier, "root").select("key", "was"), "changed")
        revised = cut(self.read("places", changed.select("key")).join(changed, F.col("component") == F.col("key")).where("day = was").select("ordinal").distinct(), "revised")
        # the segment
        name = f"segment-{before['number'] + 1}-{uuid.uuid4().hex[:8]}"
        fresh = now.where("not old").select(F.col("key").alias("title_node"))
        fresh_titles = cut(titles.join(fresh, "title_node", "left_semi"), "fresh")
        self._write(halves.join(fresh, "title_node", "left_semi").select("half", "title_node"), name, "halves")
        self._write(fresh_titles, name, "titles")
        self._write(now.where("not old").select(F.col("key").alias("node"), "component"), name, "components")
        self._write(days, name, "firsts")
        self._write(batch, name, "places")
        renamed = f"remaps-{before['number'] + 1}-{uuid.uuid4().hex[:8]}"
        old = remaps.join(moved.select(F.col("component").alias("_c"), F.col("root").alias("_r")), F.col("root") == F.col("_c"), "left").select("component", F.coalesce("_r", "root").alias("root"))
        old.unionByName(moved).write.parquet(f"{self.path}/{renamed}")
        count, new = rows.count(), fresh_titles.count()
        self._commit({"number": before["number"] + 1, "segments": [*before["segments"], {"name": name, "level": 0, "rows": count, "titles": new}], "remaps": renamed})
        report = {"rows": count, "known": known.count(), "revised": revised.count(), "titles_new": new, "titles_opened": opened.count(), "titles_stored": sum(s["titles"] for s in before["segments"])}
        return known, revised, report

    def compact(self, fan: int = FAN) -> list[str]:
        """Merge `fan` segments of a level into one of the next, while there are so many; names of the segments merged away. Others stay untouched."""
        gone: list[str] = []
        while True:
            manifest = self.manifest()
            levels: dict[int, list[dict]] = {}
            for s in manifest["segments"]:
                levels.setdefault(s["level"], []).append(s)
            level = next((v for v, many in sorted(levels.items()) if len(many) >= fan), None)
            if level is None:
                return gone
            merged = levels[level][:fan]
            name = f"segment-{manifest['number'] + 1}-{uuid.uuid4().hex[:8]}"
            held = [s["name"] for s in merged if s["rows"]]
            for table, (_, schema) in TABLES.items():
                parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{s}/{table}").select([c.split()[0] for c in schema.split(", ")]) for s in held]
                if parts:
                    union = parts[0]
                    for p in parts[1:]:
                        union = union.unionByName(p)
                    self._write(union, name, table)
            kept = [s for s in manifest["segments"] if s not in merged]
            self._commit({**manifest, "number": manifest["number"] + 1, "segments": [*kept, {"name": name, "level": level + 1, "rows": sum(s["rows"] for s in merged), "titles": sum(s["titles"] for s in merged)}]})
            gone += [s["name"] for s in merged]
