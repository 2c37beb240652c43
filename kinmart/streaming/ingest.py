"""Page files of a resource to bronze: resumable, with progress recorded page by page.

Spark's checkpoint remembers which files were read. Rows and progress are written under the
micro-batch's number, so a batch that is run again replaces itself and nothing counts twice.
A page is known by its offset, and one that states none by the identifiers of its records, so
what is delivered twice counts once, corrected or not, and a run is complete only when its pages
cover the release without a gap.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmart.schemas import KEY
from kinmart.sources.records import MoleculeLayout, lookup_rows, molecule_tables
from kinmart.sources.store import Folder
from kinmart.streaming.upserts import (
    ARRIVAL,
    BATCH,
    append_batch,
    fold,
    pieces,
    read_latest,
    read_pieces,
)

Loader = Callable[[DataFrame], dict[str, DataFrame]]

PROGRESS = (
    "epoch bigint, release string, batch bigint, page string, offset bigint, records bigint, "
    "total_count bigint, table string, nameless array<string>"
)


def arrivals(lines: DataFrame) -> DataFrame:
    """Text of page files with where and when each line came: value, seen, file, split."""
    return lines.select(
        "value",
        F.col("_metadata.file_modification_time").alias("seen"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
    )


# Room for the batches of one run over a resource, so that no two runs share a number.
_BATCHES_PER_EPOCH = 1_000_000_000


@dataclass(frozen=True)
class Resource:
    """A paged resource: the key its records sit under, and how they become tables."""

    name: str
    collection: str
    load: Loader
    tables: tuple[str, ...]
    id_field: str = KEY


def _lookup_tables(records: DataFrame) -> dict[str, DataFrame]:
    return {"id_lookup": lookup_rows(records, keep=(ARRIVAL,))}


def molecule_loader(layout: MoleculeLayout = MoleculeLayout()) -> Loader:
    """Records of the molecule resource feed three tables."""

    def load(records: DataFrame) -> dict[str, DataFrame]:
        tables = molecule_tables(records, layout=layout, keep=(ARRIVAL,))
        return {
            "molecule_dictionary": tables.dictionary,
            "compound_properties": tables.properties,
            "compound_structures": tables.structures,
        }

    return load


MOLECULE = Resource(
    "molecule",
    "molecules",
    molecule_loader(),
    ("molecule_dictionary", "compound_properties", "compound_structures"),
)
ID_LOOKUP = Resource("id_lookup", "id_lookups", _lookup_tables, ("id_lookup",))


@dataclass(frozen=True)
class Watermark:
    """How far a resource got, and which release that progress belongs to."""

    resource: str
    release: str
    epoch: int
    next_offset: int
    total_count: int | None
    is_complete: bool
    landed: int = 0


class Landing:
    """Bronze tables of one landing folder, fed from page files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A landed table, the newest row of every key."""
        # Pages have an order of their own, whichever micro-batch read them.
        return read_latest(self.spark, f"{self.path}/{name}", [KEY], (ARRIVAL, BATCH))

    def pages(self, resource: str) -> DataFrame:
        """Every distinct page landed, by run: its offset, if it states one, and its records."""
        rows = self._progress(resource)
        return rows.groupBy("epoch", "release", "page").agg(
            F.max("offset").alias("offset"),
            F.max("records").alias("records"),
            F.max("total_count").alias("total_count"),
        )

    def _progress(self, resource: str) -> DataFrame:
        folder = Folder(self.spark, f"{self.path}/_progress/{resource}")
        if not folder.names():
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).parquet(folder.path)

    def _loose(self, resource: str) -> DataFrame:
        """(epoch, loose): by run, the different records that only pages without offsets held.

        A record is known by its identifier, so a corrected page adds nothing. Records without
        one are known by their content. Of a release that holds an identifier twice, pages
        without offsets never count as complete.
        """
        rows = self._progress(resource).where("offset is null")
        nothing = self.spark.createDataFrame([], "epoch bigint, loose bigint")
        first = rows.select("table").first()
        if first is None:
            return nothing
        bare = rows.select("epoch", F.explode("nameless").alias("id")).distinct()
        found = bare.groupBy("epoch").agg(F.count("*").alias("loose"))
        landed = pieces(self.spark, f"{self.path}/{first['table']}")
        if landed:
            place = F.col(f"{ARRIVAL}.at")
            held = read_pieces(self.spark, landed).select(KEY, f"{ARRIVAL}.epoch", place.alias("at"))
            held = held.groupBy("epoch", KEY).agg(F.max("at").alias("at")).where("at < 0")
            found = found.unionByName(held.groupBy("epoch").agg(F.count("*").alias("loose")))
        return found.groupBy("epoch").agg(F.sum("loose").alias("loose"))

    def progress(self, resource: str) -> DataFrame:
        """Per run over a resource: records covered without a gap, and whether that is all.

        Pages with offsets cover the stretch from 0 to the first record that none of them
        holds. Pages without offsets can't leave a gap and add the records that are new.
        """
        placed = F.col("offset").isNotNull()
        end = F.when(placed, F.col("offset") + F.col("records"))
        run = Window.partitionBy("epoch").orderBy(F.col("offset").asc_nulls_last(), "page")
        before = run.rowsBetween(Window.unboundedPreceding, -1)
        reached = F.coalesce(F.max(end).over(before), F.lit(0))
        pages = self.pages(resource).withColumn("gap", F.coalesce(F.col("offset") > reached, F.lit(False)))
        pages = pages.withColumn("cut", F.max("gap").over(run.rowsBetween(Window.unboundedPreceding, 0)))
        covered = F.coalesce(F.max(F.when(~F.col("cut"), end)), F.lit(0))
        complete = F.coalesce(F.col("records") >= F.col("total_count"), F.lit(False))
        loose = F.coalesce("loose", F.lit(0))
        runs = pages.groupBy("epoch", "release").agg(
            covered.alias("covered"),
            F.coalesce(F.sum(F.when(placed, F.col("records"))), F.lit(0)).alias("placed"),
            F.max("total_count").alias("total_count"),
        )
        return (
            runs.join(self._loose(resource), "epoch", "left")
            .select(
                "epoch",
                "release",
                (F.col("covered") + loose).cast("bigint").alias("records"),
                (F.col("placed") + loose).cast("bigint").alias("landed"),
                "total_count",
            )
            .withColumn("is_complete", complete)
        )

    def watermark(self, resource: str) -> Watermark | None:
        """Progress of the latest run over a resource, or None before the first."""
        row = self.progress(resource).orderBy(F.col("epoch").desc()).first()
        if row is None:
            return None
        return Watermark(
            resource,
            row.release,
            row.epoch,
            row.records,
            row.total_count,
            row.is_complete,
            row.landed,
        )

    def ingest(
        self,
        resource: Resource,
        pages: str,
        release: str,
        force: bool = False,
        files_per_batch: int = 6,
        whole_files: bool = True,
        timeout: int | None = None,
    ) -> int:
        """Land the page files under ``pages`` that were not read yet; returns the records of
        pages that are new. Landed batches are folded as they add up.

        A release that is complete is skipped. A new release, or ``force``, starts from the
        first page. Anything else goes on where the last run stopped. A file is one page, or
        without ``whole_files`` every line is.
        """
        mark = self.watermark(resource.name)
        resumes = mark is not None and mark.release == release and not force
        if resumes and mark.is_complete:
            return 0
        epoch = mark.epoch + (not resumes) if mark else 0
        before = mark.landed if resumes else 0

        reader = self.spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        stream = arrivals(reader.text(pages, wholetext=whole_files))
        query = (
            stream.writeStream.foreachBatch(self._land(resource, release, epoch))
            .option("checkpointLocation", f"{self.path}/_checkpoints/{resource.name}/{epoch}")
            .trigger(availableNow=True)
            .start()
        )
        try:
            if not query.awaitTermination(timeout) and timeout is not None:
                raise TimeoutError(f"{resource.name} was not landed within {timeout} s")
        finally:
            query.stop()
        for name in resource.tables:
            # Pages have an order of their own, whichever micro-batch read them.
            fold(self.spark, f"{self.path}/{name}", [KEY], (ARRIVAL, BATCH))
        mark = self.watermark(resource.name)
        return mark.landed - before if mark and mark.epoch == epoch else 0

    def _land(self, resource: Resource, release: str, epoch: int) -> Callable:
        meta = T.StructType(
            [T.StructField("offset", T.LongType()), T.StructField("total_count", T.LongType())]
        )
        page_type = T.StructType(
            [
                T.StructField(resource.collection, T.ArrayType(T.StringType())),
                T.StructField("page_meta", meta),
            ]
        )

        def land(batch: DataFrame, batch_id: int) -> None:
            number = epoch * _BATCHES_PER_EPOCH + batch_id
            parsed = F.from_json("value", page_type, {"mode": "FAILFAST"}).alias("page")
            came = ("seen", "file", "split", "line")
            numbered = batch.withColumn("line", F.monotonically_increasing_id())
            pages = numbered.select(parsed, F.md5("value").alias("content"), *came).select(
                "page.*", "content", *came
            )
            pages = pages.persist()
            try:
                self._land_pages(resource, release, epoch, batch_id, number, pages)
            finally:
                pages.unpersist()

        return land

    def _land_pages(
        self,
        resource: Resource,
        release: str,
        epoch: int,
        batch_id: int,
        number: int,
        pages: DataFrame,
    ) -> None:
        """Rows of one micro-batch, then its progress.

        Within a run the place in the release decides which row is newest. Pages that state no
        offset are taken in the order in which they came: by batch, file time, file, and line.
        """
        offset = F.col("page_meta.offset")
        exploded = pages.select(
            offset.alias("offset"),
            "seen",
            "file",
            "split",
            "line",
            F.posexplode(resource.collection).alias("place", "record"),
        )
        order = F.struct(
            F.lit(epoch).cast("bigint").alias("epoch"),
            F.coalesce(F.col("offset") + F.col("place"), F.lit(-1)).cast("bigint").alias("at"),
            F.lit(batch_id).cast("bigint").alias("batch"),
            "seen",
            "file",
            "split",
            "line",
            "place",
        )
        records = exploded.select(order.alias(ARRIVAL), "record")
        for name, rows in resource.load(records).items():
            append_batch(rows, f"{self.path}/{name}", number, [KEY])
        bare = F.filter(
            F.transform(
                F.coalesce(F.col(resource.collection), F.array().cast("array<string>")),
                lambda r: F.when(
                    F.coalesce(F.get_json_object(r, f"$.{resource.id_field}"), F.lit("")) == "",
                    F.md5(r),
                ),
            ),
            lambda r: r.isNotNull(),
        )
        done = pages.select(
            F.lit(epoch).cast("bigint").alias("epoch"),
            F.lit(release).alias("release"),
            F.lit(batch_id).cast("bigint").alias("batch"),
            F.coalesce(offset.cast("string"), "content").alias("page"),
            offset.alias("offset"),
            F.greatest(F.size(resource.collection), F.lit(0)).cast("bigint").alias("records"),
            F.col("page_meta.total_count").alias("total_count"),
            F.lit(resource.tables[0]).alias("table"),
            F.when(offset.isNull(), bare).alias("nameless"),
        )
        # Written last: progress never runs ahead of the rows it stands for.
        target = f"{self.path}/_progress/{resource.name}/part={number}"
        done.coalesce(1).write.mode("overwrite").parquet(target)
