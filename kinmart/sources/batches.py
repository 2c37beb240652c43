"""Delimited batch files whose headers drift, landed row by row with their exact position.

Files are read as lines, so a file of any size is split over tasks. A quoted value may hold
line breaks, so whether a line starts a record depends on the lines before it. A task doesn't
know how its split opens and follows both cases: it joins lines that no case begins a record
with, numbers the records of either case, and reports how the split ends in either. One row a
split then tells, over the splits of each file, which case holds and how many records came
before. Lines are read once and stay in their tasks; only records that a split's border cuts,
or that look cut until the case is known, are brought together.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmart.schemas import INPUT_COLUMNS, NAME_COLUMN
from kinmart.workspace import stage

# What a line does to the quoting state: leave it, end outside quotes, end inside, swap.
KEEP, OUTSIDE, INSIDE, SWAP = range(4)

_UNQUOTED = r'[^,"][^,]*'
_CLOSED = rf'"(?:[^"]|"")*"(?:{_UNQUOTED})?'
_FIELD = re.compile(rf"(?:{_CLOSED}|{_UNQUOTED}|)(?:,|$)", re.DOTALL)
_ENDS = r"(?U)^\s+|\s+$"
_REST = re.compile(rf'(?:[^"]|"")*"(?!")(?:{_UNQUOTED})?(?:,|$)', re.DOTALL)


class UnnamedBatches(ValueError):
    """Batch files whose rows carry no name to resolve."""


@dataclass(frozen=True)
class Batches:
    """Landed rows, headers no column is known for, and files without a name column."""

    rows: DataFrame
    unknown_headers: DataFrame
    refused: DataFrame


def _ends_inside(line: str, position: int) -> bool:
    """Whether a line is inside quotes at its end, read from a field start."""
    while position < len(line):
        field = _FIELD.match(line, position)
        if field is None:
            return True
        if field.end() == len(line):
            return False
        position = field.end()
    return False


def line_effect(line: str | None) -> int:
    """KEEP, OUTSIDE, INSIDE or SWAP for one line; null stands for a line without quotes."""
    if not line or '"' not in line:
        return KEEP
    from_outside = _ends_inside(line, 0)
    rest = _REST.match(line)
    from_inside = _ends_inside(line, rest.end()) if rest else True
    if from_outside == from_inside:
        return INSIDE if from_outside else OUTSIDE
    return SWAP if from_outside else KEEP


@F.pandas_udf(T.ArrayType(T.StringType()))
def _cells(records: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Cells of each record. A blank record has none."""
    for series in records:
        csv.field_size_limit(max(1, *map(len, series)) if len(series) else 1)
        rows = (next(csv.reader(io.StringIO(text, newline="")), []) for text in series)
        yield pd.Series(list(rows), dtype=object)


def _split_cells(record: Column) -> Column:
    """Trimmed cells of each record. Only records with a quote need a parser."""
    plain = F.when(record != "", F.split(record, ",", -1)).otherwise(F.array().cast("array<string>"))
    quoted = F.contains(record, F.lit('"'))
    cells = F.when(quoted, _cells(F.when(quoted, record).otherwise(""))).otherwise(plain)
    return F.transform(cells, lambda x: F.regexp_replace(x, _ENDS, ""))


def _carry(df: DataFrame, effect: str, keys: list[str], order: str, out: str) -> DataFrame:
    """The combined effect of all rows before each one, within ``keys``: column ``out``."""
    window = Window.partitionBy(*keys).orderBy(order)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col(effect) == SWAP).cast("int")
    fixed = F.col(effect).isin(OUTSIDE, INSIDE)
    swaps_before = F.coalesce(F.sum(swap).over(before), F.lit(0))
    counted = df.withColumn("_swaps", F.sum(swap).over(upto)).withColumn("_past", swaps_before)
    mark = F.when(fixed, F.struct(F.col(effect).alias("state"), F.col("_swaps").alias("swaps")))
    marked = counted.withColumn("_mark", F.last(mark, ignorenulls=True).over(before))
    odd = (F.col("_past") - F.coalesce(F.col("_mark.swaps"), F.lit(0))) % 2 == 1
    state = F.col("_mark.state")
    return marked.withColumn(
        out,
        F.when(state.isNull(), F.when(odd, SWAP).otherwise(KEEP))
        .when(odd, F.when(state == INSIDE, OUTSIDE).otherwise(INSIDE))
        .otherwise(state),
    ).drop("_swaps", "_past", "_mark")


def _then(first: Column, second: Column) -> Column:
    """The effect of ``first`` followed by ``second``."""
    swapped = F.when(first == SWAP, KEEP).when(first == KEEP, SWAP)
    swapped = swapped.when(first == INSIDE, OUTSIDE).otherwise(INSIDE)
    fixed = second.isin(OUTSIDE, INSIDE)
    return F.when(fixed, second).when(second == SWAP, swapped).otherwise(first)


def _below(spark: SparkSession, path: str, file: Column) -> Column:
    """The part of a file's address below the folder that is read, or its bare name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place)
    bare = F.url_decode(F.regexp_replace(file, r"\+", "%2B"))
    inside = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    folder = root.toUri().getPath().rstrip("/") + "/"
    start = F.instr(inside, folder)
    return F.when(start > 0, F.substr(inside, start + F.lit(len(folder)))).otherwise(
        F.element_at(F.split(inside, "/"), -1)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all .csv files under ``path``, the extension in any case.

    Columns: path, source_file (the path below the folder, so that files of one name in two
    folders stay apart), split (where the task's part of the file starts), line. Bytes that are
    not UTF-8 become replacement characters.
    """
    reader = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.[cC][sS][vV]")
    return reader.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        _below(spark, path, F.col("_metadata.file_path")).alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.make_valid_utf8("value").alias("line"),
    )


PIECE = (
    "path string, source_file string, split bigint, seq bigint, text string, begins_out boolean, "
    "begins_in boolean, next_out boolean, next_in boolean, n_out bigint, n_in bigint, "
    "end_out int, end_in int"
)
_PIECE_FIELDS = tuple(part.split()[0] for part in PIECE.split(", "))
_PIECE_KINDS = (
    [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    + [pa.bool_()] * 4
    + [pa.int64()] * 2
    + [pa.int32()] * 2
)
#: Splits whose openings may be sent to every task: some 100 bytes each.
_OPENINGS_TO_SEND = 200_000


class _Split:
    """One split of a file, line by line, under both states it may open in."""

    def __init__(self, path: str, source_file: str, split: int, longest: int | None):
        self.name, self.longest = (path, source_file, split), longest
        # A file opens outside quotes; of any other split both cases are followed.
        self.states = [OUTSIDE, INSIDE if split else OUTSIDE]
        self.seq, self.counts = 0, np.zeros(2, np.int64)
        self.open: list[str] = []
        self.held, self.begun = 0, (False, False)

    def _piece(self, following: tuple, ends: tuple) -> pa.RecordBatch:
        """The piece that is open, closed."""
        row = (*self.name, self.seq, "\n".join(self.open), *self.begun, *following, *self.counts, *ends)
        self.seq += 1
        self.open, self.held = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, _PIECE_KINDS)], names=_PIECE_FIELDS
        )

    def _extend(self, lines: pa.Array) -> None:
        if len(lines):
            self.open.extend(lines.to_pylist())
            self.held += len(lines) + pc.sum(pc.utf8_length(lines)).as_py()
            if self.longest is not None and self.held > self.longest + 1:
                raise ValueError(f"a record of over {self.longest} characters in {self.name[0]}")

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """Pieces that are whole: lines up to the next that begins a record in some case."""
        n = len(lines)
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        begins = np.empty((2, n), bool)
        at = 0
        for place in quoted.tolist():
            begins[:, at : place + 1] = np.array(self.states)[:, None] == OUTSIDE
            at, effect = place + 1, line_effect(lines[place].as_py())
            if effect == SWAP:
                self.states = [INSIDE if s == OUTSIDE else OUTSIDE for s in self.states]
            elif effect != KEEP:
                self.states = [effect, effect]
        begins[:, at:] = np.array(self.states)[:, None] == OUTSIDE
        starts = np.flatnonzero(begins.any(axis=0))
        if not len(starts):
            self._extend(lines)
            return
        first = int(starts[0])
        if self.open or first:
            self._extend(lines.slice(0, first))
            yield self._piece(tuple(begins[:, first].tolist()), (None, None))
        # All but the last of these are whole; most are one line.
        sizes = np.diff(starts)
        whole = len(sizes)
        if whole:
            texts = lines.take(pa.array(starts[:-1]))
            if (sizes > 1).any():
                held = texts.to_pylist()
                for k in np.flatnonzero(sizes > 1).tolist():
                    held[k] = "\n".join(lines.slice(starts[k], sizes[k]).to_pylist())
                texts = pa.array(held, pa.string())
            flags, counts = begins[:, starts], np.cumsum(begins[:, starts], axis=1)
            columns = [pa.array([v], k).take(pa.array(np.zeros(whole, np.int64))) for v, k in zip(self.name, _PIECE_KINDS)]
            columns += [pa.array(np.arange(whole) + self.seq), texts]
            columns += [pa.array(flags[k, :-1]) for k in (0, 1)] + [pa.array(flags[k, 1:]) for k in (0, 1)]
            columns += [pa.array(counts[k, :-1] + self.counts[k]) for k in (0, 1)]
            columns += [pa.nulls(whole, pa.int32())] * 2
            if self.longest is not None and pc.max(pc.utf8_length(texts)).as_py() > self.longest:
                raise ValueError(f"a record of over {self.longest} characters in {self.name[0]}")
            self.seq += whole
            yield pa.RecordBatch.from_arrays(columns, names=_PIECE_FIELDS)
        self.counts = self.counts + begins[:, starts].sum(axis=1)
        self.begun = tuple(begins[:, starts[-1]].tolist())
        self._extend(lines.slice(int(starts[-1])))

    def end(self) -> pa.RecordBatch:
        return self._piece((None, None), tuple(self.states))


def scan_splits(lines: DataFrame, longest: int | None) -> DataFrame:
    """Pieces of records of every split, and how each split ends; made inside the tasks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            if not batch.num_rows:
                continue
            paths = batch.column("path").dictionary_encode().indices.to_numpy()
            places = batch.column("split").to_numpy()
            cuts = np.flatnonzero((np.diff(paths) != 0) | (np.diff(places) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                name = [batch.column(c)[low].as_py() for c in ("path", "source_file", "split")]
                if split is None or tuple(name) != split.name:
                    if split is not None:
                        yield split.end()
                    split = _Split(*name, longest)
                yield from split.add(batch.column("line").slice(low, high - low))
        if split is not None:
            yield split.end()

    return lines.select("path", "source_file", "split", "line").mapInArrow(scan, PIECE)


def read_records(lines: DataFrame, longest: int | None = None) -> DataFrame:
    """Whole records with their place in the file: path, source_file, source_row, record.

    Blank lines are records, and a quoted line break does not start one. A quote that is never
    closed makes the rest of its file one record; ``longest``, in characters, refuses longer
    ones by name of their file. Without it any record lands.
    """
    pieces = stage(scan_splits(lines, longest), "batch-pieces")
    inside_ends = F.col("end_in") == INSIDE
    whole = F.when(F.col("end_out") == OUTSIDE, F.when(inside_ends, KEEP).otherwise(OUTSIDE)).otherwise(
        F.when(inside_ends, INSIDE).otherwise(SWAP)
    )
    splits = pieces.where("end_out is not null").select("path", "split", "n_out", "n_in", whole.alias("whole"))
    opened = _carry(splits, "whole", ["path"], "split", "opening").withColumn(
        "outside", _then(F.lit(OUTSIDE), F.col("opening")) == OUTSIDE
    )
    started = F.when(F.col("outside"), F.col("n_out")).otherwise(F.col("n_in"))
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        opened.select(
            "path", "split", "outside", F.coalesce(F.sum(started).over(earlier), F.lit(0)).alias("offset")
        ),
        "batch-splits",
    )
    if offsets.count() <= _OPENINGS_TO_SEND:
        offsets = F.broadcast(offsets)

    def of_case(name: str) -> Column:
        return F.when(F.col("outside"), F.col(f"{name}_out")).otherwise(F.col(f"{name}_in"))

    numbered = pieces.join(offsets, ["path", "split"]).select(
        "path",
        "source_file",
        "split",
        "seq",
        "text",
        (F.col("offset") + of_case("n")).alias("source_row"),
        (of_case("begins") & F.coalesce(of_case("next"), of_case("end") == OUTSIDE)).alias("is_whole"),
    )
    alone = numbered.where("is_whole").select("path", "source_file", "source_row", F.col("text").alias("record"))
    held = F.array_sort(F.collect_list(F.struct("split", "seq", "text")))
    joined = F.array_join(F.transform(held, lambda piece: piece["text"]), "\n")
    if longest is not None:
        refuse = F.raise_error(F.concat(F.lit(f"a record of over {longest} characters in "), "path"))
        joined = F.when(F.sum(F.length("text") + 1) <= longest + 1, joined).otherwise(refuse)
    cut = numbered.where("not is_whole").groupBy("path", "source_file", "source_row")
    return alone.unionByName(cut.agg(joined.alias("record")))


def _normal_header(cell: Column) -> Column:
    bare = F.regexp_replace(cell, r"^\uFEFF+", "")
    return F.lower(F.regexp_replace(bare, r"(?U)^\s+|\s+$", ""))


def _cell(name: str) -> Column:
    """The value under a header; the last one when a header repeats, null when absent."""
    from_end = F.array_position(F.reverse("headers"), name)
    value = F.get("cells", (F.size("headers") - from_end).cast("int"))
    return F.when(from_end > 0, F.nullif(value, F.lit("")))


def land_batches(
    spark: SparkSession, path: str, longest: int | None = None, strict: bool = True
) -> Batches:
    """Parse every batch file under ``path`` onto the union of the known columns.

    A file with a header but no name column is refused: with ``strict`` nothing lands, without
    it the other files do, and ``refused`` lists it with its headers. Header names keep their
    place by name, so files may differ; row numbers count records with the header as row one.
    """
    cells = read_records(read_lines(spark, path), longest).select(
        "path", "source_file", "source_row", _split_cells(F.col("record")).alias("cells")
    )
    headers = stage(
        cells.where("source_row = 1").select(
            "path", "source_file", F.transform("cells", _normal_header).alias("headers")
        ),
        "headers",
    )
    named = F.array_contains("headers", NAME_COLUMN)
    refused = headers.where(~named).select("source_file", "headers")
    if strict and (first := refused.orderBy("source_file").first()):
        raise UnnamedBatches(f"no {NAME_COLUMN} among {first.headers} of {first.source_file}")

    filled = cells.where("source_row > 1").where(F.exists("cells", lambda cell: cell != ""))
    rows = filled.join(headers.where(named).select("path", "headers"), "path").select(
        "source_file", "source_row", *[_cell(name).alias(name) for name in INPUT_COLUMNS]
    )
    unknown = (
        headers.select("source_file", F.explode("headers").alias("header"))
        .where(~F.col("header").isin(*INPUT_COLUMNS))
        .distinct()
    )
    return Batches(rows, unknown, refused)
