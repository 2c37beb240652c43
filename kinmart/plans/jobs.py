"""The jobs that rebuild a mart, each one transaction over the table store.

A layer becomes current only after its gate has passed; its results are recorded either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmart.config import Settings
from kinmart.operators import conform as conforming
from kinmart.operators import selection
from kinmart.operators.fingerprints import (
    by_popcount,
    publish_library,
    text_fingerprints,
    text_rejects,
)
from kinmart.operators.ranking import latest_per_key
from kinmart.operators.similarity import (
    read_scores,
    require_complete,
    require_fingerprints,
    require_unique,
    search,
    write_scores,
)
from kinmart.plans import mart
from kinmart.plans import quality as q
from kinmart.schemas import KEY, QUALITY_CHECK, WATERMARK
from kinmart.sources import batches, release
from kinmart.sources.store import TableStore, Transaction
from kinmart.streaming.ingest import Landing, Resource
from kinmart.workspace import scratch, stage

LIBRARY = "silver.fingerprint"
LIBRARY_REJECTS = "silver.fingerprint_rejected"
TOP = "silver.similarity_top"
LIBRARY_BY_BITS = "silver.fingerprint_by_bits"
SCORES = "silver.similarity_score"
SCORE_ORDER = "silver.similarity_score_order"
LOOKUP = "bronze.id_lookup"
HISTORY = "_history/quality_check"
WATERMARK_TABLE = "meta.ingest_watermark"


def tidy(job: Callable) -> Callable:
    """Remove what a job has staged when it ends; a table it returns stays."""

    @wraps(job)
    def run(*args, **kwargs):
        with scratch() as held:
            made = job(*args, **kwargs)
            return held.keep(made) if hasattr(made, "staged_at") else made

    return run


def quality_history(store: TableStore) -> DataFrame:
    """Every recorded check result."""
    stamp = T.StructField("checked_at", T.TimestampType())
    schema = T.StructType([*QUALITY_CHECK.fields, stamp])
    return store.spark.read.schema(schema).parquet(f"{store.path}/{HISTORY}")


def record_results(store: TableStore, results: DataFrame) -> None:
    """Add results to the history; those of the same run and layer are replaced.

    The history only grows by what is recorded. It lies outside the store's commits, so a
    gate that fails keeps its evidence while its tables are dropped.
    """
    (
        results.withColumn("checked_at", F.current_timestamp())
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "layer")
        .parquet(f"{store.path}/{HISTORY}")
    )


def latest_results(history: DataFrame) -> DataFrame:
    """The newest result of every check, whichever run produced it."""
    return latest_per_key(history, ["check_name"], "checked_at")


def _gate(store: TableStore, work: Transaction, run_id: str, layer: str, s: Settings) -> DataFrame:
    def record(results: DataFrame) -> None:
        record_results(store, results)

    return q.run_gate(run_id, work, record, (layer,), s)


@tidy
def drain_release(
    store: TableStore,
    release_name: str,
    raw: Mapping[str, DataFrame],
    surrogate: str,
    force: bool = False,
) -> dict[str, int]:
    """The four tables of a full release to bronze, all at once; returns their rows.

    ``raw`` holds the release's frames by bronze table name. A release that is already
    loaded is skipped unless forced.
    """
    loaded = WATERMARK_TABLE in store and not (
        store[WATERMARK_TABLE].where((F.col("release") == release_name) & F.col("is_complete"))
    ).isEmpty()
    if loaded and not force:
        return {}
    keys = release.key_map(raw[q.DICTIONARY], surrogate)
    made = {
        q.DICTIONARY: release.drain_dictionary(raw[q.DICTIONARY]),
        q.PROPERTIES: release.drain_properties(raw[q.PROPERTIES], keys, surrogate),
        q.STRUCTURES: release.drain_structures(raw[q.STRUCTURES], keys, surrogate),
        LOOKUP: release.drain_lookup(raw[LOOKUP]),
    }
    done = [(name, release_name, 0, None, True) for name in ("molecule", "id_lookup")]
    with store.transaction() as work:
        counts = {name: work.write(name, frame).count() for name, frame in made.items()}
        work.write(WATERMARK_TABLE, store.spark.createDataFrame(done, WATERMARK).coalesce(1))
    return counts


@tidy
def publish_landed(store: TableStore, landing: Landing, resources: Iterable[Resource]) -> None:
    """Tables a landing folder holds become the current bronze tables, together."""
    with store.transaction() as work:
        for resource in resources:
            for name in resource.tables:
                work.write(f"bronze.{name}", landing.table(name))


@tidy
def land_inputs(store: TableStore, path: str) -> DataFrame:
    """Batch files under ``path`` replace the input rows; returns unknown headers."""
    landed = batches.land_batches(store.spark, path)
    store.write(q.INPUTS, landed.rows)
    return stage(landed.unknown_headers, "unknown-headers")


@tidy
def build_silver(store: TableStore, run_id: str, settings: Settings = Settings()) -> DataFrame:
    """Bronze tables to silver molecules."""
    with store.transaction() as work:
        bronze = (work[name] for name in (q.DICTIONARY, q.PROPERTIES, q.STRUCTURES))
        work.write(q.MOLECULES, conforming.conform(*bronze))
        return _gate(store, work, run_id, "silver", settings)


@tidy
def build_sources(store: TableStore, run_id: str, settings: Settings = Settings()) -> DataFrame:
    """Input rows to the source set and the rejected rows."""
    with store.transaction() as work:
        molecules, inputs = work[q.MOLECULES], work[q.INPUTS]
        work.write(q.SOURCES, selection.source_set(molecules, inputs, settings.target_size))
        work.write(q.REJECTED, selection.rejected_rows(molecules, inputs))
        return _gate(store, work, run_id, "source", settings)


@tidy
def build_library(
    store: TableStore, settings: Settings = Settings(), features: str = "ngrams"
) -> int:
    """Silver molecules to the fingerprint library; returns its rows."""
    with store.transaction() as work:
        molecules = work[q.MOLECULES].select(KEY, "canonical_smiles")
        version = store.new_version(LIBRARY)
        made = text_fingerprints(molecules, KEY, "canonical_smiles", settings, features)
        rows = publish_library(made, f"{store.path}/{version}", settings)
        library = work.adopt(LIBRARY, version)
        rejects = work.write(LIBRARY_REJECTS, text_rejects(molecules, KEY, "canonical_smiles"))
        require_complete(molecules, library, rejects)
        require_unique(library)
        version = store.new_version(LIBRARY_BY_BITS)
        by_popcount(library, f"{store.path}/{version}", settings.shard_size)
        work.adopt(LIBRARY_BY_BITS, version)
        return rows


@tidy
def build_mart(
    store: TableStore, run_id: str, settings: Settings = Settings(), archive: bool = False
) -> DataFrame:
    """Score the source set, load dimension and fact; with ``archive`` keep every score too."""
    with store.transaction() as work:
        library = work[LIBRARY]
        sources = work[q.SOURCES].select(F.col(KEY).alias("source_id"))
        require_complete(work[q.MOLECULES], library, work[LIBRARY_REJECTS])
        require_fingerprints(sources, library)
        if archive:
            versions = {name: store.new_version(name) for name in (SCORES, SCORE_ORDER)}
            paths = (f"{store.path}/{version}" for version in versions.values())
            write_scores(library, sources, *paths, settings)
            for name, version in versions.items():
                work.adopt(name, version)
        top = work.write(TOP, search(work[LIBRARY_BY_BITS], sources, settings))
        work.write(q.DIM, mart.dim_molecule(work[q.MOLECULES], top))
        work.write(q.FACT, mart.fact_similarity(top))
        return _gate(store, work, run_id, "gold", settings)


def scores(store: TableStore, source_ids: Iterable[str] | None = None) -> DataFrame:
    """The archived scores of the last build that kept them, of some sources or of all."""
    current = store.current()
    paths = (f"{store.path}/{current[name]}" for name in (SCORES, SCORE_ORDER))
    wanted = None if source_ids is None else list(source_ids)
    return read_scores(store.spark, *paths, wanted)


def create_views(store: TableStore, settings: Settings = Settings()) -> list[str]:
    """Register the five delivery views and the latest check results in the session."""
    fact, dim = store[q.FACT], store[q.DIM]
    views = {
        "v_avg_similarity_per_source": mart.avg_similarity(fact),
        "v_avg_alogp_deviation": mart.avg_deviation(fact, dim),
        "v_similarity_pivot": mart.similarity_pivot(fact, settings.pivot_sources),
        "v_similarity_neighbours": mart.similarity_neighbours(fact),
        "v_avg_similarity_rollup": mart.similarity_rollup(fact, dim),
        "v_quality_latest": latest_results(quality_history(store)),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
