"""Every registered query. Decimals leave as doubles so that both engines print them alike."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import inputs
from catalog.mart import SETTINGS, document_mart, role, table
from kinmart import Settings
from kinmart.functions.bits import tanimoto
from kinmart.functions.casts import register_safe_numeric, safe_decimal
from kinmart.operators import fingerprints, ranking, selection, similarity
from kinmart.operators.conform import conform
from kinmart.plans import mart as marts
from kinmart.plans import quality as q
from kinmart.plans.jobs import latest_results
from kinmart.schemas import KEY
from kinmart.sources import batches, records, release
from kinmart.sources.store import TableStore
from kinmart.streaming import ingest, upserts
from kinmart.workspace import new_dir, stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.select(
        *[
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )


def query(make: Query) -> Query:
    QUERIES[make.__name__] = lambda spark, sf_dir: plain(make(spark, sf_dir))
    return make


def words_text(library: DataFrame) -> DataFrame:
    """Fingerprint words as one comma-separated text."""
    words = F.array_join(F.col("fp").cast("array<string>"), ",")
    return library.select("item_id", "pc", words.alias("words"))


# Landing


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.expr(inputs.EVENT_RECORD).alias("record"))


@query
def land_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.expr(inputs.CUSTOMER_RECORD).alias("record"))
    return records.lookup_rows(rows)


@query
def land_dictionary(spark, sf_dir):
    return records.molecule_tables(event_records(spark, sf_dir)).dictionary


@query
def land_properties(spark, sf_dir):
    return records.molecule_tables(event_records(spark, sf_dir)).properties


@query
def land_structures(spark, sf_dir):
    return records.molecule_tables(event_records(spark, sf_dir)).structures


@query
def drain_dictionary(spark, sf_dir):
    return release.drain_dictionary(role(spark, sf_dir, inputs.CUSTOMER_RELEASE))


@query
def drain_properties(spark, sf_dir):
    keys = release.key_map(role(spark, sf_dir, inputs.CUSTOMER_RELEASE), "record_no")
    raw = role(spark, sf_dir, inputs.ORDER_RELEASE_PROPERTIES)
    return release.drain_properties(raw, keys, "record_no")


@query
def drain_structures(spark, sf_dir):
    keys = release.key_map(role(spark, sf_dir, inputs.PART_RELEASE), "record_no")
    raw = role(spark, sf_dir, inputs.LINE_RELEASE_STRUCTURES)
    return release.drain_structures(raw, keys, "record_no")


@query
def drain_lookup(spark, sf_dir):
    return release.drain_lookup(role(spark, sf_dir, inputs.SUPPLIER_RELEASE_LOOKUP))


def batch_files(spark: SparkSession, sf_dir: str) -> str:
    """Delimited files of all parts in three layouts: drifting headers, quotes, line breaks."""
    part = table(spark, sf_dir, "part")
    path = new_dir(spark, "batch_files")

    def write(folder: str, rows: DataFrame) -> None:
        # In order of the key, so that a row's place in its file is known.
        ordered = rows.coalesce(1).sortWithinPartitions("p_partkey").drop("p_partkey")
        ordered.write.option("header", True).option("escape", '"').csv(f"{path}/{folder}")

    size = F.col("p_size")
    key, name = F.col("p_partkey").alias("compound_id"), F.col("p_name").alias("compound_name")
    write("a", part.where(size < 17).select(key, name, F.col("p_brand").alias("lab_id"), "p_partkey"))
    broken = F.concat(F.lit('say "'), "p_name", F.lit('",\nthen '), "p_type")
    write(
        "b",
        part.where((size >= 17) & (size < 34)).select(
            F.col("p_brand").alias("Lab_ID"),
            broken.alias("COMPOUND_NAME"),
            F.col("p_size").alias("IC50_nM"),
            F.col("p_partkey").alias("mystery"),
            "p_partkey",
        ),
    )
    write(
        "c",
        part.where(size >= 34).select(
            F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("compound_name"),
            F.when(size > 45, F.lit("   ")).otherwise(F.lit("2024-01-25")).alias("Collection_Date"),
            F.col("p_type").alias("p_type"),
            "p_partkey",
        ),
    )
    return path


@query
def land_csv(spark, sf_dir):
    landed = batches.land_batches(spark, batch_files(spark, sf_dir)).rows
    layout = F.split("source_file", "/")[0]
    return landed.withColumn("source_file", layout)


@query
def csv_refused(spark, sf_dir):
    """Files without a name column: the supplier table written out as it is."""
    path = new_dir(spark, "nameless")
    named = table(spark, sf_dir, "part").select(F.col("p_name").alias("compound_name"))
    named.write.option("header", True).csv(f"{path}/good")
    table(spark, sf_dir, "supplier").coalesce(1).write.option("header", True).csv(f"{path}/bad")
    landed = batches.land_batches(spark, path, strict=False)
    rows = landed.rows.agg(F.count("*").alias("landed_rows"))
    headers = F.array_join("headers", ",").alias("headers")
    folder = F.split("source_file", "/")[0].alias("folder")
    return landed.refused.select(folder, headers).withColumn("landed_rows", rows.scalar())


@query
def csv_row_numbers(spark, sf_dir):
    """Per layout: rows landed, and rows whose number is not their place in the file."""
    landed = batches.land_batches(spark, batch_files(spark, sf_dir)).rows
    per_file = landed.groupBy("source_file").agg(
        F.count("*").alias("n"),
        F.min("source_row").alias("first"),
        F.max("source_row").alias("last"),
        F.count_distinct("source_row").alias("places"),
    )
    gap = (F.col("first") != 2) | (F.col("last") != F.col("n") + 1) | (F.col("places") != F.col("n"))
    return per_file.agg(
        F.sum("n").cast("bigint").alias("landed_rows"), F.count_if(gap).alias("files_with_gaps")
    )


@query
def csv_unknown_headers(spark, sf_dir):
    unknown = batches.land_batches(spark, batch_files(spark, sf_dir)).unknown_headers
    return unknown.select("header").distinct()


# Casts and conforming


@query
def safe_numeric(spark, sf_dir):
    rows = role(spark, sf_dir, inputs.PART_NUMBERS)
    return rows.select("p_partkey", safe_decimal(F.col("raw")).alias("number"))


def document_bronze(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    given = (inputs.DOCUMENT_DICTIONARY, inputs.DOCUMENT_PROPERTIES, inputs.DOCUMENT_STRUCTURES)
    return [role(spark, sf_dir, each) for each in given]


@query
def conform_molecules(spark, sf_dir):
    made = conform(*document_bronze(spark, sf_dir))
    return made.drop("canonical_smiles")


# Source selection


def customer_case(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    molecules = role(spark, sf_dir, inputs.CUSTOMER_MOLECULES)
    return molecules, role(spark, sf_dir, inputs.ORDER_INPUTS)


@query
def resolve_names(spark, sf_dir):
    return selection.resolve_names(*customer_case(spark, sf_dir))


@query
def rejected_rows(spark, sf_dir):
    return selection.rejected_rows(*customer_case(spark, sf_dir))


@query
def top_up(spark, sf_dir):
    molecules, rows = customer_case(spark, sf_dir)
    return selection.top_up(molecules, selection.resolve_names(molecules, rows), 50)


@query
def source_set(spark, sf_dir):
    mart = document_mart(spark, sf_dir)
    made = selection.source_set(mart.molecules, mart.nation_inputs, SETTINGS.target_size)
    return made.drop("canonical_smiles").orderBy(KEY)


@query
def source_summary(spark, sf_dir):
    mart = document_mart(spark, sf_dir)
    return selection.selection_summary(mart.sources, mart.rejected)


@query
def first_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return ranking.first_per_key(orders, ["o_custkey"], *order)


@query
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "ts", "event_id", "value"
    )
    return ranking.latest_per_key(events, ["user_id", "event_type"], "ts", "event_id").drop("ts")


# Fingerprints


@query
def fingerprint_library(spark, sf_dir):
    return words_text(document_mart(spark, sf_dir).fingerprints())


PUBLISHED = Settings(shard_size=250)


@query
def published_library(spark, sf_dir):
    """The shards a library is published in, each read back from its own folder."""
    path = new_dir(spark, "published")
    fingerprints.publish_library(document_mart(spark, sf_dir).library, path, PUBLISHED)
    return (
        spark.read.parquet(path)
        .select("*", F.col("_metadata.file_path").alias("file"))
        .groupBy(F.col("shard").cast("bigint").alias("shard"))
        .agg(
            F.min("item_id").alias("first_id"),
            F.max("item_id").alias("last_id"),
            F.count("*").alias("items"),
            F.sum("pc").alias("bits"),
            F.max(F.size("fp")).alias("n_words"),
            F.count_distinct("file").alias("files"),
        )
    )


@query
def fingerprint_exchange(spark, sf_dir):
    """Fingerprints as packed bytes, the layout for exchange, and read back from it."""
    library = document_mart(spark, sf_dir).library
    packed = fingerprints.to_packed_bytes(library, SETTINGS.n_bits)
    again = fingerprints.from_packed_bytes(packed, SETTINGS.n_bits)
    hexed = packed.select("item_id", F.lower(F.hex("fingerprint")).alias("packed"))
    return hexed.join(again.select("item_id", "pc"), "item_id")


@query
def qgram_fingerprints(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    settings = Settings(n_bits=512)
    return words_text(fingerprints.text_fingerprints(pages, "page_id", "url", settings, "qgrams"))


@query
def vector_fingerprints(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return words_text(fingerprints.vector_fingerprints(vectors, "vec_id", "embedding", 64))


def patchy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some lack a structure and some have a blank one."""
    return table(spark, sf_dir, "documents").selectExpr(
        f"{inputs.padded('D', 'doc_id')} AS item_id",
        "CASE lang WHEN 'fr' THEN NULL WHEN 'es' THEN ' ' ELSE text END AS structure",
    )


PATCHY = Settings(n_bits=1024, shard_size=100)


@query
def fingerprint_rejects(spark, sf_dir):
    return fingerprints.text_rejects(patchy_documents(spark, sf_dir), "item_id", "structure")


@query
def fingerprint_summary(spark, sf_dir):
    items = patchy_documents(spark, sf_dir)
    library = fingerprints.text_fingerprints(items, "item_id", "structure", PATCHY, "tokens")
    rejects = fingerprints.text_rejects(items, "item_id", "structure")
    return fingerprints.library_summary(library, rejects, PATCHY)


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(f"{inputs.padded('O', 'o_orderkey')} AS id")


@query
def shard_plan(spark, sf_dir):
    return fingerprints.shard_plan(order_keys(spark, sf_dir), "id", 1000, partitions=8)


@query
def range_scan(spark, sf_dir):
    library = document_mart(spark, sf_dir).library
    plan = fingerprints.shard_plan(library, "item_id", 90, partitions=4)
    wanted = plan.where("shard = 1 OR next_id IS NULL").orderBy("shard").collect()
    parts = [
        library.where(fingerprints.in_range(F.col("item_id"), b.first_id, b.next_id)).select(
            F.lit(b.shard).alias("shard"), "item_id", "pc"
        )
        for b in wanted
    ]
    return reduce(DataFrame.unionAll, parts)


# Scoring


@query
def missing_fingerprints(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").selectExpr(
        f"{inputs.padded('D', 'c_custkey')} AS source_id"
    )
    return similarity.missing_fingerprints(wanted, document_mart(spark, sf_dir).library)


@query
def score_table(spark, sf_dir):
    mart = document_mart(spark, sf_dir)
    scored = similarity.score_table(mart.library, mart.source_ids, SETTINGS)
    archived = F.col("score").cast("float").cast("double")
    return scored.select("source_id", "target_id", archived.alias("tanimoto_score"))


@query
def score_archive(spark, sf_dir):
    """The archived score tables read back: rows, self rows and highest score per source."""
    mart = document_mart(spark, sf_dir)
    path, order = new_dir(spark, "scores"), new_dir(spark, "score-order")
    similarity.write_scores(mart.library, mart.source_ids, path, order, SETTINGS)
    return (
        similarity.read_scores(spark, path, order)
        .groupBy("source_id")
        .agg(
            F.count("*").alias("targets"),
            F.count_if(F.col("source_id") == F.col("target_id")).alias("self_rows"),
            F.max("tanimoto_score").cast("double").alias("highest"),
            F.min("tanimoto_score").cast("double").alias("lowest"),
        )
    )


@query
def top_matches(spark, sf_dir):
    mart = document_mart(spark, sf_dir)
    return similarity.search(mart.library_by_bits, mart.source_ids, SETTINGS)


@query
def top_matches_vectors(spark, sf_dir):
    """Short fingerprints tie often. The small pass size makes the search take several passes."""
    vectors = table(spark, sf_dir, "embeddings")
    made = fingerprints.vector_fingerprints(vectors, "vec_id", "embedding", 64)
    library = stage(made, "vectors")
    chosen = vectors.where("vec_id % 20 = 0")
    sources = chosen.select(F.col("vec_id").cast("string").alias("source_id"))
    laid_out = fingerprints.by_popcount(library, new_dir(spark, "vectors-by-bits"))
    return similarity.search(laid_out, sources, Settings(n_bits=64, sources_per_pass=100))


def discount_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as its candidates: at most seven, with many equal scores."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{inputs.padded('O', 'l_orderkey')} AS source_id",
        f"{inputs.padded('L', 'l_linenumber')} AS target_id",
        "CAST(l_discount AS DOUBLE) AS score",
    )


@query
def top_matches_tied(spark, sf_dir):
    return ranking.top_matches(discount_scores(spark, sf_dir), 2, fan_in=4)


@query
def top_matches_short(spark, sf_dir):
    return ranking.top_matches(discount_scores(spark, sf_dir), 10)


@query
def search_summary(spark, sf_dir):
    return similarity.search_summary(document_mart(spark, sf_dir).top)


@query
def pair_scores(spark, sf_dir):
    """Scores of the stored matches worked out again from both fingerprints."""
    mart = document_mart(spark, sf_dir)
    source = mart.library.select(F.col("item_id").alias("source_id"), F.col("fp").alias("a"))
    target = mart.library.select(F.col("item_id").alias("target_id"), F.col("fp").alias("b"))
    again = tanimoto(F.col("a"), F.col("b")).cast("decimal(9,8)")
    return (
        mart.fact.join(source, "source_id")
        .join(target, "target_id")
        .select("source_id", "target_id", again.alias("tanimoto_score"))
    )


# Mart and views


@query
def dim_build(spark, sf_dir):
    mart = document_mart(spark, sf_dir)
    return marts.dim_molecule(mart.molecules, mart.top)


@query
def fact_build(spark, sf_dir):
    return marts.fact_similarity(document_mart(spark, sf_dir).top)


@query
def avg_similarity(spark, sf_dir):
    return marts.avg_similarity(document_mart(spark, sf_dir).fact)


@query
def top_sources(spark, sf_dir):
    return marts.top_sources(document_mart(spark, sf_dir).fact, 3)


@query
def avg_deviation(spark, sf_dir):
    mart = document_mart(spark, sf_dir)
    return marts.avg_deviation(mart.fact, mart.dim)


@query
def pivot_sources(spark, sf_dir):
    return marts.pivot_sources(document_mart(spark, sf_dir).fact, SETTINGS.pivot_sources)


@query
def similarity_pivot(spark, sf_dir):
    """The pivot with its source columns numbered, as their names are data."""
    made = marts.similarity_pivot(document_mart(spark, sf_dir).fact, SETTINGS.pivot_sources)
    names = [f"source_{place:02d}" for place in range(1, len(made.columns))]
    return made.toDF("target_id", *names)


@query
def similarity_neighbours(spark, sf_dir):
    return marts.similarity_neighbours(document_mart(spark, sf_dir).fact)


@query
def similarity_rollup(spark, sf_dir):
    mart = document_mart(spark, sf_dir)
    return marts.similarity_rollup(mart.fact, mart.dim)


@query
def layer_counts(spark, sf_dir):
    mart = document_mart(spark, sf_dir)
    return marts.table_counts(
        {
            "silver.molecule": mart.molecules,
            "silver.source_molecule": mart.sources,
            "silver.source_molecule_rejected": mart.rejected,
            "silver.fingerprint": mart.library,
            "gold.dim_molecule": mart.dim,
            "gold.fact_molecule_similarity": mart.fact,
        }
    )


# Quality. The drafts carry defects, so that every check has something to count.


def silver_draft(spark: SparkSession, sf_dir: str, dropping: bool = False) -> dict[str, DataFrame]:
    """All documents as molecules with defects; ``dropping`` loses those of one language."""
    dictionary, properties, structures = document_bronze(spark, sf_dir)
    silver = conform(dictionary, properties, structures)
    silver = silver.where(F.col("molecule_type") != "es") if dropping else silver
    blanked = F.when(F.col("molecule_type") == "fr", F.lit("  ")).when(
        ~F.coalesce(F.col("ro3_pass"), F.lit(False)), F.col("canonical_smiles")
    )
    molecules = silver.withColumn("canonical_smiles", blanked)
    copies = molecules.where(F.col("aromatic_rings") == 0)
    return {
        q.DICTIONARY: dictionary,
        q.PROPERTIES: properties,
        q.STRUCTURES: structures,
        q.MOLECULES: molecules.unionAll(copies),
    }


def source_draft(spark: SparkSession, sf_dir: str, dropping: bool = False) -> dict[str, DataFrame]:
    """All input rows with defects; ``dropping`` loses some chosen and some rejected ones."""
    molecules, rows = customer_case(spark, sf_dir)
    draft = role(spark, sf_dir, inputs.DRAFT_SOURCES)
    matched = selection.resolve_names(molecules, rows).select(KEY, "canonical_smiles", "origin")
    rejected = selection.rejected_rows(molecules, rows)
    if dropping:
        matched = matched.where(F.col("canonical_smiles") != "BUILDING")
        rejected = rejected.where(F.col("source_file") != "5-LOW")
    kept = rejected.withColumn(
        "source_row", F.when(F.col("reason") != "compound name is blank", F.col("source_row"))
    )
    chosen = matched.unionByName(draft)
    return {q.MOLECULES: molecules, q.INPUTS: rows, q.SOURCES: chosen, q.REJECTED: kept}


def gold_draft(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        q.FACT: role(spark, sf_dir, inputs.DRAFT_FACT),
        q.DIM: role(spark, sf_dir, inputs.DRAFT_DIM),
        q.SOURCES: role(spark, sf_dir, inputs.DRAFT_SOURCES),
    }


DRAFTS = {"silver": silver_draft, "source": source_draft, "gold": gold_draft}
CHECK_SETTINGS = Settings(top_n=600, target_size=100)


#: Checks that count lost rows read a draft that has lost some; all others read every row.
OF_LOST_ROWS = ("every_structure_is_kept", "every_input_row_is_accounted_for")


def draft_observations(spark, sf_dir, layer: str, names: tuple[str, ...] = ()) -> DataFrame:
    lost = {"dropping": True} if set(names) & set(OF_LOST_ROWS) else {}
    return q.observe(DRAFTS[layer](spark, sf_dir, **lost), (layer,), CHECK_SETTINGS, names)


def _register_checks() -> None:
    def single(layer: str, name: str) -> Query:
        return lambda spark, sf_dir: draft_observations(spark, sf_dir, layer, (name,))

    for _, layer, name, *_ in q.rules():
        QUERIES[f"check_{name}"] = single(layer, name)


_register_checks()


@query
def gate_gold(spark, sf_dir):
    """All gold checks in one job."""
    return draft_observations(spark, sf_dir, "gold")


@query
def gate_report(spark, sf_dir):
    """The gate over the finished document mart, as counted from its recorded results."""
    mart = document_mart(spark, sf_dir)
    dictionary, properties, structures = document_bronze(spark, sf_dir)
    tables = {
        q.DICTIONARY: dictionary,
        q.PROPERTIES: properties,
        q.STRUCTURES: structures,
        q.INPUTS: mart.nation_inputs,
        q.MOLECULES: mart.molecules,
        q.SOURCES: mart.sources,
        q.REJECTED: mart.rejected,
        q.DIM: mart.dim,
        q.FACT: mart.fact,
    }
    observed = q.observe(tables, tuple(q.LAYERS), SETTINGS)
    return q.report_counts(q.judge(spark, "documents", observed, SETTINGS))


@query
def check_width(spark, sf_dir):
    """Rows of the library too narrow or wide, or with a wrong bit count, for 2048 bits."""
    library = document_mart(spark, sf_dir).library
    first, rest = F.get("fp", F.lit(0)), F.slice("fp", 2, 31)
    cut = library.select(
        "item_id", F.when(first < 0, rest).otherwise(F.col("fp")).alias("fp"), "pc"
    )
    wrong = fingerprints.wrong_width(cut, 2048)
    return wrong.select("item_id")


@query
def check_library_complete(spark, sf_dir):
    """Distance from complete when the documents of one language are left out."""
    items = patchy_documents(spark, sf_dir)
    library = document_mart(spark, sf_dir).library.select("item_id")
    rejects = fingerprints.text_rejects(items, "item_id", "structure")
    return similarity.library_gap(items, library, rejects)


@query
def quality_latest(spark, sf_dir):
    """The newest recorded result of each check, events standing in for a long history."""
    history = table(spark, sf_dir, "events").selectExpr(
        "concat(event_type, CAST(user_id AS STRING)) AS check_name",
        "CAST(event_id AS STRING) AS run_id",
        "ts AS checked_at",
        "value AS observed",
    )
    return latest_results(history).drop("checked_at")


# Incremental landing


@query
def upsert_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", "ts", "value"
    )
    keys = ["user_id", "event_type"]
    weekend = F.dayofweek("ts").isin(1, 7)
    existing = ranking.latest_per_key(events.where(weekend), keys, "ts", "event_id")
    made = upserts.upsert(existing, events.where(~weekend), keys, "ts", "event_id")
    return made.drop("ts")


PAGE_ROWS = 250


def event_pages(
    spark: SparkSession,
    sf_dir: str,
    path: str | None = None,
    pages: Column | None = None,
    kinds: Column | None = None,
    offsets: bool = True,
) -> str:
    """Events as pages of JSON records, one page a line, over several files.

    ``pages`` picks pages by number, ``kinds`` events. Pages may state no offset.
    """
    events = table(spark, sf_dir, "events")
    total = events.count()
    events = events.where(kinds) if kinds is not None else events
    record = F.struct(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias(KEY),
        F.col("event_type").alias("pref_name"),
        F.col("event_id").cast("int").alias("first_approval"),
    )
    page = F.floor(F.col("event_id") / PAGE_ROWS).alias("page")
    rows = F.array_sort(F.collect_list(F.struct("event_id", record.alias("record"))))
    paged = events.groupBy(page).agg(F.transform(rows, lambda row: row["record"]).alias("molecules"))
    total_count = F.lit(total).alias("total_count")
    offset = (F.col("page") * PAGE_ROWS).alias("offset")
    meta = F.struct(offset, total_count) if offsets else F.struct(total_count)
    path = path or new_dir(spark, "pages")
    paged = paged.where(pages) if pages is not None else paged
    paged.repartition(12, "page").select(
        F.to_json(F.struct("molecules", meta.alias("page_meta")))
    ).write.mode("append").text(path)
    return path


@query
def stream_land(spark, sf_dir):
    """Event records landed from page files by a stream, the newest row of every key."""
    landing = ingest.Landing(spark, new_dir(spark, "landing"))
    pages = event_pages(spark, sf_dir)
    landing.ingest(ingest.MOLECULE, pages, "r1", whole_files=False, timeout=600)
    return landing.table("molecule_dictionary").select(KEY, "pref_name", "first_approval")


@query
def stream_watermark(spark, sf_dir):
    """Progress after landing every page."""
    landing = ingest.Landing(spark, new_dir(spark, "landing"))
    pages = event_pages(spark, sf_dir)
    landing.ingest(ingest.MOLECULE, pages, "r1", whole_files=False, timeout=600)
    return landing.progress("molecule").select(
        "release", F.col("records").alias("next_offset"), "total_count", "is_complete"
    )


def land_pages(landing: ingest.Landing, pages: str, release_name: str, force: bool = False) -> int:
    return landing.ingest(
        ingest.MOLECULE, pages, release_name, force=force, whole_files=False, timeout=600
    )


@query
def stream_restart(spark, sf_dir):
    """Even pages, the first of them twice, then the late ones; a new release, and it again.

    Beside the newest row of each key: whether the release was complete before and after the
    late pages, and how many records each step landed.
    """
    landing = ingest.Landing(spark, new_dir(spark, "landing"))
    even = F.col("page") % 2 == 0
    pages = event_pages(spark, sf_dir, pages=even)
    event_pages(spark, sf_dir, pages, F.col("page") == 0)
    steps = [land_pages(landing, pages, "r1")]
    early = landing.watermark("molecule").is_complete
    event_pages(spark, sf_dir, pages, ~even)
    steps.append(land_pages(landing, pages, "r1"))
    late = landing.watermark("molecule").is_complete
    steps.append(land_pages(landing, pages, "r1"))
    newer = event_pages(spark, sf_dir, kinds=F.col("event_type") == "purchase")
    steps.append(land_pages(landing, newer, "r2"))
    steps.append(land_pages(landing, newer, "r2", force=True))
    rows = landing.table("molecule_dictionary").select(KEY, "pref_name", "first_approval")
    return rows.select(
        "*",
        F.lit(early).alias("complete_early"),
        F.lit(late).alias("complete_late"),
        F.lit(",".join(map(str, steps))).alias("landed"),
    )


@query
def stream_no_offset(spark, sf_dir):
    """Pages that state no offset: what came in a later run is newer, whatever its place.

    Odd events land first, even clicks in a second run; a key is renewed if its row is of the
    second.
    """
    landing = ingest.Landing(spark, new_dir(spark, "landing"))
    odd = F.col("event_id") % 2 == 1
    pages = event_pages(spark, sf_dir, kinds=odd, offsets=False)
    land_pages(landing, pages, "r1")
    clicks = ~odd & (F.col("event_type") == "click")
    event_pages(spark, sf_dir, pages, kinds=clicks, offsets=False)
    land_pages(landing, pages, "r1")
    rows = landing.table("molecule_dictionary")
    return rows.select(KEY, (F.col("first_approval") % 2 == 0).alias("renewed"))


def customer_pages(
    spark: SparkSession, sf_dir: str, path: str, pages: Column, name: Column
) -> str:
    """Customers as pages of records without offsets, each record of its own identifier."""
    customers = table(spark, sf_dir, "customer")
    total = customers.count()
    record = F.struct(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias(KEY),
        name.alias("pref_name"),
        F.col("c_nationkey").alias("first_approval"),
    )
    page = F.floor(F.col("c_custkey") / 50).alias("page")
    paged = customers.groupBy(page).agg(F.collect_list(record).alias("molecules"))
    meta = F.struct(F.lit(total).alias("total_count")).alias("page_meta")
    paged.where(pages).repartition(4, "page").select(
        F.to_json(F.struct("molecules", meta))
    ).write.mode("append").text(path)
    return path


@query
def stream_corrected(spark, sf_dir):
    """Pages without offsets: the even ones, the same once more but corrected, then the rest.

    Beside the newest row of each key: whether the release was complete after each step, and
    how many records each brought.
    """
    landing = ingest.Landing(spark, new_dir(spark, "landing"))
    path = new_dir(spark, "pages")
    even, name = F.col("page") % 2 == 0, F.col("c_name")
    steps, complete = [], []
    for wanted, called in ((even, name), (even, F.concat(name, F.lit("!"))), (~even, name)):
        customer_pages(spark, sf_dir, path, wanted, called)
        steps.append(land_pages(landing, path, "r1"))
        complete.append(landing.watermark("molecule").is_complete)
    rows = landing.table("molecule_dictionary")
    return rows.select(
        KEY,
        "pref_name",
        "first_approval",
        F.col("loaded_at").isNotNull().alias("is_timed"),
        F.lit(",".join(str(x).lower() for x in complete)).alias("complete"),
        F.lit(",".join(map(str, steps))).alias("landed"),
    )


@query
def store_rebuild(spark, sf_dir):
    """Suppliers written as a table, then twice rebuilt: what is current, how many commits it
    took, whether the versions are the same and every row says when it was loaded."""
    store = TableStore(spark, new_dir(spark, "store"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    made = [store.write("bronze.supplier", suppliers.repartition(n, "s_suppkey")) for n in (1, 3, 2)]
    first, last = (made[k].select(suppliers.columns) for k in (0, -1))
    same = first.exceptAll(last).isEmpty() and last.exceptAll(first).isEmpty()
    return store["bronze.supplier"].select(
        *suppliers.columns,
        F.lit(store.commit_number()).alias("commits"),
        F.lit(same).alias("is_same"),
        F.col("loaded_at").isNotNull().alias("is_timed"),
    )


@query
def safe_numeric_sql(spark, sf_dir):
    """The safe cast called from SQL text, as a function of the session that Spark inlines."""
    register_safe_numeric(spark)
    role(spark, sf_dir, inputs.PART_NUMBERS).createOrReplaceTempView("part_numbers")
    return spark.sql("SELECT p_partkey, safe_numeric(raw) AS number FROM part_numbers")
