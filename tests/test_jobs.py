import json

import pytest
from pyspark.sql import functions as F

from kinmart import Settings
from kinmart.operators.similarity import LibraryMismatch, UnscorableSources
from kinmart.plans import jobs
from kinmart.plans import quality as q
from kinmart.schemas import (
    COMPOUND_PROPERTIES,
    COMPOUND_STRUCTURES,
    ID_LOOKUP,
    INPUT_COMPOUND,
    KEY,
    MOLECULE_DICTIONARY,
)
from kinmart.sources.store import TableStore
from kinmart.streaming.ingest import MOLECULE, Landing
from kinmart.workspace import shared_dir

SMALL = Settings(n_bits=256, top_n=3, target_size=4, pivot_sources=2, shard_size=10)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def frame(spark, schema, rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, f"file://{tmp_path}/mart")
    ids = [f"M{n:02d}" for n in range(24)]
    texts = [" ".join(WORDS[(n * step) % 10] for step in range(1, 7)) for n in range(24)]
    with made.transaction() as work:
        work.write(
            q.DICTIONARY,
            frame(
                spark, MOLECULE_DICTIONARY,
                [{KEY: i, "pref_name": f"name {i}", "max_phase": "4.0"} for i in ids],
            ),
        )
        work.write(
            q.PROPERTIES,
            frame(
                spark, COMPOUND_PROPERTIES,
                [{KEY: i, "alogp": f"{n}.5", "heavy_atoms": n % 3} for n, i in enumerate(ids)],
            ),
        )
        work.write(
            q.STRUCTURES,
            frame(
                spark, COMPOUND_STRUCTURES,
                [{KEY: i, "canonical_smiles": t} for i, t in zip(ids, texts)],
            ),
        )
        given = [("f.csv", 2, "Name m03"), ("f.csv", 3, " NAME M07 "), ("f.csv", 4, "who")]
        work.write(
            q.INPUTS,
            frame(
                spark, INPUT_COMPOUND,
                [{"source_file": f, "source_row": r, "compound_name": n} for f, r, n in given],
            ),
        )
    return made


def build(store):
    jobs.build_silver(store, "run", SMALL)
    jobs.build_sources(store, "run", SMALL)
    jobs.build_library(store, SMALL)
    return jobs.build_mart(store, "run", SMALL, archive=True)


def test_from_bronze_to_views(spark, store, rows):
    report = build(store)
    counts = q.report_counts(report).first()
    assert counts.blocking == 0 and counts.checks > 10
    assert store[q.SOURCES].count() == 4 and store[q.REJECTED].count() == 1
    assert store[q.FACT].count() == 12 and jobs.scores(store).count() == 4 * 24
    assert jobs.create_views(store, SMALL)[-1] == "v_quality_latest"
    assert spark.table("v_avg_similarity_per_source").count() == 4
    assert spark.table("v_avg_alogp_deviation").count() == 4
    assert len(spark.table("v_similarity_pivot").columns) == 3
    assert spark.table("v_similarity_neighbours").count() == 12
    assert spark.sql("SELECT * FROM v_avg_similarity_rollup WHERE source_molecule = 'TOTAL'").count()
    before = {t: rows(store[t].drop("loaded_at")) for t in (q.DIM, q.FACT, jobs.TOP, q.SOURCES)}
    build(store)
    assert {t: rows(store[t].drop("loaded_at")) for t in before} == before


def staged(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {str(x.getPath().getName()) for x in files.listStatus(path)} if files.exists(path) else set()


def test_a_job_leaves_nothing_staged_but_what_it_returns(spark, store):
    jobs.build_silver(store, "run", SMALL)
    before = staged(spark)
    results = jobs.build_sources(store, "run", SMALL)
    left = staged(spark) - before
    assert len(left) == 1 and results.staged_at.endswith(left.pop())
    jobs.build_library(store, SMALL)
    assert staged(spark) - before == {results.staged_at.rpartition("/")[2]}


def test_a_failed_gate_records_and_publishes_nothing(spark, store):
    jobs.build_silver(store, "run-1", SMALL)
    before = store.current()[q.MOLECULES]
    broken = store[q.DICTIONARY].withColumn("max_phase", F.lit("not a number"))
    store.write(q.DICTIONARY, broken)
    with pytest.raises(q.GateClosed, match="casts_drop_nothing is 24"):
        jobs.build_silver(store, "run-2", SMALL)
    assert store.current()[q.MOLECULES] == before
    history = jobs.quality_history(store)
    assert history.where("run_id = 'run-2' AND NOT passed").first().check_name == "casts_drop_nothing"
    latest = jobs.latest_results(history).where("check_name = 'casts_drop_nothing'").first()
    assert (latest.run_id, latest.passed, latest.observed) == ("run-2", False, 24.0)


def test_a_run_recorded_twice_keeps_one_result_per_check(store):
    jobs.build_silver(store, "run", SMALL)
    first = jobs.quality_history(store).count()
    jobs.build_silver(store, "run", SMALL)
    assert jobs.quality_history(store).count() == first
    jobs.build_silver(store, "7", SMALL)
    history = jobs.quality_history(store)
    assert history.count() == 2 * first and history.schema["run_id"].dataType.simpleString() == "string"
    assert {r.run_id for r in jobs.latest_results(history).collect()} == {"7"}
    assert store.prune() == 2 and jobs.quality_history(store).count() == 2 * first


def test_a_source_without_fingerprint_stops_before_anything_is_replaced(spark, store):
    build(store)
    before = store.current()
    stranger = store[q.SOURCES].limit(1).withColumn(KEY, F.lit("M99"))
    store.write(q.SOURCES, store[q.SOURCES].unionByName(stranger))
    with pytest.raises(UnscorableSources, match="M99"):
        jobs.build_mart(store, "run", SMALL)
    assert {t: store.current()[t] for t in (q.FACT, jobs.TOP, jobs.SCORES)} == {
        t: before[t] for t in (q.FACT, jobs.TOP, jobs.SCORES)
    }


def test_a_stale_library_is_refused(store):
    build(store)
    extra = store[q.MOLECULES].limit(1).withColumn(KEY, F.lit("M98"))
    store.write(q.MOLECULES, store[q.MOLECULES].unionByName(extra))
    with pytest.raises(LibraryMismatch):
        jobs.build_mart(store, "run", SMALL)


def test_release_is_drained_once(spark, store):
    dictionary = frame(spark, MOLECULE_DICTIONARY, [{KEY: "R1", "pref_name": "one"}])
    flags = [f.name for f in MOLECULE_DICTIONARY if f.dataType.simpleString() == "boolean"]
    for name in flags:
        dictionary = dictionary.withColumn(name, F.lit(1))
    keyed = dictionary.withColumn("n", F.lit(7))
    raw = {
        q.DICTIONARY: keyed,
        q.PROPERTIES: frame(spark, COMPOUND_PROPERTIES, [{"alogp": "1.5"}]).drop(KEY).withColumn(
            "n", F.lit(7)
        ),
        q.STRUCTURES: frame(spark, COMPOUND_STRUCTURES, [{"canonical_smiles": "C"}])
        .drop(KEY)
        .withColumn("n", F.lit(7)),
        jobs.LOOKUP: frame(spark, ID_LOOKUP, [{KEY: "R1"}]).drop("resource_url"),
    }
    counts = jobs.drain_release(store, "r1", raw, "n")
    assert counts == {q.DICTIONARY: 1, q.PROPERTIES: 1, q.STRUCTURES: 1, jobs.LOOKUP: 1}
    assert store[q.DICTIONARY].first().oral is True
    assert store[q.PROPERTIES].first()[KEY] == "R1"
    assert jobs.drain_release(store, "r1", raw, "n") == {}
    assert jobs.drain_release(store, "r1", raw, "n", force=True) == counts
    assert jobs.drain_release(store, "r2", raw, "n") == counts


def test_landed_pages_and_batch_files_become_bronze(spark, store, tmp_path):
    pages, files = tmp_path / "pages", tmp_path / "files"
    pages.mkdir(), files.mkdir()
    record = {KEY: "P1", "pref_name": "p", "molecule_properties": {"alogp": "2"},
              "molecule_structures": {"canonical_smiles": "C"}}
    (pages / "p.json").write_text(json.dumps({"molecules": [record], "page_meta": {"total_count": 1}}))
    landing = Landing(spark, f"file://{tmp_path}/landing")
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    jobs.publish_landed(store, landing, [MOLECULE])
    assert [store[t].first()[KEY] for t in (q.DICTIONARY, q.PROPERTIES, q.STRUCTURES)] == ["P1"] * 3
    (files / "a.csv").write_text("compound_name,odd\nAspirin,1\n")
    assert [r.header for r in jobs.land_inputs(store, str(files)).collect()] == ["odd"]
    assert store[q.INPUTS].first().compound_name == "Aspirin"
