import json

import pytest
from pyspark.sql import functions as F

from kinmart.schemas import KEY
from kinmart.sources.store import Folder
from kinmart.streaming.ingest import ID_LOOKUP, MOLECULE, Landing, arrivals
from kinmart.streaming.upserts import (
    ARRIVAL,
    append_batch,
    compact,
    fold,
    pieces,
    read_latest,
    read_pieces,
    upsert,
)


def page(folder, name, offset, records, total, collection="molecules"):
    body = {collection: records, "page_meta": {"offset": offset, "total_count": total}}
    (folder / f"{name}.json").write_text(json.dumps(body, indent=1))


def record(n, name, **more):
    return {KEY: f"M{n}", "pref_name": name, **more}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, f"file://{tmp_path}/landing")


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    return folder


def names(landing):
    return {r[KEY]: r.pref_name for r in landing.table("molecule_dictionary").collect()}


def test_pages_land_and_a_finished_release_is_skipped(landing, pages):
    page(pages, "p0", 0, [record(1, "one", molecule_structures={"canonical_smiles": "C"})], 3)
    page(pages, "p1", 1, [record(2, "two"), record(1, "one again")], 3)
    assert landing.watermark("molecule") is None
    assert landing.ingest(MOLECULE, str(pages), "r1", files_per_batch=1, timeout=120) == 3
    mark = landing.watermark("molecule")
    assert (mark.next_offset, mark.total_count, mark.is_complete) == (3, 3, True)
    assert names(landing) == {"M1": "one again", "M2": "two"}
    assert landing.table("compound_structures").first().canonical_smiles == "C"
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 0


def test_page_order_decides_whatever_order_files_arrive_in(landing, pages):
    page(pages, "late", 1, [record(1, "newer")], 2)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    page(pages, "early", 0, [record(1, "older")], 2)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    assert names(landing) == {"M1": "newer"}


def test_an_interrupted_run_goes_on_where_it_stopped(landing, pages):
    page(pages, "p0", 0, [record(1, "one"), record(2, "two")], 4)
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 2
    assert not landing.watermark("molecule").is_complete
    page(pages, "p1", 2, [record(3, "three"), record(4, "four")], 4)
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 2
    assert landing.watermark("molecule").is_complete and len(names(landing)) == 4


def test_a_batch_that_runs_again_counts_once(spark, landing, pages):
    page(pages, "p0", 0, [record(1, "one"), record(2, "two")], 2)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    # As if the run had died after its writes and before its checkpoint was committed.
    Folder(spark, f"{landing.path}/_checkpoints/molecule/0/commits").remove("0")
    work = landing._land(MOLECULE, "r1", 0)
    work(arrivals(spark.read.text(str(pages), wholetext=True)), 0)
    assert landing.watermark("molecule").next_offset == 2 and len(names(landing)) == 2


def test_a_page_delivered_twice_completes_nothing(landing, pages):
    page(pages, "p0", 0, [record(1, "one"), record(2, "two")], 4)
    page(pages, "again", 0, [record(1, "one"), record(2, "two")], 4)
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 2
    mark = landing.watermark("molecule")
    assert (mark.next_offset, mark.is_complete) == (2, False)
    page(pages, "p1", 2, [record(3, "three"), record(4, "four")], 4)
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 2
    assert landing.watermark("molecule").is_complete and len(names(landing)) == 4


def test_a_gap_keeps_a_release_open(landing, pages):
    page(pages, "p2", 2, [record(3, "three")], 3)
    page(pages, "p0", 0, [record(1, "one")], 3)
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 2
    assert landing.watermark("molecule").next_offset == 1
    page(pages, "p1", 1, [record(2, "two")], 3)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    mark = landing.watermark("molecule")
    assert (mark.next_offset, mark.is_complete) == (3, True)


def bare_page(folder, name, records, total):
    body = {"molecules": records, "page_meta": {"total_count": total}}
    (folder / f"{name}.json").write_text(json.dumps(body))


def test_without_offsets_the_page_that_came_last_wins(landing, pages):
    bare_page(pages, "b", [record(7, "x"), record(8, "x"), record(1, "old")], 9)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    bare_page(pages, "a", [record(1, "new")], 9)
    bare_page(pages, "c", [record(7, "x"), record(8, "x"), record(1, "old")], 9)
    # Both hold records that have landed before, so neither brings the release nearer its end.
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 0
    assert landing.watermark("molecule").next_offset == 3
    assert names(landing)["M7"] == "x"
    bare_page(pages, "d", [record(1, "newest")], 9)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    assert names(landing)["M1"] == "newest"


def test_a_corrected_page_without_offset_completes_nothing(landing, pages):
    bare_page(pages, "p0", [record(1, "one"), record(2, "two")], 4)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    bare_page(pages, "p1", [record(1, "one, mended"), record(2, "two")], 4)
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 0
    mark = landing.watermark("molecule")
    assert (mark.next_offset, mark.is_complete) == (2, False)
    bare_page(pages, "p2", [record(3, "three"), {"pref_name": "no identifier"}], 4)
    bare_page(pages, "p3", [{"pref_name": "no identifier"}], 4)
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 2
    assert landing.watermark("molecule").is_complete
    assert names(landing) == {"M1": "one, mended", "M2": "two", "M3": "three"}


def test_a_loose_page_repeating_placed_records_adds_nothing(landing, pages):
    page(pages, "p0", 0, [record(1, "one"), record(2, "two")], 4)
    bare_page(pages, "p1", [record(1, "one again"), record(2, "two")], 4)
    assert landing.ingest(MOLECULE, str(pages), "r1", timeout=120) == 2
    assert not landing.watermark("molecule").is_complete
    page(pages, "p2", 2, [record(3, "three"), record(4, "four")], 4)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    assert landing.watermark("molecule").is_complete and len(names(landing)) == 4


def test_a_new_release_and_force_start_over(landing, pages, tmp_path):
    page(pages, "p0", 0, [record(1, "one"), record(2, "two")], 2)
    landing.ingest(MOLECULE, str(pages), "r1", timeout=120)
    assert landing.ingest(MOLECULE, str(pages), "r1", force=True, timeout=120) == 2
    newer = tmp_path / "newer"
    newer.mkdir()
    page(newer, "p0", 0, [record(1, "renamed")], 1)
    assert landing.ingest(MOLECULE, str(newer), "r2", timeout=120) == 1
    mark = landing.watermark("molecule")
    assert (mark.release, mark.epoch, mark.is_complete) == ("r2", 2, True)
    assert names(landing) == {"M1": "renamed", "M2": "two"}


def test_the_lookup_resource_lands_too(landing, pages):
    rows = [{KEY: "M1", "status": "ACTIVE"}, {KEY: "", "status": "x"}]
    page(pages, "p0", 0, rows, 2, "id_lookups")
    assert landing.ingest(ID_LOOKUP, str(pages), "r1", timeout=120) == 2
    made = landing.table("id_lookup").collect()
    assert [(r[KEY], r.status, r.entity_id) for r in made] == [("M1", "ACTIVE", None)]


BATCH = f"k string, v int, {ARRIVAL} bigint"


def test_newest_row_wins_within_and_between_batches(spark, tmp_path, rows):
    path = f"file://{tmp_path}/log"
    append_batch(spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 1, 2)], BATCH), path, 0, ["k"])
    append_batch(spark.createDataFrame([("b", 5, 0), ("c", 7, 1)], BATCH), path, 1, ["k"])
    append_batch(spark.createDataFrame([("b", 5, 0), ("c", 7, 1)], BATCH), path, 1, ["k"])
    want = [("a", 2), ("b", 5), ("c", 7)]
    assert rows(read_latest(spark, path, ["k"]).select("k", "v")) == want
    compact(spark, path, ["k"], f"file://{tmp_path}/folded")
    assert spark.read.parquet(f"file://{tmp_path}/folded").count() == 3
    assert rows(read_latest(spark, f"file://{tmp_path}/folded", ["k"]).select("k", "v")) == want


def test_reading_stays_as_cheap_however_many_batches_came(spark, tmp_path):
    path, most, want = f"file://{tmp_path}/log", [], {}
    for number in range(100):
        given = [(f"k{(number * 7 + n) % 40}", number * 10 + n, n) for n in range(5)]
        want |= {k: v for k, v, _ in given}
        append_batch(spark.createDataFrame(given, BATCH).coalesce(1), path, number, ["k"])
        fold(spark, path, ["k"])
        most.append(len(pieces(spark, path)))
        if number in (9, 63, 64, 99):
            assert {r.k: r.v for r in read_latest(spark, path, ["k"]).collect()} == want
    # Seven of each size, eight before a fold, and the newest batch.
    assert max(most) <= 2 * 7 + 3 and most[-1] <= 12
    read = read_pieces(spark, pieces(spark, path)).count()
    assert read < 40 * 12 < 500
    fold(spark, path, ["k"])
    left = [n for n in Folder(spark, path).names() if n.startswith("_batch=")]
    assert len(left) <= 8 and len(Folder(spark, path).names("runs")) <= 5


def test_a_run_that_was_not_finished_counts_for_nothing(spark, tmp_path, rows):
    path = f"file://{tmp_path}/log"
    for number in range(9):
        append_batch(spark.createDataFrame([("a", number, 0)], BATCH), path, number, ["k"])
    spark.createDataFrame([("a", 99, 0)], BATCH).write.parquet(f"{path}/runs/0-7-8")
    Folder(spark, path).remove("runs/0-7-8/_SUCCESS")
    assert len(pieces(spark, path)) == 9
    assert fold(spark, path, ["k"]) == 1 and len(pieces(spark, path)) == 2
    assert rows(read_latest(spark, path, ["k"]).select("k", "v")) == [("a", 8)]


def test_an_upsert_refreshes_the_time_of_loading(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    append_batch(spark.createDataFrame([("a", 1, 0), ("b", 1, 1)], BATCH), path, 0, ["k"])
    first = {r.k: r.loaded_at for r in read_latest(spark, path, ["k"]).collect()}
    append_batch(spark.createDataFrame([("b", 2, 0)], BATCH), path, 1, ["k"])
    second = {r.k: r.loaded_at for r in read_latest(spark, path, ["k"]).collect()}
    assert second["a"] == first["a"] and second["b"] > first["b"]
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    old = old.withColumn("loaded_at", F.lit("2001-01-01").cast("timestamp"))
    made = upsert(old, spark.createDataFrame([("b", 2)], "k string, v int"), ["k"])
    years = {r.k: r.loaded_at.year for r in made.collect()}
    assert years["a"] == 2001 and years["b"] > 2001


def test_upsert_folds_a_batch_in(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("b", 3), ("c", 4)], "k string, v int")
    assert rows(upsert(old, new, ["k"], "v")) == [("a", 1), ("b", 3), ("c", 4)]
