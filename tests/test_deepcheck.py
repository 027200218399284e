"""The deep check: planted problems, files that need no second look, stops and failing extractions."""

import hashlib
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from parchment.plans.deepcheck import DeepCheck
from parchment.plans.store import SnapshotStore
from parchment.sources.extract import Pdf

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the executors have no tests


def read_pdf(data):
    if b"broken" in data:
        raise RuntimeError("no tool")
    return Pdf(1, data.decode() + "\f", {})


def read_two_pages(data):
    return Pdf(2, data.decode() + "\f\f", {})


def rows_of(spark, n, **changes):
    """n sound rows; changes are by id."""
    rows = []
    for i in range(n):
        data = b"%PDF-" + str(i).encode() * 40
        row = {"id": f"d{i:03d}", "partition": f"OT{i % 3}", "file": data, "file_sha256": hashlib.sha256(data).hexdigest(), "file_size": len(data), "media_type": "application/pdf", "pages": 1, "image_pages": 0, "ocr_pages": 0, "text_source": "born_digital", "text": data.decode() + "\f", "listed": True}
        rows.append(tuple((row | changes.get(row["id"], {})).values()))
    return spark.createDataFrame(rows, "id string, partition string, file binary, file_sha256 string, file_size long, media_type string, pages int, image_pages int, ocr_pages int, text_source string, text string, listed boolean")


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, f"file://{tmp_path}/s", file_bytes=2_000)


def told(check, manifest):
    return sorted((r.scope, r.key, r.problem) for r in check.problems(manifest).collect())


def test_planted_problems_are_told_and_sound_files_are_read_once(spark, store):
    wrong = {"d001": {"text": "another text"}, "d002": {"pages": 7}, "d003": {"file_sha256": "0" * 64}, "d004": {"file": None}, "d005": {"file_size": 3}}
    manifest = store.commit(rows_of(spark, 60, **wrong), store.manifest())
    check, want = DeepCheck(store, read_pdf, batch_bytes=8_000), [
        ("OT0", "d003", "file_sha256 differs from the bytes"), ("OT1", "d001", "text differs from a new extraction"), ("OT1", "d004", "no file"),
        ("OT2", "d002", "pages 7, a new extraction says 1"), ("OT2", "d005", "file_size differs from the bytes"),
    ]
    files = store.files().count()
    assert files > 6 and check.run(manifest) == files and told(check, manifest) == want
    again = DeepCheck(store, read_pdf)
    assert again.run(manifest) == 0 and told(again, manifest) == want
    # a row is mended: its file is read and no other
    mended = store.commit(rows_of(spark, 60, **{k: v for k, v in wrong.items() if k != "d002"}).where(F.col("partition") == "OT2"), manifest)
    assert again.run(mended) == 1 and told(again, mended) == [w for w in want if w[1] != "d002"]
    assert DeepCheck(store, read_two_pages, "2").run(mended) == files  # another extraction looks at everything


def test_a_check_that_stopped_is_taken_up(spark, store):
    manifest = store.commit(rows_of(spark, 40), store.manifest())
    files, now = store.files().count(), iter(range(100))
    check = DeepCheck(store, read_pdf, batch_bytes=1, clock=lambda: next(now))
    first = check.run(manifest, deadline=3)  # the clock is asked twice a batch
    assert 0 < first < files and check.due(manifest).count() == files - first
    assert DeepCheck(store, read_pdf).run(manifest) == files - first and told(check, manifest) == []


def test_a_failed_extraction_is_tried_again(spark, store):
    data = b"%PDF-broken"
    broken = {"d000": {"file": data, "file_sha256": hashlib.sha256(data).hexdigest(), "file_size": len(data), "text": data.decode() + "\f"}}
    manifest = store.commit(rows_of(spark, 3, **broken), store.manifest())
    assert DeepCheck(store, read_pdf).run(manifest) == 3
    check = DeepCheck(store, lambda data: Pdf(1, data.decode() + "\f", {}))
    assert told(check, manifest) == [("OT0", "d000", "extraction failed: RuntimeError: no tool")]
    assert check.run(manifest) == 1 and told(check, manifest) == [] and check.run(manifest) == 0


def test_nothing_stored(spark, store):
    check = DeepCheck(store, read_pdf)
    assert check.run(store.manifest()) == 0 and told(check, store.manifest()) == []
