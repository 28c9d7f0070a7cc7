from __future__ import annotations

import os

import pytest

from winnower import fixtures
from winnower.config import Sampling
from winnower.plans import prepare
from winnower.plans.publish import publish_dataset, published, read_published
from winnower.storage import read_small_json, replace_small_json

MIDDLE = "/root/testdata/sf0.01"
HALF, QUARTER = Sampling(hash_prob=0.5), Sampling(hash_prob=0.25)


def _ids(spark, folder):
    return sorted(row.source_id for row in read_published(spark, folder, "pairs").collect())


def _whole(spark, version, rows):
    assert spark.read.text(version.dataset).count() == rows
    assert spark.read.json(version.stats).first()["stats"]["kept_rows"] == rows
    assert spark.read.text(version.demo).count() == min(rows, 200)


@pytest.mark.parametrize("broken", ["write_records", "write_stats", "first_kept", "manifest"])
def test_a_run_that_fails_leaves_the_version_before(spark, tmp_path, monkeypatch, broken):
    folder = str(tmp_path / "data")
    pairs = fixtures.document_pairs(spark, MIDDLE)
    first, _ = publish_dataset(pairs, folder, "pairs", sampling=HALF, dedup=True)
    before = _ids(spark, folder)
    assert len(before) > 200

    def fails(*args, **kwargs):
        raise OSError("the store is gone")

    with monkeypatch.context() as patch:
        if broken == "manifest":
            patch.setattr("winnower.plans.publish.replace_small_json", fails)
        else:
            patch.setattr(prepare, broken, fails)
        with pytest.raises(OSError, match="gone"):
            publish_dataset(pairs, folder, "pairs", sampling=QUARTER, dedup=True)
    assert published(spark, folder, "pairs") == first
    assert _ids(spark, folder) == before
    _whole(spark, first, len(before))
    second, done = publish_dataset(pairs, folder, "pairs", sampling=QUARTER, dedup=True)
    after = _ids(spark, folder)
    assert set(after) < set(before) and done.counts["kept_rows"] == len(after)
    _whole(spark, second, len(after))
    _whole(spark, first, len(before))  # those who read it still can


def test_old_versions_go(spark, tmp_path):
    folder = str(tmp_path / "data")
    pairs = fixtures.document_pairs(spark, MIDDLE).where("seq < 60")
    assert published(spark, folder, "pairs") is None
    with pytest.raises(FileNotFoundError):
        read_published(spark, folder, "pairs")
    versions = [publish_dataset(pairs, folder, "pairs", sampling=HALF)[0].version for _ in range(3)]
    assert sorted(os.listdir(f"{folder}/versions")) == versions[1:]


def test_small_files_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/info.json"
    for content in ({"a": "\N{SNOWMAN}" * 5000}, {"b": 1}):
        replace_small_json(spark, path, content)
        assert read_small_json(spark, path) == content
    assert [name for name in os.listdir(tmp_path) if not name.startswith(".")] == ["info.json"]
