"""Keyed tables keep every version readable and rewrite only what a write touches."""

import pytest
from pyspark.sql import functions as F

from gaugeline.sources import keyed, versions

SCHEMA = "kind string, id bigint, value string"


def rows(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def folder_of(tmp_path):
    return str(tmp_path / "table")


def test_upserts_equal_a_dictionary(spark, tmp_path):
    folder, known = folder_of(tmp_path), {}
    batches = [
        [("a", i, f"first {i}") for i in range(200)] + [(None, None, "nobody"), (None, 1, "one")],
        [("a", 5, "new"), ("b", 5, "other"), (None, None, "changed")],
        [("a", 5, "x"), ("a", 5, "y"), ("a", 7, None)],
    ]
    for at, batch in enumerate(batches):
        keyed.write_keyed(rows(spark, batch).repartition(3), folder, ["kind", "id"], 16, [F.col("value").desc()])
        for kind, i, value in sorted(batch, key=lambda r: r[2] or ""):
            known[kind, i] = value
        assert content(keyed.read_table(spark, folder)) == sorted(((*key, value) for key, value in known.items()), key=str)
    assert versions.versions(spark, folder) == [1, 2, 3]
    assert len(content(keyed.read_table(spark, folder, 1))) == 202
    assert ("a", 5, "new") in content(keyed.read_table(spark, folder, 2))


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    folder = folder_of(tmp_path)
    first = keyed.create_table(rows(spark, [("a", i, "v") for i in range(300)]), folder, ["kind", "id"], 8)
    second = keyed.upsert_table(rows(spark, [("a", 3, "w")]), folder)
    changed = {bucket for bucket in first["parts"] if first["parts"][bucket] != second["parts"][bucket]}
    assert len(first["parts"]) == 8 and len(changed) == 1
    bucket = int(changed.pop())
    assert ("a", 3, "w") in content(keyed.read_table(spark, folder, only=[bucket]))
    assert all(r[1] != 3 for other in range(8) if other != bucket for r in content(keyed.read_table(spark, folder, only=[other])))


def test_a_write_that_dies_before_its_commit_leaves_the_old_version(spark, tmp_path, monkeypatch):
    folder = folder_of(tmp_path)
    keyed.create_table(rows(spark, [("a", i, "v") for i in range(50)]), folder, ["kind", "id"], 4)
    before = content(keyed.read_table(spark, folder))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(keyed, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            keyed.upsert_table(rows(spark, [("a", 1, "lost")]), folder)
    assert len(versions.folders(spark, f"{folder}/data")) == 2  # the new files are there, but no version names them
    assert content(keyed.read_table(spark, folder)) == before
    keyed.upsert_table(rows(spark, [("a", 1, "kept")]), folder)
    assert ("a", 1, "kept") in content(keyed.read_table(spark, folder)) and versions.versions(spark, folder) == [1, 2]


def test_a_writer_that_was_overtaken_is_refused(spark, tmp_path):
    folder = folder_of(tmp_path)
    keyed.create_table(rows(spark, [("a", 1, "v")]), folder, ["kind", "id"], 4)

    def meanwhile(old, new):
        keyed.upsert_table(rows(spark, [("a", 2, "faster")]), folder)
        return old.unionByName(new)

    with pytest.raises(versions.Overtaken):
        keyed.merge_table(rows(spark, [("a", 3, "slower")]), folder, meanwhile)
    assert content(keyed.read_table(spark, folder)) == [("a", 1, "v"), ("a", 2, "faster")]
    assert not [name for name in versions.folders(spark, f"{folder}/_versions") if name.startswith(".") and not name.endswith(".crc")]


def test_deleted_keys_and_dropped_versions(spark, tmp_path):
    folder = folder_of(tmp_path)
    keyed.create_table(rows(spark, [("a", i, "v") for i in range(20)] + [(None, None, "n")]), folder, ["kind", "id"], 4)
    keyed.delete_keys(rows(spark, [("a", i, "?") for i in range(19)] + [(None, None, "?"), ("z", 1, "?")]), folder)
    assert content(keyed.read_table(spark, folder)) == [("a", 19, "v")]
    keyed.upsert_table(rows(spark, [("a", 40, "w")]), folder)
    stray = versions.write_part(rows(spark, [("a", 1, "u")]), folder)  # of a write that has yet to commit
    assert versions.drop_versions(spark, folder, keep=1) > 0
    assert versions.versions(spark, folder) == [3]
    assert content(keyed.read_table(spark, folder)) == [("a", 19, "v"), ("a", 40, "w")]
    assert stray.split("/")[1] in versions.folders(spark, f"{folder}/data")
    with pytest.raises(FileNotFoundError):
        keyed.read_table(spark, folder, 1)


def test_empty_tables_and_empty_writes(spark, tmp_path):
    folder = folder_of(tmp_path)
    keyed.create_table(rows(spark, []), folder, ["kind", "id"])
    assert content(keyed.read_table(spark, folder)) == []
    keyed.upsert_table(rows(spark, []), folder)
    assert versions.versions(spark, folder) == [1]
    keyed.upsert_table(rows(spark, [("a", 1, "v")]), folder)
    assert content(keyed.read_table(spark, folder)) == [("a", 1, "v")]
    with pytest.raises(FileExistsError):
        keyed.create_table(rows(spark, []), folder, ["kind", "id"])


def test_one_key_with_most_new_rows(spark, tmp_path):
    folder = folder_of(tmp_path)
    new = spark.range(3000).select(
        F.lit("a").alias("kind"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
        F.format_string("%06d", "id").alias("value"))
    keyed.write_keyed(new, folder, ["kind", "id"], 8, [F.col("value").desc()])
    found = keyed.read_table(spark, folder)
    assert found.count() == 2001 and found.filter("id = 0").first()["value"] == "002997"


def test_new_rows_are_stored_once_for_every_key(spark, tmp_path, monkeypatch):
    """Which of several new rows of a key counts is settled before they are stored and read back."""
    folder, stored, store = folder_of(tmp_path), [], keyed.materialize
    keyed.create_table(rows(spark, [("a", 1, "v")]), folder, ["kind", "id"], 4)
    monkeypatch.setattr(keyed, "materialize", lambda df, label: stored.append(store(df, label)) or stored[-1])
    keyed.upsert_table(rows(spark, [("a", 1, "x"), ("a", 1, "w"), ("a", 2, "y")] * 3), folder)
    assert stored[0].count() == 2
    assert content(keyed.read_table(spark, folder)) == [("a", 1, "w"), ("a", 2, "y")]
