from __future__ import annotations

import json

import pyarrow as pa
import pytest
from conftest import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripmill.catalogue import entries
from tripmill.session import new_folder
from tripmill.sources import arrays, landing

AWKWARD = [
    {"a": "}{][,", "b": 1},
    {"a": 'quote " and \\" and \\\\', "b": "\\"},
    {"a": "", "b": None},
    {"a": {"type": "Point", "coordinates": [[1, 2], [3, {"deep": "}]"}]]}, "b": "x"},
    {"a": "line\nbreak\r\n\t}", "b": "é𝄞}\u2028"},
    {"a": "[" * 50 + '"' * 7 + "}" * 50, "b": [{"c": {}}, {}, []]},
    {"a": "x" * 3000, "b": "long"},
]


@pytest.fixture(params=[16, 100, 1 << 20])
def ranges(spark, request):
    """Ranges of so many bytes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in kept:
        spark.conf.set(k, str(request.param))
    yield request.param
    for k, v in kept.items():
        spark.conf.set(k, v)


def objects(spark, folder):
    return sorted(json.dumps(json.loads(r["text"]), sort_keys=True) for r in arrays.object_texts(spark, str(folder))[0].collect())


def wanted(*lists):
    return sorted(json.dumps(r, sort_keys=True) for rows in lists for r in rows)


def test_awkward_strings_at_any_range(spark, tmp_path, ranges):
    few = AWKWARD[:6] if ranges < 64 else AWKWARD
    (tmp_path / "plain.json").write_text(json.dumps(few))
    (tmp_path / "wide.json").write_text("﻿ \n" + json.dumps(few, indent=3, ensure_ascii=False) + "\n\n", newline="")
    assert objects(spark, tmp_path) == wanted(few, few)


def test_what_is_no_array_is_no_data(spark, tmp_path, ranges):
    texts = ["", " ", "[]", "[ ]\n", '{"a": 1}', '{"message": "no", "x": [{"a": 1}]}', "[1, 2]", '"[{}]"', '[{"a": 1}, {"a": 2', '[{"a": 1}', '[{"a": "1]']
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    assert objects(spark, tmp_path) == []


def test_elements_that_are_no_objects_are_skipped(spark, tmp_path, ranges):
    (tmp_path / "r.json").write_text('["a}{", 1, {"a": 1}, [{"b": 2}, "]"], [[]], {"c": "3"}, null, {}, "{", {"d": [1]}, -1]')
    assert objects(spark, tmp_path) == wanted([{"a": 1}, {"c": "3"}, {}, {"d": [1]}])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.dictionaries(st.text('ab"\\{}[],:\n', max_size=6), st.recursive(
    st.none() | st.text('ab"\\{}[],:\n}', max_size=12), lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text('a"}', max_size=3), v, max_size=3), max_leaves=6), max_size=4), max_size=8))
def test_any_array_in_ranges_of_some_bytes(spark, rows):
    folder = new_folder(spark, "any-array")
    spark.createDataFrame([(json.dumps(rows),)], "value string").coalesce(1).write.text(folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16"), spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        assert objects(spark, folder) == wanted(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes"), spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ranges_too_many_to_broadcast(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps(AWKWARD * 20))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500"), spark.conf.set("spark.sql.files.openCostInBytes", "500")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert objects(spark, tmp_path) == wanted(AWKWARD * 20)
    finally:
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)


def test_records_as_by_the_whole_file_reader(spark, sf):
    folder = new_folder(spark, "arrays")
    raw = entries.td.raw_trips(spark, sf)
    arrays.land_arrays(raw.repartition(3), folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000"), spark.conf.set("spark.sql.files.openCostInBytes", "20000")
    try:
        got = landing.read_records(spark, folder, landing.TRIP_FIELDS, whole_files=True)
        whole = spark.read.schema(",".join(f"{c} string" for c in landing.TRIP_FIELDS)).json(folder, multiLine=True)
        assert got.columns == landing.TRIP_FIELDS and tuples(got) == tuples(whole) and got.count() == raw.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes"), spark.conf.unset("spark.sql.files.openCostInBytes")


def test_folders_become_columns(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        (tmp_path / f"landed_day={day}").mkdir()
        (tmp_path / f"landed_day={day}" / "r.json").write_text(json.dumps([{"trip_id": day}, {"trip_id": "}"}, {"other": 1}]))
    df = landing.read_records(spark, str(tmp_path), ["trip_id"], whole_files=True)
    assert dict(df.dtypes) == {"trip_id": "string", "landed_day": "date"}
    assert sorted((r[0], str(r[1])) for r in df.collect()) == [
        ("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-02"), ("}", "2024-01-01"), ("}", "2024-01-02")
    ]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='a"\\\\{[],é', max_size=12), max_size=8), st.integers(0, 3))
def test_states_of_chunks(texts, offset):
    """Quotes and both depths of every chunk, told from the bytes of a batch, against a reader of one character at a time."""

    def read(text, quoted):
        depth, odd, i = 0, 0, 0
        while i < len(text):
            if text[i] == "\\":
                i += 1
            elif text[i] == '"':
                quoted, odd = not quoted, 1 - odd
            elif not quoted:
                depth += {"{": 1, "[": 1, "]": -1}.get(text[i], 0)
            i += 1
        return odd, depth - (not quoted)

    for kind in (pa.string(), pa.large_string()):
        got = arrays._states(pa.array(["x"] * offset + texts, kind)[offset:])
        assert [x.tolist() for x in got] == [[read(t, False)[0] for t in texts], [read(t, False)[1] for t in texts], [read(t, True)[1] for t in texts]]
