"""Log records, exposition, notebooks and images on small cases."""

import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelpulse.functions import scalar as S
from modelpulse.operators import images as I
from modelpulse.operators import notebooks as N
from modelpulse.operators import requests as R
from modelpulse.operators import traces as TR
from modelpulse.sources import artifacts as A
from modelpulse.sources import exposition as X
from modelpulse.sources import logs as L


def test_broken_json_line_is_kept(spark):
    lines = spark.createDataFrame([('{"level": "INFO", "source": {"line": 3}}',), ("{broken",)], "value string")
    rows = L.parse_json_lines(lines).collect()
    assert sorted(str(r["_corrupt_record"]) for r in rows) == ["None", "{broken"]
    assert [r["source"]["line"] for r in rows if r["level"]] == [3]


def test_level_and_request_id_defaults(spark):
    df = spark.createDataFrame([("warning", "INFO", "x"), (None, "ERROR", None), ("", "INFO", None)], "l string, r string, id string")
    got = df.select(S.log_level(F.col("l"), F.col("r")), S.request_id_or_default(F.col("id"))).collect()
    assert [tuple(r) for r in got] == [("WARNING", "x"), ("ERROR", "no-request-id"), ("INFO", "no-request-id")]


def test_text_line_with_separator_in_message(spark):
    line = "2024-01-01 00:00:00,123 - batch_manager - INFO - [abc] - a - b"
    row = L.parse_text_lines(spark.createDataFrame([(line,)], "value string")).first()
    assert tuple(row) == ("2024-01-01 00:00:00,123", "batch_manager", "INFO", "abc", "a - b", None)


def test_traces_skip_lines_without_request(spark):
    rows = [("a", TR.RECEIVED, 0), ("a", TR.QUEUED, 2000), ("a", TR.FAILED, 9000), ("no-request-id", TR.RECEIVED, 1), (None, TR.QUEUED, 1)]
    got = TR.request_traces(spark.createDataFrame(rows, "request_id string, message string, at_us bigint")).collect()
    assert [(r["request_id"], r["result"], r["to_queue_ms"], r["in_queue_ms"]) for r in got] == [("a", "failed", 2.0, 7.0)]


def test_exposition_roundtrip_and_escapes(spark, tmp_path):
    values = spark.createDataFrame([('/a"b', 3)], "endpoint string, value bigint")
    lines = X.value_lines(values, "m_total", ["endpoint"]).unionByName(X.header_lines(spark, "m_total", "help", "counter"))
    hist = R.histogram(spark.createDataFrame([(7.0,)], "v double"), [], "v", [2.0, 10.0])
    X.write_exposition(X.histogram_lines(hist, "a_seconds", []).unionByName(lines), str(tmp_path / "x"))
    page = "".join(p.read_text() for p in sorted((tmp_path / "x").glob("part-*"))).splitlines()
    assert page == [
        'a_seconds_bucket{le="2.0"} 0.0', 'a_seconds_bucket{le="10.0"} 1.0', 'a_seconds_bucket{le="+Inf"} 1.0',
        "a_seconds_count 1.0", "a_seconds_sum 7.0",
        "# HELP m_total help", "# TYPE m_total counter", 'm_total{endpoint="/a\\"b"} 3.0',
    ]
    read = spark.read.text(str(tmp_path / "x")).where("value not like 'a_%'").unionByName(spark.createDataFrame([("",)], "value string"))
    assert [r["value"] for r in X.first_samples(read).collect()] == ['m_total{endpoint="/a\\"b"} 3.0']
    row = X.parse_samples(read).first()
    assert (row["metric"], row["sample_value"]) == ("m_total", 3.0)


def test_exposition_numbers(spark):
    values = spark.createDataFrame([(2.5e7,), (0.00001,), (12.34,), (0.0,), (float("nan"),), (1e20,)], "value double")
    got = [r["value"] for r in X.value_lines(values, "m", []).collect()]
    assert got == ["m 25000000.0", "m 1.0E-5", "m 12.34", "m 0.0", "m NaN", "m 1.0E20"]


def png(text):
    return {"data": {"image/png": base64.b64encode(text.encode()).decode(), "text/plain": "x"}}


def test_notebook_rules_numbers_and_last_write(spark, tmp_path):
    cells = [
        {"source": ["# text only"]},
        {"source": ["Confusion ", "Matrix and feature_importances"], "outputs": [png("one"), {"data": {"text/plain": "t"}}, png("two")]},
        {"source": ["nothing"], "outputs": [png("three"), {"name": "stdout"}]},
        {"source": ["Actual vs Predicted, Confusion Matrix"], "outputs": [png("four")]},
    ]
    (tmp_path / "a.ipynb").write_text(json.dumps({"cells": cells, "nbformat": 4}))
    (tmp_path / "empty.ipynb").write_text(json.dumps({"cells": []}))
    images = N.image_outputs(A.read_notebooks(spark, str(tmp_path)))
    got = sorted((r["n"], r["filename"], bytes(r["content"]).decode()) for r in images.collect())
    assert got == [
        (1, "02_classification_confusion_matrix.png", "one"),
        (2, "02_classification_confusion_matrix.png", "two"),
        (3, "plot_03.png", "three"),
        (4, "01_regression_actual_vs_predicted.png", "four"),
    ]
    final = {r["filename"]: bytes(r["content"]).decode() for r in N.last_write_wins(images).collect()}
    assert final["02_classification_confusion_matrix.png"] == "two" and len(final) == 3


def test_artifact_files_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a.bin", bytearray(b"xyz")), ("b.bin", bytearray(b"q"))], "filename string, content binary")
    for _ in range(2):  # a repeated write leaves the same files
        A.write_artifact_files(df, f"file://{tmp_path}/out")
    read = {r["path"].rsplit("/", 1)[1]: (r["length"], bytes(r["content"])) for r in A.read_image_bytes(spark, str(tmp_path / "out")).collect()}
    assert read == {"a.bin": (3, b"xyz"), "b.bin": (1, b"q")}


def test_artifact_names_stay_in_their_folder(spark, tmp_path):
    rows = lambda *names: spark.createDataFrame([(f, n, bytearray(b"x")) for f, n in names], "folder string, filename string, content binary")
    A.write_artifact_files(rows(("one", "a.png"), ("two", "a.png")), f"file://{tmp_path}/out", folder="folder")
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.png")) == ["out/one/a.png", "out/two/a.png"]
    for bad in (("..", "a.png"), ("one", "../b.png"), ("one", ""), ("one", None), ("", "a.png")):
        with pytest.raises(Exception, match="not the name of a file"):
            A.write_artifact_files(rows(bad), f"file://{tmp_path}/out", folder="folder")
    assert len(list(tmp_path.rglob("*.png"))) == 2


def test_files_are_listed_and_read_by_tasks(spark, tmp_path):
    rows = [(f"f{i % 7}", f"{i}.png", bytearray(b"x" * i)) for i in range(40)]
    A.write_artifact_files(spark.createDataFrame(rows, "folder string, filename string, content binary"), f"file://{tmp_path}/out", folder="folder", shards=3)
    assert len(list((tmp_path / "out").iterdir())) <= 3
    (tmp_path / "out" / "_hidden.png").write_bytes(b"x")
    (tmp_path / "out" / "other.txt").write_bytes(b"x")
    read = A.read_image_bytes(spark, f"{tmp_path}/out", "*.png", recursive=True)
    # The driver knows no file: a listing there grows with the files.
    assert list(read.inputFiles()) == []
    got = sorted((*r["path"].split("/")[-2:], bytes(r["content"]), r["length"]) for r in read.collect())
    assert got == sorted((f, n, bytes(c), len(c)) for f, n, c in rows if c)
    assert A.read_image_bytes(spark, f"{tmp_path}/out", "*.txt").first()["path"] == f"file:{tmp_path}/out/other.txt"


def test_notebooks_are_listed_and_read_by_tasks(spark, tmp_path):
    cell = {"source": ["a"], "outputs": [png("one")]}
    texts = {"one": json.dumps({"cells": [cell]}), "two": json.dumps([{"cells": []}, {"cells": [cell]}]), "broken": "{", "empty": " \n", "none": "[]"}
    (tmp_path / "0001").mkdir()
    for name, text in texts.items():
        (tmp_path / "0001" / f"{name} x.ipynb").write_text(text)
    read = A.read_notebooks(spark, f"file://{tmp_path}", recursive=True)
    assert list(read.inputFiles()) == []
    plain = A.read_notebooks(spark, f"{tmp_path}/000[1]")  # by Spark's own reader
    both = [sorted((r["path"], str(r["cells"])) for r in df.collect()) for df in (read, plain)]
    assert both[0] == both[1] and len(both[0]) == 4


def test_image_preparation():
    flat = np.full((30, 50, 3), 128, dtype=np.uint8)
    tensor = I.prepare(flat)
    assert tensor.shape == (3, 224, 224) and tensor.dtype == np.float32
    for c in range(3):
        want = (128 / 255 - S.CHANNEL_MEAN[c]) / S.CHANNEL_STD[c]
        assert np.allclose(tensor[c], want, atol=1e-6)
    # Shrinking by a whole factor averages, so the mean of the picture is kept.
    noise = np.random.default_rng(0).integers(0, 256, (512, 512, 3)).astype(np.uint8)
    small = np.einsum("ow,hwc->hoc", I.resample_weights(512, 256), noise)
    assert abs(small.mean() - noise.mean()) < 1


def test_channel_order_is_red_green_blue():
    class Row:
        data, height, width, nChannels = bytes([10, 20, 30]), 1, 1, 3

    assert I.to_rgb(Row).ravel().tolist() == [30, 20, 10]


def test_unknown_keys_and_broken_lines_are_kept(spark):
    lines = [('{"level": "INFO", "message": "m", "latency_ms": 1.5, "user": {"id": 7}}',), ('{"level": "INFO"}',), ("{broken",)]
    rows = L.parse_json_lines(spark.createDataFrame(lines, "value string")).collect()
    assert rows[0]["extras"] == {"latency_ms": "1.5", "user": '{"id":7}'} and rows[1]["extras"] == {}
    assert rows[2]["_corrupt_record"] == "{broken" and rows[2]["extras"] is None


def test_records_of_several_lines_are_folded(spark, tmp_path):
    head = "2024-01-01 00:00:0%d,000 - app - ERROR - [r%d] - failed"
    (tmp_path / "a.log").write_text("\n".join(["left over", head % (1, 1), "Traceback:", "", "  boom", head % (2, 2)]) + "\n")
    (tmp_path / "b.log").write_text("\n".join([head % (3, 3), "  other"]) + "\n")
    got = L.read_text_logs(spark, str(tmp_path)).collect()
    assert {(r["request_id"], r["message"], r["raw"]) for r in got} == {
        (None, None, "left over"), ("r1", "failed\nTraceback:\n\n  boom", None), ("r2", "failed", None), ("r3", "failed\n  other", None),
    }


def test_checksums_where_the_tensors_are_made(spark, tmp_path):
    from modelpulse.plans import logs as P

    A.write_artifact_files(P._bitmaps(spark, "/root/testdata/sf0.001").limit(12), f"file://{tmp_path}/out")
    images = A.read_images(spark, f"{tmp_path}/out").where("ok")
    chained = I.image_tensors(images, then=I.checksum_batches, schema=I.CHECKSUM_SCHEMA)
    # One pass through Python: a tensor as a row is 600 KB.
    assert chained._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    tensors = I.image_tensors(images, rows_per_batch=5)
    held = {r["origin"]: np.array(r["tensor"], dtype=np.float32) for r in tensors.collect()}
    assert len(held) == 12 and all(len(t) == 3 * 224 * 224 for t in held.values())
    assert sorted(map(tuple, chained.collect())) == sorted(map(tuple, I.channel_checksums(tensors).collect()))
    for row in chained.collect():
        red = np.rint((held[row["origin"]][: 224 * 224].astype(float) * 0.229 + 0.485) * 255).astype(int)
        assert row["red"] == sum(v * (1 + i % 9973) for i, v in enumerate(red.tolist()))
