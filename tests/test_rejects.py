"""Lines that are no records leave through a channel of their own."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lastmile import fixed
from lastmile.plans import pipeline
from lastmile.sources import files, layers, rejects
from lastmile.streaming.incremental import ingest_available

HEADER = ",".join(fixed.SHIPMENT_FIELDS)
GOOD = "T1,2024-01-01 08:00:00,2024-01-01 09:00:00,Madrid,28001,\"2,5\",DELIVERED,REP-1,PERSON,9.5"


def _land(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


CSV_CASES = [
    (GOOD, None),
    ("T2,,,,,,,,,", None),  # ten empty fields
    ('T3,2024-01-01 08:00:00,,"Las "Palmas" x,28001,1,DELIVERED,REP-1,PERSON,9.5', "unclosed_quote"),
    ('T4,2024-01-01 08:00:00,,"a \\"quoted\\", city",28001,1,DELIVERED,REP-1,PERSON,9.5', None),
    ('T5,2024-01-01 08:00:00,,"Madrid,28001,1,DELIVERED,REP-1,PERSON,9.5', "unclosed_quote"),
    ('T6,2024-01-01 08:00:00,,Madrid,28001,1,DELIVERED,REP-1,PERSON,"9.5', "unclosed_quote"),
    ("T7", "short_line"),
    ("T8,2024-01-01 08:00:00,,Madrid,28001,1,DELIVERED,REP-1,PERSON", "short_line"),
    ("T9,2024-01-01 08:00:00,,Madrid,28001,2,5,DELIVERED,REP-1,PERSON,9.5", "long_line"),
    (GOOD + ",", "long_line"),
    ("\u0001;" * 3, "short_line"),
]


def test_every_csv_line_is_a_record_or_a_reject(spark, tmp_path):
    _land(f"{tmp_path}/in", "a.csv", HEADER, *[line for line, _ in CSV_CASES], "", "   ")
    got = {r.line: (r.reason, r.source_file) for r in files.rejected_shipments(spark, f"{tmp_path}/in").collect()}
    assert got == {line: (reason, "a.csv") for line, reason in CSV_CASES if reason}
    records = {r.tracking_id: r for r in files.read_shipments_csv(spark, f"{tmp_path}/in").collect()}
    assert sorted(records) == ["T1", "T2", "T4"]
    assert records["T1"].weight_raw == "2,5" and records["T2"].city is None and records["T4"].city == 'a "quoted", city'


JSON_CASES = [
    ('{"courier_id":"R1","first_name":"A"}', None),
    ('  {"courier_id":"R2","phone":null, "more": {"x": 1}}', None),
    ('{"courier_id":7,"vehicle":"VAN"}', None),  # a number is kept as text
    ('{"courier_id":"R3","first_name":', "broken_json"),
    ("R4;VAN", "broken_json"),
    ('["R5"]', "not_an_object"),
    ('[{"courier_id":"R6"}]', "not_an_object"),
    ('"R7"', "not_an_object"),
    ("12", "not_an_object"),
    ("{}", "no_key"),
    ('{"courier_id":null,"vehicle":"VAN"}', "no_key"),
]


def test_every_json_line_is_a_record_or_a_reject(spark, tmp_path):
    _land(f"{tmp_path}/in/sub", "a.json", *[line for line, _ in JSON_CASES], "", " ")
    got = {r.line: r.reason for r in files.rejected_couriers(spark, f"{tmp_path}/in").collect()}
    assert got == {line: reason for line, reason in JSON_CASES if reason}
    records = {r.courier_id: r for r in files.read_couriers_json(spark, f"{tmp_path}/in").collect()}
    assert sorted(records) == ["7", "R1", "R2"] and records["7"].vehicle == "VAN"


def test_a_file_of_rejects_only_and_an_empty_file(spark, tmp_path):
    _land(f"{tmp_path}/in", "a.csv", HEADER)
    _land(f"{tmp_path}/in", "b.csv", HEADER, "x")
    assert files.read_shipments_csv(spark, f"{tmp_path}/in").count() == 0
    assert [r.reason for r in files.rejected_shipments(spark, f"{tmp_path}/in").collect()] == ["short_line"]


def test_the_marked_lines_are_read_once(spark, tmp_path):
    _land(f"{tmp_path}/in", "a.csv", HEADER, GOOD, "x")
    counts = rejects.line_counts(files.marked_lines(spark, f"{tmp_path}/in", "shipments"), "shipments")
    assert counts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(map(tuple, counts.collect())) == [("shipments", "accepted", 1), ("shipments", "short_line", 1)]


def test_layers_keep_and_count_the_rejects(spark, tmp_path):
    layout = pipeline.Layout(f"{tmp_path}/lake")
    _land(layout.landing_shipments, "a.csv", HEADER, GOOD, "x", "y,z")
    _land(layout.landing_couriers, "a.json", '{"courier_id":"REP-1","contract":"EMP"}', "{")
    result = pipeline.run_layers(spark, layout.root)
    assert result["bronze"] == {"shipments": 1, "couriers": 1}
    kept = layers.read_layer(spark, layout.path("bronze", "shipments_rejected"))
    assert sorted(r.line for r in kept.collect()) == ["x", "y,z"]
    report = dict(layers.read_layer(spark, layout.path("gold", "silver_quality")).collect())
    assert (report["rejected_shipments"], report["rejected_couriers"]) == (2.0, 1.0)


@pytest.mark.parametrize("kind", ["shipments", "couriers"])
def test_the_stream_separates_them_too(spark, tmp_path, kind):
    if kind == "shipments":
        _land(f"{tmp_path}/in", "a.csv", HEADER, GOOD, "x")
    else:
        _land(f"{tmp_path}/in", "a.json", '{"courier_id":"R1"}', "{")
    for rejected in (False, True):
        name = f"{tmp_path}/{kind}-{rejected}"
        assert ingest_available(spark, f"{tmp_path}/in", name, f"{name}-ckpt", kind, rejected=rejected) == 1
        assert ingest_available(spark, f"{tmp_path}/in", name, f"{name}-ckpt", kind, rejected=rejected) == 0
    assert [r.line for r in layers.read_layer(spark, f"{tmp_path}/{kind}-True").select(F.col("line")).collect()] == ["x" if kind == "shipments" else "{"]


def test_plain_lines_take_the_short_way_to_the_same_reason(spark):
    """Lines with and without quotes and backslashes against a count by hand."""
    rng = random.Random(8)
    lines = ["".join(rng.choice('ab ,,"\\' if k % 2 else "ab ,,é") for _ in range(rng.randint(0, 12))) for k in range(400)]

    def by_hand(line):
        inside, found, i = False, 1, 0
        while i < len(line):
            if line[i] == "\\" and i + 1 < len(line):
                i += 1
            elif line[i] == '"':
                inside = not inside
            elif line[i] == "," and not inside:
                found += 1
            i += 1
        if inside:
            return rejects.UNCLOSED
        return rejects.SHORT if found < 4 else rejects.LONG if found > 4 else None

    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [(r.line, r.reason) for r in frame.select("line", rejects.csv_reason(F.col("line"), 4).alias("reason")).collect()]
    assert got == [(x, by_hand(x)) for x in lines]
