"""JSON payload readers."""

from conftest import rows
from daycast.sources.payloads import flatten_arrays, flatten_records


def _p(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")


def test_record_envelopes(spark):
    texts = [
        '{"records": [{"record": {"jour": "2024-01-01", "conso_jour": 1.0}}, {"jour": "2024-01-02", "conso_jour": 2.0}]}',
        '{"results": [{"jour": "2024-01-03", "conso_jour": 3.0}]}',
        '{"records": [], "results": [{"jour": "2024-01-04", "conso_jour": 4.0}]}',
        '{"other": 1}',
    ]
    got = sorted(rows(flatten_records(_p(spark, texts), keep=["id"])[0], "id", "jour", "conso_jour"))
    assert got == [(0, "2024-01-01", 1.0), (0, "2024-01-02", 2.0), (1, "2024-01-03", 3.0)]


def test_array_payloads_and_rejects(spark):
    good = ('{"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [1.0, 2.0], '
            '"temperature_2m_min": [0.0, 1.0], "temperature_2m_mean": [0.5, 1.5]}}')
    bad = ('{"daily": {"time": ["2024-01-01"], "temperature_2m_max": [1.0, 2.0], '
           '"temperature_2m_min": [0.0], "temperature_2m_mean": [0.5]}}')
    none = '{"hourly": {}}'
    ok, rej = flatten_arrays(_p(spark, [good, bad, none]), keep=["id"])
    assert sorted(rows(ok, "id", "time", "temperature_2m_mean")) == [(0, "2024-01-01", 0.5), (0, "2024-01-02", 1.5)]
    assert sorted(r[0] for r in rows(rej, "id")) == [1, 2]


def test_envelope_fixture_has_all_shapes_and_round_trips(spark):
    from pyspark.sql import functions as F

    from conftest import SMALL
    from daycast.sources.fixtures import event_readings
    from daycast.sources.payloads import envelope_payloads

    r = event_readings(spark, SMALL)
    pl = envelope_payloads(r)
    kinds = {("nested" if '"record"' in p else "results" if p.startswith('{"results"') else "records")
             for (p,) in rows(pl, "payload")}
    assert kinds == {"nested", "results", "records"}
    back = flatten_records(pl, keep=["page"])[0]
    assert back.count() == r.count()
    assert back.agg(F.round(F.sum("conso_jour"), 2)).first()[0] == r.agg(F.round(F.sum("value"), 2)).first()[0]


def test_no_payload_is_lost(spark):
    """Every payload gives rows or is a reject; a record without fields is a row of NULLs."""
    texts = ['{"records": [{"jour": "2024-01-01"}, {}, {"record": {}}]}', '{"records": [{"jour": "20', "", "[1]", None, '{"results": []}']
    good, bad = flatten_records(_p(spark, texts), keep=["id"])
    assert sorted(rows(good, "id", "jour", "conso_jour"), key=str) == [(0, "2024-01-01", None), (0, None, None), (0, None, None)]
    assert sorted(r[0] for r in rows(bad, "id")) == [1, 2, 3, 4]
    three = '{"daily": {"time": ["2024-01-01"], "temperature_2m_max": [1.0], "temperature_2m_min": [1.0], "temperature_2m_mean": [1.0]}}'
    part = three.replace(', "temperature_2m_mean": [1.0]', "")
    good, bad = flatten_arrays(_p(spark, [three, part, "x", '{"daily": null}']), keep=["id"])
    assert [r[0] for r in rows(good, "id")] == [0] and sorted(r[0] for r in rows(bad, "id")) == [1, 2, 3]
