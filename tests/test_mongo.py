"""Document images: extended JSON, flattened landing, patches folded to the newest image."""

import json

from pyspark.sql import functions as F

from cdclake import CdcConfig, ingest_batch, read_table
from cdclake.operators.mongo import latest_documents, plain_json
from helpers import events, fld, value


def test_extended_json_becomes_plain(spark):
    cases = {
        '{"_id": {"$oid": "5f"}, "n": {"$numberLong": "-12"}, "i": {"$numberInt": "3"}, "f": {"$numberDouble": "1.5"}}': {"_id": "5f", "n": -12, "i": 3, "f": 1.5},
        '{"t": {"$date": {"$numberLong": "99"}}, "u": {"$date": "2020-01-01T00:00:00Z"}, "d": {"$numberDecimal": "1.50"}}': {"t": 99, "u": "2020-01-01T00:00:00Z", "d": "1.50"},
        '{"b": {"$binary": "YQ==", "$type": "00"}, "c": {"$binary": {"base64": "Yg==", "subType": "00"}}, "x": {"$numberDouble": "NaN"}}': {"b": "YQ==", "c": "Yg==", "x": None},
        json.dumps({"s": '{"$oid": "5f"}', "e": "a\\"}): {"s": '{"$oid": "5f"}', "e": "a\\"},
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", plain_json(F.col("t")).alias("p")).collect()
    assert {r.t: json.loads(r.p) for r in rows} == cases


def test_documents_land_flattened(spark, lake):
    source = {"type": "struct", "field": "source", "optional": True, "fields": [fld("connector", "string"), fld("collection", "string"), fld("ord", "int32"), fld("ts_ms", "int64")]}
    fields = [fld("after", "string"), fld("patch", "string"), source, fld("op", "string"), fld("ts_ms", "int64")]
    doc = lambda i: json.dumps({"_id": {"$oid": f"o{i}"}, "n": {"$numberLong": str(i)}, "in": {"a": i}})
    rows = [("m.c", None, value(fields, {"after": doc(i), "patch": None, "source": {"connector": "mongodb", "collection": "c", "ord": i, "ts_ms": 5}, "op": "c", "ts_ms": 6})) for i in range(3)]
    rows.append(("m.c", None, value(fields, {"after": None, "patch": None, "source": {"connector": "mongodb", "collection": "c", "ord": 9, "ts_ms": 5}, "op": "d", "ts_ms": 6})))
    ingest_batch(events(spark, rows), CdcConfig(base_path=lake, unwrap=True, add_fields=("op", "source.ord")))
    got = read_table(spark, f"{lake}/m.c").collect()
    assert sorted((r._id, r.n, r["in"].a, r["__op"], r["__source_ord"]) for r in got if r._id) == [(f"o{i}", i, i, "c", i) for i in range(3)]
    assert [r["__deleted"] for r in got if r._id is None] == ["true"]


def fold(changes):
    """Plain fold, event by event."""
    docs = {}
    for k, _, op, after, patch in sorted(changes, key=lambda c: c[1]):
        p = json.loads(patch) if patch else {}
        if op == "d":
            docs.pop(k, None)
        elif after:
            docs[k] = json.loads(after)
        elif "$set" in p or "$unset" in p:
            d = docs.setdefault(k, {})
            for f in p.get("$unset", {}):
                d.pop(f, None)
            d.update(p.get("$set", {}))
        elif patch:
            docs[k] = p
    return docs


def test_patches_are_folded_in_order(spark):
    import random

    r = random.Random(7)
    changes, names = [], ["a", "b", "c"]
    for i in range(400):
        k, x = r.randrange(12), r.random()
        some = {n: r.choice([1, 2, None]) for n in r.sample(names, 2)}
        if x < 0.2:
            changes.append((k, i, "c", json.dumps(some), None))
        elif x < 0.3:
            changes.append((k, i, "d", None, None))
        elif x < 0.35:
            changes.append((k, i, "u", None, json.dumps(some)))
        elif x < 0.8:
            changes.append((k, i, "u", None, json.dumps({"$set": some} | ({"$unset": {r.choice(names): True}} if r.random() < 0.3 else {}))))
        else:
            changes.append((k, i, "u", None, json.dumps({"$unset": {r.choice(names): True}})))
    changes += [(50 + i, 1000, "c", json.dumps({"a": i}), None) for i in range(3)] + [(60, 2, "d", None, None), (61, 1, "u", None, json.dumps({"$set": {"a": 4}}))]
    r.shuffle(changes)
    schema = "k int, at int, op string, after string, patch string"
    frame = spark.createDataFrame(changes + [(None, 5, "c", "{}", None)], schema)
    got = latest_documents(frame, "k", ["at"], struct=spark.createDataFrame([], "a int, b int, c int").schema)
    assert got.columns == ["k", "a", "b", "c", "__deleted"]
    want = fold(changes)
    assert {x.k: (x.a, x.b, x.c) for x in got.collect()} == {k: tuple(d.get(n) for n in names) for k, d in want.items()}
    kept = latest_documents(frame, "k", ["at"], keep_deleted=True).collect()
    assert {x.k for x in kept if x["__deleted"]} == {c[0] for c in changes} - set(want)
    assert latest_documents(frame.limit(0), "k", ["at"]).count() == 0


def test_values_keep_their_json(spark):
    doc = {"k": 1, 'quo"te\\': 'a"b\\c', "é": [1, {"x": None}], "o": {"y": "z"}}
    rows = [(1, 1, "c", json.dumps(doc), None), (1, 2, "u", None, json.dumps({"$set": {"o": {"y": "w"}, "n": "t"}}))]
    out = latest_documents(spark.createDataFrame(rows, "id int, at int, op string, after string, patch string"), "id", ["at"]).first()
    assert out['quo"te\\'] == 'a"b\\c' and out["é"][0] is not None and out["o"].y == "w" and out["n"] == "t"
