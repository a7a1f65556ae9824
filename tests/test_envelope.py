from __future__ import annotations

import hashlib
import hmac
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillmart.entities import ENTITIES
from tillmart.functions.privacy import hmac_sha256, normal_phone
from tillmart.operators import envelope
from tillmart.operators.facts import explode_items
from tillmart.operators.pseudonymise import pseudonymise
from tillmart.plans import jobs
from tillmart.sources import documents, messages

AS_OF = "2026-03-08 12:00:00"


def opened(spark, rows, topic="purchases"):
    df = spark.createDataFrame(rows, "json_data string, event_time string")
    return envelope.open_envelopes(df, ENTITIES[topic].schema, AS_OF)


def test_reject_reasons(spark):
    good = json.dumps({"purchase_id": "a"})
    rows = [
        (None, "2026-01-01T00:00:00"), ("", "2026-01-01T00:00:00"), ('{"purchase_id":', "2026-01-01T00:00:00"),
        ("[1]", "2026-01-01T00:00:00"), ("5", "2026-01-01T00:00:00"), (good + " tail", "2026-01-01T00:00:00"),
        (good, "soon"), (good, None), (good, "2026-01-01T00:00:00Z"),
    ]
    got = opened(spark, rows).select("reject_reason", "event_clock").collect()
    assert [r.reject_reason for r in got] == [
        "missing json_data", "missing json_data", "invalid json", "not an object", "not an object",
        "not an object", "invalid event_time", None, None]
    assert got[7].event_clock == datetime(2026, 3, 8, 12)
    assert got[8].event_clock == datetime(2026, 1, 1, 3)
    both = opened(spark, rows)
    assert envelope.accepted(both).count() + envelope.rejected(both).count() == len(rows)


def test_flatten_defaults_and_wrong_types(spark):
    doc = {
        "purchase_id": "p1", "customer": "not an object", "total_amount": 1.50, "is_delivery": True,
        "store": {"store_id": None, "location": {"coordinates": {"latitude": 55.7}}},
        "items": [{"product_id": "a", "quantity": 2, "kbju": {"fat": None}}, None, "junk", 7,
                  {"product_id": None, "manufacturer": {"inn": "77"}}],
    }
    row = envelope.flatten(opened(spark, [(json.dumps(doc), "2026-01-01T00:00:00")]),
                           ENTITIES["purchases"]).first()
    assert row.customer_customer_id == "" and row.store_store_id == ""
    assert row.total_amount == "1.5" and row.is_delivery == "true"
    assert row.store_location_coordinates_latitude == "55.7"
    assert [i.product_id for i in row["items"]] == ["a", ""]
    assert row["items"][0].quantity == "2" and row["items"][0].kbju_fat == ""
    assert row["items"][1].manufacturer_inn == "77"


def test_items_missing_or_not_a_list(spark):
    rows = [(json.dumps({"purchase_id": "x", "items": v}), "2026-01-01T00:00:00")
            for v in ([], None, {"product_id": "a"}, "text")]
    raw = envelope.flatten(opened(spark, rows), ENTITIES["purchases"])
    assert [len(r["items"]) for r in raw.collect()] == [0, 0, 0, 0]
    assert explode_items(raw).count() == 0


def test_categories_list_or_text(spark):
    rows = [(json.dumps({"store_id": "s", "categories": v}, ensure_ascii=False), "2026-01-01T00:00:00")
            for v in (["Хлеб", "Мясо"], [], "plain", None)]
    raw = envelope.flatten(opened(spark, rows, "stores"), ENTITIES["stores"])
    assert [r.categories for r in raw.collect()] == ["Хлеб, Мясо", "", "plain", ""]


def test_raw_column_counts():
    counts = {t: len(e.raw_columns) for t, e in ENTITIES.items()}
    assert counts == {"stores": 23, "products": 18, "customers": 26, "purchases": 29}


def test_parallel_arrays_round_trip(spark):
    doc = {"purchase_id": "p", "items": [{"product_id": "a"}, {"product_id": "b", "unit": "кг"}]}
    raw = envelope.flatten(opened(spark, [(json.dumps(doc), "2026-01-01T00:00:00")]),
                           ENTITIES["purchases"]).select("purchase_id", "items")
    arrays = envelope.parallel_arrays(raw)
    assert arrays.select("`items.product_id`").first()[0] == ["a", "b"]
    assert envelope.zip_arrays(arrays).collect() == raw.collect()


@pytest.mark.parametrize("secret", ["k", "x" * 64, "long" * 40])
def test_hmac_matches_python(spark, secret):
    values = ["a", "Ёж", "+79990000000", "", None]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(hmac_sha256(F.col("x"), secret)).collect()]
    want = [hmac.new(secret.encode(), v.encode(), hashlib.sha256).hexdigest() if v else "" for v in values]
    assert got == want


def test_phone_rules(spark):
    pairs = {"8 (999) 123-45-67": "+79991234567", "7 999 123 45 67": "+79991234567",
             "9991234567": "+79991234567", "+7 999 123-45-67": "+79991234567",
             "+1 555": "+1555", "7+5": "7+5", "abc": "", "": ""}
    df = spark.createDataFrame([(k,) for k in pairs], "x string")
    got = {r.x: r.y for r in df.select("x", normal_phone(F.col("x")).alias("y")).collect()}
    assert got == pairs


def test_contacts_hashed_at_any_depth(spark):
    schema = ("id string, Email string, a struct<contactPhone string, b struct<email string, n int>>, "
              "list array<struct<phone2 string, z string>>, phones array<string>, phone int")
    df = spark.createDataFrame(
        [("1", " A@B.c ", ("8 1", ("e", 1)), [("9", "z"), None], ["8"], 5), ("2", None, None, None, None, None)],
        schema)
    out = pseudonymise(df, "k")
    assert [f.name for f in out.schema.fields] == [f.name for f in df.schema.fields]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in df.schema.fields]
    first, second = out.collect()

    def h(v):
        return hmac.new(b"k", v.encode(), hashlib.sha256).hexdigest()

    assert first.Email == h("a@b.c") and first.a.contactPhone == h("+71") and first.a.b.email == h("e")
    assert first.a.b.n == 1 and first.list[0].phone2 == h("9") and first.list[0].z == "z"
    assert first.list[1] is None and first.phones == ["8"] and first.phone == 5
    assert second.Email is None and second.a is None and second.list is None


def test_products_pass_through_and_key_required(spark):
    df = spark.createDataFrame([("p",)], "phone string")
    assert pseudonymise(df, "k", "products").first().phone == "p"
    with pytest.raises(ValueError):
        pseudonymise(df, "", "customers")


def test_pads_do_not_show_in_plans(spark, capsys):
    pseudonymise(spark.createDataFrame([("p",)], "phone string"), "secret").explain(True)
    pad = bytes(b ^ 0x36 for b in b"secret".ljust(64, b"\0")).hex().upper()
    assert pad not in capsys.readouterr().out.upper()


def test_publish_and_read_back(spark, tmp_path):
    doc = spark.createDataFrame([("c1", "8 999", "A@b")], "customer_id string, phone string, email string")
    jobs.publish(doc, "customers", "k", "2026-01-01 10:00:00.000001", str(tmp_path / "log"))
    envelopes = spark.read.schema(messages.ENVELOPE).json(str(tmp_path / "log"))
    raw = envelope.to_raw(envelopes.where("topic = 'customers'"), "customers", AS_OF).first()
    assert raw.event_time == datetime(2026, 1, 1, 10, 0, 0, 1)
    assert len(raw.phone) == 64 and raw.customer_id == "c1" and raw.gender == ""


def test_log_records_round_trip(spark):
    rows = spark.createDataFrame([("t", '{"a":1}', "2026")], messages.ENVELOPE)
    back = messages.from_log_records(messages.to_log_records(rows))
    assert back.collect() == rows.collect()
    options = messages.log_options("host:1", ["a", "b"], 5)
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "earliest"


def test_document_folders(spark, tmp_path):
    folder = tmp_path / "docs" / "products"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n" + json.dumps({"id": "a", "kbju": {"fat": 1}}, indent=2) + "\r\n", "utf-8")
    (folder / "b.json").write_text('{"id": ', "utf-8")
    (folder / "c.txt").write_text("ignored", "utf-8")
    schema = ENTITIES["products"].schema
    rows = documents.read_documents(spark, str(folder), schema).collect()
    assert [(r.id, r.kbju.fat) for r in rows] == [("a", "1")]
    bad = documents.malformed_documents(spark, str(folder), schema).collect()
    assert [(r.path.endswith("b.json"), r.reject_reason) for r in bad] == [(True, "invalid json")]
    out = str(tmp_path / "out")

    def counts(clear):
        loaded = documents.load_documents(spark, str(tmp_path / "docs"), out, clear, ("products", "stores"))
        return {r.topic: r.documents for r in loaded.collect()}

    assert counts(True) == {"products": 1, "stores": 0}
    assert counts(False) == {"products": 1, "stores": 0}
    assert spark.read.parquet(f"{out}/products").count() == 2
    assert counts(True) == {"products": 1, "stores": 0}
    assert spark.read.parquet(f"{out}/products").count() == 1
    assert documents.read_collection(spark, "parquet", path=f"{out}/products").count() == 1


def test_contacts_in_maps_are_hashed_by_key(spark):
    df = spark.createDataFrame(
        [({"phone": "8 1", "Email": "A@b.c ", "x": "y", "n": None}, {"a": ("8 1", "z")}, [{"e_mail": "q", "email2": "E"}])],
        "m map<string,string>, nested map<string,struct<phone string, z string>>, listed array<map<string,string>>")
    row = pseudonymise(df, "k").first()

    def h(v):
        return hmac.new(b"k", v.encode(), hashlib.sha256).hexdigest()

    assert row.m == {"phone": h("+71"), "Email": h("a@b.c"), "x": "y", "n": None}
    assert row.nested["a"].phone == h("+71") and row.nested["a"].z == "z"
    assert row.listed == [{"e_mail": "q", "email2": h("e")}]


def test_pads_are_never_printed(spark):
    name = "spark.sql.redaction.string.regex"
    before = spark.conf.get(name)
    try:
        for pattern in ("", "secret"):
            spark.conf.set(name, pattern)
            df = pseudonymise(spark.createDataFrame([("8 1",)], "phone string"), "my key")
            pad = bytes(b ^ 0x36 for b in b"my key".ljust(64, b"\0")).hex()
            assert pad not in df._jdf.queryExecution().toString().lower()
    finally:
        spark.conf.set(name, before)


def test_documents_are_written_by_many_tasks_and_loaded_into_large_files(spark, tmp_path):
    from tillmart.plans.queries import _write_documents

    rows = spark.range(80, numPartitions=1).select(F.concat(F.lit("s-"), "id").alias("store_id"), F.lit("Лавка").alias("store_name"))
    _write_documents(rows, str(tmp_path / "in" / "stores"))
    files = sorted((tmp_path / "in" / "stores").glob("*.json"))
    assert len(files) == 80 and all(f.read_bytes().count(b"\n") == 1 for f in files)
    assert len({f.name.split("-")[1] for f in files}) > 1
    for clear, times in ((False, 1), (True, 1), (False, 2)):
        documents.load_documents(spark, str(tmp_path / "in"), str(tmp_path / "out"), clear, ("stores",))
        loaded = spark.read.parquet(str(tmp_path / "out" / "stores"))
        assert len(list((tmp_path / "out" / "stores").glob("part-*"))) == times
        assert loaded.count() == 80 * times and loaded.select("store_id", "store_name").exceptAll(rows).count() == 80 * (times - 1)


def test_malformed_documents_keep_their_bytes(spark, tmp_path):
    (tmp_path / "bad.json").write_bytes(b'\xef\xbb\xbf{"store_id": "\xff"\r\n')
    text = documents.open_documents(spark, str(tmp_path), "store_id string").select(F.col("json_data").cast("binary")).first()[0]
    assert bytes(text) == b'\xef\xbb\xbf{"store_id": "\xff"\r\n'


def test_some_raw_columns_come_from_the_same_messages(spark):
    rows = [(t, "2026-01-01T00:00:00") for t in (
        json.dumps({"purchase_id": "a", "customer": {"customer_id": "c", "phone": "1"}, "items": [{"name": "x"}], "purchase_datetime": "d"}),
        json.dumps({"purchase_id": {"x": 1}, "customer": {"phone": 5}, "items": [1, {"name": "y"}]}),
        json.dumps({"customer": [1], "items": "no", "store": 3}),
        '{"customer": {"phone": "2"}, "items": [{"name": "x"}', '{"items": [1 2], "customer": {"phone": "3"}}',
        '[1]', "null", "{}", '  {"customer": null} ', None)]
    rows.append((rows[0][0], "yesterday"))
    df = spark.createDataFrame(rows, "json_data string, event_time string")
    shown = ["customer_phone", "customer_customer_id", "purchase_datetime"]
    some = envelope.to_raw(df, "purchases", AS_OF, shown)
    want = envelope.to_raw(df, "purchases", AS_OF).select(*shown)
    assert some.columns == shown and sorted(some.collect()) == sorted(want.collect())
    assert want.count() == 5


def test_phones_are_cleaned_as_the_rules_say(spark):
    digits = ["", "8", "7", "+7", "+", "8+", "7+", "78", "87", "9123456789", "7123456789", "7+23456789", "8123456789",
              "+123456789", "89123456789", "79123456789", "+79123456789", "7 (912) 345-67-89+", "a8", "x9\n123456789", "98+7"]

    def rule(text):
        kept = "".join(c for c in text if c in "0123456789+")
        if kept.startswith("8") or (kept.startswith("7") and "+" not in kept):
            return "+7" + kept[1:]
        return "+7" + kept if len(kept) == 10 else kept

    got = spark.createDataFrame([(x,) for x in digits], "x string").select("x", normal_phone(F.col("x")).alias("y")).collect()
    assert {r.x: r.y for r in got} == {x: rule(x) for x in digits}
