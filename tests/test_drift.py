"""Undeclared fields are kept with their values and reported by file."""

import json
from datetime import datetime
from uuid import uuid4

from test_operators import TYPE_1, TYPE_2

from chargelake.plans import jobs
from chargelake.sinks.lakehouse import Lakehouse

RUN = datetime(2025, 3, 1, 12)


def test_unknown_fields_by_file(spark, tmp_path):
    lake = Lakehouse(spark, f"lake_{uuid4().hex[:10]}", str(tmp_path / "lake"))
    grown = json.loads(json.dumps(TYPE_1))
    grown["policy"] = {"kind": "n", "pages": [1, 2]}
    for number, item in enumerate(grown["standard_charge_information"]):
        item["rank"] = number if number else "first"
        for charge in item["standard_charges"]:
            charge["currency"] = None
    for name, content in {"a": [grown, TYPE_1], "b": TYPE_2, "c": TYPE_1 | {"license_information": {"license": "L", "issued": "1999"}}}.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(content))
    jobs.ingest(lake, str(tmp_path / "in"), RUN)
    for _ in range(2):
        jobs.keep_unknown_fields(lake, RUN)
    items = len(grown["standard_charge_information"])
    charges = sum(len(item["standard_charges"]) for item in grown["standard_charge_information"])
    found = {(r.source_id.split("-")[0], r.field): (r.occurrences, r.type) for r in jobs.unknown_fields(lake).collect()}
    kinds = found.pop(("a", "standard_charge_information[].rank"))
    assert kinds[0] == items
    assert found == {
        ("a", "policy"): (1, "OBJECT<kind: STRING, pages: ARRAY<BIGINT>>"),
        ("a", "standard_charge_information[].standard_charges[].currency"): (charges, "VOID"),
        ("c", "license_information.issued"): (1, "STRING")}
    kept = {(r.field, r.value) for r in lake.read("unknown_values").collect()}
    assert ("policy", '{"kind":"n","pages":[1,2]}') in kept and ("license_information.issued", '"1999"') in kept
