"""JSON arrays read with schema on read keep every top-level field."""

import json

from strata.sources import files


def test_fields_that_no_schema_lists_are_kept(spark, tmp_path):
    docs = [[{"store_id": "S1", "extra": {"a": [1, "x"]}}, {"event_id": "E1", "note": None}], [{"other": 1.5}, {}], []]
    for i, part in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(part))
    got = [json.loads(r[0]) for r in files.read_json_array(spark, str(tmp_path)).selectExpr("to_json(row_col)").collect()]
    clean = lambda d: {k: v for k, v in d.items() if v is not None}
    want = [clean(d) for part in docs for d in part]
    text = lambda rows: sorted(json.dumps(d, sort_keys=True) for d in rows)
    assert text(map(clean, got)) == text(want)
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "0.json").write_text("[]")
    assert files.read_json_array(spark, str(empty)).count() == 0
