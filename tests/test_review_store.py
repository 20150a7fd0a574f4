"""The review store: build, edit, export, build anew, import; conflicts, repeated edits and a restart from the checkpoint."""

import json

import pytest

from adjudica.streaming import review_store as store

MANIFEST = "kind string, dataset_id string, key string, review_status string, review_reasons string, review_reason string, reviewer string, reviewed_at string, auto_tags array<string>, spot_check boolean"
ITEMS = [
    ("annotation", "d1", "A", "pending", None, "review_required", None, None, ["auto:s05_outside_body"], None),
    ("annotation", "d1", "B", "keep", None, "", "", "", [], False),
    ("annotation", "d2", "A", "keep", None, None, None, None, None, None),
    ("image", "d1", "i/s/e/F2", "pending", "", "", "", "", ["auto:m09_unannotated_view"], True),
]


def edit(n, key, field, value, reviewer="ann", base=0, kind="annotation", dataset="d1"):
    return {"kind": kind, "dataset_id": dataset, "key": key, "edit_id": f"e{n}", "at": f"2024-01-01T00:00:{n:02d}", "reviewer": reviewer, "base": base, "field": field, "value": value}


@pytest.fixture
def run(spark, tmp_path):
    """Writes edits as a file and runs the stream until they are done."""
    (tmp_path / "in").mkdir()
    count = iter(range(99))

    def go(items, *edits):
        (tmp_path / "in" / f"{next(count)}.json").write_text("\n".join(json.dumps(e) for e in edits))
        store.edit_stream(items, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return spark.read.schema(store.HISTORY_DDL).parquet(str(tmp_path / "out"))

    return go


def by_key(df):
    return {(r["dataset_id"], r["key"]): r for r in df.collect()}


def test_build_edit_export_import(spark, run):
    manifest = spark.createDataFrame(ITEMS, MANIFEST)
    items = store.built(manifest)
    assert by_key(items)["d1", "A"]["tags"] == ["auto:s05_outside_body", "review:pending"]
    assert by_key(items)["d1", "i/s/e/F2"]["tags"] == ["auto:m09_unannotated_view", "review:pending", "spot_check"]
    history = run(items, edit(1, "A", "status", "exclude"), edit(2, "A", "reasons", "invalid_duplicate|older_duplicate"), edit(3, "i/s/e/F2", "status", "exclude", kind="image"), edit(4, "i/s/e/F2", "reasons", "lateral_view", kind="image"))
    after = store.edited(items, history)
    verdicts = store.exported(after)
    assert {k: (r["decision"], r["reason"], r["reviewer"]) for k, r in by_key(verdicts).items()} == {
        ("d1", "A"): ("exclude", "invalid_duplicate|older_duplicate", "ann"), ("d1", "i/s/e/F2"): ("exclude", "lateral_view", "ann")}  # machine verdicts stay out
    assert store.unexported(after, verdicts).count() == 0
    assert store.unexported(after, verdicts.filter("kind = 'image'")).count() == 1
    again = store.imported(store.built(manifest), verdicts)  # the store was deleted
    assert sorted(map(tuple, store.imported_counts(items, verdicts).collect())) == [("annotation", 1), ("image", 1)]
    back = by_key(again)
    assert back["d1", "A"]["status"] == "exclude" and back["d1", "A"]["reason"] == ""
    assert back["d1", "A"]["tags"] == ["auto:s05_outside_body", "review:exclude", "reason:invalid_duplicate", "reason:older_duplicate"]
    assert back["d1", "B"]["status"] == "keep" and back["d2", "A"]["status"] == "keep"  # the same key in another dataset is another item
    assert back["d1", "i/s/e/F2"]["tags"] == ["auto:m09_unannotated_view", "spot_check", "review:exclude", "reason:lateral_view"]
    assert sorted(map(tuple, store.exported(again).collect())) == sorted(map(tuple, verdicts.collect()))


def test_conflicts_and_restart(spark, run):
    items = store.built(spark.createDataFrame(ITEMS, MANIFEST))
    history = run(items, edit(1, "A", "status", "exclude"), edit(2, "A", "comment", "?", reviewer="bob"))
    assert sorted((r["edit_id"], r["outcome"], r["version"]) for r in history.collect()) == [("e1", "applied", 1), ("e2", "applied", 2)]
    history = run(items, edit(3, "A", "status", "keep", reviewer="bob"), edit(4, "A", "status", "exclude", reviewer="bob"), edit(5, "A", "status", "keep", reviewer="bob", base=3),
                  edit(1, "A", "status", "exclude"), edit(6, "Z", "status", "keep"), edit(7, "A", "colour", "x"), edit(8, "B", "tag+", "flag:needs_report"), edit(9, "B", "tag-", "flag:needs_report", reviewer="bob"))
    found = {(r["edit_id"], r["outcome"], r["version"]) for r in history.collect()}
    # e3 did not know of e1; e4 says what e1 said; e5 saw version 3; e9 did not know of e8
    assert found == {("e1", "applied", 1), ("e2", "applied", 2), ("e3", "conflict", 2), ("e4", "applied", 3), ("e5", "applied", 4), ("e1", "repeated", 2),
                     ("e6", "no item", None), ("e7", "no field", 4), ("e8", "applied", 1), ("e9", "conflict", 1)}
    after = store.edited(items, history)
    assert by_key(after)["d1", "A"]["status"] == "keep" and by_key(after)["d1", "A"]["comment"] == "?"
    assert [r["key"] for r in store.flagged(after).collect()] == ["B"]


def test_status_by_tag_alone_and_no_name(spark, run):
    items = store.built(spark.createDataFrame(ITEMS, MANIFEST))
    history = run(items, edit(1, "A", "tag+", "review:keep", reviewer=""), edit(2, "B", "status", "exclude", reviewer=None))
    got = by_key(store.exported(store.edited(items, history)))
    assert {k: (r["decision"], r["reviewer"]) for k, r in got.items()} == {("d1", "A"): ("keep", "unknown"), ("d1", "B"): ("exclude", "unknown")}
    assert store.exported(store.edited(items, history), baseline=False).count() == 0
    assert store.exported(items.limit(0)).count() == 0


class Held:
    """A state that counts the calls that go to it."""

    def __init__(self, calls, value=None):
        self.calls, self.value, self.values = calls, value, []

    def __getattr__(self, name):
        self.calls.append(name)
        plain = {"exists": lambda: self.value is not None, "get": lambda: self.value or iter(self.values), "update": lambda v: setattr(self, "value", v)}
        return {**plain, "put": lambda v: setattr(self, "values", v), "appendList": lambda v: self.values.extend(v)}.get(name) or (lambda *a: None)


def test_state_is_called_by_item_and_not_by_edit():
    calls, processor = [], store.Edits()
    handle = type("Handle", (), {f"get{k}State": lambda self, *a: Held(calls) for k in ("Value", "List", "Map")})()
    processor.init(handle)
    processor.item.value = (0, "pending", "", "", "", "", "", [])
    edits = [store.Row(**edit(n, "A", "comment", f"c{n}", f"r{n % 3}", base=n if n % 2 else 0)) for n in range(300)]
    told = [r["outcome"] for r in processor.handleInputRows(("annotation", "d1", "A"), iter(edits[:200]), None)]
    told += [r["outcome"] for r in processor.handleInputRows(("annotation", "d1", "A"), iter(edits[100:]), None)]
    assert len(calls) < 20
    assert told[200:300] == ["repeated"] * 100 and "repeated" not in told[:200] + told[300:] and {"applied", "conflict"} <= set(told[:200])
