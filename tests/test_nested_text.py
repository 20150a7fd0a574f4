"""Nested documents in parts: the reader against the reader of whole texts, at every size of block, and the writer in one part and in many."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from adjudica.sources import nested, nested_text

NASTY = ['plain', 'br{ace}s', '}{', 'qu"ote', 'back\\slash', 'ends in \\', '":{', 'line\nbreak', 'ü日\U0001f600', '"]}', '', '}}}}', '\\"}']


def _document(seed, institutions=4, studies=7):
    r = random.Random(seed)
    word = lambda: r.choice(NASTY)
    name = lambda kind, k: f"{kind}{k}{word()}"
    annotation = lambda k: {"geometry_uid": f"g{k}", "comment": word(), "labels": [{"code": word(), "label_id": k}]}
    image = lambda k: {"image_path": f"image/{word()}/{k}", "annotations": [annotation(j) for j in range(r.randrange(3))]}
    series = lambda k: {"shape": {"w": k, "h": 2}, "file_list": {name("f", j): image(j) for j in range(r.randrange(4))}}
    study = lambda k: {"patient_id": word(), "study_date": None, "annotations": [], "series_list": {name("e", j): series(j) for j in range(r.randrange(3))}}
    data = {name("i", k): {name("s", j): study(j) for j in range(r.randrange(studies))} for k in range(institutions)}
    return {"version_id": word(), "other": {"x": {"y": {"z": {"patient_id": "no study"}}}}, "list": [[{"a": {"b": 1}}]], "dataset": data, "after": {"a": {"b": {"c": {"d": 1}}}}}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    home = tmp_path_factory.mktemp("nested")
    for k, layout in enumerate(({}, {"indent": 1}, {"separators": (",", ":")}, {"ensure_ascii": False})):
        (home / f"set-D{k}-20260102_030405.json").write_text(json.dumps(_document(k), **layout) + ("\n \n" if k % 2 else ""))
    (home / "set-E-20260102_030405.json").write_text("{}")
    return home


def _key(df):
    return sorted((r["source_json"], r["institution"], r["study"], json.dumps(r["j"])) for r in df.select("source_json", "institution", "study", F.to_json("s").alias("j")).collect())


def test_studies_equal_the_whole_reader(spark, folder):
    paths = sorted(glob.glob(f"{folder}/*.json"))
    want = _key(nested.studies_of(nested.documents(spark, paths)))
    assert len(want) > 30
    for size in (None, 700, 90):
        assert _key(nested_text.studies(spark, paths, block_bytes=size)) == want, size
    some = want[0][1]
    assert _key(nested_text.studies(spark, paths, [some], block_bytes=300)) == [w for w in want if w[1] == some]
    images = lambda df: sorted((r["file_uid"], r["series_image_index"], len(r["records"])) for r in df.collect())
    assert images(nested.images_of(nested_text.studies(spark, paths, block_bytes=500))) == images(nested.images(nested.documents(spark, paths)))


def test_documents_that_do_not_end(spark, tmp_path):
    whole = json.dumps(_document(5))
    texts = {"good": whole, "cut": whole[: len(whole) // 2], "text": "not json", "list": "[" + whole + "]", "extra": whole + "}", "quote": whole + '"', "blank": "", "space": " \n" + whole + " \n", "open": whole[:-1] + "\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    paths = [str(tmp_path / f"{n}.json") for n in texts]
    bad = {r["path"].rsplit("/", 1)[1].removesuffix(".json") for r in nested_text.rejected(spark, paths).collect()}
    assert bad == {"cut", "text", "list", "extra", "quote", "open"}  # an empty file has no block
    found = nested_text.studies(spark, paths, block_bytes=800).groupBy("source_json").count().collect()
    counts = {r["source_json"]: r["count"] for r in found}
    assert set(counts) == {"good.json", "space.json"} and len(set(counts.values())) == 1


def test_depths_by_parity():
    for text in ('{"a}":"{{"}', '\\"{', 'x\\\\"}{"', '}}"'):
        parity, plain, quoted = nested_text._depth_change(text)
        assert nested_text._depth_change('"' + text)[1:] == (quoted, plain) and parity == nested_text._depth_change(text * 3)[0] % 2


def _files(spark, doc):
    rows, studies, series = [], [], []
    for i, own in doc["dataset"].items():
        for k, s in own.items():
            studies.append(("d", i, k, json.dumps({x: v for x, v in s.items() if x != "series_list"})))
            for e, x in s["series_list"].items():
                series.append(("d", i, k, e, json.dumps({a: v for a, v in x.items() if a != "file_list"})))
                rows += [("d", i, k, e, f, json.dumps(v)) for f, v in x["file_list"].items()]
    names = ["source_json", "institution", "study", "series", "file"]
    table = lambda some, n, last: spark.createDataFrame(some, ", ".join(f"{c} string" for c in [*names[:n], last]))
    return table(rows, 5, "value"), table(studies, 3, "members"), table(series, 4, "members")


def _pruned(doc):
    out = {}
    for i, own in doc["dataset"].items():
        for k, s in own.items():
            kept = {e: x for e, x in s["series_list"].items() if x["file_list"]}
            if kept:
                out.setdefault(i, {})[k] = s | {"series_list": kept}
    return out


def test_documents_are_written_in_parts(spark, tmp_path):
    doc = _document(8)
    files, studies, series = _files(spark, doc)
    top = spark.createDataFrame([("d", json.dumps({"version_id": "v"})), ("e", "{}")], "source_json string, members string")
    both = files.unionByName(files.withColumn("source_json", F.lit("e")))
    texts = []
    for parts in (1, 8):
        lines = nested_text.document_lines(both.repartition(parts), top, studies, series)
        nested_text.write_documents(lines, str(tmp_path / str(parts)), parts)
        text = lambda d: "".join(open(p, newline="").read() for p in sorted(glob.glob(str(tmp_path / str(parts) / f"source_json={d}" / "part-*"))))  # noqa: E731, B023
        texts.append((text("d"), text("e")))
    assert len(glob.glob(str(tmp_path / "8" / "*" / "part-*"))) > 6
    assert texts[0] == texts[1]
    assert json.loads(texts[0][0]) == {"version_id": "v", "dataset": _pruned(doc)}
    assert json.loads(texts[0][1])["dataset"].keys() == _pruned(doc).keys()
    assert nested_text.document_lines(files.limit(0)).count() == 0


def test_a_document_in_many_files_is_read_as_one(spark, tmp_path):
    docs = {f"{k}": _document(k) for k in (8, 9)}
    tables = [[df.withColumn("source_json", F.lit(k)) for df in _files(spark, doc)] for k, doc in docs.items()]
    files, studies, series = (a.unionByName(b) for a, b in zip(*tables, strict=True))
    folder = str(tmp_path / "many")
    nested_text.write_documents(nested_text.document_lines(files, None, studies, series), folder, 9)
    assert len(glob.glob(f"{folder}/*/part-*")) > 8
    for k, doc in docs.items():
        (tmp_path / k).write_text(json.dumps({"dataset": _pruned(doc)}))
    want = _key(nested_text.studies(spark, [str(tmp_path / k) for k in docs]))
    assert len(want) > 10
    for size in (None, 700):
        assert _key(nested_text.studies(spark, folder, block_bytes=size)) == want, size
    assert nested_text.rejected(spark, folder).count() == 0
    os.remove(max(glob.glob(f"{folder}/source_json=9/part-*")))
    assert [r["path"] for r in nested_text.rejected(spark, folder).collect()] == ["9"]


def test_a_large_document_is_written_by_many_tasks(spark, monkeypatch):
    import re

    from __spark_entry__ import queries

    folders = []
    write = nested_text.write_documents
    monkeypatch.setattr(nested_text, "write_documents", lambda lines, folder, parts=None: (folders.append(folder), spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false"), write(lines, folder, parts)))
    try:
        assert queries()["nested_round_trip"](spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(re.sub("^file:", "", folders[0]) + "/*/part-*")) > 1


def test_many_small_blocks_are_few_tasks(spark, folder, monkeypatch):
    paths = sorted(glob.glob(f"{folder}/*.json"))
    want = _key(nested_text.studies(spark, paths))
    monkeypatch.setattr(nested_text, "TASKS", 1)
    tables, put = [], nested_text.written
    monkeypatch.setattr(nested_text, "written", lambda df, name: tables.append((name, put(df, name))) or tables[-1][1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert _key(nested_text.studies(spark, paths, block_bytes=200)) == want and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    made = dict(tables)
    blocks = made["blocks"].count()
    cores = spark.sparkContext.defaultParallelism
    assert blocks > 10 * cores and all(len(made[name].inputFiles()) <= cores for name in ("block-sums", "records"))
    assert made["block-sums"].rdd.getNumPartitions() <= cores  # tables of numbers aren't cut as the text is


def test_a_text_is_cut_alike_in_one_piece_and_in_many():
    text = json.dumps(_document(3), ensure_ascii=False).encode()
    whole = nested_text._Cutter(False, 0)
    records = whole.feed(text)
    assert len(records) > 5 and "".join([*records, whole.left()]).encode() == text and (whole.inside, whole.depth) == (False, 0)
    ends = [k + 1 for k, c in enumerate(text) if c == ord("}")]
    for step in (1, 3, 50):
        cutter, start, found = nested_text._Cutter(False, 0), 0, []
        for end in [*ends[::step], len(text)]:
            found += cutter.feed(text[start:end])
            start = end
        assert found == records and cutter.left() == whole.left()
        late = nested_text._Cutter(False, 0)
        late.feed(text[: ends[step]])
        rest = nested_text._Cutter(late.inside, late.depth)  # a block that begins there, in a string or not
        assert "".join([late.left(), *rest.feed(text[ends[step] :])]).endswith(records[-1])
