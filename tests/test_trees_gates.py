"""Trees as variants, gates in the writing pass and near images, against plain Python."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.functions import raster, variants
from adjudica.operators import gates, ladders, near_images


def _tree(r, depth=0):
    kind = r.choice("onlsbz" if depth < 4 else "nsbz")
    if kind == "o":
        return {r.choice(["a", "b", 'q"', "x.y", "ü", ""]): _tree(r, depth + 1) for _ in range(r.randrange(4))}
    if kind == "l":
        return [_tree(r, depth + 1) for _ in range(r.randrange(4))]
    return {"n": r.randrange(5), "s": r.choice(["", "x", "y"]), "b": r.random() < 0.5, "z": None}[kind]


def _leaves(tree, path=""):
    if isinstance(tree, dict) and tree:
        return {k: v for name, x in tree.items() for k, v in _leaves(x, f"{path}.{json.dumps(name, ensure_ascii=False)}").items()}
    if isinstance(tree, list) and tree:
        return {k: v for n, x in enumerate(tree) for k, v in _leaves(x, f"{path}[{n}]").items()}
    return {path: json.dumps(tree, separators=(",", ":"), ensure_ascii=False)}


@pytest.fixture(scope="module")
def trees(spark):
    r = random.Random(3)
    pairs = [(_tree(r), _tree(r)) for _ in range(80)] + [({"a": 1}, {"a": None}), ({}, []), ({"a": {}}, {"a": []}), (None, 0)]
    make = lambda side: spark.createDataFrame([(k, json.dumps(p[side])) for k, p in enumerate(pairs)], "id int, j string").select("id", F.parse_json("j").alias("tree"))
    return pairs, make(0), make(1)


def test_leaves_and_differences(trees):
    pairs, left, right = trees
    got = {}
    for r in variants.leaves(left, ["id"], "tree").collect():
        got.setdefault(r["id"], {})[r["path"]] = r["value"]
    assert got == {k: _leaves(a) for k, (a, _) in enumerate(pairs)}
    want = sorted((k, p, x, y) for k, (a, b) in enumerate(pairs) for p in _leaves(a).keys() | _leaves(b).keys() if (x := _leaves(a).get(p)) != (y := _leaves(b).get(p)))
    found = sorted((tuple(r) for r in variants.differences(left, right, ["id"], "tree").collect()), key=repr)
    assert found == sorted(want, key=repr)
    merged = {(r["id"], r["path"]): (r["value"], r["conflict"]) for r in variants.merged(left, right, ["id"], "tree").collect()}
    for k, (a, b) in enumerate(pairs):
        x, y = _leaves(a), _leaves(b)
        assert {p: v for (i, p), v in merged.items() if i == k} == {p: (x.get(p, y.get(p)), p in x and p in y and x[p] != y[p]) for p in x.keys() | y.keys()}
    assert variants.leaves(left.limit(0), ["id"], "tree").count() == 0


def test_states(spark):
    cases = {"{}": "missing", '{"x": null}': "null", '{"x": ""}': "empty", '{"x": []}': "empty", '{"x": {}}': "empty", '{"x": 0}': "value", '{"x": false}': "value", '{"x": [null]}': "value", '{"x": " "}': "value", '{"x": {"a": null}}': "value"}
    df = spark.createDataFrame([(j,) for j in cases], "j string").select("j", F.try_variant_get(F.parse_json("j"), "$.x", "variant").alias("v"))
    assert {r["j"]: r["s"] for r in df.select("j", variants.state(F.col("v")).alias("s")).collect()} == cases


def test_gates_in_the_writing_pass(spark, tmp_path):
    store = f"file://{tmp_path}/store"
    df = spark.range(10).withColumn("bad", F.when(F.col("id") == 3, None).otherwise(F.col("id") > 7))
    rule = lambda **k: gates.Gate("bad rows", gates.count_of(F.col("bad")), **k)
    assert gates.read_visible(spark, store) is None
    with pytest.raises(gates.GateError, match="2 bad rows") as e:
        gates.write_gated(df, store, [rule(), gates.Gate("none", gates.count_of(F.col("id") < 0))])
    assert e.value.failed == {"bad rows": 2} and gates.read_visible(spark, store) is None
    assert gates.write_gated(df, store, [rule(allowed=True)], {"run": 1}) == {"bad rows": 2, "rows": 10}
    first = gates.manifest(spark, store)
    assert first["note"] == {"run": 1} and gates.read_visible(spark, store).count() == 10
    with pytest.raises(gates.GateError):
        gates.write_gated(df.limit(9), store, [gates.Gate("rows", F.count(F.lit(1)), most=3)])
    assert gates.manifest(spark, store) == first  # a failed run leaves what was visible
    gates.write_gated(df.filter("id < 4"), store, [gates.Gate("rows", F.count(F.lit(1)), most=4)])
    assert gates.read_visible(spark, store).count() == 4 and not [p for p in (tmp_path / "store").iterdir() if p.name.startswith(".v")]
    assert gates.write_gated(df.limit(0), store, [rule()])["rows"] == 0 and gates.read_visible(spark, store).count() == 0


def test_the_writing_pass_reads_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(stream):
        for batch in stream:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(50).mapInArrow(count, "id long")
    gates.write_gated(df, f"file://{tmp_path}/once", [gates.Gate("odd", gates.count_of(F.col("id") % 2 == 1), most=25)])
    assert seen.value == 50


def test_gate_sentences(spark):
    rows = [(0, False, False), (2, False, True), (2, True, False), (2, True, True)]
    df = spark.createDataFrame(rows, "n int, allow boolean, told boolean")
    got = [r[0] for r in df.select(ladders.gate_column(F.col("n"), "rows open", F.col("allow"), F.col("told"))).collect()]
    assert got == [ladders.gate(n, "rows open", a, "keep" if t else None) for n, a, t in rows]


@pytest.mark.parametrize(("distance", "crowd"), [(0, 1000), (1, 1000), (3, 1000), (3, 5), (6, 5)])
def test_near_hashes_miss_nothing(spark, monkeypatch, distance, crowd):
    monkeypatch.setattr(near_images, "CROWD", crowd)
    r = random.Random(distance)
    base = [r.getrandbits(64) for _ in range(25)]
    flipped = lambda h, n: h ^ sum(1 << b for b in r.sample(range(64), n))
    some = base + [flipped(r.choice(base), r.randrange(9)) for _ in range(150)] + [0, (1 << 64) - 1, 1, 1 << 63] + [(7 << 40) + k for k in range(40)]
    signed = sorted({h - (1 << 64) if h >> 63 else h for h in some})
    df = spark.createDataFrame([(h,) for h in [*signed, *signed[:9], None]], "hash long")
    got = sorted((x["a"], x["b"]) for x in near_images.near_hashes(df, distance).collect())
    want = sorted((a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= distance)
    assert got == (want if distance else [])


def test_near_images_from_pictures(spark):
    rng = np.random.default_rng(5)
    pictures = [rng.integers(0, 255, (40, 36)).astype(np.uint8) for _ in range(6)]
    pictures += [np.clip(p.astype(int) + rng.integers(-2, 3, p.shape), 0, 255).astype(np.uint8) for p in pictures[:4]] + [pictures[0]]
    rows = [(f"i{k}", int.from_bytes(bytes.fromhex(raster.difference_hash(p)), "big", signed=True), raster.thumbnail(p)) for k, p in enumerate(pictures)] + [("none", None, None)]
    df = spark.createDataFrame(rows, "uid string, hash long, thumb array<double>")
    bits = lambda a, b: bin((a ^ b) & ((1 << 64) - 1)).count("1")
    for distance in (0, 8):
        want = sorted((x[0], y[0]) for i, x in enumerate(rows[:-1]) for y in rows[i + 1 : -1] if bits(x[1], y[1]) <= distance and np.dot(x[2], y[2]) >= 0.98)
        got = sorted(tuple(sorted((r["a"], r["b"]))) for r in near_images.near_images(df, distance).collect())
        assert got == sorted(tuple(sorted(p)) for p in want) and len(want) >= (1 if distance == 0 else 5)


def test_near_vectors_meet_in_chunks(spark, monkeypatch):
    """All pairs of a block, in many small tasks, with the sums of a plain loop; no row of vectors is joined to another."""
    monkeypatch.setattr(near_images, "CHUNK", 7)
    r = random.Random(5)
    vectors = [(k, k % 2 and "odd" or None if k % 5 else "five", [r.gauss(0.3, 1) for _ in range(3)]) for k in range(90)]
    vectors += [(100, "odd", None), (101, "odd", [1.0, None, 1.0]), (102, "odd", [1.0, 1.0]), (103, "zero", [0.0, 0.0]), (104, "zero", [1.0, 0.0])]
    df = spark.createDataFrame(vectors, "vec_id long, block string, embedding array<double>")
    want = []
    for a, block, x in vectors[:90]:
        for b, other, y in vectors[:90]:
            if a < b and block is not None and block == other:
                dot = norm = own = 0.0
                for p, q in zip(x, y, strict=True):
                    dot, norm, own = dot + p * q, norm + p * p, own + q * q
                if (s := dot / (math.sqrt(norm) * math.sqrt(own))) >= 0.4:
                    want.append((a, b, s))
    found = near_images.near_vectors(df, 0.4)
    got = sorted(tuple(x) for x in found.collect())
    assert [g for g in got if g[0] < 100] == sorted(want) and len(want) > 100
    assert [g[:2] for g in got if g[0] >= 100] == [(103, 104)]  # SQL's cosine of a zero vector is above all
