"""The pipeline's stages, each against what its operator is tested for."""

import re
import sys
from hashlib import md5
from pathlib import Path

import numpy as np
from conftest import SF

import corpus_pipeline
from adjudica.llm import queries, rule_classifier

sys.path.insert(0, str(Path(__file__).parent))
import test_corpus as brute  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen, before = docs.columns, [], {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(name)
        now = docs.collect()
        if k < 4:
            assert docs.columns == columns
            ids = [r["doc_id"] for r in now]
            assert set(ids) <= set(before) and (k == 3 or len(ids) == len(set(ids)))
        if k == 0:
            assert all(labels.get(i) != 0 for i in ids) and all(r["text"] == before[r["doc_id"]]["text"] for r in now)
            assert {i for i, q in labels.items() if q == 1 and i in before} <= set(ids)
        if k == 1:
            kept = {r["doc_id"]: r["text"] for r in now}
            for i, text in kept.items():
                assert set(text.split("\n")) <= set(before[i]["text"].split("\n")) and WORD.search(text)
        if k == 2:
            texts = [r["text"] for r in now]
            assert len(texts) == len(set(texts)) and set(texts) <= {r["text"] for r in before.values()}
        if k == 3:
            assert abs(sum(len(WORD.findall(r["text"])) for r in now) - 1.5 * sum(len(WORD.findall(r["text"])) for r in before.values())) < 0.02 * sum(len(WORD.findall(r["text"])) for r in before.values())
        if k == 4:
            assert {r["doc_id"] for r in now} == set(before)
        before = {r["doc_id"]: r for r in now}
    assert seen == [s for s, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.ORACLE_SQL or "") == 0


def test_stages_equal_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    kept: dict[str, list] = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
    quality, lines, near, mixed, packed = (kept[name] for name, _ in corpus_pipeline.STAGES)
    pairs = lambda rs: sorted((r["doc_id"], r["text"]) for r in rs)

    model = rule_classifier.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert pairs(quality) == pairs(r for r in rows if brute.plain_score(model, r["text"] or "") >= 0.3)
    left = {(i, t): "\n".join(x) for (i, t), x in brute._brute_lines(pairs(quality), 50).items()}
    assert pairs(lines) == sorted((i, new) for (i, t), new in left.items() if WORD.search(new) or not WORD.search(t))
    label = brute._classes(pairs(lines), 5, 80)
    assert pairs(near) == [(i, t) for i, t in pairs(lines) if label[i] == i]

    size = {r["doc_id"]: len(WORD.findall(r["text"])) for r in near}
    sources = sorted({r["source"] for r in near}, key=lambda x: (x is None, x or ""))
    held = {s: sum(size[r["doc_id"]] for r in near if r["source"] == s) for s in sources}
    weight, left_words, target = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}, 1.5 * sum(held.values()), {}
    while over := [s for s in weight if weight[s] * left_words / sum(weight.values()) > 2 * held[s]]:
        target |= {s: 2 * held[s] for s in over}
        left_words, weight = left_words - sum(2 * held[s] for s in over), {s: w for s, w in weight.items() if s not in over}
    target |= {s: w * left_words / sum(weight.values()) for s, w in weight.items()}
    want = []
    for s in sources:
        own = [r for r in near if r["source"] == s and size[r["doc_id"]]]
        key = lambda r: md5(f"mix|{r['doc_id']}|{md5(r['text'].encode()).hexdigest()}".encode()).hexdigest()
        epochs, rest = divmod(int(target[s] + 1e-9), held[s]) if held[s] else (0, 0)
        for r in sorted(own, key=key):
            part, rest = min(rest, size[r["doc_id"]]), max(rest - size[r["doc_id"]], 0)
            want += [(r["doc_id"], tuple(WORD.findall(r["text"])[:n])) for n in [size[r["doc_id"]]] * epochs + [part] * (part > 0)]
    assert sorted((r["doc_id"], tuple(WORD.findall(r["text"]))) for r in mixed) == sorted(want)

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    pieces = []
    for r in mixed:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0]
        pieces += [(r["doc_id"], k // 2048, k, ids[k : k + 2048]) for k in range(0, len(ids), 2048)]
    assert sorted((r["doc_id"], r["piece"], r["start"], np.frombuffer(r["ids"], dtype="<u4").tolist()) for r in packed) == sorted(pieces)
    bins: dict = {}
    for r in sorted(packed, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 2048 and len(bins) <= -(-sum(bins.values()) // 2048) + 2
