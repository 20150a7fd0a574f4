"""Filter audit, periodic runs and prefix hashes against brute force: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import random
import re
import zlib
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from conftest import SF, same_as_sql
from pyspark.sql import functions as F

from adjudica.llm import filter_audit, periodic_runs, prefix_hashes, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(2_000))
ODD = [
    (1, "one two THREE # four", "en"), (2, None, "en"), (3, "", None), (4, " \t\n\x0b\x0c\r ", ""), (5, "one two THREE # four", "de"), (5, "one two THREE # four", "de"), (5, "other text", "de"),
    (6, LONG, "en"), (7, LONG + " tail", None), (None, "nameless words", "en"), (None, "one two THREE # four", "en"), (8, "a b " * 300, "fr"), (9, "a b " * 300, "fr"), (10, "ABC " * 90 + " ".join(f"x{i}" for i in range(120)), "en"),
    (12, "x ퟿ é ß \U0001f600 <|end|> it's", "en"), (20, "la la la la la la end", "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string").withColumns({c: F.lit("x") for c in ("mask", "part", "range", "n", "runs", "id", "digest", "tie")})


def brute_audit(rows, labels):
    """The counts by walking every document through every order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = {}
    for i, text, lang in rows:
        t, w = text or "", WORD.findall(text or "")
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > least[t]}
        for order in permutations("ABCDE"):
            failed = False
            for step, f in enumerate(order, 1):
                c = out.setdefault((lang or "", "".join(order), step), [0] * 7)
                first = fails[f] and not failed
                c[1] += first
                c[2] += fails[f] and failed
                c[3] += fails[f] and sum(fails.values()) == 1
                c[4] += first and i in good
                c[5] += first and i in toxic
                failed |= fails[f]
                c[0] += not failed
    for (part, order, step), c in out.items():
        c[6] = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == order[step - 1])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_as_brute_force(spark, odd):
    labels = [(1, 1, 0), (5, 0, 1), (5, 1, None), (6, 1, 1), (7, None, 1), (8, 1, 0), (9, 1, 1), (None, 1, 1), (99, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(7))
    for rows, table in ((ODD, odd), (ODD * 2, odd.union(odd).repartition(5))):
        got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filter_audit.COUNTS) for r in filter_audit.audit(table, marks).collect()}
        assert got == brute_audit(rows, labels)
    assert filter_audit.audit(odd.limit(0), marks).count() == 0
    empty = filter_audit.audit(odd, marks.limit(0))
    assert empty.agg(F.sum("good_lost")).first()[0] == 0 and empty.count() == 4 * 600


def test_audit_as_sql(spark):
    same_as_sql(queries.op11_filter_audit(spark, SF), queries.oracle_sql()["op11_filter_audit"])


def test_outcome_matrices_add_up():
    orders, m = filter_audit.outcome_matrices("ABCDE")
    assert len(orders) == 120 and all(x.shape == (32, 600) for x in m.values())
    last = m["kept"][:, 4::5]
    assert (sum(m["removed"][:, k::5] for k in range(5)) + last == 1).all()
    assert filter_audit.outcome_matrices("AB")[1]["kept"].tolist() == [[1, 1, 1, 1], [0, 0, 1, 0], [1, 0, 0, 0], [0, 0, 0, 0]]


def brute_runs(words):
    """Every maximal stretch of four periods and six words or more with its smallest period, by extending each start at each lag."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > i:
                length = end - i + q
                if length >= max(6, 4 * q):
                    found.setdefault((i, length), q)  # ascending q: the smallest period comes first
                i = end
            else:
                i += 1
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_digest(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_runs_as_brute_force():
    r = random.Random(12)
    some = [[r.randrange(k) for _ in range(r.randint(0, 90))] for k in (1, 2, 2, 3, 5, 40) for _ in range(150)]
    for _ in range(200):  # runs inside runs, next to runs, cut off
        part = []
        for _ in range(r.randint(1, 5)):
            unit = [r.randrange(3) for _ in range(r.randint(1, 25))]
            part += (unit * r.randint(1, 9))[: r.randint(1, 150)]
        some.append(part)
    for words in some:
        assert periodic_runs.find_runs(np.array(words, np.int64)) == sorted(brute_runs(words), key=lambda x: (x[0], x[2])), words


def test_lag_matches_are_exact():
    r = np.random.default_rng(3)
    for n, kinds in ((7, 2), (500, 3), (3000, 40), (4000, 2000)):
        ids = np.minimum(r.geometric(0.2, n), kinds).astype(np.int64) if kinds == 40 else r.integers(0, kinds, n)
        want = [int((ids[: n - q] == ids[q:]).sum()) for q in range(n // 4 + 1)]
        assert periodic_runs.lag_matches(ids, n // 4).tolist() == want


def test_long_runs_take_little_time():
    for ids in (np.zeros(2_000_000, np.int64), np.arange(900_000) % 1013, np.random.default_rng(1).integers(0, 2, 100_000)):
        runs = periodic_runs.find_runs(ids.astype(np.int64))
        assert len(runs) == 1 or len(ids) == 100_000


def test_words_in_slices(monkeypatch):
    text = ("é " + LONG[:5000] + " \n\n" + "y" * 300).encode()
    whole = periodic_runs.word_numbers(text)
    monkeypatch.setattr(periodic_runs, "SLICE", 7)
    ids, names = periodic_runs.word_numbers(text)
    assert names == whole[1] and ids.tolist() == whole[0].tolist() and [names[k] for k in ids] == text.split()


def test_run_query_as_brute_force(spark, odd):
    planted = [(i, " ".join(f"v{(i * 7 + k * k) % 50}" for k in range(i % 130)), "en") for i in range(200, 420)]
    table = odd.select("doc_id", "text", "runs").union(spark.createDataFrame(planted, "doc_id long, text string, lang string"))
    got = periodic_runs.run_digests(periodic_runs.collapse_runs(periodic_runs.with_planted_runs(table.repartition(3))))
    key = lambda x: sorted(x, key=repr)
    want = [brute_digest(i, t) for i, t, _ in [*ODD, *planted]]
    assert key(tuple(r) for r in got.collect()) == key(want) and sum(w[1] > 0 for w in want) > 10
    assert periodic_runs.collapse_runs(table.limit(0)).count() == 0


def test_run_query_on_a_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect() if len(r[1] or "") < 4000]
    got = {r[0]: tuple(r) for r in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == table.count() and all(got[i] == brute_digest(i, t) for i, t in rows)


def test_prefix_hashes_answer_spans(monkeypatch):
    monkeypatch.setattr(prefix_hashes, "BLOCK", 16)
    r = random.Random(4)
    a = "".join(r.choice("ab\U0001f600") for _ in range(200))
    b = a[50:120] + "c" + a[121:]
    x, y = prefix_hashes.PrefixHashes(a), prefix_hashes.PrefixHashes(b)
    for _ in range(500):
        i, j = r.randrange(len(a)), r.randrange(len(b))
        n = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
        assert x.extension(i, y, j) == n
        k = r.randint(0, min(len(a) - i, len(b) - j))
        assert x.equal(i, y, j, k) == (a[i : i + k] == b[j : j + k])
    assert x.extension(50, y, 0) == 70 and prefix_hashes.PrefixHashes("").extension(0, x, 0) == 0


def test_fingerprints_do_not_depend_on_blocks(monkeypatch):
    r = random.Random(6)
    texts = ["", "a", "\U0001f600é", "x" * 31, "x" * 32, "x" * 33, "".join(r.choice("abcde ") for _ in range(3000))]
    whole = [prefix_hashes.fingerprint(t) for t in texts]
    monkeypatch.setattr(prefix_hashes, "BLOCK", 50)
    prefix_hashes._powers.cache_clear()
    assert [prefix_hashes.fingerprint(t) for t in texts] == whole
    prefix_hashes._powers.cache_clear()
    assert len(set(whole)) == len(whole)
    p = prefix_hashes.PrefixHashes(texts[-1])
    marks = prefix_hashes.rungs(3000)
    ladder = np.frombuffer(whole[-1], ">u4", offset=14)
    assert ladder[: len(marks)].tolist() == [p.span(0, m)[0] for m in marks]
    assert ladder[len(marks) : 2 * len(marks)].tolist() == [p.span(3000 - m, 3000)[0] for m in marks]


def test_fingerprints_of_texts_a_little_longer_than_blocks(spark):
    text = "".join(random.Random(7).choices("abcdefgh ", k=2 * prefix_hashes.BLOCK + 40))
    for n in [prefix_hashes.BLOCK * b + k for b in (1, 2) for k in (0, 1, 2, 30, 31, 32, 33)]:
        mark, p, steps = prefix_hashes.fingerprint(text[:n]), prefix_hashes.PrefixHashes(text[:n]), prefix_hashes.rungs(n)
        found = np.frombuffer(mark, ">u4", offset=14).tolist()
        assert found[: 2 * len(steps)] == [p.span(0, s)[0] for s in steps] + [p.span(n - s, n)[0] for s in steps]
        if n not in (prefix_hashes.BLOCK + 1, 2 * prefix_hashes.BLOCK + 30):
            continue
        mixed = {(p.span(i, i + prefix_hashes.WIDTH)[0] * int(prefix_hashes.MIX) % 2**64) >> 32 for i in range(n - prefix_hashes.WIDTH + 1)}
        assert found[2 * len(steps) :] == sorted(mixed)[: prefix_hashes.SPANS]
    docs = spark.createDataFrame([(i, text[: prefix_hashes.BLOCK + i]) for i in range(4)], "doc_id long, text string")
    assert prefix_hashes.compare_with_next(docs).count() == 4


def test_likeness():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    text, other = (" ".join(word() for _ in range(400)) for _ in range(2))
    near = lambda a, b: prefix_hashes.likeness(prefix_hashes.fingerprint(a), prefix_hashes.fingerprint(b))
    words = text.split()
    moved = " ".join(words[200:] + words[:200])
    one_off = " ".join([*words[:200], "changed", *words[201:]])
    assert near(text, text) == near("", "") == 1 and near(text, other) < 0.05 and near(text, "") == 0
    assert near(text, moved) > 0.9 and near(text, one_off) > 0.85 and 0.4 < near(text, text[:1200] + other[1200:]) < 0.75
    for a, b in ((text, other), (text, moved), ("a", "b"), ("ab", "ac"), ("x" * 40, "x" * 41), (text, text[:5])):
        assert near(a, b) == near(b, a) and 0 <= near(a, b) < 1


def brute_next(rows):
    """(doc_id, text) of each row with the next one's text, rows alike as one."""
    low = lambda i: -(1 << 63) if i is None else i
    from_spark = {}

    def order(row):
        return (low(row[0]), from_spark[row[1]])

    def pairs(ties):
        from_spark.update(ties)
        keys = sorted({(i, t or "") for i, t in rows}, key=order)
        after = {k: keys[n - 1] for n, k in enumerate(keys)}
        return [(i, t or "", after[(i, t or "")][1]) for i, t in rows]

    return pairs


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next_documents_as_brute_force(spark, odd, parts):
    more = [(i, f"text of {i} " * (i % 40), "en") for i in range(100, 260)] + [(77, f"same id {k}", "en") for k in range(90)] + [(78, "alike", "en")] * 60 + [(None, f"no id {k}", "en") for k in range(30)] + [((1 << 61) + k, f"large {k}", "en") for k in range(40)]
    rows = [(i, t) for i, t, _ in [*ODD, *more]]
    table = odd.select("doc_id", "text", "tie", "range", "id").union(spark.createDataFrame(more, "doc_id long, text string, lang string").select("doc_id", "text", *[F.lit("x")] * 3)).repartition(7)
    ties = {r[0]: r[1] for r in spark.createDataFrame([(t,) for t in {t or "" for _, t in rows}], "t string").select("t", F.shiftrightunsigned(F.xxhash64("t"), 12)).collect()}
    want = []
    for i, t, after in brute_next(rows)(ties):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = map(prefix_hashes.fingerprint, (t, edited, after))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), prefix_hashes.likeness(a, b), prefix_hashes.likeness(a, c)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = [tuple(r) for r in prefix_hashes.compare_with_next(table).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_next_documents_of_small_tables(spark, odd):
    assert prefix_hashes.compare_with_next(odd.limit(0)).count() == 0
    one = prefix_hashes.compare_with_next(spark.createDataFrame([(4, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0 and one["n_chars"] == 4


def test_next_documents_as_sql(spark):
    import duckdb

    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in queries.op13_prefix_fingerprints(spark, SF).collect()}
    want = duckdb.sql(f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(text) OVER w, first_value(text) OVER w, '') AS x FROM '{SF}/documents.parquet' WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        SELECT doc_id, length(t), sha256(left(t, length(t) - length(t) // 2) || left(x, length(t) // 2)) FROM d""").fetchall()
    assert got == {i: (n, s) for i, n, s in want}


def test_fingerprint_column(odd):
    got = prefix_hashes.fingerprints(odd.select("doc_id", "text", F.lit(1).alias("fingerprint"))).collect()
    assert all(r["fingerprint"] == prefix_hashes.fingerprint(r["text"] or "").hex() for r in got) and len(got) == len(ODD)
