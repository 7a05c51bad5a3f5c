import collections
import hashlib
import pathlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from moraine.llm import decontaminate, embeddings, jaccard, linededup
from moraine.llm.common import components, stored

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def tie(self, a, b):
        self.up[self.find(a)] = self.find(b)


def near_brute(docs, words, percent):
    own = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        own.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    where = collections.defaultdict(list)
    for i, s in enumerate(own):
        for x in s:
            where[x].append(i)
    u = Sets(len(docs))
    for i, s in enumerate(own):
        for k, v in collections.Counter(k for x in s for k in where[x] if k < i).items():
            if 100 * v >= percent * (len(s) + len(own[k]) - v):
                u.tie(i, k)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[u.find(i)] = min(least.get(u.find(i), d), d)
    return {d: (len(own[i]), least[u.find(i)]) for i, (d, _) in enumerate(docs)}


@pytest.fixture(scope="module")
def near_texts():
    rng = random.Random(3)
    out = [None, "", "a", "A", "a b", "a b c d", "A b c\td", "x " * 50, "y " * 20000]
    for _ in range(25):
        b = [rng.choice("abcdefghijkl") + str(rng.randint(0, 30)) for _ in range(rng.randint(3, 60))]
        for _ in range(8):
            c = list(b)
            for _ in range(rng.randint(0, 4)):
                c[rng.randrange(len(c))] = rng.choice("abc")
            out.append(" ".join(c))
    return out


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (2, 60), (1, 50)])
def test_jaccard_groups(spark, near_texts, words, percent):
    rows = [(i, t, 1, "k") for i, t in enumerate(near_texts)]
    df = spark.createDataFrame([*rows, rows[20], rows[20], rows[77]], "doc_id long, text string, n int, key string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, words, percent).collect()}
    assert got == near_brute(list(enumerate(near_texts)), words, percent)


def test_short_texts_that_extend_each_other_are_admitted(spark):
    for words, percent in ((4, 85), (5, 80)):
        texts = []
        for n in range(1, 13):  # sets of n and n + more shingles, none shared with other texts
            for more in (1, 2):
                own = [f"w{len(texts)}x{i}" for i in range(n + more + words - 1)]
                texts += [" ".join(own[: n + words - 1]), " ".join(own)] if 100 * n >= percent * (n + more) else []
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        rows = jaccard.summarised(df, "doc_id", "text", words)
        assert jaccard.admitted(df, rows, "doc_id", "text", words, percent)[1].count() == len(texts) > 0


def test_texts_that_agree_in_polynomial_hashes_are_apart(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    docs = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word + " x"), (4, "b" + word)]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 2, 3: 3, 4: 4}


def test_tokens_and_classes_that_very_many_have(spark, monkeypatch):
    """Common tokens, large groups of copies and small batches give what brute force gives."""
    monkeypatch.setattr(jaccard, "NOBODY", 7)
    monkeypatch.setattr(jaccard, "HOT", 5)
    rng = random.Random(6)
    common = "all texts begin with the same eight words "
    texts = [common + " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(rng.randint(4, 50))) for _ in range(40)]
    texts += [t + " end" for t in texts[:20]] + [texts[0]] * 12 + [texts[1] + " end"] * 7 + [None, "", " "] * 4
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, 3, 70).collect()}
    assert got == near_brute(list(enumerate(texts)), 3, 70)


def test_one_of_each_keeps_other_columns(spark, hard_docs):
    out = jaccard.one_of_each(hard_docs)
    assert out.schema == hard_docs.schema and out.count() > 0


def test_jaccard_query_and_empty(spark, small_sf, empty_docs):
    docs = [tuple(r) for r in spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.query(spark, small_sf).collect()} == near_brute(docs, 4, 85)
    assert jaccard.near_duplicates(empty_docs).count() == 0 and jaccard.one_of_each(empty_docs).count() == 0


def within(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = max(a, b, key=len), min(a, b, key=len)
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def lines_brute(docs, least=1, edit=10):
    first, rows = {}, []
    for d, t in docs:
        for no, line in enumerate((t or "").split("\n")):
            w = tuple(x for x in re.split("[ \t\x0b\f\r]+", line.lower()) if x)
            if len(w) >= least:
                rows.append((d, no, w))
                first.setdefault(w, (d, no))
    sized = collections.defaultdict(list)
    for w, at in first.items():
        sized[len(w)].append((at, w))
    near = {w for w, at in first.items() if any(a < at and within(w, v) for n in (len(w) - 1, len(w), len(w) + 1) if max(n, len(w)) >= edit for a, v in sized[n])}
    gone = collections.defaultdict(set)
    for d, no, w in rows:
        if w in near or first[w] != (d, no):
            gone[d].add(no)
    return {d: (len((t or "").split("\n")), len(gone[d]), hashlib.sha256("\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[d]).encode()).hexdigest()) for d, t in docs}


def test_lines_on_edits(spark):
    rng = random.Random(8)
    texts = [None, "", "\n\n", "a b c d e\na b c d e"]
    for _ in range(12):
        b = [rng.choice("abcdef") + str(rng.randint(0, 9)) for _ in range(rng.randint(9, 16))]
        lines = []
        for _ in range(9):
            c = list(b)
            for _ in range(rng.randint(0, 2)):
                i = rng.randrange(len(c))
                k = rng.randrange(3)
                if k == 0:
                    c[i] = "zz"
                elif k == 1:
                    del c[i]
                else:
                    c.insert(i, "yy")
            lines.append("  ".join(c) if rng.random() < 0.3 else " ".join(c))
        texts += ["\n".join(lines[:4]), "\n".join(lines[4:])]
    texts += ["x y " * 4000 + "end", "x y " * 4000 + "End other", "yes\nyes\nno", "no\n  \nNO", "one two three four five six seven eight nine", "one two three four and five six seven eight nine"]
    texts += ["1 2 3 4 5 6 7 8 9 ten", "1 2 3 4 5 6 7 8 9", "a1 2 3 4 5 6 7 8 9", "a2 2 3 4 5 6 7 8 9"]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(texts)], "doc_id long, text string, no int, w string").repartition(3)
    out = linededup.dedup_lines(df)
    assert out.columns == df.columns
    kept = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in out.collect()}
    assert kept == {d: v[2] for d, v in lines_brute(list(enumerate(texts))).items()}


def test_lines_query_and_empty(spark, small_sf, empty_docs, hard_docs):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").collect())
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in linededup.query(spark, small_sf).collect()} == lines_brute(docs)
    assert linededup.dedup_lines(empty_docs).count() == 0
    assert linededup.dedup_lines(hard_docs).count() == hard_docs.count()


def shuffled(spark):
    """Bytes that each stage so far has written to shuffles, by stage."""
    store = spark.sparkContext._jsc.sc().statusStore()
    found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (found.apply(i) for i in range(found.size()))}


@pytest.fixture
def unplanned(spark):
    """The planner broadcasts nothing by itself."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_lines_disk(spark, small_sf, unplanned):
    """What is shuffled stays under twice the input, also where the planner broadcasts nothing by itself."""
    size = sum(f.stat().st_size for f in pathlib.Path(small_sf).glob("documents.parquet/**/*") if f.is_file()) or pathlib.Path(small_sf, "documents.parquet").stat().st_size
    before = shuffled(spark)
    linededup.query(spark, small_sf).write.format("noop").mode("overwrite").save()
    written = sum(v for k, v in shuffled(spark).items() if k not in before)
    assert 0 < written < 2 * size


def test_lines_where_nothing_is_broadcast(spark, small_sf, monkeypatch):
    monkeypatch.setattr(linededup, "small", lambda df: df)
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").collect())
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in linededup.query(spark, small_sf).collect()} == lines_brute(docs)


def test_lines_whose_documents_are_too_many_to_broadcast(spark, unplanned, monkeypatch):
    """Only texts that hold lines under suspicion are shuffled."""
    monkeypatch.setattr(linededup, "small", lambda df: F.broadcast(df) if "_bits" in df.columns else df)
    rng = random.Random(4)
    texts = ["\n".join(" ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(60)) for _ in range(20)) for _ in range(200)]
    texts += [texts[3].split("\n")[5].replace(" ", " more ", 1), texts[150].rpartition(" ")[0] + " end", texts[7]]
    df = spark.createDataFrame(list(enumerate(texts)) + [(200, texts[200])], "doc_id long, text string")
    before = shuffled(spark)
    gone = {r.did: (r.nos, r.near) for r in linededup.dropped(df, "doc_id", "text").collect()}
    written = sum(v for k, v in shuffled(spark).items() if k not in before)
    assert gone == {200: ([0], 1), 201: (list(range(20)), 1), 202: (list(range(20)), 0)}
    assert written < sum(map(len, texts)) / 2


def test_sieve_passes_all_keys(spark):
    rows = spark.range(4000).select(F.xxhash64("id").alias("k"), F.col("id").alias("_bits"), F.lit("x").alias("_chunk"))
    keys = stored(rows.where("_bits % 5 = 0").select("k"), "keys")
    got = {r._bits for r in linededup.sieved(rows, "k", keys).collect()}
    assert set(range(0, 4000, 5)) <= got and len(got) < 2000
    assert linededup.sieved(rows, "k", keys).columns == rows.columns
    assert linededup.sieved(rows, "k", stored(keys.limit(0), "keys")).count() == 0


def leaks_brute(docs, bench, n=10):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    wins = collections.defaultdict(set)
    for item, t in bench:
        w = find((t or "").translate(LOW))
        m = min(n, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            wins[tuple(w[i : i + m])].add(str(item))
    out = {}
    for d, t in docs:
        w, hit, items = find((t or "").translate(LOW)), set(), set()
        for m in {len(k) for k in wins}:
            for i in range(len(w) - m + 1):
                if got := wins.get(tuple(w[i : i + m])):
                    hit |= set(range(i, i + m))
                    items |= got
        out[d] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    return out


def test_leaks(spark, hard_docs, hard_texts, empty_docs, small_sf):
    bench = [(1, hard_texts[15]), (2, "a b c d e f g h i j k"), (3, "foo"), (4, None), (5, "É zz Ba"), (6, "..."), (7, "zz foo ba é 1 2")]
    b = spark.createDataFrame(bench, "item_id long, text string")
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = {r.doc_id: tuple(r[c] for c in columns) for r in decontaminate.report(hard_docs, b).collect()}
    assert got == leaks_brute(list(enumerate(hard_texts)), bench)
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{small_sf}/{t}.parquet").select(*c).collect()]
    assert {r.doc_id: tuple(r[c] for c in columns) for r in decontaminate.query(spark, small_sf).collect()} == leaks_brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    clean = decontaminate.decontaminate(hard_docs, b, mode="spans")
    assert clean.columns == hard_docs.columns and clean.count() == hard_docs.count()
    again = leaks_brute([(r.doc_id, r.text) for r in clean.collect()], bench)
    before = leaks_brute(list(enumerate(hard_texts)), bench)
    assert all(again[d][0] == before[d][0] - before[d][1] for d in before)
    assert decontaminate.decontaminate(empty_docs, b).count() == 0 and decontaminate.decontaminate(hard_docs, b.limit(0)).count() == hard_docs.count()


def vectors_brute(rows, threshold=0.98):
    unit, ok = [], []
    for _, v, label in rows:
        good = v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(good)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    n, u = [0] * len(rows), Sets(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                n[i] += 1
                n[j] += 1
                u.tie(i, j)
    least = {}
    for i, r in enumerate(rows):
        least[u.find(i)] = min(least.get(u.find(i), r[0]), r[0])
    return {r[0]: (n[i], least[u.find(i)]) for i, r in enumerate(rows)}


def test_vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(12):
        c = rng.normal(size=16)
        rows += [((c + rng.normal(size=16) * s) * rng.uniform(0.1, 9)).tolist() for s in (0, 0, 0.03, 0.08, 0.15, 0.3)]
    rows = [(i, v, i // 18) for i, v in enumerate(rows)]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [None] + [1.0] * 15, 1), (203, [float("nan")] * 16, 1), (204, [float("inf")] * 16, 1), (205, rows[0][1], None), (206, [1.0, 2.0], 0), (207, [2.0, 4.0], 0), (208, [], 0), (209, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, key int, list string").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert got == vectors_brute(rows)
    assert embeddings.near_duplicates(df, lists=6).where("n_links > 0").count() == sum(v[0] > 0 for v in got.values())
    assert embeddings.near_duplicates(df.limit(0)).count() == 0 and embeddings.near_duplicates(df.where("vec_id = 200")).first().component_id == 200


def test_recall_against_brute_force(spark, small_sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected = vectors_brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.query(spark, small_sf).collect()}
    found, wanted = sum(v[0] for v in got.values()), sum(v[0] for v in expected.values())
    assert found >= 0.9 * wanted and got == expected


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 80)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)]
    u = Sets(3000)
    for a, b in edges:
        u.tie(a, b)
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {i: min(j for j in ids if u.find(j) == u.find(i)) for i in ids if min(j for j in ids if u.find(j) == u.find(i)) != i}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0 and F is not None
